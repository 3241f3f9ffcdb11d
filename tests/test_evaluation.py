import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from paddock.operators import collinearity, evaluation, registry


def scored(spark, rows):
    return spark.createDataFrame(rows, "actual_price_eur double, predicted_price_eur double, region string")


def test_metrics_with_zero_actuals(spark):
    df = scored(spark, [(100.0, 90.0, "a"), (0.0, 0.0, "a"), (200.0, 230.0, None), (50.0, 50.0, "b")])
    row = evaluation.regression_metrics(df).first()
    assert row["mae_eur"] == 10.0 and row["median_ae_eur"] == 5.0
    assert row["mape"] == pytest.approx((0.1 + 0.15) / 4) and row["within_10pct"] == 0.75 and row["within_15pct"] == 1.0
    assert evaluation.regression_metrics(scored(spark, [(0.0, 1.0, "a")])).first()["mape"] == float("inf")
    with pytest.raises(ValueError):
        evaluation.regression_metrics(df.limit(0), check=True)
    segments = evaluation.segment_metrics(df, ["region", "absent"])
    assert {(r["segment_value"], r["n_rows"]) for r in segments.collect()} == {("a", 2), ("b", 1)}


def test_bootstrap_of_a_constant_is_degenerate(spark):
    df = spark.createDataFrame([(i, 3.5) for i in range(5)], "position int, v double")
    row = evaluation.bootstrap_mean_ci(df, "v", "position", iterations=50).first()
    assert (row["ci_low"], row["ci_high"]) == (3.5, 3.5)
    with pytest.raises(ValueError):
        evaluation.bootstrap_mean_ci(df.limit(0), "v", "position")


def test_weights_by_row_give_the_interval_of_drawn_rows(spark):
    """Both forms near the normal interval of the mean; a hot group, nulls and a lone row included."""
    values = np.random.default_rng(3).gamma(2.0, 50.0, 1500)
    df = spark.createDataFrame([(i, float(v), "a") for i, v in enumerate(values)], "position int, v double, g string")
    drawn = evaluation.bootstrap_mean_ci(df, "v", "position").first()
    more = spark.createDataFrame([(1, 7.0, "b"), (2, None, "b"), (3, float("nan"), "b"), (4, 2.0, None), (5, None, "c")], df.schema)
    rows = {r["g"]: r for r in evaluation.bootstrap_mean_ci_rows(df.unionAll(more), "v", ["position"], ["g"]).collect()}
    width = 2 * 1.96 * values.std() / np.sqrt(len(values))
    for bound, at in (("ci_low", -0.5), ("ci_high", 0.5)):
        assert abs(rows["a"][bound] - drawn[bound]) < 0.06 * width
        assert abs(rows["a"][bound] - (values.mean() + at * width)) < 0.06 * width
    assert rows["a"]["mean"] == pytest.approx(values.mean())
    assert {g: (r["mean"], r["ci_low"], r["ci_high"]) for g, r in rows.items() if g != "a"} == {"b": (7.0, 7.0, 7.0), None: (2.0, 2.0, 2.0)}
    whole = evaluation.bootstrap_mean_ci_rows(df, "v", ["position"]).first()
    assert (whole["ci_low"], whole["ci_high"]) == (rows["a"]["ci_low"], rows["a"]["ci_high"])
    with pytest.raises(ValueError):
        evaluation.bootstrap_mean_ci_rows(df.limit(0), "v", ["position"])


def test_weights_by_row_shuffle_sums_only(spark):
    df = spark.range(100).selectExpr("id", "id * 1.0 as v")
    plan = evaluation.bootstrap_mean_ci_rows(df, "v", ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "partial_sum" in plan and "SortMergeJoin" not in plan


def test_weights_by_row_digest_a_key_once_for_all_groups(spark):
    """Keys that repeat, within a group and over groups, or are null."""
    rows = [(i % 40 if i % 7 else None, "ab"[i % 2], float(i)) for i in range(120)]
    df = spark.createDataFrame(rows, "k int, g string, v double")
    found = evaluation.bootstrap_mean_ci_rows(df, "v", ["k"], ["g"], iterations=40)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" in plan[plan.rindex("Generate explode") :]  # keys are dealt before they are digested
    shares = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(13)])

    def weight(k, b):
        digest = hashlib.md5(f"42|{b // 4}|{'' if k is None else k}".encode()).hexdigest()
        return int(np.searchsorted(np.floor(2**32 * shares), int(digest[8 * (b % 4) : 8 * (b % 4) + 8], 16), "right"))

    for r in found.collect():
        own = [(k, v) for k, g, v in rows if g == r["g"]]
        means = [sum(weight(k, b) * v for k, v in own) / sum(weight(k, b) for k, _ in own) for b in range(40)]
        assert (r["ci_low"], r["ci_high"]) == pytest.approx(tuple(np.quantile(means, [0.025, 0.975])))


def test_histogram_counts_every_value(spark):
    values = [float(v) for v in np.linspace(0, 10, 101)]
    df = spark.createDataFrame([(v, 1.0) for v in values], "a double, b double")
    rows = evaluation.histogram(df, {"a": 10, "b": 5}).collect()
    counts = [n for _, n in sorted((r["bin"], r["n"]) for r in rows if r["column"] == "a")]
    assert counts == list(np.histogram(values, 10)[0]) and [r["n"] for r in rows if r["column"] == "b"] == [101]


def test_vif_matches_regressions_without_a_constant(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 3)) * [1, 1000, 1e6] + [1, 2, 3]
    x[:, 2] += 900 * x[:, 1]
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double")
    got = {r["feature"]: r["vif"] for r in collinearity.vif(df).collect()}
    for i, name in enumerate("abc"):
        others = np.delete(x, i, 1)
        fit = others @ np.linalg.lstsq(others, x[:, i], rcond=None)[0]
        assert got[name] == pytest.approx((x[:, i] ** 2).sum() / ((x[:, i] - fit) ** 2).sum(), rel=1e-6)


def run_tables(spark):
    runs = spark.createDataFrame([(1, "2024-01-01", "d1"), (2, "2024-01-02", "d2"), (3, "2024-01-02", None)], "id long, created_at string, output_dir string")
    metrics = spark.createDataFrame(
        [(1, "m", 5.0, 1.0, 1.0, 1.0, 1.0, 1), (2, "m", 5.0, 1.0, 1.0, 1.0, 1.0, 2), (3, "m", 5.0, 1.0, 1.0, 1.0, 1.0, 3), (1, "n", 1.0, 1.0, 1.0, 1.0, 1.0, 4), (1, "n", 0.5, 1.0, 1.0, 1.0, 1.0, 5)],
        "run_id long, model_name string, mae_eur double, median_ae double, mape double, within_10 double, within_15 double, insert_order long",
    )
    skips = spark.createDataFrame([(1, "z", "no"), (1, "a", "no")], "run_id long, model_name string, reason string")
    return runs, registry.unique_rows(metrics), skips


def test_registry_ties_history_and_skips(spark):
    runs, metrics, skips = run_tables(spark)
    best = {r["model_name"]: r for r in registry.best_run_summary(runs, metrics, skips).collect()}
    assert best["m"]["run_id"] == 3 and best["n"]["mae_eur"] == 1.0 and best["n"]["skipped_count"] == 2 and best["m"]["skipped_count"] == 0
    listed = {r["run_id"]: [tuple(s) for s in r["skipped_models"]] for r in registry.best_run_skips(registry.best_run_summary(runs, metrics, skips), skips).collect()}
    assert listed == {1: [("a", "no"), ("z", "no")], 3: []}
    last = registry.latest_run(runs, metrics, skips).first()
    assert last["id"] == 3 and set(last["metrics"]) == {"m"} and last["skipped"] is None
    assert [r["model_count"] for r in registry.run_history(runs, metrics).collect()] == [2, 1, 1]
    grown = registry.append_run(runs, spark.createDataFrame([("2024-02-01",)], "created_at string"))
    assert grown.agg(F.max("id")).first()[0] == 4


def test_fallback_order(spark):
    runs, _, _ = run_tables(spark)
    readable = spark.createDataFrame([("d1", 1), ("d9", 2)], "output_dir string, modified_at int")
    assert tuple(registry.run_fallback(runs, readable).first()) == ("d9", "filesystem")
    assert tuple(registry.run_fallback(runs.where("id < 2"), readable).first()) == ("d1", "registry")
    assert registry.run_fallback(runs, readable.limit(0)).collect() == []
