import re
import subprocess
import sys
import weakref

import numpy as np
import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from paddock.functions.stats import hash_bucket
from paddock.models import benchmark, frame, linear, moments, tfidf, trees, tuning
from paddock.operators.features import ColumnRoles
from paddock.operators.gold import TARGET
from paddock.plans import model_queries
from paddock.session import METHOD_LIMIT, compiled_methods

ROLES = ColumnRoles(TARGET, ("Mileage_km", "listing_score"), ("Series",), ())


@pytest.fixture(scope="module")
def listings(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(240):
        km, score, series = float(rng.uniform(0, 1e5)), float(rng.integers(0, 30)), "abc"[i % 3]
        price = float(np.exp(11 + score / 20 - km / 1e5 + 0.3 * (i % 3) + rng.normal(0, 0.1)))
        text = f"car {series} {'rare find' if i % 3 == 2 else 'daily driver'}"
        rows.append((f"u{i}", None if i % 40 == 0 else km, score, series, text, price))
    return spark.createDataFrame(rows, "URL string, Mileage_km double, listing_score double, Series string, listing_text string, price_in_eur double").coalesce(2).cache()


def design(rows):
    km = np.array([r["Mileage_km"] if r["Mileage_km"] is not None else np.nan for r in rows])
    km = np.where(np.isnan(km), np.nanmedian(km), km)
    score = np.array([r["listing_score"] for r in rows])
    numbers = np.column_stack([km, score])
    numbers = (numbers - numbers.mean(0)) / numbers.std(0)
    return np.column_stack([numbers, *[[r["Series"] == s for r in rows] for s in "abc"]]).astype(float)


def test_ridge_equals_the_closed_form(listings):
    rows = listings.orderBy("URL").collect()
    x, y = design(rows), np.log([r[TARGET] for r in rows])
    centred = x - x.mean(0)
    w = np.linalg.solve(centred.T @ centred + 3.0 * np.eye(x.shape[1]), centred.T @ (y - y.mean()))
    expected = np.exp((x - x.mean(0)) @ w + y.mean())
    got = linear.fit_ridge(listings, ROLES).predict(listings).orderBy("URL").collect()
    assert np.allclose([r["predicted_price_eur"] for r in got], expected, rtol=1e-8)


def test_elastic_net_meets_its_optimality_conditions(listings):
    alpha, ratio = 0.05, 0.6
    rows = listings.orderBy("URL").collect()
    x, y = design(rows), np.log([r[TARGET] for r in rows])
    model = linear.fit_elastic_net(listings, ROLES, alpha, ratio)
    w, b = model.coefficients, model.intercept
    slope = x.T @ (x @ w + b - y) / len(y) + alpha * (1 - ratio) * w
    for s, v in zip(slope, w):
        assert abs(s + alpha * ratio * np.sign(v)) < 1e-8 if v else abs(s) <= alpha * ratio + 1e-8


def test_unseen_and_missing_levels_encode_as_zeros(spark, listings):
    encoder = frame.fit_encoder(listings, ROLES)
    odd = spark.createDataFrame([("x", None, 1.0, "zzz"), ("y", 1.0, 1.0, None)], "URL string, Mileage_km double, listing_score double, Series string")
    for r in encoder.transform(odd).select("features").collect():
        assert r["features"].size == 5 and not r["features"].toArray()[2:].any()


def test_target_must_be_positive(listings):
    with pytest.raises(ValueError):
        linear.fit_ridge(listings.withColumn(TARGET, F.lit(0.0)), ROLES)
    with pytest.raises(ValueError):
        frame.fit_encoder(listings, ColumnRoles(TARGET, (), ()))


def test_text_weights_match_the_vectors(spark, listings):
    relational = tfidf.tfidf_weights(listings, "URL", "listing_text", min_df=1)
    by_key = {}
    for r in relational.collect():
        by_key.setdefault(r["URL"], {})[r["term"]] = r["weight"]
    model = tfidf.fit_tfidf(listings, "listing_text")
    for r in model.transform(listings, "listing_text", "s", "v").limit(20).collect():
        assert r["s"] == sorted(r["s"])
        mine = {model.terms[i]: w for i, w in zip(r["s"], r["v"])}
        assert mine == pytest.approx(by_key[r["URL"]])


def test_specialist_routes_and_falls_back(listings):
    model = linear.fit_specialist(listings, ROLES, high_price=120000.0)
    assert model.router is not None and model.specialist is not None
    prices = [r["predicted_price_eur"] for r in model.predict(listings).collect()]
    assert len(prices) == 240 and min(prices) > 0 and np.isfinite(prices).all()
    assert linear.fit_specialist(listings, ROLES, high_price=1.0).all_high
    assert linear.fit_specialist(listings, ROLES, high_price=1e12).router is None
    flat = linear.fit_specialist(listings, ColumnRoles(TARGET, (), (), ("listing_text",)))
    assert isinstance(flat.general, float)


def test_balanced_logistic_is_the_penalised_optimum(listings):
    encoder = frame.fit_encoder(listings, ROLES)
    data = encoder.transform(listings.withColumn("hi", (F.col(TARGET) >= 120000).cast("double")))
    model = linear.balanced_logistic(data, "hi")
    rows = data.select("features", "hi").collect()
    x, y = np.array([r["features"].toArray() for r in rows]), np.array([r["hi"] for r in rows])
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    w = model.coefficients.toArray()
    p = 1 / (1 + np.exp(-(x @ w + model.intercept)))
    assert np.abs(x.T @ (weight * (p - y)) + w).max() < 1e-2


def test_stacked_blend_is_the_geometric_mean(listings):
    roles = ColumnRoles(TARGET, ROLES.numeric, ROLES.categorical, ("listing_text",))
    model = linear.fit_stacked(listings, roles, folds=2)
    both = model.net.predict(model.ridge.predict(listings, "a"), "b")
    for r in model.predict(both).limit(30).collect():
        assert r["predicted_price_eur"] == pytest.approx(np.sqrt(r["a"] * r["b"]))
    assert len(model.meta) == 3


def test_trees_interval_and_importance(listings):
    train, test = frame.holdout(listings)
    rows = trees.quantile_interval(train, test, ROLES, rounds=3).collect()
    assert rows and all(0 < r["pred_lower"] <= r["pred_price"] <= r["pred_upper"] for r in rows)
    model = trees.fit_early_stopped(train, ROLES, rounds=4)
    importance = {r["feature"]: r["importance"] for r in trees.feature_importance(model).collect()}
    assert set(importance) == {"Mileage_km", "listing_score", "Series"} and sum(importance.values()) == pytest.approx(1.0)


def test_tuning_is_repeatable(listings):
    first = tuning.tune_elastic_net(listings, ROLES, trials=3)
    assert first == tuning.tune_elastic_net(listings, ROLES, trials=3)
    assert [t["mae_eur"] for t in first] == sorted(t["mae_eur"] for t in first)


def folded(listings, folds):
    rows = listings.withColumn("f", hash_bucket(F.col("URL"), 42, folds).cast("int")).orderBy("URL").collect()
    return design(rows), np.log([r[TARGET] for r in rows]), np.array([r["f"] for r in rows])


def test_cross_validated_ridge_equals_fits_without_the_fold(listings):
    x, y, fold = folded(listings, 3)
    for r in tuning.cv_ridge(listings, ROLES, alphas=(0.1, 10.0), folds=3):
        errors = []
        for f in range(3):
            a, b = x[fold != f], y[fold != f]
            c = a - a.mean(0)
            w = np.linalg.solve(c.T @ c + r["alpha"] * np.eye(x.shape[1]), c.T @ (b - b.mean()))
            errors.append(np.sqrt(np.mean((y[fold == f] - (x[fold == f] - a.mean(0)) @ w - b.mean()) ** 2)))
        assert (r["rmse_mean"], r["rmse_std"]) == pytest.approx((np.mean(errors), np.std(errors)), rel=1e-8)


def test_net_grid_meets_optimality_conditions_in_every_fold(listings):
    """All 40 penalties at three ratios: every slope condition to 1e-8, and the reported errors are those of the fits."""
    x, y, fold = folded(listings, 2)
    ratios = (0.1, 0.5, 0.9)
    rows = {(r["alpha"], r["l1_ratio"]): r for r in tuning.cv_elastic_net(listings, ROLES, ratios=ratios, folds=2)}
    assert len(rows) == 120 and sum(r["is_best"] for r in rows.values()) == 1
    errors = {}
    for f in range(2):
        a, b = x[fold != f], y[fold != f]
        full = np.column_stack([a, np.ones(len(a)), b])
        path = moments.NetPath(moments.Moments(full.T @ full))
        for ratio in ratios:
            for alpha in tuning.NET_ALPHAS[::-1]:
                w, c = path.fit(alpha, ratio)
                slope = a.T @ (a @ w + c - b) / len(b) + alpha * (1 - ratio) * w
                assert np.where(w != 0, np.abs(slope + alpha * ratio * np.sign(w)), np.maximum(np.abs(slope) - alpha * ratio, 0)).max() < 1e-8
                assert abs((a @ w + c - b).sum()) < 1e-8 * len(b)
                errors.setdefault((alpha, ratio), []).append(np.mean((x[fold == f] @ w + c - y[fold == f]) ** 2))
    for key, e in errors.items():
        assert rows[key]["mse_mean"] == pytest.approx(np.mean(e), rel=1e-7)
    assert rows[min(errors, key=lambda k: np.mean(errors[k]))]["is_best"]


def test_product_sums_do_not_depend_on_blocks_or_partitions(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(300):
        slots = np.sort(rng.choice(40, rng.integers(0, 12), replace=False))
        rows.append((i % 3, slots.tolist(), rng.normal(size=len(slots)).tolist(), float(rng.normal())))
    df = spark.createDataFrame(rows, f"{moments.FOLD} int, {moments.SLOTS} array<int>, {moments.VALUES} array<double>, y double")
    dense = np.zeros((300, 42))
    for i, (_, slots, values, y) in enumerate(rows):
        dense[i, slots], dense[i, 40:] = values, (1.0, y)
    whole = dense.T @ dense
    assert np.allclose(moments.moments(df, 40, "y")[0].sums, whole, atol=1e-10)
    monkeypatch.setattr(moments, "BLOCK_BYTES", 3 * 42 * 8 * 5)
    monkeypatch.setattr(moments, "PAIRS_AT_ONCE", 7)
    parts = moments.moments(df.repartition(5), 40, "y", folds=3)
    for f, part in enumerate(parts):
        own = dense[[i for i, r in enumerate(rows) if r[0] == f]]
        assert np.allclose(part.sums, own.T @ own, atol=1e-10)
    with pytest.raises(ValueError):
        moments.moments(df.limit(0), 40, "y")


@pytest.mark.parametrize("alpha", [10.0, 0.1, 1e-3, 1e-5])
@pytest.mark.parametrize("ratio", [0.0, 0.3, 0.9, 1.0])
def test_more_features_than_rows(alpha, ratio):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 150)) * (rng.random((60, 150)) < 0.3)
    y = x[:, :5].sum(axis=1) + rng.normal(size=60) * 0.1 + 10
    full = np.column_stack([x, np.ones(60), y])
    path = moments.NetPath(moments.Moments(full.T @ full))
    w, _ = path.fit(alpha, ratio)
    assert path.violation(w, alpha, ratio) < 1e-8


def test_meta_model_from_folds_left_out(listings):
    """The stacked meta model equals one from separate fits without each fold."""
    x, y, fold = folded(listings, 3)
    logs = np.empty((len(y), 2))
    for f in range(3):
        a, b = x[fold != f], y[fold != f]
        full = np.column_stack([a, np.ones(len(a)), b])
        m = moments.Moments(full.T @ full)
        for i, (w, c) in enumerate((moments.ridge(m, linear.RIDGE_ALPHA), moments.NetPath(m).fit(linear.NET_ALPHA, linear.NET_L1_RATIO))):
            logs[fold == f, i] = x[fold == f] @ w + c
    centred = logs - logs.mean(0)
    w = np.linalg.solve(centred.T @ centred + np.eye(2), centred.T @ (y - y.mean()))
    meta = linear.fit_stacked(listings, ROLES, folds=3).meta
    assert meta == pytest.approx((*w, y.mean() - logs.mean(0) @ w), rel=1e-6)


def test_run_writes_what_it_should_and_skips(spark, listings, tmp_path):
    out = str(tmp_path / "run")
    gold = listings.drop("listing_text")
    result = benchmark.run_benchmark(gold, out, models=("median", "ridge", "auto_ridge"))
    metrics = {r["model_name"]: r["mae_eur"] for r in result.metrics.collect()}
    assert set(metrics) == {"median", "ridge", "auto_ridge"} and metrics["ridge"] < metrics["median"]
    stored = spark.read.option("header", True).csv(f"{out}/predictions.csv")
    assert stored.columns == ["row_index", "model_name", "actual_price_eur", "predicted_price_eur", "residual_eur"]
    assert stored.count() == result.predictions.count()
    assert spark.read.json(f"{out}/metrics.json").count() == 3
    with pytest.raises(ValueError):
        benchmark.run_benchmark(gold, models=("nothing",))


def test_saved_model_predicts_the_same(spark, listings, tmp_path):
    roles = ColumnRoles(TARGET, ROLES.numeric, ROLES.categorical, ("listing_text",))
    model = linear.fit_ridge(listings, roles)
    benchmark.save_model(model, str(tmp_path / "m"))
    again = benchmark.load_model(spark, str(tmp_path / "m"))
    a = [r["predicted_price_eur"] for r in model.predict(listings).orderBy("URL").limit(20).collect()]
    assert a == [r["predicted_price_eur"] for r in again.predict(listings).orderBy("URL").limit(20).collect()]


def test_ablation_pairs(listings):
    gold = listings.withColumn("price_inflation_factor", F.lit(1.0)).drop("listing_text")
    rows = benchmark.ablation_scores(gold, seeds=(1, 2)).collect()
    assert len(rows) == 4 and {r["seed"] for r in rows} == {1, 2}


def test_text_length_is_computed_once_a_row(listings):
    """Not within the function that divides each term by it: that took time with the square of a row's terms."""
    model = tfidf.fit_tfidf(listings, "listing_text")
    plan = model.transform(listings, "listing_text", "s", "v").select("v")._jdf.queryExecution().optimizedPlan().toString()
    divisor = re.search(r"lambdafunction\(\(lambda \w+#\d+ / (\w+)", plan)
    assert divisor and divisor[1] == "lambda"  # of the function's own argument


def test_stacked_fit_holds_one_matrix_at_a_time(listings, monkeypatch):
    """The sums without a fold are those of the other folds, and no two folds' matrices are on the driver at once."""
    most, alive = [0], weakref.WeakSet()
    made = moments.WrittenSums.of

    class Held(np.ndarray):
        __hash__ = object.__hash__

    def counted(self, *folds):
        found = made(self, *folds).sums.view(Held)
        alive.add(found)
        most[0] = max(most[0], sum(a.base is not None and len(a) > 4 for a in alive))
        return moments.Moments(found)

    monkeypatch.setattr(moments.WrittenSums, "of", counted)
    roles = ColumnRoles(TARGET, ROLES.numeric, ROLES.categorical, ("listing_text",))
    linear.fit_stacked(listings, roles, folds=3)
    assert most[0] == 1
    monkeypatch.undo()
    rows = linear.encoded(frame.fit_encoder(listings, roles), listings, hash_bucket(F.col("URL"), 42, 3).cast("int").alias(moments.FOLD))
    size = frame.fit_encoder(listings, roles).size
    written, parts = moments.written_moments(rows, size, frame.LOG_TARGET, 3), moments.moments(rows, size, frame.LOG_TARGET, 3)
    assert np.allclose(written.without(1).sums, (parts[0] + parts[2]).sums) and np.allclose(written.total().sums, (parts[0] + parts[1] + parts[2]).sums)


def plain_weights(rows, max_terms=5000, min_df=1):
    """Weights by key of (key, text) rows, counted one by one."""
    counts = {}
    for key, text in rows:
        words = re.findall(r"\w{2,}", (text or "").lower())
        mine = counts.setdefault(key, {})
        for term in [*words, *map(" ".join, zip(words, words[1:]))]:
            mine[term] = mine.get(term, 0) + 1
    df, total = {}, {}
    for mine in counts.values():
        for term, n in mine.items():
            df[term], total[term] = df.get(term, 0) + 1, total.get(term, 0) + n
    kept = sorted((t for t in df if df[t] >= min_df), key=lambda t: (-total[t], t.encode()))[:max_terms]
    idf = {t: np.log((1 + len(rows)) / (1 + df[t])) + 1 for t in kept}
    out = {}
    for key, mine in counts.items():
        raw = {t: (1 + np.log(n)) * idf[t] for t, n in mine.items() if t in idf}
        out |= {(key, t): w / np.sqrt(sum(x * x for x in raw.values())) for t, w in raw.items()}
    return out


TEXTS = ["red car red car red", "a", None, "", "Über straße über straße 42", "car red. car, car", "blue car\nred x car"]


@pytest.mark.parametrize("keys", [range(7), [1, None, 1, None, 2, 3, 2], [None, 1, 2, 3, 4, 5, 6]])
@pytest.mark.parametrize(("max_terms", "min_df"), [(5000, 1), (4, 2), (3, 1)])
def test_text_weights_equal_plain_counts(spark, keys, max_terms, min_df):
    """Single keys, one of them missing, and keys that several rows share."""
    rows = list(zip(keys, TEXTS))
    got = tfidf.tfidf_weights(spark.createDataFrame(rows, "k int, t string"), "k", "t", max_terms, min_df).collect()
    expected = plain_weights(rows, max_terms, min_df)
    assert {(r["k"], r["term"]) for r in got} == set(expected) and len(got) == len(expected)
    assert all(abs(r["weight"] - expected[r["k"], r["term"]]) < 1e-12 for r in got)


def test_text_weights_of_single_keys_shuffle_no_counts(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "k int, t string")
    plan = tfidf.tfidf_weights(df, "k", "t", min_df=1)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_term_sums_do_not_depend_on_slices(monkeypatch):
    words = pa.array([re.findall(r"\w{2,}", t or "") for t in TEXTS * 3], pa.list_(pa.string()))

    def summed(column, at_once):
        monkeypatch.setattr(tfidf, "WORDS_AT_ONCE", at_once)
        out = {}
        for part in tfidf.term_sums()([pa.RecordBatch.from_arrays([column], ["words"])]):
            for r in part.to_pylist():
                old = out.get(r["term"], (0, 0))
                out[r["term"]] = (old[0] + r["df"], old[1] + r["total"])
        return out

    whole = summed(words, 1000)
    assert whole["red car"] == (9, 12) and whole["car car"] == (3, 3) and whole["red"] == (9, 15)
    assert summed(words, 1) == summed(words, 6) == whole
    assert summed(words.slice(7), 6) == {t: (d * 2 // 3, n * 2 // 3) for t, (d, n) in whole.items()}


def test_functions_for_tasks_need_no_package(tmp_path):
    """Executors may not have this package: what is sent to them loads and runs without it."""
    run = (
        "import pickle, sys, pyarrow as pa; sums, weighted = pickle.load(sys.stdin.buffer); words = pa.array([['ab', 'cd'], []])\n"
        "print(next(sums([pa.RecordBatch.from_arrays([words], ['w'])])).num_rows, len(weighted(words)), 'paddock' in sys.modules)"
    )
    sent = cloudpickle.dumps((tfidf.term_sums(), tfidf.TfidfModel(["ab cd", "cd"], [1.0, 1.0]).weighing()))
    done = subprocess.run([sys.executable, "-c", run], input=sent, capture_output=True, cwd=tmp_path, env={"PATH": ""}, timeout=60)
    assert done.stdout.split() == [b"3", b"2", b"False"], done.stderr.decode()[-500:]


def test_the_frame_is_written_with_compiled_methods(spark, monkeypatch):
    """Methods beyond what the JVM compiles were interpreted; the session's limit comes back, after an error as well."""
    before, seen = spark.conf.get(METHOD_LIMIT), []
    monkeypatch.setattr(model_queries, "cut_lineage", lambda df: seen.append(spark.conf.get(METHOD_LIMIT)) or df)
    model_queries.prepared(spark, "/root/testdata/sf0.001")
    assert seen == ["8000"] and spark.conf.get(METHOD_LIMIT) == before
    with pytest.raises(KeyError), compiled_methods(spark):
        raise KeyError
    assert spark.conf.get(METHOD_LIMIT) == before
