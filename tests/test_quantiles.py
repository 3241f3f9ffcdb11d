import numpy as np
import pytest
from pyspark.sql import functions as F

from paddock.functions.stats import exact_quantiles, hash_bucket, one_row


def test_equals_numpy_with_a_hot_group_and_null_group(spark):
    rng = np.random.default_rng(3)
    data = [("hot", float(v)) for v in rng.normal(1e5, 1e4, 3000)]
    data += [(None, float(v)) for v in rng.exponential(2.0, 501)] + [("x", -1.5), ("x", 4.0), ("y", 7.0), ("y", None)]
    df = spark.createDataFrame(data, "g string, v double")
    got = {r["g"]: r for r in exact_quantiles(df, F.col("v"), {"a": 0.1, "m": 0.5, "z": 0.99}, ["g"]).collect()}
    for g in ("hot", None, "x", "y"):
        values = [v for k, v in data if k == g and v is not None]
        for name, q in (("a", 0.1), ("m", 0.5), ("z", 0.99)):
            assert got[g][name] == pytest.approx(np.quantile(values, q), rel=1e-12), (g, name)


def test_one_value_repeated_and_infinity(spark):
    df = spark.createDataFrame([(5.0,)] * 999 + [(float("inf"),)] * 1000, "v double")
    row = exact_quantiles(df, F.col("v"), {"lo": 0.2, "m": 0.5}).first()
    assert row["lo"] == 5.0 and row["m"] == float("inf")


def test_empty_input_has_no_quantile(spark):
    empty = spark.createDataFrame([], "g string, v double")
    assert exact_quantiles(empty, F.col("v"), {"m": 0.5}, ["g"]).collect() == []
    assert exact_quantiles(empty, F.col("v"), {"m": 0.5}).first()["m"] is None


def test_scalar_statistics_need_no_join(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "v double")
    stats = one_row(df, mean=F.avg("v"))
    out = df.withColumn("d", F.col("v") - stats["mean"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Cartesian" not in plan
    assert sorted(r["d"] for r in out.collect()) == [-1.0, 1.0]


def test_buckets_do_not_depend_on_partitioning(spark):
    df = spark.range(500).withColumn("b", hash_bucket(F.col("id").cast("string"), 42, 4))
    one = {r["id"]: r["b"] for r in df.repartition(1).collect()}
    many = {r["id"]: r["b"] for r in df.repartition(16).collect()}
    assert one == many and set(one.values()) == {0, 1, 2, 3}
