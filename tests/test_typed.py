"""Typed tables, deviations per model, and the cells of the quantile histogram."""

import math

import pytest
from pyspark.sql import functions as F

from paddock.functions.stats import _cell, exact_quantiles
from paddock.models.frame import onehot_counts
from paddock.operators import evaluation, features, upsert
from paddock.plans import model_queries
from paddock.plans.queries import gold_table, plain_queries
from paddock.session import _local_folder

FOLDER = "/root/testdata/sf0.001"
CRAWLED = "ingest_order long, URL string, Title string, Price string, Mileage string, Description string, Secondary_Description string, Year string"


def stored(spark, rows):
    return spark.createDataFrame(rows, CRAWLED.replace("Year string", "Year int"))


def test_upsert_into_a_typed_table(spark):
    old = stored(spark, [(1, "a", "A", "1", "2", "d", "s", 1990), (2, "b", "B", "1", "2", "d", "s", 1991)])
    new = spark.createDataFrame([(3, "a", "A2", "1", "2", "d", "s", "unknown"), (4, "b", "B", "1", "2", "d", "s", "?"), (5, "c", "C", "1", "2", "d", "s", "1992.0")], CRAWLED)
    result = upsert.upsert_listings(old, new)
    assert dict(result.dtypes)["Year"] == "int"
    rows = {r["URL"]: (r["Year"], r["uncast_values"], r["action"]) for r in result.collect()}
    assert rows["a"] == (None, {"Year": "unknown"}, "replace")
    assert rows["b"] == (1991, None, "keep")
    assert rows["c"][0] == 1992 and not rows["c"][1] and rows["c"][2] == "insert"
    # a second crawl keeps what was kept as text, and hashes compare the scraped text
    again = upsert.upsert_listings(result.drop("action"), new)
    assert {r["URL"]: (r["uncast_values"], r["action"]) for r in again.collect()}["a"] == ({"Year": "unknown"}, "keep")


def test_deviations_are_taken_per_model(spark):
    rows = [(m, i, 100.0, 100.0 * (1 + e * (-1) ** i)) for m, e in (("close", 0.01), ("far", 0.5)) for i in range(40)]
    df = spark.createDataFrame(rows, "model_name string, listing_key long, actual_price_eur double, predicted_price_eur double")
    wide = evaluation.sigma_interval(df).withColumn("w", F.ln("pred_upper") - F.ln("pred_lower")).groupBy("model_name").agg(F.avg("w").alias("w"))
    width = {r["model_name"]: r["w"] for r in wide.collect()}
    assert width["far"] > 20 * width["close"]
    listings = spark.createDataFrame([(i,) for i in range(40)], "listing_key long")
    odd = df.withColumn("predicted_price_eur", F.when(F.expr("model_name = 'close' and listing_key = 0"), 110.0).otherwise(F.col("predicted_price_eur")))
    far = evaluation.residual_outliers(odd, listings, "listing_key").select("model_name", "listing_key").collect()
    assert [tuple(r) for r in far] == [("close", 0)]


VALUES = [0.0, -0.0, 5e-324, 1e-310, 2.0**-1000, 1e-9, 0.1, 0.5, 0.75, 1 - 2**-53, 1.0, 1 + 2**-52, 2.0, 3.0, 4.0, 1e15, 2.0**1023, math.inf]


def test_cells_follow_the_order_of_the_values(spark):
    values = sorted({v for x in VALUES for v in (x, -x)} | {2.0**k * (1 + j / 7) for k in range(-40, 60) for j in range(7)})
    cells = spark.createDataFrame([(v,) for v in values], "v double").select("v", _cell(F.col("v")).alias("c")).orderBy("v").collect()
    numbers = [r["c"] for r in cells]
    assert numbers == sorted(numbers)
    # powers of two begin cells of their own
    assert len(set(numbers)) > 0.9 * len(numbers)


@pytest.mark.parametrize("values", [[i / 997 for i in range(998)], [-(1.5 ** (i % 90)) for i in range(400)], [math.inf, -math.inf, 1.0, 2.0, 1e-300]])
def test_quantiles_of_any_magnitude(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    found = exact_quantiles(df, F.col("v"), {"q25": 0.25, "q50": 0.5}).first()
    ordered = sorted(values)
    for name, q in (("q25", 0.25), ("q50", 0.5)):
        at = q * (len(ordered) - 1)
        low, high = ordered[math.floor(at)], ordered[math.ceil(at)]
        expected = low if low == high else low + (high - low) * (at - math.floor(at))
        assert found[name] == pytest.approx(expected)


def test_small_numbers_spread_over_cells(spark):
    gold = gold_table(spark, FOLDER)
    cells = gold.select(_cell(F.col("inv_mileage").cast("double")).alias("c")).distinct().count()
    assert cells > 500


def test_linear_columns_are_what_is_left(spark):
    assert [c for c in features.NUMERIC_COLUMNS if c not in features.NOT_LINEAR] == [
        "Mileage_km", "Year of construction", "listing_score", "owners_known", "is_fully_restored",
        "Paint-to-Sample (PTS)", "log_mileage", "Mileage_sq", "price_inflation_factor",
    ]
    assert features.NOT_LINEAR <= set(features.NUMERIC_COLUMNS)


def test_clusters_must_name_a_shared_folder(spark, monkeypatch):
    assert _local_folder(spark, "x")
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        monkeypatch.setattr(spark.sparkContext, "master", master)
        with pytest.raises(ValueError):
            _local_folder(spark, "x")


def priced(spark):
    rows = [(f"u{i}", 1000.0 * (1 + i % 7)) for i in range(60)]
    return spark.createDataFrame(rows, "URL string, price_in_eur double")


@pytest.mark.parametrize(
    "prediction, usable, fits",
    [("price_in_eur * 1.01", 1, 1), ("price_in_eur * 3", 1, 0), ("4000D", 1, 0), ("double('nan')", 0, 0), ("-price_in_eur", 0, 0), ("cast(null as double)", 0, 0)],
)
def test_facts_of_a_fit_are_computed(spark, prediction, usable, fits):
    df = priced(spark)
    found = model_queries.predictions(lambda d: d.withColumn("predicted_price_eur", F.expr(prediction)), df, df).collect()
    assert {(r["usable"], r["fits_training"]) for r in found} == {(usable, fits)}


def scans(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0].count("FileScan parquet")


def test_reports_read_each_table_once(spark):
    """Orders and documents make up Bronze; Silver and the scored texts come from a narrow checkpoint."""
    registered = plain_queries()
    assert scans(registered["dq_report"](spark, FOLDER)) <= 2
    assert scans(registered["histogram"](spark, FOLDER)) == 0


def test_level_counts_equal_the_encoder(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), ("b", ""), (None, "x")], "c string, d string")
    found = {r["level"]: r["n"] for r in onehot_counts(df, ["c", "d"]).collect()}
    assert found == {"c=a": 2, "c=b": 1, "c=missing": 1, "d=x": 2, "d=missing": 1, "d=(empty)": 1}
