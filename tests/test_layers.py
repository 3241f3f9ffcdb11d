import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paddock.functions.numeric import sanitize_nonfinite
from paddock.operators import combine, dashboard, features, gold, hygiene, quality, silver, upsert
from paddock.sources import pages, rates, tables

BRONZE = (
    "ingest_order long, URL string, Title string, Model string, Series string, Price string, Mileage string, "
    "Condition string, `Paint-to-Sample (PTS)` string, `Matching numbers` string, `Number of vehicle owners` string"
)


def bronze(spark, rows):
    return spark.createDataFrame(rows, BRONZE)


def test_silver_job(spark):
    rows = [
        (1, "u/a", "t", "911", "982 (718 Boxster/Cayman)", "USD 10,000", "1,000 mi", "Used", " Yes", None, "2"),
        (2, "u/a", "later", "911", "964", "USD 1", "1 km", "Used", "No", "Yes", "1"),
        (3, "u/shop/x", "t", "911", "964", "EUR 5", "1 km", "Used", "No", "Yes", "1"),
        (4, "u/b", "t", "911", "964", "XYZ 7", None, "FULLY restored", "No", "Yes", None),
        (5, "u/c", "t", "911", "964", "EUR 5", "unknown", "Used", "No", "Yes", " "),
        (6, None, "t", "911", "964", "on request", "5 km", "  ", "No", "Yes", "1"),
        (7, None, "t", "911", "964", "on request", "6 km", "Used", "No", "Yes", "1"),
        (8, "u/d", "t", "911", "964", "EUR 1.234,56", ", km", "Used", "No", "Yes", "1"),
    ]
    table = spark.createDataFrame([("USD", 0.5)], rates.RATE_SCHEMA)
    out = {r["ingest_order"]: r for r in silver.bronze_to_silver(bronze(spark, rows), table, "u/shop/").collect()}
    assert set(out) == {1, 4, 6}
    assert out[1]["price_in_eur"] == 5000.0 and out[1]["Mileage_km"] == pytest.approx(1609.34)
    assert out[1]["Series"] == "982" and out[1]["Paint-to-Sample (PTS)"] == 1 and out[1]["Matching numbers"] == "Unknown"
    assert out[4]["Mileage_km"] == 1.0 and out[4]["is_fully_restored"] == 1 and out[4]["owners_known"] == 0
    assert out[4]["price_in_eur"] == 7.0 and out[4]["currency_known"] == 0
    assert out[6]["price_in_eur"] is None and out[6]["Condition"] == "Unknown"


def test_price_is_permissive_and_existing_price_is_coerced(spark):
    df = spark.createDataFrame([("EUR 1.234,56",), ("EUR ,",), ("eur 5",)], "Price string")
    assert [r["price"] for r in silver.parse_price(df).collect()] == [1.23456, None, None]
    df = spark.createDataFrame([("12", "usd"), ("12d", "eur"), ("x", None)], "price string, currency string")
    assert [tuple(r) for r in silver.parse_price(df).collect()] == [(12.0, "USD"), (None, "EUR"), (None, None)]


def test_a_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(10000).select(
        F.col("id").alias("ingest_order"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("URL")
    )
    out = silver.dedupe_url(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2 and plan.index("Final") < plan.index("hashpartitioning") < plan.rindex("Partial")
    assert out.where("URL = 'hot'").first()["ingest_order"] == 0 and out.count() == 6667


def test_outliers_keep_bounds_and_short_tables(spark):
    values = [(float(v),) for v in (1, 2, 3, 4, 100)]
    df = spark.createDataFrame(values, "v double")
    kept = [r["v"] for r in gold.remove_outliers(df, "v", 1.0).collect()]
    x = np.array([v for (v,) in values])
    assert kept == [v for v in x if abs(v - x.mean()) <= x.std(ddof=1)]
    one = spark.createDataFrame([(-5.0,)], "v double")
    assert gold.remove_outliers(one, "v", 3.0, use_log=True).count() == 1


def test_inflation_is_relative_to_the_newest_scrape(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2023-01-01",), ("no date",), (None,)], "Scraped_At string")
    out = [r["price_inflation_factor"] for r in gold.price_inflation(df).collect()]
    assert out[0] == 1.0 and out[1] == pytest.approx(1.02 ** (365 / 365.25)) and out[2:] == [1.0, 1.0]


def test_score_of_an_empty_listing_and_points(spark):
    df = spark.createDataFrame(
        [("Yes", "2", "Black", None, 1, 1, 10.0), (None, "Unknown", None, None, 0, 0, None)],
        "`Matching numbers` string, `Number of vehicle owners` string, `Interior color` string, `Exterior color` string,"
        " `Paint-to-Sample (PTS)` int, is_fully_restored int, Mileage_km double",
    )
    assert [r["listing_score"] for r in gold.listing_score(df).collect()] == [70.0, 0.0]


def test_interactions_with_missing_mileage(spark):
    df = spark.createDataFrame([("Taycan", None), ("911 GT3", 9.0)], "Model string, Mileage_km double")
    a, b = gold.model_interactions(df).collect()
    assert a["model_cat_ordered"] == 11 and a["inv_mileage"] is None and a["Mileage_model_cat"] is None
    assert b["model_cat_ordered"] == 4 and b["inv_mileage"] == 0.1 and b["Mileage_sq_model_cat"] == 324.0


def test_combine_prefers_the_fuller_then_newer_then_earlier_row(spark):
    schema = "ingest_order long, URL string, Title string, Scraped_At string"
    old = spark.createDataFrame([(1, " a ", "old", "2024-01-02"), (2, "b", None, "2024-01-01"), (3, "", "x", None)], schema)
    new = spark.createDataFrame([(1, "a", "new", "2024-01-01"), (2, "b", "full", "2023-01-01"), (3, "c", "c", None)], schema)
    out = {r["URL"]: r["Title"] for r in combine.combine_gold(old, new.withColumn("Extra", F.lit(None).cast("string"))).collect()}
    assert out == {"a": "old", "b": "full", "c": "c"}
    with pytest.raises(ValueError):
        combine.normalize_keys(old.drop("URL"))


def crawl(spark, rows):
    return spark.createDataFrame(rows, "ingest_order long, URL string, Title string, Price string, Mileage string, Description string, Error string")


def test_upsert_actions(spark):
    old = crawl(spark, [
        (1, "same", "t", "EUR 1", "1 km", "d", None), (2, "failed", "t", "EUR 1", "1 km", "d", None),
        (3, "reserved", "t", "EUR 1", "1 km", "d", None), (4, "changed", "t", "EUR 1", "1 km", "d", None),
        (5, "gone", "t", "EUR 1", "1 km", "d", None), (6, "both", "t", "EUR 1", "1 km", "d", None),
    ]).withColumn("Kept", F.lit("k"))
    new = crawl(spark, [
        (1, "same", "t", "EUR 1", "1 km", "d", None), (2, "failed", "x", "EUR 9", "1 km", "d", "Status 500"),
        (3, "reserved", "t", " Reserved", "1 km", "d", None), (4, "changed", "t", "EUR 2", "1 km", "d", None),
        (7, "new", "t", "EUR 1", "1 km", "d", None), (6, "both", "t2", "Reserved", "1 km", "d", None),
    ])
    out = {r["URL"]: r for r in upsert.upsert_listings(old, new).collect()}
    actions = {u: r["action"] for u, r in out.items()}
    assert actions == {"same": "keep", "failed": "keep", "reserved": "keep", "changed": "replace", "gone": "keep",
                       "new": "insert", "both": "replace"}
    assert out["changed"]["Price"] == "EUR 2" and out["changed"]["Kept"] is None and out["same"]["Kept"] == "k"
    assert {r["URL"]: r["Kept"] for r in upsert.upsert_listings(old, new, fill_missing=True).collect()}["changed"] == "k"
    log = {r["URL"]: r["Changes"] for r in upsert.change_log(old, new, "now").collect()}
    assert log == {"changed": "Price: 'EUR 1' → 'EUR 2'", "both": "Title: 't' → 't2'; Price: 'EUR 1' → 'Reserved'"}


def test_typed_overwrite_keeps_what_does_not_fit(spark):
    new = spark.createDataFrame([("1999.0", "x"), ("n/a", None), (None, "2024-01-02")], "year string, at string")
    target = T.StructType([T.StructField("year", T.IntegerType()), T.StructField("at", T.TimestampType())])
    a, b, c = upsert.typed_overwrite(new, target).collect()
    assert a["year"] == 1999 and a["uncast_values"] == {"at": "x"}
    assert b["year"] is None and b["uncast_values"] == {"year": "n/a"}
    assert c["at"] == datetime.datetime(2024, 1, 2) and c["uncast_values"] == {}


def test_refresh_changes_only_fetched_values(spark):
    stored = spark.createDataFrame([("a", "old"), ("b", "old")], "URL string, Description string")
    fetched = spark.createDataFrame([(1, "a", "new"), (2, "b", None)], "ingest_order long, URL string, Description string")
    out = {r["URL"]: r["Description"] for r in upsert.refresh_columns(stored, fetched, ["Description"]).collect()}
    assert out == {"a": "new", "b": "old"}


def test_screening_reasons(spark):
    rows = [(1.0, "c", None, str(i), 1.0 if i else None) for i in range(6)]
    df = spark.createDataFrame(rows, "price_in_eur double, constant string, empty string, Model string, x double")
    out = {r["feature"]: r["reasons"] for r in quality.feature_screen(df, max_cardinality=3).collect()}
    assert out["constant"] == ["constant"] and out["empty"] == ["null_fraction_gt_0.4", "constant"]
    assert out["Model"] == ["cardinality_gt_3", "min_frequency_lt_2"] and out["x"] == ["constant"]
    assert out["price_in_eur"] == []
    with pytest.raises(ValueError):
        quality.feature_screen(df.drop("price_in_eur"))


def test_dummies_follow_the_training_levels(spark):
    train = spark.createDataFrame([("a", 1.0), ("b", 3.0), (None, None)], "c string, n double")
    test = spark.createDataFrame([("z", None), (None, 5.0)], "c string, n double")
    _, out = features.aligned_dummies(train, test, ["c"], ["n"], keys=())
    assert [r.asDict() for r in out.collect()] == [
        {"n": 2.0, "c_a": 0, "c_b": 0, "c_nan": 0}, {"n": 5.0, "c_a": 0, "c_b": 0, "c_nan": 1}
    ]


def test_nested_sanitising(spark):
    df = spark.createDataFrame(
        [([1.0, float("nan")], {"a": float("inf")}, (float("-inf"), "x"))],
        "a array<double>, m map<string, double>, s struct<v: double, t: string>",
    )
    row = sanitize_nonfinite(df).first()
    assert row["a"] == [1.0, None] and row["m"] == {"a": None} and row["s"]["v"] is None and row["s"]["t"] == "x"


def test_path_styles(spark):
    texts = ["c:\\users\\x", "D:\\a\\AppData\\Local\\Temp", "\\nas_x", "/USERS/a", "/home/b", "home/b", "C:/Users/x"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    found = {}
    for r in hygiene.path_leak_scan(df, "i", "t").collect():
        found.setdefault(r["i"], set()).add(r["finding"])
    assert found == {0: {"windows_user"}, 1: {"windows_temp"}, 2: {"network_share"}, 3: {"mac_user"}, 4: {"linux_home"}, 6: {"mac_user"}}


def test_page_specs_and_hidden_paragraphs(spark):
    html = """<h1 class='t'> Carrera <b>RS</b> &amp; more</h1><script>'<p>no</p>'</script><p class="x small">s</p>
    <p>One</p><p>Two</p><ul><li>a</li><li>b</li></ul><table class="fahrzeugdaten"><tr><td class="label">Mileage:</td>
    <td class="content">5 km</td></tr><tr><td class="label">Mileage:</td><td class="content">6 km</td></tr></table>
    <div class="sidebar-section"><div class="price"><span class="p">EUR 5</span></div></div>"""
    row = pages.extract_listings(spark.createDataFrame([(html,)], "html string")).first()
    assert row["Title"] == "Carrera RS & more" and row["Description"] == "One\nTwo" and row["items"] == ["a", "b"]
    assert row["specs"] == {"Mileage": "6 km"} and row["Price"] == "EUR 5"


def test_dashboard_filter_and_missing_columns(spark):
    df = spark.createDataFrame([(1, "a", "Boxster", 5.0), (2, "a", "dup", 6.0)], "ingest_order long, URL string, Title string, price_in_eur double")
    table = dashboard.dash_frame(df)
    assert table.count() == 1 and table.first()["scraped"] is None and table.first()["year"] is None
    assert dashboard.dash_filter(table, search="BOX").count() == 1 and dashboard.dash_filter(table, ranges={"price_in_eur": (6, 7)}).count() == 0


def test_rates_expire_and_fall_back(spark):
    cached = spark.createDataFrame(
        [("USD", 2.0, "2024-01-01 00:00:01"), ("GBP", 4.0, "2023-12-31 00:00:00"), ("EUR", 9.0, "2024-01-01 12:00:00"), ("JPY", 0.0, "2024-01-01 12:00:00")],
        "currency string, units double, fetched_at string",
    )
    out = {r["currency"]: (r["rate"], r["source"]) for r in rates.rate_table(cached, "2024-01-02 00:00:00").collect()}
    assert out["USD"] == (0.5, "cache") and out["GBP"] == (1.187, "static") and out["EUR"] == (1.0, "cache")
    assert out["JPY"] == (0.006076, "cache") and out["CHF"][1] == "static"


def test_files_snapshots_and_newest_run(spark, tmp_path):
    df = spark.createDataFrame([(1, ' a "quoted"\nline ', 1.5), (2, None, None)], "i int, t string, v double")
    for suffix in ("csv", "parquet", "json"):
        path = tables.save_table(df, str(tmp_path / f"x.{suffix}"))
        back = tables.load_table(spark, path, schema=df.schema, multi_line=True)
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect())), suffix
    with pytest.raises(ValueError):
        tables.load_table(spark, "x.xlsx")
    folder = str(tmp_path / "snapshots")
    for stamp in ("20240101", "20240102", "20240102"):
        tables.write_snapshot(df, folder, stamp)
    snapshots = spark.read.option("basePath", folder).parquet(folder)
    assert snapshots.count() == 4 and tables.latest_snapshot(snapshots).count() == 2
    for name in ("r1", "r2"):
        tables.write_predictions(df.withColumn("row_index", F.col("i")), str(tmp_path / "runs" / name / "predictions.csv"))
    assert tables.newest_run(spark, str(tmp_path / "runs")).first()["run_dir"].endswith("/r2")


def test_views_are_partitioned_and_whole(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 2.0, 3.0, -1.0), (5.0, 2.0, 3.0, 1.0), (2.5, 2.0, 3.0, 0.0)],
                               "actual_price_eur double, pred_lower double, pred_upper double, residual_eur double")
    tables.write_views(df, str(tmp_path / "v"))
    counts = {r["view"]: r["count"] for r in spark.read.parquet(str(tmp_path / "v")).groupBy("view").count().collect()}
    assert counts == {"all_results": 3, "underpriced": 1, "overpriced": 1}
