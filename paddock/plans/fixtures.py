"""Listing tables derived from the driver tables (see FIXTURES.md).

Every order is one listing. The order with the number of a document carries that
document's whole text as its description, so all orders and all texts take part
and no text is read twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T


SHOP_PREFIX = "https://listings.example/en/shop/"

# Model names, at least one per category rule, plus overlaps.
MODELS = (
    "Singer 911", "Carrera GT", "911 GT2 RS", "911 RSR", "911 Sport Classic", "911 GT3 RS",
    "911 Dakar", "964 Carrera RS", "Cayman GT4 RS", "911 GT3", "Cayman GT4", "911 GT3 RSX",
    "911 Speedster", "911 Backdate", "911 Turbo S", "930 Turbo", "911 Carrera GTS", "911 SC",
    "911 Carrera 3.2", "Boxster Cabriolet", "Cayman Coupe", "911 Targa", "991 CLUB COUPÉ", "Taycan",
)

# Phrases aimed at the 43 flags, then guarded or negated phrases
# that must not set a flag, then their genuine counterparts.
PHRASES = (
    "nut and bolt restoration", "cosmetic refresh", "custom interior", "full service history",
    "matching numbers", "showroom condition", "race-ready with racing harness", "1 of 25",
    "Porsche 911 RSR-ST", "accident-free", "KW suspension", "single owner",
    "one of 30 produced", "Nürburgring 24 hour", "built by Tuthill", "special commission",
    "zero running hours", "gearbox fully overhauled", "unrestored", "needs engine rebuild",
    "rolling shell", "missing engine", "project car", "no TÜV",
    "accident damage", "cup car", "Dakar", "weissach package",
    "PCCB", "ceramic brakes", "bucket seats", "clubsport package",
    "front axle lift", "sport chrono", "6-speed manual", "paint to sample",
    "Manthey", "RUF", "TechArt", "carbon package",
    "lightweight package", "full leather interior", "carbon fibre bucket seats", "speedster style",
    "replica dakar", "rare clone", "limited edition replica", "replica RSR ST",
    "missing engine cover", "requires no work", "no known accident damage", "heritage design replica",
    "manual steering wheel", "heritage design", "sport classic", "special edition",
)

# Column expressions valid in Spark SQL and DuckDB alike; k is the order key.
LISTING_COLUMNS = {
    "ingest_order": "k",
    "URL": "'https://listings.example/en/' || case when k % 97 = 0 then 'shop/' else 'car/' end"
    " || cast(case when k % 50 = 49 then k - 1 else k end as string)",
    "Title": "'Porsche ' || model",
    "Model": "case when k % 53 = 0 then cast(null as string) else model end",
    "Series": "case k % 5 when 0 then '982 (718 Boxster/Cayman)' when 1 then '987 (Boxster/Cayman)'"
    " when 2 then '981 (Boxster/Cayman)' when 3 then '992' else '964' end",
    "Price": "case when k % 29 = 0 then 'Price on request' else"
    " (case k % 6 when 0 then 'EUR' when 1 then 'USD' when 2 then 'GBP' when 3 then 'CHF'"
    " when 4 then 'JPY' else 'SEK' end)"
    " || ' ' || cast(cast(floor(o_totalprice / 1000) as bigint) as string)"
    " || ',' || lpad(cast(cast(floor(o_totalprice) as bigint) % 1000 as string), 3, '0') end",
    "Mileage": "case when k % 31 = 0 then cast(null as string) when k % 37 = 0 then 'about 30k' else"
    " cast(cast(floor(((k * 7919) % 250000) / 1000) as bigint) as string) || ',' ||"
    " lpad(cast((k * 7919) % 1000 as string), 3, '0') || case when k % 4 = 0 then ' mi' else ' km' end end",
    "Condition": "case when k % 11 = 0 then 'Fully restored' when k % 13 = 0 then cast(null as string)"
    " when k % 17 = 0 then '  ' else 'Used' end",
    "Paint-to-Sample (PTS)": "case when k % 19 = 0 then ' Yes' else 'No' end",
    "Matching numbers": "case k % 4 when 0 then 'Yes' when 1 then cast(null as string)"
    " when 2 then 'matching numbers' else 'No' end",
    "Number of vehicle owners": "case when k % 4 = 0 then cast(null as string) else cast(k % 4 as string) end",
    "Interior color": "case when k % 3 = 0 then cast(null as string) else 'Black' end",
    "Exterior color": "case when k % 7 = 0 then cast(null as string) else 'Silver' end",
    "Ready to drive": "case k % 3 when 0 then 'Yes' when 1 then 'no' else '' end",
    "Drive": "case k % 3 when 0 then 'Rear drive' when 1 then 'All wheel drive' else 'RWD' end",
    "Transmission": "case when k % 2 = 0 then 'Manual' else 'Automatic' end",
    "Car location": "case k % 8 when 0 then 'Germany' when 1 then 'France' else 'USA' end",
    "Year of construction": "cast(1965 + k % 60 as string)",
    "Description": "phrase || '. ' || coalesce(text, '')",
    "Scraped_At": "case when k % 41 = 0 then cast(null as timestamp) else o_orderdate end",
}

# Example rates, units of EUR per unit; SEK is left out on purpose.
EXAMPLE_RATES = {"EUR": 1.0, "USD": 0.9, "GBP": 1.2, "CHF": 1.05, "JPY": 0.006}

# Error spread per fixture model.
PREDICTION_MODELS = {"median": 17, "ridge": 31, "catboost": 53}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def _listing_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    k = F.col("o_orderkey")
    return orders.join(documents, k == F.col("doc_id"), "left").select(
        k.alias("k"),
        "o_totalprice",
        "o_orderdate",
        "o_orderstatus",
        "o_orderpriority",
        "text",
        F.element_at(F.array(*map(F.lit, MODELS)), (k % len(MODELS) + 1).cast("int")).alias("model"),
        F.element_at(F.array(*map(F.lit, PHRASES)), (k % len(PHRASES) + 1).cast("int")).alias("phrase"),
    )


def listings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze listings."""
    base = _listing_base(spark, sf_dir)
    return base.select(*[F.expr(e).alias(c) for c, e in LISTING_COLUMNS.items()]).withColumn(
        "Scraped_At", F.col("Scraped_At").cast("timestamp")
    )


def listings_prev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored table before a crawl: all but the listings still to come."""
    base = _listing_base(spark, sf_dir).where("o_orderpriority <> '1-URGENT'")
    return base.select(*[F.expr(e).alias(c) for c, e in LISTING_COLUMNS.items()]).withColumn(
        "Scraped_At", F.col("Scraped_At").cast("timestamp")
    )


def listings_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later crawl: listings still online, some changed, some failed."""
    base = _listing_base(spark, sf_dir).where("o_orderstatus <> 'F'")
    changed = {
        **LISTING_COLUMNS,
        "Price": f"case when k % 9 = 0 then 'Reserved' else {LISTING_COLUMNS['Price']} end",
        "Description": f"case when k % 4 = 0 then 'Updated ' else '' end || {LISTING_COLUMNS['Description']}",
        "Year of construction": "case when k % 23 = 0 then 'unknown' else"
        f" {LISTING_COLUMNS['Year of construction']} end",
        "Error": "case when k % 83 = 0 then 'Status 500' end",
        "Extra": "o_orderpriority",
    }
    return base.select(*[F.expr(e).alias(c) for c, e in changed.items()]).withColumn(
        "Scraped_At", F.col("Scraped_At").cast("timestamp")
    )


def fx_rates(spark: SparkSession) -> DataFrame:
    schema = T.StructType(
        [T.StructField("currency", T.StringType()), T.StructField("rate", T.DoubleType())]
    )
    return spark.createDataFrame(list(EXAMPLE_RATES.items()), schema)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One prediction per order and model, with interval bounds and segments."""
    models = F.array(
        *[F.struct(F.lit(m).alias("model_name"), F.lit(c).alias("c")) for m, c in PREDICTION_MODELS.items()]
    )
    k = F.col("o_orderkey")
    return (
        table(spark, sf_dir, "orders")
        .withColumn("m", F.explode(models))
        .select(
            k.alias("listing_key"),
            F.col("m.model_name").alias("model_name"),
            F.when(k % 500 == 0, F.lit(0.0)).otherwise(F.col("o_totalprice")).alias("actual_price_eur"),
            (F.col("o_totalprice") * (F.lit(0.85) + F.lit(0.3) * ((k * F.col("m.c")) % 101) / F.lit(100.0))).alias(
                "predicted_price_eur"
            ),
            "o_orderstatus",
            "o_orderpriority",
            "o_orderdate",
        )
        .withColumn("pred_lower", F.col("predicted_price_eur") * 0.9)
        .withColumn("pred_upper", F.col("predicted_price_eur") * 1.1)
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run registry: one run per order."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("created_at"),
        F.col("o_custkey").alias("random_state"),
        F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("runs/"), F.col("o_orderkey").cast("string"))).alias(
            "output_dir"
        ),
        (F.col("o_totalprice") / 1000).alias("duration_sec"),
        F.col("o_orderpriority").alias("git_commit"),
    )


def model_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics offered for storing: one row per order line, duplicates included."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("run_id"),
        F.concat(F.lit("m"), F.col("l_linenumber").cast("string")).alias("model_name"),
        F.round(F.col("l_extendedprice") / 1000, 0).alias("mae_eur"),
        F.round(F.col("l_extendedprice") / 2000, 0).alias("median_ae"),
        F.col("l_discount").alias("mape"),
        F.col("l_tax").alias("within_10"),
        (F.col("l_tax") * 2).alias("within_15"),
        (F.col("l_partkey") * 1000000 + F.col("l_suppkey")).alias("insert_order"),
    )


def skipped_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Skips offered for storing: one row per event of a user (a run)."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"),
        F.col("event_type").alias("model_name"),
        F.concat(F.lit("skip "), F.col("event_type")).alias("reason"),
        F.col("event_id").alias("insert_order"),
    )
