"""Exchange-rate tables: currency code and EUR value of one unit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

# EUR per unit, used where no current rate is known.
STATIC_RATES = {"EUR": 1.0, "USD": 0.8779, "GBP": 1.1870, "JPY": 0.006076, "CHF": 1.0660}
# Fixed value: a fetched table is good for 24 hours.
RATE_TTL_SECONDS = 24 * 3600

RATE_SCHEMA = T.StructType(
    [T.StructField("currency", T.StringType()), T.StructField("rate", T.DoubleType())]
)


def static_rates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(STATIC_RATES.items()), RATE_SCHEMA)


def invert_units(units: DataFrame) -> DataFrame:
    """Units per EUR to EUR per unit; zero or missing units fall back to the static rate, then 1."""
    fallback = static_rates(units.sparkSession).withColumnRenamed("rate", "__static")
    rate = F.when(F.col("units") != 0, F.lit(1.0) / F.col("units"))
    return units.join(F.broadcast(fallback), "currency", "left").select(
        "currency",
        F.when(F.col("currency") == "EUR", F.lit(1.0))
        .otherwise(F.coalesce(rate, F.col("__static"), F.lit(1.0)))
        .alias("rate"),
        *[c for c in units.columns if c not in ("currency", "units")],
    )


def rate_table(cached: DataFrame, as_of: str, ttl_seconds: int = RATE_TTL_SECONDS) -> DataFrame:
    """Cached rates (currency, units, fetched_at) younger than the limit.

    Currencies without a fresh rate come from the static table; ``source`` says
    which one a rate is from. Codes are three letters, so the result is bounded
    by the number of such codes and safe to broadcast.
    """
    age = F.unix_seconds(F.lit(as_of).cast("timestamp")) - F.unix_seconds(F.col("fetched_at").cast("timestamp"))
    fresh = (
        cached.where(F.col("currency").rlike("^[A-Z]{3}$") & (age >= 0) & (age < ttl_seconds))
        .groupBy("currency")
        .agg(F.max_by("units", "fetched_at").alias("units"))
    )
    current = invert_units(fresh).withColumn("source", F.lit("cache"))
    euro = static_rates(cached.sparkSession).withColumn("source", F.lit("static"))
    return current.unionByName(euro.join(current, "currency", "left_anti"))


def bounded_rates(rates: DataFrame) -> DataFrame:
    """One rate per three-letter code, broadcastable whatever the input holds."""
    return (
        rates.where(F.col("currency").rlike("^[A-Z]{3}$"))
        .groupBy("currency")
        .agg(F.max("rate").alias("rate"))
    )
