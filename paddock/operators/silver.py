"""Bronze to Silver: parsing, de-duplication, cleaning, conversion to EUR."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from paddock.functions.numeric import number, to_double
from paddock.functions.ranking import first_per_key
from paddock.functions.text import blank_to, trimmed
from paddock.sources.rates import bounded_rates, static_rates

# Formats, conversion factor and series names.
PRICE_PATTERN = r"(?U)([A-Z]{3})\s*([\d.,]+)"
MILEAGE_PATTERN = r"(?U)([\d,]+)\s*(km|mi)"
KM_PER_MILE = 1.60934
SERIES_NAMES = {
    "982 (718 Boxster/Cayman)": "982",
    "987 (Boxster/Cayman)": "987",
    "981 (Boxster/Cayman)": "981",
}
UNUSED_COLUMN = "License documents (Click to open)"
RESTORED = "fully restored"


def _part(column: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(column, pattern, group), F.lit(""))


def _amount(text: Column) -> Column:
    return to_double(F.replace(text, F.lit(","), F.lit("")))


def parse_price(df: DataFrame) -> DataFrame:
    """``price`` and ``currency`` out of ``Price``; an existing ``price`` is only made numeric."""
    if "price" in df.columns:
        df = df.withColumn("price", number(df, "price"))
    elif "Price" in df.columns:
        df = df.select(
            "*",
            _amount(_part(F.col("Price"), PRICE_PATTERN, 2)).alias("__price"),
            _part(F.col("Price"), PRICE_PATTERN, 1).alias("__currency"),
        )
        # "Price" and "price" are one name to a case-insensitive session
        kept = [c for c in df.columns if c not in ("__price", "__currency", "currency")]
        df = df.select(
            *[F.col(f"`{c}`").alias("price_text" if c == "Price" else c) for c in kept],
            F.col("__price").alias("price"),
            F.col("__currency").alias("currency"),
        )
    if "currency" in df.columns:
        df = df.withColumn("currency", F.upper("currency"))
    return df


def dedupe_url(df: DataFrame, order: str = "ingest_order", key: str = "URL") -> DataFrame:
    """First row per URL in ingest order."""
    return first_per_key(df, [key], [F.col(order).asc()])


def drop_column(df: DataFrame, name: str = UNUSED_COLUMN) -> DataFrame:
    return df.drop(name)


def drop_shop_links(df: DataFrame, prefix: str, key: str = "URL") -> DataFrame:
    """Rows whose URL holds the shop prefix go; a missing URL stays."""
    if key not in df.columns:
        return df
    return df.where(~F.coalesce(F.col(key).contains(prefix), F.lit(False)))


def mileage_extract(df: DataFrame) -> DataFrame:
    return df.select(
        "*",
        _part(F.col("Mileage"), MILEAGE_PATTERN, 1).alias("mileage_value"),
        _part(F.col("Mileage"), MILEAGE_PATTERN, 2).alias("mileage_unit"),
    )


def is_restored(condition: Column) -> Column:
    return F.coalesce(F.contains(F.lower(condition), F.lit(RESTORED)), F.lit(False))


def mileage_impute(df: DataFrame) -> DataFrame:
    """Restored cars without mileage count 1; other rows without mileage go."""
    value = F.when(
        F.col("mileage_value").isNull() & is_restored(F.col("Condition")), F.lit("1")
    ).otherwise(F.col("mileage_value"))
    return df.withColumn("mileage_value", value).where(F.col("mileage_value").isNotNull())


def mileage_km(df: DataFrame) -> DataFrame:
    """Numeric mileage in km; a missing unit means km. Text without digits goes."""
    unit = F.coalesce(F.nullif(F.col("mileage_unit"), F.lit("")), F.lit("km"))
    value = _amount(F.col("mileage_value"))
    return (
        df.withColumns({"mileage_unit": unit, "mileage_value": value})
        .where(F.col("mileage_value").isNotNull())
        .withColumn(
            "mileage_value",
            F.when(F.col("mileage_unit") == "mi", F.col("mileage_value") * KM_PER_MILE).otherwise(
                F.col("mileage_value")
            ),
        )
        .withColumn("Mileage_km", F.col("mileage_value"))
    )


def clean_mileage(df: DataFrame) -> DataFrame:
    return mileage_km(mileage_impute(mileage_extract(df)))


def clean_condition(df: DataFrame) -> DataFrame:
    pts = F.lower(trimmed(F.col("Paint-to-Sample (PTS)").cast("string"))) == "yes"
    return df.withColumns(
        {
            "Condition": blank_to(F.col("Condition"), "Unknown"),
            "Paint-to-Sample (PTS)": F.coalesce(pts, F.lit(False)).cast("int"),
            "Matching numbers": blank_to(F.col("Matching numbers"), "Unknown"),
            "Number of vehicle owners": blank_to(F.col("Number of vehicle owners").cast("string"), "Unknown"),
        }
    )


def derived_flags(df: DataFrame) -> DataFrame:
    unknown = F.lower(trimmed(F.col("Number of vehicle owners"))) == "unknown"
    return df.withColumns(
        {
            "owners_known": (~F.coalesce(unknown, F.lit(False))).cast("int"),
            "is_fully_restored": is_restored(F.col("Condition")).cast("int"),
        }
    )


def standardize_series(df: DataFrame) -> DataFrame:
    return df.replace(SERIES_NAMES, subset=["Series"])


def price_in_eur(df: DataFrame, rates: DataFrame) -> DataFrame:
    """EUR price from the given rate, else the static rate, else 1:1.

    ``currency_known`` is 0 where that last resort was used. Without price or
    currency columns the table is returned as it is.
    """
    if not {"price", "currency"} <= set(df.columns):
        return df
    static = static_rates(df.sparkSession).withColumnRenamed("rate", "__static")
    table = (
        bounded_rates(rates)
        .join(static, "currency", "full")
        .select("currency", F.coalesce("rate", "__static").alias("__rate"))
    )
    is_eur = F.col("currency") == "EUR"
    amount = F.when(is_eur, F.col("price")).otherwise(
        F.col("price") * F.coalesce(F.col("__rate"), F.lit(1.0))
    )
    return (
        df.join(F.broadcast(table), "currency", "left")
        .withColumn("price_in_eur", F.when(F.col("currency").isNotNull(), amount))
        .withColumn(
            "currency_known",
            F.when(F.col("currency").isNotNull(), (is_eur | F.col("__rate").isNotNull()).cast("int")),
        )
        .drop("__rate")
        .select(*df.columns, "price_in_eur", "currency_known")
    )


def bronze_to_silver(
    df: DataFrame, rates: DataFrame, shop_prefix: str | None, order: str = "ingest_order"
) -> DataFrame:
    """The whole Silver job as one plan with one shuffle.

    The shop filter looks at the key alone, so it may run before the
    de-duplication; everything that looks at other columns runs after it.
    """
    if shop_prefix:
        df = drop_shop_links(df, shop_prefix)
    df = drop_column(dedupe_url(df, order))
    df = derived_flags(standardize_series(clean_condition(clean_mileage(parse_price(df)))))
    return price_in_eur(df, rates)
