"""Tables behind the listing browser."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from paddock.functions.numeric import number
from paddock.functions.ranking import first_per_key
from paddock.operators.gold import as_timestamp

# Where date and mileage are looked for, and table sizes.
DATE_COLUMNS = ("Scraped_At", "Scraped At", "Date")
MILEAGE_COLUMNS = ("Mileage_km", "Mileage", "mileage_value")
TABLE_ROWS, PREDICTION_ROWS, SUMMARY_ROWS = 500, 200, 200


def dash_frame(df: DataFrame, order: str = "ingest_order") -> DataFrame:
    """One row per URL with ``scraped``, ``year`` and ``km`` from the first column at hand."""
    if "URL" in df.columns:
        df = first_per_key(df, ["URL"], [F.col(order)])
    if "price_in_eur" not in df.columns and {"price", "currency"} <= set(df.columns):
        df = df.withColumn("price_in_eur", F.col("price"))
    date = next((c for c in DATE_COLUMNS if c in df.columns), None)
    mileage = next((c for c in MILEAGE_COLUMNS if c in df.columns), None)
    nothing = F.lit(None)
    return df.withColumns(
        {
            "scraped": as_timestamp(df, date) if date else nothing.cast("timestamp"),
            "year": number(df, "Year of construction") if "Year of construction" in df.columns else nothing.cast("double"),
            "km": number(df, mileage) if mileage else nothing.cast("double"),
        }
    )


def gearbox_column(df: DataFrame) -> str | None:
    return next((c for c in df.columns if "gear" in c.lower() or "transm" in c.lower()), None)


def facet_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values per filter column, as rows (a column may have many)."""
    return (
        df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns])
        .unpivot([], list(columns), "facet", "value")
        .where(F.col("value").isNotNull())
        .distinct()
    )


def facet_ranges(df: DataFrame, columns: Sequence[str] = ("price_in_eur", "km", "year")) -> DataFrame:
    """Whole-number range per numeric filter."""
    row = df.agg(*[f(c).alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("lo", F.min), ("hi", F.max))])
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("facet"),
                F.col(f"lo{i}").cast("bigint").alias("low"),
                F.col(f"hi{i}").cast("bigint").alias("high"),
            )
            for i, c in enumerate(columns)
        ]
    )
    return row.select(F.inline(rows))


def dash_facets(df: DataFrame) -> DataFrame:
    """Filter choices (facet, value) and ranges (facet, low, high) in one table."""
    columns = [c for c in ("Model", gearbox_column(df)) if c and c in df.columns]
    return facet_values(df, columns).unionByName(facet_ranges(df), allowMissingColumns=True)


def search_text(df: DataFrame) -> Column | None:
    """The searchable columns joined and lower-cased."""
    columns = [c for c in df.columns if any(part in c.lower() for part in ("desc", "title", "model"))]
    if not columns:
        return None
    return F.lower(F.concat_ws(" ", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in columns]))


def dash_filter(
    df: DataFrame,
    choices: Mapping[str, Sequence[str]] | None = None,
    ranges: Mapping[str, tuple[float, float]] | None = None,
    search: str | None = None,
) -> DataFrame:
    """Rows meeting every choice, inclusive range and the case-insensitive search."""
    for column, values in (choices or {}).items():
        if values:
            df = df.where(F.col(f"`{column}`").isin(*values))
    for column, (low, high) in (ranges or {}).items():
        df = df.where(F.col(f"`{column}`").between(low, high))
    if search:
        text = search_text(df)
        if text is not None:
            df = df.where(F.contains(text, F.lit(search.lower())))
    return df


def dash_table(df: DataFrame, columns: Sequence[str], order: str, n: int = TABLE_ROWS) -> DataFrame:
    """Chosen columns of the first ``n`` rows."""
    present = [c for c in columns if c in df.columns]
    gearbox = gearbox_column(df)
    if gearbox and gearbox not in present:
        present.insert(min(3, len(present)), gearbox)
    return df.orderBy(order).limit(n).select(*[F.col(f"`{c}`") for c in present])


def price_timeline(df: DataFrame) -> DataFrame:
    return df.where(F.col("scraped").isNotNull()).select(
        "scraped", "price_in_eur", "Model", "Title", "URL"
    ).orderBy("scraped", "URL")


def model_summary(df: DataFrame, n: int = SUMMARY_ROWS) -> DataFrame:
    """Count, price and mileage range per model; the ``n`` most frequent models."""
    price, km = F.col("price_in_eur"), F.col("Mileage_km" if "Mileage_km" in df.columns else "km")
    return (
        df.where(F.col("Model").isNotNull())
        .groupBy("Model")
        .agg(
            F.count(price).alias("n"),
            F.avg(price).alias("price_mean"),
            F.min(price).alias("price_min"),
            F.max(price).alias("price_max"),
            F.avg(km).alias("mileage_mean"),
            F.min(km).alias("mileage_min"),
            F.max(km).alias("mileage_max"),
        )
        .orderBy(F.col("n").desc(), "Model")
        .limit(n)
    )


def row_at_offset(df: DataFrame, n: int, order: str) -> DataFrame:
    return df.orderBy(order).offset(n).limit(1)
