"""Combining two Gold tables: key cleaning, completeness, best row per key."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F

from paddock.functions.numeric import sanitize_nonfinite
from paddock.functions.ranking import first_per_key
from paddock.functions.text import trimmed
from paddock.operators.gold import as_timestamp

# Extra points for a filled column.
COMPLETENESS_BONUS = {"URL": 8, "price_in_eur": 5, "Mileage_km": 3, "Description": 2, "Scraped_At": 1}


def normalize_keys(df: DataFrame, key: str = "URL") -> DataFrame:
    if key not in df.columns:
        raise ValueError(f"table lacks the key column {key}")
    return df.withColumn(key, trimmed(F.col(key).cast("string"))).where(F.col(key) != "")


def completeness(columns: list[str]) -> Column:
    """Filled columns plus the bonuses of those present."""
    filled = [F.col(f"`{c}`").isNotNull().cast("int") for c in columns]
    bonus = [
        F.col(f"`{c}`").isNotNull().cast("int") * points
        for c, points in COMPLETENESS_BONUS.items()
        if c in columns
    ]
    return reduce(add, filled + bonus).cast("double")


def row_completeness(df: DataFrame) -> DataFrame:
    return df.withColumn("completeness_score", completeness(sanitize_nonfinite(df).columns))


def union_gold(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of both tables; a column of one side is NULL on the other. ``source_order`` tells the side."""
    return old.withColumn("source_order", F.lit(0)).unionByName(
        new.withColumn("source_order", F.lit(1)), allowMissingColumns=True
    )


def combine_gold(old: DataFrame, new: DataFrame, order: str = "ingest_order") -> DataFrame:
    """Per URL the fullest row, then the newest scrape, then the earlier input row."""
    both = union_gold(normalize_keys(old), normalize_keys(new))
    data = [c for c in both.columns if c not in ("source_order", order)]
    ranked = first_per_key(
        both.withColumn("__score", completeness(data)),
        ["URL"],
        [
            F.col("__score").desc(),
            (as_timestamp(both, "Scraped_At") if "Scraped_At" in data else F.lit(None)).desc_nulls_last(),
            F.col("source_order"),
            F.col(order),
        ],
    )
    return ranked.drop("__score", "source_order")


def predictions_long(frames: dict[str, DataFrame]) -> DataFrame:
    """One long table over models, each row tagged with its model."""
    tagged = [df.withColumn("model_name", F.lit(name)) for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b), tagged)
