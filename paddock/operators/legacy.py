"""The older notebook cleaning: price format, filters, usage, cascade, flags."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F

from paddock.functions.numeric import number, to_double
from paddock.functions.text import first_match, flags_of, trimmed
from paddock.operators import rules
from paddock.operators.gold import category_code

# Price format and limits.
LEGACY_PRICE_PATTERN = r"(?U)([A-Za-z]+)\s([\d,]+)\s*$"
MAX_MILEAGE_KM = 900000
MIN_PRICE_EUR, MAX_PRICE_EUR = 15000, 700000
# case as written, Unicode classes, only \n ends a line
_FLAGS = "(?dU)"
_FLAGS_ANY_CASE = "(?idU)"


def parse_price_legacy(df: DataFrame) -> DataFrame:
    """``legacy_currency`` and ``legacy_price`` from a price at the end of the text."""
    def part(group: int) -> Column:
        return F.nullif(F.regexp_extract("Price", LEGACY_PRICE_PATTERN, group), F.lit(""))

    return df.select(
        "*",
        part(1).alias("legacy_currency"),
        to_double(F.replace(part(2), F.lit(","), F.lit(""))).alias("legacy_price"),
    )


def legacy_filters(df: DataFrame) -> DataFrame:
    price = F.col("price_in_eur")
    return df.where(
        (F.col("Mileage_km") < MAX_MILEAGE_KM) & (price < MAX_PRICE_EUR) & (price > MIN_PRICE_EUR)
    )


def legacy_usage(df: DataFrame, as_of_year: int) -> DataFrame:
    """Age, whole kilometres (half to even), and kilometres per year of age."""
    age = F.lit(as_of_year) - number(df, "Year of construction").cast("int")
    whole_km = F.bround("Mileage_km", 0)
    return df.withColumns({"age": age, "mileage_rounded": whole_km.cast("bigint")}).withColumn(
        "mileage_per_year",
        F.col("mileage_rounded")
        / F.when(F.col("age") == 0, F.lit(0.5)).otherwise(F.col("age").cast("double")),
    )


def legacy_ready_to_drive(df: DataFrame) -> DataFrame:
    """Blank means no; a "no" on a car younger than 30 becomes yes. Needs ``age``."""
    state = F.coalesce(F.col("Ready to drive"), F.lit(""))
    state = F.when(state.rlike(r"(?U)^\s*$"), F.lit("no")).otherwise(state)
    return df.withColumn(
        "Ready to drive",
        F.when((F.col("age") < 30) & state.isin("No", "no"), F.lit("yes")).otherwise(state),
    )


def model_category_legacy(df: DataFrame) -> DataFrame:
    text = F.lower(trimmed(F.col("Model")))
    # rule 2 ignores case, the others see lower-cased text as it is
    cascade = [
        ((_FLAGS_ANY_CASE if i == 1 else _FLAGS) + pattern, name)
        for i, (pattern, name) in enumerate(rules.LEGACY_CATEGORY_RULES)
    ]
    category = first_match(text, cascade, rules.LEGACY_CATEGORY_DEFAULT, flags="")
    order = rules.LEGACY_CATEGORY_ORDER
    return df.withColumn("legacy_category", category).withColumn(
        "legacy_cat_ordered", category_code(F.col("legacy_category"), order, -1)
    )


def text_flags_legacy(df: DataFrame, text_column: str = "Description") -> DataFrame:
    text = F.lower(F.coalesce(F.col(text_column), F.lit("")))
    flags = flags_of(text, rules.LEGACY_TEXT_FLAGS)
    df = df.withColumns({f"legacy_{name}": column for name, column in flags.items()})
    weights = rules.LEGACY_FLAG_WEIGHTS
    score = reduce(add, [F.col(f"legacy_{name}") * F.lit(w) for name, w in weights.items()])
    return df.withColumn("legacy_score", score)
