"""Silver to Gold: outlier filter, numeric features, categories, flags, score."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from paddock.functions.numeric import number
from paddock.functions.stats import one_row
from paddock.functions.text import first_match, flag, folded, found_words, hinted_flags_of, trimmed
from paddock.operators import rules

TARGET = "price_in_eur"
# Points per filled field, and the wording of the binary flags.
FIELD_POINTS = {"matching": 10, "owners": 10, "interior": 5, "exterior": 5, "paint": 15, "restored": 20, "mileage": 10}
LOW_MILEAGE_KM = 50000
MATCHING_VALUES = ("yes", "matching numbers", "numbers matching", "matching drivetrain")
READY_VALUES = ("yes", "y", "true", "1")
REAR_DRIVE_PATTERN = r"\b(?:rear|rwd)\b"
MATCHING_PATTERN = r"\b(?:yes|matching numbers|numbers matching|matching drivetrain)\b"


def as_timestamp(df: DataFrame, name: str) -> Column:
    """Column as timestamp; NULL where the text is no date."""
    column = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.try_to_timestamp(column)
    return column.cast("timestamp")


def drop_missing_target(df: DataFrame, target: str = TARGET) -> DataFrame:
    return df.where(F.col(target).isNotNull() & ~F.isnan(target))


def _log_or_plain(column: str, use_log: bool) -> Column:
    # ln of a non-positive value is NULL: such rows are outside every bound
    return F.ln(F.col(column)) if use_log else F.col(column)


def _bounds(df: DataFrame, value: Column, n_std: float) -> Column:
    """(low, high) around the mean; everything for a table of fewer than two rows."""
    few, reach = F.count(F.lit(1)) < 2, F.lit(n_std) * F.stddev_samp(value)
    return one_row(
        df,
        low=F.when(few, F.lit(float("-inf"))).otherwise(F.avg(value) - reach),
        high=F.when(few, F.lit(float("inf"))).otherwise(F.avg(value) + reach),
    )


def remove_outliers(df: DataFrame, column: str, n_std: float = 3.0, use_log: bool = False) -> DataFrame:
    """Rows within ``n_std`` sample standard deviations of the mean, bounds included."""
    value = _log_or_plain(column, use_log).cast("double")
    bounds = _bounds(df, value, n_std)
    return df.where(F.coalesce(value, F.lit(float("-inf"))).between(bounds["low"], bounds["high"]))


def outlier_count(df: DataFrame, column: str = TARGET, n_std: float = 3.0) -> DataFrame:
    """How many values lie beyond ``n_std`` deviations of the log mean, and their share."""
    value = _log_or_plain(column, use_log=True)
    bounds = _bounds(df.where(F.col(column) > 0), value, n_std)
    outside = F.count_if((value < bounds["low"]) | (value > bounds["high"]))
    return df.where(F.col(column) > 0).agg(
        F.count(F.lit(1)).alias("n_prices"),
        outside.alias("n_outliers"),
        F.try_divide(outside, F.count(F.lit(1))).alias("outlier_share"),
    )


def log_features(df: DataFrame) -> DataFrame:
    columns = {}
    if TARGET in df.columns:
        columns["log_price"] = F.ln(TARGET)
    if "Mileage_km" in df.columns:
        columns["log_mileage"] = F.log1p("Mileage_km")
        columns["Mileage_sq"] = F.pow("Mileage_km", F.lit(2.0))
    return df.withColumns(columns) if columns else df


def price_inflation(df: DataFrame, annual_rate: float = 0.02) -> DataFrame:
    """Growth factor for the time since a scrape, relative to the newest scrape here."""
    if "Scraped_At" not in df.columns:
        return df.withColumn("price_inflation_factor", F.lit(1.0))
    scraped = as_timestamp(df, "Scraped_At")
    newest = one_row(df, at=F.max(scraped))["at"]
    days = (F.unix_micros(newest) - F.unix_micros(scraped)) / F.lit(86400.0e6)
    factor = F.pow(F.lit(1.0 + annual_rate), days / F.lit(365.25))
    return df.withColumn("price_inflation_factor", F.coalesce(factor, F.lit(1.0)))


def model_category(df: DataFrame) -> DataFrame:
    if "Model" not in df.columns:
        return df.withColumn("model_category", F.lit(rules.CATEGORY_DEFAULT))
    category = first_match(F.col("Model"), rules.CATEGORY_RULES, rules.CATEGORY_DEFAULT)
    return df.withColumn("model_category", category)


def category_code(category: Column, order: tuple[str, ...], unknown: int) -> Column:
    codes = F.create_map(*[F.lit(x) for i, name in enumerate(order) for x in (name, i)])
    return F.coalesce(F.try_element_at(codes, category), F.lit(unknown))


def model_interactions(df: DataFrame) -> DataFrame:
    if "model_category" not in df.columns:
        df = model_category(df)
    order = rules.CATEGORY_ORDER
    mileage = number(df, "Mileage_km") if "Mileage_km" in df.columns else F.lit(None).cast("double")
    squared = number(df, "Mileage_sq") if "Mileage_sq" in df.columns else F.pow(mileage, F.lit(2.0))
    df = df.withColumns(
        {
            "model_cat_ordered": category_code(F.col("model_category"), order, len(order) - 1),
            "inv_mileage": F.try_divide(F.lit(1.0), mileage + 1),
        }
    )
    code = F.col("model_cat_ordered")
    return df.withColumns(
        {
            "Mileage_model_cat": mileage * code,
            "inv_Mileage_model_cat": F.col("inv_mileage") * code,
            "Mileage_sq_model_cat": squared * code,
        }
    )


def listing_text(df: DataFrame) -> Column:
    """The text fields at hand joined by spaces."""
    present = [c for c in rules.TEXT_COLUMNS if c in df.columns]
    if not present:
        return F.lit("")
    return F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in present])


def with_listing_text(df: DataFrame) -> DataFrame:
    return df.withColumn("listing_text", listing_text(df))


def text_flags(df: DataFrame) -> DataFrame:
    """One 0/1 column per keyword pattern, from one pass over the text."""
    flags = hinted_flags_of("__text", rules.TEXT_FLAGS, rules.FLAG_HINTS, "__words", rules.FLAG_WORDS)
    df = df.withColumn("__text", folded(F.col("listing_text")))
    return df.withColumn("__words", found_words(F.col("__text"), rules.FLAG_WORDS)).withColumns(flags).drop("__text", "__words")


def field_points(df: DataFrame) -> dict[str, Column]:
    """Points for each field present in ``df``; a missing value gives 0."""
    have, points = set(df.columns), {}

    def give(name: str, condition: Column) -> None:
        points[f"points_{name}"] = F.when(condition, F.lit(FIELD_POINTS[name])).otherwise(F.lit(0))

    if "Matching numbers" in have:
        text = F.lower(trimmed(F.col("Matching numbers").cast("string")))
        give("matching", text.isin(*MATCHING_VALUES))
    if "Number of vehicle owners" in have:
        # a missing value differs from "Unknown" and counts
        give("owners", F.coalesce(F.col("Number of vehicle owners") != "Unknown", F.lit(True)))
    if "Interior color" in have:
        give("interior", F.col("Interior color").isNotNull())
    if "Exterior color" in have:
        give("exterior", F.col("Exterior color").isNotNull())
    for name, column in (("paint", "Paint-to-Sample (PTS)"), ("restored", "is_fully_restored")):
        if column in have:
            value = F.coalesce(number(df, column), F.lit(0.0))
            points[f"points_{name}"] = (value * FIELD_POINTS[name]).cast("int")
    if "Mileage_km" in have:
        give("mileage", number(df, "Mileage_km") < LOW_MILEAGE_KM)
    return points


def score_components(df: DataFrame) -> DataFrame:
    return df.withColumns(field_points(df))


def weighted(weights: dict[str, float]) -> Column:
    """Sum of 0/1 columns times their weights."""
    return F.expr(" + ".join(f"{name} * {weight}D" for name, weight in weights.items()))


def penalty() -> Column:
    """Sum of the negative weights, floored."""
    return F.greatest(weighted(rules.PENALTY_WEIGHTS), F.lit(rules.PENALTY_FLOOR))


def listing_score(df: DataFrame) -> DataFrame:
    """Listing text, keyword flags and the weighted listing score."""
    terms = list(field_points(df).values())
    if any(c in df.columns for c in rules.TEXT_COLUMNS):
        df = text_flags(with_listing_text(df))
        terms += [weighted(rules.FLAG_WEIGHTS), penalty()]
    score = reduce(add, terms) if terms else F.lit(0.0)
    return df.withColumn("listing_score", score.cast("double"))


def binary_flags(df: DataFrame) -> DataFrame:
    def text(name: str) -> Column:
        if name not in df.columns:
            return F.lit("")
        return F.lower(trimmed(F.coalesce(F.col(name).cast("string"), F.lit(""))))

    return df.withColumns(
        {
            "state_yes": text("Ready to drive").isin(*READY_VALUES).cast("int"),
            "state_Rear drive": flag(text("Drive"), REAR_DRIVE_PATTERN),
            "matching_yes": flag(text("Matching numbers"), MATCHING_PATTERN),
        }
    )


def prepare_features(df: DataFrame) -> DataFrame:
    """Numbers as doubles (NULL where there is none), missing colours "Unknown"."""
    numeric = [c for c in ("Mileage_km", TARGET, "Year of construction") if c in df.columns]
    colours = [c for c in ("Interior color", "Exterior color") if c in df.columns]
    df = df.withColumns({c: number(df, c) for c in numeric}) if numeric else df
    return df.fillna("Unknown", subset=colours) if colours else df


def silver_to_gold(
    df: DataFrame, remove_price_outliers: bool = True, outlier_std: float = 3.0
) -> DataFrame:
    """The whole Gold job. The newest scrape is taken after the outlier filter."""
    df = drop_missing_target(df)
    if remove_price_outliers:
        df = remove_outliers(df, TARGET, outlier_std, use_log=True)
    df = price_inflation(log_features(df))
    df = model_interactions(model_category(df))
    return prepare_features(binary_flags(listing_score(df)))
