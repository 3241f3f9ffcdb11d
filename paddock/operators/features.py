"""Which columns a model sees, and the frame built from them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from paddock.functions.numeric import number
from paddock.functions.stats import exact_quantiles
from paddock.operators import rules
from paddock.operators.gold import TARGET, with_listing_text

# Columns a model may use, in this order.
NUMERIC_COLUMNS = (
    "Mileage_km", "Year of construction", "listing_score", "owners_known", "is_fully_restored",
    "Paint-to-Sample (PTS)", "log_mileage", "Mileage_sq", "model_cat_ordered", "inv_mileage",
    "Mileage_model_cat", "inv_Mileage_model_cat", "Mileage_sq_model_cat", "restoration_full",
    "restoration_partial", "is_restomod", "has_docs", "is_matching_numbers", "is_mint",
    "is_race_ready", "is_rare", "is_accident_free", "has_upgrades", "first_owner", "state_yes",
    "state_Rear drive", "matching_yes", "limited_production", "racing_history", "specialist_build",
    "bespoke_exclusive", "zero_running_hours", "engine_transmission_rebuilt", "cup_clubsport",
    "heritage_special", "weissach_package", "pccb", "ceramic_brakes", "bucket_seats",
    "clubsport_package", "front_axle_lift", "sport_chrono", "manual_transmission_text",
    "paint_to_sample_text", "rsr_st_special", "non_rebuilt", "needs_rebuild", "body_only",
    "missing_drivetrain", "project_car", "not_ready_to_drive_text", "accident_damage", "manthey",
    "ruf", "techart", "carbon_package", "lightweight_package", "full_leather",
    "carbon_bucket_seats", "price_inflation_factor",
)
CATEGORICAL_COLUMNS = (
    "Model", "Series", "model_category", "Condition", "Matching numbers", "Interior color",
    "Exterior color", "Country", "Transmission", "Drive", "Ready to drive", "Car location",
)
TEXT_COLUMNS = ("listing_text", "Description")
# What a linear model leaves out as redundant with the score and the categories:
# the text flags, and (fixed values) interactions and binary flags.
INTERACTION_COLUMNS = ("model_cat_ordered", "inv_mileage", "Mileage_model_cat", "inv_Mileage_model_cat", "Mileage_sq_model_cat")
BINARY_FLAGS = ("state_yes", "state_Rear drive", "matching_yes")
NOT_LINEAR = frozenset((*rules.TEXT_FLAGS, *INTERACTION_COLUMNS, *BINARY_FLAGS))


@dataclass(frozen=True)
class ColumnRoles:
    """Column names by role; plain driver-side data."""

    target: str
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    text: tuple[str, ...] = ()

    @property
    def tabular(self) -> list[str]:
        return [*self.numeric, *self.categorical]

    @property
    def features(self) -> list[str]:
        return [*self.tabular, *self.text]

    def for_linear(self) -> ColumnRoles:
        return replace(self, numeric=tuple(c for c in self.numeric if c not in NOT_LINEAR))

    def without_text(self) -> ColumnRoles:
        return replace(self, text=())

    def without(self, *names: str) -> ColumnRoles:
        return replace(
            self,
            numeric=tuple(c for c in self.numeric if c not in names),
            categorical=tuple(c for c in self.categorical if c not in names),
        )


def select_columns(df: DataFrame) -> ColumnRoles:
    """Allowed columns present in ``df``; the joined text replaces its parts."""
    have = set(df.columns)
    text = tuple(c for c in TEXT_COLUMNS if c in have)
    return ColumnRoles(
        target=TARGET,
        numeric=tuple(c for c in NUMERIC_COLUMNS if c in have),
        categorical=tuple(c for c in CATEGORICAL_COLUMNS if c in have),
        text=("listing_text",) if "listing_text" in text else text,
    )


def feature_frame(df: DataFrame, keys: Sequence[str] = ("URL",)) -> tuple[DataFrame, ColumnRoles]:
    """Keys, features and target of the rows that have a target."""
    if TARGET not in df.columns:
        raise ValueError(f"Missing required target column: {TARGET}")
    df = df.dropna(subset=[TARGET])
    if "listing_text" not in df.columns and any(c in df.columns for c in rules.TEXT_COLUMNS):
        df = with_listing_text(df)
    roles = select_columns(df)
    if not roles.features:
        raise ValueError("No supported features found in DataFrame")
    frame = df.select(
        *keys,
        *[number(df, c).alias(c) for c in roles.numeric],
        *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("Unknown")).alias(c) for c in roles.categorical],
        *roles.text,
        F.col(TARGET).cast("double").alias(TARGET),
    )
    return frame, roles


def column_usage(df: DataFrame) -> DataFrame:
    """Every selected column with its role, its use in linear models and its filled rows."""
    frame, roles = feature_frame(df, keys=())
    linear = set(roles.for_linear().features)
    role = {**dict.fromkeys(roles.numeric, "numeric"), **dict.fromkeys(roles.categorical, "categorical"),
            **dict.fromkeys(roles.text, "text")}
    counts = frame.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in roles.features])
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.lit(role[c]).alias("role"),
                F.lit(int(c in linear)).alias("used_by_linear"),
                F.col(f"`{c}`").alias("n_filled"),
            )
            for c in roles.features
        ]
    )
    return counts.select(F.inline(rows))


def aligned_dummies(
    train: DataFrame, test: DataFrame, categorical: Sequence[str], numeric: Sequence[str], keys: Sequence[str] = ("URL",)
) -> tuple[DataFrame, DataFrame]:
    """0/1 columns per training level and per missing level; numbers filled with the training median.

    A level becomes a column, so the levels are read to the driver as the schema
    of the result. Test levels unseen in training get no column.
    """
    levels = (
        train.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in categorical])
        .unpivot([], list(categorical), "column", "level")
        .where(F.col("level").isNotNull())
        .distinct()
        .orderBy("column", "level")
        .collect()
    )
    values = train.select(*[number(train, c).alias(c) for c in numeric]).unpivot([], list(numeric), "column", "v")
    medians = {r["column"]: r["median"] for r in exact_quantiles(values, F.col("v"), {"median": 0.5}, ["column"]).collect()}

    def encode(df: DataFrame) -> DataFrame:
        columns = [F.coalesce(number(df, c), F.lit(float(medians.get(c, 0.0)))).alias(c) for c in numeric]
        for c in categorical:
            names = [r["level"] for r in levels if r["column"] == c]
            columns += [F.col(f"`{c}`").eqNullSafe(F.lit(name)).cast("int").alias(f"{c}_{name}") for name in names]
            columns.append(F.col(f"`{c}`").isNull().cast("int").alias(f"{c}_nan"))
        return df.select(*keys, *columns)

    return encode(train), encode(test)
