"""Train/test split and the numeric feature vector of a listing."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from paddock.functions.stats import exact_quantiles, hash_bucket
from paddock.models.moments import SLOTS, VALUES, unpacked
from paddock.models.tfidf import TfidfModel, fit_tfidf
from paddock.operators.features import ColumnRoles
from paddock.operators.gold import TARGET

LOG_TARGET = "__log_target"
# Fixed value: stands for a missing category.
MISSING = "missing"


def holdout(df: DataFrame, key: str = "URL", seed: int = 42, buckets: int = 4) -> tuple[DataFrame, DataFrame]:
    """Training rows and one bucket of the key hash as test rows (25 percent for 4 buckets)."""
    is_test = hash_bucket(F.col(key), seed, buckets) == 0
    return df.where(~is_test), df.where(is_test)


def log_target_guard(df: DataFrame, target: str = TARGET) -> DataFrame:
    """How many targets there are and how many cannot be logged."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(target) <= 0).alias("n_non_positive")
    )


def with_log_target(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Adds ln(target); raises if any target is not positive."""
    if log_target_guard(df, target).first()["n_non_positive"]:
        raise ValueError("Target values must be positive before applying the log transform")
    return df.withColumn(LOG_TARGET, F.ln(target))


def numeric_stats(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float, float]]:
    """Median, then mean and population deviation after median filling, per column with any value."""
    columns = list(columns)
    if not columns:
        return {}
    values = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in columns]).unpivot([], columns, "column", "v")
    medians = {
        r["column"]: r["median"] for r in exact_quantiles(values, F.col("v"), {"median": 0.5}, ["column"]).collect()
    }
    present = [c for c in columns if c in medians]

    def filled(c: str) -> Column:
        return F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(medians[c]))

    row = df.agg(
        *[F.avg(filled(c)).alias(f"mean{i}") for i, c in enumerate(present)],
        *[F.stddev_pop(filled(c)).alias(f"std{i}") for i, c in enumerate(present)],
    ).first()
    return {c: (medians[c], row[f"mean{i}"], row[f"std{i}"] or 1.0) for i, c in enumerate(present)}


def numeric_columns(stats: dict[str, tuple[float, float, float]], center: bool = True, scale: bool = True) -> dict[str, str]:
    """SQL expression per column: median filled, centred and scaled."""
    out = {}
    for c, (median, mean, std) in stats.items():
        value = f"coalesce(cast(`{c}` as double), {median!r}D)"
        if center:
            value = f"({value} - {mean!r}D)"
        out[c] = f"{value} / {std!r}D" if scale else value
    return out


def category_level(column: str, missing: str = MISSING) -> str:
    """SQL expression of a category; the empty text gets a name, as MLlib allows none without."""
    return f"coalesce(if(`{column}` = '', '(empty)', cast(`{column}` as string)), '{missing}')"


@dataclass(frozen=True)
class Encoder:
    """Fitted feature encoding: a plain MLlib pipeline for the tabular part, and text weights if there is text."""

    pipeline: PipelineModel
    text: TfidfModel | None
    text_column: str | None
    slots: list[str] = field(default_factory=list)

    def transform(self, df: DataFrame) -> DataFrame:
        """``features`` of the tabular part as a vector."""
        return self.pipeline.transform(df)

    def rows(self, df: DataFrame) -> DataFrame:
        """Tabular and text part as two arrays, SLOTS and VALUES, slots rising."""
        tabular = self.size - (len(self.text.terms) if self.text else 0)
        if tabular:
            slots, values = unpacked(F.col("features"))
            df = self.pipeline.transform(df).withColumns({SLOTS: slots, VALUES: values}).select(*df.columns, SLOTS, VALUES)
        else:
            df = df.withColumns({SLOTS: F.array().cast("array<int>"), VALUES: F.array().cast("array<double>")})
        if self.text is not None:
            df = self.text.transform(df, self.text_column, "__term_slots", "__term_values")
            moved = F.transform("__term_slots", lambda s: s + tabular)
            df = df.withColumns({SLOTS: F.concat(SLOTS, moved), VALUES: F.concat(VALUES, "__term_values")}).drop("__term_slots", "__term_values")
        return df

    @property
    def size(self) -> int:
        return len(self.slots)


def fit_encoder(
    train: DataFrame,
    roles: ColumnRoles,
    center: bool = True,
    scale: bool = True,
    max_terms: int = 5000,
    min_df: int = 1,
    one_hot: bool = True,
) -> Encoder:
    """Learn the encoding of the columns in ``roles`` from the training rows.

    Categories become one-hot slots; levels unseen in training are all zeros.
    With ``one_hot=False`` they stay as level numbers for tree models.
    """
    if not roles.features:
        raise ValueError("ColumnRoles must include at least one feature column")
    stats = numeric_stats(train, roles.numeric)
    numeric = numeric_columns(stats, center, scale)
    stages, inputs, slots = [], [], []
    safe = {c: f"__x{i}" for i, c in enumerate([*numeric, *roles.categorical])}
    pieces = [f"{e} as {safe[c]}" for c, e in numeric.items()]
    pieces += [f"{category_level(c)} as {safe[c]}" for c in roles.categorical]
    if pieces:
        stages.append(SQLTransformer(statement=f"select *, {', '.join(pieces)} from __THIS__"))
    inputs += [safe[c] for c in numeric]
    slots += list(numeric)
    if roles.categorical:
        names = [safe[c] for c in roles.categorical]
        indexer = StringIndexer(
            inputCols=names, outputCols=[f"{n}_i" for n in names], handleInvalid="keep", stringOrderType="alphabetAsc"
        )
        prepared = stages[0].transform(train)
        indexed = indexer.fit(prepared)
        stages.append(indexed)
        if one_hot:
            # the indexer's bucket for unseen levels comes last and is dropped, so
            # such a level is all zeros
            encoder = OneHotEncoder(
                inputCols=[f"{n}_i" for n in names], outputCols=[f"{n}_v" for n in names], dropLast=True
            )
            stages.append(encoder.fit(indexed.transform(prepared)))
            inputs += [f"{n}_v" for n in names]
            for c, levels in zip(roles.categorical, indexed.labelsArray):
                slots += [f"{c}={level}" for level in levels]
        else:
            inputs += [f"{n}_i" for n in names]
            slots += list(roles.categorical)
    text, column = None, None
    if roles.text:
        column = roles.text[0]
        text = fit_tfidf(train, column, max_terms=max_terms, min_df=min_df)
        slots += [f"{column}:{term}" for term in text.terms]
    if inputs:
        stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="error"))
    return Encoder(PipelineModel(stages), text, column, slots)


def median_baseline(train: DataFrame, test: DataFrame, target: str = TARGET) -> DataFrame:
    """The training median for every test row."""
    median = exact_quantiles(train, F.col(target), {"median": 0.5}).select("median").scalar()
    return test.withColumn("predicted_price_eur", median)


def numeric_prep(df: DataFrame, columns: Sequence[str], center: bool = True) -> DataFrame:
    """Median filling and standardising as columns; the statistics are a few numbers per column."""
    scaled = numeric_columns(numeric_stats(df, columns), center)
    return df.withColumns({f"{c}_scaled": F.expr(e) for c, e in scaled.items()})


def onehot_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per one-hot slot (``column=level``): levels are counted, no row is made dense."""
    levels = F.array(*[F.concat(F.lit(f"{c}="), F.expr(category_level(c))) for c in columns])
    return df.select(F.explode(levels).alias("level")).groupBy("level").agg(F.count(F.lit(1)).alias("n"))
