"""Ridge, elastic net, automatic ridge, high-price specialist and the blend, on ln(price)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from paddock.functions.stats import exact_quantiles, hash_bucket
from paddock.models import moments
from paddock.models.frame import LOG_TARGET, Encoder, fit_encoder, with_log_target
from paddock.models.moments import FOLD, SLOTS, VALUES, dot
from paddock.operators.features import ColumnRoles
from paddock.operators.gold import TARGET
from paddock.session import cut_lineage

PREDICTED = "predicted_price_eur"
# Penalties and thresholds of the price models.
RIDGE_ALPHA, AUTO_RIDGE_ALPHA, META_ALPHA = 3.0, 1.0, 1.0
NET_ALPHA, NET_L1_RATIO = 5e-05, 0.655
HIGH_PRICE, ROUTE_AT, MIN_HIGH_ROWS = 250000.0, 0.5, 4
PREDICTION_FLOOR = 1.0
LOW_CARDINALITY, HASH_SLOTS = 40, 256


@dataclass(frozen=True)
class LogModel:
    """An encoder and a linear model of ln(price)."""

    encoder: Encoder
    coefficients: np.ndarray
    intercept: float

    def predict(self, df: DataFrame, out: str = PREDICTED) -> DataFrame:
        price = F.exp(dot(self.coefficients) + F.lit(self.intercept))
        return self.encoder.rows(df).withColumn(out, price).select(*df.columns, out)


def encoded(encoder: Encoder, df: DataFrame, *more: Column) -> DataFrame:
    """Sparse rows with their log target, written once."""
    return cut_lineage(encoder.rows(with_log_target(df)).select(SLOTS, VALUES, LOG_TARGET, *more))


def fit_ridge(
    train: DataFrame, roles: ColumnRoles, alpha: float = RIDGE_ALPHA, max_terms: int = 5000, min_df: int = 1, center: bool = True
) -> LogModel:
    """Ridge with sum-of-squares penalty ``alpha``, from the product sums of the encoded rows."""
    encoder = fit_encoder(train, roles.for_linear(), center=center, max_terms=max_terms, min_df=min_df)
    (sums,) = moments.moments(encoded(encoder, train), encoder.size, LOG_TARGET)
    return LogModel(encoder, *moments.ridge(sums, alpha))


def fit_elastic_net(
    train: DataFrame,
    roles: ColumnRoles,
    alpha: float = NET_ALPHA,
    l1_ratio: float = NET_L1_RATIO,
    max_terms: int = 5000,
    min_df: int = 1,
) -> LogModel:
    """Elastic net at its optimum, from the product sums of the encoded rows."""
    encoder = fit_encoder(train, roles.for_linear(), max_terms=max_terms, min_df=min_df)
    (sums,) = moments.moments(encoded(encoder, train), encoder.size, LOG_TARGET)
    return LogModel(encoder, *moments.NetPath(sums).fit(alpha, l1_ratio))


@dataclass(frozen=True)
class AutoRidge:
    """Ridge over automatically encoded columns."""

    encoder: Encoder
    hashed: tuple[str, ...]
    coefficients: np.ndarray
    intercept: float

    def predict(self, df: DataFrame, out: str = PREDICTED) -> DataFrame:
        price = F.exp(dot(self.coefficients) + F.lit(self.intercept))
        return _hashed_rows(self.encoder, self.hashed, df).withColumn(out, price).select(*df.columns, out)


def _hashed_rows(encoder: Encoder, hashed: tuple[str, ...], df: DataFrame) -> DataFrame:
    slots, values = moments.unpacked(F.col("auto_features"))
    return _hash_grams(encoder.transform(df), hashed).withColumns({SLOTS: slots, VALUES: values})


def _hash_grams(df: DataFrame, columns: tuple[str, ...], size: int = HASH_SLOTS) -> DataFrame:
    """Character 3-grams of high-cardinality text, hashed into ``size`` slots each."""
    inputs = ["features"]
    for i, c in enumerate(columns):
        text = F.concat(F.lit(" "), F.lower(F.coalesce(F.col(f"`{c}`"), F.lit(""))), F.lit("  "))
        grams = F.transform(F.sequence(F.lit(1), F.length(text) - 2), lambda at: F.substring(text, at, F.lit(3)))
        df = HashingTF(numFeatures=size, inputCol=f"__g{i}", outputCol=f"__h{i}").transform(df.withColumn(f"__g{i}", grams))
        inputs.append(f"__h{i}")
    return VectorAssembler(inputCols=inputs, outputCol="auto_features").transform(df)


def fit_auto_ridge(train: DataFrame, roles: ColumnRoles, alpha: float = AUTO_RIDGE_ALPHA) -> AutoRidge:
    """Numbers as they are, few levels one-hot, many levels as hashed character 3-grams."""
    roles = roles.for_linear().without_text()
    counts = train.agg(
        *[F.count_distinct(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(roles.categorical)]
    ).first() if roles.categorical else ()
    many = tuple(c for c, n in zip(roles.categorical, counts) if n >= LOW_CARDINALITY)
    encoder = fit_encoder(train, roles.without(*many), center=False, scale=False)
    rows = cut_lineage(_hashed_rows(encoder, many, with_log_target(train)).select(SLOTS, VALUES, LOG_TARGET))
    (sums,) = moments.moments(rows, encoder.size + HASH_SLOTS * len(many), LOG_TARGET)
    return AutoRidge(encoder, many, *moments.ridge(sums, alpha))


@dataclass(frozen=True)
class Specialist:
    """A general model, one for high prices, and a router between them."""

    general: LogModel | float
    specialist: LogModel | None
    encoder: Encoder | None
    router: LogisticRegressionModel | None
    route_at: float
    all_high: bool

    def predict(self, df: DataFrame, out: str = PREDICTED) -> DataFrame:
        if isinstance(self.general, float):
            return df.withColumn(out, F.lit(self.general))
        if self.specialist is not None and self.all_high:
            return self.specialist.predict(df, out)
        general = self.general.predict(df, out)
        if self.router is None or self.specialist is None:
            return general
        both = self.specialist.predict(general, "__special")
        routed = self.router.setProbabilityCol("__p").setRawPredictionCol("__raw").setPredictionCol("__route").transform(
            self.encoder.transform(both)
        )
        is_high = vector_to_array("__p")[1] >= self.route_at
        return routed.withColumn(out, F.when(is_high, F.col("__special")).otherwise(F.col(out))).select(*df.columns, out)


def balanced_logistic(data: DataFrame, label: str) -> LogisticRegressionModel:
    """Logistic regression with unit penalty and classes of equal total weight."""
    row = data.agg(F.count(F.lit(1)).alias("n"), F.sum(label).alias("ones")).first()
    n, ones = row["n"], float(row["ones"])
    weight = F.when(F.col(label) == 1, F.lit(n / (2 * ones))).otherwise(F.lit(n / (2 * (n - ones))))
    return LogisticRegression(
        labelCol=label, weightCol="__weight", standardization=False, regParam=1.0 / n, maxIter=1000
    ).fit(data.withColumn("__weight", weight))


def fit_specialist(
    train: DataFrame,
    roles: ColumnRoles,
    high_price: float = HIGH_PRICE,
    route_at: float = ROUTE_AT,
    min_rows: int = MIN_HIGH_ROWS,
) -> Specialist:
    roles = roles.for_linear().without_text()
    if not roles.tabular:
        median = exact_quantiles(train, F.col(TARGET), {"m": 0.5}).first()["m"]
        return Specialist(float(median), None, None, None, route_at, False)
    high = (F.col(TARGET) >= high_price).cast("int")
    row = train.agg(F.count(F.lit(1)).alias("n"), F.sum(high).alias("high")).first()
    general = fit_ridge(train, roles, center=False)
    router = encoder = None
    if 0 < row["high"] < row["n"]:
        encoder = general.encoder
        router = balanced_logistic(encoder.transform(train.withColumn("__high", high.cast("double"))), "__high")
    special = None
    if row["high"] >= min_rows:
        special = fit_ridge(train.where(F.col(TARGET) >= high_price), roles, center=False)
    return Specialist(general, special, encoder, router, route_at, row["high"] == row["n"])


def floored(column: str, floor: float = PREDICTION_FLOOR):
    """Missing and non-finite predictions, and those below it, become the floor."""
    c = F.col(column)
    bad = c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    return F.when(bad, F.lit(floor)).otherwise(F.greatest(c, F.lit(floor)))


def geo_mean_blend(df: DataFrame, a: str, b: str, out: str = PREDICTED, floor: float = PREDICTION_FLOOR) -> DataFrame:
    return df.withColumn(out, F.exp((F.ln(floored(a, floor)) + F.ln(floored(b, floor))) / 2))


@dataclass(frozen=True)
class Blend:
    """Geometric mean of ridge and elastic net; ``meta`` is only reported."""

    ridge: LogModel
    net: LogModel
    meta: tuple[float, float, float] | None

    def predict(self, df: DataFrame, out: str = PREDICTED) -> DataFrame:
        both = self.net.predict(self.ridge.predict(df, "__ridge"), "__net")
        return geo_mean_blend(both, "__ridge", "__net", out).drop("__ridge", "__net")


def by_fold(expressions: list[Column]) -> Column:
    """The expression of the row's fold; the others are not computed."""
    out = F.when(F.col(FOLD) == 0, expressions[0])
    for i, e in enumerate(expressions[1:], 1):
        out = out.when(F.col(FOLD) == i, e)
    return out


def fit_stacked(
    train: DataFrame,
    roles: ColumnRoles,
    key: str = "URL",
    folds: int = 5,
    max_terms: int = 5000,
    min_df: int = 1,
    report_meta: bool = True,
    seed: int = 42,
) -> Blend:
    """Both base models on all rows; with ``report_meta`` also the meta model over out-of-fold predictions.

    Product sums by key-hash fold serve all fits: a fold's models come from the total without the fold. The
    encoding is learned once, from all training rows.
    """
    encoder = fit_encoder(train, roles.for_linear(), max_terms=max_terms, min_df=min_df)
    fold = hash_bucket(F.col(key), seed, folds).cast("int").alias(FOLD)
    rows = encoded(encoder, train, fold)
    written = moments.written_moments(rows, encoder.size, LOG_TARGET, folds if report_meta else 1)

    def fits(sums: moments.Moments, start: np.ndarray | None = None) -> list[tuple[np.ndarray, float]]:
        fitted, path = moments.ridge(sums, RIDGE_ALPHA), moments.NetPath(sums)
        if start is not None:
            path.weights, path.limit = start.copy(), NET_ALPHA * NET_L1_RATIO  # from the whole fit on
        return [fitted, path.fit(NET_ALPHA, NET_L1_RATIO)]

    whole = fits(written.total())
    models = [LogModel(encoder, *fit) for fit in whole]
    if not report_meta:
        return Blend(*models, None)
    outside = [fits(written.without(f), whole[1][0]) for f in range(folds)]  # one fold's matrix at a time
    logs = [by_fold([dot(pair[i][0]) + F.lit(pair[i][1]) for pair in outside]) for i in (0, 1)]
    prices = rows.select(LOG_TARGET, F.exp(logs[0]).alias("__ridge"), F.exp(logs[1]).alias("__net"))
    both = prices.select(
        LOG_TARGET, F.array(F.lit(0), F.lit(1)).alias(SLOTS), F.array(F.ln(floored("__ridge")), F.ln(floored("__net"))).alias(VALUES)
    )
    weights, intercept = moments.ridge(moments.moments(both, 2, LOG_TARGET)[0], META_ALPHA)
    return Blend(*models, (*map(float, weights), float(intercept)))
