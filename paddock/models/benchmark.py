"""A benchmark run: fit the asked-for models, score, and write what a run leaves behind."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from paddock.models import linear, trees
from paddock.models.cards import card_model_pick, model_card
from paddock.models.frame import holdout, median_baseline
from paddock.operators.combine import predictions_long
from paddock.operators.evaluation import regression_metrics, residuals
from paddock.operators.features import ColumnRoles, feature_frame
from paddock.operators.gold import TARGET
from paddock.session import cut_lineage
from paddock.sources import tables

DEFAULT_MODELS = ("median", "ridge", "elasticnet", "auto_ridge")
# Text limits of the runner, seeds of the ablation.
RUN_TERMS, RUN_MIN_DF = 5000, 3
ABLATION_SEEDS = (42, 43, 44, 45, 46)

Fit = Callable[[DataFrame, DataFrame, ColumnRoles, dict], DataFrame]


def _predicting(fit: Callable) -> Fit:
    return lambda train, test, roles, options: fit(train, roles, **options).predict(test)


MODELS: dict[str, Fit] = {
    "median": lambda train, test, roles, options: median_baseline(train, test),
    "ridge": _predicting(lambda t, r, **o: linear.fit_ridge(t, r, max_terms=RUN_TERMS, min_df=RUN_MIN_DF, **o)),
    "elasticnet": _predicting(lambda t, r, **o: linear.fit_elastic_net(t, r, max_terms=RUN_TERMS, min_df=RUN_MIN_DF, **o)),
    "auto_ridge": _predicting(linear.fit_auto_ridge),
    "high_price_specialist": _predicting(linear.fit_specialist),
    "stacked_ensemble": _predicting(linear.fit_stacked),
    "boosted": _predicting(trees.fit_boosted),
    "boosted_early_stop": _predicting(trees.fit_early_stopped),
    "boosted_categories": _predicting(trees.fit_category_boosted),
}


@dataclass(frozen=True)
class RunResult:
    predictions: DataFrame
    metrics: DataFrame
    skipped: dict[str, str] = field(default_factory=dict)
    duration_sec: float = 0.0


def as_predictions(scored: DataFrame, key: str = "URL") -> DataFrame:
    """Scored test rows in the layout of a prediction table; the listing key identifies a row."""
    return residuals(
        scored.select(
            F.col(key).alias("row_index"),
            F.col(TARGET).alias("actual_price_eur"),
            F.col("predicted_price_eur").cast("double").alias("predicted_price_eur"),
        )
    )


def run_benchmark(
    gold: DataFrame,
    output_dir: str | None = None,
    models: Sequence[str] = DEFAULT_MODELS,
    seed: int = 42,
    key: str = "URL",
    options: dict[str, dict] | None = None,
) -> RunResult:
    """Fit and score ``models`` on one split. A model that cannot be fitted is skipped with its reason.

    The feature frame is checkpointed once: every model reads it several times.
    """
    start = time.perf_counter()
    unknown = [m for m in models if m not in MODELS]
    if unknown:
        raise ValueError(f"Unknown models: {unknown}")
    frame, roles = feature_frame(gold, (key,))
    train, test = holdout(cut_lineage(frame), key, seed)
    frames, skipped = {}, {}
    for name in models:
        try:
            frames[name] = as_predictions(MODELS[name](train, test, roles, (options or {}).get(name, {})), key)
        except (ValueError, RuntimeError) as error:
            skipped[name] = str(error)
    if not frames:
        raise ValueError(f"No model could be fitted: {skipped}")
    predictions = cut_lineage(predictions_long(frames))
    metrics = regression_metrics(predictions, by=["model_name"])
    result = RunResult(predictions, metrics, skipped, time.perf_counter() - start)
    if output_dir is not None:
        write_run(result, output_dir)
    return result


def write_run(result: RunResult, output_dir: str) -> None:
    """Predictions as CSV, metrics and skips as JSON, the card as text."""
    spark = result.predictions.sparkSession
    tables.write_predictions(result.predictions, f"{output_dir}/predictions.csv")
    tables.write_metrics(result.metrics, f"{output_dir}/metrics.json")
    if result.skipped:
        rows = list(result.skipped.items())
        tables.write_skipped(spark.createDataFrame(rows, "model_name string, reason string"), f"{output_dir}/skipped_models.json")
    picked = card_model_pick(result.metrics).first() or result.metrics.orderBy("mae_eur").first()
    card = model_card(
        picked.asDict(),
        ["Errors are measured on one held-out quarter of the listings."],
        ["Read the metrics and the held-out predictions next to the model."],
    )
    spark.createDataFrame([(card,)], "value string").write.mode("overwrite").option("lineSep", "\n").text(
        f"{output_dir}/MODEL_CARD.md"
    )


def save_model(model: linear.LogModel, path: str) -> None:
    """Encoder pipeline, text vocabulary and coefficients under one folder."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    model.encoder.pipeline.write().overwrite().save(f"{path}/encoder")
    text = model.encoder.text
    rows = [(i, t, w) for i, (t, w) in enumerate(zip(text.terms, text.idf))] if text else []
    spark.createDataFrame(rows, "position int, term string, idf double").write.mode("overwrite").parquet(f"{path}/terms")
    slots = [(i, s, float(w)) for i, (s, w) in enumerate(zip([*model.encoder.slots, "(intercept)"], [*model.coefficients, model.intercept]))]
    table = spark.createDataFrame(slots, "position int, slot string, coefficient double")
    table.withColumn("text_column", F.lit(model.encoder.text_column)).write.mode("overwrite").parquet(f"{path}/slots")


def load_model(spark, path: str) -> linear.LogModel:
    import numpy as np
    from pyspark.ml import PipelineModel

    from paddock.models.frame import Encoder
    from paddock.models.tfidf import TfidfModel

    terms = spark.read.parquet(f"{path}/terms").orderBy("position").collect()
    *slots, last = spark.read.parquet(f"{path}/slots").orderBy("position").collect()
    text = TfidfModel([r["term"] for r in terms], [r["idf"] for r in terms]) if terms else None
    encoder = Encoder(PipelineModel.load(f"{path}/encoder"), text, last["text_column"], [r["slot"] for r in slots])
    return linear.LogModel(encoder, np.array([r["coefficient"] for r in slots]), last["coefficient"])


def ablation_scores(
    gold: DataFrame,
    feature: str = "price_inflation_factor",
    model: str = "ridge",
    seeds: Sequence[int] = ABLATION_SEEDS,
    key: str = "URL",
    options: dict | None = None,
) -> DataFrame:
    """(seed, use_feature, mae) of one model with and without one feature, per split seed."""
    frame, roles = feature_frame(gold, (key,))
    frame, rows = cut_lineage(frame), []
    for seed in seeds:
        train, test = holdout(frame, key, seed)
        for use in (True, False):
            columns = roles if use else roles.without(feature)
            scored = MODELS[model](train, test, columns, options or {})
            error = F.avg(F.abs(F.col(TARGET) - F.col("predicted_price_eur")))
            rows.append((seed, use, scored.agg(error.alias("mae")).first()["mae"]))
    return gold.sparkSession.createDataFrame(rows, "seed int, use_feature boolean, mae double")
