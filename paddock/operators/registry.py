"""Run registry: append, latest run, history, best run per model, fallback."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from paddock.functions.ranking import first_per_key
from paddock.functions.stats import one_row

METRICS = ("mae_eur", "median_ae", "mape", "within_10", "within_15")
KEY = ["run_id", "model_name"]


def next_run_id(runs: DataFrame) -> Column:
    return F.coalesce(one_row(runs, id=F.max("id"))["id"], F.lit(0)) + 1


def append_run(runs: DataFrame, run: DataFrame) -> DataFrame:
    """Registry with one more run, numbered after the last."""
    return runs.unionByName(run.withColumn("id", next_run_id(runs)), allowMissingColumns=True)


def append_unique(stored: DataFrame, offered: DataFrame, order: str = "insert_order") -> DataFrame:
    """Offered rows whose (run, model) is not stored yet, the first of equal keys, after the stored ones."""
    first = first_per_key(offered, KEY, [F.col(order)])
    return stored.unionByName(first.join(stored.select(*KEY), KEY, "left_anti"))


def unique_rows(offered: DataFrame, order: str = "insert_order") -> DataFrame:
    """What an empty registry holds after storing ``offered``."""
    return first_per_key(offered, KEY, [F.col(order)]).drop(order)


def latest_run(runs: DataFrame, metrics: DataFrame, skips: DataFrame) -> DataFrame:
    """The run with the highest id, with its metrics and skips as maps by model.

    Only that run's rows are collected into the maps: one per model.
    """
    last = runs.orderBy(F.col("id").desc()).limit(1)
    newest = one_row(runs, id=F.max("id"))["id"]
    by_model = metrics.where(F.col("run_id") == newest).groupBy("run_id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("model_name", F.struct(*METRICS))))).alias("metrics")
    )
    skipped = skips.where(F.col("run_id") == newest).groupBy("run_id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("model_name", "reason")))).alias("skipped")
    )
    return (
        last.join(by_model.withColumnRenamed("run_id", "id"), "id", "left")
        .join(skipped.withColumnRenamed("run_id", "id"), "id", "left")
    )


def run_history(runs: DataFrame, metrics: DataFrame) -> DataFrame:
    """Every run with the number of its models."""
    counts = metrics.groupBy(F.col("run_id").alias("id")).agg(F.count("model_name").alias("model_count"))
    return (
        runs.join(counts, "id", "left")
        .withColumn("model_count", F.coalesce("model_count", F.lit(0)))
        .orderBy("id")
    )


def best_run_summary(runs: DataFrame, metrics: DataFrame, skips: DataFrame) -> DataFrame:
    """Per model its run of least MAE (newest first on ties) and how many models that run skipped."""
    scored = metrics.join(runs, F.col("run_id") == F.col("id"))
    best = first_per_key(
        scored, ["model_name"], [F.col("mae_eur"), F.col("created_at").desc(), F.col("id").desc()]
    ).drop("id")
    counts = skips.groupBy("run_id").agg(F.count(F.lit(1)).alias("skipped_count"))
    return (
        best.join(counts, "run_id", "left")
        .withColumn("skipped_count", F.coalesce("skipped_count", F.lit(0)))
        .orderBy("mae_eur", "model_name")
    )


def best_run_skips(summary: DataFrame, skips: DataFrame) -> DataFrame:
    """Per selected run its (model, reason) pairs in model order; no skips give an empty list."""
    selected = summary.select("run_id").distinct()
    pairs = (
        skips.join(selected, "run_id", "left_semi")
        .groupBy("run_id")
        .agg(F.array_sort(F.collect_list(F.struct("model_name", "reason"))).alias("skipped_models"))
    )
    empty = F.array().cast("array<struct<model_name: string, reason: string>>")
    return selected.join(pairs, "run_id", "left").withColumn("skipped_models", F.coalesce("skipped_models", empty))


def run_fallback(runs: DataFrame, readable: DataFrame) -> DataFrame:
    """The newest registry run if its outputs can be read, else the newest output folder, else no row.

    ``readable`` lists (output_dir, modified_at) of folders with predictions.
    """
    last = runs.orderBy(F.col("id").desc()).limit(1)
    registered = last.join(readable, "output_dir", "left_semi").select(
        F.lit(0).alias("__priority"), "output_dir", F.lit("registry").alias("origin")
    )
    newest = (
        readable.orderBy(F.col("modified_at").desc(), F.col("output_dir").desc())
        .limit(1)
        .select(F.lit(1).alias("__priority"), "output_dir", F.lit("filesystem").alias("origin"))
    )
    return registered.unionByName(newest).orderBy("__priority").limit(1).drop("__priority")
