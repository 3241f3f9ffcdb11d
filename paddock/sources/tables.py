"""Reading and writing tables by file extension, snapshots and run outputs."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from paddock.functions.numeric import sanitize_nonfinite

FORMATS = {".csv": "csv", ".parquet": "parquet", ".json": "json"}
# listing texts span lines, quote by doubling and keep their blanks
CSV_OPTIONS = {
    "header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}
PREDICTION_COLUMNS = ("row_index", "model_name", "actual_price_eur", "predicted_price_eur", "residual_eur")


def _format(path: str, file_type: str | None) -> str:
    kind = (file_type or os.path.splitext(path.rstrip("/"))[1]).lower()
    kind = kind if kind.startswith(".") else f".{kind}"
    if kind not in FORMATS:
        raise ValueError(f"Unsupported file type: {kind}")
    return FORMATS[kind]


def load_table(
    spark: SparkSession,
    path: str,
    file_type: str | None = None,
    schema: T.StructType | str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Table at ``path``; csv and json should come with a schema, else Spark reads them twice.

    ``multi_line`` reads csv fields with line breaks; such a file cannot be split between tasks.
    """
    kind = _format(path, file_type)
    reader = spark.read.format(kind)
    if kind == "csv":
        reader = reader.options(**CSV_OPTIONS, multiLine=multi_line, inferSchema=schema is None)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def save_table(df: DataFrame, path: str, file_type: str | None = None, mode: str = "overwrite") -> str:
    kind = _format(path, file_type)
    writer = df.write.mode(mode).format(kind)
    if kind == "csv":
        writer = writer.options(**CSV_OPTIONS)
    writer.save(path)
    return path


def write_snapshot(df: DataFrame, path: str, run_ts: str) -> None:
    """Keep ``df`` as the snapshot of ``run_ts`` next to the earlier ones.

    Only that partition is replaced, so a repeated write leaves one copy.
    """
    (
        df.withColumn("run_ts", F.lit(run_ts))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_ts")
        .parquet(path)
    )


def latest_snapshot(df: DataFrame, stamp: str = "run_ts") -> DataFrame:
    """Rows of the newest snapshot; on partitioned files only that folder is read."""
    newest = df.agg(F.max(stamp).alias("newest")).scalar()
    return df.where(F.col(stamp) == newest)


def newest_run(spark: SparkSession, results_dir: str) -> DataFrame:
    """(run_dir, modified_at) of the newest ``*/predictions.csv``; no rows if there is none."""
    files = spark.read.format("binaryFile").load(f"{results_dir}/*/predictions.csv")
    return (
        files.select(
            F.regexp_extract("path", r"^(.*)/predictions\.csv(/|$)", 1).alias("run_dir"),
            F.col("modificationTime").alias("modified_at"),
        )
        .groupBy("run_dir")
        .agg(F.max("modified_at").alias("modified_at"))
        .orderBy(F.col("modified_at").desc(), "run_dir")
        .limit(1)
    )


def write_predictions(df: DataFrame, path: str) -> None:
    """Predictions as CSV with the fixed columns; missing ones stay empty."""
    columns = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in PREDICTION_COLUMNS]
    df.select(*columns).write.mode("overwrite").option("header", True).csv(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """One JSON line per model, fields in name order, non-finite numbers as null."""
    columns = sorted(metrics.columns)
    clean = sanitize_nonfinite(metrics).select(*columns)
    # few rows: one file
    clean.coalesce(1).sortWithinPartitions("model_name").write.mode("overwrite").option(
        "ignoreNullFields", False
    ).json(path)


def write_skipped(skipped: DataFrame, path: str) -> None:
    skipped.select("model_name", "reason").coalesce(1).sortWithinPartitions("model_name").write.mode("overwrite").json(path)


def write_views(df: DataFrame, path: str, residual: str = "residual_eur") -> None:
    """All results, the underpriced and the overpriced, each sorted by residual."""
    views = F.array_compact(
        F.array(
            F.lit("all_results"),
            F.when(F.col("actual_price_eur") < F.col("pred_lower"), F.lit("underpriced")),
            F.when(F.col("actual_price_eur") > F.col("pred_upper"), F.lit("overpriced")),
        )
    )
    (
        df.withColumn("view", F.explode(views))
        .repartitionByRange("view", residual)
        .sortWithinPartitions("view", residual)
        .write.mode("overwrite")
        .partitionBy("view")
        .parquet(path)
    )


def round_trip_counts(df: DataFrame, folder: str, schema: T.StructType) -> DataFrame:
    """Rows and a checksum of ``df`` after writing and reading every format."""
    parts = []
    for suffix, kind in FORMATS.items():
        path = save_table(df, f"{folder}/copy{suffix}")
        back = load_table(df.sparkSession, path, schema=schema, multi_line=True)
        parts.append(back.select(F.lit(kind).alias("format"), *schema.fieldNames()))
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part)
    return both


def add_position(df: DataFrame, order: str) -> DataFrame:
    """Number few rows 0..n-1 in ``order``."""
    return df.withColumn("position", F.row_number().over(Window.orderBy(order)) - 1)
