"""Session setup for local runs, and lineage cuts that survive executor loss."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# The JVM compiles no method of more bytes than this, it interprets them.
COMPILED_BYTES = "8000"
METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


def local_session(cpus: str = "8", app: str = "paddock", partitions: str | None = None) -> SparkSession:
    """A session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", partitions or cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("PADDOCK_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` into the shared folder named by ``spark.checkpoint.dir``.

    Model fits read their frame many times; a reliable checkpoint keeps an
    executor loss from replaying the whole job. A local session that names no
    folder gets one of its own; on a cluster that is an error, as executors
    would write to different disks.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if not spark.conf.get("spark.checkpoint.dir", "") and context.getCheckpointDir() is None:
        context.setCheckpointDir(_local_folder(spark, "checkpoint"))
    return df.checkpoint(eager=True)


def _local_folder(spark: SparkSession, name: str) -> str:
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix=f"paddock-{name}-")


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for written tables: in the cluster's shared folder, else a local one."""
    shared = spark.conf.get("spark.checkpoint.dir", "")
    if shared:
        return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    return _local_folder(spark, name)


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """Plans run meanwhile use whole-stage code only where the JVM compiles it; wide projections are split into small methods instead.

    A limit that the session has set below Spark's own stays; the former one comes back at the end.
    """
    former = spark.conf.get(METHOD_LIMIT)
    spark.conf.set(METHOD_LIMIT, str(min(int(former), int(COMPILED_BYTES))))
    try:
        yield
    finally:
        spark.conf.set(METHOD_LIMIT, former)
