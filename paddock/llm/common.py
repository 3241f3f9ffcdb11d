"""Helpers shared by the operators: texts as bytes, batches of bounded size, connected components."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from paddock.session import cut_lineage

BATCH_BYTES = 4 << 20  # texts handled together in one Python step


def fresh(name: str, *frames: DataFrame) -> str:
    """A column name that none of the frames has, whatever the letters' case."""
    taken = {c.lower() for frame in frames for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def set_aside(df: DataFrame, *names: str) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with columns of these names, in any case, under other names, and these by the name they had."""
    moved: dict[str, str] = {}
    for c in df.columns:
        if c.lower() in {n.lower() for n in names}:
            moved[c] = fresh(f"own_{c}", df)
            df = df.withColumnRenamed(c, moved[c])
    return df, moved


def utf8(column: str | Column) -> Column:
    """A text column as UTF-8 bytes, null as no bytes."""
    value = F.col(f"`{column}`") if isinstance(column, str) else column
    return F.coalesce(value.cast("binary"), F.lit(b""))


def scanned(df: DataFrame, scan: Callable[[list[bytes]], dict[str, Iterable]], text: Column, results: str, keep: dict[str, Column], batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Add what ``scan`` finds in the texts of a batch, one value for each text.

    ``scan`` gets at most ``batch_bytes`` of texts at a time (or one longer text) and returns a list or array
    for each column of ``results``, a schema string. ``keep`` names the columns that are carried along.
    The step reads each row once, needs no shuffle, and holds one Arrow batch and its results.
    """
    source = fresh("text_bytes", df)
    added = T._parse_datatype_string(results)
    frame = df.select(*[c.alias(n) for n, c in keep.items()], utf8(text).alias(source))
    schema = T.StructType([*[f for f in frame.schema.fields if f.name != source], *added.fields])
    width = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        for batch in batches:
            texts = batch.column(width)
            start = size = 0
            for end in range(1, len(texts) + 1):
                size += len(texts[end - 1].as_buffer())
                if end == len(texts) or size + len(texts[end].as_buffer()) > batch_bytes:
                    part = batch.slice(start, end - start)
                    found = scan(part.column(width).to_pylist())
                    arrays = [part.column(i) for i in range(width)]
                    arrays += [pa.array(found[f.name], type=target.field(width + i).type) for i, f in enumerate(added.fields)]
                    yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, target)], schema=target)
                    start, size = end, 0

    return frame.mapInArrow(run, schema)


def components(edges: DataFrame) -> DataFrame:
    """Smallest node of each connected component: (node, root) for every node of ``edges`` (a, b).

    Alternating large-star and small-star steps: each node's larger neighbours, then its smaller ones, are
    linked to the smallest node it knows, until nothing changes (a logarithmic number of rounds). Minima
    are pre-aggregated, so a node with very many links costs no more than others; only two numbers of
    each round reach the driver. Every round is checkpointed.
    """
    links = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    links, before = cut_lineage(links), None
    while True:
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        both = links.union(links.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        links = cut_lineage(small.union(least.select("u", F.col("m").alias("v"))).distinct())
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def forest(a, b, size: int):
    """For each of ``size`` nodes the smallest node reachable over the pairs (a[i], b[i]); numpy arrays."""
    import numpy as np

    root = np.arange(size)
    while len(a):
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low != high
        if not apart.any():
            break
        a, b, low, high = a[apart], b[apart], low[apart], high[apart]
        np.minimum.at(root, high, low)
        while True:
            nearer = root[root]
            if (nearer == root).all():
                break
            root = nearer
    return root


def scratch(spark, name: str) -> str:
    """A fresh folder for a written table in the folder that driver and executors share."""
    from paddock.session import work_folder

    return work_folder(spark, f"{name}-{uuid.uuid4().hex[:8]}")
