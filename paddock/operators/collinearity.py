"""Variance inflation and correlation from sums gathered by Spark."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations, combinations_with_replacement

import numpy as np
from pyspark.sql import DataFrame, functions as F

from paddock.functions.numeric import number
from paddock.functions.stats import exact_quantiles


def design_matrix(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """Median-filled numbers and 0/1 columns per level, the first level dropped."""
    values = df.select(*[number(df, c).alias(c) for c in numeric]).unpivot([], list(numeric), "column", "v")
    medians = {r["column"]: r["m"] for r in exact_quantiles(values, F.col("v"), {"m": 0.5}, ["column"]).collect()}
    columns = [F.coalesce(number(df, c), F.lit(medians.get(c))).alias(c) for c in numeric]
    for c in categorical:
        levels = sorted(
            r[0] for r in df.select(F.col(f"`{c}`").cast("string")).where(F.col(f"`{c}`").isNotNull()).distinct().collect()
        )
        for level in levels[1:]:
            columns.append(F.coalesce(F.col(f"`{c}`") == level, F.lit(False)).cast("double").alias(f"{c}_{level}"))
    return df.select(*columns)


def gram(matrix: DataFrame) -> DataFrame:
    """Sums of products of every column pair (a, b, value), in one aggregate."""
    pairs = list(combinations_with_replacement(matrix.columns, 2))
    sums = matrix.agg(
        *[F.sum(F.col(f"`{a}`") * F.col(f"`{b}`")).alias(f"g{i}") for i, (a, b) in enumerate(pairs)]
    )
    rows = F.array(
        *[
            F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"g{i}").alias("value"))
            for i, (a, b) in enumerate(pairs)
        ]
    )
    return sums.select(F.inline(rows))


def vif(matrix: DataFrame) -> DataFrame:
    """Uncentred variance inflation per column; only the k by k sums reach the driver."""
    names = matrix.columns
    at = {c: i for i, c in enumerate(names)}
    g = np.zeros((len(names), len(names)))
    for r in gram(matrix).collect():
        g[at[r["a"]], at[r["b"]]] = g[at[r["b"]], at[r["a"]]] = r["value"]
    # scaled to a unit diagonal first: the columns differ by many orders of magnitude
    scale = np.sqrt(np.diag(g))
    scale[scale == 0] = 1.0
    inverse = np.linalg.pinv(g / np.outer(scale, scale), hermitian=True)
    rows = [(c, float(inverse[i, i] * (g[i, i] / scale[i] ** 2))) for c, i in at.items()]
    return matrix.sparkSession.createDataFrame(rows, "feature string, vif double").orderBy(F.col("vif").desc())


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair, over the rows where both are present."""
    present = [c for c in columns if c in df.columns]
    pairs = list(combinations(present, 2))
    numbers = df.select(*[number(df, c).alias(c) for c in present])
    row = numbers.agg(*[F.corr(F.col(f"`{a}`"), F.col(f"`{b}`")).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    rows = F.array(
        *[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{i}").alias("corr")) for i, (a, b) in enumerate(pairs)]
    )
    return row.select(F.inline(rows))
