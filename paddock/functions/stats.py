"""Whole-table statistics, exact quantiles and key-hash buckets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def one_row(df: DataFrame, **aggregates: Column) -> Column:
    """Aggregate ``df`` to one row and offer it as a scalar-subquery struct.

    The struct can be used in any projection or filter, so a whole-table
    statistic needs neither a join nor an unpartitioned window.
    """
    stats = df.agg(*[column.alias(name) for name, column in aggregates.items()])
    return stats.select(F.struct(*[F.col(name) for name in aggregates]).alias("stats")).scalar()


def hash_bucket(key: Column, seed: int, buckets: int) -> Column:
    """Bucket 0..buckets-1 from the first 8 hex digits of md5(key|seed)."""
    digest = F.md5(F.concat_ws("|", key.cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % F.lit(buckets)


# Cells of the quantile histogram: steps between two powers of two. A double has
# some 2100 powers of either sign, so one group never has more than ~17 million
# cells, and ordinary data some ten thousand. Small numbers have as many as large.
_STEPS = 4096


def _cell(value: Column) -> Column:
    """Number of the cell of a double that is no NaN, in the order of the values.

    The power of two and the steps above it. The power is put right where the
    logarithm was rounded over it, so the order holds at powers of two as well.
    """
    size = F.abs(value)
    guess = F.floor(F.log2(size))
    power = guess + F.when(size >= F.pow(F.lit(2.0), guess + 1), 1).when(size < F.pow(F.lit(2.0), guess), -1).otherwise(0)
    steps = F.floor((size / F.pow(F.lit(2.0), power) - 1.0) * _STEPS)
    number = (power + 1100) * _STEPS + F.least(F.greatest(steps, F.lit(0)), F.lit(_STEPS - 1)) + 1
    finite = F.when(size < F.lit(2.0**-1000), F.lit(1)).when(size == float("inf"), F.lit(1 << 30)).otherwise(number)
    return F.coalesce(F.when(value == 0, F.lit(0)).otherwise(finite * F.signum(value)).cast("bigint"), F.lit(0).cast("bigint"))


def exact_quantiles(
    df: DataFrame, value: Column, quantiles: Mapping[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """Exact linearly interpolated quantiles per group, without gathering a group.

    1. equal values collapse to (value, count) on the map side;
    2. a histogram over cells of equal relative width finds, by running totals over the few
       cells, which cell holds each wanted rank;
    3. only values in those cells are ordered to pick the ranks.
    """
    by = list(by)
    # never NULL, so the join below infers no extra filter and both uses of
    # ``counts`` share one shuffle
    cell = _cell(F.col("__v"))
    counts = (
        df.select(*[F.col(f"`{c}`").alias(f"__g{i}") for i, c in enumerate(by)],
                  value.cast("double").alias("__v"))
        .where(F.col("__v").isNotNull() & ~F.isnan("__v"))
        .withColumn("__v", F.col("__v") + F.lit(0.0))
        .groupBy(*[f"__g{i}" for i in range(len(by))], "__v")
        .agg(F.count(F.lit(1)).alias("__c"))
        .withColumn("__cell", cell)
    )
    groups = [f"__g{i}" for i in range(len(by))]
    whole = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    running = whole.orderBy("__cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    position = {name: F.lit(float(q)) * (F.col("__n") - 1) for name, q in quantiles.items()}
    wanted = F.array_distinct(
        F.array(*[f(p).cast("bigint") for p in position.values() for f in (F.floor, F.ceil)])
    )
    cells = (
        counts.groupBy(*groups, "__cell")
        .agg(F.sum("__c").alias("__in"))
        .withColumn("__n", F.sum("__in").over(whole))
        .withColumn("__base", F.sum("__in").over(running) - F.col("__in"))
        .withColumn("__ranks", wanted)
        .where(
            F.exists(
                "__ranks",
                lambda r: (r >= F.col("__base")) & (r < F.col("__base") + F.col("__in")),
            )
        )
        .select(*groups, "__cell", "__n", "__base")
    )
    left, right = counts.alias("l"), cells.alias("r")
    on = F.col("l.__cell") == F.col("r.__cell")
    for g in groups:
        on = on & F.col(f"l.{g}").eqNullSafe(F.col(f"r.{g}"))
    inside = (
        Window.partitionBy(*groups, "__cell")
        .orderBy("__v")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    picked = (
        left.join(right, on)
        .select(*[F.col(f"l.{g}").alias(g) for g in groups], "l.__cell", "__v", "__c", "__n", "__base")
        .withColumn("__end", F.col("__base") + F.sum("__c").over(inside))
        .withColumn("__start", F.col("__end") - F.col("__c"))
    )

    def at(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("__start")) & (rank < F.col("__end")), F.col("__v")))

    ends = []
    for i, p in enumerate(position.values()):
        ends += [
            at(F.floor(p)).alias(f"__lo{i}"),
            at(F.ceil(p)).alias(f"__hi{i}"),
            F.max(p - F.floor(p)).alias(f"__f{i}"),
        ]
    return (
        picked.groupBy(*groups)
        .agg(*ends)
        .select(
            *[F.col(g).alias(c) for g, c in zip(groups, by)],
            *[
                # equal ends keep infinities from turning into NaN
                F.when(F.col(f"__lo{i}") == F.col(f"__hi{i}"), F.col(f"__lo{i}"))
                .otherwise(
                    F.col(f"__lo{i}") + (F.col(f"__hi{i}") - F.col(f"__lo{i}")) * F.col(f"__f{i}")
                )
                .alias(name)
                for i, name in enumerate(quantiles)
            ],
        )
    )


def join_groups(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Join two per-group results, NULL groups matching each other."""
    renamed = right.select(
        *[F.col(f"`{c}`").alias(f"__r_{i}") for i, c in enumerate(by)],
        *[F.col(f"`{c}`") for c in right.columns if c not in by],
    )
    on = F.lit(True)
    for i, c in enumerate(by):
        on = on & F.col(f"`{c}`").eqNullSafe(F.col(f"__r_{i}"))
    return left.join(renamed, on, "left").drop(*[f"__r_{i}" for i in range(len(by))])
