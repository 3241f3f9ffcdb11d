"""Mixing sources to target weights by subset-sum budget fitting (operator 5).

Every source's target is met by whole documents: all of them as often as the target allows, and for the
remaining budget a subset whose words add up to it. Documents are counted by exact length; every length first
gives its share of the budget, rounded down, and a bounded-knapsack dynamic programme over the remaining
counts closes the gap. Which documents of a length are taken follows from a seeded hash, so reruns agree.

Only counts by (source, length) and by (source, length, hash prefix) are gathered, never documents: a source or
a length that holds a third of all rows is selected by hash prefixes, 256 at a time. A source's counts by
length meet in one task; there are as many as it has different lengths.

Very long texts are single documents of many words: where few such are left, the sums that they reach are listed one by one.
Null texts have size 0 and are never taken. The null source is a source, last in order. Rows that are equal in id
and text are taken one by one; an empty table gives an empty table.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from paddock.llm.common import fresh, utf8
from paddock.session import cut_lineage

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2
SEED = 20_240_517
WINDOW = 1 << 16  # units of budget that the dynamic programme keeps as bits
FEW_SUMS = 1 << 18  # sums of subsets that are kept as a list
EXCHANGED = 18  # documents that may be taken in or put back at the end, their subsets all tried
RESULTS = ("size", "source_size", "target", "copies")
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str) -> Column:
    return F.coalesce(F.expr(f"regexp_count(`{text}`, '{WORD}')".replace("\\", "\\\\")), F.lit(0)).cast("long")


def source_targets(totals: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target) of (source, source_size): weights repeat over sources by code point, null last.

    One row for each source. The excess over ``most`` times a source's size is dealt anew by weight until no
    target is above; each round is one aggregate.
    """
    spread = totals.repartitionByRange(F.col("source").isNull(), "source").withColumn("part", F.spark_partition_id())
    within = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    numbered = cut_lineage(spread.withColumn("number", F.row_number().over(within) - 1))
    parts = numbered.groupBy("part").agg(F.count("*").alias("rows"))  # a row for each partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("number") + F.col("offset")) % len(weights) + 1).cast("int"))
    weighed = cut_lineage(numbered.join(parts, "part").select("source", "source_size", weight.alias("weight")))
    words = weighed.agg(F.sum("source_size")).first()[0] or 0
    rate, capped = 0.0, None
    while True:
        over = F.lit(False) if capped is None else F.col("weight") * rate >= most * F.col("source_size")
        number, full, weight_left = weighed.agg(
            F.sum(over.cast("long")), F.sum(F.when(over, most * F.col("source_size")).otherwise(0.0)), F.sum(F.when(~over, F.col("weight")).otherwise(0.0))
        ).first()
        if number == capped or not weight_left:
            break
        capped, rate = number, (share * words - full) / weight_left
    return weighed.select("source", "source_size", F.least(F.col("weight") * rate, most * F.col("source_size").cast("double")).alias("target"))


def closest_sum(sizes: list[int], counts: list[int], budget: int) -> list[int]:
    """How many of each size to take so that the sum comes as near to ``budget`` from below as it can.

    Bounded knapsack: reachable sums are the bits of one integer, counts are split into powers of two.
    """
    mask, reached = (1 << budget + 1) - 1, 1
    items: list[tuple[int, int]] = []
    made_by: dict[int, int] = {}
    for at, (size, count) in enumerate(zip(sizes, counts)):
        count = min(count, budget // size)
        step = 1
        while count and not reached >> budget & 1:
            step = min(step, count)
            new = reached << size * step & mask & ~reached
            reached |= new
            while new:
                low = new & -new
                made_by[low.bit_length() - 1] = len(items)
                new ^= low
            items.append((at, step))
            count, step = count - step, step * 2
    taken = [0] * len(sizes)
    total = reached.bit_length() - 1
    while total:
        at, step = items[made_by[total]]
        taken[at] += step
        total -= sizes[at] * step
    return taken


def sparse_sums(items: list[tuple[int, int, int]], most: int) -> tuple[np.ndarray, np.ndarray] | None:
    """All sums of subsets of (change, at, step) items, rising, and the item that made each first; None beyond ``most`` sums."""
    sums, maker = np.zeros(1, np.int64), np.full(1, -1)
    for number, (change, _, _) in enumerate(items):
        new = np.setdiff1d(sums + change, sums, assume_unique=True)
        if len(sums) + len(new) > most:
            return None
        order = np.argsort(both := np.concatenate([sums, new]), kind="stable")
        sums, maker = both[order], np.concatenate([maker, np.full(len(new), number)])[order]
    return sums, maker


def nearest(items: list[tuple[int, int, int]], goal: int, most: int) -> list[tuple[int, int, int]] | None:
    """The items whose changes add up to the sum nearest to ``goal``, the lower of two; None beyond ``most`` sums."""
    found = sparse_sums(items, most)
    if found is None:
        return None
    sums, maker = found
    at, chosen = int(np.abs(sums - goal).argmin()), []
    while maker[at] >= 0:
        chosen.append(items[maker[at]])
        at = int(np.searchsorted(sums, sums[at] - items[maker[at]][0]))
    return chosen


def split_counts(sizes: list[int], counts: list[int]) -> list[tuple[int, int, int]]:
    """(words, which size, how many) by powers of two, so that their subsets give every number up to a count."""
    items = []
    for at, (size, count) in enumerate(zip(sizes, counts)):
        step = 1
        while count > 0:
            step = min(step, count)
            items.append((size * step, at, step))
            count, step = count - step, step * 2
    return items


def exchange(sizes: list[int], counts: list[int], taken: list[int], rest: int) -> list[int]:
    """Takes in and puts back up to EXCHANGED documents so that what is missing gets as small as it can."""
    by_size = sorted(range(len(sizes)), key=lambda i: abs(sizes[i] - rest))
    more = [(sizes[i], i, 1) for i in by_size if taken[i] < counts[i]]
    less = [(-sizes[i], i, -1) for i in by_size if taken[i]]
    half = EXCHANGED // 2
    items = more[: max(half, EXCHANGED - len(less))] + less[: max(half, EXCHANGED - len(more))]
    taken = list(taken)
    for _, at, step in nearest(items, rest, 1 << len(items)) or []:
        taken[at] += step
    return taken


def fit_budget(sizes: list[int], counts: list[int], budget: int) -> list[int]:
    """How many documents of each size (ascending, above 0) to take for ``budget`` words, a few more or less if no subset has just as many.

    In units of the sizes' common divisor. The sums that subsets reach are kept as bits where the budget is small, as a sorted
    list where documents are few; both are exact. Where both are too many, sizes give their share of the budget, the
    dynamic programme closes what is left, and exchanges of single documents what even that leaves; of a budget over half of
    all words the part left out is fitted so, and what cannot be met is then taken on top.
    """
    unit = math.gcd(*sizes) if sizes else 1
    sizes, (budget, over) = [s // unit for s in sizes], divmod(budget, unit)
    budget += 2 * over > unit
    total = sum(s * c for s, c in zip(sizes, counts))
    if not budget:
        return [0] * len(sizes)
    if budget >= total:
        return list(counts)
    few = nearest(split_counts(sizes, [min(c, budget // s + 1) for s, c in zip(sizes, counts)]), budget, FEW_SUMS)
    if few is not None:
        taken = [0] * len(sizes)
        for _, at, step in few:
            taken[at] += step
        return taken
    if 2 * budget > total:  # what is left out is the smaller part, and easier to fit
        return [c - n for c, n in zip(counts, fit_budget(sizes, counts, total - budget))]
    taken = [c * budget // total for c in counts]
    rest = budget - sum(s * t for s, t in zip(sizes, taken))
    # nearest to their next document first, then large ones, until the programme's window is reached
    by_need = sorted(range(len(sizes)), key=lambda i: (-(counts[i] * budget % total), sizes[i]))
    for i in by_need:
        if rest - sizes[i] >= WINDOW // 2 and taken[i] < counts[i]:
            taken[i] += 1
            rest -= sizes[i]
    for keep in (WINDOW // 2, 0):
        for i in reversed(range(len(sizes))):
            if rest <= WINDOW:
                break
            more = min(counts[i] - taken[i], max(0, rest - keep) // sizes[i])
            taken[i] += more
            rest -= more * sizes[i]
    if rest <= WINDOW:
        extra = closest_sum(sizes, [c - t for c, t in zip(counts, taken)], rest)
        taken = [t + e for t, e in zip(taken, extra)]
    if budget <= WINDOW and sum(s * t for s, t in zip(sizes, taken)) < budget:
        return closest_sum(sizes, counts, budget)
    for _ in range(3):
        rest = budget - sum(s * t for s, t in zip(sizes, taken))
        if not rest:
            break
        taken = exchange(sizes, counts, taken, rest)
    return taken


def mix(df: DataFrame, id_column: str, text: str, source: str, seed: int = SEED) -> DataFrame:
    """``df`` with size, source_size, target and copies (how often the mix takes the row, 0 to MOST).

    These replace columns of their names; ``common.set_aside`` keeps such columns.
    """
    df = df.drop(*RESULTS)
    mark, b1, b2, s, z, p1, p2, extra, whole_name = (fresh(f"mix_{n}", df) for n in ("hash", "b1", "b2", "s", "z", "p1", "p2", "extra", "whole"))
    sized = df.withColumn("size", word_count(text)).withColumn(mark, F.xxhash64(F.lit(seed), f"`{id_column}`", F.xxhash64(utf8(text))))
    sized = sized.withColumns({b: F.shiftrightunsigned(mark, shift).bitwiseAND(F.lit(255)) for b, shift in ((b1, 56), (b2, 48))})
    counts = sized.groupBy(F.col(f"`{source}`").alias("source"), "size", F.col(b1).alias("b1"), F.col(b2).alias("b2")).agg(F.count("*").alias("n"))
    counts = cut_lineage(counts)
    by_prefix = counts.groupBy("source", "size", "b1").agg(F.sum("n").alias("n"))
    by_size = by_prefix.groupBy("source", "size").agg(F.sum("n").alias("n"))
    targets = cut_lineage(source_targets(by_size.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))))
    # how often the whole source is taken, and the words that are still missing then
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = targets.withColumn("whole", F.least(whole, F.lit(MOST)).cast("long"))
    targets = targets.withColumn("missing", F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("long"))
    named = targets.withColumnRenamed("source", "target_source")
    joined = by_size.join(named, by_size["source"].eqNullSafe(named["target_source"])).drop("target_source")

    def fit(frame):
        frame = frame.sort_values("size", ignore_index=True)
        full = (frame["size"] > 0).to_numpy()
        extra = fit_budget(frame["size"][full].tolist(), frame["n"][full].tolist(), int(frame["missing"].iloc[0]))
        frame["extra"] = 0
        frame.loc[full, "extra"] = extra
        return frame[["source", "size", "extra", "source_size", "target", "whole"]]

    fitted = joined.groupBy("source").applyInPandas(fit, "source string, size long, extra long, source_size long, target double, whole long")
    fitted = cut_lineage(fitted.withColumnsRenamed({"source": "s", "size": "z"}))

    def lowest(rows: DataFrame, keys: list[str], prefix: str, need: str) -> DataFrame:
        """Of the documents that a group needs, how many come from each of its prefixes, lowest first."""
        before = Window.partitionBy(*keys).orderBy(prefix).rowsBetween(Window.unboundedPreceding, -1)
        left = F.col(need) - F.coalesce(F.sum("n").over(before), F.lit(0))
        return rows.withColumn(need, F.greatest(F.lit(0), F.least(left, F.col("n"))))

    first = by_prefix.join(fitted, by_prefix["source"].eqNullSafe(fitted["s"]) & (by_prefix["size"] == fitted["z"])).drop("s", "z")
    first = lowest(first, ["source", "size"], "b1", "extra").drop("n").withColumnsRenamed({"source": "s", "size": "z", "b1": "p"})
    second = counts.join(first, counts["source"].eqNullSafe(first["s"]) & (counts["size"] == first["z"]) & (counts["b1"] == first["p"]))
    second = lowest(second.drop("s", "z", "p"), ["source", "size", "b1"], "b2", "extra").drop("n")
    chosen = second.withColumnsRenamed({"source": s, "size": z, "b1": p1, "b2": p2, "extra": extra, "whole": whole_name})
    same = sized[source].eqNullSafe(chosen[s]) & (sized["size"] == chosen[z]) & (sized[b1] == chosen[p1]) & (sized[b2] == chosen[p2])
    rows = sized.join(chosen, same).drop(s, z, p1, p2)
    rank = F.row_number().over(Window.partitionBy(f"`{source}`", "size", b1, b2).orderBy(mark))
    copies = F.col(whole_name) + (rank <= F.col(extra)).cast("long")
    return rows.withColumn("copies", copies).drop(whole_name, extra, mark, b1, b2)
