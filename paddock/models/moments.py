"""Sufficient statistics of encoded rows, and penalised regressions solved from them alone.

One pass over the rows gives every product sum of two features, of a feature and the target, and of the target: for each
fold a symmetric matrix with two more slots than features, a constant one and the target. Fits, penalty paths and
cross-validation work on these matrices; a fold's training part is the total without the fold. No fit reads the rows again.

A fold's matrix is summed by blocks of its rows: a task holds one block (``BLOCK_BYTES``), reads its part of the fold's rows one by one in
sparse form, and hands the block's rows on to be added up. What is handed on is one matrix for each task of a fold, so there are no more
of them than cores, all folds together, whatever the partitions, and no more than the work asks for.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from paddock.session import cut_lineage

SLOTS, VALUES, FOLD = "__slots", "__values", "__fold"
BLOCK_BYTES = 96 << 20
PAIRS_AT_ONCE = 1_000_000


def unpacked(vector: Column) -> tuple[Column, Column]:
    """Slots and values of an MLlib vector, dense or sparse, as arrays; values of zero may be among them."""
    plain = F.unwrap_udt(vector)
    values = F.coalesce(plain["values"], F.array().cast("array<double>"))
    every = F.when(F.size(values) > 0, F.sequence(F.lit(0), F.size(values) - 1)).otherwise(F.array().cast("array<int>"))
    return F.when(plain["type"] == 1, every).otherwise(plain["indices"]), values


def dot(coefficients: np.ndarray, slots: str = SLOTS, values: str = VALUES) -> Column:
    """Sum of the values times their slots' coefficients."""
    # read back from text to the last bit; the optimizer folds it into one array
    table = F.split(F.lit(",".join(map(repr, map(float, coefficients)))), ",").cast("array<double>")
    products = F.zip_with(F.col(slots), F.col(values), lambda s, v: v * F.get(table, s))
    return F.aggregate(products, F.lit(0.0), lambda a, b: a + b)


@dataclass(frozen=True)
class Moments:
    """Product sums of k features, a constant one and the target, in this order."""

    sums: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        return Moments(self.sums + other.sums)

    def __sub__(self, other: Moments) -> Moments:
        return Moments(self.sums - other.sums)

    @property
    def n(self) -> float:
        return float(self.sums[-2, -2])

    def centred(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """Centred feature products, centred products with the target, feature means, target mean."""
        k = len(self.sums) - 2
        means = self.sums[:k, k] / self.n
        target = float(self.sums[k + 1, k]) / self.n
        products = self.sums[:k, :k].copy()
        for low in range(0, k, 256):  # no second matrix beside the result
            products[low : low + 256] -= np.outer(means[low : low + 256], self.sums[:k, k])
        return products, self.sums[:k, k + 1] - means * self.sums[k + 1, k], means, target

    def squared_error(self, weights: np.ndarray, intercept: float) -> float:
        """Sum of squared residuals of a fit over these rows."""
        full = np.concatenate([weights, [intercept, -1.0]])
        used = np.flatnonzero(full)
        return max(float(full[used] @ self.sums[np.ix_(used, used)] @ full[used]), 0.0)


@dataclass(frozen=True)
class WrittenSums:
    """Product sums by fold as rows of a checkpoint; the driver holds the matrices that are asked for, no others."""

    rows: DataFrame
    width: int
    folds: int

    def of(self, *folds: int) -> Moments:
        """The sum over the given folds, a fold read at a time."""
        sums = np.zeros((self.width, self.width))
        for f in folds:
            for batch in self.rows.where(F.col("f") == f).toArrow().to_batches():
                indices, values = batch.column("indices"), batch.column("values")
                for at, i in enumerate(batch.column("i").to_pylist()):
                    part, dense = values[at].values.to_numpy(), batch.column("type")[at].as_py() == 1
                    sums[i, slice(i, None) if dense else i + indices[at].values.to_numpy()] += part
        for i in range(self.width):
            sums[i + 1 :, i] = sums[i, i + 1 :]
        return Moments(sums)

    def total(self) -> Moments:
        return self.of(*range(self.folds))

    def without(self, fold: int) -> Moments:
        return self.of(*[f for f in range(self.folds) if f != fold])


def moments(rows: DataFrame, size: int, target: str, folds: int = 1) -> list[Moments]:
    """Product sums by fold, all on the driver."""
    written = written_moments(rows, size, target, folds)
    return [written.of(f) for f in range(folds)]


def written_moments(rows: DataFrame, size: int, target: str, folds: int = 1) -> WrittenSums:
    """Product sums by fold of rows with SLOTS (rising), VALUES, the target and, with several folds, FOLD.

    ``rows`` should be checkpointed: each block of the matrices reads them.
    """
    width = size + 2
    fold = F.col(FOLD).cast("int") if folds > 1 else F.lit(0)
    data = rows.select(fold.alias("f"), SLOTS, VALUES, F.col(target).cast("double").alias("y"))
    work = data.agg(F.sum(F.size(SLOTS).cast("double") ** 2).alias("w"), F.count(F.lit(1)).alias("n")).first()
    if not work["n"]:
        raise ValueError("no rows to fit")
    cores = -(-rows.sparkSession.sparkContext.defaultParallelism // folds)
    tasks = max(1, min(data.rdd.getNumPartitions(), cores, int(work["w"] / (folds * width * width)) + 1))
    height = max(1, BLOCK_BYTES // (8 * width))
    parts = [
        (data.where(F.col("f") == f) if folds > 1 else data).coalesce(tasks).mapInArrow(block_sums(f, low, min(low + height, width), width), "f int, i int, part array<double>")
        for f in range(folds) for low in range(0, width, height)
    ]
    summed = reduce(DataFrame.union, parts).groupBy("f", "i").agg(Summarizer.sum(array_to_vector("part")).alias("part"))
    summed = cut_lineage(summed.select("f", "i", F.unwrap_udt("part").alias("v")).select("f", "i", *[F.col(f"v.{c}").alias(c) for c in ("type", "size", "indices", "values")]))
    return WrittenSums(summed, width, folds)


def block_sums(fold: int, low: int, high: int, width: int):
    """Rows low to high of the upper triangle, from the diagonal on, summed over a partition of the fold's rows."""

    def run(batches):
        sums = np.zeros((high - low) * width)
        for batch in batches:
            y = batch.column(3).to_numpy()
            counts = np.diff(batch.column(1).offsets.to_numpy())
            ends = np.cumsum(counts)
            slots = np.insert(batch.column(1).flatten().to_numpy(), np.repeat(ends, 2), np.tile([width - 2, width - 1], len(ends))).astype(np.int64)
            values = np.insert(batch.column(2).flatten().to_numpy(), np.repeat(ends, 2), np.column_stack([np.ones(len(y)), y]).ravel())
            counts = counts + 2
            entries = np.flatnonzero((slots >= low) & (slots < high))
            row = np.repeat(np.arange(len(counts)), counts)[entries]
            times = np.cumsum(counts)[row] - entries  # this entry and those to its right in the row
            place = (slots[entries] - low) * width
            # entries with as many to their right are a table of pairs
            order = np.argsort(times, kind="stable")
            starts = np.flatnonzero(np.diff(times[order], prepend=0))
            for start, stop in zip(starts, np.append(starts[1:], len(order))):
                t = int(times[order[start]])
                step = max(1, PAIRS_AT_ONCE // t)
                for at in range(start, stop, step):
                    e = order[at : min(at + step, stop)]
                    pair = entries[e][:, None] + np.arange(t)
                    np.add.at(sums, (place[e][:, None] + slots[pair]).ravel(), (values[entries[e]][:, None] * values[pair]).ravel())
        sums = sums.reshape(high - low, width)
        for i in np.flatnonzero(sums.any(axis=1)):
            part = pa.array([sums[i, low + i :]], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array([fold], pa.int32()), pa.array([low + i], pa.int32()), part], ["f", "i", "part"])

    return run


def ridge(m: Moments, alpha: float) -> tuple[np.ndarray, float]:
    """Coefficients and intercept of least squares with penalty alpha times the sum of squares."""
    products, towards, means, target = m.centred()
    products[np.diag_indices_from(products)] += alpha
    weights = np.linalg.solve(products, towards) if alpha > 0 else np.linalg.lstsq(products, towards, rcond=None)[0]
    return weights, target - float(means @ weights)


class NetPath:
    """Elastic nets of one set of moments, (1 / 2n) |y - Xw - b|² + alpha (ratio |w|₁ + (1 - ratio) / 2 |w|²), to the optimum.

    Coordinate descent on the product sums, started from the last fit, finds the coefficients that are not zero and
    their signs; the equations that hold for these are then solved exactly, going no farther than the first sign
    that would change, until every optimality condition holds to ``TOLERANCE`` of the largest slope at zero.
    """

    TOLERANCE = 1e-10
    SWEEPS = 3
    MOST_STEPS = 500
    LEAST_SHRINK = 1e-6  # of the largest feature variance

    def __init__(self, m: Moments):
        products, towards, self.means, self.target = m.centred()
        products /= m.n
        self.products, self.towards = products, towards / m.n
        self.weights = np.zeros(len(towards))
        self.limit = float(np.abs(self.towards).max(initial=0))

    def slope(self, weights: np.ndarray, shrink: float) -> np.ndarray:
        used = np.flatnonzero(weights)
        return self.towards - self.products[:, used] @ weights[used] - shrink * weights

    def violation(self, weights: np.ndarray, alpha: float, ratio: float) -> float:
        """The largest breach of an optimality condition."""
        return float(self.breach(weights, alpha * ratio, alpha * (1 - ratio)).max(initial=0))

    def breach(self, weights: np.ndarray, limit: float, shrink: float) -> np.ndarray:
        slope = self.slope(weights, shrink)
        return np.where(weights != 0, np.abs(slope - limit * np.sign(weights)), np.maximum(np.abs(slope) - limit, 0))

    def descend(self, weights: np.ndarray, limit: float, shrink: float) -> np.ndarray:
        """Some sweeps of coordinate descent over the coefficients that are or should be different from zero."""
        slope = self.slope(weights, shrink)
        scale = np.diag(self.products) + shrink
        for _ in range(self.SWEEPS):
            moved = 0.0
            for j in np.flatnonzero((weights != 0) | (np.abs(slope) > limit)):
                if scale[j] <= 0:
                    continue
                old = weights[j]
                pull = slope[j] + scale[j] * old
                new = np.sign(pull) * max(abs(pull) - limit, 0.0) / scale[j]
                if new != old:
                    weights[j] = new
                    slope -= (new - old) * self.products[j]
                    slope[j] -= (new - old) * shrink
                    moved = max(moved, abs(new - old) * np.sqrt(scale[j]))
            if moved < self.TOLERANCE:
                break
        return weights

    def fit(self, alpha: float, ratio: float) -> tuple[np.ndarray, float]:
        limit, shrink = alpha * ratio, alpha * (1 - ratio)
        tolerance = self.TOLERANCE * max(float(np.abs(self.towards).max(initial=0)), 1e-300)
        least = self.LEAST_SHRINK * float(np.diag(self.products).max(initial=0))
        # steps of the path between the last penalty and this one
        while self.limit > 2 * limit and limit > 0:
            self.limit /= 2
            self.weights = self.guess(self.weights, self.limit, max(shrink, least, self.limit * 0.01), 5)
        self.limit = limit
        if shrink >= least:
            self.weights = self.optimum(self.weights, limit, shrink, tolerance)
        else:
            # equations without a square penalty may be singular: fits that are drawn to the last one, until it stays
            towards = self.towards
            for _ in range(self.MOST_STEPS):
                self.towards = towards + least * self.weights
                self.weights = self.optimum(self.weights, limit, shrink + least, tolerance)
                self.towards = towards
                if self.violation(self.weights, alpha, ratio) <= tolerance:
                    break
        return self.weights, self.target - float(self.means @ self.weights)

    def optimum(self, weights: np.ndarray, limit: float, shrink: float, tolerance: float) -> np.ndarray:
        weights = self.guess(self.descend(weights.copy(), limit, shrink), limit, shrink, 10)
        for _ in range(self.MOST_STEPS):
            slope, breach = self.slope(weights, shrink), self.breach(weights, limit, shrink)
            if breach.max(initial=0) <= tolerance:
                break
            # the worst breaches join, at most half as many as there are already
            most = max(16, np.count_nonzero(weights) // 2)
            for j in np.argsort(-breach)[:most]:
                if breach[j] > tolerance and weights[j] == 0:
                    weights[j] = np.copysign(np.finfo(float).tiny, slope[j])
            weights = self.solve(weights, limit, shrink)
        return weights

    def guess(self, weights: np.ndarray, limit: float, shrink: float, steps: int) -> np.ndarray:
        """Weights whose support and signs follow from each other, if that is found within some steps; else the best seen.

        Each step solves for the present signs, takes out what turned, and takes in what breaches its condition.
        """
        signs = np.sign(weights)
        slope = self.slope(weights, shrink)
        signs = np.where((weights == 0) & (np.abs(slope) > limit), np.sign(slope), signs)
        best, least, idle = weights, np.inf, 0
        for _ in range(steps):
            used = np.flatnonzero(signs)
            weights = np.zeros(len(signs))
            weights[used] = self.exact(used, signs[used], limit, shrink)
            slope = self.slope(weights, shrink)
            turned = weights * signs < 0
            joins = (signs == 0) & (np.abs(slope) > limit)
            error = float(np.abs(weights[turned]).sum() + (np.abs(slope[joins]) - limit).sum())
            idle = 0 if error < least else idle + 1
            if error < least:
                best, least = np.where(turned, 0.0, weights), error
            if idle == 3:  # it goes round in circles
                break
            if not turned.any() and not joins.any():
                return weights
            signs = np.where(turned, 0.0, np.where(joins, np.sign(slope), signs))
        return best

    def exact(self, used: np.ndarray, signs: np.ndarray, limit: float, shrink: float) -> np.ndarray:
        """The weights that meet the equations of the given support and signs."""
        system = self.products[np.ix_(used, used)]
        system[np.diag_indices_from(system)] += shrink
        right = self.towards[used] - limit * signs
        try:
            goal = np.linalg.solve(system, right)
            goal += np.linalg.solve(system, right - system @ goal) if len(used) < 500 else 0.0  # one refinement
            if np.isfinite(goal).all():
                return goal
        except np.linalg.LinAlgError:
            pass
        return np.linalg.lstsq(system, right, rcond=None)[0]

    def solve(self, weights: np.ndarray, limit: float, shrink: float) -> np.ndarray:
        """Exact coefficients for the given signs; those that would change sign on the way become zero."""
        for _ in range(self.MOST_STEPS):
            used = np.flatnonzero(weights)
            if not len(used):
                return weights
            now = weights[used]
            goal = self.exact(used, np.sign(now), limit, shrink)
            crossing = np.sign(goal) != np.sign(now)
            if limit == 0 or not crossing.any():
                weights[used] = goal
                return weights
            with np.errstate(divide="ignore", invalid="ignore"):
                share = np.where(crossing, now / (now - goal), np.inf)
            step = share.min()
            weights[used] = now + step * (goal - now)
            weights[used[share <= step * (1 + 1e-12)]] = 0.0
        return weights


def elastic_nets(m: Moments, grid: Sequence[tuple[float, float]]) -> list[tuple[np.ndarray, float]]:
    """Fits for (alpha, ratio) pairs in the order given, computed along a path from strong to weak penalties."""
    path, out = NetPath(m), [None] * len(grid)
    for at in sorted(range(len(grid)), key=lambda i: -grid[i][0] * max(grid[i][1], 1e-3)):
        out[at] = path.fit(*grid[at])
    return out
