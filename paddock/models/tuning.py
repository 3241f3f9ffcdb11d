"""Seeded parameter search and cross-validated penalties."""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from paddock.functions.stats import hash_bucket
from paddock.models import moments
from paddock.models.frame import LOG_TARGET, fit_encoder, holdout, with_log_target
from paddock.models.linear import encoded
from paddock.models.moments import FOLD, SLOTS, VALUES
from paddock.models.trees import fit_category_boosted
from paddock.operators.features import ColumnRoles
from paddock.operators.gold import TARGET

# Search ranges and penalty grid.
NET_RANGES = {"alpha": (1e-5, 10.0), "l1_ratio": (0.0, 1.0)}
TREE_RANGES = {"rounds": (250, 1200), "step": (0.01, 0.2), "depth": (3, 8), "l2": (1.0, 20.0)}
RIDGE_ALPHAS = (0.1, 1.0, 10.0, 100.0)
NET_ALPHAS = tuple(map(float, np.logspace(-4, 1, 40)))
NET_RATIOS = tuple(map(float, np.linspace(0.1, 0.9, 9)))


def _log_uniform(rng: random.Random, low: float, high: float) -> float:
    return math.exp(rng.uniform(math.log(low), math.log(high)))


def net_grid(trials: int, seed: int) -> list[tuple[float, float]]:
    """Seeded (alpha, l1_ratio) pairs within NET_RANGES."""
    rng = random.Random(seed)
    return [(_log_uniform(rng, *NET_RANGES["alpha"]), rng.uniform(*NET_RANGES["l1_ratio"])) for _ in range(trials)]


def price_errors(rows: DataFrame, fits: list[tuple[np.ndarray, float]], price: str = TARGET) -> list[float]:
    """Mean absolute price error of each fit over sparse rows; one pass whatever the number of fits."""
    table, intercepts = np.column_stack([w for w, _ in fits]), np.array([b for _, b in fits])

    def errors(batches):
        for batch in batches:
            ends = batch.column(0).offsets.to_numpy()
            terms = batch.column(1).flatten().to_numpy()[:, None] * table[batch.column(0).flatten().to_numpy()]
            logs = np.vstack([np.zeros(len(fits)), np.cumsum(terms, axis=0)])[ends - ends[0]]
            off = np.abs(np.exp(np.diff(logs, axis=0) + intercepts) - batch.column(2).to_numpy()[:, None])
            sums = [pa.array(range(len(fits)), pa.int32()), pa.array(off.sum(axis=0)), pa.array([len(off)] * len(fits), pa.int64())]
            yield pa.RecordBatch.from_arrays(sums, ["fit", "off", "n"])

    found = rows.select(SLOTS, VALUES, F.col(price).cast("double")).mapInArrow(errors, "fit int, off double, n long")
    means = found.groupBy("fit").agg((F.sum("off") / F.sum("n")).alias("mae")).collect()
    return [r["mae"] for r in sorted(means)]


def tune_elastic_net(
    train: DataFrame,
    roles: ColumnRoles,
    trials: int = 25,
    seed: int = 42,
    key: str = "URL",
    min_df: int = 1,
    max_terms: int = 5000,
) -> list[dict[str, float]]:
    """Trials by rising EUR error on a held-out quarter of the training rows.

    All trials come from one pass of product sums, each at its optimum; one more pass scores them.
    """
    fit_rows, valid_rows = holdout(train, key, seed + 1)
    encoder = fit_encoder(fit_rows, roles.for_linear(), min_df=min_df, max_terms=max_terms)
    (sums,) = moments.moments(encoded(encoder, fit_rows), encoder.size, LOG_TARGET)
    grid = net_grid(trials, seed)
    scores = price_errors(encoder.rows(valid_rows), moments.elastic_nets(sums, grid))
    rows = [{"alpha": a, "l1_ratio": r, "mae_eur": e} for (a, r), e in zip(grid, scores)]
    return sorted(rows, key=lambda t: t["mae_eur"])


def tune_boosted(
    train: DataFrame, roles: ColumnRoles, trials: int = 25, seed: int = 42, key: str = "URL"
) -> list[dict[str, float]]:
    """Boosting trials by rising EUR error."""
    fit_rows, valid_rows = holdout(train, key, seed + 1)
    rng, results = random.Random(seed), []
    for _ in range(trials):
        rounds = rng.randint(*TREE_RANGES["rounds"])
        step = _log_uniform(rng, *TREE_RANGES["step"])
        depth = rng.randint(*TREE_RANGES["depth"])
        penalty = _log_uniform(rng, *TREE_RANGES["l2"])
        model = fit_category_boosted(fit_rows, roles, rounds, depth, step, penalty, seed)
        error = F.avg(F.abs(F.col("__p") - F.col(TARGET)))
        mae = model.predict(valid_rows, "__p").agg(error.alias("mae")).first()["mae"]
        results.append({"rounds": rounds, "step": step, "depth": depth, "l2": penalty, "mae_eur": mae})
    return sorted(results, key=lambda t: t["mae_eur"])


def fold_moments(train: DataFrame, roles: ColumnRoles, folds: int, seed: int, key: str) -> list[moments.Moments]:
    """Product sums of the tabular features by key-hash fold."""
    encoder = fit_encoder(train, roles.for_linear().without_text())
    fold = hash_bucket(F.col(key), seed, folds).cast("int").alias(FOLD)
    return moments.moments(encoded(encoder, train, fold), encoder.size, LOG_TARGET, folds)


def cv_ridge(
    train: DataFrame, roles: ColumnRoles, alphas: tuple[float, ...] = RIDGE_ALPHAS, folds: int = 5, seed: int = 42, key: str = "URL"
) -> list[dict[str, float]]:
    """Mean and deviation of the log RMSE over key-hash folds, per penalty; a training part is the total without its fold."""
    parts = fold_moments(train, roles, folds, seed, key)
    total = reduce(moments.Moments.__add__, parts)
    scores = np.array([[math.sqrt(p.squared_error(*moments.ridge(total - p, a)) / p.n) for p in parts] for a in alphas])
    means, best = scores.mean(axis=1), int(scores.mean(axis=1).argmin())
    return [
        {"alpha": a, "rmse_mean": float(means[i]), "rmse_std": float(scores[i].std()), "is_best": int(i == best)} for i, a in enumerate(alphas)
    ]


def cv_elastic_net(
    train: DataFrame,
    roles: ColumnRoles,
    alphas: Sequence[float] = NET_ALPHAS,
    ratios: Sequence[float] = NET_RATIOS,
    folds: int = 5,
    seed: int = 42,
    key: str = "URL",
) -> list[dict[str, float]]:
    """Mean and deviation of the squared log error over key-hash folds for every penalty and ratio; the lowest mean is best."""
    parts = fold_moments(train, roles, folds, seed, key)
    total = reduce(moments.Moments.__add__, parts)
    grid = [(a, r) for r in ratios for a in alphas]
    scores = np.empty((len(grid), folds))
    for f, part in enumerate(parts):
        for r, ratio in enumerate(ratios):
            fits = moments.elastic_nets(total - part, [(a, ratio) for a in alphas])
            scores[r * len(alphas) : (r + 1) * len(alphas), f] = [part.squared_error(*fit) / part.n for fit in fits]
    means = scores.mean(axis=1)
    best = int(means.argmin())
    return [
        {"alpha": a, "l1_ratio": r, "mse_mean": float(means[i]), "mse_std": float(scores[i].std()), "is_best": int(i == best)}
        for i, (a, r) in enumerate(grid)
    ]


def cv_boosted(train: DataFrame, roles: ColumnRoles, rounds: int = 500, folds: int = 5, seed: int = 42, key: str = "URL") -> dict[str, float]:
    """Mean and deviation of the boosted log RMSE over key-hash folds."""
    train = with_log_target(train)
    fold, scores = hash_bucket(F.col(key), seed, folds), []
    for i in range(folds):
        model = fit_category_boosted(train.where(fold != i).drop(LOG_TARGET), roles, rounds, seed=seed)
        error = F.sqrt(F.avg(F.pow(F.col("__p") - F.col(LOG_TARGET), F.lit(2.0))))
        scores.append(model.log_predict(train.where(fold == i), "__p").agg(error.alias("e")).first()["e"])
    mean = sum(scores) / folds
    return {"rmse_mean": mean, "rmse_std": math.sqrt(sum((s - mean) ** 2 for s in scores) / (folds - 1))}
