"""Product sums: what tasks hand on does not grow with the partitions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from paddock.models import moments
from paddock.models.moments import FOLD, SLOTS, VALUES


def table(spark, rows=4000, size=6):
    rng = np.random.default_rng(9)
    x, y = rng.normal(size=(rows, size)), rng.normal(size=rows)
    data = [(list(range(size)), a.tolist(), float(b), i % 3) for i, (a, b) in enumerate(zip(x, y))]
    return x, y, spark.createDataFrame(data, f"{SLOTS} array<int>, {VALUES} array<double>, y double, {FOLD} int")


@pytest.mark.parametrize("folds", [1, 3])
def test_no_more_matrices_are_handed_on_than_there_are_cores(spark, monkeypatch, folds):
    handed, block_sums = spark.sparkContext.accumulator(0), moments.block_sums

    def counted(*args):
        run = block_sums(*args)

        def each(batches):
            for part in run(batches):
                handed.add(len(part))
                yield part

        return each

    monkeypatch.setattr(moments, "block_sums", counted)
    x, y, df = table(spark)
    df = df.repartition(40).cache()
    parts = moments.moments(df, x.shape[1], "y", folds)
    cores = spark.sparkContext.defaultParallelism
    assert handed.value <= (x.shape[1] + 2) * (cores + folds - 1)  # rows of matrices, each with two more slots
    full = np.column_stack([x, np.ones(len(y)), y])
    for f, part in enumerate(parts):
        own = full[np.arange(len(y)) % 3 == f] if folds > 1 else full
        assert np.allclose(part.sums, own.T @ own)


def test_folds_without_rows_are_zero(spark):
    x, y, df = table(spark, 300)
    parts = moments.moments(df.where(F.col(FOLD) != 1), x.shape[1], "y", 3)
    assert not parts[1].sums.any() and parts[0].n == parts[2].n == 100
