"""Digests over arrays, and the row bootstrap built on them."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from paddock.functions.digests import md5_of_keys
from paddock.operators import evaluation


def test_digests_are_those_of_the_library():
    keys = [str(i).encode() * (1 + 9 * (i % 7 == 0)) for i in range(300)] + [b"", "é|x".encode(), b"y" * 500]
    data, ends = np.frombuffer(b"".join(keys), np.uint8), np.cumsum([len(k) for k in keys])
    prefixes = [f"42|{d}|".encode() for d in (0, 7, 10, 499)]
    seen = set()
    for p, rows, words in md5_of_keys()(data, ends, prefixes):
        for j, r in enumerate(rows):
            seen.add((p, int(r)))
            assert b"".join(w[j].tobytes() for w in words) == hashlib.md5(prefixes[p] + keys[r]).digest()
    assert len(seen) == len(keys) * len(prefixes)


def test_no_row_for_each_digest(spark):
    """Keys times resamples never become rows; a task hands on one row for each group."""
    df = spark.range(3000).selectExpr("id", "id % 3 as g", "id * 1.0 as v")
    found = evaluation.bootstrap_mean_ci_rows(df, "v", ["id"], ["g"])
    assert "md5" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.count() == 3


def plain(rows, groups, iterations):
    """Intervals by the definition, a digest at a time."""
    limits, out = evaluation.POISSON_LIMITS, {}
    for g in groups:
        own = [(k, v) for k, h, v in rows if h == g]
        means = []
        for b in range(iterations):
            at = 8 * (b % 4)
            w = [sum(int(hashlib.md5(f"42|{b // 4}|{k}".encode()).hexdigest()[at : at + 8], 16) >= x for x in limits) for k, _ in own]
            if sum(w):
                means.append(sum(x * v for x, (_, v) in zip(w, own)) / sum(w))
        out[g] = tuple(np.quantile(means, [0.025, 0.975]))
    return out


@pytest.mark.parametrize("most", [500, 2])
def test_many_groups_and_long_keys(spark, monkeypatch, most):
    monkeypatch.setattr(evaluation, "GROUPS_AT_ONCE", most)
    rows = [("k" * (i % 70) + str(i % 25), i % 9, float(i * i % 101)) for i in range(90)]
    df = spark.createDataFrame(rows, "k string, g int, v double").withColumn("h", F.array("g"))
    expected = plain(rows, range(9), 30)
    for by in ("g", "h"):  # a nested group as well
        found = evaluation.bootstrap_mean_ci_rows(df, "v", ["k"], [by], iterations=30).collect()
        assert len(found) == 9
        for r in found:
            g = r["g"] if by == "g" else r["h"][0]
            assert (r["ci_low"], r["ci_high"]) == pytest.approx(expected[g])
