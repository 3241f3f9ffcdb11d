"""Candidates of the near-duplicate stage come from shared shingles, not from all pairs of fingerprints."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from paddock.llm import simhash

WORDS = [f"w{i}" for i in range(400)]


def family_texts(rnd, families=12):
    """Near copies around base texts, all with one line that stands in every text."""
    rows = []
    for _ in range(families):
        base = rnd.choices(WORDS, k=rnd.randint(20, 90))
        for _ in range(rnd.randint(1, 6)):
            words = list(base)
            for _ in range(rnd.randint(0, 5)):
                words[rnd.randrange(len(words))] = rnd.choice(WORDS)
            rows.append(" ".join(words + "all rights are reserved by the owner of this page".split()))
    return rows


def test_no_pass_over_all_pairs(spark, monkeypatch):
    def refuse(*_):
        raise AssertionError("all pairs of fingerprints are compared")

    monkeypatch.setattr(simhash, "wide_links", refuse)
    texts = family_texts(random.Random(3))
    rows = [(i, t) for i, t in enumerate(texts)]
    kept = simhash.one_of_each_group(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text")
    sets = [set(simhash.shingles_of(t.encode(), 5)) for t in texts]
    near = lambda i, j: len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8
    root = list(range(len(rows)))
    for i in root[:]:
        for j in range(i):
            if near(i, j) and root[i] != root[j]:
                root = [min(root[i], root[j]) if r in (root[i], root[j]) else r for r in root]
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(root))


def test_sets_that_agree_share_one_of_their_first_shingles(spark):
    texts = family_texts(random.Random(5))
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    common = simhash.common_shingles(df, F.col("text"), 5)
    line = {int(v) for v in simhash.shingle_set(b"all rights are reserved by the owner of this page", 5).view(np.int64)}
    assert line <= set(common)
    for last in (common, []):
        found = simhash.wide_fingerprints(df, F.col("text"), {"text": F.col("text")}, 5, (42, 43, 44), last, 0.8).collect()
        firsts = [set(np.frombuffer(r["first"], "<i8").tolist()) for r in found]
        sets = [set(simhash.shingle_set(r["text"].encode(), 5).view(np.int64).tolist()) for r in found]
        if last:  # what all texts have is looked up only where nothing else is left
            assert sum(bool(f & line) for f in firsts) < len(firsts) / 2
        for i, a in enumerate(sets):
            assert all(firsts[i] & firsts[j] for j, b in enumerate(sets[:i]) if len(a & b) / len(a | b) >= 0.8)


@pytest.mark.parametrize("short", [0, 3, 1000])
def test_runs_connect_as_all_pairs_of_a_shingle_do(monkeypatch, short):
    monkeypatch.setattr(simhash, "SHORT_RUN", short)
    rng = np.random.default_rng(4)
    shingles = np.sort(rng.integers(0, 12, 150).astype(np.uint64))
    seeds = rng.integers(0, 1 << 63, (6, 3)).astype(np.uint64)
    words = seeds[rng.integers(0, 6, 150)]
    for _ in range(8):
        words[np.arange(150), rng.integers(0, 3, 150)] ^= np.uint64(1) << rng.integers(0, 64, 150).astype(np.uint64)
    near = [(i, j) for i in range(150) for j in range(i) if shingles[i] == shingles[j] and np.bitwise_count(words[i] ^ words[j]).sum() <= 13]
    expected = simhash.forest(*np.array(near).T, 150)
    a, b = simhash.run_links(shingles, words, 13)
    assert simhash.forest(a, b, 150).tolist() == expected.tolist() and len(set(expected)) < 150


def test_buckets_and_pieces_change_nothing(spark, monkeypatch):
    texts = family_texts(random.Random(6))
    df = spark.createDataFrame([(t,) for t in texts * 2], "text string").withColumn("m", F.xxhash64("text")).repartition(3)
    marked = simhash.wide_fingerprints(df, F.col("text"), {"m": F.col("m")}, 5, (42, 43, 44), [], 0.8).cache()
    roots = lambda links: sorted((bytes(r["node"]), bytes(r["root"])) for r in simhash.components(links).collect())
    whole = roots(simhash.shared_links(marked, "m", 50, 24))
    monkeypatch.setattr(simhash, "BUCKET", 7)
    monkeypatch.setattr(simhash, "PIECE", 11)
    assert whole and roots(simhash.shared_links(marked, "m", 50, 24)) == whole
