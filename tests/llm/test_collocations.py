"""Collocations against a plain count of all phrases, with few and with many rounds."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from paddock.llm import collocations, queries

FOLDER = "/root/testdata/sf0.001"
LOWER = {c: c + 32 for c in range(65, 91)}


def plain(rows, top, least):
    """rows: (text, lang)."""
    counts, sizes = defaultdict(Counter), Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall(r"[^ \t]+", piece)
            sizes[lang or "und" if lang is None else lang] += len(words)
            for n in range(1, 5):
                counts["und" if lang is None else lang].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        longest = Counter()
        for p, a in candidates.items():
            for n in range(2, len(p)):
                for i in range(len(p) - n + 1):
                    longest[p[i : i + n]] = max(longest[p[i : i + n]], a)
        kept = []
        for p, a in candidates.items():
            if 100 * longest[p] >= 80 * a and longest[p]:
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, sizes[lang], -score))
    return sorted(out)


def found(docs, **limits):
    return sorted(map(tuple, collocations.collocations(docs, "text", "lang", **limits).collect()))


def test_query_against_plain(spark):
    docs = [(r["text"], r["lang"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    assert sorted(map(tuple, queries.op13_collocations(spark, FOLDER).collect())) == plain(docs, 2000, 30)


def mixed_rows():
    rnd = random.Random(3)
    rows = []
    for lang, size in (("en", 400), ("de", 250), (None, 60), ("xx", 3)):
        common = ["of", "the", "to"]
        terms = [" ".join(rnd.choice("abcdefgh") + rnd.choice("ijklmn") for _ in range(rnd.randint(2, 5))) for _ in range(40)]
        for _ in range(size):
            parts = []
            for _ in range(rnd.randint(1, 30)):
                parts.append(rnd.choice(terms) if rnd.random() < 0.5 else rnd.choice(common) if rnd.random() < 0.6 else rnd.choice("abcdefgh") + rnd.choice("ijk"))
            rows.append(("".join(p + rnd.choice([" ", " ", " ", ", ", "\t", ".\n", " | "]) for p in parts).title() if rnd.random() < 0.2 else " ".join(parts), lang))
    return rows + [rows[0]] * 30 + [(None, "en"), ("", None), (" \n\t", "en"), ("É É é É! ÀB àb ÀB", "fr"), ("so it goes " * 3000, "de"), ("\x0b\x0cx y x y\rx y", "")]


@pytest.mark.parametrize(("top", "least", "goals"), [(5, 2, (1, 3)), (40, 3, (1,)), (7, 4, (2, 16)), (2000, 2, (2, 16)), (3, 30, (1, 2, 4, 8))])
def test_rounds_against_plain(spark, top, least, goals):
    rows = mixed_rows()
    docs = spark.createDataFrame([(*r, 1, "x", 5) for r in rows], "text string, lang string, a int, phrase string, `rank` int")
    assert found(docs, top=top, least=least, goals=goals) == plain(rows, top, least)


@pytest.mark.parametrize("rows", [[], [(None, None)], [("one two", "en")]])
def test_nothing_to_find(spark, rows):
    assert found(spark.createDataFrame(rows, "text string, lang string")) == []


def test_full_filters_only_cost_time(spark, monkeypatch):
    monkeypatch.setattr(collocations, "FILTER_BITS", (6, 6))
    rows = mixed_rows()
    assert found(spark.createDataFrame(rows, "text string, lang string"), top=20, least=2, goals=(1,)) == plain(rows, 20, 2)


def test_long_texts_in_stretches(spark, monkeypatch):
    text = b"a b, c d. " * 50 + b"e f " * 100 + b"; g h"
    monkeypatch.setattr(collocations, "STRETCH", 64)
    parts = list(collocations.stretches(text))
    assert b"".join(parts) == text and all(p[-1:] in (b",", b".", b";") for p in parts[:-1]) and len(parts) > 5


def test_products_beyond_64_bits(spark):
    a, left, right = 3 * 10**15, 4 * 10**15, 5 * 10**15 + 1
    row = spark.createDataFrame([(a, left, right)], "a long, x long, y long").select(*collocations.cuts(("x", "y"), ("y", "x"))).first()
    assert tuple(row) == (2_000_000 * a // (left + right), left, right)


def test_words_keep_their_place():
    ids, words, piece = collocations.words_of(b"Aa bb\tAA. \xc3\x89 aa\n\nbb")
    assert [words[i].as_py() for i in ids] == ["aa", "bb", "aa", "É", "aa", "bb"]
    assert (np.diff(piece) > 0).tolist() == [False, False, True, False, True]
