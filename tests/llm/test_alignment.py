"""Token alignment against a plain restatement, document by document."""

import hashlib
from collections import Counter

import numpy as np
import pytest
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from paddock.llm import alignment, queries
from paddock.llm.token_count import printable_bytes

FOLDER = "/root/testdata/sf0.001"
CONTRACT = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def plain():
    """From (id, text) rows to contract rows: spans by walking both token lists, counts by dictionaries."""
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    byte = printable_bytes()

    def groups(text):
        if not text:
            return []
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        bytes_a = [bytes(byte[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b.id_to_piece(i)) for i in ids_b)]
        if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            return []
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        out, i, j = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            p, q = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
            out.append((ids_a[i:p], ids_b[j:q]))
            i, j = p, q
        return out

    def run(rows):
        each = [(i, groups(text)) for i, text in rows]
        linked = [Counter((x, y) for xs, ys in g for x in xs for y in ys) for _, g in each]
        held = Counter(pair for found in linked for pair in found)
        most = Counter()
        for (x, _), n in held.items():
            most[x] = max(most[x], n)
        out = []
        for (i, g), found in zip(each, linked):
            text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
            digest = hashlib.sha256(text.encode()).hexdigest() if g else ""
            best = sum(n for pair, n in found.items() if held[pair] == most[pair[0]])
            total = sum(n * held[pair] for pair, n in found.items())
            out.append((i, sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(found.values()), best, total, digest))
        return out

    return run


def order(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, r))


def found(table, **limits):
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise(F.lit(""))
    return alignment.with_agreement(alignment.written(table.withColumn("groups_sha256", digest).drop("groups")), **limits)


def align(docs):
    return alignment.align(docs, "text", queries.TOKENIZER, queries.PIECES, {"doc_id": docs["doc_id"]})


def test_query_against_plain(spark, plain):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    assert order(queries.op12_token_alignment(spark, FOLDER).select(CONTRACT).collect()) == order(plain(rows))


ODD = [
    (1, None), (2, ""), (3, " "), (4, "plain words"), (4, "plain words"), (5, "tabs\tand\nlines  two  blanks "), (6, "▁ is a blank to one of them"),
    (7, "<s> <|endoftext|> </s> <0x41>"), (8, "日本語のテキスト 🙂🙂 ḧ́ é"), (9, "x" * 3000), (10, "word " * 20000), (None, "no id"), (11, " 　﻿"), (12, "=" * 500 + "ß" * 500),
]


@pytest.mark.parametrize("hot", [1, 20, alignment.MOST_HOT])
def test_odd_rows_and_joined_pairs(spark, plain, hot):
    """Clashing columns neither matter nor come along; few hot pairs give the same as many."""
    wide = spark.createDataFrame([(*r, 5, "x", 7) for r in ODD], "doc_id long, text string, n_best int, pairs string, row_number int")
    assert order(found(align(wide), most_hot=hot).select(CONTRACT).collect()) == order(plain(ODD))


def test_wide_groups_and_empty_table(spark, plain, monkeypatch):
    monkeypatch.setattr(alignment, "WIDE", 0)
    one = alignment.Aligner(queries.TOKENIZER, queries.PIECES)
    texts = [(t or "").encode() for _, t in ODD]
    narrow = one(texts)
    monkeypatch.undo()
    wide = one(texts)
    for name in ("pairs", "pair_links"):
        assert all((x == y).all() for x, y in zip(narrow[name], wide[name]))
    nothing = spark.createDataFrame([], "doc_id long, text string")
    assert found(align(nothing)).count() == 0


def test_groups_are_joint_ends():
    rng = np.random.default_rng(5)
    for n in (1, 2, 50, 400):
        total = 10 * n
        cuts = [np.unique(np.append(rng.choice(np.arange(1, total), n - 1, replace=False), total)) for _ in range(2)]
        by_a, by_b = alignment.groups(*(np.diff(c, prepend=0) for c in cuts))
        joint = np.intersect1d(*cuts)
        for got, ends in zip((by_a, by_b), cuts):
            assert (got == np.searchsorted(joint, ends)).all()
