"""Encoding and counting against the tokenizer libraries; decoding by exact round trips."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from tokenizers import Tokenizer

from paddock.llm import bpe, queries, token_count, transducer
from paddock.llm.token_count import TokenCounter

PIECES = ["the", " ", "<|endoftext|>", "é", "日本", "🙂", "'ll", "\n", "  ", "ing", "thing", "A", "1", "23", "...", "ß", "~", "\t", "\x00", "​", "eau"]


def texts(seed, count, longest=25):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, longest))) for _ in range(count)]


@pytest.fixture(scope="module")
def library():
    ranks = transducer.read_ranks(queries.RANKS)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("look, most", [(512, 100_000), (16, 40)])
def test_transducer_equals_the_library(library, monkeypatch, look, most):
    monkeypatch.setattr(transducer, "_LOOK", look)  # tokens of long pieces are settled early
    # and tables are emptied often
    coder = transducer.Transducer(transducer.read_ranks(queries.RANKS), pieces=most, pairs=most, states=most)
    cut = regex.compile(public_tokenizers.PATTERN)
    rnd = random.Random(3)
    long = ["".join(rnd.choice("abcdeinorsteeeettt") for _ in range(rnd.randint(1, 300))) for _ in range(150)]
    for text in [*texts(1, 400), *long, "a" * 3000, ""]:
        assert np.frombuffer(coder.packed(cut.findall(text)), "<u4").tolist() == library.encode_ordinary(text)


def test_fits_agrees_with_merging():
    coder = transducer.Transducer(transducer.read_ranks(queries.RANKS))
    rnd = random.Random(5)
    tokens = list(coder.tokens)
    for _ in range(3000):
        a, b = rnd.choice(tokens), rnd.choice(tokens[:2000])
        merged = transducer.merge(coder.tokens[a] + coder.tokens[b], coder.ranks)
        assert coder.fits(a, b) == (merged == [a, b])


def test_stream_decoder_waits_for_whole_characters(library):
    tokens = transducer.token_bytes(queries.RANKS)
    text = "".join(texts(7, 60))
    ids = library.encode_ordinary(text)
    decoder = transducer.StreamDecoder(tokens)
    parts = [decoder.feed([i]) for i in ids] + [decoder.finish()]
    assert "".join(parts) == text
    broken = b"\xe6\x97A\xf0\x9f\xed\xa0\x80\xe2"
    by_byte = {i: bytes([i]) for i in range(256)}
    decoder = transducer.StreamDecoder(by_byte)
    assert "".join([decoder.feed([b]) for b in broken] + [decoder.finish()]) == broken.decode("utf-8", "replace")


def test_rows_of_any_kind(spark, library):
    rows = [(1, None, "x"), (2, "", "y"), (None, "thing", "z"), (3, "the thing\n" * 30_000, "w"), (3, "twice", "v"), (3, "twice", "v")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `TOKEN_IDS` string")
    coded = bpe.encode(docs, "text", queries.RANKS, public_tokenizers.PATTERN)
    assert coded.columns == ["doc_id", "text", "token_ids"]
    back = bpe.decode(coded, "token_ids", queries.RANKS).collect()
    assert len(back) == 6
    for row in back:
        assert np.frombuffer(row["token_ids"], "<u4").tolist() == library.encode_ordinary(row["text"] or "")
        assert row["decoded"] == (row["text"] or "")
    digests = {r["doc_id"]: r for r in queries.bpe_digests(docs.where("doc_id = 1")).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert tuple(digests[1]) == (1, 0, empty, empty)
    assert queries.bpe_digests(docs.limit(0)).collect() == []


def test_counts_equal_the_library(spark):
    tokenizer = Tokenizer.from_file(queries.TOKENIZER)
    samples = [*texts(11, 600), "the thing " * 20_000, "<|endoftext|><|endoftext|> <|endof"]
    counter = TokenCounter(queries.TOKENIZER)
    expected = [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in samples]
    assert [counter.count(t) for t in samples] == expected
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(samples)] + [(-1, None, 0)], "doc_id long, text string, n_tokens int")
    counted = token_count.token_counts(docs, "text", queries.TOKENIZER, {"doc_id": docs["doc_id"]})
    found = {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in counted.collect()}
    assert found == {-1: (0, 0)} | {i: (len(t.encode()), n) for i, (t, n) in enumerate(zip(samples, expected))}
    assert token_count.token_counts(docs.limit(0), "text", queries.TOKENIZER, {}).collect() == []


def test_counts_survive_full_tables(monkeypatch):
    monkeypatch.setattr(token_count, "MOST_PIECES", 50_000)  # below the whole tokens, so every miss starts anew
    tokenizer, counter = Tokenizer.from_file(queries.TOKENIZER), TokenCounter(queries.TOKENIZER)
    for text in texts(13, 100):
        assert counter.count(text) == len(tokenizer.encode(text, add_special_tokens=False).ids)


def test_whole_tokens_are_proven_not_assumed():
    counter = TokenCounter(queries.TOKENIZER)
    assert 0 < len(counter.whole) <= 50_257
    tokenizer = Tokenizer.from_file(queries.TOKENIZER)
    for piece in list(counter.whole)[:: 97]:
        if counter._cut.findall(piece) == [piece]:
            assert len(tokenizer.encode(piece, add_special_tokens=False).ids) == 1


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        TokenCounter(public_tokenizers.path("word_bpe_49k.json"))
