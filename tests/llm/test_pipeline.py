"""The pipeline against its stages' own meaning, on small tables."""

import hashlib

import numpy as np
import pytest
import public_tokenizers
import tiktoken

import corpus_pipeline
from paddock.llm import queries, quality_rules, transducer
from tests.llm.test_texts import odd_rows, plain_repeats

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows after each stage, the input first."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, out[-1], FOLDER).write.parquet(f"{folder}/{i}")
        out.append(spark.read.parquet(f"{folder}/{i}"))
    return out


def test_columns_and_order(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "repeats", "mix", "tokens"]
    for kept in stages[1:-1]:
        assert kept.dtypes == stages[0].dtypes


def test_quality_keeps_clean_rows(stages, spark):
    before, after = ({r["doc_id"]: r["text"] for r in s.collect()} for s in stages[:2])
    verdict = {r["doc_id"]: r["kept"] for r in queries.op3_quality_rules(spark, FOLDER).collect()}
    assert after == {i: t for i, t in before.items() if verdict[i]}
    good = {r["doc_id"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").where("quality = 1").collect()}
    long_enough = {i for i in good if len(before[i].split()) >= quality_rules.MIN_WORDS}
    assert len(long_enough & set(after)) >= 0.98 * len(long_enough)


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def test_no_copies_stay_and_others_do(stages):
    before, after = ({r["doc_id"]: shingles(r["text"]) for r in s.collect()} for s in stages[1:3])
    alike = lambda a, b: len(a & b) / max(len(a | b), 1)
    for i, a in after.items():
        for j, b in after.items():
            assert i >= j or alike(a, b) < 0.9
    for i, a in before.items():
        if i not in after:
            assert max(alike(a, b) for j, b in before.items() if j != i) > 0.4


def test_likeness_of_exactly_the_threshold_decides(stages):
    before, after = ({r["doc_id"]: shingles(r["text"]) for r in s.collect()} for s in stages[1:3])
    alike = lambda a, b: len(a & b) / max(len(a | b), 1)
    assert all(alike(a, b) < 0.8 for i, a in after.items() for j, b in after.items() if i < j)
    for i in set(before) - set(after):
        assert max(alike(before[i], b) for j, b in before.items() if j != i) >= 0.8


def test_repeats_go(stages):
    before, after = ({r["doc_id"]: r for r in s.collect()} for s in stages[2:4])
    ids = list(before)
    cut = plain_repeats([before[i]["text"].encode() for i in ids], corpus_pipeline.PASSAGE)
    for i, (_, removed, _, kept) in zip(ids, cut):
        assert after[i]["text"] == (kept.decode("utf-8", "ignore") if removed else before[i]["text"])
        assert after[i]["n_chars"] == (len(after[i]["text"]) if removed else before[i]["n_chars"])


def test_mix_and_tokens(stages):
    texts = {r["doc_id"]: r["text"] for r in stages[3].collect()}
    taken, coded = stages[4].collect(), stages[5].collect()
    assert len(coded) == len(taken) and {r["doc_id"] for r in taken} <= set(texts)
    ranks = transducer.read_ranks(queries.RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in coded:
        assert r["round_trip"] and np.frombuffer(r["token_ids"], "<u4").tolist() == library.encode_ordinary(texts[r["doc_id"]])


def test_run_writes_and_rereads(stages, spark):
    digest = lambda r: (r["doc_id"], r["n_tokens"], hashlib.sha256(r["token_ids"]).hexdigest())
    assert sorted(map(digest, corpus_pipeline.run(spark, FOLDER).collect())) == sorted(map(digest, stages[5].collect()))


def run_stages(spark, docs, folder):
    out = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, out[-1], FOLDER).write.parquet(f"{folder}/{i}")
        out.append(spark.read.parquet(f"{folder}/{i}"))
    return out


@pytest.mark.parametrize("empty", [False, True])
def test_odd_rows_pass_every_stage(spark, tmp_path, empty):
    """Columns named like the operators' results come through every stage untouched."""
    rows = [] if empty else [(*r[:5], f"k{i}", i, f"b{i}", -i, 0.5 * i, f"c{i}") for i, r in enumerate(odd_rows())]
    docs = spark.createDataFrame(rows, SCHEMA + ", KEPT string, Size int, n_bytes string, n_removed int, target double, copies string")
    *stages, coded = run_stages(spark, docs, tmp_path)
    assert (coded.count() > 0) is not empty
    extra = {(r["doc_id"], *r[5:]) for r in docs.collect()}
    for after in stages:
        assert after.dtypes == docs.dtypes and {(r["doc_id"], *r[5:]) for r in after.collect()} <= extra


def test_genuine_replacement_characters_stay(spark, tmp_path):
    """A cut that splits a character takes that character; U+FFFD elsewhere in the text stays."""
    rnd = np.random.default_rng(2)
    own = lambda: " ".join("".join(rnd.choice(list("abcdefgh"), 6)) for _ in range(20))
    passage = " ".join("".join(rnd.choice(list("ijklmnop"), 6)) for _ in range(52))
    # the two texts share the first byte of the character after the passage
    texts = [f"\ufffd genuine {own()} {passage}é {own()} \ufffd", f"{own()} {passage}è {own()}", own()]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], SCHEMA)
    after = {r["doc_id"]: r for r in corpus_pipeline.cut_repeats(spark, docs, FOLDER).collect()}
    assert after[0]["text"].startswith("\ufffd genuine ") and after[0]["text"].endswith(" \ufffd") and "é" not in after[0]["text"]
    assert passage[:100] not in after[0]["text"] and passage[:100] not in after[1]["text"] and after[2]["text"] == texts[2]
    assert all(after[i]["n_chars"] == len(after[i]["text"]) for i in range(3))


def test_passages_of_fifty_words_go_and_shorter_ones_stay(spark):
    rnd = np.random.default_rng(3)
    words = lambda n: " ".join("".join(rnd.choice(list("abcdefgh"), rnd.integers(3, 8))) for _ in range(n))
    long, short = words(52), words(30)
    texts = [f"{words(60)} {long} {words(60)}", f"{words(60)} {long}", f"{words(60)} {short} {words(9)}", f"{words(5)} {short} {words(60)}"]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], SCHEMA)
    after = {r["doc_id"]: r["text"] for r in corpus_pipeline.cut_repeats(spark, docs, FOLDER).collect()}
    assert long[20:-20] not in after[0] and long[20:-20] not in after[1] and (after[2], after[3]) == (texts[2], texts[3])
