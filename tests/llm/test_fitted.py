"""Language model, classifiers and vectors: brute force, and accuracy on held-out rows."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece

from paddock.llm import boosting, embedding_dedup, lattice, lm_scoring, quality_model, queries, toxicity

SMALL, FOLDER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def remainder(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds


# language model


@pytest.fixture(scope="module")
def vocabulary():
    return lattice.Pieces(queries.PIECES)


def plain_likelihood(vocabulary, by_text, word, logp):
    text = lattice.MARK + word
    sums = [-math.inf] * (len(text) + 1)
    sums[0] = 0.0
    for end in range(1, len(text) + 1):
        for begin in range(end):
            piece = text[begin:end]
            if piece in by_text:
                sums[end] = np.logaddexp(sums[end], sums[begin] + logp[by_text[piece]])
            elif end == begin + 1:
                sums[end] = np.logaddexp(sums[end], sums[begin] + logp[vocabulary.byte_ids[list(piece.encode())]].sum())
    return sums[-1]


def test_likelihood_sums_all_segmentations(vocabulary):
    model = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
    ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    by_text = {model.id_to_piece(i): k for k, i in enumerate(ids) if not model.is_byte(i)}
    words = ["the", "unbelievable", "ciónque", "日本語x", "🙂", "a", "\x01", "e" * 60]
    found = vocabulary.likelihood([w.encode() for w in words], vocabulary.prior)
    assert found == pytest.approx([plain_likelihood(vocabulary, by_text, w, vocabulary.prior) for w in words], rel=1e-9)
    assert np.exp(vocabulary.prior).sum() == pytest.approx(1.0)


def test_expected_counts_raise_the_likelihood(vocabulary):
    words, counts = [b"running", b"runs", b"the", b"theatre"], np.array([5.0, 2.0, 40.0, 1.0])
    expected = vocabulary.expected(words, counts, vocabulary.prior)
    prior = np.exp(vocabulary.prior)
    adapted = np.log((expected + prior) / (expected + prior).sum())
    assert (counts * vocabulary.likelihood(words, adapted)).sum() > (counts * vocabulary.likelihood(words, vocabulary.prior)).sum()


@pytest.mark.parametrize("folder", [None, SMALL])
def test_lm_scores(spark, monkeypatch, folder):
    monkeypatch.setattr(lm_scoring, "BLOCK", 40_000)  # several blocks in a task
    if folder:
        docs = spark.read.parquet(f"{folder}/documents.parquet")
    else:
        rows = [(1, None, 0.5), (2, "", 0.5), (None, "null id here", 0.5), (3, "The the THE é É", 0.5), (4, "word " * 30_000, 0.5), (5, "x y", 0.5), (5, "x y", 0.5)]
        docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    scored = lm_scoring.lm_scores(docs, "doc_id", "text", queries.PIECES).collect()
    texts = [(r["doc_id"], (r["text"] or "").encode().lower().split() + [None]) for r in docs.collect()]
    learned = [words for i, words in texts if i is not None and remainder(i, 10)]
    counts = Counter(w for words in learned for w in words)
    total, distinct = sum(counts.values()), len(counts)

    def base(words):
        return sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in words)

    expected = [(i, i is None or not remainder(i, 10), len(w), sum(counts[x] > 0 for x in w), total, round(base(w), 6)) for i, w in texts]
    found = [(r[0], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in scored]
    assert sorted(map(str, found)) == sorted(map(str, expected))
    assert all(r["score"] < 0 for r in scored)
    if folder:
        per_token = sum(r["score"] for r in scored if r["held_out"]) / sum(r["n_tokens"] for r in scored if r["held_out"])
        unknown = math.log10(0.1 / (total + 0.1 * (distinct + 1)))
        assert unknown < per_token < -1
    assert lm_scoring.lm_scores(docs.limit(0), "doc_id", "text", queries.PIECES).collect() == []


def test_scores_prefer_the_language_learned(spark):
    prose = "the river ran slowly past the old mill and the children played near the water"
    rows = [(i, prose) for i in range(1, 40)] + [(1000, "the old river and the mill"), (1001, "qzx jwk vvq xkz")]
    scored = lm_scoring.lm_scores(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", queries.PIECES)
    by_id = {r["doc_id"]: r["score"] / r["n_tokens"] for r in scored.collect()}
    assert by_id[1000] > by_id[1001] + 1


# classifiers


def test_boosting_learns_and_traverses():
    rng = np.random.default_rng(0)
    rows = rng.normal(size=(3000, 5))
    label = ((rows[:, 0] > 0.3) ^ (rows[:, 2] < -0.5)).astype(float)
    forest = boosting.fit(rows[:2000], label[:2000])
    assert ((forest.probability(rows[2000:]) > 0.5) == label[2000:]).mean() > 0.95

    def plain(row):
        total = forest.start
        for tree in range(len(forest.feature)):
            at = 0
            for _ in range(forest.depth):
                at = 2 * at + (2 if row[forest.feature[tree, at]] > forest.limit[tree, at] else 1)
            total += forest.leaf[tree, at - forest.feature.shape[1]]
        return total

    assert forest.raw(rows[:20]) == pytest.approx([plain(r) for r in rows[:20]])


@pytest.mark.parametrize("name, label, folds, held, least", [("op8_quality_model", "quality", 5, 0, 0.95), ("op10_toxicity", "toxic", 4, 2, 0.9)])
def test_held_out_accuracy(spark, name, label, folds, held, least):
    scored = queries.llm_queries()[name](spark, FOLDER).toPandas()
    assert (scored["held_out"] == [remainder(i, folds) == held for i in scored["doc_id"]]).all()
    assert scored["score"].between(0, 1).all() and (scored["predicted"] == (scored["score"] >= 0.3)).all()
    known = scored[scored["held_out"]].merge(spark.read.parquet(f"{FOLDER}/labels.parquet").toPandas(), on="doc_id")
    assert (known["predicted"] == known[label]).mean() >= least


@pytest.mark.parametrize("scores, label", [(quality_model.quality_scores, "quality"), (toxicity.toxicity_scores, "toxic")])
def test_classifiers_take_odd_rows(spark, scores, label):
    text = "You are a pathetic idiot and a worthless clown."
    rows = [(1, None, 1.0), (2, "", 1.0), (None, text, 1.0), (3, "word " * 50_000, 1.0), (4, text, 1.0), (4, text, 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    none = spark.createDataFrame([], f"doc_id long, {label} int")
    found = scores(docs, none).collect()
    assert len(found) == 6 and all(0 <= r["score"] <= 1 for r in found)
    # null labels and ids, one kind of label only
    one = spark.createDataFrame([(1, 1), (2, None), (None, 1), (4, 1), (4, 1), (3, 1)], f"doc_id long, {label} int")
    assert len(scores(docs, one).collect()) == 6
    both = spark.createDataFrame([(i, i % 2) for i in range(1, 5)], f"doc_id long, {label} int")
    assert len(scores(docs, both).collect()) == 6
    assert scores(docs.limit(0), one).collect() == []
    if label == "toxic":
        by_id = {r["doc_id"]: r["score"] for r in found}
        assert by_id[4] > 0.9 > 0.3 > by_id[2]


def test_label_model_sees_through_noise():
    rng = np.random.default_rng(1)
    truth = rng.random(4000) < 0.2
    fires = np.column_stack([(rng.random(4000) < np.where(truth, 0.6, 0.002)) for _ in range(6)]).astype(float)
    quiet = ~fires.any(axis=1)
    copies = np.column_stack([fires, fires[:, :1], fires[:, :1], quiet])  # two voters repeat the first
    noisy = np.where(rng.random(4000) < 0.1, ~truth, truth).astype(float)
    posterior = toxicity.label_model(copies, noisy)
    assert ((posterior > 0.5) == truth).mean() > (noisy == truth).mean() + 0.01


# vectors


def plain_links(vectors, threshold):
    usable = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for v in vectors]
    out = [set() for _ in vectors]
    for i, a in enumerate(vectors):
        for j, b in enumerate(vectors):
            if i != j and usable[i] and usable[j] and len(a) == len(b):
                x, y = np.array(a, float), np.array(b, float)
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= threshold:
                    out[i].add(j)
    return out


def plain_components(links):
    seen = {}
    for start in range(len(links)):
        todo = [start]
        while todo:
            i = todo.pop()
            if i not in seen:
                seen[i] = start
                todo.extend(links[i])
    return [seen[i] for i in range(len(links))]


def test_vectors_of_any_kind(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 7)  # cells of several blocks
    rng = np.random.default_rng(2)
    base = rng.normal(size=(6, 8)).astype(np.float32)
    rows = [(i, (base[i % 6] + rng.normal(size=8) * 0.12).astype(np.float32).tolist()) for i in range(60)]
    rows += [(70 + i, base[0].tolist()) for i in range(9)] + [(80, (base[0] * 2).tolist()), (None, base[0].tolist())]
    rows += [(90, None), (91, []), (92, [0.0] * 8), (93, [1.0, None] * 4), (94, [float("nan")] * 8), (95, [float("inf")] + [0.0] * 7), (96, base[0].tolist()[:4]), (96, base[0].tolist()[:4])]
    table = spark.createDataFrame([(i, v, "x", 0) for i, v in rows], "vec_id long, embedding array<float>, node string, copies int")
    found = embedding_dedup.near_duplicates(table, "vec_id", "embedding").collect()
    links = plain_links([v for _, v in rows], embedding_dedup.THRESHOLD)
    least = {}
    for (i, _), c in zip(rows, plain_components(links)):
        if i is not None:
            least[c] = min(least.get(c, i), i)
    expected = [(i, len(link), least[c], i is not None and i == least[c]) for (i, _), link, c in zip(rows, links, plain_components(links))]
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))
    assert embedding_dedup.near_duplicates(table.limit(0), "vec_id", "embedding").collect() == []


def test_recall_on_hard_pairs(spark):
    rng = np.random.default_rng(3)
    one = embedding_dedup.unit(rng.normal(size=(1500, 64)))
    off = rng.normal(size=one.shape)
    off = embedding_dedup.unit(off - (off * one).sum(axis=1, keepdims=True) * one)
    two = 0.905 * one + math.sqrt(1 - 0.905**2) * off  # barely linked
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([one, two]))]
    found = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding")
    linked = found.where("n_links > 0").count()
    assert linked >= 0.98 * len(rows)


@pytest.mark.parametrize("dimensions", [3, 8, 16, 64])
def test_one_of_a_linked_pair_visits_the_others_home(dimensions):
    rng = np.random.default_rng(5)
    one = embedding_dedup.unit(rng.normal(size=(3000, dimensions)))
    off = rng.normal(size=one.shape)
    off = embedding_dedup.unit(off - (off * one).sum(axis=1, keepdims=True) * one)
    two = 0.9 * one + math.sqrt(1 - 0.9**2) * off
    centroids = embedding_dedup.spherical_kmeans(np.concatenate([one, two]), 78)
    reach = math.sqrt(2 - 2 * embedding_dedup.THRESHOLD) / 2
    (home_one, one_visits), (home_two, two_visits) = (embedding_dedup.cells_of(x, centroids, reach) for x in (one, two))
    at = np.arange(len(one))
    assert one_visits[at, home_one].all() and two_visits[at, home_two].all()
    assert (one_visits[at, home_two] | two_visits[at, home_one]).all()


def test_no_link_is_lost_in_few_dimensions(spark):
    rng = np.random.default_rng(6)
    one = embedding_dedup.unit(rng.normal(size=(1000, 8)))
    off = rng.normal(size=one.shape)
    off = embedding_dedup.unit(off - (off * one).sum(axis=1, keepdims=True) * one)
    rows = np.concatenate([one, 0.905 * one + math.sqrt(1 - 0.905**2) * off])
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    found = {r["vec_id"]: r["n_links"] for r in embedding_dedup.near_duplicates(table, "vec_id", "embedding").collect()}
    rows = embedding_dedup.unit(rows)
    assert [found[i] for i in range(len(rows))] == ((rows @ rows.T >= embedding_dedup.THRESHOLD).sum(axis=1) - 1).tolist()


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    links = plain_links([r["embedding"] for r in rows], 0.9)
    found = {r["vec_id"]: r["n_links"] for r in queries.op4_embedding_dedup(spark, SMALL).collect()}
    assert found == {r["vec_id"]: len(link) for r, link in zip(rows, links)}
