"""Language-model scores: marginal probability of a text over all segmentations into pieces (operator 7).

The pieces are an existing vocabulary; its scores are the first probabilities, and expectation-maximisation
over the words of the training texts adapts them (EM_ROUNDS rounds over all distinct words). A text's
probability is the product of its words' and of one end; the words are independent of each other, so each
distinct word is scored once.

Consecutive texts form blocks of about BLOCK bytes, kept compressed in a checkpoint. A block names its distinct
words, cut into buckets by hash; a bucket gathers the counts of its words from all blocks, scores them, and
answers each block in the order in which that named them. So a word travels once for each block, however often
and in however many texts it occurs, and no word count is ever broadcast or collected.

Null and empty texts have one token, the end. Rows with a null id count as held out. Repeated rows count and
are scored one by one; an empty table gives an empty table. Words are bytes, lower-cased for A to Z.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from paddock.llm.common import utf8
from paddock.llm.lattice import pieces
from paddock.llm.quality_model import fold
from paddock.session import cut_lineage

FOLDS, HELD_OUT = 10, 0
BLOCK = 16 << 20
EM_ROUNDS = 2
PRIOR_COUNT = 100.0  # what the vocabulary's own scores count for
MOST_BUCKETS = 4096
ADD = 0.1  # of the base score


def _blocks(df: DataFrame, id_column: str, text: str) -> DataFrame:
    """(block, ids, held, sizes, packed): lower-cased texts of consecutive rows."""
    held = F.coalesce(fold(id_column, FOLDS) == HELD_OUT, F.lit(True))
    rows = df.select(F.col(f"`{id_column}`").alias("id"), held.alias("held"), utf8(text).alias("data"))
    kind = rows.schema["id"].dataType

    def pack(batches):
        import pyarrow as pa
        import zstandard
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_type

        compress, number, ids, held, texts, size = zstandard.ZstdCompressor(level=3).compress, 0, [], [], [], 0
        of_id = to_arrow_type(kind)

        def block():
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([TaskContext.get().partitionId() << 32 | number]),
                    pa.array([ids], pa.list_(of_id)),
                    pa.array([held], pa.list_(pa.bool_())),
                    pa.array([list(map(len, texts))], pa.list_(pa.int64())),
                    pa.array([compress(b"".join(texts))], pa.binary()),
                ],
                names=["block", "ids", "held", "sizes", "packed"],
            )

        for batch in batches:
            for i in range(len(batch)):
                data = batch.column(2)[i].as_buffer().to_pybytes().lower()
                ids.append(batch.column(0)[i].as_py())
                held.append(batch.column(1)[i].as_py())
                texts.append(data)
                size += len(data)
                if size >= BLOCK:
                    yield block()
                    number, ids, held, texts, size = number + 1, [], [], [], 0
        if ids:
            yield block()

    schema = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("ids", T.ArrayType(kind)),
            T.StructField("held", T.ArrayType(T.BooleanType())),
            T.StructField("sizes", T.ArrayType(T.LongType())),
            T.StructField("packed", T.BinaryType()),
        ]
    )
    return cut_lineage(rows.mapInArrow(pack, schema))


def _texts(packed: bytes, sizes) -> list[bytes]:
    import zstandard

    data = zstandard.ZstdDecompressor().decompress(packed)
    ends = np.cumsum(np.asarray(sizes, np.int64))
    return [data[e - s : e] for e, s in zip(ends.tolist(), sizes)]


def _named(words, buckets: int) -> dict[int, list[bytes]]:
    """The words by bucket, sorted: the order in which a block names them, and in which it is answered."""
    import xxhash

    out: dict[int, list[bytes]] = {}
    for word in sorted(words):
        out.setdefault(xxhash.xxh64_intdigest(word) % buckets, []).append(word)
    return out


def _words(blocks: DataFrame, buckets: int) -> DataFrame:
    """(bucket, block, words, counts): distinct words of a block, and how often they occur in training texts."""

    def count(batches):
        import pyarrow as pa
        import zstandard

        compress = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            for i in range(len(batch)):
                learned: Counter = Counter()
                held_words: set[bytes] = set()
                for text, held in zip(_texts(batch.column(3)[i].as_py(), batch.column(2)[i].as_py()), batch.column(1)[i].as_py()):
                    (held_words if held else learned).update(text.split())
                for word in held_words:
                    learned[word] += 0
                named = _named(learned, buckets)
                counts = [compress(np.array([learned[w] for w in words], "<i8").tobytes()) for words in named.values()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(list(named), pa.int32()),
                        pa.array([batch.column(0)[i].as_py()] * len(named), pa.int64()),
                        pa.array([compress(b"\n".join(words)) for words in named.values()], pa.binary()),
                        pa.array(counts, pa.binary()),
                    ],
                    names=["bucket", "block", "words", "counts"],
                )

    schema = "bucket int, block long, words binary, counts binary"
    return cut_lineage(blocks.select("block", "held", "sizes", "packed").mapInArrow(count, schema))


def _merged(frame) -> tuple[list[list[bytes]], Counter]:
    """The words that each block names, and their counts over all blocks."""
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    lists, counts = [unpack(w).split(b"\n") for w in frame["words"]], Counter()
    for words, packed in zip(lists, frame["counts"]):
        for word, n in zip(words, np.frombuffer(unpack(packed), "<i8").tolist()):
            counts[word] += n
    return lists, counts


def _expected(words: DataFrame, path: str, logp) -> dict[int, float]:
    """Expected counts by piece, the tokens (-1) and the known words (-2)."""
    spread = words.sparkSession.sparkContext.broadcast(logp)  # a number for each piece

    def expect(frame):
        import pandas as pd

        _, counts = _merged(frame)
        known = {w: n for w, n in counts.items() if n}
        vocabulary = pieces(path)
        logp = vocabulary.prior if spread.value is None else spread.value
        numbers = np.fromiter(known.values(), np.float64, len(known))
        expected = vocabulary.expected(list(known), numbers, logp)
        at = np.flatnonzero(expected)
        return pd.DataFrame(
            {"piece": np.concatenate([at, [-1, -2]]).astype("int32"), "n": np.concatenate([expected[at], [numbers.sum(), float(len(known))]])}
        )

    rows = words.groupBy("bucket").applyInPandas(expect, "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n"))
    return {row["piece"]: row["n"] for row in rows.collect()}


def lm_scores(df: DataFrame, id_column: str, text: str, path: str) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score); ``path``: the vocabulary on every node."""
    blocks = _blocks(df, id_column, text)
    buckets = min(MOST_BUCKETS, max(12, 2 * blocks.count()))
    words = _words(blocks, buckets)
    ends = blocks.select(F.explode("held").alias("held")).agg(F.sum((~F.col("held")).cast("long"))).first()[0] or 0
    logp, end, tokens, known = None, 0.0, 0, 0
    prior = np.exp(pieces(path).prior)
    for _ in range(EM_ROUNDS):
        found = _expected(words, path, logp)
        tokens, known = int(round(found.pop(-1, 0.0))), int(round(found.pop(-2, 0.0)))
        expected = PRIOR_COUNT * prior
        expected[list(found)] += list(found.values())
        total = expected.sum() + ends + 1.0
        logp, end = np.log(expected / total), float(np.log10((ends + 1.0) / total))
    train_tokens, distinct = tokens + ends, known + (1 if ends else 0)
    base_of = lambda n: np.log10((n + ADD) / (train_tokens + ADD * (distinct + 1)))
    spread = df.sparkSession.sparkContext.broadcast(logp)

    def answer(frame):
        import pandas as pd
        import zstandard

        compress = zstandard.ZstdCompressor(level=1).compress
        lists, counts = _merged(frame)
        everything = list(counts)
        score = dict(zip(everything, (pieces(path).likelihood(everything, spread.value) / np.log(10.0)).tolist()))
        return pd.DataFrame(
            {
                "block": frame["block"],
                "bucket": frame["bucket"],
                "counts": [compress(np.array([counts[w] for w in words], "<i8").tobytes()) for words in lists],
                "scores": [compress(np.array([score[w] for w in words], "<f8").tobytes()) for words in lists],
            }
        )

    answers = words.groupBy("bucket").applyInPandas(answer, "block long, bucket int, counts binary, scores binary")
    end_base, end_known = float(base_of(ends)), int(ends > 0)

    def score(mine, answers):
        import pandas as pd
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        texts = _texts(mine["packed"].iloc[0], list(mine["sizes"].iloc[0]))
        split = [x.split() for x in texts]
        del texts
        named = _named(set().union(*split), buckets)
        values: dict[bytes, complex] = {}
        unknown: set[bytes] = set()
        for bucket, counts, scores in zip(answers["bucket"], answers["counts"], answers["scores"]):
            words, n = named[bucket], np.frombuffer(unpack(counts), "<i8")
            # both sums in one pass: the base score is the real part, the model's the imaginary part
            values.update(zip(words, (base_of(n) + 1j * np.frombuffer(unpack(scores), "<f8")).tolist()))
            unknown.update(words[i] for i in np.flatnonzero(n == 0).tolist())
        sums = [sum(map(values.__getitem__, words), 0j) for words in split]
        known = [len(words) - sum(w in unknown for w in words) if unknown else len(words) for words in split]
        return pd.DataFrame(
            {
                "id": list(mine["ids"].iloc[0]),
                "held_out": list(mine["held"].iloc[0]),
                "n_tokens": [len(words) + 1 for words in split],
                "n_known": [n + end_known for n in known],
                "train_tokens": train_tokens,
                "base_score": [s.real + end_base for s in sums],
                "score": [s.imag + end for s in sums],
            }
        )

    kind = df.schema[id_column].dataType
    schema = T.StructType([T.StructField("id", kind)] + T._parse_datatype_string(
        "held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    ).fields)
    # a block without any word has no answer, so it is the left side that counts
    scored = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(score, schema)
    return scored.withColumnRenamed("id", id_column)
