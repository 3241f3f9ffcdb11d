"""Quality classifier: boosted trees over statistics of the text (operator 8).

The trees are fitted on at most TRAIN_ROWS labelled rows, those with the smallest hash of their id; every text is
then scored in one pass, batch by batch. Statistics come from the text alone.

Null and empty texts have all statistics 0 and get the trees' score for them. Rows with a null id count as held
out. Without labelled rows of both kinds every score is the share of label 1 (0.5 if there is none).
Repeated labels of an id are all learned from; an empty table gives an empty table.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from paddock.llm import boosting
from paddock.llm.common import scanned
from paddock.llm.quality_rules import LEVEL, repeated_words

TRAIN_ROWS = 20_000
FOLDS, HELD_OUT = 5, 0
CUT = 0.3
CONTINUATION = bytes(range(0x80, 0xC0))
LOWER, UPPER, DIGITS = (bytes(range(a, b + 1)) for a, b in ((97, 122), (65, 90), (48, 57)))
ENDS, PUNCTUATION, SYMBOLS = b".!?", b",;:'\"()-", b"#*$%&|<>{}[]\\/=+~^_@`"


def fold(id_column: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    value = F.col(f"`{id_column}`") if isinstance(id_column, str) else id_column
    return F.crc32(value.cast("string").cast("binary")) % folds


def statistics(text: bytes, compress) -> list[float]:
    """Figures that describe a text; shares lie between 0 and 1."""
    size = len(text)
    if not size:
        return [0.0] * 22
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    count = max(len(words), 1)
    counts = Counter(words)
    without = lambda drop: size - len(text.translate(None, drop))
    chars = size - without(CONTINUATION)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1)
    top = max(counts.values(), default=0)
    return [
        float(np.log1p(size)),
        float(np.log1p(len(words))),
        float(np.log1p(len(lines))),
        float(sizes.mean()),
        float(sizes.std()),
        float(sizes.max()),
        len(words) / max(len(lines), 1),
        without(LOWER) / size,
        without(UPPER) / size,
        without(DIGITS) / size,
        without(ENDS) / size,
        without(PUNCTUATION) / size,
        without(SYMBOLS) / size,
        (size - chars) / size,
        without(b" \t\n\v\f\r") / size,
        text.count(b"!") / size,
        len(counts) / count,
        top / count,
        1.0 - len(set(lines)) / max(len(lines), 1),
        repeated_words(words) / count,
        size / len(compress(text)),
        sum(word[-1:] in b".!?" for word in words) / count,
    ]


def described(df: DataFrame, text: str, keep: dict[str, Column]) -> DataFrame:
    """The columns of ``keep`` and the statistics of the text as an array."""

    def scan(texts: list[bytes]) -> dict[str, list]:
        import zstandard

        compress = zstandard.ZstdCompressor(level=LEVEL).compress
        return {"statistics": [statistics(x, compress) for x in texts]}

    return scanned(df, scan, F.col(f"`{text}`"), "statistics array<double>", keep)


def sample_of(labels: DataFrame, id_column: str, label: str, learned: Column, rows: int) -> DataFrame:
    """At most ``rows`` labelled rows (id, label) to learn from: the smallest hashes of the id."""
    known = labels.where(learned & F.col(f"`{label}`").isNotNull()).select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{label}`").cast("double").alias("label"))
    return known.orderBy(F.xxhash64("id"), "id", "label").limit(rows)


def fit(docs: DataFrame, labels: DataFrame, id_column: str, text: str, label: str, folds: int = FOLDS, held_out: int = HELD_OUT, rows: int = TRAIN_ROWS):
    """Trees fitted on the bounded sample; its statistics are collected, some 200 bytes a row."""
    sample = sample_of(labels, id_column, label, fold(id_column, folds) != held_out, rows)
    chosen = docs.join(F.broadcast(sample), docs[id_column] == sample["id"]).select(F.col(f"`{text}`").alias("text"), "label")
    known = described(chosen, "text", {"label": F.col("label")}).toPandas()
    target = known["label"].to_numpy(float)
    if len(known) == 0 or target.min() == target.max():
        return float(target.mean()) if len(known) else 0.5
    # a fixed order, so that a rerun sums alike
    matrix = np.stack(known["statistics"].to_list())
    order = np.lexsort(matrix.T)
    return boosting.fit(matrix[order], target[order])


def score(docs: DataFrame, text: str, model, keep: dict[str, Column]) -> DataFrame:
    """The columns of ``keep`` and the probability of label 1 for the text."""
    spread = docs.sparkSession.sparkContext.broadcast(model)  # some thousand numbers

    def scan(texts: list[bytes]) -> dict[str, np.ndarray]:
        import zstandard

        model = spread.value
        if isinstance(model, float):
            return {"score": np.full(len(texts), model)}
        compress = zstandard.ZstdCompressor(level=LEVEL).compress
        return {"score": model.probability(np.array([statistics(x, compress) for x in texts]))}

    return scanned(docs, scan, F.col(f"`{text}`"), "score double", keep)


def quality_scores(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """(id, held_out, score, predicted) of each row of ``docs``."""
    model = fit(docs, labels, id_column, text, label)
    held = F.coalesce(fold(id_column, FOLDS) == HELD_OUT, F.lit(True))
    scored = score(docs, text, model, {id_column: F.col(f"`{id_column}`"), "held_out": held})
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))
