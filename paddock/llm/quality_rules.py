"""Compression bands: texts that compress too well (repetitive) or too badly (noise) go (operator 3).

A text is rejected if its whole zstandard ratio lies outside the band of its length, or if more than a
quarter of its fixed chunks lie outside the band of the chunk's length. Limits between the listed lengths are
interpolated over the logarithm of the length; below the first length nothing is rejected by compression.
Running prose in European languages lies well inside; longer texts compress better, so limits rise.

Words are runs without ASCII white space (U+0020, U+0009 to U+000D). Null texts have no words. Every row is
judged by its own text in one pass without a shuffle; repeated rows get the same verdict, an empty table
gives an empty table.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections import Counter

from pyspark.sql import Column, DataFrame, functions as F

from paddock.llm.common import scanned

LEVEL = 3
CHUNK_BYTES = 2048
CHUNK_SHARE = 0.25
#: length in bytes, lowest and highest ratio
BANDS = (
    (256, 1.00, 1.75), (512, 1.10, 1.90), (1024, 1.25, 2.05), (2048, 1.35, 2.20), (4096, 1.40, 2.35),
    (8192, 1.45, 2.45), (16384, 1.50, 2.60), (65536, 1.50, 2.90), (1 << 20, 1.50, 3.40),
)
MIN_WORDS = 50
REPEAT_SHARE = 0.5

SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\v\f\r"
CONTINUATION = bytes(range(0x80, 0xC0))
RESULTS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "whole_ratio double, chunks_outside double, base_failed boolean, kept boolean"
)


def band(length: int) -> tuple[float, float]:
    """Lowest and highest ratio for a text of so many bytes."""
    at = bisect_right(BANDS, length, key=lambda row: row[0])
    if at == 0:
        return 0.0, math.inf
    if at == len(BANDS):
        return BANDS[-1][1:]
    (n, low, high), (m, low2, high2) = BANDS[at - 1 : at + 1]
    share = math.log(length / n) / math.log(m / n)
    return low + share * (low2 - low), high + share * (high2 - high)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three which occurs twice or more, overlapping ones and the first included."""
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered = end = 0
    for i in [i for i, window in enumerate(windows) if counts[window] > 1]:
        covered += i + 3 - max(i, end)
        end = i + 3
    return covered


def outside(text: bytes, compress) -> tuple[float, bool]:
    if not text:
        return 0.0, False
    ratio = len(text) / len(compress(text))
    low, high = band(len(text))
    return ratio, not low <= ratio <= high


def judge(text: bytes, compress) -> tuple:
    words = text.split()  # bytes split at exactly the blanks above
    lines = [line for line in text.split(b"\n") if line.strip()]
    repeats = repeated_words(words)
    base_failed = len(words) < MIN_WORDS or repeats > REPEAT_SHARE * len(words)
    ratio, whole_out = outside(text, compress)
    chunks = [outside(text[i : i + CHUNK_BYTES], compress)[1] for i in range(0, len(text), CHUNK_BYTES)]
    share = sum(chunks) / len(chunks) if chunks else 0.0
    return (
        len(words),
        len(text.translate(None, BLANKS + CONTINUATION)),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeats,
        ratio,
        share,
        base_failed,
        not (base_failed or whole_out or share > CHUNK_SHARE),
    )


def quality_rules(df: DataFrame, text: str, keep: dict[str, Column]) -> DataFrame:
    """The columns of ``keep`` and the figures and verdict for the text."""
    names = [part.split()[0] for part in RESULTS.split(", ")]

    def scan(texts: list[bytes]) -> dict[str, tuple]:
        import zstandard

        compress = zstandard.ZstdCompressor(level=LEVEL).compress
        return dict(zip(names, zip(*[judge(x, compress) for x in texts])))

    return scanned(df, scan, F.col(f"`{text}`"), RESULTS, keep)
