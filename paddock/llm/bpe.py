"""Byte-level BPE encoding and decoding of whole texts (operator 1).

Nothing is shuffled: each text is cut by the pattern, each match is run through the transducer of
``transducer.py`` with its tables kept per Python worker, and ids travel packed (little-endian unsigned
32-bit integers). A null or empty text has no ids; invalid UTF-8 is read as U+FFFD. Rows are kept as they
are, repeated ones too; an empty table gives an empty table.
"""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, functions as F

from paddock.llm.common import fresh, scanned

IDS_PER_STEP = 1 << 16


def _encoder(ranks: str, pattern: str, **tables: int):
    import regex

    from paddock.llm.transducer import transducer

    gc.disable()  # tables hold millions of tuples; walking them takes longer than encoding
    coder, cut = transducer(ranks, **tables), regex.compile(pattern)
    return lambda data: coder.packed(cut.findall(data.decode("utf-8", "replace")))


def _decoder(ranks: str):
    import numpy as np

    from paddock.llm.transducer import StreamDecoder, token_bytes

    tokens = token_bytes(ranks)

    def text(packed: bytes) -> str:
        decoder, ids = StreamDecoder(tokens), np.frombuffer(packed, "<u4")
        parts = [decoder.feed(ids[i : i + IDS_PER_STEP].tolist()) for i in range(0, len(ids), IDS_PER_STEP)]
        return "".join([*parts, decoder.finish()])

    return text


def _others(df: DataFrame, *names: str):
    taken = {n.lower() for n in names}
    return {c: F.col(f"`{c}`") for c in df.columns if c.lower() not in taken}


def encode(df: DataFrame, text: str, ranks: str, pattern: str, ids: str = "token_ids") -> DataFrame:
    """``df`` with a binary column of packed ids. ``ranks``: path of a rank file on every node."""
    return scanned(df, lambda texts: {ids: list(map(_encoder(ranks, pattern), texts))}, F.col(f"`{text}`"), f"`{ids}` binary", _others(df, ids))


def decode(df: DataFrame, ids: str, ranks: str, text: str = "decoded") -> DataFrame:
    """``df`` with the text of its packed ids, decoded piece by piece; unknown ids are an error."""
    step = fresh("decoded_text")
    scan = lambda packed: {step: list(map(_decoder(ranks), packed))}
    return scanned(df, scan, F.col(f"`{ids}`"), f"`{step}` string", _others(df, text)).withColumnRenamed(step, text)


def round_trip(df: DataFrame, text: str, ranks: str, pattern: str, ids: str = "token_ids", decoded: str = "decoded", **tables: int) -> DataFrame:
    """``df`` with packed ids and what they decode to, in one pass: one Python worker holds both tables.

    ``tables``: sizes as in ``Transducer``; larger ones are faster and take more memory.
    """

    def scan(texts: list[bytes]) -> dict[str, list]:
        packed = list(map(_encoder(ranks, pattern, **tables), texts))
        return {ids: packed, decoded: list(map(_decoder(ranks), packed))}

    return scanned(df, scan, F.col(f"`{text}`"), f"`{ids}` binary, `{decoded}` string", _others(df, ids, decoded))
