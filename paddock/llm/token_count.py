"""Token counts of whole texts for a byte-level tokenizer file (operator 2).

Offline, every string of the vocabulary is merged on its own; those that come out as one token count as 1
when a pre-token equals them. Only other pre-tokens are merged, the most frequent ones once per worker.
Special strings are cut out first and count one token, as the tokenizer does by default. One pass, no shuffle.
Null and empty texts have 0 tokens, rows are kept as they are, an empty table gives an empty table.
"""

from __future__ import annotations

import gc
import json
import os

from pyspark.sql import Column, DataFrame, functions as F

from paddock.llm.common import scanned
from paddock.llm.transducer import Transducer, merge

#: The pattern of the byte-level pre-tokenizer (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def printable_bytes() -> dict[str, int]:
    """The character that stands for each byte in such files: itself if it prints, else the next from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


MOST_PIECES = 350_000  # of a generation


class TokenCounter:
    """Counts of one tokenizer file; other kinds of tokenizers are refused."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        kind, model = spec["pre_tokenizer"] or {}, spec["model"]
        refused = (
            spec["normalizer"] or kind.get("type") != "ByteLevel" or kind.get("add_prefix_space") or not kind.get("use_regex", True)
            or model["type"] != "BPE" or model.get("ignore_merges") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix")
            or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
        )
        if refused:
            raise ValueError(f"not a plain byte-level BPE file: {path}")
        byte = printable_bytes()
        as_bytes = lambda s: bytes(byte[c] for c in s)
        specials = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self._special = regex.compile("|".join(map(regex.escape, specials))) if specials else None
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        # a merge ranks before all later ones; single bytes before every merge
        ranks = {bytes([b]): b for b in range(256)}
        ranks |= {as_bytes(left) + as_bytes(right): 256 + i for i, (left, right) in reversed(list(enumerate(pairs)))}
        self._merger = Transducer(ranks, pairs=500_000, states=250_000)
        #: Strings proven to be one token by themselves; the bound is the vocabulary's size.
        self.whole = {
            data.decode(): 1
            for token in model["vocab"]
            if token not in specials and (data := as_bytes(token)) in ranks and merge(data, ranks) == [ranks[data]] and valid(data)
        }
        self._cut = regex.compile(PATTERN)
        # whole tokens count as known from the start; of the others the recent ones are kept, in two generations
        self._young, self._old = dict(self.whole), {}

    def _miss(self, piece: str) -> int:
        known = self._old.get(piece)
        if known is None:
            known = len(self._merger.ids(piece.encode("utf-8", "surrogatepass")))
        if len(self._young) >= MOST_PIECES:
            self._old, self._young = self._young, dict(self.whole)
        self._young[piece] = known
        return known

    def count(self, text: str) -> int:
        if self._special is None or not self._special.search(text):
            return self._plain(text)
        parts = self._special.split(text)
        return len(parts) - 1 + sum(map(self._plain, parts))

    def _plain(self, text: str) -> int:
        known, miss = self._young.get, self._miss
        return sum([known(piece) or miss(piece) for piece in self._cut.findall(text)])


def valid(data: bytes) -> bool:
    try:
        data.decode()
    except UnicodeDecodeError:
        return False
    return True


_LOADED: dict[tuple[str, float], TokenCounter] = {}


def counter(path: str) -> TokenCounter:
    key = (path, os.path.getmtime(path))
    if key not in _LOADED:
        _LOADED[key] = TokenCounter(path)
    return _LOADED[key]


def token_counts(df: DataFrame, text: str, path: str, keep: dict[str, Column]) -> DataFrame:
    """The columns of ``keep``, then n_bytes (UTF-8) and n_tokens of the text. ``path``: the file on every node."""

    def scan(texts: list[bytes]) -> dict[str, list[int]]:
        gc.disable()  # see bpe.encode
        tokens = counter(path)
        return {"n_bytes": [len(x) for x in texts], "n_tokens": [tokens.count(x.decode("utf-8", "replace")) for x in texts]}

    return scanned(df, scan, F.col(f"`{text}`"), "n_bytes long, n_tokens long", keep)
