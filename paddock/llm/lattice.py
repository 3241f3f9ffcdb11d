"""Marginal likelihood of words over all their segmentations into vocabulary pieces, in numpy.

Words of one length are handled together: the lattice runs over positions, not over words.
"""

from __future__ import annotations

import os

import numpy as np

MARK = "▁"  # begins a word in the vocabulary's pieces
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_SLOTS = 20  # bits of the table of pieces


class Pieces:
    """Pieces of a vocabulary file and their scores; bytes stand in for characters that no piece has."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.byte_ids = np.full(256, -1)
        texts: list[str] = []
        scores = []
        for i in ids:
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = len(texts)
            texts.append("" if model.is_byte(i) else piece)
            scores.append(model.get_score(i))
        # scores of such a file are negative ranks: Zipf's law makes them probabilities
        rank = np.clip(-np.array(scores), 0, len(texts))
        rank[self.byte_ids[self.byte_ids >= 0]] = len(texts)
        self.prior = -np.log(rank + 2.7)
        self.prior -= np.log(np.exp(self.prior).sum())
        self.size = len(texts)
        self.longest = max(map(len, texts))
        self._keys = np.zeros(1 << _SLOTS, np.uint64)
        self._ids = np.full(1 << _SLOTS, -1, np.int64)
        self._probes = 1
        for i, text in enumerate(texts):
            if text:
                key = np.uint64(0)
                with np.errstate(over="ignore"):
                    for c in text:
                        key = (key + np.uint64(ord(c))) * _PRIME
                slot, probe = int(key >> np.uint64(64 - _SLOTS)), 1
                while self._ids[slot] >= 0:
                    slot, probe = (slot + 1) % (1 << _SLOTS), probe + 1
                self._keys[slot], self._ids[slot] = key, i
                self._probes = max(self._probes, probe)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Piece of each key, -1 for none."""
        slot = (keys >> np.uint64(64 - _SLOTS)).astype(np.int64)
        out = np.full(len(keys), -1)
        for _ in range(self._probes):
            out = np.where((self._keys[slot] == keys) & (out < 0), self._ids[slot], out)
            slot = (slot + 1) & ((1 << _SLOTS) - 1)
        return out

    def groups(self, words: list[bytes]):
        """(indices, codes) of the marked words by their number of characters, in portions."""
        texts = [MARK + w.decode("utf-8", "replace") for w in words]
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        for length in np.unique(lengths):
            at = np.flatnonzero(lengths == length)
            step = max(1, 4_000_000 // (int(length) * self.longest))
            for i in range(0, len(at), step):
                part = at[i : i + step]
                codes = np.frombuffer("".join([texts[j] for j in part]).encode("utf-32-le", "surrogatepass"), "<u4")
                yield part, codes.reshape(len(part), int(length))

    def arcs(self, codes: np.ndarray):
        """(begin, end, rows, pieces) of all pieces in words of one length; bytes come as lists of pieces."""
        count, length = codes.shape
        wide = codes.astype(np.uint64)
        for begin in range(length):
            key = np.zeros(count, np.uint64)
            for end in range(begin + 1, min(length, begin + self.longest) + 1):
                key = (key + wide[:, end - 1]) * _PRIME
                found = self.find(key)
                rows = np.flatnonzero(found >= 0)
                if len(rows):
                    yield begin, end, rows, found[rows]
                if end == begin + 1 and len(rows) < count:
                    rest = np.flatnonzero(found < 0)
                    yield begin, end, rest, [self.byte_ids[list(chr(c).encode("utf-8", "surrogatepass"))] for c in codes[rest, begin]]

    def weight(self, pieces, logp: np.ndarray) -> np.ndarray:
        return np.array([logp[b].sum() for b in pieces]) if isinstance(pieces, list) else logp[pieces]

    def likelihood(self, words: list[bytes], logp: np.ndarray) -> np.ndarray:
        """Natural logarithm of the probability of each word, all segmentations summed (forward recursion)."""
        out = np.zeros(len(words))
        for at, codes in self.groups(words):
            forward = np.full((codes.shape[1] + 1, len(at)), -np.inf)
            forward[0] = 0.0
            for begin, end, rows, pieces in self.arcs(codes):
                forward[end, rows] = np.logaddexp(forward[end, rows], forward[begin, rows] + self.weight(pieces, logp))
            out[at] = forward[-1]
        return out

    def expected(self, words: list[bytes], counts: np.ndarray, logp: np.ndarray) -> np.ndarray:
        """How often each piece is expected in the counted words (forward and backward recursion)."""
        out = np.zeros(self.size)
        for at, codes in self.groups(words):
            length = codes.shape[1]
            arcs = [(b, e, r, p, self.weight(p, logp)) for b, e, r, p in self.arcs(codes)]
            forward, backward = (np.full((length + 1, len(at)), -np.inf) for _ in range(2))
            forward[0] = backward[-1] = 0.0
            for begin, end, rows, _, w in arcs:
                forward[end, rows] = np.logaddexp(forward[end, rows], forward[begin, rows] + w)
            for begin, end, rows, _, w in sorted(arcs, key=lambda arc: -arc[0]):
                backward[begin, rows] = np.logaddexp(backward[begin, rows], backward[end, rows] + w)
            for begin, end, rows, pieces, w in arcs:
                share = np.exp(forward[begin, rows] + w + backward[end, rows] - forward[-1, rows]) * counts[at][rows]
                if isinstance(pieces, list):
                    for ids, s in zip(pieces, share):
                        np.add.at(out, ids, s)
                else:
                    out += np.bincount(pieces, share, self.size)
        return out


_LOADED: dict[tuple[str, float], Pieces] = {}


def pieces(path: str) -> Pieces:
    """The pieces of a file, loaded once for each Python worker."""
    key = (path, os.path.getmtime(path))
    if key not in _LOADED:
        _LOADED[key] = Pieces(path)
    return _LOADED[key]
