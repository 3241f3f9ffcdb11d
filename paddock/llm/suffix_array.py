"""Suffix arrays of many short stretches of text, in numpy."""

from __future__ import annotations

import numpy as np

_PACK = 7  # symbols of 9 bits in one key


def build(stretches: list[bytes]):
    """Suffix array of the stretches, each followed by an end of its own, which is smaller than any byte.

    Returns (symbols, key, owner, sa): symbols are bytes + 1 and 0 at the ends; key packs the symbols from a position
    on; owner is the stretch of a position. Larsson-Sadakane refinement: suffixes are grouped by their
    first symbols, then only groups that are still together are sorted by the group of the suffix that lies as
    far ahead as is sorted already, which doubles the sorted length each time.
    """
    lengths = np.array([len(s) for s in stretches], np.int64) + 1
    size = int(lengths.sum())
    ends = np.cumsum(lengths) - 1
    symbols = np.zeros(size, np.uint64)
    inner = np.ones(size, bool)
    inner[ends] = False
    symbols[inner] = np.frombuffer(b"".join(stretches), np.uint8).astype(np.uint64) + np.uint64(1)
    owner = np.repeat(np.arange(len(stretches), dtype=np.int64), lengths)
    left = ends[owner] - np.arange(size)  # symbols before the end
    key = np.zeros(size, np.uint64)
    for i in range(_PACK):
        ahead = np.zeros(size, np.uint64)
        ahead[: max(size - i, 0)] = symbols[i:]
        ahead[left < i] = 0
        key = key << np.uint64(9) | ahead
    # ends differ from each other: suffixes whose key reaches the end are told apart by their stretch
    sa = np.lexsort((np.where(left < _PACK, owner + 1, 0), key))
    sorted_key, reach = key[sa], np.where(left[sa] < _PACK, owner[sa] + 1, 0)
    first = np.ones(size, bool)
    first[1:] = (sorted_key[1:] != sorted_key[:-1]) | (reach[1:] != reach[:-1])
    del sorted_key, reach
    start = np.maximum.accumulate(np.where(first, np.arange(size), 0))
    group = np.empty(size, np.int64)
    group[sa] = start
    together = _unsorted(first)
    depth = _PACK
    while len(together):
        suffixes = sa[together]
        order_key = (group[suffixes] << 32) | group[suffixes + depth]
        order = np.argsort(order_key, kind="stable")
        suffixes, order_key = suffixes[order], order_key[order]
        sa[together] = suffixes
        first = np.ones(len(together), bool)
        first[1:] = order_key[1:] != order_key[:-1]
        start = np.maximum.accumulate(np.where(first, together, 0))
        group[suffixes] = start
        together = together[_unsorted(first)]
        depth *= 2
    return symbols, key, owner, sa


def _unsorted(first: np.ndarray) -> np.ndarray:
    """Indices of entries whose group has more than one; ``first`` marks where groups begin."""
    alone = first.copy()
    alone[:-1] &= first[1:]
    return np.flatnonzero(~alone)


def common_prefixes(symbols: np.ndarray, key: np.ndarray, owner: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each suffix in ``sa`` and the one before it (0 for the first).

    Kasai's observation, over positions: the common prefix of the next position is at most one shorter. So it is
    measured only where the symbols before the two suffixes differ; elsewhere it is one less than at
    the position before.
    """
    size = len(sa)
    before = np.full(size, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    at = np.arange(size)
    measured = (before <= 0) | (at == 0)
    inner = ~measured
    a, b = at[inner], before[inner]
    measured[inner] = (symbols[a - 1] != symbols[b - 1]) | (symbols[a - 1] == 0)
    a = at[measured & (before >= 0)]
    b, length = before[a], np.zeros(len(a), np.int64)
    open_ = np.arange(len(a))
    while len(open_):
        x, y = a[open_] + length[open_], b[open_] + length[open_]
        same = key[x] == key[y]
        # equal keys that reach an end are equal up to it and no further
        whole = same & (symbols[np.minimum(x + _PACK - 1, size - 1)] != 0) & (owner[np.minimum(x + _PACK - 1, size - 1)] == owner[x])
        rest = open_[~whole]
        i, j = a[rest] + length[rest], b[rest] + length[rest]
        going = np.ones(len(rest), bool)
        for _ in range(_PACK):
            going &= (symbols[np.minimum(i, size - 1)] == symbols[np.minimum(j, size - 1)]) & (symbols[np.minimum(i, size - 1)] != 0)
            i, j = i + going, j + going
        length[rest] = i - a[rest]
        open_ = open_[whole]
        length[open_] += _PACK
    reach = np.zeros(size, np.int64)
    reach[a] = length + a
    by_position = np.maximum(np.maximum.accumulate(reach) - at, 0)
    by_position[before < 0] = 0
    return by_position[sa]
