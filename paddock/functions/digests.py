"""MD5 of many short messages at once, over arrays of numbers."""

from __future__ import annotations

from collections.abc import Callable


def md5_of_keys() -> Callable:
    """A function (key bytes, their ends, prefixes) that goes through the MD5 of each prefix before every key.

    It gives, for each prefix and each part of the keys, the prefix' number, the places of the part's keys, and the digest
    as four arrays of little-endian numbers, whose bytes are its 32 hex digits in their order. Keys may be of any length; those of equally many blocks are taken
    together. It is made within a function and so travels whole: executors may not have this package.
    """
    import math

    constants = [int(abs(math.sin(i + 1)) * 2**32) for i in range(64)]
    turns = [[7, 12, 17, 22], [5, 9, 14, 20], [4, 11, 16, 23], [6, 10, 15, 21]]
    places = [lambda i: i, lambda i: (5 * i + 1) % 16, lambda i: (3 * i + 5) % 16, lambda i: 7 * i % 16]
    rounds = [(constants[i], turns[i // 16][i % 4], places[i // 16](i % 16)) for i in range(64)]
    start = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
    most = 16384  # keys at once, whose arrays stay in a core's cache

    def digest(words, n):
        """Four arrays of little-endian numbers; each word of the message is a number or an array."""
        import numpy as np

        state = [np.full(n, s, np.uint32) for s in start]
        f, t = np.empty(n, np.uint32), np.empty(n, np.uint32)
        for block in range(0, len(words), 16):
            a, b, c, d = (s.copy() for s in state)
            for i, (constant, turn, at) in enumerate(rounds):
                if i < 16:
                    np.bitwise_xor(c, d, out=f)
                    np.bitwise_and(f, b, out=f)
                    np.bitwise_xor(f, d, out=f)
                elif i < 32:
                    np.bitwise_xor(b, c, out=f)
                    np.bitwise_and(f, d, out=f)
                    np.bitwise_xor(f, c, out=f)
                elif i < 48:
                    np.bitwise_xor(b, c, out=f)
                    np.bitwise_xor(f, d, out=f)
                else:
                    np.invert(d, out=f)
                    np.bitwise_or(f, b, out=f)
                    np.bitwise_xor(f, c, out=f)
                np.add(f, a, out=f)
                word = words[block + at]
                if isinstance(word, int):
                    np.add(f, np.uint32((constant + word) & 0xFFFFFFFF), out=f)
                else:
                    np.add(f, word, out=f)
                    np.add(f, np.uint32(constant), out=f)
                np.left_shift(f, np.uint32(turn), out=t)
                np.right_shift(f, np.uint32(32 - turn), out=f)
                np.bitwise_or(t, f, out=t)
                np.add(t, b, out=a)  # a's own array takes the new b
                a, b, c, d = d, a, b, c
            for s, x in zip(state, (a, b, c, d)):
                np.add(s, x, out=s)
        return state

    def digests(data, ends, prefixes):
        import numpy as np

        ends = np.asarray(ends, np.int64)
        starts = np.insert(ends[:-1], 0, 0)
        lengths = ends - starts
        for before in sorted({len(p) for p in prefixes}):
            blocks = (before + lengths + 8) // 64 + 1
            for count in np.unique(blocks):
                same = np.flatnonzero(blocks == count)
                for rows in np.array_split(same, -(-len(same) // most)):
                    own, total = np.arange(len(rows)), lengths[rows]
                    text = np.zeros((len(rows), int(count) * 64), np.uint8)
                    within = np.arange(total.sum()) - np.repeat(np.cumsum(total) - total, total)
                    text[np.repeat(own, total), before + within] = data[np.repeat(starts[rows], total) + within]
                    text[own, before + total] = 0x80
                    text[:, -8:] = (8 * (before + total)).astype("<u8").view(np.uint8).reshape(-1, 8)
                    columns = np.ascontiguousarray(text.view("<u4").T)
                    alike = (columns == columns[:, :1]).all(axis=1)
                    words = [int(c[0]) if a else c for c, a in zip(columns, alike)]
                    for number, prefix in enumerate(prefixes):
                        if len(prefix) != before:
                            continue
                        lead = np.frombuffer(prefix + bytes(-before % 4), "<u4")
                        message = [w | int(p) if isinstance(w, int) else w | p for w, p in zip(words, lead)] + words[len(lead) :]
                        yield number, rows, digest(message, len(rows))

    return digests
