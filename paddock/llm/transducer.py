"""Byte-pair merges as a lazily determinised transducer, and a streaming UTF-8 decoder.

A token sequence is the merge result of its bytes exactly if every adjacent pair of tokens
is the merge result of the pair's own bytes. So one token ends at each position of a text:
the one that fits its predecessor. The transducer follows all tokens that may still be open (its configurations)
and names the token that ends at each byte; the tokens that every open configuration leads back to are
settled and handed out.
"""

from __future__ import annotations

import base64
import os
from array import array

ROOT = 0
START = -1  # no token before the first
_CONFIGURATIONS = -1  # key of a state beside the bytes
_LOOK = 512  # bytes after which tokens are settled in long pieces


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file (base64, blank, rank on each line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Merge the neighbours whose union ranks lowest, leftmost first, until none is known."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        known = [(rank, i) for i in range(len(parts) - 1) if (rank := ranks.get(parts[i] + parts[i + 1])) is not None]
        if not known:
            break
        _, i = min(known)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[part] for part in parts]


class Transducer:
    """Merges compiled into states that are made when first reached.

    A state is a dict: byte -> (next state, token that ends there), plus its configurations. A configuration is
    (token before, node of the trie): a token that may still become longer.
    """

    def __init__(self, ranks: dict[bytes, int], pieces: int = 200_000, pairs: int = 250_000, states: int = 100_000):
        """Tables are bounded: ``pieces`` in the younger and in the older generation, ``pairs`` of tokens, and
        ``states``; a full table is emptied and filled anew."""
        self.ranks = ranks
        self._most_pieces, self._most_pairs, self._most_states = pieces, pairs, states
        self.tokens = {rank: token for token, rank in ranks.items()}  # the same byte strings, not copies
        self._children: list[dict[int, int] | None] = [{}]
        self._ends = [START]
        self._depths = [0]
        self._lengths = {rank: len(token) for token, rank in ranks.items()}
        self._fits: dict[int, bool] = {}
        self._made: dict[int, tuple[int, int] | None] = {}
        self._states: dict[tuple, dict] = {}
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        for token, rank in ranks.items():
            node = ROOT
            for byte in token:
                children = self._children[node]
                if children is None:
                    children = self._children[node] = {}
                if byte not in children:
                    children[byte] = len(self._ends)
                    self._ends.append(START)
                    self._depths.append(self._depths[node] + 1)
                    self._children.append(None)
                node = children[byte]
            self._ends[node] = rank
        self._forget()

    def _forget(self) -> None:
        for state in self._states.values():
            state.clear()  # states refer to each other in circles
        configurations = ((START, ROOT),)
        self._first = {_CONFIGURATIONS: configurations}
        self._states = {configurations: self._first}

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge made this one; none for a single byte."""
        known = self._made.get(token, 0)
        if known == 0:
            older = {}
            data = self.tokens[token]
            for i in range(len(data)):
                for j in range(i + 1, len(data) + 1):
                    rank = self.ranks.get(data[i:j])
                    if rank is not None and (rank < token or j == i + 1):
                        older[data[i:j]] = rank
            parts = merge(data, older)
            known = self._made[token] = (parts[0], parts[1]) if len(parts) == 2 else None
        return known

    def fits(self, before: int, token: int) -> bool:
        """Whether the two tokens stay apart, each whole, when their bytes are merged.

        Merges are undone along the seam, youngest first; the tokens would have been torn apart
        if the two that face each other there merge before the undone one was made.
        """
        known = self._fits.get(before << 20 | token)
        if known is None:
            if len(self._fits) >= self._most_pairs:
                self._fits.clear()
            if before == START:
                known = merge(self.tokens[token], self.ranks) == [token]
            else:
                known = self._apart(before, token)
            self._fits[before << 20 | token] = known
        return known

    def _apart(self, left: int, right: int) -> bool:
        youngest = len(self._ends) + len(self.ranks)
        while True:
            union = self.ranks.get(self.tokens[left] + self.tokens[right])
            if union is not None and union < youngest:
                return False
            left_made, right_made = self._halves(left), self._halves(right)
            if left_made is None and right_made is None:
                return True
            if right_made is None or (left_made is not None and left > right):
                youngest, left = left, left_made[1]
            else:
                youngest, right = right + 1, right_made[0]

    def _move(self, state: dict, byte: int) -> tuple[dict, int]:
        children, ends, fits = self._children, self._ends, self._fits
        after = []  # oldest first
        for before, node in state[_CONFIGURATIONS]:
            node = children[node].get(byte)
            if node is None:
                continue
            token = ends[node]
            if token != START:
                fit = fits.get(before << 20 | token)
                if self.fits(before, token) if fit is None else fit:
                    last = token
            if children[node] is not None:
                after.append((before, node))
        after.append((last, ROOT))  # one token ends at every position
        after = tuple(after)
        known = self._states.get(after)
        if known is None:
            known = self._states[after] = {_CONFIGURATIONS: after}
        state[byte] = move = (known, last)
        return move

    def _settle(self, state: dict, lasts: list[int], start: int) -> tuple[list[int], int]:
        """Tokens from ``start`` on that every open configuration agrees on, and where they end."""
        lengths, depths = self._lengths, self._depths
        ways = {len(lasts) - depths[node] for _, node in state[_CONFIGURATIONS]}
        while len(ways) > 1:  # follow the latest back until all have met
            latest = max(ways)
            ways.remove(latest)
            ways.add(latest - lengths[lasts[latest - 1]])
        end = at = ways.pop()
        out = []
        while at > start:
            out.append(lasts[at - 1])
            at -= lengths[lasts[at - 1]]
        return out[::-1], end

    def ids(self, piece: bytes) -> list[int]:
        """Token ids of one piece. After each byte the token that ends there is known; which of them
        are kept is settled every _LOOK bytes, at the latest at the piece's end."""
        if len(self._states) >= self._most_states:
            self._forget()
        state, lasts, lengths, out, start = self._first, [], self._lengths, [], 0
        for byte in piece:
            state, last = state.get(byte) or self._move(state, byte)
            lasts.append(last)
            if not len(lasts) % _LOOK:
                sure, start = self._settle(state, lasts, start)
                out += sure
        tail, at = [], len(lasts)
        while at > start:
            last = lasts[at - 1]
            tail.append(last)
            at -= lengths[last]
        tail.reverse()
        return out + tail if out else tail

    def _miss(self, piece: str) -> bytes:
        known = self._young.get(piece) or self._old.get(piece)
        if known is None:
            known = array("I", self.ids(piece.encode("utf-8", "surrogatepass"))).tobytes()
        if len(self._young) >= self._most_pieces:
            self._old, self._young = self._young, {}
        self._young[piece] = known
        return known

    def packed(self, pieces: list[str]) -> bytes:
        """Ids of the pieces as little-endian unsigned 32-bit integers; pieces in use are looked up."""
        known, miss = self._young.get, self._miss
        return b"".join([known(piece) or miss(piece) for piece in pieces])


_LOADED: dict[tuple, Transducer] = {}


def transducer(path: str, **tables: int) -> Transducer:
    """One transducer for each rank file, table sizes and Python worker."""
    key = (path, os.path.getmtime(path), *sorted(tables.items()))
    if key not in _LOADED:
        _LOADED[key] = Transducer(read_ranks(path), **tables)
    return _LOADED[key]


_TOKENS: dict[tuple[str, float], dict[int, bytes]] = {}


def token_bytes(path: str) -> dict[int, bytes]:
    """Bytes of each id of a rank file, read once for each Python worker."""
    key = (path, os.path.getmtime(path))
    if key not in _TOKENS:
        _TOKENS[key] = {rank: token for token, rank in read_ranks(path).items()}
    return _TOKENS[key]


def open_bytes(tail: bytes) -> int:
    """How many bytes at the end begin a UTF-8 character that is not complete yet."""
    for back in range(1, min(3, len(tail)) + 1):
        byte = tail[-back]
        if byte & 0xC0 == 0x80:
            continue  # a continuation byte, its lead comes before
        need = 2 if 0xC2 <= byte <= 0xDF else 3 if 0xE0 <= byte <= 0xEF else 4 if 0xF0 <= byte <= 0xF4 else 1
        if back >= need:
            return 0
        if back > 1:  # the first continuation byte is restricted after some leads
            low, high = {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}.get(byte, (0x80, 0xBF))
            if not low <= tail[1 - back] <= high:
                return 0
        return back
    return 0


class StreamDecoder:
    """Text of ids that come in pieces; a character waits until its last byte is there.

    Bytes that can't become a character turn into U+FFFD, as in ``bytes.decode``.
    """

    def __init__(self, tokens: dict[int, bytes]):
        self.tokens, self._open = tokens, b""

    def feed(self, ids) -> str:
        data = self._open + b"".join(map(self.tokens.__getitem__, ids))
        cut = len(data) - open_bytes(data[-3:])
        self._open = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def finish(self) -> str:
        rest, self._open = self._open, b""
        return rest.decode("utf-8", "replace")
