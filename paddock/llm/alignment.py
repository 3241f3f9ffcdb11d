"""Alignment of two tokenizers' tokens over the same bytes (operator 12).

Both tokenizers cut a text's bytes; where both have a token end, a group ends. Each token points to the token
that overlaps it and reaches farthest to the right, the last token of a group to itself. Doubling the pointers
(every token jumps to where its target points) ends after a logarithmic number of steps at the last token of the
group, which is the group's label. Tokens of one batch of texts are labelled together in numpy.

``align`` reads each text once, without a shuffle. ``with_agreement`` counts in how many texts each pair of
token ids is linked: pairs are counted on the map side first; the most frequent ones, at most ``MOST_HOT`` by
the choice of their least count, are handed to all workers, so the pairs that nearly all texts hold are never
joined. Only the rest, of which no pair has more than 1/MOST_HOT of all occurrences, goes through a join.

Words are encoded once for each worker: a single blank between other characters starts a pre-token of A, and
B's pieces have blanks at their start only (checked when the file is read), so neither merges across it.

Null and empty texts, and those that either tokenizer does not give back byte for byte, have no tokens: zeros, no
groups and no pairs. Repeated rows are rows of their own and count each. Ties for an id's most frequent partner all
count as such. Very long texts are encoded whole; a batch holds one of them. A group's pairs are formed from its
distinct ids, so a group without a common end for thousands of tokens costs what it has of different pairs. The
result has the columns named in ``keep`` (under any names but those of the results) and the results; other columns
of the input, whatever they are called, neither matter nor come along. An empty table gives an empty table.
"""

from __future__ import annotations

import functools
import re
from itertools import chain

from pyspark.sql import Column, DataFrame, functions as F

from paddock.llm.common import fresh, scanned, scratch
from paddock.session import cut_lineage

MOST_HOT = 1 << 20  # pairs held by every worker, 17 bytes each
WIDE = 1 << 12  # links of a group beyond which its ids are made distinct first
PORTION = 1 << 20  # bytes of texts in one step
#: A single blank between other characters: A starts a pre-token here, and B a word.
BLANK = re.compile(r"(?<=\S) (?=\S)")
MOST_WORDS, LONGEST_WORD = 300_000, 48  # kept in a worker
RESULTS = "n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, pair_links array<int>"


class Aligner:
    """Tokens of two tokenizer files, their groups and their links."""

    def __init__(self, a_file: str, b_file: str):
        import numpy as np
        import sentencepiece
        from tokenizers import Tokenizer

        from paddock.llm.token_count import printable_bytes

        self.a = Tokenizer.from_file(a_file)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        byte = printable_bytes()
        names = {i: name for name, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.a_bytes = [bytes(byte[c] for c in names.get(i, "") if c in byte) for i in range(max(names) + 1)]
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        self.b_bytes = [
            bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode()
            for i in range(self.b.get_piece_size())
        ]
        self.a_length = np.array([len(t) for t in self.a_bytes])
        self.b_length = np.array([len(t) for t in self.b_bytes])
        # no piece goes on after a blank, so B never merges across one that follows another character
        self.separable = not any("▁" in self.b.id_to_piece(i).lstrip("▁") for i in range(self.b.get_piece_size()))
        self.forget()
        # what an id adds to the groups' text: inside its half of a group, and at the half's end
        self.written = [f"{i}{end}" for ids, ends in ((self.a_bytes, ",|"), (self.b_bytes, ",;")) for end in ends for i in range(len(ids))]

    def encode(self, texts: list[bytes]):
        """(ids, number of ids in each text) of A and of B; none in a text of which a tokenizer changes the bytes."""
        import numpy as np

        strings = [t.decode("utf-8", "replace") for t in texts]
        words = [BLANK.split(s) if self.separable else [s] for s in strings]
        if self.count > MOST_WORDS or len(self.ids[0]) > 6 * MOST_WORDS:
            self.forget()
        found = set().union(*words).difference(self.known)
        # blanks at a word's edge could join its neighbour's
        inner = [w for w in found if self.separable and w and not (w[0].isspace() or w[-1].isspace())]
        self.learn(inner)
        for w in found.difference(inner):
            self.learn([w])
        for i, (text, string) in enumerate(zip(texts, strings)):
            usable = text and ("\ufffd" not in string or string.encode() == text)
            if not usable or (self.changed and self.changed.intersection(words[i])):
                words[i] = []
        at = np.fromiter(map(self.known.__getitem__, chain.from_iterable(words)), np.int64)
        ends = np.cumsum([len(w) for w in words])
        both = [spread(ids, stop, at, ends) for ids, stop in zip(self.ids, self.stop)]
        for w in found:
            if len(w) > LONGEST_WORD:
                del self.known[w]
        return both

    def forget(self) -> None:
        import numpy as np

        self.known: dict[str, int] = {}  # words by number
        self.changed: set[str] = set()  # those of which a tokenizer changes the bytes
        self.ids, self.stop = [np.empty(0, np.int64)] * 2, [np.zeros(1, np.int64)] * 2  # the words' ids one after the other
        self.count = 0

    def learn(self, words: list[str]) -> None:
        """Encode words that follow a blank, all as one text."""
        import numpy as np

        if not words:
            return
        each = [b" " + w.encode("utf-8", "surrogateescape") for w in words]
        text, data = " ".join(words), b"".join(each)
        both = self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids, self.b.encode(text)
        same = all(b"".join(map(table.__getitem__, ids)) == data for table, ids in zip((self.a_bytes, self.b_bytes), both))
        if not same and len(words) > 1:
            half = len(words) // 2
            self.learn(words[:half])
            self.learn(words[half:])
            return
        if not same:
            self.changed.add(words[0])
            both = ([], [])
        stop = np.cumsum([len(x) for x in each])
        for i, (length, ids) in enumerate(zip((self.a_length, self.b_length), both)):
            ids = np.array(ids, np.int64)
            cut = np.searchsorted(np.cumsum(length[ids]), stop) + 1 if same else np.zeros(1, np.int64)
            self.stop[i] = np.append(self.stop[i], len(self.ids[i]) + cut)
            self.ids[i] = np.append(self.ids[i], ids)
        self.known.update(zip(words, range(self.count, self.count + len(words))))
        self.count += len(words)

    def __call__(self, texts: list[bytes]) -> dict:
        import numpy as np

        (a, n_a), (b, n_b) = self.encode(texts)
        group_a, group_b = groups(self.a_length[a], self.b_length[b])
        size_a, size_b = np.bincount(group_a), np.bincount(group_b)
        text_of = np.repeat(np.arange(len(texts)), n_a)
        group_text = text_of[np.cumsum(size_a) - 1] if len(a) else text_of
        n_groups = np.bincount(group_text, minlength=len(texts))
        pairs, counts, pair_text = links(a, b, size_a, size_b, group_text, len(self.b_bytes))
        cut = np.searchsorted(pair_text, np.arange(1, len(texts)))
        n_links = np.bincount(group_text, size_a * size_b, minlength=len(texts)).astype(np.int64)
        return {
            "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links, "groups": self.write(a, b, group_a, group_b, size_a, size_b, n_a + n_b),
            "pairs": np.split(pairs, cut), "pair_links": np.split(counts, cut),
        }

    def write(self, a, b, group_a, group_b, size_a, size_b, n_tokens) -> list[str]:
        """Each text's groups as ``a1,a2|b1;a3|b2,b3``."""
        import numpy as np

        last_a, last_b = np.cumsum(size_a) - 1, np.cumsum(size_b) - 1
        at_a, at_b = a.copy(), b + 2 * len(self.a_bytes)
        at_a[last_a] += len(self.a_bytes)
        at_b[last_b] += len(self.b_bytes)
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + (last_b + 1 - size_b)[group_a]] = at_a
        order[np.arange(len(b)) + (last_a + 1)[group_b]] = at_b
        parts = list(map(self.written.__getitem__, order.tolist()))
        ends = np.cumsum(n_tokens).tolist()
        return ["".join(parts[s:e])[:-1] for s, e in zip([0, *ends], ends)]


def spread(ids, stop, at, ends):
    """The ids of the words numbered ``at`` one after the other, and how many there are in each text.

    Word i has the ids from stop[i] to stop[i + 1]; texts end at ``ends``.
    """
    import numpy as np

    start = stop[at]
    times = stop[at + 1] - start
    last = np.cumsum(times)
    place = np.repeat(start - (last - times), times) + np.arange(times.sum())
    return ids[place], np.diff(np.append(0, last)[ends], prepend=0)


def groups(a_length, b_length):
    """Group number of each A and each B token, from the tokens' lengths in bytes, by pointer jumping.

    Both lists of lengths have the same sum. A token's target is the token overlapping it that ends last; an A
    token with which a B token ends is its own target.
    """
    import numpy as np

    n = len(a_length)
    a_end, b_end = np.cumsum(a_length), np.cumsum(b_length)
    # the last token of the other side that starts before this one's end
    b_over = np.searchsorted(b_end - b_length, a_end, "left") - 1
    a_over = np.searchsorted(a_end - a_length, b_end, "left") - 1
    target = np.concatenate([np.where(b_end[b_over] > a_end, n + b_over, np.arange(n)), a_over]) if n else np.empty(0, np.int64)
    while True:
        farther = target[target]
        if (farther == target).all():
            break
        target = farther
    number = np.cumsum(target[:n] == np.arange(n)) - 1  # of the group that ends at an A token
    return number[target[:n]], number[target[n:]]


def links(a, b, size_a, size_b, group_text, wide_b: int):
    """Distinct linked id pairs of each text, ``a << 32 | b``, in order of texts, with their number of links."""
    import numpy as np

    product = size_a * size_b
    small = product <= WIDE
    first_b = np.cumsum(size_b) - size_b
    group_a = np.repeat(np.arange(len(size_a)), size_a)
    inside = small[group_a] if len(a) else np.empty(0, bool)
    times = size_b[group_a[inside]]
    offset = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    vocabulary = int(a.max(initial=0)) + 1
    text_a = group_text[group_a]
    keys = [np.repeat((text_a * vocabulary + a)[inside], times) * wide_b + b[np.repeat(first_b[group_a[inside]], times) + offset]]
    weights = [np.ones(len(offset), np.int64)]
    first_a = np.cumsum(size_a) - size_a
    for g in np.flatnonzero(~small):
        own_a, n_a = np.unique(a[first_a[g] : first_a[g] + size_a[g]], return_counts=True)
        own_b, n_b = np.unique(b[first_b[g] : first_b[g] + size_b[g]], return_counts=True)
        keys.append((((group_text[g] * vocabulary + own_a) * wide_b)[:, None] + own_b).ravel())
        weights.append((n_a[:, None] * n_b).ravel())
    keys, weights = np.concatenate(keys), np.concatenate(weights)
    order = np.argsort(keys, kind="stable")
    keys, weights = keys[order], weights[order]
    start = np.flatnonzero(np.diff(keys, prepend=-1))
    keys, weights = keys[start], np.add.reduceat(weights, start) if len(start) else weights
    of_a, of_b = keys // wide_b, keys % wide_b
    return (of_a % vocabulary) << 32 | of_b, weights, of_a // vocabulary


@functools.lru_cache(maxsize=1)
def aligner(a_file: str, b_file: str) -> Aligner:
    return Aligner(a_file, b_file)


def align(docs: DataFrame, text: str, a_file: str, b_file: str, keep: dict[str, Column]) -> DataFrame:
    """The ``keep`` columns, and of each text n_a, n_b, n_groups, n_links, ``groups`` (``a1,a2|b1;a3|b2,b3``), the
    distinct linked ``pairs`` (A id shifted by 32 bits, B id) and their numbers of links ``pair_links``."""
    return scanned(docs, lambda texts: aligner(a_file, b_file)(texts), F.col(f"`{text}`"), RESULTS, keep, PORTION)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, is_best): texts that hold an id pair linked, and whether no other pair of its A id is held by more."""
    counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    counts = cut_lineage(counts)
    most = counts.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("n").alias("most"))
    return counts.withColumn("a", F.shiftright("pair", 32)).join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("is_best"))


def with_agreement(aligned: DataFrame, most_hot: int = MOST_HOT) -> DataFrame:
    """Add n_best and count_sum to what ``align`` gave and drop the pairs; ``aligned`` should be a written table."""
    import pyarrow as pa
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    counts = cut_lineage(pair_counts(aligned))
    total = counts.agg(F.sum("n").alias("n")).first()["n"] or 0
    least = max(1, -(-total // most_hot))  # at most total / least pairs can reach it
    hot = counts.where(F.col("n") >= least).toArrow()
    order = hot.column("pair").to_numpy().argsort()
    hot_pair, hot_n, hot_best = (hot.column(c).to_numpy()[order] for c in ("pair", "n", "is_best"))
    kept = [c for c in aligned.columns if c not in ("pairs", "pair_links")]
    row, best, summed, rest, rest_n = (fresh(n, aligned) for n in ("row_number", "n_best", "count_sum", "rest", "rest_links"))
    added = T._parse_datatype_string(f"{best} long, {summed} long, {rest} array<long>, {rest_n} array<int>")
    frame = aligned.select(*[F.col(f"`{c}`") for c in kept], F.monotonically_increasing_id().alias(row), "pairs", "pair_links")
    schema = T.StructType([*frame.schema.fields[:-2], *added.fields])

    def look_up(batches):
        import numpy as np

        target = to_arrow_schema(schema)
        for batch in batches:
            pairs, times = batch.column(len(kept) + 1), batch.column(len(kept) + 2)
            ends = pairs.offsets.to_numpy()
            ids, n = pairs.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
            ends = ends - ends[0]
            place = np.minimum(np.searchsorted(hot_pair, ids), max(len(hot_pair) - 1, 0))
            known = hot_pair[place] == ids if len(hot_pair) else np.zeros(len(ids), bool)
            sums = []
            for value in (hot_best, hot_n):
                found = np.zeros(len(ids) + 1, np.int64)
                if len(hot_pair):
                    found[1:] = np.cumsum(np.where(known, value[place] * n, 0))
                sums.append(found[ends[1:]] - found[ends[:-1]])
            left = np.concatenate([[0], np.cumsum(~known)])[ends]
            others = [pa.ListArray.from_arrays(pa.array(left, pa.int32()), pa.array(v[~known], t)) for v, t in ((ids, pa.int64()), (n, pa.int32()))]
            arrays = [*batch.columns[: len(kept) + 1], pa.array(sums[0]), pa.array(sums[1]), *others]
            yield pa.RecordBatch.from_arrays([x.cast(f.type) for x, f in zip(arrays, target)], schema=target)

    looked_up = cut_lineage(frame.mapInArrow(look_up, schema))
    tail = looked_up.select(row, F.explode(F.arrays_zip(F.col(rest).alias("pair"), F.col(rest_n).alias("times"))).alias("r")).select(row, "r.pair", "r.times")
    tail = tail.join(counts.where(F.col("n") < least), "pair").groupBy(row)
    more_best, more_sum = fresh("more_best", looked_up), fresh("more_sum", looked_up)
    tail = tail.agg(F.sum(F.when(F.col("is_best"), F.col("times")).otherwise(0)).alias(more_best), F.sum(F.col("times") * F.col("n")).alias(more_sum))
    both = looked_up.drop(rest, rest_n).join(tail, row, "left")
    return both.select(
        *[F.col(f"`{c}`") for c in kept],
        (F.col(best) + F.coalesce(more_best, F.lit(0))).alias("n_best"),
        (F.col(summed) + F.coalesce(more_sum, F.lit(0))).alias("count_sum"),
    )


def written(aligned: DataFrame) -> DataFrame:
    """``aligned`` as a table in the shared folder, so that no text is encoded twice."""
    path = scratch(aligned.sparkSession, "aligned")
    aligned.write.option("compression", "zstd").parquet(path)
    return aligned.sparkSession.read.parquet(path)
