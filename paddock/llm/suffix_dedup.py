"""Removal of long byte strings that occur more than once in a corpus (operator 9).

A byte goes if it lies in a string of LENGTH bytes that starts anywhere else too. The steps:

1. Equal texts become one row with a count, compressed and partitioned by digest; this table is checkpointed and
   joined by its partitioning from then on.
2. Windows that cannot repeat are struck out. Every window of LENGTH bytes has an anchor, its 32-byte gram
   with the smallest hash; equal windows have equal anchors, so a window whose anchor occurs once in
   the corpus is unique. The same test follows for shorter windows inside the remaining ones. Only anchors
   (one in about 180 or 60 bytes) are shuffled.
3. Runs of remaining windows with a common anchor, the stretches, are collapsed by digest and counted.
   Where all stretches of an anchor are equal, their count decides.
4. All others are dealt to shards by anchor. Each shard builds its suffix array (Larsson-Sadakane refinement)
   and common prefixes (Kasai): suffixes with LENGTH bytes in common are one window, with the sum of their counts.
5. An anchor with very many different stretches is spread over several shards; these publish the sorted digests of
   their windows, and equal ones in different shards are found by binary search, range by range.

Struck-out windows are unique for certain, so the result is exact. Null and empty texts, and texts shorter than
LENGTH, keep all their bytes; repeated rows of a long enough text lose them all; an empty table gives an
empty table. Very long texts are handled in slices that overlap by a window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from paddock.llm.common import fresh, utf8
from paddock.session import cut_lineage

LENGTH = 400
GRAM = 32
INNER = 128  # grams in the shorter windows, at most; half of a window's for short ones
SLICE = 1 << 19  # bytes examined at once
SHARD = 1 << 20  # bytes of stretches in a shard, on average
CROWD = 1024  # different stretches of an anchor beyond which it is spread over several shards

_rng = np.random.default_rng(9)
_BYTE = _rng.integers(0, 1 << 64, 256, dtype=np.uint64)
_ODD = np.uint64(0x94D049BB133111EB)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each position on, by doubling."""
    value, n = _BYTE[data], 1
    while n < GRAM:
        value = value[: len(value) - n] * _ODD + value[n:]
        value ^= value >> np.uint64(29)
        value *= _MIX
        value ^= value >> np.uint64(32)
        n *= 2
    return value


def smallest(hashes: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest hash (upper half, leftmost) among ``width`` from each position on."""
    least = hashes & np.uint64(0xFFFFFFFF00000000) | np.arange(len(hashes), dtype=np.uint64)
    n = 1
    while 2 * n <= width:
        least = np.minimum(least[: len(least) - n], least[n:])
        n *= 2
    if n < width:
        least = np.minimum(least[: len(least) - (width - n)], least[width - n :])
    return (least & np.uint64(0xFFFFFFFF)).astype(np.int64)


def any_within(flags: np.ndarray, before: int, after: int) -> np.ndarray:
    """Whether a flag is set from ``before`` places before to ``after`` places after each place."""
    sums = np.concatenate([[0], np.cumsum(flags)])
    at = np.arange(len(flags))
    return sums[np.minimum(at + after + 1, len(flags))] > sums[np.maximum(at - before, 0)]


def once(positions: np.ndarray) -> np.ndarray:
    """Positions in ascending order without repeats; they come ascending."""
    return positions[np.flatnonzero(np.diff(positions, prepend=-1))] if len(positions) else positions


class Slices:
    """Several texts, or a slice of a long one, examined as one array of bytes."""

    def __init__(self, parts: list[tuple[int, int, bytes]], length: int):
        self.text = np.array([p[0] for p in parts])
        self.offset = np.array([p[1] for p in parts])
        sizes = np.array([len(p[2]) for p in parts])
        self.begin = np.cumsum(sizes) - sizes
        self.data = b"".join(p[2] for p in parts)
        self.width = length - GRAM + 1
        self.inner_width = min(INNER, self.width // 2 + 1)
        self.part = np.repeat(np.arange(len(parts)), sizes)
        self.hashes = gram_hashes(np.frombuffer(self.data, np.uint8))
        self.anchor = smallest(self.hashes, self.width)
        self.part = self.part[: len(self.anchor)]
        self.valid = (self.begin + sizes)[self.part] - np.arange(len(self.anchor)) >= length

    def outer(self, struck: np.ndarray) -> np.ndarray:
        """Windows whose anchor is not among the struck ones (sorted hashes)."""
        return self.valid & ~member(self.hashes, self.anchor, struck)

    def inner(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Anchors of the shorter windows, and which of these lie in one of ``windows``."""
        inner = smallest(self.hashes, self.inner_width)
        # the last of them begin after the last long window, and lie in it
        return inner, any_within(np.pad(windows, (0, len(inner) - len(windows))), self.width - self.inner_width, 0)

    def remaining(self, struck: np.ndarray, inner_struck: np.ndarray) -> np.ndarray:
        windows = self.outer(struck)
        if not windows.any():
            return windows
        inner, covered = self.inner(windows)
        bad = covered & member(self.hashes, inner, inner_struck)
        return windows & ~any_within(bad, 0, self.width - self.inner_width)[: len(windows)]


def member(hashes: np.ndarray, anchor: np.ndarray, struck: np.ndarray) -> np.ndarray:
    """For each window whether the hash of its anchor is struck out; anchors ascend, so each is looked up once."""
    changes = np.flatnonzero(np.diff(anchor, prepend=-1))
    values = hashes[anchor[changes]]
    at = np.minimum(np.searchsorted(struck, values), max(len(struck) - 1, 0))
    found = struck[at] == values if len(struck) else np.zeros(len(values), bool)
    return np.repeat(found, np.diff(changes, append=len(anchor)))


def sliced(texts: list[bytes], length: int) -> Iterator[Slices]:
    parts, size = [], 0
    for i, text in enumerate(texts):
        for offset in range(0, max(len(text) - length + 1, 1), SLICE):
            piece = text[offset : offset + SLICE + length - 1]
            if len(piece) < length:
                continue
            parts.append((i, offset, piece))
            size += len(piece)
            if size >= SLICE:
                yield Slices(parts, length)
                parts, size = [], 0
    if parts:
        yield Slices(parts, length)


def _texts(column) -> list[bytes]:
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    return [unpack(z) for z in column.to_pylist()]


def _struck(column) -> np.ndarray:
    """All struck hashes of a batch, sorted. Each belongs to one text only, so they may be looked up together."""
    return np.sort(column.combine_chunks().flatten().to_numpy(zero_copy_only=False).view(np.uint64) if hasattr(column, "combine_chunks") else column.flatten().to_numpy(zero_copy_only=False).view(np.uint64))


def _portions(batches, weight: int):
    """Batches cut so that one holds a few MB of compressed texts (column ``weight``) at most."""
    for batch in batches:
        start = size = 0
        for i, z in enumerate(batch.column(weight)):
            size += len(z.as_buffer())
            if size > SLICE or i == len(batch) - 1:
                yield batch.slice(start, i + 1 - start)
                start, size = i + 1, 0


def distinct_texts(df: DataFrame, text: str, length: int) -> DataFrame:
    """Texts of at least ``length`` bytes, once each: (t1, t2, sha, copies, packed), partitioned by t1."""

    def pack(batches):
        import hashlib

        import pyarrow as pa
        import zstandard

        compress = zstandard.ZstdCompressor(level=3).compress
        seen: dict[bytes, int] = {}  # texts of this task's rows; further copies are counted and told at the end

        def rows(shas, copies, packed):
            ids = np.frombuffer(b"".join(s[:16] for s in shas), "<i8").reshape(-1, 2)
            return pa.RecordBatch.from_arrays(
                [pa.array(ids[:, 0]), pa.array(ids[:, 1]), pa.array(shas, pa.binary()), pa.array(copies, pa.int64()), pa.array(packed, pa.binary())],
                names=["t1", "t2", "sha", "copies", "packed"],
            )

        for batch in batches:
            shas, packed, size = [], [], 0
            for value in batch.column(0):
                data = value.as_buffer()
                sha = hashlib.sha256(data).digest()
                if sha in seen:
                    seen[sha] += 1
                    continue
                seen[sha] = 0
                shas.append(sha)
                packed.append(compress(data))
                size += len(packed[-1])
                if size > (4 << 20):
                    yield rows(shas, [1] * len(shas), packed)
                    shas, packed, size = [], [], 0
            if shas:
                yield rows(shas, [1] * len(shas), packed)
        more = [(sha, n) for sha, n in seen.items() if n]
        if more:
            yield rows([m[0] for m in more], [m[1] for m in more], [None] * len(more))

    data = utf8(text)
    long_enough = df.select(data.alias("data")).where(F.octet_length("data") >= length)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = long_enough.mapInArrow(pack, "t1 long, t2 long, sha binary, copies long, packed binary").repartition(parts, "t1")
    # max: of equal texts, packed alike, the one that is not null
    return cut_lineage(packed.groupBy("t1", "t2", "sha").agg(F.sum("copies").alias("copies"), F.max("packed").alias("packed")))


def _anchors(table: DataFrame, length: int, inner: bool) -> DataFrame:
    """(hash, t1, copies) of the anchors of the windows, or of the shorter windows in those that remain."""

    def scan(batches):
        import pyarrow as pa

        for batch in _portions(batches, 2):
            t1, copies = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            struck = _struck(batch.column(3)) if inner else None
            for s in sliced(_texts(batch.column(2)), length):
                if inner:
                    windows = s.outer(struck)
                    if not windows.any():
                        continue
                    anchor, covered = s.inner(windows)
                else:
                    anchor, covered = s.anchor, s.valid
                at = once(anchor[covered])
                text = s.text[np.searchsorted(s.begin, at, side="right") - 1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s.hashes[at].view(np.int64)), pa.array(t1[text]), pa.array(copies[text])], names=["hash", "t1", "copies"]
                )

    columns = ["t1", "copies", "packed"] + ["struck"] * inner
    return table.select(columns).mapInArrow(scan, "hash long, t1 long, copies long")


def _unique(anchors: DataFrame, name: str) -> DataFrame:
    """Hashes that occur once in the corpus, listed by text: (t1, name). A list is as long as its text at most."""
    once_only = anchors.groupBy("hash").agg(F.sum("copies").alias("n"), F.min("t1").alias("t1")).where("n = 1")
    return once_only.groupBy("t1").agg(F.collect_list("hash").alias(name))


def _with(table: DataFrame, lists: DataFrame, name: str) -> DataFrame:
    empty = F.array().cast("array<bigint>")
    return table.join(lists, "t1", "left").withColumn(name, F.coalesce(name, empty))


def _stretches(table: DataFrame, length: int) -> DataFrame:
    """Runs of remaining windows with one anchor: (anchor, d1, d2, t1, t2, start, n, copies), d the digest of its bytes."""

    def scan(batches):
        import hashlib

        import pyarrow as pa

        for batch in _portions(batches, 3):
            t1, t2, copies = (batch.column(i).to_numpy() for i in range(3))
            struck, inner_struck = _struck(batch.column(4)), _struck(batch.column(5))
            for s in sliced(_texts(batch.column(3)), length):
                at = np.flatnonzero(s.remaining(struck, inner_struck))
                if not len(at):
                    continue
                first = np.flatnonzero((np.diff(at, prepend=-2) != 1) | (np.diff(s.anchor[at], prepend=-1) != 0))
                begin, n = at[first], np.diff(first, append=len(at))
                digests = b"".join([hashlib.blake2b(s.data[b : b + m + length - 1], digest_size=16).digest() for b, m in zip(begin.tolist(), n.tolist())])
                ids = np.frombuffer(digests, "<i8").reshape(-1, 2)
                part = s.part[begin]
                text = s.text[part]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(s.hashes[s.anchor[begin]].view(np.int64)), pa.array(ids[:, 0]), pa.array(ids[:, 1]), pa.array(t1[text]), pa.array(t2[text]),
                        pa.array(begin - s.begin[part] + s.offset[part]), pa.array(n.astype(np.int64)), pa.array(copies[text]),
                    ],
                    names=["anchor", "d1", "d2", "t1", "t2", "start", "n", "copies"],
                )

    schema = "anchor long, d1 long, d2 long, t1 long, t2 long, start long, n long, copies long"
    return table.select("t1", "t2", "copies", "packed", "struck", "inner_struck").mapInArrow(scan, schema)


def _bytes_of(table: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of the stretches in ``wanted`` (shard, crowded, d1, d2, copies, n, t1, t2, start)."""
    lists = wanted.groupBy("t1", "t2").agg(F.collect_list(F.struct("shard", "crowded", "d1", "d2", "weight", "n", "start")).alias("wanted"))
    joined = table.select("t1", "t2", "packed").join(lists, ["t1", "t2"])

    def cut(batches):
        import pyarrow as pa

        for batch in _portions(batches, 0):
            for data, wanted in zip(_texts(batch.column(0)), batch.column(1).to_pylist()):
                found = [data[w["start"] : w["start"] + w["n"] + length - 1] for w in wanted]
                arrays = [pa.array([w[c] for w in wanted]) for c in ("shard", "crowded", "d1", "d2", "weight")]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(found, pa.binary())], names=["shard", "crowded", "d1", "d2", "weight", "data"])

    return joined.select("packed", "wanted").mapInArrow(cut, "shard long, crowded boolean, d1 long, d2 long, weight long, data binary")


_MEMBER = np.dtype([("key", "<u4"), ("d1", "<i8"), ("d2", "<i8"), ("at", "<i4")])
_FOUND = "d1 long, d2 long, first long, last long, range long, shard long, keys binary, members binary"


def _runs(owner: np.ndarray, at: np.ndarray):
    """Runs of consecutive places of one owner: (owner, first, last)."""
    begin = np.flatnonzero((np.diff(owner, prepend=-1) != 0) | (np.diff(at, prepend=-2) != 1))
    end = np.append(begin[1:], len(at)) - 1
    return owner[begin], at[begin], at[end]


def search_shard(frame, length: int, ranges: int):
    """Repeated windows of one shard, and the windows of crowded anchors, published by range."""
    import hashlib

    import pandas as pd

    from paddock.llm.suffix_array import build, common_prefixes

    stretches = frame["data"].tolist()
    symbols, key, owner, sa = build(stretches)
    prefixes = common_prefixes(symbols, key, owner, sa)
    sizes = np.array([len(s) for s in stretches], np.int64)
    begin = np.cumsum(sizes + 1) - (sizes + 1)
    del symbols, key
    place = sa - begin[owner[sa]]
    is_window = place + length <= sizes[owner[sa]]
    group = np.cumsum(prefixes < length) - 1
    # suffixes that are too short share fewer bytes with any other, so groups of several hold windows only
    sa, place, group = sa[is_window], place[is_window], group[is_window]
    own = owner[sa]
    weight = np.bincount(group, frame["weight"].to_numpy()[own])
    repeated = weight[group] >= 2
    o, p = own[repeated], place[repeated]
    order = np.lexsort((p, o))
    runs, first, last = _runs(o[order], p[order])
    d1, d2 = frame["d1"].to_numpy(), frame["d2"].to_numpy()
    out = [pd.DataFrame({"d1": d1[runs], "d2": d2[runs], "first": first, "last": last, "range": -1, "shard": -1, "keys": None, "members": None})]
    public = frame["crowded"].to_numpy(bool)[own]
    if public.any():
        own, place, group = own[public], place[public], group[public]
        numbers, leader, number = np.unique(group, return_index=True, return_inverse=True)
        digests = np.array(
            [hashlib.blake2b(stretches[own[i]][place[i] : place[i] + length], digest_size=16).digest() + b"\1" for i in leader], "S17"
        )
        order = np.argsort(digests)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        digests = digests[order]
        bucket = np.frombuffer(digests.tobytes(), np.uint8).reshape(-1, 17)[:, :4].astype(np.int64) @ [1 << 24, 1 << 16, 1 << 8, 1] * ranges >> 32
        members = np.zeros(len(own), _MEMBER)
        members["key"], members["d1"], members["d2"], members["at"] = rank[number], d1[own], d2[own], place
        members = members[np.argsort(members["key"], kind="stable")]
        rows = []
        for r in np.unique(bucket):
            low, high = np.searchsorted(bucket, [r, r + 1])
            some = members[np.searchsorted(members["key"], low) : np.searchsorted(members["key"], high)].copy()
            some["key"] -= np.uint32(low)
            rows.append((0, 0, -1, -1, r, int(frame["shard"].iloc[0]), digests[low:high].tobytes(), some.tobytes()))
        out.append(pd.DataFrame(rows, columns=["d1", "d2", "first", "last", "range", "shard", "keys", "members"]))
    return pd.concat(out, ignore_index=True)


def merge_range(frame):
    """Windows of one range that more than one shard has published."""
    import pandas as pd

    lists = [np.frombuffer(keys, "S17") for keys in frame["keys"]]
    merged = np.sort(np.concatenate(lists))
    repeated = merged[1:][merged[1:] == merged[:-1]]
    out = pd.DataFrame({"d1": [], "d2": [], "first": [], "last": []}, dtype="int64")
    if not len(repeated):
        return out
    parts = []
    for keys, members in zip(lists, frame["members"]):
        at = np.minimum(np.searchsorted(repeated, keys), len(repeated) - 1)
        rows = np.frombuffer(members, _MEMBER)
        rows = rows[(repeated[at] == keys)[rows["key"]]]
        parts.append(pd.DataFrame({"d1": rows["d1"], "d2": rows["d2"], "first": rows["at"].astype("int64"), "last": rows["at"].astype("int64")}))
    return pd.concat(parts, ignore_index=True)


def merged_runs(runs: Column, length: int) -> Column:
    """Runs of window starts in order, those joined whose windows overlap or touch."""

    def add(done: Column, run: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        longer = F.struct(last["first"].alias("first"), F.greatest(last["last"], run["last"]).alias("last"))
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))
        return F.when((F.size(done) > 0) & (run["first"] <= last["last"] + length), joined).otherwise(F.array_append(done, run))

    return F.aggregate(runs, F.array().cast("array<struct<first:bigint,last:bigint>>"), add)


def repeats(df: DataFrame, text: str, length: int = LENGTH, shard: int = SHARD, crowd: int = CROWD, whole: bool = False) -> DataFrame:
    """(sha, n_removed, n_spans, kept) of every different text that loses bytes; kept: what is left, as bytes.

    With ``whole`` a character that a cut splits is left out of ``kept`` altogether.
    """
    if length < 2 * GRAM:
        raise ValueError(f"length must be at least {2 * GRAM}")
    table = distinct_texts(df, text, length)
    outer = _with(table, cut_lineage(_unique(_anchors(table, length, False), "struck")), "struck")
    both = _with(outer, cut_lineage(_unique(_anchors(outer, length, True), "inner_struck")), "inner_struck")
    places = cut_lineage(_stretches(both, length))
    different = places.groupBy("anchor", "d1", "d2").agg(
        F.sum("copies").alias("weight"), F.min("n").alias("n"), F.min(F.struct("t1", "t2", "start")).alias("sample")
    )
    crowds = different.groupBy("anchor").agg(F.count("*").alias("stretches"))
    different = cut_lineage(different.join(crowds, "anchor"))
    alone = different.where("stretches = 1 and weight >= 2").select("d1", "d2", F.lit(0).cast("long").alias("first"), (F.col("n") - 1).alias("last"))
    several = different.where("stretches > 1")
    size = several.agg(F.sum(F.col("n") + length)).first()[0] or 0
    shards = max(1, -(-size // shard))
    crowded = F.col("stretches") > crowd
    salt = F.when(crowded, F.pmod(F.xxhash64("d1", "d2"), F.ceil(F.col("stretches") / crowd))).otherwise(0)
    wanted = several.select(F.pmod(F.xxhash64("anchor", salt), F.lit(shards)).alias("shard"), crowded.alias("crowded"), "d1", "d2", "weight", "n", "sample.*")
    data = _bytes_of(table, wanted, length)
    found = cut_lineage(data.groupBy("shard").applyInPandas(lambda frame: search_shard(frame, length, shards), _FOUND))
    inside = found.where("range < 0").select("d1", "d2", "first", "last")
    across = found.where("range >= 0").groupBy("range").applyInPandas(merge_range, "d1 long, d2 long, first long, last long")
    runs = alone.union(inside).union(across)
    # one row for each stretch, whose places may be very many; a stretch has no more runs than an anchor has windows
    joined_runs = runs.groupBy("d1", "d2").agg(F.array_sort(F.collect_set(F.struct("first", "last"))).alias("runs"))
    joined_runs = joined_runs.withColumn("runs", merged_runs(F.col("runs"), length))
    moved = F.transform("runs", lambda r: F.struct((F.col("start") + r["first"]).alias("a"), (F.col("start") + r["last"] + length).alias("b")))
    spans = places.join(joined_runs, ["d1", "d2"]).select("t1", "t2", moved.alias("spans"))
    spans = spans.groupBy("t1", "t2").agg(F.flatten(F.collect_list("spans")).alias("spans"))

    def remove(batches):
        import pyarrow as pa

        for batch in _portions(batches, 1):
            rows = []
            for data, spans in zip(_texts(batch.column(1)), batch.column(2).to_pylist()):
                kept, removed, count, at = [], 0, 0, 0
                end = -1
                for a, b in sorted((s["a"], s["b"]) for s in spans):
                    if a > end:  # a new run of removed bytes
                        kept.append(data[at:a])
                        count += 1
                        removed += b - a
                        end = at = b
                    elif b > end:
                        removed += b - end
                        end = at = b
                kept.append(data[at:])
                if whole:
                    kept = [part.decode("utf-8", "ignore").encode() for part in kept]
                rows.append((removed, count, b"".join(kept)))
            removed, count, kept = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(removed, pa.int64()), pa.array(count, pa.int64()), pa.array(kept, pa.binary())], names=["sha", "n_removed", "n_spans", "kept"]
            )

    joined = table.join(spans, ["t1", "t2"]).select("sha", "packed", "spans")
    return joined.mapInArrow(remove, "sha binary, n_removed long, n_spans long, kept binary")


RESULTS = ("kept", "n_bytes", "n_removed", "n_spans")


def without_repeats(df: DataFrame, text: str, length: int = LENGTH, whole: bool = False) -> DataFrame:
    """``df`` with kept (bytes that are left), n_bytes, n_removed and n_spans of each row's text.

    These replace columns of their names; ``common.set_aside`` keeps such columns.
    """
    df = df.drop(*RESULTS)
    mark = fresh("text_sha", df)
    found = repeats(df, text, length, whole=whole).withColumnRenamed("sha", mark)
    marked = df.withColumn(mark, F.unhex(F.sha2(utf8(text), 256)))
    joined = marked.join(found, mark, "left")
    zero = F.lit(0).cast("long")
    return joined.withColumns(
        {
            "kept": F.coalesce("kept", utf8(text)),
            "n_bytes": F.octet_length(utf8(text)).cast("long"),
            "n_removed": F.coalesce("n_removed", zero),
            "n_spans": F.coalesce("n_spans", zero),
        }
    ).drop(mark)
