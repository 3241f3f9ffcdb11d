"""SimHash near-duplicates by tiled exact comparison (operator 6).

Fingerprints are computed in one pass. Equal ones are one class, so copies are never compared. The classes
are put into tiles by the number of set bits in each quarter of the fingerprint; two fingerprints that
differ in d bits have counts that differ by d in all at most, so only tile pairs whose counts differ
within the radius are compared, by numpy exclusive-or and bit counts. Tiles have a bounded size: a full one
is split by hash, and pairs of tiles are ordinary rows that Spark deals out. Each tile pair hands out one link
for each node at most (a spanning forest of its hits), never the pairs themselves.

About 4 % of all fingerprint pairs are compared: the work still grows with the square of the number of
distinct fingerprints, as the method has it.

Null and empty texts have fingerprint 0 and are linked like any other; repeated rows share their class; null
ids never become a component's id unless it has no other. An empty table gives an empty table.
"""

from __future__ import annotations

from itertools import product
from math import acos, ceil, pi, sqrt

from pyspark.sql import Column, DataFrame, Window, functions as F

from paddock.llm.common import components, forest, fresh, scanned, utf8
from paddock.session import cut_lineage

SEED = 42
SHINGLE = 3
RADIUS = 3
TILE = 2048  # fingerprints in a tile, on average at most
WIDE_TILE = 8192
VERIFIED = 2048  # texts of a group whose shingles are compared together, on average at most
QUARTERS, SIDE = 4, 17  # a quarter has 0 to 16 bits set
_ROWS = 256  # rows of a tile compared at once
RARE = 500  # a shingle that one text in so many has is common
SHORT_RUN = 32  # texts with one shingle that are compared pair by pair
BUCKET = 1 << 19  # shingles of a bucket, on average at most
PIECE = 1 << 20  # shingles packed at once


def shingles_of(text: bytes, size: int) -> list[bytes]:
    words = text.lower().split()  # bytes: A-Z only, and the ASCII blanks only
    if len(words) < size:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*[words[i:] for i in range(size)])))


def fingerprint(text: bytes, size: int = SHINGLE, seeds: tuple[int, ...] = (SEED,), distinct: bool = False) -> bytes:
    """64 bits for each seed: a bit is set if it is set in over half the shingles' hashes."""
    import numpy as np
    import xxhash

    shingles = shingles_of(text, size)
    if not shingles:
        return bytes(8 * len(seeds))
    if distinct:
        shingles = list(set(shingles))
    counts = np.zeros((len(seeds), 64), np.int64)
    for start in range(0, len(shingles), 1 << 16):
        part = shingles[start : start + (1 << 16)]
        for row, seed in zip(counts, seeds):
            digests = b"".join([xxhash.xxh64_digest(s, seed) for s in part])
            row += np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * counts > len(shingles), axis=1).tobytes()


def fingerprints(df: DataFrame, text: Column, keep: dict[str, Column], size: int = SHINGLE) -> DataFrame:
    """The columns of ``keep`` and the fingerprint of each text as a signed number ``fp``."""
    return scanned(df, lambda texts: {"fp": [int.from_bytes(fingerprint(x, size), "big", signed=True) for x in texts]}, text, "fp long", keep)


def common_shingles(df: DataFrame, text: Column, size: int) -> list[int]:
    """Hashes of the shingles that stand in about one text of ``RARE`` or more; ``RARE`` times a text's shingles of them at most.

    Tasks count a batch of texts at a time and hand on what stands in three texts of it and in one of ``RARE``. The list
    only orders shingles, so that those of many texts are looked up last: no result depends on what it misses.
    """
    rare, few, piece = RARE, 3, PIECE

    def count(batches):
        import numpy as np
        import pyarrow as pa

        def counted(sets):
            values, times = np.unique(np.concatenate(sets), return_counts=True)
            often = times >= max(few, len(sets) / rare)
            # the last row only counts texts
            values, times = np.append(values[often], np.uint64(0)).view(np.int64), np.append(times[often], 0)
            texts = np.append(np.zeros(len(values) - 1, np.int64), len(sets))
            return pa.RecordBatch.from_arrays([pa.array(values), pa.array(times, pa.int64()), pa.array(texts)], names=["shingle", "times", "texts"])

        sets, held = [], 0
        for batch in batches:
            for x in batch.column(0).unique():
                sets.append(shingle_set(x.as_py(), size))
                held += len(sets[-1])
                if held >= piece:
                    yield counted(sets)
                    sets, held = [], 0
        if sets:
            yield counted(sets)

    found = df.select(utf8(text).alias("data")).mapInArrow(count, "shingle long, times long, texts long")
    found = cut_lineage(found.groupBy("shingle").agg(F.sum("times").alias("times"), F.sum("texts").alias("texts")))
    texts = found.agg(F.sum("texts")).first()[0] or 0
    return [r["shingle"] for r in found.where(F.col("times") >= max(few, texts / rare)).select("shingle").collect()]


def wide_fingerprints(df: DataFrame, text: Column, keep: dict[str, Column], size: int, seeds: tuple[int, ...], common: list[int], likeness: float) -> DataFrame:
    """The columns of ``keep``, the fingerprint of each text's set of shingles as bytes ``fp``, 8 for each seed, and ``first``: the shingles
    of which two sets of ``likeness`` share one at least.

    Sets of n shingles that agree in a share j of their union have j times n in common, so all but that many, and one more, meet whatever
    the order. The order is that of the hashes, with ``common`` ones last.
    """

    def scan(texts):
        import numpy as np

        last, firsts = np.sort(np.array(common, np.int64).view(np.uint64)), []
        for x in texts:
            own = shingle_set(x, size)
            n = len(own) - ceil(likeness * len(own) - 1e-9) + 1
            if len(last):
                often = last[np.minimum(np.searchsorted(last, own), len(last) - 1)] == own
                if often[:n].any():
                    own = np.concatenate([own[~often], own[often]])
            firsts.append(own[:n].tobytes())
        return {"fp": [fingerprint(x, size, seeds, True) for x in texts], "first": firsts}

    return scanned(df, scan, text, "fp binary, first binary", keep)


def hits(left, right, radius: int):
    """Index pairs of fingerprints within the radius; a row of unsigned 64-bit integers for each fingerprint."""
    import numpy as np

    found = [np.empty((0, 2), np.int64)]
    for start in range(0, len(left), _ROWS):
        apart = np.bitwise_count(left[start : start + _ROWS, None, 0] ^ right[None, :, 0])
        for word in range(1, left.shape[1]):
            apart += np.bitwise_count(left[start : start + _ROWS, None, word] ^ right[None, :, word])
        near = np.argwhere(apart <= radius)
        near[:, 0] += start
        found.append(near)
    return np.concatenate(found)


def links(classes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) that connect the distinct fingerprints ``fp`` of ``classes`` as all pairs within the radius do."""
    quarter = [F.bit_count(F.shiftrightunsigned("fp", 16 * q).bitwiseAND(F.lit(0xFFFF))) for q in range(QUARTERS)]
    key = sum((q * SIDE**i for i, q in enumerate(quarter)), F.lit(0)).cast("int")
    keyed = classes.select("fp", key.alias("key"))
    # at most 17^4 rows of three numbers, whatever the input
    parts = cut_lineage(keyed.groupBy("key").agg(F.ceil(F.count("*") / TILE).cast("int").alias("parts")))
    tiles = cut_lineage(
        keyed.join(F.broadcast(parts), "key")
        .groupBy("key", F.pmod(F.xxhash64("fp"), "parts").cast("int").alias("part"))
        .agg(F.sort_array(F.collect_list("fp")).alias("fps"))
    )
    steps = [d for d in product(range(-radius, radius + 1), repeat=QUARTERS) if sum(map(abs, d)) <= radius]
    shift = F.array(*[F.struct(*[F.lit(d).alias(f"d{i}") for i, d in enumerate(step)]) for step in steps])
    digit = lambda i: F.expr(f"cast(key div {SIDE**i} as int) % {SIDE}")
    moved = [digit(i) + F.col(f"step.d{i}") for i in range(QUARTERS)]
    near = tiles.select("key", "part", F.explode(shift).alias("step"))
    for m in moved:
        near = near.where(m.between(0, SIDE - 1))
    near = near.select("key", "part", sum((m * SIDE**i for i, m in enumerate(moved)), F.lit(0)).cast("int").alias("other"))
    others = parts.select(F.col("key").alias("other"), F.col("parts").alias("other_parts"))
    pairs = near.where("other >= key").join(F.broadcast(others), "other")
    pairs = pairs.select("key", "part", "other", F.explode(F.sequence(F.lit(0), F.col("other_parts") - 1)).alias("other_part"))
    pairs = pairs.where("other > key or other_part >= part")
    right = tiles.select(F.col("key").alias("other"), F.col("part").alias("other_part"), F.col("fps").alias("other_fps"))
    compared = pairs.join(tiles, ["key", "part"]).join(right, ["other", "other_part"])

    def compare(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            a, b = [], []
            for left, other in zip(batch.column(0), batch.column(1)):
                # views of the batch's memory
                left, other = (x.values.to_numpy(zero_copy_only=False).view(np.uint64) for x in (left, other))
                near = hits(left[:, None], other[:, None], radius)
                if len(near):
                    nodes, at = np.unique(np.concatenate([left[near[:, 0]], other[near[:, 1]]]), return_inverse=True)
                    root = forest(at[: len(near)], at[len(near) :], len(nodes))
                    linked = np.flatnonzero(root != np.arange(len(nodes)))
                    a.append(nodes[linked].view(np.int64))
                    b.append(nodes[root[linked]].view(np.int64))
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    return compared.select("fps", "other_fps").mapInArrow(compare, "a long, b long").distinct()


def wide_links(classes: DataFrame, radius: int, width: int) -> DataFrame:
    """As ``links``, for fingerprints of any width and radii of many bits.

    Such a radius leaves few tile pairs to skip, so tiles are large and go by the count of all bits. Work grows with the square of the
    fingerprints; ``shared_links`` has no such growth but needs the shingles.
    """
    # the bits of a byte string: of its hexadecimal digits, each counted by its value
    digits = F.hex("fp")
    bits = sum((F.lit(n) * F.regexp_count(digits, F.lit(f"[{d}]")) for n, d in ((1, "1248"), (2, "3569AC"), (3, "7BDE"), (4, "F"))), F.lit(0))
    keyed = classes.select("fp", bits.cast("int").alias("key"))
    # a row for each count of bits
    parts = cut_lineage(keyed.groupBy("key").agg(F.ceil(F.count("*") / WIDE_TILE).cast("int").alias("parts")))
    tiles = keyed.join(F.broadcast(parts), "key").groupBy("key", F.pmod(F.xxhash64("fp"), "parts").cast("int").alias("part"))
    tiles = cut_lineage(tiles.agg(F.array_join(F.sort_array(F.collect_list(F.hex("fp"))), "").alias("fps")).withColumn("fps", F.unhex("fps")))
    names = tiles.select("key", "part")
    # names of tiles only; their number squared is what the method compares
    others = names.toDF("other", "other_part")
    near = names.join(F.broadcast(others), (F.col("other") >= F.col("key")) & (F.col("other") <= F.col("key") + radius))
    pairs = near.where("other > key or other_part >= part")
    right = tiles.toDF("other", "other_part", "other_fps")
    compared = pairs.join(tiles, ["key", "part"]).join(right, ["other", "other_part"]).select("fps", "other_fps")

    def compare(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for left, other in zip(batch.column(0), batch.column(1)):
                left, other = (np.frombuffer(x.as_buffer(), f"S{width}") for x in (left, other))
                near = hits(left.view(np.uint64).reshape(len(left), -1), other.view(np.uint64).reshape(len(other), -1), radius)
                near = near[left[near[:, 0]] != other[near[:, 1]]]
                if len(near):
                    nodes, at = np.unique(np.concatenate([left[near[:, 0]], other[near[:, 1]]]), return_inverse=True)
                    root = forest(at[: len(near)], at[len(near) :], len(nodes))
                    linked = np.flatnonzero(root != np.arange(len(nodes)))
                    whole = lambda values: pa.array([v.ljust(width, b"\0") for v in values.tolist()], pa.binary())
                    yield pa.RecordBatch.from_arrays([whole(nodes[linked]), whole(nodes[root[linked]])], names=["a", "b"])

    # comparing takes long for its few bytes, so pairs are dealt out one by one
    spread = compared.repartition(int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 2)
    return spread.mapInArrow(compare, "a binary, b binary").distinct()


def joined(words, radius: int):
    """For each fingerprint the first one that it is connected to by pairs within the radius; a row of unsigned 64-bit integers for each.

    Breadth first, as in ``alike``: near copies of one text are compared once each.
    """
    import numpy as np

    root, left = np.arange(len(words)), np.arange(len(words))
    rest = words
    while len(left) > 1:
        first, left, rest = left[0], left[1:], rest[1:]
        waiting = [first]
        while waiting and len(left):
            near = np.bitwise_count(rest ^ words[waiting.pop()]).sum(axis=1, dtype=np.int32) <= radius
            if near.any():
                found = left[near]
                root[found] = first
                waiting.extend(found.tolist())
                left, rest = left[~near], rest[~near]
    return root


def run_links(shingles, words, radius: int):
    """Index pairs that connect, among fingerprints with an equal shingle, those within the radius as all such pairs do.

    ``shingles`` rise; short runs of equal ones are compared all at once, a pair of places at a time.
    """
    import numpy as np

    starts = np.flatnonzero(np.diff(shingles) != 0) + 1
    starts, ends = np.insert(starts, 0, 0), np.append(starts, len(shingles))
    counts = ends - starts
    a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for start, end in zip(starts[counts > SHORT_RUN], ends[counts > SHORT_RUN]):
        root = joined(words[start:end], radius)
        linked = np.flatnonzero(root != np.arange(end - start))
        a.append(linked + start)
        b.append(root[linked] + start)
    last = np.repeat(np.where(counts > SHORT_RUN, starts, ends), counts) - 1  # no pair starts in a long run
    left = np.flatnonzero(last > np.arange(len(shingles)))
    apart = 1
    while len(left):
        near = np.bitwise_count(words[left] ^ words[left + apart]).sum(axis=1, dtype=np.int32) <= radius
        a.append(left[near])
        b.append(left[near] + apart)
        apart += 1
        left = left[last[left] >= left + apart]
    return np.concatenate(a), np.concatenate(b)


def shared_links(marked: DataFrame, mark: str, radius: int, width: int) -> DataFrame:
    """Links (a, b) that connect the fingerprints of texts as all pairs do that share a shingle of ``first`` and lie within the radius.

    Shingles travel with their text's fingerprint, packed by bucket; a bucket holds a bounded number on average. What is compared
    grows with the texts that share a rare shingle, not with all pairs.
    """
    total = marked.agg(F.sum(F.length("first") / 8)).first()[0] or 0
    parts = max(int(marked.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(total // BUCKET) + 1)
    piece, wide = PIECE, width // 8

    def pack(batches):
        import numpy as np
        import pyarrow as pa

        seen = set()  # copies in this task
        for batch in batches:
            marks = batch.column(0).to_pylist()
            new = [i for i, m in enumerate(marks) if not (m in seen or seen.add(m))]
            sizes = np.array([len(batch.column(2)[i].as_buffer()) // 8 for i in new], np.int64)
            block = np.cumsum(sizes) // piece
            for k in np.unique(block):
                rows = [new[i] for i in np.flatnonzero(block == k)]
                shingles = np.frombuffer(b"".join(batch.column(2)[i].as_py() for i in rows), "<u8")
                prints = np.frombuffer(b"".join(batch.column(1)[i].as_py() for i in rows), "<u8").reshape(len(rows), wide)
                entries = np.column_stack([shingles, np.repeat(prints, sizes[block == k], axis=0)])
                bucket = (shingles % np.uint64(parts)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                entries, bucket = entries[order], bucket[order]
                starts = np.flatnonzero(np.diff(bucket, prepend=-1))
                data = [entries[s:e].tobytes() for s, e in zip(starts, np.append(starts[1:], len(bucket)))]
                yield pa.RecordBatch.from_arrays([pa.array(bucket[starts], pa.int64()), pa.array(data, pa.binary())], names=["bucket", "data"])

    def compare(frame):
        import numpy as np
        import pandas as pd

        entries = np.frombuffer(b"".join(frame["data"]), "<u8").reshape(-1, wide + 1)
        entries = entries[np.lexsort((entries[:, 1], entries[:, 0]))]
        entries = entries[np.insert((entries[1:] != entries[:-1]).any(axis=1), 0, True)]  # copies of other tasks
        words = np.ascontiguousarray(entries[:, 1:])
        a, b = run_links(entries[:, 0], words, radius)
        pairs = np.unique(np.column_stack([words[a], words[b]]), axis=0) if len(a) else np.empty((0, 2 * wide), "<u8")
        pairs = pairs[(pairs[:, :wide] != pairs[:, wide:]).any(axis=1)]
        return pd.DataFrame({"a": [p.tobytes() for p in pairs[:, :wide]], "b": [p.tobytes() for p in pairs[:, wide:]]})

    packed = marked.select(mark, "fp", "first").mapInArrow(pack, "bucket long, data binary")
    return packed.groupBy("bucket").applyInPandas(compare, "a binary, b binary").distinct()


def grouped(marked: DataFrame, id_column: str, link) -> DataFrame:
    """Group of each fingerprint: (fp, root, component_id), component_id the smallest id of the group's rows."""
    classes = cut_lineage(marked.groupBy("fp").agg(F.min(f"`{id_column}`").alias("least")))
    roots = components(link(classes))
    rooted = classes.join(roots, classes["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.select("fp", "root").join(least, "root").select("fp", "root", "component_id")


def near_duplicates(df: DataFrame, id_column: str, text: str, size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(id, fingerprint as 16 hex digits, component_id) of each row."""
    marked = cut_lineage(fingerprints(df, F.col(f"`{text}`"), {id_column: F.col(f"`{id_column}`")}, size))
    groups = grouped(marked, id_column, lambda classes: links(classes, radius))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return marked.join(groups.select("fp", "component_id"), "fp").select(f"`{id_column}`", digits, "component_id")


def shingle_set(text: bytes, size: int):
    """Distinct hashes of the shingles; a text without a word has one of its own."""
    import numpy as np
    import xxhash

    digests = b"".join([xxhash.xxh64_digest(x, SEED) for x in shingles_of(text, size)])
    return np.unique(np.frombuffer(digests, "<u8")) if digests else np.zeros(1, "<u8")


def alike(sets: list, likeness: float):
    """For each set the first one that it is connected to by pairs with a Jaccard likeness of at least ``likeness``.

    Breadth first: a set is compared with those that no component has yet, so near copies of one text cost little.
    """
    import numpy as np

    sizes = np.array([len(s) for s in sets])
    values, at = np.unique(np.concatenate(sets), return_inverse=True)
    names = np.split(at, np.cumsum(sizes)[:-1])
    own, root, left = np.zeros(len(values), np.int32), np.arange(len(sets)), np.arange(len(sets))
    while len(left) > 1:
        first, left = left[0], left[1:]
        waiting = [first]
        while waiting and len(left):
            x = waiting.pop()
            small, large = np.minimum(sizes[x], sizes[left]), np.maximum(sizes[x], sizes[left])
            other = left[small / large >= likeness]
            if not len(other):
                continue
            own[names[x]] = 1
            shared = np.add.reduceat(own[np.concatenate([names[o] for o in other])], np.cumsum(sizes[other]) - sizes[other])
            own[names[x]] = 0
            found = other[shared / (sizes[x] + sizes[other] - shared) >= likeness]
            if len(found):
                root[found] = first
                waiting.extend(found.tolist())
                left = np.setdiff1d(left, found, assume_unique=True)
    return root


def verified(hashed: DataFrame, node: str, text: str, groups: DataFrame, size: int, likeness: float) -> DataFrame:
    """(node, root) of the texts that are connected to others by shingles that agree in ``likeness`` of their union.

    ``groups`` (node, root) holds the candidates, each text once. Texts of one group meet in blocks of bounded size, every pair of blocks
    in one place; it hands out a link for each text at most.
    """
    crowds = groups.groupBy("root").agg(F.ceil(F.count("*") / VERIFIED).cast("int").alias("blocks"), F.count("*").alias("n")).where("n > 1")
    several = cut_lineage(groups.join(crowds.drop("n"), "root"))
    buckets = several.count() // VERIFIED + 1
    texts = hashed.select(F.col(node).alias("node"), utf8(text).alias("data")).join(several, "node").select("node", "root", "blocks", "data")

    def cut(batches):
        import pyarrow as pa

        seen = set()  # copies in this task
        for batch in batches:
            nodes, rows, found = batch.column(0).to_pylist(), [], []
            for i, n in enumerate(nodes):
                if n not in seen:
                    seen.add(n)
                    rows.append(i)
                    found.append(shingle_set(batch.column(3)[i].as_py(), size).tobytes())
            if rows:
                kept = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([*(kept.column(i) for i in range(3)), pa.array(found, pa.binary())], names=["node", "root", "blocks", "shingles"])

    root = groups.schema["root"].dataType.simpleString()
    sets = texts.mapInArrow(cut, f"node long, root {root}, blocks int, shingles binary")
    sets = sets.withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    paired = sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where("blocks = 1 or other <> block")
    paired = paired.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other"), "bucket": F.pmod(F.xxhash64("root"), F.lit(buckets))})

    def compare(frame):
        import numpy as np
        import pandas as pd

        a, b = [], []
        for _, part in frame.groupby("root"):
            nodes = part["node"].to_numpy()
            root = alike([np.frombuffer(x, "<u8") for x in part["shingles"]], likeness)
            linked = np.flatnonzero(nodes != nodes[root])
            a.append(nodes[linked])
            b.append(nodes[root[linked]])
        none = [np.empty(0, np.int64)]
        return pd.DataFrame({"a": np.concatenate(a or none), "b": np.concatenate(b or none)})

    columns = ["root", "node", "shingles", "bucket", "low", "high"]
    return components(paired.select(columns).groupBy("bucket", "low", "high").applyInPandas(compare, "a long, b long"))


def one_of_each_group(df: DataFrame, id_column: str, text: str, size: int = 5, seeds: tuple[int, ...] = (42, 43, 44), likeness: float = 0.8) -> DataFrame:
    """The rows of ``df`` without near-duplicates: of each group the smallest id stays (of equal ids the
    smallest text hash, of equal rows one). Texts are linked if their sets of shingles have a Jaccard likeness of at
    least ``likeness``. Columns stay as they are. Texts without a word are one group, null ones included.

    Candidates share one of their first shingles, as sets of that likeness must, and have near fingerprints: two sets of likeness j differ
    in a share arccos(2j / (1 + j)) / pi of the bits at most, on average; the radius lies 4.3 deviations above. Every link is verified by
    the shingles.
    """
    mark, place = fresh("text_hash", df), fresh("place_in_group", df)
    width = 8 * len(seeds)
    share = acos(2 * likeness / (1 + likeness)) / pi
    radius = ceil(8 * width * share + 4.3 * sqrt(8 * width * share * (1 - share)) - 0.5)
    hashed = df.withColumn(mark, F.xxhash64(utf8(text)))
    keep = {id_column: F.col(f"`{id_column}`"), mark: F.col(mark)}
    common = common_shingles(df, F.col(f"`{text}`"), size)
    marked = cut_lineage(wide_fingerprints(hashed, F.col(f"`{text}`"), keep, size, seeds, common, likeness))
    linked = shared_links(marked, mark, radius, width)
    candidates = grouped(marked, id_column, lambda classes: linked).select("fp", "root")
    candidates = marked.select(F.col(mark).alias("node"), "fp").distinct().join(candidates, "fp").select("node", "root")
    groups = verified(hashed, mark, text, candidates, size, likeness)
    # structs compare field by field; a null id comes last
    first = F.min(F.struct(F.col(f"`{id_column}`").isNull().alias("none"), F.col(f"`{id_column}`").alias("id"), F.col(mark).alias("hash")))
    rooted = marked.join(groups, marked[mark] == groups["node"], "left").withColumn("root", F.coalesce("root", mark))
    stays = rooted.groupBy("root").agg(first.alias("first")).select("first.id", "first.hash").distinct()
    left = hashed.join(stays, hashed[id_column].eqNullSafe(stays["id"]) & (hashed[mark] == stays["hash"]), "left_semi")
    order = Window.partitionBy(f"`{id_column}`", mark).orderBy(F.lit(0))
    return left.withColumn(place, F.row_number().over(order)).where(F.col(place) == 1).drop(place, mark)
