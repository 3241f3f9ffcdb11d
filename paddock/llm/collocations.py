"""Phrases of 2 to 4 words that stand together more often than apart, by language (operator 13).

A phrase's score is 2,000,000 a / (l + r), rounded down, at its worst cut: a its own frequency, l and r those of the
two parts. A longer phrase is no more frequent than its prefix p, and its rest is at least as frequent as itself, so
2,000,000 f(p) / (f(first word of p) + f(p)) bounds every phrase that grows from p. The search is best first: words and
pairs are counted for the whole corpus; then the prefixes of the highest bounds are grown, those of a
language together down to a bound at which some thousand of its pairs lie. All phrases that score as much are known then,
and so is which of them survive. A language with ``top`` survivors at or above the bound is settled, ties and all; for the
others the bound falls and only prefixes between the new and the old bound are grown, until nothing is left to grow.

A phrase is dropped if a longer candidate holds it and is nearly as frequent; the one-word extensions decide
that, since a candidate between the two is at least as frequent as the longer one. They are counted with the growth.

Counting is one pass for each length: tasks count in numpy and hand on sums, which are summed again before and after the
shuffle, so a very common phrase is one row of each task. Passes leave out what cannot count: occurrences with a
rare word or pair, or with no prefix to grow. That is looked up in filters of a bounded size (``FILTER_BITS``),
which may let too much through but never too little; exact joins follow. A filter too full costs time only.

Null texts are empty, null languages are ``und``; a text without words or pairs adds nothing. Every row counts, repeated
ones too. Ties of score go by frequency, then by the phrase's UTF-8 bytes. Very long texts are read in stretches that end
at a piece's end, whole texts all the same. Only the two columns named are read, others may have any name. An empty
table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from paddock.session import cut_lineage

TOP, LEAST = 2000, 30
SCALE = 2_000_000
DROP_PERCENT = 80
BREAKS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
STRETCH = 8 << 20  # bytes of text counted together
FILTER_BITS = (13, 27)  # least and most, as powers of two: 1 KB to 16 MB
GOALS = (2, 16)  # first bounds: as many times ``top`` pairs lie above them
NO_LANGUAGE = "und"


# counting inside a task


def _table(fill: dict[int, bytes]) -> np.ndarray:
    out = np.zeros(256, np.uint8)
    for value, members in fill.items():
        out[list(members)] = value
    return out


KINDS = _table({1: BLANKS, 2: BREAKS})
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def words_of(data: bytes) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Word numbers in order, the words by number, and the piece that each stands in."""
    raw = np.frombuffer(data, np.uint8)
    kind = KINDS[raw]
    inside = kind == 0
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    piece = np.cumsum(kind == 2, dtype=np.int32)[start]
    offsets = np.zeros(len(start) + 1, np.int32)
    np.cumsum(end - start, out=offsets[1:])
    packed = LOWER[raw[inside]]
    words = pa.Array.from_buffers(pa.string(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(packed)])
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary, piece


def stretches(text: bytes) -> Iterator[bytes]:
    """The text in parts that end at a piece's end and hold about STRETCH bytes, more only within one piece."""
    at = 0
    while len(text) - at > STRETCH:
        cut = max(text.rfind(b, at, at + STRETCH) for b in (bytes([c]) for c in BREAKS))
        if cut < at:
            later = [x for x in (text.find(bytes([c]), at + STRETCH) for c in BREAKS) if x >= 0]
            if not later:
                break
            cut = min(later)
        yield text[at : cut + 1]
        at = cut + 1
    yield text[at:]


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    """(language, texts joined by a break) in portions of about STRETCH bytes."""
    held: dict[str, list[bytes]] = {}
    size: dict[str, int] = {}
    for batch in batches:
        for language, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            for part in stretches(text.as_py()):
                held.setdefault(language, []).append(part)
                size[language] = size.get(language, 0) + len(part) + 1
                if size[language] >= STRETCH:
                    yield language, b"\n".join(held.pop(language))
                    del size[language]
        if sum(size.values()) >= 4 * STRETCH:
            yield from ((language, b"\n".join(parts)) for language, parts in held.items())
            held, size = {}, {}
    yield from ((language, b"\n".join(parts)) for language, parts in held.items())


def word_hashes(words: pa.Array) -> np.ndarray:
    import xxhash

    return np.fromiter((xxhash.xxh64_intdigest(w.as_buffer() or b"", 7) for w in words), np.uint64, len(words))


def language_hash(language: str) -> np.uint64:
    import xxhash

    return np.uint64(xxhash.xxh64_intdigest(language.encode("utf-8", "replace"), 7))


def longer(hashes: np.ndarray | np.uint64, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase from that of its beginning and its last word's."""
    mixed = (hashes ^ word) * np.uint64(0x9E3779B97F4A7C15)
    return mixed ^ (mixed >> np.uint64(29))


class Filter:
    """A set of phrases in a bounded number of bits; says yes to all members and to few others."""

    def __init__(self, words: np.ndarray):
        self.words = words

    @staticmethod
    def places(hashes: np.ndarray, bits: int) -> Iterator[np.ndarray]:
        step = (hashes >> np.uint64(32)) | np.uint64(1)
        for i in range(3):
            yield (hashes + np.uint64(i) * step) & np.uint64(bits - 1)

    def __contains__(self, item) -> bool:
        raise TypeError("test whole arrays")

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for place in self.places(hashes, 64 * len(self.words)):
            found &= ((self.words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1)).astype(bool)
        return found


def phrases_at(hashes: np.ndarray, language: np.uint64, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each word on."""
    n = len(hashes) - size + 1
    out = longer(language, hashes[:n])
    for i in range(1, size):
        out = longer(out, hashes[i : i + n])
    return out


def occurrences(data: bytes, language: str, size: int, parts: dict[int, Filter], grow: Filter | None, check: Filter | None, exact: Filter | None):
    """(phrases, counts) of ``size`` words within pieces.

    Counted are those whose words and pairs are all in ``parts`` and that begin with a phrase of ``grow`` or end
    with one of ``check``, if these are given; or those of ``exact``.
    """
    ids, words, piece = words_of(data)
    n = len(ids) - size + 1
    if n <= 0:
        return None
    at = np.flatnonzero(piece[:n] == piece[size - 1 :])
    hashes, tongue = word_hashes(words), language_hash(language)
    for width, known in parts.items():
        if width == 1:
            good = known.has(longer(tongue, hashes))[ids]
        else:
            good = np.zeros(len(ids), bool)
            where = np.flatnonzero(piece[: len(ids) - width + 1] == piece[width - 1 :])
            good[where] = known.has(phrases_at(hashes[ids], tongue, width)[where])
        for i in range(size - width + 1):
            at = at[good[at + i]]
    if exact is not None:
        at = at[exact.has(phrases_at(hashes[ids], tongue, size)[at])]
    elif grow is not None or check is not None:
        shorter = phrases_at(hashes[ids], tongue, size - 1)
        wanted = np.zeros(len(at), bool)
        if grow is not None:
            wanted |= grow.has(shorter[at])
        if check is not None:
            wanted |= check.has(shorter[at + 1])
        at = at[wanted]
    if not len(at):
        return None
    keys = ids[at].astype(np.int64)
    for i in range(1, size):
        if i > 1:
            keys = np.unique(keys, return_inverse=True)[1]
        keys = keys * len(words) + ids[at + i]
    _, first, counts = np.unique(keys, return_index=True, return_counts=True)
    chosen = at[first]
    columns = [words.take(pa.array(ids[chosen + i])) for i in range(size)]
    import pyarrow.compute as pc

    return (pc.binary_join_element_wise(*columns, " ") if size > 1 else columns[0]), counts


# the same over Spark


def counted(texts: DataFrame, size: int, least: int = 0, parts: dict[int, Filter] | None = None, grow=None, check=None, exact=None) -> DataFrame:
    """(lang, phrase, a) of phrases of ``size`` words with a frequency of at least ``least``; written to the shared folder."""

    def count(batches):
        for language, data in gathered(batches):
            found = occurrences(data, language, size, parts or {}, grow, check, exact)
            if found is not None:
                phrases, counts = found
                for start in range(0, len(counts), 20_000):
                    part = slice(start, start + 20_000)
                    names = pa.array([language] * len(counts[part]), pa.string())
                    yield pa.RecordBatch.from_arrays([names, phrases[part], pa.array(counts[part])], ["lang", "phrase", "a"])

    sums = texts.mapInArrow(count, "lang string, phrase string, a long").groupBy("lang", "phrase").agg(F.sum("a").alias("a"))
    return cut_lineage(sums.where(F.col("a") >= least))


def filter_of(phrases: DataFrame) -> Filter | None:
    """A filter of the (lang, phrase) rows; None if there are none. Its size reaches the driver, whatever the rows."""
    n = phrases.count()
    if not n:
        return None
    least, most = FILTER_BITS
    bits = 1 << min(max(least, (16 * n).bit_length()), most)

    def places(batches):
        for batch in batches:
            languages = batch.column(0).to_pylist()
            ids, words, row = words_of(b"\n".join(p.as_py().encode("utf-8", "surrogateescape") for p in batch.column(1)))
            hashes = word_hashes(words)[ids]
            tongue = {x: language_hash(x) for x in set(languages)}
            size = np.bincount(row, minlength=len(languages))
            first = np.cumsum(size) - size
            out = longer(np.array([tongue[x] for x in languages], np.uint64), hashes[first])
            for i in range(1, int(size.max(initial=1))):
                more = size > i
                out[more] = longer(out[more], hashes[first[more] + i])
            place = np.unique(np.concatenate(list(Filter.places(out, bits))))
            word, start = np.unique(place >> np.uint64(6), return_index=True)
            value = np.bitwise_or.reduceat(np.uint64(1) << (place & np.uint64(63)), start)
            yield pa.RecordBatch.from_arrays([pa.array(word.astype(np.int64)), pa.array(value.view(np.int64))], ["word", "value"])

    found = phrases.select("lang", "phrase").mapInArrow(places, "word long, value long")
    rows = found.groupBy("word").agg(F.bit_or("value").alias("value")).toArrow()
    words = np.zeros(bits >> 6, np.uint64)
    words[rows.column("word").to_numpy()] = rows.column("value").to_numpy().view(np.uint64)
    return Filter(words)


def ratio(a: str | Column, left: Column, right: Column) -> Column:
    """floor(SCALE * a / (left + right)) in decimals, as the product may pass 64 bits."""
    whole = "decimal(38,0)"
    a = F.col(a) if isinstance(a, str) else a
    return F.call_function("div", F.lit(SCALE).cast("decimal(7,0)") * a.cast("decimal(25,0)"), (left.cast("decimal(25,0)") + right).cast(whole))


def cuts(*pairs: tuple[str, str]) -> list[Column]:
    """l, r and score of the lowest-scoring cut, the earliest among equals; a cut of unknown parts is none."""
    each = [F.struct(ratio("a", F.col(x), F.col(y)).alias("score"), F.lit(i).alias("k"), F.col(x).alias("l"), F.col(y).alias("r")) for i, (x, y) in enumerate(pairs)]
    worst = F.array_min(F.array(*each))
    return [worst["score"].alias("score"), worst["l"].alias("l"), worst["r"].alias("r")]


def bound() -> Column:
    """The highest score that the phrase or one that begins with it can have."""
    return ratio("a", F.col("head1"), F.col("a")).alias("bound")


def beginning(words: int) -> Column:
    return F.substring_index("phrase", " ", words)


def end(words: int) -> Column:
    return F.substring_index("phrase", " ", -words)


def pairs_of_words(texts: DataFrame, words: DataFrame, least: int) -> DataFrame:
    """Scored pairs: lang, phrase, a, head1 (frequency of the first word), tail1 (of the last), score, l, r, bound."""
    pairs = counted(texts, 2, least, {1: filter_of(words)})
    first = words.select("lang", F.col("phrase").alias("w1"), F.col("a").alias("head1"))
    last = words.select("lang", F.col("phrase").alias("w2"), F.col("a").alias("tail1"))
    joined = pairs.withColumn("w1", beginning(1)).withColumn("w2", end(1)).join(first, ["lang", "w1"]).join(last, ["lang", "w2"])
    return cut_lineage(joined.select("lang", "phrase", "a", "head1", "tail1", *cuts(("head1", "tail1")), bound()))


def due(limits: DataFrame, table: DataFrame, value: Column) -> DataFrame:
    """Rows whose value lies at or above their language's bound and below its last one."""
    return table.join(limits, "lang").where((value >= F.col("low")) & (F.col("high").isNull() | (value < F.col("high"))))


def grown_triples(texts: DataFrame, pairs: DataFrame, limits: DataFrame, known: Filter, least: int) -> DataFrame | None:
    grow = filter_of(due(limits, pairs, F.col("bound")))
    check = filter_of(due(limits, pairs, F.col("score")))
    if grow is None and check is None:
        return None
    triples = counted(texts, 3, least, {2: known}, grow, check)
    before = pairs.select("lang", F.col("phrase").alias("p"), F.col("a").alias("head2"), "head1", F.col("bound").alias("bound_p"))
    after = pairs.select("lang", F.col("phrase").alias("s"), F.col("a").alias("tail2"), "tail1", F.col("score").alias("score_s"))
    joined = triples.withColumn("p", beginning(2)).withColumn("s", end(2)).join(before, ["lang", "p"]).join(after, ["lang", "s"])
    wanted = due(limits, joined, F.greatest("bound_p", "score_s"))
    columns = ("lang", "phrase", "a", "head1", "head2", "tail1", "tail2")
    return cut_lineage(wanted.select(*columns, *cuts(("head1", "tail2"), ("head2", "tail1")), bound()))


def grown_quadruples(texts: DataFrame, triples: DataFrame, pairs: DataFrame, limits: DataFrame, known: Filter, least: int) -> DataFrame | None:
    """Counts of four words with what is known of their parts; head3, tail3 are null where that part was not counted."""
    grow = filter_of(due(limits, triples, F.col("bound")))
    check = filter_of(due(limits, triples, F.col("score")))
    if grow is None and check is None:
        return None
    fours = counted(texts, 4, least, {2: known}, grow, check)
    before = triples.select("lang", F.col("phrase").alias("p"), F.col("a").alias("head3"), "head1", "head2", F.col("bound").alias("bound_p"))
    after = triples.select("lang", F.col("phrase").alias("s"), F.col("a").alias("tail3"), F.col("score").alias("score_s"))
    middle = pairs.select("lang", F.col("phrase").alias("m"), F.col("a").alias("tail2"), "tail1")
    joined = fours.withColumn("p", beginning(3)).withColumn("s", end(3)).withColumn("m", end(2)).join(middle, ["lang", "m"])
    joined = joined.join(before, ["lang", "p"], "left").join(after, ["lang", "s"], "left")
    wanted = due(limits, joined, F.greatest("bound_p", "score_s"))
    columns = ("lang", "phrase", "a", "head1", "head2", "head3", "tail1", "tail2", "tail3", "s")
    return cut_lineage(wanted.select(*columns, F.coalesce("bound_p", F.lit(-1)).alias("bound_p")))


def missing_ends(texts: DataFrame, fours: DataFrame, ends: DataFrame | None, limits: DataFrame, known: Filter, least: int) -> DataFrame | None:
    """Frequencies of last three words that are still unknown but may decide a score at or above the bound."""
    hope = F.least(ratio("a", F.col("head1"), F.col("a")), ratio("a", F.col("head2"), F.col("tail2")), ratio("a", F.col("head3"), F.col("tail1")))
    open_ = fours.where("tail3 is null and head3 is not null").join(limits, "lang").where(hope >= F.col("low"))
    open_ = open_.select("lang", F.col("s").alias("phrase")).distinct()
    if ends is not None:
        open_ = open_.join(ends, ["lang", "phrase"], "left_anti")
    open_ = cut_lineage(open_)
    asked = filter_of(open_)
    if asked is None:
        return ends
    more = counted(texts, 3, least, {2: known}, exact=asked).join(open_, ["lang", "phrase"], "left_semi").select("lang", "phrase", "a")
    return cut_lineage(more if ends is None else ends.union(more))


def scored_quadruples(fours: DataFrame, ends: DataFrame | None) -> DataFrame:
    if ends is not None:
        others = ends.select("lang", F.col("phrase").alias("s"), F.col("a").alias("end3"))
        fours = fours.join(others, ["lang", "s"], "left").withColumn("tail3", F.coalesce("tail3", "end3"))
    whole = fours.where("tail3 is not null and head3 is not null")
    return whole.select("lang", "phrase", "a", *cuts(("head1", "tail3"), ("head2", "tail2"), ("head3", "tail1")))


def survivors(shorter: DataFrame, extended: DataFrame | None, words: int) -> DataFrame:
    """Phrases without a one-word extension that is nearly as frequent."""
    columns = ("lang", "phrase", "a", "l", "r", "score")
    if extended is None:
        return shorter.select(*columns)
    sides = extended.select("lang", "a", F.explode(F.array(beginning(words), end(words))).alias("phrase"))
    most = sides.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    share = F.lit(100).cast("decimal(3,0)") * F.col("most").cast("decimal(25,0)") >= F.lit(DROP_PERCENT).cast("decimal(3,0)") * F.col("a").cast("decimal(25,0)")
    joined = shorter.select(*columns).join(most, ["lang", "phrase"], "left")
    return joined.where(F.col("most").isNull() | ~share).select(*columns)


def together(old: DataFrame | None, new: DataFrame | None) -> DataFrame | None:
    return new if old is None else old if new is None else old.unionByName(new)


def collocations(docs: DataFrame, text: str, lang: str, top: int = TOP, least: int = LEAST, goals: tuple[int, ...] = GOALS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases; n is its number of words."""
    language, body = F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(NO_LANGUAGE)), F.col(f"`{text}`").cast("string").cast("binary")
    texts = docs.select(language.alias("lang"), F.coalesce(body, F.lit(b"")).alias("text"))
    all_words = counted(texts, 1)
    sizes = cut_lineage(all_words.groupBy("lang").agg(F.sum("a").alias("n")))
    words = all_words.where(F.col("a") >= least)
    by_rank = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    columns = ("lang", "phrase", "a", "l", "r", "score")
    if not words.head(1):
        pairs = None
    else:
        pairs = pairs_of_words(texts, words, least)
    known = None if pairs is None else filter_of(pairs)
    best = None
    if known is not None:
        limits, triples, fours, ends = None, None, None, None
        for goal in (*goals, None):
            last = sizes.select("lang", F.lit(None).cast("long").alias("high")) if limits is None else limits.select("lang", F.col("low").alias("high"))
            if goal is None:
                low = last.select("lang", F.lit(0).cast("long").alias("low"), "high")
            else:
                ranked = pairs.withColumn("at", F.row_number().over(by_rank)).where(F.col("at") <= goal * top)
                reached = ranked.groupBy("lang").agg(F.min("score").alias("low"), F.max("at").alias("reached"))
                at_goal = F.when(F.col("reached") >= goal * top, F.col("low")).otherwise(0)
                low = last.join(reached, "lang", "left").select("lang", F.coalesce(at_goal, F.lit(0)).alias("low"), "high")
            limits = cut_lineage(low.where("high is null or low < high"))
            triples = together(triples, grown_triples(texts, pairs, limits, known, least))
            if triples is not None:
                fours = together(fours, grown_quadruples(texts, triples, pairs, limits, known, least))
            if fours is not None:
                ends = missing_ends(texts, fours, ends, limits, known, least)
            kept = survivors(pairs, triples, 2)
            if triples is not None:
                kept = kept.union(survivors(triples, fours, 3))
            if fours is not None:
                kept = kept.union(scored_quadruples(fours, ends).select(*columns))
            settled = cut_lineage(due(limits.drop("high").withColumn("high", F.lit(None).cast("long")), kept, F.col("score")).select(*columns, "low"))
            ready = settled.groupBy("lang").agg(F.count(F.lit(1)).alias("found"))
            state = cut_lineage(limits.join(ready, "lang", "left").withColumn("done", (F.col("low") == 0) | (F.coalesce("found", F.lit(0)) >= top)))
            part = settled.join(state.where("done").select("lang"), "lang", "left_semi").select(*columns)
            best = cut_lineage(part if best is None else best.union(part))
            limits = cut_lineage(state.where("not done").select("lang", "low", "high"))
            if not limits.head(1):
                break
    if best is None:
        best = all_words.select("lang", "phrase", "a", *[F.lit(None).cast("long").alias(c) for c in ("l", "r", "score")]).where(F.lit(False))
    ranked = best.withColumn("rank", F.row_number().over(by_rank)).where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
