"""Word and word-pair weights: relational vocabulary, per-row vectors."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import NGram
from pyspark.sql import Column, DataFrame, Window, functions as F

from paddock.session import cut_lineage

# Tokens are runs of two or more letters, digits or underscores.
TOKEN = r"[\p{L}\p{N}_]{2,}"
MAX_TERMS, MIN_DF = 5000, 3
WORDS_AT_ONCE = 500_000


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN), 0)


def with_terms(df: DataFrame, text: str, out: str = "__terms") -> DataFrame:
    """Words followed by word pairs, per row and without a shuffle."""
    words = df.withColumn("__words", tokens(F.col(text)))
    pairs = NGram(n=2, inputCol="__words", outputCol="__pairs").transform(words)
    return pairs.withColumn(out, F.concat("__words", "__pairs")).drop("__words", "__pairs")


def term_counts(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, term, tf): how often each term stands in a row."""
    return with_terms(df.select(key, text), text).select(key, F.explode("__terms").alias("term")).groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))


def most_frequent(counts: DataFrame, max_terms: int, min_df: int) -> DataFrame:
    """(term, df, total) of counts by row and term: the most frequent terms of the corpus, term order deciding ties."""
    totals = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total"))
    return totals.where(F.col("df") >= min_df).orderBy(F.col("total").desc(), "term").limit(max_terms)


def word_numbering():
    """A function that goes through a list of texts' words, some texts at a time, so that a batch of long ones needs no more memory.

    It gives the first text and the end, for each word its text, counted from the first, and its number among the distinct words, and these.
    Like the other functions for tasks here it is made within a function and so travels whole: executors may not have this package.
    """
    most = WORDS_AT_ONCE

    def numbered(texts: pa.ListArray):
        ends = texts.offsets.to_numpy()
        low = 0
        while low < len(texts):
            high = max(int(np.searchsorted(ends, ends[low] + most, "right")) - 1, low + 1)
            coded = texts.values.slice(ends[low], ends[high] - ends[low]).dictionary_encode()
            row = np.repeat(np.arange(high - low), np.diff(ends[low : high + 1]))
            yield low, high, row, coded.indices.to_numpy().astype(np.int64), coded.dictionary
            low = high

    return numbered


def term_sums():
    """A function that gives (term, df, total) of some texts at a time. Terms are numbers; only the distinct ones are spelled out."""
    numbered = word_numbering()

    def sums(batches):
        for batch in batches:
            for low, high, row, word, names in numbered(batch.column(0)):
                size, beside = len(names), np.flatnonzero(row[1:] == row[:-1])
                terms = np.concatenate([word, size + word[beside] * size + word[beside + 1]])
                coded = pa.array(terms).dictionary_encode()  # by hashing; a sort takes longer
                numbers, term = coded.dictionary.to_numpy(), coded.indices.to_numpy().astype(np.int64)
                once = pa.array(term * (high - low) + np.concatenate([row, row[beside]])).unique().to_numpy() // (high - low)
                singles, pairs = np.flatnonzero(numbers < size), np.flatnonzero(numbers >= size)
                first, second = np.divmod(numbers[pairs] - size, max(size, 1))
                joined = pc.binary_join_element_wise(names.take(pa.array(first)), names.take(pa.array(second)), " ")
                spelled, order = pa.concat_arrays([names.take(pa.array(numbers[singles])), joined]), np.concatenate([singles, pairs])
                df, total = (np.bincount(x, minlength=len(numbers))[order] for x in (once, term))
                yield pa.RecordBatch.from_arrays([spelled, pa.array(df, pa.int64()), pa.array(total, pa.int64())], ["term", "df", "total"])

    return sums


def vocabulary(df: DataFrame, text: str, max_terms: int = MAX_TERMS, min_df: int = MIN_DF) -> DataFrame:
    """(term, df, total): the most frequent terms of the corpus, term order deciding ties.

    Tasks sum both frequencies over many texts before anything is shuffled, so one shuffle by term gives both.
    At most ``max_terms`` rows, whatever the corpus holds.
    """
    sums = df.select(tokens(F.col(text)).alias("words")).mapInArrow(term_sums(), "term string, df long, total long")
    totals = sums.groupBy("term").agg(F.sum("df").alias("df"), F.sum("total").alias("total"))
    return totals.where(F.col("df") >= min_df).orderBy(F.col("total").desc(), "term").limit(max_terms)


def has_repeats(df: DataFrame, key: str) -> bool:
    """Whether any two rows share a key; missing keys are alike."""
    return not df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()


def tfidf_weights(
    df: DataFrame, key: str, text: str, max_terms: int = MAX_TERMS, min_df: int = MIN_DF
) -> DataFrame:
    """(key, term, weight): (1 + ln tf) times smoothed idf, unit length per key of ``df``.

    Where no key repeats, a row's weights follow from the row and the vocabulary, at most ``max_terms`` terms: texts are read
    once for the vocabulary and once for the weights, and only the vocabulary's sums are shuffled. Rows that share a key count
    as one text, so their counts by key and term are summed and written first.
    """
    n = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    idf = F.ln((1 + n) / (1 + F.col("df"))) + 1.0
    if has_repeats(df, key):
        counts = cut_lineage(term_counts(df, key, text))
        terms = most_frequent(counts, max_terms, min_df).select("term", "df")
        weighted = counts.join(F.broadcast(terms), "term").withColumn("__w", (1.0 + F.ln("tf")) * idf)
        # at most max_terms rows per key
        length = F.sqrt(F.sum(F.col("__w") * F.col("__w")).over(Window.partitionBy(key)))
        return weighted.select(key, "term", (F.col("__w") / length).alias("weight"))
    rows = vocabulary(df, text, max_terms, min_df).select("term", idf.alias("idf")).collect()
    model = TfidfModel([r["term"] for r in rows], [r["idf"] for r in rows])
    weighted = model.with_weights(df.select(key, text), text, "__s", "__v").select(key, F.explode(F.arrays_zip("__s", "__v")).alias("__t"))
    names = F.split(F.lit(" \n".join(model.terms)), " \n")  # one literal; no term holds a line end
    return weighted.select(key, F.get(names, F.col("__t.__s")).alias("term"), F.col("__t.__v").alias("weight"))


@dataclass(frozen=True)
class TfidfModel:
    """Vocabulary and idf on the driver (at most ``max_terms`` of each); sparse weights per row."""

    terms: list[str]
    idf: list[float]

    def weighing(self):
        """A function from texts' words to structs of two arrays: term numbers, rising, and their weights before division by the row's length."""
        numbered, find, idf = word_numbering(), term_finder(self.terms), np.array(self.idf, dtype=float)

        def weighted(words: pa.Array) -> pa.Array:
            slots, raw, counts = [np.empty(0, int)], [np.empty(0)], [np.zeros(1, int)]
            for low, high, row, word, names in numbered(words):
                row, term, times = find(row, word, names)
                slots.append(term)
                raw.append((1.0 + np.log(times)) * idf[term])
                counts.append(np.bincount(row, minlength=high - low))
            ends = pa.array(np.cumsum(np.concatenate(counts)), pa.int32())
            arrays = [pa.array(np.concatenate(slots), pa.int32()), pa.array(np.concatenate(raw), pa.float64())]
            return pa.StructArray.from_arrays([pa.ListArray.from_arrays(ends, a) for a in arrays], ["slots", "raw"])

        return weighted

    def with_weights(self, df: DataFrame, text: str, slots: str, values: str) -> DataFrame:
        """Term numbers, rising, and their weights of unit length as two arrays; only the words of a text leave the JVM."""
        df = df.withColumn("__found", F.arrow_udf(self.weighing(), "slots array<int>, raw array<double>")(tokens(F.col(text))))
        df = df.withColumns({slots: F.col("__found.slots"), "__raw": F.col("__found.raw")})
        df = df.withColumn("__length", F.sqrt(F.aggregate("__raw", F.lit(0.0), lambda a, w: a + w * w)))
        # as an argument the length is computed once a row; the optimizer would draw it into the function of a transform, once a term
        lengths = F.array_repeat("__length", F.size("__raw"))
        return df.withColumn(values, F.zip_with("__raw", lengths, lambda w, n: w / n)).drop("__found", "__raw", "__length")

    def transform(self, df: DataFrame, text: str, slots: str, values: str) -> DataFrame:
        """``with_weights`` of a vocabulary that has terms."""
        if not self.terms:
            raise ValueError("empty vocabulary")
        return self.with_weights(df, text, slots, values)


def term_finder(terms: Sequence[str]):
    """A function that finds the words and word pairs of a vocabulary among numbered words: (row, term, times), rising by row and term."""
    parts = [t.split(" ") for t in terms]  # no word holds a blank
    words = sorted({w for part in parts for w in part})
    number, size = {w: i for i, w in enumerate(words)}, max(len(parts), 1)
    single = np.full(len(words) + 1, -1)  # term of each word; the last is for words that are in no term
    for t, part in enumerate(parts):
        if len(part) == 1:
            single[number[part[0]]] = t
    pairs = sorted((number[p[0]] * len(words) + number[p[1]], t) for t, p in enumerate(parts) if len(p) == 2)
    table = np.array([*pairs, (np.iinfo(np.int64).max, -1)], dtype=np.int64)

    def find(row, word, names):
        known = pc.fill_null(pc.index_in(names, value_set=pa.array(words, pa.string())), -1).to_numpy()
        word = known[word].astype(np.int64)
        beside = np.flatnonzero((row[1:] == row[:-1]) & (word[1:] >= 0) & (word[:-1] >= 0))
        pair = word[beside] * len(words) + word[beside + 1]
        at = np.searchsorted(table[:, 0], pair)
        found = np.concatenate([single[word], np.where(table[at, 0] == pair, table[at, 1], -1)])
        rows = np.concatenate([row, row[beside]])
        both, times = np.unique(rows[found >= 0] * size + found[found >= 0], return_counts=True)
        return (*np.divmod(both, size), times)

    return find


def fit_tfidf(df: DataFrame, text: str, max_terms: int = MAX_TERMS, min_df: int = 1) -> TfidfModel:
    """Vocabulary and idf of ``df``, both read to the driver."""
    rows = vocabulary(df, text, max_terms, min_df).collect()
    n = df.count()
    return TfidfModel([r["term"] for r in rows], [float(np.log((1 + n) / (1 + r["df"])) + 1.0) for r in rows])
