"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier (operator 10).

Voters are words of a lexicon, patterns, and words and word beginnings that go with toxic rows in the bounded
training sample; the sample's own label is one more voter. The label model takes each voter's rates of firing in
toxic and in other texts as unknown, and finds them by expectation and maximisation; a voter that fires together
with others more than the classes explain counts for less. A logistic regression on the fired voters is then
fitted to the posterior labels, and scores every text in one pass.

At most TRAIN_ROWS labelled rows are learned from (smallest hashes of the id), and at most MOST_FOUND voters are
found in them. Null and empty texts fire no voter. Rows with a null id count as held out. Without labelled rows of
both kinds only the lexicon votes. Repeated rows are scored alike; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, functions as F

from paddock.llm.common import scanned, utf8
from paddock.llm.quality_model import fold, sample_of

TRAIN_ROWS = 16_000
MOST_FOUND = 320
MIN_ROWS = 5  # toxic rows in which a found voter must fire
MIN_SHARE = 0.9  # share of toxic rows among those in which it fires
FOLDS, HELD_OUT = 4, 2
CUT = 0.3
BEGINNINGS = (4, 5, 6)
WORD = re.compile(r"[^\W\d_]+")

#: Insults and abuse, a starting point that the label model weighs (fixed values).
LEXICON = tuple(
    (
        "idiot idiots moron morons stupid dumb dumbass loser losers trash garbage scum scumbag worthless pathetic disgusting clown clowns fool "
        "imbecile cretin vermin filth filthy hateful ugly freak creep coward liar bitch bastard asshole jerk shit crap fuck fucking retard "
        "retarded whore slut prick douche subhuman parasite "
        "dummkopf arschloch scheiße trottel depp abschaum widerlich hure connard salaud merde crétin ordure débile putain "
        "idiota imbécil estúpido basura mierda cabrón puta gilipollas asqueroso"
    ).split()
)
PATTERNS = {
    "shouting": lambda text, lower: len(text) > 20 and sum(map(str.isupper, text)) > 0.5 * len(text),
    "exclaiming": lambda text, lower: "!!" in text,
    "addressing": lambda text, lower: " you are " in lower or " you're " in lower,
    "masked": lambda text, lower: re.search(r"[a-z][*#$%]{2,}", lower) is not None,
}


def features(text: str) -> set[str]:
    """Words of a text, and beginnings of its words, marked by a final star."""
    words = set(WORD.findall(text.lower()))
    return {w for w in words if len(w) > 2} | {w[:k] + "*" for w in words for k in BEGINNINGS if len(w) > k}


class Voters:
    """Which voters fire in a text."""

    def __init__(self, terms: list[str]):
        self.names = list(dict.fromkeys([*LEXICON, *terms])) + [*PATTERNS, "quiet"]
        self.words = {t: i for i, t in enumerate(self.names[: -len(PATTERNS) - 1]) if not t.endswith("*")}
        self.starts = {t[:-1]: i for i, t in enumerate(self.names) if t.endswith("*")}
        self._firsts = {t[: BEGINNINGS[0]] for t in (*self.words, *self.starts)}

    def fired(self, data: bytes) -> list[int]:
        text = data.decode("utf-8", "replace")
        lower = text.lower()
        k = BEGINNINGS[0]
        out = set()
        for word in set(WORD.findall(lower)):
            if word[:k] in self._firsts:
                out.add(self.words.get(word))
                out.update(self.starts.get(word[:n]) for n in BEGINNINGS if len(word) > n)
        out.discard(None)
        first = len(self.names) - len(PATTERNS) - 1
        if not out:
            out.add(first + len(PATTERNS))  # no term: a vote for clean
        out.update(first + i for i, pattern in enumerate(PATTERNS.values()) if pattern(text, lower))
        return sorted(out)


def label_model(fires: np.ndarray, given: np.ndarray, rounds: int = 6) -> np.ndarray:
    """Posterior probability of the toxic class for each row of ``fires`` (rows x voters, 0 or 1).

    A voter that doesn't fire abstains. ``given`` are the noisy labels that the rates start from; they vote in
    every row.
    """
    votes = np.column_stack([fires, given]).astype(np.float64)
    posterior = np.clip(given.astype(np.float64), 0.05, 0.95)
    for _ in range(rounds):
        sides = []
        for weight in (posterior, 1.0 - posterior):
            total = weight.sum()
            rate = (weight @ votes + 0.5) / (total + 1.0)
            centred = (votes - rate) * np.sqrt(weight)[:, None]
            covariance = centred.T @ centred / max(total, 1.0)
            scale = np.sqrt(rate * (1 - rate))
            sides.append((total / len(votes), rate, covariance / np.outer(scale, scale)))
        (share, toxic, corr1), (_, clean, corr0) = sides
        # a voter that others fired in the row repeat within a class is so much less evidence
        shared = np.clip(np.maximum(corr1, corr0), 0, 1)
        np.fill_diagonal(shared, 0.0)
        shared[-1] = shared[:, -1] = 0.0  # the label is no part of the text
        own = votes / (1.0 + votes @ np.where(shared > 0.3, shared, 0.0))
        fired = np.log(toxic / clean)
        against = np.log((1 - toxic[-1]) / (1 - clean[-1]))
        odds = np.log(share / (1 - share)) + own @ fired + (1 - votes[:, -1]) * against
        posterior = 1.0 / (1.0 + np.exp(-np.clip(odds, -30, 30)))
        posterior = np.clip(posterior, 1e-4, 1 - 1e-4)
    return posterior


def linear(fires: np.ndarray, target: np.ndarray, ridge: float = 0.1, rounds: int = 25) -> np.ndarray:
    """Logistic regression on soft labels by Newton's method; the last weight is the intercept, unpenalised."""
    rows = np.column_stack([fires, np.ones(len(fires))]).astype(np.float64)
    penalty = np.full(rows.shape[1], ridge)
    penalty[-1] = 1e-6
    weights = np.zeros(rows.shape[1])
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(rows @ weights, -30, 30)))
        slope = rows.T @ (target - p) - penalty * weights
        bend = (rows * (p * (1 - p))[:, None]).T @ rows + np.diag(penalty)
        step = np.linalg.solve(bend, slope)
        weights += step
        if np.abs(step).max() < 1e-6:
            break
    return weights


def _found(chosen: DataFrame) -> list[str]:
    """Terms that go with toxic rows of the sample, at most MOST_FOUND."""

    def count(batches):
        import pyarrow as pa

        for batch in batches:
            toxic, clean = Counter(), Counter()
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                (toxic if label else clean).update(features(text.decode("utf-8", "replace")))
            names = list(toxic.keys() | clean.keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([toxic[n] for n in names], pa.int64()), pa.array([clean[n] for n in names], pa.int64())],
                names=["term", "toxic", "clean"],
            )

    counts = chosen.mapInArrow(count, "term string, toxic long, clean long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    share = F.col("toxic") / (F.col("toxic") + F.col("clean"))
    best = counts.where((F.col("toxic") >= MIN_ROWS) & (share >= MIN_SHARE)).orderBy(F.desc(F.col("toxic") * share), "term").limit(MOST_FOUND)
    return [row["term"] for row in best.collect()]


def fit(docs: DataFrame, labels: DataFrame, id_column: str, text: str, label: str) -> tuple[list[str], np.ndarray]:
    """Found terms and the classifier's weights. What is collected: terms, and fired voters of the sample."""
    sample = sample_of(labels, id_column, label, fold(id_column, FOLDS) != HELD_OUT, TRAIN_ROWS)
    chosen = docs.join(F.broadcast(sample), docs[id_column] == sample["id"]).select(utf8(text).alias("text"), "label")
    terms = _found(chosen)
    voters = Voters(terms)
    fired = scanned(chosen, lambda texts: {"fired": [voters.fired(x) for x in texts]}, F.col("text"), "fired array<int>", {"label": F.col("label")}).toPandas()
    given = fired["label"].to_numpy(float)
    if len(given) == 0 or given.min() == given.max():
        weights = np.zeros(len(voters.names) + 1)
        weights[: len(LEXICON)], weights[-1] = 3.0, -2.5
        return terms, weights
    fires = np.zeros((len(given), len(voters.names)))
    for i, numbers in enumerate(fired["fired"]):
        fires[i, list(numbers)] = 1.0
    order = np.lexsort((*fires.T, given))  # a fixed order, so that a rerun sums alike
    fires, given = fires[order], given[order]
    return terms, linear(fires, label_model(fires, given))


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """(id, held_out, score, predicted) of each row of ``docs``."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_column, text, label))  # some hundred terms

    def scan(texts: list[bytes]) -> dict[str, list[float]]:
        terms, weights = model.value
        voters = Voters(terms)
        odds = np.array([weights[voters.fired(x)].sum() for x in texts]) + weights[-1]
        return {"score": 1.0 / (1.0 + np.exp(-np.clip(odds, -30, 30)))}

    held = F.coalesce(fold(id_column, FOLDS) == HELD_OUT, F.lit(True))
    scored = scanned(docs, scan, F.col(f"`{text}`"), "score double", {id_column: F.col(f"`{id_column}`"), "held_out": held})
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))
