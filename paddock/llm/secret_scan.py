"""Secrets in whole texts: known formats, and stretches of high entropy (operator 11), in SQL functions only.

Three formats are searched by pattern: an assignment to a telling name, an access key and a run of lower-case
hexadecimal digits. Beside them, candidate strings are runs of characters of one class (hexadecimal digits; letters,
digits and the signs of base 64). A window of ``WINDOW`` characters slides over each; the Shannon entropy of its characters
is kept up to date by two counts, that of the character that comes in and that of the one that goes out: with c
occurrences of a character, the sum of c log2 c over the window is all that the entropy depends on. The sum is kept in
whole millionths, so that it is the same whatever the order of the steps. Windows above the class's entropy, joined where
they overlap, are spans; a candidate that the allow-list names gives none, nor does a span inside one of a known format.

Everything happens within a row: no shuffle, no Python. A long candidate is cut into blocks of ``BLOCK`` windows that
overlap by a window, so state and intermediate arrays stay small and no step depends on the candidate's length.

Null and empty texts, and texts without finds, have no spans and the digest of the empty text. Spans are in code points,
their end is exclusive; ties of start go by kind as listed. Repeated rows are rows of their own. Very long texts are searched
whole. The result has the columns named in ``keep`` (any names but those of the results) and the results; other columns of
the input, whatever their names, neither matter nor come along. An empty table gives an empty table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from paddock.llm.common import fresh


def either_case(words: str) -> str:
    """A pattern of plain words for A-Z and a-z alike, and for no other letters."""
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in words)


# Known formats, with the least length that counts (of group 2 for assignments).
NAMES = "password|passwd|secret|token|api_?key"
ASSIGN = rf"""({either_case(NAMES)})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 8
ACCESS, HEX = r"AKIA[A-Z0-9]{12,}", r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64")

WINDOW = 20
BLOCK = 2048  # windows
UNIT = 1 << 20  # of c log2 c
ALPHABET = 128


@dataclass(frozen=True)
class CharacterClass:
    """Characters of a candidate, what it must contain, and the least entropy of a window in bits a character."""

    kind: str
    characters: str
    needs: tuple[str, ...]
    bits: float


CLASSES = (
    CharacterClass("entropy_hex", "0-9A-Fa-f", ("[0-9]", "[A-Fa-f]"), 3.0),
    CharacterClass("entropy_base64", "A-Za-z0-9+/_=-", ("[0-9]", "[A-Z]", "[a-z]"), 3.7),
)
#: Candidates that hold one of these are no secrets: identifiers of rows, alphabets in order, stand-ins, digests of files.
ALLOWED = (
    r"[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}",
    r"(?i)abcdefgh|hijklmno|qrstuvwx|01234567|12345678|87654321",
    r"(?i)example|placeholder|changeme|dummy|sample|test_?key|your_?(key|token|secret)|redacted|x{6}",
    r"(.)\1{7}",
)
#: A candidate after one of these is data or a digest in the open, not a secret.
ALLOWED_BEFORE = "(" + either_case(";base64,|sha(1|224|256|384|512)") + "[-:=]|" + either_case("md5") + "[-:=]|" + either_case("integrity=") + r"""["']?)\z"""
#: Words, capitalised words, abbreviations and short numbers; a candidate of these and signs is a path or a name.
NAME_PART = r"(?<![A-Za-z0-9])([A-Z]?[a-z]+|[A-Z]+|[0-9]{1,8})(?![A-Za-z0-9])"


def weight(count: int) -> int:
    """count log2 count in whole UNITs."""
    return round(count * math.log2(count) * UNIT) if count else 0


WEIGHTS = tuple(weight(c) for c in range(WINDOW + 1))


def most_weight(bits: float) -> int:
    """The highest sum of weights of a window with at least ``bits`` bits a character."""
    return math.floor((WINDOW * math.log2(WINDOW) - WINDOW * bits) * UNIT)


def running(lengths: Column) -> Column:
    """Sums of the array up to and with each element, 64 elements at a time so that no array grows step by step."""

    def sums(values: Column) -> Column:
        start = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("all"))
        step = lambda s, v: F.struct((s["sum"] + v).alias("sum"), F.array_append(s["all"], s["sum"] + v).alias("all"))
        return F.aggregate(values, start, step)["all"]

    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / 64).cast("int")), lambda i: sums(F.slice(lengths, i * 64 + 1, 64)))
    totals = F.transform(blocks, lambda b: F.element_at(b, -1))
    before = F.concat(F.array(F.lit(0)), sums(totals))
    moved = F.transform(blocks, lambda b, i: F.transform(b, lambda v: v + F.get(before, i)))
    return F.when(F.size(lengths) == 0, F.array().cast("array<int>")).otherwise(F.flatten(moved))


def spans_of(kind: str, starts: Column, ends: Column, good: Column | None = None) -> Column:
    """Sortable spans from parallel arrays."""
    rank = F.lit(KINDS.index(kind))
    both = F.arrays_zip(starts.alias("start"), ends.alias("end"), (good if good is not None else F.transform(ends, lambda e: F.lit(True))).alias("good"))
    return F.transform(F.filter(both, lambda x: x["good"]), lambda x: F.struct(x["start"].alias("start"), rank.alias("rank"), x["end"].alias("end")))


def window_starts(block: Column, most: int) -> Column:
    """Where windows of at most ``most`` weight start in a short string of ASCII characters: [(first, last), ...].

    The counts are a string with one character for each character of the alphabet, A for none, B for one and so on.
    """
    letters = F.split(block, "")
    weights = F.array(*[F.lit(w).cast("long") for w in WEIGHTS])
    held = lambda counts, ch: F.ascii(F.substring(counts, F.ascii(ch) + 1, F.lit(1))) - 65
    put = lambda counts, ch, n: F.overlay(counts, F.char(n + 65), F.ascii(ch) + 1, F.lit(1))
    start = F.struct(
        F.lit("A" * ALPHABET).alias("counts"), F.lit(0).cast("long").alias("sum"), F.array().cast("array<struct<first:int,last:int>>").alias("runs")
    )

    def moved(state: Column, i: Column) -> Column:
        counts, comes = state["counts"], F.get(letters, i)
        goes = F.when(i >= WINDOW, F.get(letters, i - WINDOW))
        same = F.coalesce(goes == comes, F.lit(False))
        n_in, n_out = held(counts, comes), held(counts, goes)
        without = F.when(goes.isNull(), counts).otherwise(put(counts, goes, n_out - 1))
        less = F.when(goes.isNull(), F.lit(0).cast("long")).otherwise(F.get(weights, n_out) - F.get(weights, n_out - 1))
        total = F.when(same, state["sum"]).otherwise(state["sum"] + F.get(weights, n_in + 1) - F.get(weights, n_in) - less)
        return F.struct(F.when(same, counts).otherwise(put(without, comes, n_in + 1)).alias("counts"), total.alias("sum"), state["runs"].alias("runs"))

    def noted(state: Column, i: Column) -> Column:
        at, runs = i - (WINDOW - 1), state["runs"]
        last = F.get(runs, F.size(runs) - 1)
        extended = F.concat(F.slice(runs, 1, F.size(runs) - 1), F.array(F.struct(last["first"].alias("first"), at.alias("last"))))
        fresh_run = F.array_append(runs, F.struct(at.alias("first"), at.alias("last")))
        joined = F.when((F.size(runs) > 0) & (last["last"] + WINDOW >= at), extended).otherwise(fresh_run)
        high = (i >= WINDOW - 1) & (state["sum"] <= most)
        return F.struct(state["counts"].alias("counts"), state["sum"].alias("sum"), F.when(high, joined).otherwise(runs).alias("runs"))

    # one array element for the moved state, so that it is computed once
    step = lambda state, i: F.get(F.transform(F.array(moved(state, i)), lambda s: noted(s, i)), 0)
    return F.aggregate(F.sequence(F.lit(0), F.length(block) - 1), start, step)["runs"]


def entropy_runs(candidate: Column, most: int) -> Column:
    """Character ranges [start, end) of the high windows of a candidate, joined where they overlap or touch."""
    raw = candidate.cast("binary")
    n = F.octet_length(candidate) - (WINDOW - 1)  # windows
    blocks = F.sequence(F.lit(0), F.floor((n - 1) / BLOCK).cast("int"))
    found = F.flatten(
        F.transform(
            blocks,
            lambda b: F.transform(
                window_starts(F.substring(raw, b * BLOCK + 1, F.lit(BLOCK + WINDOW - 1)).cast("string"), most),
                lambda r: F.struct((r["first"] + b * BLOCK).alias("start"), (r["last"] + b * BLOCK + WINDOW).alias("end")),
            ),
        )
    )

    def join(done: Column, r: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        longer = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last["start"].alias("start"), r["end"].alias("end"))))
        return F.when((F.size(done) > 0) & (last["end"] >= r["start"]), longer).otherwise(F.array_append(done, r))

    return F.aggregate(found, F.array().cast("array<struct<start:int,end:int>>"), join)


def suppressed(candidate: Column, before: Column) -> Column:
    """Whether the allow-list names the candidate or what stands before it."""
    named = F.lit(False)
    for pattern in ALLOWED:
        named = named | candidate.rlike(pattern)
    rest = F.regexp_replace(candidate, NAME_PART, "")
    return named | before.rlike(ALLOWED_BEFORE) | ~rest.rlike("[A-Za-z0-9]")


def turns(found: Column, gaps: Column) -> Column:
    """Length of each find together with the gap before it, in code points."""
    return F.transform(found, lambda f, i: F.char_length(F.get(gaps, i)) + F.char_length(f))


def starts_of(found: Column, ends: Column) -> Column:
    return F.transform(ends, lambda e, i: e - F.char_length(F.get(found, i)))


def entropy_spans(c: CharacterClass, found: Column, gaps: Column, ends: Column) -> Column:
    """Spans of the high windows of all candidates of a class."""

    def spans(f: Column, i: Column) -> Column:
        usable = ~suppressed(f, F.get(gaps, i))
        for need in c.needs:
            usable = usable & f.rlike(need)
        offset, rank = F.get(ends, i) - F.octet_length(f), F.lit(KINDS.index(c.kind))
        runs = F.transform(
            entropy_runs(f, most_weight(c.bits)),
            lambda r: F.struct((r["start"] + offset).alias("start"), rank.alias("rank"), (r["end"] + offset).alias("end")),
        )
        return F.when(usable, runs).otherwise(F.array().cast("array<struct<start:int,rank:int,end:int>>"))

    return F.flatten(F.transform(found, spans))


def find_secrets(docs: DataFrame, text: str, keep: dict[str, Column], classes: tuple[CharacterClass, ...] = CLASSES) -> DataFrame:
    """The ``keep`` columns, n_assign, n_access, n_hex, n_entropy, base_spans and spans (``kind:start:end,...``)."""
    taken = {c.lower() for c in keep}

    def own(name: str) -> str:
        name = fresh(name, docs)
        while name.lower() in taken:
            name += "_"
        return name

    body = own("body")
    frame = docs.select(*[c.alias(n) for n, c in keep.items()], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias(body))
    all_kinds: dict[str, Column] = {}
    searches = [("assign", ASSIGN), ("access", ACCESS), ("hex", HEX)]
    searches += [(c.kind, f"[{c.characters}]{{{WINDOW},}}") for c in classes]
    # what is found and what stands between, in turns
    frame = frame.select("*", *[F.regexp_extract_all(body, F.lit(p), F.lit(0)).alias(own(f"found_{k}")) for k, p in searches])
    places = []
    for kind, pattern in searches:
        found, gaps = own(f"found_{kind}"), own(f"gaps_{kind}")
        places.append(F.when(F.size(found) > 0, F.split(body, pattern, -1)).otherwise(F.array().cast("array<string>")).alias(gaps))
    frame = frame.select("*", *places)
    at = {kind: tuple(F.col(own(f"{x}_{kind}")) for x in ("found", "gaps", "ends")) for kind, _ in searches}
    frame = frame.select("*", *[running(turns(found, gaps)).alias(own(f"ends_{kind}")) for kind, (found, gaps, _) in at.items()])
    for kind in KINDS[:3]:
        found, _, ends = at[kind]
        good = F.transform(found, lambda f: F.length(F.regexp_extract(f, ASSIGN, 2)) >= ASSIGN_VALUE) if kind == "assign" else None
        all_kinds[kind] = spans_of(kind, starts_of(found, ends), ends, good)
    base = F.array_sort(F.concat(*[all_kinds[k] for k in KINDS[:3]]))
    frame = frame.select("*", base.alias(own("base")))
    known = F.col(own("base"))
    inside = lambda s: F.exists(known, lambda k: (k["start"] <= s["start"]) & (k["end"] >= s["end"]))
    extra = [F.filter(entropy_spans(c, *at[c.kind]), lambda s: ~inside(s)) for c in classes]
    frame = frame.select("*", F.concat(*extra).alias(own("extra")))
    more = F.col(own("extra"))
    kinds = F.array(*[F.lit(k) for k in KINDS])
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"], s["end"])), ",")
    number = lambda k: F.size(F.filter(known, lambda s: s["rank"] == KINDS.index(k))).cast("long").alias(f"n_{k}")
    return frame.select(
        *[F.col(f"`{n}`") for n in keep],
        *[number(k) for k in KINDS[:3]],
        F.size(more).cast("long").alias("n_entropy"),
        written(known).alias("base_spans"),
        written(F.array_sort(F.concat(known, more))).alias("spans"),
    )
