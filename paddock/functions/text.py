"""Regex rules turned into column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

# i: ignore case, d: only \n ends a line, U: Unicode \b, \w, \s and case folding.
REGEX_FLAGS = "(?idU)"


def matches(text: Column, pattern: str, flags: str = REGEX_FLAGS) -> Column:
    """True where ``pattern`` is found in ``text``; a missing text is no match."""
    return F.coalesce(text.rlike(flags + pattern), F.lit(False))


def flag(text: Column, pattern: str, flags: str = REGEX_FLAGS) -> Column:
    return matches(text, pattern, flags).cast("int")


def first_match(
    text: Column, rules: Sequence[tuple[str, str]], default: str, flags: str = REGEX_FLAGS
) -> Column:
    """Label of the first rule found in ``text``, else ``default``."""
    label = F.lit(default)
    for pattern, name in reversed(rules):
        label = F.when(matches(text, pattern, flags), F.lit(name)).otherwise(label)
    return label


def flags_of(text: Column, patterns: Mapping[str, str], flags: str = REGEX_FLAGS) -> dict[str, Column]:
    return {name: flag(text, pattern, flags) for name, pattern in patterns.items()}


def folded(text: Column) -> Column:
    """Lower case, with the two letters that ignore-case also takes for s and i."""
    # two replacements find nothing in most texts and hand them on; a translation would look up every character
    return F.replace(F.replace(F.lower(text), F.lit("ſ"), F.lit("s")), F.lit("ı"), F.lit("i"))


class Near(str):
    """A cheap regex that finds something wherever the pattern of its hint does."""


def hint_sql(text: str, hint: str | tuple) -> str:
    """SQL condition of a hint: a text, a regex (``Near``) or a tuple of parts that must all stand there."""
    if isinstance(hint, tuple):
        parts = [p if isinstance(p, tuple) else (p,) for p in hint]
        return "(" + " and ".join("(" + " or ".join(hint_sql(text, p) for p in part) + ")" for part in parts) + ")"
    return f"{text} rlike r'(?dU){hint}'" if isinstance(hint, Near) else f"contains({text}, '{hint}')"


# What lies before and behind a whole word of a pattern, \b, never is one of these letters and digits, so the word is a run
# of them. Letters beyond ASCII cut a run, which only finds more words; a class with them took six times as long.
NO_WORD = "[^a-z0-9]+"
CUT_FROM = 256


def found_words(text: Column, words: Mapping[str, Sequence[str]], least: int = CUT_FROM) -> Column:
    """The words of a ``folded`` text that any entry of ``words`` asks for, each once; NULL for a text of fewer than ``least`` characters.

    The text is cut once, whatever the number of flags, and each of its words looked up in one set. For short texts the
    search for hints costs less than that.
    """
    wanted = sorted({w for entry in words.values() for w in entry})
    found = F.array_distinct(F.filter(F.split(text, NO_WORD), lambda word: word.isin(wanted)))
    return F.when(F.length(text) >= least, found)


def hinted_flags_of(
    text: str, patterns: Mapping[str, str], hints: Mapping[str, Sequence[str | tuple]], found: str, words: Mapping[str, Sequence[str]]
) -> dict[str, Column]:
    """0/1 flags over the column ``text`` of ``folded`` text, running a regex only where one of its words and a hint are present.

    ``found`` holds the ``found_words`` of the text: few, so most long texts are searched neither for hints nor by regex.
    Patterns hold no upper-case escapes, so lower-casing them replaces ignore-case.
    """
    columns = {}
    for name, pattern in patterns.items():
        # one parsed expression per flag: some 200 hints would be as many calls to the JVM
        asked = ", ".join(f"'{word}'" for word in words[name])
        hinted = F.expr(f"({found} is null or exists({found}, w -> w in ({asked}))) and ({' or '.join(hint_sql(text, hint) for hint in hints[name])})")
        matched = F.col(text).rlike("(?dU)" + pattern.lower())
        columns[name] = F.when(hinted & matched, F.lit(1)).otherwise(F.lit(0))
    return columns


def blank_to(column: Column, value: str) -> Column:
    """Replace a missing or whitespace-only text."""
    return F.when(column.isNull() | (trimmed(column) == ""), F.lit(value)).otherwise(column)


# Every character that counts as whitespace at the ends of a text.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def trimmed(column: Column) -> Column:
    """Strip every kind of whitespace from both ends, not only spaces."""
    return F.btrim(column, F.lit(WHITESPACE))
