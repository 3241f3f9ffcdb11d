import random
import re

import pytest
from pyspark.sql import functions as F

from paddock.functions.text import CUT_FROM, flags_of, found_words, hint_sql
from paddock.operators import gold, legacy, rules
from paddock.plans import fixtures as fx


def flags(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, Description string")
    rows = gold.text_flags(gold.with_listing_text(df)).orderBy("i").collect()
    return [{n for n in rules.TEXT_FLAGS if r[n]} for r in rows]


GENUINE = {
    "a rare survivor": "is_rare",
    "a genuine speedster": "heritage_special",
    "restored from replica parts, heritage design interior": "heritage_special",
    "Porsche 911 RSR-ST from the works": "rsr_st_special",
    "replica Porsche 911 RSR ST": "rsr_st_special",
    "sold with missing engine": "missing_drivetrain",
    "engine not included": "missing_drivetrain",
    "with accident damage to the front": "accident_damage",
    "needs a full story, requires an engine rebuild": "needs_rebuild",
    "without TÜV": "not_ready_to_drive_text",
    "NÜRBURGRING winner": "racing_history",
    "gearbox was completely overhauled": "engine_transmission_rebuilt",
    "1 of one": "is_rare",
    "kw suspension": "has_upgrades",
    "rolling chassis": "body_only",
    "won't start": "not_ready_to_drive_text",
    "only 30 built": "limited_production",
    "club sport package": "clubsport_package",
}
GUARDED = {
    "rare clone": "is_rare",
    "replica dakar": "heritage_special",
    "speedster-style body": "heritage_special",
    "sport classic, inspired build": "heritage_special",
    "limited edition tribute": "is_rare",
    "heritage shell speedster": "heritage_special",
    "replica RSR ST": "rsr_st_special",
    "rsr/st lookalike": "rsr_st_special",
    "missing engine cover": "missing_drivetrain",
    "transmission missing service records": "missing_drivetrain",
    "without gearbox noise": "missing_drivetrain",
    "no known accident damage": "accident_damage",
    "without accident damage": "accident_damage",
    "requires no work": "needs_rebuild",
    "ruffled": "ruf",
    "é911 r": "heritage_special",
    "manual steering wheel": "manual_transmission_text",
}


def test_genuine_phrases_set_their_flag(spark):
    for (text, flag), found in zip(GENUINE.items(), flags(spark, list(GENUINE))):
        assert flag in found, text


def test_guarded_phrases_do_not(spark):
    for (text, flag), found in zip(GUARDED.items(), flags(spark, list(GUARDED))):
        assert flag not in found, text


def test_hints_lose_no_match(spark):
    """Flags behind hints equal the plain patterns on phrases, their mixtures and real texts."""
    rng = random.Random(7)
    pool = [*GENUINE, *GUARDED, *fx.PHRASES]
    texts = pool + [
        rng.choice(["", "The "]) + rng.choice(pool) + rng.choice([" ", "\u00a0", ", ", "-", "\n"]) + rng.choice(pool).upper()
        for _ in range(600)
    ]
    phrases = spark.createDataFrame([(t,) for t in texts], "Description string")
    documents = fx.table(spark, "/root/testdata/sf0.001", "documents").select(F.col("text").alias("Description"))
    df = gold.with_listing_text(phrases.unionByName(documents))
    plain = flags_of(F.lower("listing_text"), rules.TEXT_FLAGS)
    both = gold.text_flags(df).select(*rules.TEXT_FLAGS, *[c.alias(f"plain_{n}") for n, c in plain.items()])
    wrong = both.agg(*[F.count_if(F.col(n) != F.col(f"plain_{n}")).alias(n) for n in rules.TEXT_FLAGS]).first().asDict()
    assert not {n: c for n, c in wrong.items() if c}


def test_penalty_is_floored(spark):
    text = "unrestored, needs engine rebuild, rolling shell, missing engine, project car, no TÜV, accident damage"
    df = spark.createDataFrame([(text,)], "Description string")
    row = gold.text_flags(gold.with_listing_text(df)).select(gold.penalty().alias("p")).first()
    assert row["p"] == -12.0


@pytest.mark.parametrize(
    "model,category",
    [
        ("Boxster Cabriolet", "718"), ("911 GT2 RSR", "GT2RS and RARE Models"), ("911 SC", "Carrera 3.0/3.2 / S / SC"),
        ("911 GT3 RSX", "Base Carrera / Targa / 912"), ("991 CLUB COUPÉ", "GT2RS and RARE Models"), (None, "Other"),
        ("Taycan", "Other"), ("gt3", "GT4 / GT3 / GT2"),
    ],
)
def test_first_matching_rule_wins(spark, model, category):
    df = spark.createDataFrame([(model,)], "Model string")
    assert gold.model_category(df).first()["model_category"] == category


def test_legacy_quirks_are_kept(spark):
    df = spark.createDataFrame([("any text", "Lanzante 911")], "Description string, Model string")
    row = legacy.model_category_legacy(legacy.text_flags_legacy(df)).first()
    assert row["legacy_has_docs"] == 1
    assert row["legacy_category"] == "Base Carrera / Targa / 912"


def test_hints_pass_over_words_that_are_not_enough(spark):
    """Common words alone run no regex; counts with any blanks or digits, and the two odd letters, still set their flags."""
    common = spark.createDataFrame([("only one of the number of bodies to start, run by no edition, unique",)], "t string")
    for name in ("is_rare", "limited_production", "body_only", "not_ready_to_drive_text"):
        assert not common.where(" or ".join(hint_sql("t", h) for h in rules.FLAG_HINTS[name])).count(), name
    texts = ["only\t30  built", "number 3\u00a0of\u20034", "only \u0663 built", "\u017fhell only", "rolling proje\u0441t", "doesn't\tstart", "pa\u0131nt to sample"]
    patterns = flags_of(F.col("t"), rules.TEXT_FLAGS)
    plain = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", *[c.alias(n) for n, c in patterns.items()])
    assert flags(spark, texts) == [{n for n in rules.TEXT_FLAGS if r[n]} for r in plain.orderBy("i").collect()]


def test_texts_without_a_flags_words_run_no_hint_and_no_regex(spark):
    """Hints that stand only within other words are passed over; whole words are found at any boundary."""
    text = "Spanish space, a motor for the Berufung, fullness of working workshops and an onlyness of cupboards"
    df = spark.createDataFrame([(text,)], "t string")
    found = set(df.select(found_words(F.col("t"), rules.FLAG_WORDS, 0)).first()[0])
    assert {n for n, words in rules.FLAG_WORDS.items() if found & set(words)} == {"missing_drivetrain"}
    edges = spark.createDataFrame([("\u00e9 spa\u2013cup\u00a0ruf_t\u00fcv 1 of 9",)], "t string")
    assert sorted(edges.select(found_words(F.col("t"), rules.FLAG_WORDS, 0)).first()[0]) == ["1", "cup", "ruf", "spa", "t", "v"]


def test_words_lose_no_match_of_any_wording(spark):
    """Each wording of a pattern, with its optional parts, joined by hyphens, blanks or nothing, and beside odd characters."""
    rng, wordings = random.Random(11), []
    for pattern in rules.TEXT_FLAGS.values():
        parts = re.findall(r"[^\W_]+", re.sub(r"\\[bsdw]|\(\?[<!=:]+|\{0,80\}", " ", pattern.lower()))
        wordings += [rng.choice(["", " ", "-", "\u00a0"]).join(parts[at : at + n]) for at in range(len(parts)) for n in (1, 2, 3)]
    wordings += [w.replace("30", "\u0663") for w in GENUINE] + ["6speed manual", "gearboxes fully rebuilt", "rebuilding the gearbox", "notrestored"]
    texts = [rng.choice(["", "x ", "\u00e9", "3 ", "not ", "1 of "]) + w + rng.choice(["", "s", " 7", "\u0301", "/t", "\u00df"]) for w in wordings]
    texts += [" " * CUT_FROM + t for t in texts]  # short texts are not cut into words
    df = gold.with_listing_text(spark.createDataFrame([(t,) for t in texts], "Description string"))
    plain = flags_of(F.lower("listing_text"), rules.TEXT_FLAGS)
    both = gold.text_flags(df).select("listing_text", *rules.TEXT_FLAGS, *[c.alias(f"plain_{n}") for n, c in plain.items()])
    wrong = both.agg(*[F.count_if(F.col(n) != F.col(f"plain_{n}")).alias(n) for n in rules.TEXT_FLAGS]).first().asDict()
    assert not {n: c for n, c in wrong.items() if c}
    assert both.agg(*[F.sum(n).alias(n) for n in rules.TEXT_FLAGS]).first().asDict()["is_race_ready"] > 0
