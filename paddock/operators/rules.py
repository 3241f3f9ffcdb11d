"""Rule tables: category cascades, keyword patterns and weights.

Every literal below is a fixed value: results follow from these exact patterns,
labels and numbers.
"""

from __future__ import annotations

from paddock.functions.text import Near

# ---- fixed values: text columns joined into the listing text -------------------
TEXT_COLUMNS = ("Title", "Model", "Description", "Secondary_Description")

# ---- fixed values: wording that marks a part as not genuine --------------------
NOT_GENUINE = (
    "style", "spec", "comparison", "replica", "look", "lookalike", "inspired", "tribute",
    "homage", "clone", "recreation", "restomod", "heritage shell",
)
NOT_BEFORE = "".join(rf"(?<!\b{word}\s)" for word in NOT_GENUINE)
NOT_AFTER = rf"(?![\s\-/,:()]*?(?:{'|'.join(NOT_GENUINE)})\b)"
NOT_A_DRIVETRAIN_PART = (
    r"(?!\s+(?:cover|covers?|trim|trims?|noise|rebuild|damage|issues?|problem|problems?|work"
    r"|service|history|paperwork|records)\b)"
)


def genuine(term: str) -> str:
    """``term`` without guard wording on either side.

    Looking ahead for the term first spares the thirteen look-behinds at every
    other position.
    """
    return rf"(?={term}){NOT_BEFORE}{term}{NOT_AFTER}"


SPECIAL_EDITION = genuine(r"(?:speedster|sport classic|dakar)")
RARITY = genuine(r"(?:rare\b|special edition|limited edition)")
HERITAGE = genuine(r"heritage design")
ST_MODELS = genuine(r"911 st\b") + "|" + genuine(r"s/t\b")
RSR_ST = genuine(r"\b(?:porsche\s+911\s+rsr[\s\-/]+st\b|911\s+rsr[\s\-/]+st\b|rsr[\s\-/]+st\b)")

# ---- fixed values: keyword flags over the lower-cased listing text --------------
TEXT_FLAGS = {
    "restoration_full": r"\b(?:frame[- ]?off|body[- ]?off|complete restoration|fully restored|fully rebuilt|nut and bolt (?:restoration|rebuild)|completely restored|full restoration|ground[- ]?up restoration|restored to (?:original|factory) specification|mechanically restored|interior refurbishment|engine overhaul)\b",
    "restoration_partial": r"\b(?:partial restoration|cosmetic refresh|lightly restored|restored in parts)\b",
    "is_restomod": r"\b(?:backdate|restomod|modified|custom (?:build|interior|paint|exhaust|engine|body))\b",
    "has_docs": r"\b(?:full (?:documentation|service history|records|history)|extensive records|well documented|fully documented)\b",
    "is_matching_numbers": r"\b(?:matching numbers|numbers matching|matching drivetrain)\b",
    "is_mint": r"\b(?:mint condition|collector quality|fully sorted|excellent condition|top condition|showroom condition)\b",
    "is_race_ready": r"\b(?:rally ready|race[- ]?ready|track[- ]?prepped|bucket seats|racing harness|homologated|fire suppression system|racing history|race winner|overall winner|group winner|24 hour|nürburgring|nurburgring|spa|le mans|adac|fia|championship|podium|cup\s*s?\b|clubsport|club sport|cup car)\b",
    "is_rare": rf"\b(?:{RARITY}|1 of (?:\d+|one)|one of \d+|only \d+ (?:produced|built|made|delivered|examples|cars)|\d+ produced|production number \d+|number \d+ of \d+|rwb|singer|guntherwerks|elfwerks|{SPECIAL_EDITION}|911 r\b|{ST_MODELS}|{HERITAGE}|bespoke|factory-approved exclusivity|exclusive manufaktur|paint to sample|pts|sonderwunsch|unique piece|unique example|special commission|commissioned)\b",
    "rsr_st_special": RSR_ST,
    "is_accident_free": r"\b(?:accident[- ]?free|never crashed|clean title|no accidents|undamaged)\b",
    "has_upgrades": r"\b(?:KW suspension|x51|upgraded brakes|recaro|limited[- ]?slip|aftermarket (?:exhaust|turbo|suspension|intake|wheels)|performance parts|turbo upgrade|weissach package)\b",
    "first_owner": r"\b(?:first owner|one owner|single owner|original owner|first hand|single registered keeper)\b",
    "limited_production": r"\b(?:one of|1 of|only)\s+\d+\s+(?:produced|built|made|delivered|examples|cars)\b|\b\d+\s+produced\b|\bnumber\s+\d+\s+of\s+\d+\b",
    "racing_history": r"\b(?:racing history|race winner|overall winner|group winner|24 hour|nürburgring|nurburgring|spa|le mans|adac|fia|championship|podium)\b",
    "specialist_build": r"\b(?:rs tuning|manthey|ruf|singer|gunther|guntherwerks|lanzante|kremer|dp motorsport|techart|gemballa|rwb|theon|paul stephens|tuthill|emerson|canepa)\b",
    "bespoke_exclusive": r"\b(?:bespoke|factory-approved exclusivity|exclusive manufaktur|paint to sample|pts|sonderwunsch|unique piece|unique example|special commission|commissioned|commission)\b",
    "zero_running_hours": r"\b(?:zero running hours|0 running hours|no running hours)\b",
    "engine_transmission_rebuilt": r"\b(?:engine and transmission|gearbox).{0,80}\b(?:overhauled|rebuilt|rebuild|restored)\b|\b(?:overhauled|rebuilt|rebuild|restored).{0,80}\b(?:engine and transmission|gearbox)\b",
    "non_rebuilt": r"\bunrestored\b|\b(?:not|never|non[- ]?)\s*(?:rebuilt|restored|overhauled)\b",
    "needs_rebuild": r"\b(?:needs?|requires?|requiring|awaiting|due for)(?!\s+no\b)\s+(?:an?\s+)?(?:(?:engine|gearbox|transmission|mechanical)\s+)?(?:rebuild|overhaul|restoration|recommissioning|work)\b",
    "body_only": r"\b(?:body[- ]?only|shell[- ]?only|bare shell|rolling shell|rolling chassis|rolling project|roller project|chassis only)\b",
    "missing_drivetrain": rf"\bmissing\s+(?:the\s+)?(?:engine|gearbox|transmission|drivetrain|motor)\b{NOT_A_DRIVETRAIN_PART}|\b(?:engine|gearbox|transmission|drivetrain)\s+(?:missing|absent|not included)\b{NOT_A_DRIVETRAIN_PART}|\bwithout\s+(?:the\s+)?(?:engine|gearbox|transmission|drivetrain|motor)\b{NOT_A_DRIVETRAIN_PART}",
    "project_car": r"\b(?:project car|restoration project|unfinished project|parts car|for restoration|requires restoration|requires recommissioning|needs recommissioning)\b",
    "not_ready_to_drive_text": r"\b(?:not ready to drive|not[\s-]+running|not[\s-]+drivable|non[- ]running|does not run|doesn'?t run|will not start|won'?t start|does(?:\s+not|n'?t)\s+start|cannot start|not roadworthy|no\s+(?:mot|tuv|tüv)\b|without\s+(?:mot|tuv|tüv)\b|no\s+(?:mot|tuv|tüv)\s+certificate|without\s+(?:mot|tuv|tüv)\s+certificate)\b",
    "accident_damage": r"(?<!no\s)(?<!without\s)(?<!no known\s)(?<!without known\s)\b(?:accident damage|damaged car|salvage title|write[- ]off|crash damage|fire damage|flood damage)\b",
    "cup_clubsport": r"\b(?:cup\s*s?\b|clubsport|club sport|cup car)\b",
    "heritage_special": rf"\b(?:{SPECIAL_EDITION}|911 r\b|{ST_MODELS}|{HERITAGE})\b",
    "weissach_package": r"\bweissach package\b",
    "pccb": r"\bpccb\b",
    "ceramic_brakes": r"\b(?:ceramic brakes?|ceramic disc brakes?)\b",
    "bucket_seats": r"\bbucket seats?\b",
    "clubsport_package": r"\bclubsport package\b|\bclub sport package\b",
    "front_axle_lift": r"\b(?:front axle lift(?: system)?|front lift system)\b",
    "sport_chrono": r"\b(?:sport chrono(?: package)?|chrono package)\b",
    "manual_transmission_text": r"\b(?:\d[- ]?speed manual|manual transmission|manual gearbox)\b",
    "paint_to_sample_text": r"\bpaint[- ]to[- ]sample\b|\bpts\b|\bsonderwunsch\b",
    "manthey": r"\bmanthey\b",
    "ruf": r"\bruf\b",
    "techart": r"\btechart\b",
    "carbon_package": r"\bcarbon package\b",
    "lightweight_package": r"\blightweight package\b",
    "full_leather": r"\b(?:full leather(?: interior)?|extended leather package)\b",
    "carbon_bucket_seats": r"\b(?:carbon(?:[ -](?:fiber|fibre))?\s+bucket seats?|carbon buckets?)\b",
}

# Every match of a flag holds at least one of its hints, so a text without them
# needs no regex. A tuple is a hint of which every part must stand there, a part that is
# a tuple being one of several texts; ``Near`` is a part that is a cheap regex. Checked
# against the plain patterns in tests/test_text_flags.py.
COUNTED = ("one of", "1 of", "only", "number")
FLAG_HINTS = {
    "restoration_full": ("frame", "body", "restor", "rebuil", "refurbish", "overhaul"),
    "restoration_partial": ("restor", "cosmetic refresh"),
    "is_restomod": ("backdate", "restomod", "modified", "custom "),
    "has_docs": ("full ", "extensive records", "documented"),
    "is_matching_numbers": ("matching",),
    "is_mint": ("condition", "collector quality", "fully sorted"),
    "is_race_ready": (
        "rally ready", "race", "track", "bucket seats", "racing h", "homologated", "fire suppression",
        "winner", "24 hour", "rburgring", "spa", "le mans", "adac", "fia", "championship", "podium",
        "cup", "club",
    ),
    "is_rare": (
        "rare", "special edition", "limited edition", "1 of ", (COUNTED, Near(r"(?:of|only|number) \d")), "produced", "rwb", "singer",
        "guntherwerks", "elfwerks", "speedster", "sport classic", "dakar", "911 r", "911 st", "s/t",
        "heritage design", "bespoke", "factory-approved", "exclusive manufaktur", "paint to sample",
        "pts", "sonderwunsch", "unique ", "commission",
    ),
    "rsr_st_special": ("rsr",),
    "is_accident_free": ("accident", "crashed", "clean title", "undamaged"),
    "has_upgrades": (
        "kw suspension", "x51", "upgraded brakes", "recaro", "limited", "aftermarket",
        "performance parts", "turbo upgrade", "weissach",
    ),
    "first_owner": ("owner", "first hand", "registered keeper"),
    "limited_production": ("produced", (COUNTED, Near(r"(?:of|only|number)\s+\d"))),
    "racing_history": (
        "racing history", "winner", "24 hour", "rburgring", "spa", "le mans", "adac", "fia",
        "championship", "podium",
    ),
    "specialist_build": (
        "rs tuning", "manthey", "ruf", "singer", "gunther", "lanzante", "kremer", "dp motorsport",
        "techart", "gemballa", "rwb", "theon", "paul stephens", "tuthill", "emerson", "canepa",
    ),
    "bespoke_exclusive": (
        "bespoke", "factory-approved", "exclusive manufaktur", "paint to sample", "pts",
        "sonderwunsch", "unique ", "commission",
    ),
    "zero_running_hours": ("running hours",),
    "engine_transmission_rebuilt": ("engine and transmission", "gearbox"),
    "non_rebuilt": ("restored", "rebuilt", "overhauled"),
    "needs_rebuild": ("rebuild", "overhaul", "restoration", "recommissioning", "work"),
    "body_only": (("only", ("body", "shell", "chassis")), "bare shell", "rolling ", "roller project"),
    "missing_drivetrain": ("missing", "absent", "not included", "without"),
    "project_car": ("project", "parts car", "restoration", "recommissioning"),
    "not_ready_to_drive_text": (
        "not ready", "running", "t run", "drivable", ("start", ("not", "doesn", "won")), "roadworthy", "mot", "tuv", "tüv",
    ),
    "accident_damage": ("damage", "salvage title", "write"),
    "cup_clubsport": ("cup", "club"),
    "heritage_special": (
        "speedster", "sport classic", "dakar", "911 r", "911 st", "s/t", "heritage design",
    ),
    "weissach_package": ("weissach package",),
    "pccb": ("pccb",),
    "ceramic_brakes": ("ceramic",),
    "bucket_seats": ("bucket seat",),
    "clubsport_package": ("sport package",),
    "front_axle_lift": ("lift",),
    "sport_chrono": ("chrono",),
    "manual_transmission_text": ("manual",),
    "paint_to_sample_text": ("sample", "pts", "sonderwunsch"),
    "manthey": ("manthey",),
    "ruf": ("ruf",),
    "techart": ("techart",),
    "carbon_package": ("carbon package",),
    "lightweight_package": ("lightweight package",),
    "full_leather": ("leather",),
    "carbon_bucket_seats": ("carbon",),
}

# Whole words, as runs of a-z and 0-9 in folded text ("tüv" holds "v"), of which every match of a flag holds at least one: the
# rarest of each wording. They are looked up before the hints, among the few words that a text shares with all flags. Checked like the hints.
COUNTED_WORDS = "produced built made delivered examples cars number"
GENUINE_WORDS = "speedster classic dakar 911 t heritage"
RACING_WORDS = "racing winner 24 rburgring nurburgring spa mans adac fia championship podium"
CUP_WORDS = "cup cups club clubsport"
BESPOKE_WORDS = "bespoke exclusivity manufaktur sample pts sonderwunsch unique commission commissioned"
FLAG_WORDS = {
    name: tuple(words.split())
    for name, words in {
        "restoration_full": "frameoff bodyoff off restoration restored rebuilt rebuild refurbishment overhaul",
        "restoration_partial": "restoration refresh restored",
        "is_restomod": "backdate restomod modified custom",
        "has_docs": "documentation service records history documented",
        "is_matching_numbers": "matching",
        "is_mint": "condition collector sorted",
        "is_race_ready": f"rally race raceready prepped trackprepped bucket harness homologated suppression {RACING_WORDS} {CUP_WORDS}",
        "is_rare": f"rare edition {COUNTED_WORDS} 1 one rwb singer guntherwerks elfwerks {GENUINE_WORDS} {BESPOKE_WORDS}",
        "rsr_st_special": "rsr",
        "is_accident_free": "accident accidentfree crashed clean accidents undamaged",
        "has_upgrades": "kw x51 upgraded recaro slip limitedslip aftermarket performance turbo weissach",
        "first_owner": "owner hand keeper",
        "limited_production": COUNTED_WORDS,
        "racing_history": RACING_WORDS,
        "specialist_build": (
            "tuning manthey ruf singer gunther guntherwerks lanzante kremer motorsport techart gemballa rwb theon stephens tuthill"
            " emerson canepa"
        ),
        "bespoke_exclusive": BESPOKE_WORDS,
        "zero_running_hours": "hours",
        # one side of a match may end within a word, the other is whole
        "engine_transmission_rebuilt": "overhauled rebuilt rebuild restored gearbox transmission",
        "non_rebuilt": (
            "unrestored restored rebuilt overhauled notrestored notrebuilt notoverhauled neverrestored neverrebuilt neveroverhauled"
            " nonrestored nonrebuilt nonoverhauled"
        ),
        "needs_rebuild": "rebuild overhaul restoration recommissioning work",
        "body_only": "bodyonly shellonly only shell rolling roller",
        "missing_drivetrain": "engine gearbox transmission drivetrain motor",
        "project_car": "project parts restoration recommissioning",
        "not_ready_to_drive_text": "ready running drivable run start roadworthy mot tuv v",
        "accident_damage": "damage damaged salvage write",
        "cup_clubsport": CUP_WORDS,
        "heritage_special": GENUINE_WORDS,
        "weissach_package": "weissach",
        "pccb": "pccb",
        "ceramic_brakes": "ceramic",
        "bucket_seats": "bucket",
        "clubsport_package": "package",
        "front_axle_lift": "lift",
        "sport_chrono": "chrono",
        "manual_transmission_text": "manual",
        "paint_to_sample_text": "sample pts sonderwunsch",
        "manthey": "manthey",
        "ruf": "ruf",
        "techart": "techart",
        "carbon_package": "carbon",
        "lightweight_package": "lightweight",
        "full_leather": "leather",
        "carbon_bucket_seats": "carbon",
    }.items()
}

# ---- fixed values: points per set flag ------------------------------------------
FLAG_WEIGHTS = {
    "restoration_full": 2.0, "restoration_partial": 1.5, "is_restomod": 1.7, "has_docs": 0.7,
    "is_matching_numbers": 1.0, "is_mint": 0.5, "is_race_ready": 2.5, "is_rare": 2.5,
    "rsr_st_special": 2.0, "is_accident_free": 0.5, "has_upgrades": 2.3, "first_owner": 1.2,
    "limited_production": 2.0, "racing_history": 2.0, "specialist_build": 1.8,
    "bespoke_exclusive": 1.8, "zero_running_hours": 1.8, "engine_transmission_rebuilt": 1.2,
    "cup_clubsport": 1.5, "heritage_special": 2.0, "weissach_package": 1.8, "pccb": 1.8,
    "ceramic_brakes": 1.8, "bucket_seats": 1.4, "clubsport_package": 1.8, "front_axle_lift": 1.5,
    "sport_chrono": 1.4, "manual_transmission_text": 1.4, "paint_to_sample_text": 1.8,
    "manthey": 1.7, "ruf": 1.7, "techart": 1.7, "carbon_package": 1.5, "lightweight_package": 1.5,
    "full_leather": 1.0, "carbon_bucket_seats": 1.8,
}
PENALTY_WEIGHTS = {
    "non_rebuilt": -1.2, "needs_rebuild": -2.5, "body_only": -4.0, "missing_drivetrain": -4.0,
    "project_car": -2.5, "not_ready_to_drive_text": -2.0, "accident_damage": -2.5,
}
PENALTY_FLOOR = -12.0

# ---- fixed values: model categories, first matching rule wins --------------------
CATEGORY_RULES = (
    (r"\b(singer|guntherwerks|gunther werks|lanzante|carrera gt)\b", "Bespoke / Rarest Models"),
    (r"(gt2 rs|gt2rs|911 gt2 rs|gt2 rsr|911 gt2 rsr|rsr|sport classic|911 st\b|911 s[\s/]?t|60 (jahre|years|anniversary)|911 r\b|le mans centenaire edition|991 club coup[eé]|club coup[eé])", "GT2RS and RARE Models"),
    (r"\b(gt3 rs|gt3rs|911 gt3 rs|ruf|dakar|gt2 clubsport)\b", "GT3RS"),
    (r"\b(964 carrera rs|993 carrera rs|carrera rs\b|911 carrera rs\b|rs america|911 carrera 2\.7|911 carrera 2,7|911 carrera 2\.7 rs|911 carrera 2\.7 mfi|flachbau|gt4 rs|gt4rs|leichtbau)\b", "RS Model"),
    (r"\b(gt3\b(?! rs)|gt2\b(?! rs)|911 gt3\b(?! rs)|911 gt2\b(?! rs)|cup|gt4|911 carrera 3\.2 clubsport)\b", "GT4 / GT3 / GT2"),
    (r"\b(speedster|clubsport|heritage|backdate|restomod|modified|exclusive manufaktur)\b", "Special / Backdate"),
    (r"\b(turbo s|turbo|930)\b", "Turbo S / Turbo"),
    (r"\b(gts)\b", "GTS"),
    (r"\b(911\s+s\b|911\s+sc\b|carrera 3\.0|carrera 3,0|carrera 3\.2|carrera 3,2|911 sc|super carrera|carrera s|carrera 4s)\b", "Carrera 3.0/3.2 / S / SC"),
    (r"\b(boxster|cayman|718|981|982|987)\b", "718"),
    (r"\b(912\b|911\b|911 t\b|911 l\b|911 e\b|911 targa\b|carrera\b|carrera 2\b|cabriolet|targa|coupe|convertible)\b", "Base Carrera / Targa / 912"),
)
CATEGORY_DEFAULT = "Other"
CATEGORY_ORDER = (
    "Base Carrera / Targa / 912", "Carrera 3.0/3.2 / S / SC", "GTS", "Turbo S / Turbo",
    "GT4 / GT3 / GT2", "Special / Backdate", "RS Model", "GT3RS", "GT2RS and RARE Models",
    "Bespoke / Rarest Models", "718", "Other",
)

# ---- fixed values: the older cascade over the lower-cased model ------------------
# The capital in rule 1 never matches lower-cased text; kept as it was.
LEGACY_CATEGORY_RULES = (
    (r"\b(singer|guntherwerks|gunther werks|Lanzante)\b", "Bespoke / Rarest Models"),
    (r"(gt2 rs|rsr|gt2 rsr|911 gt2 rs|sport classic|911 st\b|911 s[\s\/]?t|60 (jahre|years|anniversary)|911 r\b|le mans centenaire edition|991 club coupé|club coupé)", "GT2RS and RARE Models"),
    (r"\b(gt3 rs|gt3rs|911 gt3 rs|ruf|dakar|gt2 clubsport)\b", "GT3RS"),
    (r"\b(964 carrera rs|993 carrera rs|carrera rs\b|911 carrera rs\b|rs america|911 carrera 2\.7|911 carrera 2,7|911 carrera 2\.7 rs|911 carrera 2\.7 mfi|flachbau|gt4 rs|gt4rs|leichtbau)\b", "RS Model"),
    (r"\b(gt3\b(?! rs)|gt2\b(?! rs)|911 gt3\b(?! rs)|911 gt2\b(?! rs)|cup|gt4|911 carrera 3\.2 clubsport)\b", "GT4 / GT3 / GT2"),
    (r"\b(speedster|clubsport|heritage|backdate|restomod|modified|exclusive manufaktur)\b", "Special / Backdate"),
    (r"\b(turbo s\b|911 turbo s\b|turbo\b(?! rs|gt2|cup)|964 turbo|993 turbo|930 turbo|911 turbo 3\.3|911 turbo 3\.0|911 turbo|turbo wls|911 turbo cabriolet)\b", "Turbo S / Turbo"),
    (r"\b(gts|exclusive edition)\b", "GTS"),
    (r"\b(911 carrera 3\.0|carrera 3\.0|carrera 3\.2|911 carrera 3\.2|911 sc\b|911 s\b|carrera s\b|carrera 4s\b|993 carrera s\b|993 carrera 4s)\b", "Carrera 3.0/3.2 / S / SC"),
    (r"\b(912\b|911\b|911 t\b|911 l\b|911 e\b|911 targa\b|carrera\b|carrera 2\b|cabriolet|targa|coupe|convertible)\b", "Base Carrera / Targa / 912"),
)
LEGACY_CATEGORY_DEFAULT = "GTS"
LEGACY_CATEGORY_ORDER = (
    "Bespoke / Rarest Models", "GT2RS and RARE Models", "GT3RS", "RS Model", "GT4 / GT3 / GT2",
    "Special / Backdate", "Turbo S / Turbo", "GTS", "Carrera 3.0/3.2 / S / SC",
    "Base Carrera / Targa / 912",
)

# ---- fixed values: the older keyword flags ---------------------------------------
# Kept as they were: an empty last alternative in has_docs, and two pairs of
# alternatives run together ("engine overhaulcategory 1", "production number \d+rwb").
LEGACY_TEXT_FLAGS = {
    "restoration_full": r"\b(frame[- ]?off|body[- ]?off|complete restoration|fully restored|fully rebuilt|nut and bolt (restoration|rebuild)|completely restored|full restioration|ground[- ]?up restoration|restored to (original|factory) specification|mechanically restored|interior refurbishment|engine overhaulcategory 1)\b",
    "restoration_partial": r"\b(partial restoration|cosmetic refresh|lightly restored|restored in parts|category 2)\b",
    "is_restomod": r"\b(backdate|restomod|modified|custom (build|interior|paint|exhaust|engine|body))\b",
    "has_docs": r"\b(full (documentation|service history|records|history)|extensive records|well documented|fully documented|)\b",
    "is_matching_numbers": r"\b(matching numbers|numbers matching|matching drivetrain)\b",
    "is_mint": r"\b(mint condition|collector quality|fully sorted|excellent condition|top condition|showroom condition)\b",
    "is_race_ready": r"\b(rally ready|race[- ]?ready|track[- ]?prepped|bucket seats|racing harness|homologated|fire suppression system)\b",
    "is_rare": r"\b(rare\b|special edition|limited edition|1 of (\d+|one)|unique example|only \d+ produced|production number \d+rwb|singer|guntherwerks|elfwerks)\b",
    "is_accident_free": r"\b(accident[- ]?free|never crashed|clean title|no accidents|undamaged)\b",
    "has_upgrades": r"\b(KW suspension|x51|upgraded brakes|recaro|limited[- ]?slip|aftermarket (exhaust|turbo|suspension|intake|wheels)|performance parts|turbo upgrade|weissach package)\b",
    "first_owner": r"\b(first owner|one owner|single owner|original owner|first hand|single registered keeper)\b",
}
LEGACY_FLAG_WEIGHTS = {
    "restoration_full": 2.0, "restoration_partial": 1.5, "is_restomod": 1.7, "has_docs": 0.7,
    "is_matching_numbers": 1.0, "is_mint": 0.5, "is_race_ready": 2.5, "is_rare": 2.5,
    "is_accident_free": 0.5, "has_upgrades": 2.3, "first_owner": 1.2,
}
