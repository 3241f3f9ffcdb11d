"""Common table expressions shared by the oracle statements."""

from __future__ import annotations

from paddock.operators import rules
from paddock.plans import fixtures as fx
from paddock.sources.rates import STATIC_RATES


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def listing(values) -> str:
    return "[" + ", ".join(text(v) for v in values) + "]"


def ident(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


BASE = f"""base as (
  select o_orderkey as k, o_totalprice, o_orderdate, o_orderstatus, o_orderpriority, text,
    ({listing(fx.MODELS)})[(o_orderkey % {len(fx.MODELS)}) + 1] as model,
    ({listing(fx.PHRASES)})[(o_orderkey % {len(fx.PHRASES)}) + 1] as phrase
  from orders left join documents on doc_id = o_orderkey)"""


def _columns(columns: dict[str, str]) -> str:
    return ", ".join(f"{e} as {ident(c)}" for c, e in columns.items())


RAW = f"{BASE}, raw as (select {_columns(fx.LISTING_COLUMNS)} from base)"
PREV = f"prev as (select {_columns(fx.LISTING_COLUMNS)} from base where o_orderpriority <> '1-URGENT')"
_NEXT = {
    **fx.LISTING_COLUMNS,
    "Price": f"case when k % 9 = 0 then 'Reserved' else {fx.LISTING_COLUMNS['Price']} end",
    "Description": f"case when k % 4 = 0 then 'Updated ' else '' end || {fx.LISTING_COLUMNS['Description']}",
    "Year of construction": f"case when k % 23 = 0 then 'unknown' else {fx.LISTING_COLUMNS['Year of construction']} end",
    "Error": "case when k % 83 = 0 then 'Status 500' end",
    "Extra": "o_orderpriority",
}
NEXT = f"nxt as (select {_columns(_NEXT)} from base where o_orderstatus <> 'F')"
CRAWLS = f"{BASE}, {PREV}, {NEXT}"

TEXT_OF = "regexp_replace(regexp_replace({0}, '^[\\s\\p{{Z}}]+', ''), '[\\s\\p{{Z}}]+$', '')"
PRICED = r"""priced as (
  select *, try_cast(replace(nullif(regexp_extract(Price, '([A-Z]{3})\s*([0-9.,]+)', 2), ''), ',', '') as double) as price_value,
    upper(nullif(regexp_extract(Price, '([A-Z]{3})\s*([0-9.,]+)', 1), '')) as currency
  from raw)"""
MILES = r"""miles as (
  select *, nullif(regexp_extract(Mileage, '([0-9,]+)\s*(km|mi)', 1), '') as mv,
    nullif(regexp_extract(Mileage, '([0-9,]+)\s*(km|mi)', 2), '') as mu
  from raw)"""

_RATES = {**STATIC_RATES, **fx.EXAMPLE_RATES}
RATE_CASE = (
    "case currency " + " ".join(f"when '{c}' then {r}::double" for c, r in _RATES.items()) + " end"
)
EUR = (
    "case when currency is null then null when currency = 'EUR' then price_value "
    f"else price_value * coalesce({RATE_CASE}, 1.0::double) end"
)
KNOWN = f"case when currency is not null then (({RATE_CASE}) is not null)::int end"

# Silver in one go: first row per URL, shop links out, cleaned, converted.
SILVER = rf"""{RAW}, {PRICED},
first_rows as (
  select * from priced where not coalesce(contains(URL, '{fx.SHOP_PREFIX}'), false)
  qualify row_number() over (partition by URL order by ingest_order) = 1),
with_miles as (
  select *, coalesce(nullif(regexp_extract(Mileage, '([0-9,]+)\s*(km|mi)', 1), ''),
      case when Condition ilike '%fully restored%' then '1' end) as mv,
    coalesce(nullif(regexp_extract(Mileage, '([0-9,]+)\s*(km|mi)', 2), ''), 'km') as mu
  from first_rows),
silver as (
  select ingest_order, URL, Title, Model,
    case when Series like '9__ (%' and Series like '%Cayman)' then left(Series, 3) else Series end as Series,
    Price as price_text, Mileage,
    case when trim(coalesce(Condition, '')) = '' then 'Unknown' else Condition end as Condition,
    coalesce((lower(trim("Paint-to-Sample (PTS)")) = 'yes'), false)::int as "Paint-to-Sample (PTS)",
    case when trim(coalesce("Matching numbers", '')) = '' then 'Unknown' else "Matching numbers" end as "Matching numbers",
    case when trim(coalesce("Number of vehicle owners", '')) = '' then 'Unknown' else "Number of vehicle owners" end as "Number of vehicle owners",
    "Interior color", "Exterior color", "Ready to drive", Drive, Transmission, "Car location",
    "Year of construction", Description, Scraped_At,
    price_value as price, currency,
    try_cast(replace(mv, ',', '') as double) * case when mu = 'mi' then 1.60934::double else 1.0::double end as mileage_value,
    mu as mileage_unit,
    mileage_value as Mileage_km,
    (trim(coalesce("Number of vehicle owners", '')) <> '' and lower(trim("Number of vehicle owners")) <> 'unknown')::int as owners_known,
    coalesce(Condition ilike '%fully restored%', false)::int as is_fully_restored,
    {EUR} as price_in_eur, {KNOWN} as currency_known
  from with_miles where try_cast(replace(mv, ',', '') as double) is not null)"""

# ---- keyword flags ---------------------------------------------------------------
# RE2 has no look-around and an ASCII \b: letters outside ASCII are folded to "q",
# other signs to "~", and guarded wording is cut out before matching.


def normal_text(expr: str) -> str:
    t = f"replace(replace(lower({expr}), 'nürburgring', 'nurburgring'), 'tüv', 'tuv')"
    t = rf"regexp_replace({t}, '[^\x00-\x7F\p{{L}}\p{{N}}\p{{M}}\p{{Z}}]', '~', 'g')"
    t = rf"regexp_replace({t}, '\p{{Z}}', ' ', 'g')"
    return rf"regexp_replace({t}, '[^\x00-\x7F]', 'q', 'g')"


_G = "(?:" + "|".join(rules.NOT_GENUINE) + ")"
_PARTS = (
    "(?:cover|covers?|trim|trims?|noise|rebuild|damage|issues?|problem|problems?|work|service|history|paperwork|records)"
)


def cut_not_genuine(terms: str) -> str:
    t = rf"regexp_replace(t, '({terms})([\s\-/,:()]*?{_G}\b)', '@\2', 'g')"
    return rf"regexp_replace({t}, '\b({_G})\s({terms})', '\1 @', 'g')"


_SPECIAL = r"(?:speedster|sport classic|dakar|911 st\b|s/t\b|heritage design)"
_RARE = r"(?:rare\b|special edition|limited edition|speedster|sport classic|dakar|911 st\b|s/t\b|heritage design)"
GUARDED = {
    "is_rare": (
        cut_not_genuine(_RARE),
        r"\b(?:rare\b|special edition|limited edition|1 of (?:\d+|one)|one of \d+|only \d+ (?:produced|built|made|delivered|examples|cars)|\d+ produced|production number \d+|number \d+ of \d+|rwb|singer|guntherwerks|elfwerks|speedster|sport classic|dakar|911 r\b|911 st\b|s/t\b|heritage design|bespoke|factory-approved exclusivity|exclusive manufaktur|paint to sample|pts|sonderwunsch|unique piece|unique example|special commission|commissioned)\b",
    ),
    "heritage_special": (
        cut_not_genuine(_SPECIAL),
        r"\b(?:speedster|sport classic|dakar|911 r\b|911 st\b|s/t\b|heritage design)\b",
    ),
    "rsr_st_special": (cut_not_genuine(r"rsr[\s\-/]+st\b"), r"\brsr[\s\-/]+st\b"),
    "missing_drivetrain": (
        rf"regexp_replace(t, '(engine|gearbox|transmission|drivetrain|motor|missing|absent|not included)\s+{_PARTS}\b', '@', 'g')",
        r"\bmissing\s+(?:the\s+)?(?:engine|gearbox|transmission|drivetrain|motor)\b|\b(?:engine|gearbox|transmission|drivetrain)\s+(?:missing|absent|not included)\b|\bwithout\s+(?:the\s+)?(?:engine|gearbox|transmission|drivetrain|motor)\b",
    ),
    "accident_damage": (
        r"regexp_replace(t, '(no\s|without\s|no known\s|without known\s)(accident damage|damaged car|salvage title|write[- ]off|crash damage|fire damage|flood damage)\b', '\1@', 'g')",
        r"\b(?:accident damage|damaged car|salvage title|write[- ]off|crash damage|fire damage|flood damage)\b",
    ),
    "needs_rebuild": (
        "t",
        r"\b(?:needs?|requires?|requiring|awaiting|due for)\s+(?:an?\s+)?(?:(?:engine|gearbox|transmission|mechanical)\s+)?(?:rebuild|overhaul|restoration|recommissioning|work)\b",
    ),
}


def flag_sql(name: str) -> str:
    subject, pattern = GUARDED.get(name, ("t", rules.TEXT_FLAGS[name].lower()))
    return f"regexp_matches({subject}, {text(pattern)})::int"


FLAG_COLUMNS = ", ".join(f"{flag_sql(name)} as {name}" for name in rules.TEXT_FLAGS)


def flagged(source: str, name: str = "flagged") -> str:
    """``source`` with listing text and the 43 flags."""
    joined = "concat_ws(' ', coalesce(Title, ''), coalesce(Model, ''), coalesce(Description, ''))"
    return (
        f"{name}_text as (select *, {joined} as listing_text from {source}),"
        f" {name}_norm as (select *, {normal_text('listing_text')} as t from {name}_text),"
        f" {name} as (select *, {FLAG_COLUMNS} from {name}_norm)"
    )


PENALTY = "greatest(" + " + ".join(f"{f} * ({w}::double)" for f, w in rules.PENALTY_WEIGHTS.items()) + ", -12.0::double)"
POINTS = {
    "points_matching": "case when lower(trim(coalesce(\"Matching numbers\", ''))) in ('yes', 'matching numbers', 'numbers matching', 'matching drivetrain') then 10 else 0 end",
    "points_owners": "case when \"Number of vehicle owners\" = 'Unknown' then 0 else 10 end",
    "points_interior": "case when \"Interior color\" is not null then 5 else 0 end",
    "points_exterior": "case when \"Exterior color\" is not null then 5 else 0 end",
    "points_paint": "\"Paint-to-Sample (PTS)\" * 15",
    "points_restored": "is_fully_restored * 20",
    "points_mileage": "case when Mileage_km < 50000 then 10 else 0 end",
}
SCORE = (
    "(" + " + ".join(POINTS.values()) + ")::double + "
    + " + ".join(f"{f} * ({w}::double)" for f, w in rules.FLAG_WEIGHTS.items())
    + f" + {PENALTY}"
)

# ---- categories ------------------------------------------------------------------


def category(model: str) -> str:
    """First matching rule; look-aheads replaced by cutting "gt3 rs" and "gt2 rs"."""
    branches = []
    for i, (pattern, label) in enumerate(rules.CATEGORY_RULES):
        subject = f"lower({model})"
        if i == 4:
            subject = f"regexp_replace({subject}, 'gt([23]) rs', '@', 'g')"
            pattern = pattern.replace("(?! rs)", "")
        branches.append(f"when regexp_matches({subject}, {text(pattern)}) then {text(label)}")
    return f"case when {model} is null then 'Other' " + " ".join(branches) + " else 'Other' end"


def legacy_category(model: str) -> str:
    branches = []
    for i, (pattern, label) in enumerate(rules.LEGACY_CATEGORY_RULES):
        subject = f"trim(lower({model}))"
        if i == 4:
            subject = f"regexp_replace({subject}, 'gt([23]) rs', '@', 'g')"
            pattern = pattern.replace("(?! rs)", "")
        condition = f"regexp_matches({subject}, {text(pattern)})"
        if i == 6:
            plain = pattern.replace(r"turbo\b(?! rs|gt2|cup)|", "")
            bare = rf"regexp_matches(regexp_replace({subject}, '\bturbo (rs)', '@', 'g'), '\bturbo\b')"
            condition = f"(regexp_matches({subject}, {text(plain)}) or {bare})"
        branches.append(f"when {condition} then {text(label)}")
    return f"case when {model} is null then 'GTS' " + " ".join(branches) + " else 'GTS' end"


def code(category_column: str, order: tuple[str, ...], unknown: int) -> str:
    return (
        f"case {category_column} " + " ".join(f"when {text(c)} then {i}" for i, c in enumerate(order)) + f" else {unknown} end"
    )


CODE = code("model_category", rules.CATEGORY_ORDER, len(rules.CATEGORY_ORDER) - 1)

# Gold after the log outlier filter; the newest scrape is taken from what is left.
GOLD = f"""{SILVER},
spread as (select avg(ln(price_in_eur)) as m, stddev_samp(ln(price_in_eur)) as s from silver where price_in_eur > 0),
kept as (select silver.* from silver, spread where price_in_eur > 0 and ln(price_in_eur) between m - 3.0::double * s and m + 3.0::double * s),
{flagged('kept')},
featured as (
  select *, ln(price_in_eur) as log_price, ln(1 + Mileage_km) as log_mileage, Mileage_km * Mileage_km as Mileage_sq,
    coalesce(pow(1.02::double, (epoch_us((select max(Scraped_At) from kept)) - epoch_us(Scraped_At)) / 86400000000.0::double / 365.25::double), 1.0::double) as price_inflation_factor,
    {category('Model')} as model_category, {SCORE} as listing_score
  from flagged),
gold as (
  select * exclude (t, "Interior color", "Exterior color", "Year of construction"),
    coalesce("Interior color", 'Unknown') as "Interior color", coalesce("Exterior color", 'Unknown') as "Exterior color",
    try_cast("Year of construction" as double) as "Year of construction",
    {CODE} as model_cat_ordered, 1.0::double / (Mileage_km + 1) as inv_mileage,
    Mileage_km * ({CODE}) as Mileage_model_cat, 1.0::double / (Mileage_km + 1) * ({CODE}) as inv_Mileage_model_cat,
    Mileage_sq * ({CODE}) as Mileage_sq_model_cat,
    (lower(trim(coalesce("Ready to drive", ''))) in ('yes', 'y', 'true', '1'))::int as state_yes,
    regexp_matches(lower(coalesce(Drive, '')), '\\b(rear|rwd)\\b')::int as "state_Rear drive",
    regexp_matches(lower(coalesce("Matching numbers", '')), '\\b(yes|matching numbers|numbers matching|matching drivetrain)\\b')::int as matching_yes
  from featured)"""

_PREDICTED = " union all ".join(
    f"select o_orderkey as listing_key, '{m}' as model_name,"
    " case when o_orderkey % 500 = 0 then 0.0::double else o_totalprice end as actual_price_eur,"
    f" o_totalprice * (0.85::double + 0.3::double * ((o_orderkey * {c}) % 101) / 100.0::double) as predicted_price_eur,"
    " o_orderstatus, o_orderpriority, o_orderdate from orders"
    for m, c in fx.PREDICTION_MODELS.items()
)
PRED = f"""predicted as ({_PREDICTED}),
pred as (select *, predicted_price_eur * 0.9::double as pred_lower, predicted_price_eur * 1.1::double as pred_upper,
  abs(actual_price_eur - predicted_price_eur) as err,
  case when actual_price_eur <> 0 then abs(actual_price_eur - predicted_price_eur) / abs(actual_price_eur)
    when actual_price_eur = predicted_price_eur then 0.0::double else 'inf'::double end as pct
  from predicted)"""

REGISTRY = """runs as (
  select o_orderkey as id, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as created_at, o_custkey as random_state,
    case when o_orderstatus <> 'P' then 'runs/' || o_orderkey end as output_dir, o_totalprice / 1000 as duration_sec,
    o_orderpriority as git_commit from orders),
offered as (
  select l_orderkey as run_id, 'm' || l_linenumber as model_name, round(l_extendedprice / 1000, 0) as mae_eur,
    round(l_extendedprice / 2000, 0) as median_ae, l_discount as mape, l_tax as within_10, l_tax * 2 as within_15,
    l_partkey * 1000000 + l_suppkey as insert_order from lineitem),
metrics as (select * exclude (insert_order) from offered
  qualify row_number() over (partition by run_id, model_name order by insert_order) = 1),
skips as (
  select user_id as run_id, event_type as model_name, 'skip ' || event_type as reason from events
  qualify row_number() over (partition by user_id, event_type order by event_id) = 1)"""


def bucket(key: str, seed: int, buckets: int) -> str:
    return f"(('0x' || substr(md5({key}::varchar || '|{seed}'), 1, 8))::bigint % {buckets})"
