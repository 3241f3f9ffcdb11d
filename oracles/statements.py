"""One DuckDB statement per registered query."""

from __future__ import annotations

import math

from oracles import blocks as b
from paddock.operators import features, rules
from paddock.operators.combine import COMPLETENESS_BONUS
from paddock.operators.hygiene import PATH_PATTERNS
from paddock.plans import fixtures as fx
from paddock.plans import queries as q
from paddock.sources.rates import STATIC_RATES

K = "ingest_order, URL"
STAMP = "strftime(Scraped_At, '%Y-%m-%d %H:%M:%S') as Scraped_At"
# The numeric columns of linear models.
LINEAR_COLUMNS = (
    "Mileage_km", "Year of construction", "listing_score", "owners_known", "is_fully_restored",
    "Paint-to-Sample (PTS)", "log_mileage", "Mileage_sq", "price_inflation_factor",
)
RAW, CRAWLS, SILVER, GOLD, PRED, REG = b.RAW, b.CRAWLS, b.SILVER, b.GOLD, b.PRED, b.REGISTRY

HASH = "md5(concat_ws(chr(31), coalesce({0}.Description, ''), coalesce({0}.Mileage, ''), coalesce({0}.Price, ''), '', coalesce({0}.Title, '')))"


def _changes() -> str:
    parts = [
        f"case when coalesce(o.{f}, '') <> coalesce(n.{f}, '') then '{f}: ''' || coalesce(o.{f}, '') || ''' → ''' || coalesce(n.{f}, '') || '''' end"
        for f in ("Title", "Price", "Mileage", "Description")
    ]
    return f"nullif(concat_ws('; ', {', '.join(parts)}), '')"


# one row per URL on both sides, and what happens to it
PAIRS = f"""{CRAWLS},
o as (select * from prev qualify row_number() over (partition by URL order by ingest_order desc) = 1),
n as (select * from nxt where URL is not null qualify row_number() over (partition by URL order by ingest_order desc) = 1),
pairs as (select o, n, case when o.URL is null then 'insert' when n.URL is null then 'keep'
    when coalesce(n.Error, '') <> '' then 'keep' when {HASH.format('o')} = {HASH.format('n')} then 'keep'
    when coalesce(o.Title, '') = coalesce(n.Title, '') and coalesce(o.Mileage, '') = coalesce(n.Mileage, '')
      and coalesce(o.Description, '') = coalesce(n.Description, '') and coalesce(o.Price, '') <> coalesce(n.Price, '')
      and lower(trim(coalesce(n.Price, ''))) in ('reserved', '', 'n/a') then 'keep'
    else 'replace' end as action,
    {HASH.format('o')} as old_hash, {HASH.format('n')} as new_hash, {_changes()} as changes
  from o full join n on o.URL = n.URL)"""


def _upsert_columns() -> str:
    columns = []
    for c in [*fx.LISTING_COLUMNS, "Error", "Extra"]:
        name = b.ident(c)
        old = f"o.{name}" if c in fx.LISTING_COLUMNS else "null"
        value = f"case when action = 'keep' then {old} else n.{name} end"
        if c == "Scraped_At":
            value = f"strftime({value}, '%Y-%m-%d %H:%M:%S')"
        columns.append(f"{value} as {name}")
    return ", ".join(columns)


def _quantiles(column: str, digits: int) -> str:
    return ", ".join(
        f"round(quantile_cont({column}, {p}), {digits}) as p{int(p * 100)}" for p in (0.1, 0.5, 0.9)
    )


def _metrics(digits: int = 4) -> str:
    return (
        f"count(*) as n_rows, round(avg(err), {digits}) as mae_eur, round(median(err), {digits}) as median_ae_eur,"
        f" round(avg(pct), {digits}) as mape, round(avg((pct <= 0.10)::int), {digits}) as within_10pct,"
        f" round(avg((pct <= 0.15)::int), {digits}) as within_15pct"
    )


_DIGITS = {"inv_mileage": 9, "inv_Mileage_model_cat": 9}
_DOUBLES = (
    "listing_score", "log_mileage", "Mileage_sq", "inv_mileage", "Mileage_model_cat", "inv_Mileage_model_cat",
    "Mileage_sq_model_cat", "price_inflation_factor", "Mileage_km", "Year of construction", "log_price",
    "price", "mileage_value", "price_in_eur",
)


def _round(name: str, digits: int = 6) -> str:
    if name in q.EXACT:
        return f"{b.ident(name)}::double as {b.ident(name)}"
    return f"round({b.ident(name)}, {_DIGITS.get(name, digits)}) as {b.ident(name)}"


def _gold_row() -> str:
    replaced = ", ".join(_round(c) for c in _DOUBLES)
    return f"* replace ({replaced}, {STAMP}, ({b.CODE})::int as model_cat_ordered)"


def _frame_row() -> str:
    columns = []
    for c in [*features.NUMERIC_COLUMNS, *features.CATEGORICAL_COLUMNS]:
        if c == "Country":
            continue
        name = b.ident(c)
        if c in features.CATEGORICAL_COLUMNS:
            columns.append(f"coalesce({name}, 'Unknown') as {name}")
        elif c in q.EXACT:
            columns.append(f"({name})::double as {name}")
        else:
            columns.append(f"round(({name})::double, {_DIGITS.get(c, 6)}) as {name}")
    return f"URL, {', '.join(columns)}, round(price_in_eur, 6) as price_in_eur"


def _usage(linear: bool) -> str:
    rows = []
    numeric = [c for c in features.NUMERIC_COLUMNS]
    categorical = [c for c in features.CATEGORICAL_COLUMNS if c != "Country"]
    for c in numeric + categorical + ([] if linear else ["listing_text"]):
        role = "numeric" if c in numeric else "categorical" if c in categorical else "text"
        filled = f"count({b.ident(c)})" if role == "numeric" else "count(*)"
        if linear:
            used = int(c in categorical or c in LINEAR_COLUMNS)
            rows.append(f"select {b.text(c)} as feature, {used} as used_by_linear, {filled} as n_filled from gold")
        else:
            rows.append(f"select {b.text(c)} as feature, {b.text(role)} as role, {filled} as n_filled from gold")
    return f"with {GOLD.replace('gold as (', 'gold as materialized (')} " + " union all ".join(rows)


_SILVER_COLUMNS = (
    "ingest_order", "URL", "Title", "Model", "Series", "price_text", "Mileage", "Condition",
    "Paint-to-Sample (PTS)", "Matching numbers", "Number of vehicle owners", "Interior color",
    "Exterior color", "Ready to drive", "Drive", "Transmission", "Car location",
    "Year of construction", "Description", "Scraped_At", "price", "currency", "mileage_value",
    "mileage_unit", "Mileage_km", "owners_known", "is_fully_restored", "currency_known",
)
_SILVER_CATEGORICAL = (
    "URL", "Title", "Model", "Series", "price_text", "Mileage", "Condition", "Matching numbers",
    "Number of vehicle owners", "Interior color", "Exterior color", "Ready to drive", "Drive",
    "Transmission", "Car location", "Year of construction", "Description", "currency", "mileage_unit",
)


def _screen() -> str:
    rows = []
    for c in _SILVER_COLUMNS:
        level = "true" if c in _SILVER_CATEGORICAL else "false"
        rows.append(
            f"select {b.text(c)} as feature, {level} as is_level, count(*) as total, sum(n) filter (v is null) as nulls,"
            f" count(v) as n_distinct, sum(n) as rows, min(n) filter (v is not null) as least"
            f" from (select {b.ident(c)}::varchar as v, count(*) as n from silver group by 1)"
        )
    reasons = (
        "concat_ws(',', case when coalesce(nulls, 0) / rows > 0.4 then 'null_fraction_gt_0.4' end,"
        " case when n_distinct <= 1 then 'constant' end,"
        " case when is_level and n_distinct > 50 then 'cardinality_gt_50' end,"
        " case when is_level and least < 2 then 'min_frequency_lt_2' end)"
    )
    return f"""with {SILVER.replace('silver as (', 'silver as materialized (')}, counts as ({' union all '.join(rows)})
    select feature, 'feature' as role, {reasons} as reasons, ({reasons} = '')::int as selected from counts
    union all
    select 'price_in_eur', 'target', concat_ws(',', case when count(*) > count(price_in_eur) then 'target_has_nulls' end,
      case when count(*) filter (price_in_eur <= 0) > 0 then 'target_has_non_positive_values' end), 0 from silver"""


def _dq_report() -> str:
    raw_columns = list(fx.LISTING_COLUMNS)
    rows = ["select 'rows' as metric, 'bronze' as item, count(*)::double as value from raw"]
    rows += [f"select 'nulls', {b.text(c)}, count(*) - count({b.ident(c)}) from raw" for c in raw_columns]
    rows += ["select 'duplicates', 'URL', count(*) - count(distinct URL) from raw"]
    strings = len(raw_columns) - 2
    rows += [
        f"select 'types', 'string', {strings}", "select 'types', 'bigint', 1", "select 'types', 'timestamp', 1",
        f"select 'types', 'columns', {len(raw_columns)}",
    ]
    rows += ["select 'rows', 'silver', count(*) from silver"]
    for c in ("Model", "Series", "Mileage_km", "price_in_eur", "Year of construction"):
        rows.append(f"select 'filled_pct', {b.text(c)}, count({b.ident(c)}) * 100.0::double / count(*) from silver")
    for c in ("Mileage_km", "price_in_eur"):
        for name, f in (
            ("count", f"count({c})"), ("mean", f"avg({c})"), ("std", f"stddev_samp({c})"), ("min", f"min({c})"),
            ("max", f"max({c})"), ("25%", f"quantile_cont({c}, 0.25)"), ("50%", f"quantile_cont({c}, 0.5)"),
            ("75%", f"quantile_cont({c}, 0.75)"),
        ):
            rows.append(f"select 'describe {c}', '{name}', {f} from silver")
    for c in ("owners_known", "is_fully_restored", "Paint-to-Sample (PTS)"):
        rows.append(f"select {b.text('values ' + c)}, {b.ident(c)}::varchar, count(*) from silver group by {b.ident(c)}")
    return (
        f"with {SILVER.replace('silver as (', 'silver as materialized (')}, report as ({' union all '.join(rows)})"
        " select metric, item, round(value::double, 4) as value from report"
    )


def _dummies() -> str:
    columns = [
        "round(coalesce(try_cast(\"Year of construction\" as double), (select median(try_cast(\"Year of construction\" as double)) from sides where is_test = 0)), 6) as \"Year of construction\"",
        "round(coalesce(price_in_eur, (select median(price_in_eur) from sides where is_test = 0)), 6) as price_in_eur",
    ]
    levels = {
        "Series": ("964", "981", "982", "987", "992"), "Transmission": ("Automatic", "Manual"),
        "Car location": ("France", "Germany", "USA"), "Interior color": ("Black",),
    }
    for c, names in levels.items():
        columns += [f"({b.ident(c)} is not distinct from {b.text(v)})::int as {b.ident(c + '_' + v)}" for v in names]
        columns.append(f"({b.ident(c)} is null)::int as {b.ident(c + '_nan')}")
    return (
        f"with {SILVER}, sides as (select *, ({b.bucket('URL', 42, 4)} = 0)::int as is_test from silver)"
        f" select URL, {', '.join(columns)} from sides where is_test = 1"
    )


def _design() -> tuple[list[str], str]:
    numeric = {
        "Mileage_km": "Mileage_km", "Year of construction": 'try_cast("Year of construction" as double)',
        "owners_known": "owners_known::double", "is_fully_restored": "is_fully_restored::double",
        "Paint-to-Sample (PTS)": '"Paint-to-Sample (PTS)"::double',
    }
    columns = {c: f"coalesce({e}, (select median({e}) from silver))" for c, e in numeric.items()}
    for v in ("981", "982", "987", "992"):
        columns[f"Series_{v}"] = f"(Series is not distinct from '{v}')::int::double"
    columns["Transmission_Manual"] = "(Transmission is not distinct from 'Manual')::int::double"
    names = list(columns)
    matrix = ", ".join(f"{e} as {b.ident(c)}" for c, e in columns.items())
    return names, matrix


def _gram() -> str:
    names, matrix = _design()
    rows = [
        f"select {b.text(x)} as a, {b.text(y)} as b, round(sum({b.ident(x)} * {b.ident(y)}) / 1000000, 2) as value from matrix"
        for i, x in enumerate(names) for y in names[i:]
    ]
    return f"with {SILVER}, matrix as materialized (select {matrix} from silver) " + " union all ".join(rows)


# Columns of the collinearity check.
def _vif() -> str:
    """The inverse of the scaled product sums by Gauss-Jordan steps, one for each column."""
    names, matrix = _design()
    k = len(names)
    norm = ", ".join(f"sqrt(sum({b.ident(x)} * {b.ident(x)})) as n{i}" for i, x in enumerate(names))
    cells = " union all ".join(
        f"select {i} as i, {j} as j, sum({b.ident(x)} * {b.ident(y)} / n{i} / n{j}) as v from matrix, norms" for i, x in enumerate(names) for j, y in enumerate(names)
    )
    units = " union all ".join(f"select {i}, {k + j}, {int(i == j)}::double" for i in range(k) for j in range(k))
    labels = ", ".join(f"({i}, {b.text(x)})" for i, x in enumerate(names))
    return f"""with recursive {SILVER}, matrix as (select {matrix} from silver), norms as (select {norm} from matrix), start as ({cells} union all {units}),
      e as (select 0 as s, i, j, v from start
        union all select x.s + 1, x.i, x.j, case when x.i = x.s then r.v / p.v else x.v - c.v * r.v / p.v end
          from e x join e r on r.i = x.s and r.j = x.j and r.s = x.s join e c on c.i = x.i and c.j = x.s and c.s = x.s join e p on p.i = x.s and p.j = x.s and p.s = x.s where x.s < {k})
      select feature, round(v, 4) as vif from e join (values {labels}) t(place, feature) on i = place and j = {k} + i where s = {k}"""


def _corr() -> str:
    columns = {
        "price_in_eur": "price_in_eur", "log_price": "case when price_in_eur > 0 then ln(price_in_eur) end",
        "Mileage_km": "Mileage_km", "log_mileage": "ln(1 + Mileage_km)", "Mileage_sq": "Mileage_km * Mileage_km",
        "listing_score": "listing_score", "Year of construction": 'try_cast("Year of construction" as double)',
    }
    names = list(columns)
    matrix = ", ".join(f"{e} as {b.ident(c)}" for c, e in columns.items())
    rows = [
        f"select {b.text(x)} as a, {b.text(y)} as b, round(corr({b.ident(x)}, {b.ident(y)}), 6) as corr from matrix"
        for i, x in enumerate(names) for y in names[i + 1:]
    ]
    return (
        f"with {SILVER}, {b.flagged('silver')}, scored as (select *, {b.SCORE} as listing_score from flagged),"
        f" matrix as materialized (select {matrix} from scored) " + " union all ".join(rows)
    )


def _histogram() -> str:
    rows = []
    for c, n in (("price_in_eur", 50), ("Mileage_km", 50), ("listing_score", 30)):
        rows.append(
            f"select '{c}' as \"column\", least(floor(coalesce((v - lo) / nullif((hi - lo) / {n}, 0), 0)), {n - 1})::bigint as bin,"
            f" count(*) as n, round(min(lo) + bin * min((hi - lo) / {n}), 4) as bin_start"
            f" from (select {c} as v, min({c}) over () as lo, max({c}) over () as hi from scored) group by bin"
        )
    rows.append(
        "select * from (select 'top Model ' || Model, null::bigint, count(*) as n, null::double from scored where Model is not null group by Model order by n desc, Model limit 10)"
    )
    rows.append(
        "select 'year ' || \"Year of construction\", null::bigint, count(*), null::double from scored group by \"Year of construction\""
    )
    return (
        f"with {SILVER}, {b.flagged('silver')}, scored as materialized (select *, {b.SCORE} as listing_score from flagged"
        " where price_in_eur is not null) " + " union all ".join(rows)
    )


def _ablation(extra: str) -> str:
    return f"""{PRED}, scores as (
      select {b.bucket('listing_key', 7, 5)} + 42 as seed, model_name = 'ridge' as use_feature, round(avg(err), 4) as mae
      from pred where model_name <> 'catboost' group by 1, 2),
    deltas as (select seed, max(mae) filter (use_feature) as with_feature_mae, max(mae) filter (not use_feature) as without_feature_mae,
      without_feature_mae - with_feature_mae as delta_mae from scores group by seed),
    samples as (select delta_mae as v, row_number() over (order by seed) - 1 as position from deltas){extra}"""


def _bootstrap(seed: int = 42, iterations: int = 2000) -> str:
    return f""", draws as (select r.b, ('0x' || substr(md5('{seed}|' || r.b || '|' || s.position), 1, 8))::bigint % (select count(*) from samples) as pick
      from samples s, range({iterations}) r(b)),
    means as (select b, avg(v) as mean from draws join samples on pick = position group by b)"""


def _bootstrap_rows(seed: int = 42, iterations: int = 2000) -> str:
    share, limits = 0.0, []
    for k in range(13):
        share += math.exp(-1) / math.factorial(k)
        limits.append(int(2**32 * share))
    weights = [
        "case " + " ".join(f"when substr(h, {8 * i + 1}, 8) < '{t:08x}' then {k}" for k, t in enumerate(limits)) + " else 13 end" for i in range(4)
    ]
    return f"""with {PRED}, draws as (select model_name, err, g, md5('{seed}|' || g || '|' || listing_key) as h from pred, range({iterations // 4}) r(g)),
      weights as (select model_name, err, g, {", ".join(f"{w} as w{i}" for i, w in enumerate(weights))} from draws),
      sums as (select model_name, g, {", ".join(f"sum(w{i} * err) / sum(w{i}) as m{i}" for i in range(4))} from weights group by 1, 2),
      means as (select model_name, unnest([m0, m1, m2, m3]) as m from sums),
      bounds as (select model_name, quantile_cont(m, 0.025) as lo, quantile_cont(m, 0.975) as hi from means group by 1)
      select model_name, round(mean, 3) as mean, round(lo, 3) as ci_low, round(hi, 3) as ci_high
      from bounds join (select model_name, avg(err) as mean from pred group by 1) using (model_name)"""


def _paths() -> str:
    styles = ["C:\\Users\\ann\\x", "D:\\data\\AppData\\Local\\Temp", "\\\\NAS_home/share", "/users/ann", "/home/ann/x"]
    rows = [
        f"select doc_id, '{name}' as finding from docs where regexp_matches(text, {b.text('(?i)' + pattern)})"
        for name, pattern in PATH_PATTERNS.items()
    ]
    return (
        f"with docs as (select doc_id, case when doc_id % 25 < 5 then concat_ws(' ', text, ({b.listing(styles)})[doc_id % 5 + 1])"
        f" else text end as text from documents) " + " union all ".join(rows)
    )


def _numeric_prep() -> str:
    numbers = {
        "Mileage_km": "Mileage_km", "Year of construction": 'try_cast("Year of construction" as double)',
        "owners_known": "owners_known::double", "price_in_eur": "price_in_eur",
    }
    filled = ", ".join(f"coalesce({e}, (select median({e}) from silver)) as x{i}" for i, e in enumerate(numbers.values()))
    stats = ", ".join(f"avg(x{i}) as m{i}, stddev_pop(x{i}) as s{i}" for i in range(len(numbers)))
    scaled = ", ".join(
        f"round((x{i} - m{i}) / case when s{i} = 0 then 1.0::double else s{i} end, 6) as {b.ident(c + '_scaled')}"
        for i, c in enumerate(numbers)
    )
    return f"with {SILVER}, f as (select {K}, {filled} from silver), s as (select {stats} from f) select {K}, {scaled} from f, s"


_STATIC = ", ".join(f"('{c}', {r}::double)" for c, r in STATIC_RATES.items())

def _nodes(column: str) -> str:
    """Every markup of a list as its text nodes: entities read, each stripped, joined."""
    text = "n"
    for entity, character in (("&nbsp;", "\u00a0"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        text = f"replace({text}, '{entity}', '{character}')"
    stripped = f"regexp_replace({text}, '^[\\s\u00a0]+|[\\s\u00a0]+$', '', 'g')"
    return f"[array_to_string([{stripped} for n in string_split_regex(x, '(?s)<[^>]*>')], '') for x in {column}]"


STATEMENTS: dict[str, str] = {
    "src_read_formats": f"with {RAW} select f as format, count(*) as n_rows, sum(ingest_order)::bigint as key_sum, count(Price) as n_prices, sum(length(Description))::bigint as n_chars from raw, (values ('csv'), ('json'), ('parquet')) t(f) group by f",
    "latest_snapshot": f"with {RAW}, s as (select *, strftime(Scraped_At, '%Y%m%d') as run_ts from raw) select {K}, Title, run_ts from s where run_ts = (select max(run_ts) from s)",
    "fx_rate_table": f"""with {RAW}, {b.PRICED},
      cached as (select currency, Scraped_At as fetched_at, avg(price_value) / 100000 as units from priced where currency is not null and Scraped_At is not null group by 1, 2),
      fresh as (select currency, max_by(units, fetched_at) as units from cached where epoch(timestamp '{q.AS_OF}') - epoch(fetched_at) between 0 and 86399 group by 1),
      static(currency, rate) as (values {_STATIC}),
      cur as (select f.currency, case when f.currency = 'EUR' then 1.0::double when units <> 0 then 1.0::double / units else coalesce(s.rate, 1.0::double) end as rate from fresh f left join static s using (currency))
      select currency, round(rate, 6) as rate, 'cache' as source from cur
      union all select currency, round(rate, 6), 'static' from static where currency not in (select currency from cur)""",
    "pages_extract": r"""with bodies as (select page_id, regexp_replace(html, '(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->', '', 'g') as body from pages),
      parts as (select page_id, body, regexp_replace(regexp_extract(body, '(?is)<h1\b[^>]*>(.*?)</h1>', 1), '(?s)<[^>]*>', '', 'g') as h from bodies)
      select page_id, nullif(trim(replace(replace(replace(replace(replace(replace(h, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&')), '') as Title,
        len(regexp_extract_all(body, '(?is)<a\b[^>]*\bhref=["''][^"'']*["'']')) as n_links,
        len(regexp_extract_all(body, '(?is)<p\b[^>]*>')) - len(regexp_extract_all(body, '(?is)<p\b[^>]*class=["''][^"'']*\bsmall\b[^>]*>')) as n_paragraphs,
        len(regexp_extract_all(body, '(?is)<li\b[^>]*>')) as n_items
      from parts""",
    "pages_sections": rf"""with bodies as (select page_id, regexp_replace(html, '(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->', '<x>', 'g') as body from pages),
      parts as (select page_id, regexp_extract(body, '(?is)<article\b[^>]*>(.*?)</article>', 1) as article, regexp_extract(body, '(?is)<nav\b[^>]*>(.*?)</nav>', 1) as nav,
        regexp_extract(body, '(?is)<footer\b[^>]*>(.*?)</footer>', 1) as footer from bodies),
      cut as (select page_id, [regexp_replace(x, '(?is)</p>.*', '') for x in string_split_regex(article, '(?i)<p>')[2:]] as paragraphs,
        [regexp_replace(x, '(?is)</li>.*', '') for x in string_split_regex(nav, '(?i)<li>')[2:]] as items, [footer] as footer from parts),
      texts as (select page_id, {_nodes('paragraphs')} as paragraphs, {_nodes('items')} as items, {_nodes('footer')} as footer from cut)
      select page_id, len(paragraphs) as n_paragraphs, md5(array_to_string(paragraphs, chr(10))) as paragraphs_md5, len(items) as n_items,
        md5(array_to_string(items, chr(10))) as items_md5, md5(footer[1]) as footer_md5 from texts""",
    "new_listing_keys": f"with {CRAWLS} select distinct URL, case when URL in (select URL from prev) then 'existing' else 'new' end as status from nxt",
    "row_hash": f"with {RAW} select {K}, {HASH.format('raw')} as Data_Hash from raw",
    "field_changes": f"with {PAIRS} select o.URL as URL, changes from pairs where o.URL is not null and n.URL is not null",
    "upsert_listings": f"with {PAIRS} select {_upsert_columns()}, case when action = 'keep' then old_hash else new_hash end as Data_Hash, action from pairs",
    "upsert_typed": f"""with {PAIRS}, years as (select *, try_cast(o."Year of construction" as int) as old_year, try_cast(n."Year of construction" as int) as new_year from pairs)
      select case when action = 'keep' then o.ingest_order else n.ingest_order end as ingest_order, case when action = 'keep' then o.URL else n.URL end as URL,
        case when action = 'keep' then old_year else new_year end as "Year of construction", case when action <> 'keep' and new_year is null then n."Year of construction" end as uncast_year,
        case when action = 'keep' then old_hash else new_hash end as Data_Hash, action from years""",
    "typed_overwrite": f"""with {CRAWLS} select {K}, try_cast("Year of construction" as int) as "Year of construction", try_cast("Number of vehicle owners" as double) as "Number of vehicle owners",
      case when try_cast("Year of construction" as int) is null then "Year of construction" end as uncast_year, ("Year of construction" = 'unknown')::int as n_uncast from nxt""",
    "change_log": f"with {PAIRS} select n.URL as URL, coalesce(changes, 'hash-only update') as Changes, '{q.AS_OF}' as Date from pairs where action = 'replace'",
    "keep_last_by_key": f"""with {CRAWLS}, both_crawls as (select *, 1 as batch from nxt union all by name select *, 0 as batch from prev)
      select {K}, Title, Price, Error, Extra from both_crawls qualify row_number() over (partition by URL order by batch desc, ingest_order desc) = 1""",
    "refresh_descriptions": f"""with {CRAWLS}, n as (select URL, Description from nxt qualify row_number() over (partition by URL order by ingest_order desc) = 1)
      select p.ingest_order, p.URL, coalesce(n.Description, p.Description) as Description from prev p left join n on p.URL = n.URL""",
    "sanitize_nonfinite": f"""with {PRED} select listing_key, model_name, case when actual_price_eur <> 0 then round(predicted_price_eur / actual_price_eur, 6) end as ratio,
      case when actual_price_eur <> 0 and o_orderstatus <> 'P' then round(predicted_price_eur / actual_price_eur, 6) end as odd_ratio from pred""",
    "card_model_pick": f"with {PRED} select model_name, round(avg(err), 4) as mae_eur from pred where model_name in ('ridge', 'auto_ridge', 'median') group by 1 order by 2, 1 limit 1",
    "parse_price": f"with {RAW}, {b.PRICED} select {K}, price_value as price, currency from priced",
    "parse_price_legacy": rf"with {RAW} select {K}, try_cast(replace(nullif(regexp_extract(Price, '([A-Za-z]+)\s([0-9,]+)\s*$', 2), ''), ',', '') as double) as legacy_price, nullif(regexp_extract(Price, '([A-Za-z]+)\s([0-9,]+)\s*$', 1), '') as legacy_currency from raw",
    "dedupe_url": f"with {RAW} select {K}, Title, Price from raw qualify row_number() over (partition by URL order by ingest_order) = 1",
    "drop_shop_links": f"with {RAW} select {K} from raw where URL is null or URL not like '%{fx.SHOP_PREFIX}%'",
    "mileage_extract": f"with {RAW}, {b.MILES} select {K}, mv as mileage_value, mu as mileage_unit from miles",
    "mileage_impute": f"with {RAW}, {b.MILES} select {K}, coalesce(mv, '1') as mileage_value from miles where mv is not null or Condition ilike '%fully restored%'",
    "mileage_km": f"""with {RAW}, {b.MILES} select {K}, coalesce(mu, 'km') as mileage_unit, round(try_cast(replace(coalesce(mv, '1'), ',', '') as double) * case when mu = 'mi' then 1.60934::double else 1.0::double end, 6) as Mileage_km
      from miles where (mv is not null or Condition ilike '%fully restored%') and try_cast(replace(coalesce(mv, '1'), ',', '') as double) is not null""",
    "clean_condition": f"""with {RAW} select {K}, case when trim(coalesce(Condition, '')) = '' then 'Unknown' else Condition end as Condition,
      (lower(trim("Paint-to-Sample (PTS)")) = 'yes')::int as "Paint-to-Sample (PTS)", coalesce("Matching numbers", 'Unknown') as "Matching numbers",
      coalesce("Number of vehicle owners", 'Unknown') as "Number of vehicle owners" from raw""",
    "derived_flags": f"with {RAW} select {K}, (\"Number of vehicle owners\" is not null)::int as owners_known, coalesce(Condition ilike '%fully restored%', false)::int as is_fully_restored from raw",
    "standardize_series": f"with {RAW} select {K}, case Series when '982 (718 Boxster/Cayman)' then '982' when '987 (Boxster/Cayman)' then '987' when '981 (Boxster/Cayman)' then '981' else Series end as Series from raw",
    "price_in_eur": f"with {RAW}, {b.PRICED} select {K}, round({b.EUR}, 6) as price_in_eur, {b.KNOWN} as currency_known from priced",
    "silver_listings": f"with {SILVER} select * replace ({STAMP}, round(price, 6) as price, round(mileage_value, 6) as mileage_value, round(Mileage_km, 6) as Mileage_km, round(price_in_eur, 6) as price_in_eur) from silver",
    "legacy_filters": f"with {SILVER} select {K}, round(Mileage_km, 6) as Mileage_km, round(price_in_eur, 6) as price_in_eur from silver where Mileage_km < 900000 and price_in_eur > 15000 and price_in_eur < 700000",
    "legacy_usage": f"""with {SILVER} select {K}, {q.AS_OF_YEAR} - "Year of construction"::int as age, round_even(Mileage_km, 0)::bigint as mileage_rounded,
      round(round_even(Mileage_km, 0) / case when {q.AS_OF_YEAR} - "Year of construction"::int = 0 then 0.5::double else ({q.AS_OF_YEAR} - "Year of construction"::int)::double end, 6) as mileage_per_year from silver""",
    "legacy_ready_to_drive": f"""with {SILVER}, s as (select {K}, {q.AS_OF_YEAR} - "Year of construction"::int as age, case when trim(coalesce("Ready to drive", '')) = '' and coalesce("Ready to drive", '') = '' then 'no' else "Ready to drive" end as state from silver)
      select {K}, age, case when age < 30 and state in ('No', 'no') then 'yes' else state end as "Ready to drive" from s""",
    "dq_report": _dq_report(),
    "dq_thresholds": f"""with {SILVER}, stats as (select avg(price_in_eur) as pm, stddev_samp(price_in_eur) as ps, avg(Mileage_km) as km, stddev_samp(Mileage_km) as ks from silver)
      select {K}, concat_ws(',', case when price_in_eur < 5000 then 'price_below_min' end, case when price_in_eur > 5000000 then 'price_above_max' end,
        case when "Year of construction"::double not between 1950 and 2026 then 'year_out_of_range' end,
        case when abs(price_in_eur - pm) > 3 * ps then 'price_beyond_sigma' end, case when abs(Mileage_km - km) > 3 * ks then 'mileage_beyond_sigma' end) as violations
      from silver, stats""",
    "gold_listings": f"with {GOLD} select {_gold_row()} from gold",
    "outliers_linear": f"with {SILVER}, s as (select avg(price_in_eur) as m, stddev_samp(price_in_eur) as d from silver) select {K}, round(price_in_eur, 6) as price_in_eur from silver, s where price_in_eur between m - 1.5::double * d and m + 1.5::double * d",
    "outliers_log": f"with {SILVER}, s as (select avg(ln(price_in_eur)) as m, stddev_samp(ln(price_in_eur)) as d from silver where price_in_eur > 0) select {K}, round(price_in_eur, 6) as price_in_eur from silver, s where price_in_eur > 0 and ln(price_in_eur) between m - 1.5::double * d and m + 1.5::double * d",
    "log_features": f"with {SILVER} select {K}, round(ln(price_in_eur), 6) as log_price, round(ln(1 + Mileage_km), 6) as log_mileage, Mileage_km * Mileage_km as Mileage_sq from silver",
    "price_inflation": f"with {RAW} select {K}, round(coalesce(pow(1.02::double, (epoch_us((select max(Scraped_At) from raw)) - epoch_us(Scraped_At)) / 86400000000.0::double / 365.25::double), 1.0::double), 6) as price_inflation_factor from raw",
    "model_category": f"with {RAW} select {K}, Model, {b.category('Model')} as model_category from raw",
    "model_interactions": f"""with {SILVER}, c as (select *, {b.category('Model')} as model_category from silver)
      select {K}, ({b.CODE})::int as model_cat_ordered, round(1.0::double / (Mileage_km + 1), 9) as inv_mileage, Mileage_km * ({b.CODE}) as Mileage_model_cat,
        round(1.0::double / (Mileage_km + 1) * ({b.CODE}), 9) as inv_Mileage_model_cat, Mileage_km * Mileage_km * ({b.CODE}) as Mileage_sq_model_cat from c""",
    "model_category_legacy": f"with {RAW}, c as (select {K}, {b.legacy_category('Model')} as legacy_category from raw) select *, ({b.code('legacy_category', rules.LEGACY_CATEGORY_ORDER, -1)})::int as legacy_cat_ordered from c",
    "listing_text": f"with {RAW} select {K}, concat_ws(' ', coalesce(Title, ''), coalesce(Model, ''), coalesce(Description, '')) as listing_text from raw",
    "text_flags": f"with {RAW}, {b.flagged('raw')} select {K}, {', '.join(rules.TEXT_FLAGS)} from flagged",
    "text_flags_legacy": f"with {RAW}, f as (select {K}, {b.normal_text(chr(39) + chr(39) + ' || coalesce(Description, ' + chr(39) + chr(39) + ')')} as t from raw), g as (select {K}, "
    + ", ".join(f"regexp_matches(t, {b.text(p.lower())})::int as legacy_{n}" for n, p in rules.LEGACY_TEXT_FLAGS.items())
    + " from f) select *, round("
    + " + ".join(f"legacy_{n} * ({w}::double)" for n, w in rules.LEGACY_FLAG_WEIGHTS.items())
    + ", 6) as legacy_score from g",
    "score_components": f"with {SILVER} select {K}, {', '.join(f'({e})::int as {n}' for n, e in b.POINTS.items())} from silver",
    "listing_score": f"with {SILVER}, {b.flagged('silver')} select {K}, round({b.SCORE}, 6) as listing_score from flagged",
    "score_penalty": f"with {RAW}, {b.flagged('raw')} select {K}, round({b.PENALTY}, 6) as penalty from flagged",
    "binary_flags": rf"""with {RAW} select {K}, (lower(trim("Ready to drive")) in ('yes', 'y', 'true', '1'))::int as state_yes, regexp_matches(lower(Drive), '\b(rear|rwd)\b')::int as "state_Rear drive",
      regexp_matches(lower(coalesce("Matching numbers", '')), '\b(yes|matching numbers|numbers matching|matching drivetrain)\b')::int as matching_yes from raw""",
    "prepare_features": f"""with {SILVER} select {K}, try_cast("Year of construction" as double) as "Year of construction", coalesce("Interior color", 'Unknown') as "Interior color",
      coalesce("Exterior color", 'Unknown') as "Exterior color", round(price_in_eur, 6) as price_in_eur from silver""",
    "normalize_keys": f"with {RAW} select ingest_order, URL from raw where ingest_order % 101 <> 0",
    "row_completeness": f"with {SILVER} select {K}, ("
    + " + ".join(f"({b.ident(c)} is not null)::int" for c in (*_SILVER_COLUMNS, "price_in_eur"))
    + " + "
    + " + ".join(f"{p} * ({b.ident(c)} is not null)::int" for c, p in COMPLETENESS_BONUS.items())
    + ")::double as completeness_score from silver",
    "union_gold": f"""with {CRAWLS}, u as (select *, 0 as source_order from prev union all by name select *, 1 as source_order from nxt)
      select source_order, count(*) as n_rows, count(Extra) as n_extra, count(Error) as n_error, sum(length(Description))::bigint as n_chars, sum(ingest_order)::bigint as key_sum from u group by 1""",
    "combine_gold": f"""with {CRAWLS}, u as (select *, 0 as side from prev union all by name select *, 1 as side from nxt where ingest_order % 101 <> 0)
      select {K}, Title, Price, Error, Extra from u qualify row_number() over (partition by URL order by """
    + " + ".join(f"({b.ident(c)} is not null)::int" for c in (*[c for c in fx.LISTING_COLUMNS if c != "ingest_order"], "Error", "Extra"))
    + " + 2 * (Description is not null)::int + (Scraped_At is not null)::int desc, Scraped_At desc nulls last, side, ingest_order) = 1",
    "predictions_long": f"with {PRED} select listing_key, model_name, actual_price_eur, predicted_price_eur, actual_price_eur - predicted_price_eur as residual_eur from pred",
    "select_columns": _usage(linear=False),
    "feature_frame": f"with {GOLD} select {_frame_row()} from gold",
    "feature_screen": _screen(),
    "linear_columns": _usage(linear=True),
    "aligned_dummies": _dummies(),
    "vif_gram": _gram(),
    "vif": _vif(),
    "corr_matrix": _corr(),
    "regression_metrics": f"with {PRED} select model_name, {_metrics()} from pred group by 1",
    "segment_metrics": f"with {PRED} select 'o_orderstatus' as segment_column, o_orderstatus as segment_value, {_metrics()} from pred group by 2 union all select 'o_orderpriority', o_orderpriority, {_metrics()} from pred group by 2",
    "residuals": f"with {PRED} select listing_key, model_name, actual_price_eur - predicted_price_eur as residual_eur from pred",
    "rmse_r2": f"""with {PRED}, e as (select *, actual_price_eur as a, predicted_price_eur as p, ln(greatest(actual_price_eur, 1)) as la, ln(greatest(predicted_price_eur, 1)) as lp,
        ({b.bucket('listing_key', 42, 4)} = 0)::int as is_test from pred),
      s as (select model_name, is_test, 1 - sum((a - p) ** 2) / (var_pop(a) * count(*)) as r2 from e group by 1, 2),
      g as (select model_name, max(r2) filter (is_test = 0) as r2_train, max(r2) filter (is_test = 1) as r2_test from s group by 1)
      select e.model_name, count(*) as sample_size, round(sqrt(avg((a - p) ** 2)), 4) as rmse_eur, round(avg(abs(a - p)), 4) as mae_eur, round(1 - sum((a - p) ** 2) / (var_pop(a) * count(*)), 4) as r2,
        round(sqrt(avg((la - lp) ** 2)), 4) as rmse_log, round(avg(abs(la - lp)), 4) as mae_log, round(1 - sum((la - lp) ** 2) / (var_pop(la) * count(*)), 4) as r2_log,
        round(min(r2_train), 4) as r2_train, round(min(r2_test), 4) as r2_test, round(min(r2_train - r2_test), 4) as r2_gap, (min(r2_train - r2_test) > 0.1)::int as overfit
      from e join g using (model_name) group by 1""",
    "interval_coverage": f"with {PRED} select model_name, count(*) as n_rows, round(avg((actual_price_eur between pred_lower and pred_upper)::int), 6) as interval_coverage from pred group by 1",
    "residual_summary": f"""with {PRED}, r as (select model_name, actual_price_eur - predicted_price_eur as r from pred)
      select model_name, count(*) as n_rows, round(avg(r), 4) as mean, round(stddev_samp(r), 4) as std, round(min(r), 4) as min, round(max(r), 4) as max, round(median(r), 4) as median from r group by 1""",
    "watchlist": f"""with {PRED}, w as (select *, actual_price_eur - predicted_price_eur as residual, case when actual_price_eur < pred_lower then 'Underpriced' when actual_price_eur > pred_upper then 'Overpriced' end as label from pred),
      ranked as (select *, row_number() over (partition by label order by case when label = 'Underpriced' then residual else -residual end, listing_key, model_name) as rank from w where label is not null)
      select listing_key, model_name, label, rank::int as rank, residual as residual_eur, round(residual / predicted_price_eur, 6) as price_delta_pct from ranked where rank <= 10""",
    "bargains": f"""with {RAW}, {PRED} select listing_key, model_name, actual_price_eur, pred_lower, Title, Series, "Car location"
      from pred join raw on listing_key = ingest_order where actual_price_eur < predicted_price_eur and actual_price_eur < pred_lower and actual_price_eur < 90000""",
    "residual_outliers": f"""with {RAW}, {PRED} select listing_key, model_name, actual_price_eur - predicted_price_eur as residual_eur, Title, Series, "Car location"
      from pred join raw on listing_key = ingest_order where err > 1.5::double * (select stddev_pop(other.actual_price_eur - other.predicted_price_eur) from pred other where other.model_name = pred.model_name)""",
    "bootstrap_ci": f"""with {PRED}, months as (select strftime(o_orderdate, '%Y-%m') as month, round(avg(err), 4) as v from pred group by 1),
      samples as (select v, row_number() over (order by month) - 1 as position from months){_bootstrap()}
      select round(quantile_cont(mean, 0.025), 3) as ci_low, round(quantile_cont(mean, 0.975), 3) as ci_high from means""",
    "bootstrap_ci_rows": _bootstrap_rows(),
    "paired_ablation": f"with {_ablation(_bootstrap())} select seed, round(with_feature_mae, 3) as with_feature_mae, round(without_feature_mae, 3) as without_feature_mae, round(delta_mae, 3) as delta_mae, (select round(avg(delta_mae), 3) from deltas) as delta_mae_mean, (select round(quantile_cont(mean, 0.025), 3) from means) as ci_low, (select round(quantile_cont(mean, 0.975), 3) from means) as ci_high from deltas",
    "category_stats": f"""with {SILVER}, {b.flagged('silver')}, s as (select *, {b.category('Model')} as model_category, {b.SCORE} as listing_score from flagged where price_in_eur is not null)
      select model_category, count(*) as n, round(avg(price_in_eur), 2) as price_mean, round(median(price_in_eur), 2) as price_median, round(stddev_samp(price_in_eur), 2) as price_std,
        round(avg(Mileage_km), 2) as mileage_mean, round(avg(listing_score), 2) as score_mean from s group by 1""",
    "market_summary": f"""with {SILVER}, s as (select price_in_eur as p, unnest([{b.category('Model')}, '(all)']) as segment from silver where price_in_eur is not null)
      select segment, count(*) as n, round(avg(p), 4) as mean, round(stddev_samp(p), 4) as std, round(min(p), 4) as min, round(max(p), 4) as max, {_quantiles('p', 4)} from s group by 1""",
    "model_comparison": f"with {REG}, r as (select run_id, model_name, mae_eur, mape, row_number() over (partition by run_id order by mae_eur, model_name)::int as rank from metrics) select run_id, model_name, round(mae_eur, 6) as mae_eur, round(mape, 6) as mape, rank, (rank = 1)::int as is_best from r",
    "outlier_count": f"""with {SILVER}, p as (select ln(price_in_eur) as l from silver where price_in_eur > 0), s as (select avg(l) as m, stddev_samp(l) as d from p)
      select count(*) as n_prices, count(*) filter (l < m - 1.5::double * d or l > m + 1.5::double * d) as n_outliers, round(count(*) filter (l < m - 1.5::double * d or l > m + 1.5::double * d) / count(*), 6) as outlier_share from p, s""",
    "histogram": _histogram(),
    "leaderboard": f"with {PRED}, m as (select model_name, {_metrics()}, avg(err) as raw_mae from pred group by 1) select * exclude (raw_mae), rank() over (order by raw_mae)::int as rank from m",
    "sigma_interval": f"""with {PRED}, s as (select model_name, stddev_samp(ln(actual_price_eur) - ln(predicted_price_eur)) as d from pred where actual_price_eur > 0 group by 1)
      select listing_key, model_name, round(exp(ln(predicted_price_eur) - 1.645::double * d), 3) as pred_lower, round(exp(ln(predicted_price_eur) + 1.645::double * d), 3) as pred_upper from pred join s using (model_name)""",
    "registry_append": f"""with {REG}, stored as (select * from offered where mae_eur < 20 qualify row_number() over (partition by run_id, model_name order by insert_order) = 1),
      more as (select * from offered where mae_eur >= 10 and (run_id, model_name) not in (select (run_id, model_name) from stored) qualify row_number() over (partition by run_id, model_name order by insert_order) = 1)
      select run_id, model_name, round(mae_eur, 6) as mae_eur, round(median_ae, 6) as median_ae, round(mape, 6) as mape, round(within_10, 6) as within_10, round(within_15, 6) as within_15, (select max(id) + 1 from runs) as next_run_id
      from (select * from stored union all select * from more)""",
    "latest_run": f"""with {REG}, last as (select * from runs order by id desc limit 1)
      select id, created_at, output_dir, round(duration_sec, 6) as duration_sec,
        coalesce((select string_agg(model_name || '=' || round(mae_eur, 0)::bigint, ',' order by model_name) from metrics where run_id = id), '') as metrics,
        coalesce((select string_agg(model_name, ',' order by model_name) from skips where run_id = id), '') as skipped from last""",
    "run_history": f"with {REG} select id, created_at, random_state, round(duration_sec, 6) as duration_sec, git_commit, count(model_name) as model_count from runs left join metrics on run_id = id group by all",
    "best_run_summary": f"""with {REG}, c as (select run_id, count(*) as n from skips group by 1),
      ranked as (select m.*, r.* exclude (id), coalesce(n, 0) as skipped_count, row_number() over (partition by m.model_name order by mae_eur, created_at desc, id desc) as rn
        from metrics m join runs r on r.id = m.run_id left join c on c.run_id = r.id)
      select run_id, model_name, round(mae_eur, 6) as mae_eur, round(median_ae, 6) as median_ae, round(mape, 6) as mape, round(within_10, 6) as within_10, round(within_15, 6) as within_15,
        created_at, random_state, output_dir, round(duration_sec, 6) as duration_sec, git_commit, skipped_count from ranked where rn = 1""",
    "best_run_skips": f"""with {REG}, best as (select m.run_id from metrics m join runs r on r.id = m.run_id qualify row_number() over (partition by m.model_name order by mae_eur, created_at desc, id desc) = 1),
      chosen as (select run_id from best union select run_id from skips)
      select run_id, coalesce(string_agg(model_name || ':' || reason, ',' order by model_name), '') as skipped_models from chosen left join skips using (run_id) group by 1""",
    "run_fallback": f"""with {REG}, readable as (select output_dir, created_at from runs where output_dir is not null and git_commit <> '5-LOW'),
      last as (select output_dir from runs order by id desc limit 1),
      candidates as (select 0 as p, output_dir, 'registry' as origin from last where output_dir in (select output_dir from readable)
        union all select * from (select 1, output_dir, 'filesystem' from readable order by created_at desc, output_dir desc limit 1))
      select output_dir, origin from candidates order by p limit 1""",
    "dash_frame": f"with {SILVER} select {K}, strftime(Scraped_At, '%Y-%m-%d %H:%M:%S') as scraped, try_cast(\"Year of construction\" as double) as year, round(Mileage_km, 6) as km from silver",
    "dash_facets": f"""with {SILVER}, r as (select price_in_eur, Mileage_km as km, "Year of construction"::double as year, Model, Transmission from silver)
      select distinct 'Model' as facet, Model as value, null::bigint as low, null::bigint as high from r where Model is not null
      union all select distinct 'Transmission', Transmission, null, null from r where Transmission is not null
      union all select 'price_in_eur', null, trunc(min(price_in_eur))::bigint, trunc(max(price_in_eur))::bigint from r
      union all select 'km', null, trunc(min(km))::bigint, trunc(max(km))::bigint from r
      union all select 'year', null, trunc(min(year))::bigint, trunc(max(year))::bigint from r""",
    "dash_filter": f"""with {SILVER} select {K}, Title from silver where Transmission = 'Manual' and Series in ('982', '987', '981') and price_in_eur between 20000 and 400000
      and Mileage_km between 0 and 200000 and "Year of construction"::double between 1970 and 2020
      and contains(lower(concat_ws(' ', coalesce(Title, ''), coalesce(Model, ''), coalesce(Description, ''))), 'carrera')""",
    "dash_table": f"""with {SILVER} select Title, Model, "Year of construction"::double as year, round(Mileage_km, 6) as km, round(price_in_eur, 6) as price_in_eur, URL, Transmission from silver order by ingest_order limit 500""",
    "price_timeline": f"with {SILVER} select strftime(Scraped_At, '%Y-%m-%d %H:%M:%S') as scraped, round(price_in_eur, 6) as price_in_eur, Model, Title, URL from silver where Scraped_At is not null",
    "model_summary": f"""with {SILVER} select Model, count(price_in_eur) as n, round(avg(price_in_eur), 4) as price_mean, round(min(price_in_eur), 4) as price_min, round(max(price_in_eur), 4) as price_max,
      round(avg(Mileage_km), 4) as mileage_mean, round(min(Mileage_km), 4) as mileage_min, round(max(Mileage_km), 4) as mileage_max from silver where Model is not null group by 1 order by n desc, Model limit 200""",
    "row_at_offset": f"with {SILVER} select {K}, Title, price_text from silver order by ingest_order limit 1 offset 100",
    "path_leak_scan": _paths(),
    "holdout_split": f"with {SILVER} select {K}, ({b.bucket('URL', 42, 4)} = 0)::int as is_test from silver",
    "median_baseline": f"""with {SILVER}, sides as (select *, ({b.bucket('URL', 42, 4)} = 0)::int as is_test from silver where price_in_eur is not null)
      select {K}, round((select median(price_in_eur) from sides where is_test = 0), 6) as predicted_price_eur from sides where is_test = 1""",
    "numeric_prep": _numeric_prep(),
    "onehot": f"with {SILVER} " + " union all ".join(
        f"select {b.text(c + '=')} || coalesce({b.ident(c)}, 'missing') as level, count(*) as n from silver group by 1"
        for c in ("Series", "Transmission", "Drive", "Car location", "Interior color")
    ),
    "tfidf_weights": r"""with words as (select doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]{2,}') as w from documents),
      terms as (select doc_id, unnest(w) as term from words
        union all select doc_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) from words),
      counts as (select doc_id, term, count(*) as tf from terms group by 1, 2),
      vocabulary as (select term, count(*) as df, sum(tf) as total from counts group by 1 having count(*) >= 3 order by total desc, term limit 5000),
      weighted as (select doc_id, term, (1 + ln(tf)) * (ln((1 + (select count(*) from documents)) / (1 + df)) + 1) as w from counts join vocabulary using (term))
      select doc_id, term, round(w / sqrt(sum(w * w) over (partition by doc_id)), 6) as weight from weighted""",
    "log_target_guard": f"with {PRED} select count(*) as n_rows, count(*) filter (actual_price_eur <= 0) as n_non_positive from pred",
    "geo_mean_blend": f"""with {PRED}, wide as (select listing_key, max(predicted_price_eur) filter (model_name = 'ridge') as a, max(predicted_price_eur) filter (model_name = 'catboost') as b from pred group by 1)
      select listing_key, round(exp((ln(case when listing_key % 59 = 0 then 1.0::double else greatest(a, 1.0::double) end) + ln(greatest(b, 1.0::double))) / 2), 3) as blend from wide""",
}
