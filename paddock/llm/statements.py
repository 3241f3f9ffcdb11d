"""DuckDB statements of queries, written apart from the operators: direct counts and sums, no increments and no bounds."""

from __future__ import annotations

from paddock.llm import collocations, secret_scan


def collocations_statement() -> str:
    """All phrases of up to four words, all cuts, all longer phrases."""
    return f"""with recursive p as (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) as piece from documents),
  w as (select lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') as ws from p),
  g as (select lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i : i + k - 1], ' '))) as phrase
    from w, (values (1), (2), (3), (4)) as sizes(k)),
  f as (select lang, k, phrase, count(*) as a from g group by all),
  totals as (select lang, sum(a)::bigint as n from f where k = 1 group by 1),
  c as (select lang, k, phrase, a, string_split(phrase, ' ') as ws from f where k >= 2 and a >= {collocations.LEAST}),
  parts as (select c.lang, c.phrase, c.k, c.a, i, array_to_string(ws[1 : i], ' ') as x, array_to_string(ws[i + 1 : c.k], ' ') as y
    from c, (values (1), (2), (3)) as cuts(i) where i < c.k),
  scored as (select parts.lang, parts.phrase, parts.a, i, fx.a as l, fy.a as r, (({collocations.SCALE}::hugeint * parts.a) // (fx.a + fy.a))::bigint as score
    from parts join f fx on fx.lang = parts.lang and fx.phrase = x join f fy on fy.lang = parts.lang and fy.phrase = y),
  worst as (select * from scored qualify row_number() over (partition by lang, phrase order by score, i) = 1),
  inner_ as (select lang, a, unnest(list_transform(range(1, k), lambda i: array_to_string(ws[i : i + 1], ' ')) ||
    case when k = 4 then [array_to_string(ws[1 : 3], ' '), array_to_string(ws[2 : 4], ' ')] else [] end) as phrase from c where k >= 3),
  most as (select lang, phrase, max(a) as most from inner_ group by all),
  kept as (select worst.* from worst left join most using (lang, phrase) where most is null or 100::hugeint * most < {collocations.DROP_PERCENT}::hugeint * a)
  select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
    from kept join totals using (lang) qualify rank <= {collocations.TOP}"""


# Patterns without look-around and back-references, which DuckDB's engine lacks (fixed values).
NAME_RUN = "^([A-Z]?[a-z]+|[A-Z]+|[0-9]{1,8})$"


def secret_scan_statement() -> str:
    """Every find by its place among the texts between finds; every window's entropy from its distinct characters."""
    kinds = [("assign", secret_scan.ASSIGN), ("access", secret_scan.ACCESS), ("hex", secret_scan.HEX)]
    kinds += [(c.kind, f"[{c.characters}]{{{secret_scan.WINDOW},}}") for c in secret_scan.CLASSES]
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    finds = " union all ".join(
        f"select row_id, t, {rank} as kind_rank, '{kind}' as kind, regexp_extract_all(t, {quoted(p)}) as found, regexp_split_to_array(t, {quoted(p)}) as gaps from d"
        for rank, (kind, p) in enumerate(kinds)
    )
    allowed = " or ".join(f"regexp_matches(f, {quoted(p)})" for p in secret_scan.ALLOWED if chr(92) + "1" not in p)
    needs = " or ".join(
        f"(kind = '{c.kind}' and " + " and ".join(f"regexp_matches(f, '{n}')" for n in c.needs) + ")" for c in secret_scan.CLASSES
    )
    limits = " ".join(f"when '{c.kind}' then {c.bits}::double" for c in secret_scan.CLASSES)
    window, unit = secret_scan.WINDOW, secret_scan.UNIT
    weights = "[" + ", ".join(f"round({c} * log2({max(c, 1)}) * {unit})::bigint" for c in range(1, window + 1)) + "]"
    return f"""with d as (select row_number() over () as row_id, doc_id, coalesce(text, '') as t from documents),
  finds as ({finds}),
  each_ as (select row_id, kind_rank, kind, found, gaps, unnest(range(1, len(found) + 1)) as i from finds),
  placed as (select row_id, kind_rank, kind, found[i] as f, gaps[i] as gap,
    (list_sum(list_transform(found[1 : i], lambda x: length(x))) + list_sum(list_transform(gaps[1 : i], lambda x: length(x))))::bigint as stop from each_),
  base as (select row_id, kind_rank, kind, stop - length(f) as start, stop from placed
    where kind_rank < 3 and (kind <> 'assign' or length(regexp_extract(f, {quoted(secret_scan.ASSIGN)}, 2)) >= {secret_scan.ASSIGN_VALUE})),
  candidates as (select row_number() over () as c_id, * from placed where kind_rank >= 3 and ({needs}) and not ({allowed})
    and not regexp_matches(gap, {quoted(secret_scan.ALLOWED_BEFORE)})
    and not list_bool_or(list_transform(range(1, length(f) - 6), lambda i: substring(f, i, 8) = repeat(substring(f, i, 1), 8)))
    and not coalesce(list_bool_and(list_transform(list_filter(regexp_split_to_array(f, '[^A-Za-z0-9]+'), lambda x: x <> ''), lambda x: regexp_matches(x, '{NAME_RUN}'))), true)),
  windows as (select *, unnest(range(1, length(f) - {window} + 2)) as w from candidates),
  summed as (select *, list_sum(list_transform(map_values(list_histogram(string_split(substring(f, w::int, {window}), ''))), lambda n: ({weights})[n::int])) as weight from windows),
  high as (select * from summed where weight <= floor(({window} * log2({window}) - {window} * case kind {limits} end) * {unit})),
  steps as (select *, case when w - lag(w) over (partition by c_id order by w) <= {window} then 0 else 1 end as new from high),
  runs as (select *, sum(new) over (partition by c_id order by w) as run from steps),
  spans as (select row_id, kind_rank, kind, stop - length(f) + min(w) - 1 as start, stop - length(f) + max(w) + {window} - 1 as stop
    from runs group by c_id, run, row_id, kind_rank, kind, stop, f),
  extra as (select * from spans s where not exists (select 1 from base b where b.row_id = s.row_id and b.start <= s.start and b.stop >= s.stop)),
  written as (select row_id, count(*) filter (where kind = 'assign') as n_assign, count(*) filter (where kind = 'access') as n_access, count(*) filter (where kind = 'hex') as n_hex,
    count(*) filter (where kind_rank >= 3) as n_entropy,
    coalesce(string_agg(kind || ':' || start || ':' || stop, ',' order by start, kind_rank) filter (where kind_rank < 3), '') as base,
    coalesce(string_agg(kind || ':' || start || ':' || stop, ',' order by start, kind_rank), '') as spans
    from (from base union all from extra) group by 1)
  select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex, coalesce(n_entropy, 0) as n_entropy,
    sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans from d left join written using (row_id)"""
