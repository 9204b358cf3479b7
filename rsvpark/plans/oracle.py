"""DuckDB SQL for the correctness oracle.

The same registrations view and the same string rules written in DuckDB's
dialect.  These are independent re-statements of the semantics (RE2 regexes,
list lambdas, window functions), used only to check the Spark plans.
"""

from __future__ import annotations

from rsvpark import constants as K

# Unicode whitespace class in RE2 (its \s is ASCII only).
WS = r"[\s\p{Z}\v\x{85}\x{1c}-\x{1f}]"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def blank(x: str) -> str:
    return f"coalesce({strip(x)} = '', true)"


def strip_translation(x: str) -> str:
    t = strip(f"regexp_replace({x}, '{WS}*（[^）]*）{WS}*$', '')")
    return f"(CASE WHEN {t} <> '' THEN {t} ELSE {x} END)"


def choice_picks(x: str) -> str:
    kept = f"list_filter(list_transform(string_split({x}, '|'), lambda p: {strip('p')}), lambda p: p <> '')"
    tr = f"list_transform({kept}, lambda p: {strip_translation('p')})"
    return f"list_filter({tr}, lambda v, i: list_position({tr}, v) = i)"


def raw_split(x: str) -> str:
    return f"(CASE WHEN contains({x}, '|') THEN string_split({x}, '|') ELSE regexp_split_to_array({x}, '[,;]') END)"


def multiselect(x: str) -> str:
    tr = f"list_transform({raw_split(x)}, lambda p: {strip_translation(strip('p'))})"
    return f"list_filter({tr}, lambda p: p <> '')"


def combo(x: str) -> str:
    return f"array_to_string(list_transform(string_split({x}, '|'), lambda p: {strip_translation(strip('p'))}), ' | ')"


def pct_even(n: str, d: str) -> str:
    return (f"CAST(coalesce(round_even(CAST({n} AS DOUBLE) / nullif(CAST({d} AS DOUBLE), 0) * 100, 0), 0)"
            f" AS INTEGER)")


def pct_half_up(n: str, d: str) -> str:
    return f"CAST(coalesce(floor(CAST({n} AS DOUBLE) / nullif(CAST({d} AS DOUBLE), 0) * 100 + 0.5), 0) AS INTEGER)"


def experienced(x: str) -> str:
    return "(" + " OR ".join(f"starts_with(lower({x}), {lit(p.lower())})" for p in K.EXPERIENCED_LABELS) + ")"


def filler(x: str) -> str:
    punct = K.FILLER_TRAILING_PUNCT.replace(".", r"\.").replace("?", r"\?").replace("!", r"\!")
    key = strip(f"regexp_replace(lower({strip(x)}), '[{punct}]+$', '')")
    return f"({key} IN ({', '.join(lit(v) for v in K.FILLER_ANSWERS)}))"


def shorten(x: str) -> str:
    words = f"regexp_split_to_array({strip(x)}, '{WS}+')"
    nw = f"(CASE WHEN {strip(x)} = '' THEN 0 ELSE len({words}) END)"
    capped = (f"(CASE WHEN {nw} <= {K.SHORTEN_MAX_WORDS} THEN {x} ELSE "
              f"array_to_string({words}[1:{K.SHORTEN_MAX_WORDS}], ' ') || {lit(K.ELLIPSIS)} END)")
    out = "CASE"
    for sep in K.SHORTEN_SEPARATORS:
        out += f" WHEN contains({x}, {lit(sep)}) THEN {strip(f'split_part({x}, {lit(sep)}, 1)')}"
    return out + f" ELSE {capped} END"


def money(total: str) -> str:
    return (f"CASE WHEN {total} = 0 THEN {lit(K.MONEY_FREE)} ELSE "
            f"'$' || CAST(CAST(round_even({total}, 0) AS DECIMAL(38,0)) AS VARCHAR) || {lit(K.MONEY_SUFFIX)} END")


def join_and(lst: str) -> str:
    return (f"CASE WHEN len({lst}) = 1 THEN {lst}[1] WHEN len({lst}) > 1 THEN "
            f"array_to_string({lst}[1:len({lst})-1], ', ') || ' and ' || {lst}[len({lst})] END")


def palette(pos0: str, pal: list[str], default: str | None = None) -> str:
    arr = "[" + ", ".join(lit(p) for p in pal) + "]"
    if default is None:
        return f"{arr}[({pos0}) % {len(pal)} + 1]"
    return f"CASE WHEN ({pos0}) < {len(pal)} THEN {arr}[({pos0}) + 1] ELSE {lit(default)} END"


def html_escape(x: str) -> str:
    out = x
    for src, dst in [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")]:
        out = f"replace({out}, {lit(src)}, {lit(dst)})"
    return out


# Registrations view over the test tables (FIXTURES.md section 3, whole texts).
REG_CTE = """
picks0 AS (
  SELECT l.l_orderkey, string_agg(DISTINCT p.p_type, ' | ' ORDER BY p.p_type) AS p0
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY l.l_orderkey),
picks AS (
  SELECT l_orderkey, CASE WHEN l_orderkey % 3 = 0 THEN replace(p0, ' | ', ', ') ELSE p0 END AS picks FROM picks0),
reg AS (
  SELECT o.o_orderstatus AS event_id, o.o_orderkey AS row_id, CAST(o.o_orderdate AS TIMESTAMP) AS order_ts,
    CASE o.o_orderpriority WHEN '5-LOW' THEN 'Not Attending' WHEN '2-HIGH' THEN 'Attending '
         ELSE 'Attending' END AS attendee_status,
    c.c_mktsegment AS ticket_type,
    CAST(o.o_totalprice AS DECIMAL(18,2)) AS total_paid,
    k.picks AS role,
    CASE o.o_orderpriority WHEN '1-URGENT' THEN 'Expert' WHEN '2-HIGH' THEN 'Regular user — I use it for work'
         WHEN '3-MEDIUM' THEN ' intermediate ' WHEN '4-NOT SPECIFIED' THEN NULL
         ELSE 'Beginner - just curious' END AS experience,
    CASE o.o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN ' | '
         ELSE replace(k.picks, 'PROMO', 'PROMO （促销）') || ' | ECONOMY' END AS session_goals,
    coalesce(d.text, CASE o.o_orderkey % 10 WHEN 1 THEN 'no' WHEN 2 THEN ' N/A ' WHEN 3 THEN '无'
         WHEN 4 THEN '  ' END) AS speaker_q,
    CASE WHEN o.o_orderkey % 5 = 0 THEN NULL ELSE k.picks END AS future_topics
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN picks k ON k.l_orderkey = o.o_orderkey
  LEFT JOIN documents d ON d.doc_id = o.o_orderkey)
"""


def with_reg(*ctes: str) -> str:
    """``WITH`` clause holding the registrations view plus extra CTEs."""
    parts = [REG_CTE.strip()] + [c.strip() for c in ctes]
    return "WITH " + ",\n".join(parts) + "\n"


def label_counts_sql(name: str, src: str, arr: str, label: str = "label") -> str:
    """CTE ``name``: counts of array elements per (event, label) with the
    first-appearance position, ranked (count desc, first row, first pos)."""
    return f"""
{name}_x AS (
  SELECT event_id, row_id, {arr} AS arr FROM {src}),
{name}_e AS (
  SELECT event_id, row_id, unnest(arr) AS {label}, unnest(generate_series(1, len(arr))) AS i, arr
  FROM {name}_x),
{name}_a AS (
  SELECT event_id, {label}, count(*) AS n, min(row_id) AS fr,
         arg_min(list_position(arr, {label}), row_id) AS fp
  FROM {name}_e GROUP BY event_id, {label}),
{name} AS (
  SELECT event_id, {label}, CAST(n AS BIGINT) AS n,
         CAST(row_number() OVER (PARTITION BY event_id ORDER BY n DESC, fr, fp) AS BIGINT) AS pos
  FROM {name}_a)"""


def value_counts_sql(name: str, src: str, value: str, label: str = "label") -> str:
    return f"""
{name}_a AS (
  SELECT event_id, {value} AS {label}, count(*) AS n, min(row_id) AS fr
  FROM {src} WHERE {value} IS NOT NULL GROUP BY ALL),
{name} AS (
  SELECT event_id, {label}, CAST(n AS BIGINT) AS n,
         CAST(row_number() OVER (PARTITION BY event_id ORDER BY n DESC, fr) AS BIGINT) AS pos
  FROM {name}_a)"""
