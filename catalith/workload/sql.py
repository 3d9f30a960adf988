"""SQL text of the scalar functions, for the other engine's side of the check."""

from __future__ import annotations

from catalith.constants import (
    LEGAL_SUFFIXES,
    MATCH_DLC_TOKENS,
    MATCH_EDITION_TOKENS,
    PROVIDER_DLC_TOKENS,
    REPORT_EDITION_TOKENS,
    ROMAN_NUMERALS,
    Scale,
)
from catalith.functions.text import DROPPED_CHARS, SPACED_CHARS


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def words(items) -> str:
    return "[" + ", ".join(lit(i) for i in items) + "]"


def norm(x: str) -> str:
    s = f"' ' || translate(lower(coalesce({x}, '')), {lit(SPACED_CHARS + DROPPED_CHARS)}, '{' ' * len(SPACED_CHARS)}') || ' '"
    for i, r in enumerate(ROMAN_NUMERALS, 1):
        s = f"replace({s}, ' {r} ', ' {i} ')"
    return f"trim(regexp_replace({s}, '\\s+', ' ', 'g'))"


def tokens(n: str) -> str:
    return f"(CASE WHEN {n} = '' THEN []::VARCHAR[] ELSE string_split({n}, ' ') END)"


def token_sort(n: str) -> str:
    return f"array_to_string(list_sort({tokens(n)}), ' ')"


def except_(a: str, b: str) -> str:
    return f"list_distinct(list_filter({a}, lambda v: NOT list_contains({b}, v)))"


def overlap(a: str, b: str) -> str:
    return f"coalesce(list_has_any({a}, {b}), false)"


def lcs(a: str, b: str) -> str:
    """LCS length for texts whose first one has at most 60 characters."""
    full = f"((1::BIGINT << length({a})::INT) - 1)"
    masks = (
        f"list_transform(string_split({b}, ''), lambda ch: list_sum(list_transform(range(1, length({a}) + 1), "
        f"lambda i: CASE WHEN {a}[i] = ch THEN (1::BIGINT << (i - 1)::INT) ELSE 0 END))::BIGINT)"
    )
    v = f"list_reduce({masks}, lambda s, m: ((s + (s & m)) | (s & ~m)) & {full}, {full})"
    return f"(length({a}) - bit_count({v}))"


def fuzzy_cte(pairs: str) -> str:
    """CTEs ending in ``fuzzy(a, b, score)`` for the distinct normalised pairs of ``pairs`` (columns ``a``, ``b``).

    Good for pairs whose partial match, where allowed, is a plain substring.
    """
    ea, eb = except_("ta", "tb"), except_("tb", "ta")

    def harmless(e: str) -> str:
        years = f"len(list_filter({e}, lambda t: NOT regexp_full_match(t, '19\\d\\d|20\\d\\d|2100'))) = 0"
        editions = f"len(list_filter({e}, lambda t: NOT list_contains({words(MATCH_EDITION_TOKENS)}, t))) = 0"
        return f"(len({e}) > 0 AND ({years} OR {editions}))"

    return f"""fz0 AS (SELECT DISTINCT a, b FROM ({pairs})),
    fz1 AS (SELECT a, b, {tokens('a')} AS ta, {tokens('b')} AS tb, {token_sort('a')} AS sa, {token_sort('b')} AS sb FROM fz0),
    fz2 AS (SELECT *, {ea} AS ea, {eb} AS eb FROM fz1),
    fz3 AS (SELECT *, (len(eb) = 0 AND {harmless('ea')}) OR (len(ea) = 0 AND {harmless('eb')}) AS partial_ok,
        CASE WHEN sa = sb THEN 100.0 WHEN sa = '' OR sb = '' THEN 0.0 ELSE
        (1.0::DOUBLE - ((length(sa) + length(sb))::DOUBLE - 2 * {lcs('sa', 'sb')}) / (length(sa) + length(sb))::DOUBLE) * 100.0 END AS ts
        FROM fz2),
    fuzzy AS (SELECT a, b, CAST(floor(CASE WHEN partial_ok AND a <> '' AND b <> '' AND (contains(a, b) OR contains(b, a))
        THEN greatest(ts, 100.0) ELSE ts END) AS INT) AS score FROM fz3)"""


def series(n: str) -> str:
    """Series numbers of a normalised title for ranking."""
    return f"list_filter(list_distinct({tokens(n)}), lambda t: regexp_full_match(t, '[1-9]|[1-4]\\d|50'))"


def dlc(n: str, provider: bool = False) -> str:
    return overlap(tokens(n), words(PROVIDER_DLC_TOKENS if provider else MATCH_DLC_TOKENS))


def adjusted_cte(rows: str, year: bool = True) -> str:
    """CTEs ending in ``scored``: every (row, candidate) with its ranking facts.

    ``rows``: sub-select with ``row_id, name, year_hint, id, cand_name, cand_year`` and whatever else is carried.
    """
    delta = "abs(cand_year - year_hint)"
    points = f"""CASE WHEN year_hint IS NULL THEN 0 WHEN cand_year IS NULL THEN -8 WHEN {delta} = 0 THEN 10
        WHEN {delta} <= 1 THEN 6 WHEN {delta} <= 2 THEN 3 WHEN {delta} >= 15 THEN -14 WHEN {delta} >= 10 THEN -10
        WHEN {delta} >= 5 THEN -6 ELSE 0 END""" if year else "0"
    is_year = "regexp_full_match(t, '19\\d\\d|20\\d\\d|2100')"
    return f"""am0 AS (SELECT *, {norm('name')} AS a, {norm('cand_name')} AS b FROM {rows} am_in),
    {fuzzy_cte('SELECT a, b FROM am0')},
    am1 AS (SELECT am0.*, score AS raw, list_distinct({tokens('am0.a')}) AS qt, list_distinct({tokens('am0.b')}) AS ct,
        {series('am0.a')} AS qs, {series('am0.b')} AS cs, {dlc('am0.b')} AS dlc
        FROM am0 JOIN fuzzy ON fuzzy.a = am0.a AND fuzzy.b = am0.b),
    am2 AS (SELECT *, list_concat({except_('qt', 'ct')}, {except_('ct', 'qt')}) AS diff,
        CASE WHEN len(qs) = 0 AND len(cs) > 0 THEN 15 WHEN len(qs) > 0 AND len(cs) > 0 AND NOT {overlap('qs', 'cs')} THEN 20 ELSE 0 END AS pen
        FROM am1),
    am3 AS (SELECT *, len(list_filter(diff, lambda t: {is_year})) AS ydiff FROM am2),
    am4 AS (SELECT *, len(diff) - ydiff AS odiff, raw >= 100 AND len(diff) = 0 AND pen = 0 AND NOT dlc AS exact,
        CASE WHEN len(list_filter(qt, lambda t: regexp_full_match(t, '\\d+') AND NOT {is_year})) > 0
             AND starts_with(b, a) THEN 25 ELSE 0 END AS bonus, {points} AS ypts FROM am3),
    scored AS (SELECT *, CASE WHEN exact THEN 100 ELSE
        greatest(0, least(100, greatest(0, raw - pen - CASE WHEN dlc THEN 20 ELSE 0 END) + bonus + ypts)) END AS adj,
        CASE WHEN year_hint IS NULL OR cand_year IS NULL THEN 1000000000 ELSE {delta} END AS dist FROM am4)"""


RANK = "adj DESC, raw DESC, exact DESC, dist, dlc, odiff, ydiff, length(cand_name), id"


def editions(n: str) -> str:
    found = f"list_filter(list_distinct({tokens(n)}), lambda t: list_contains({words(REPORT_EDITION_TOKENS)}, t))"
    goty = f"CASE WHEN contains({n}, 'game of the year') THEN ['goty'] ELSE [] END"
    cut = f"CASE WHEN contains({n}, 'director s cut') OR contains({n}, 'directors cut') THEN ['directors'] ELSE [] END"
    return f"list_sort(list_distinct(list_concat(list_concat({found}, {goty}), {cut})))"


_SUFFIX = "(?i)(?:(?:,?\\s+|\\s*,\\s*)(?:" + "|".join(LEGAL_SUFFIXES) + ")[\\s,]*)+$"


def company(x: str) -> str:
    s = f"trim(regexp_replace(trim({x}), '\\s*\\([^)]*\\)\\s*$', ''))"
    s = f"trim(rtrim(regexp_replace({s}, {lit(_SUFFIX)}, ''), ' ,'))"
    s = f"trim(regexp_replace({s}, '\\s{{2,}}', ' ', 'g'))"
    return f"(CASE WHEN regexp_matches({s}, '[A-Za-z]') THEN {s} ELSE '' END)"


def company_key(x: str) -> str:
    folded = f"strip_accents(translate({company(x)}, '™®℠', ''))"
    return f"lower(trim(regexp_replace({folded}, '[^a-zA-Z0-9]+', ' ', 'g')))"


def log_scale(v: str, s: Scale) -> str:
    t = f"(log10(({v})::DOUBLE) - {s.low}) / ({s.high} - {s.low})"
    return f"(CASE WHEN {v} > 0 THEN least(greatest({t}, 0.0), 1.0) * 100.0 END)"


def log_weight(v: str) -> str:
    return f"(CASE WHEN {v} > 0 THEN 1.0 + log10(1.0 + ({v})::DOUBLE) ELSE 0.0 END)"


def blend(pairs: list[tuple[str, str]]) -> str:
    num = " + ".join(f"CASE WHEN {v} IS NOT NULL AND {w} > 0 THEN {v} * {w} ELSE 0.0 END" for v, w in pairs)
    den = " + ".join(f"CASE WHEN {v} IS NOT NULL AND {w} > 0 THEN {w} ELSE 0.0 END" for v, w in pairs)
    return f"CAST(CASE WHEN ({den}) > 0 THEN round_even((({num}) / ({den}))::DOUBLE, 0) END AS BIGINT)"


def join_list(x: str, sep: str = ", ") -> str:
    return f"coalesce(array_to_string({x}, '{sep}'), '')"
