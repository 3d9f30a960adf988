"""Candidate ranking and provider selection over searches (orders) and their hits (lines)."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalith.constants import PROVIDER_DLC_TOKENS, STORE_EDITION_TOKENS
from catalith.functions.fuzzy import with_fuzzy_scores
from catalith.functions.text import provider_dlc_like, title_tokens
from catalith.operators.matching import narrow, once_per_pair, pick_best, ranked, with_alternatives
from catalith.operators.selection import select_entity, select_igdb, select_playtime, select_rawg, select_store, with_name_predicates
from catalith.workload import sql as s
from catalith.workload.frames import HITS, OWN_HITS, SEARCHES, TITLES, duck, spark_frame
from catalith.workload.registry import query

_ROWS = f"(SELECT r.row_id, r.name, r.year_hint, h.id, h.cand_name, h.cand_year, h.released FROM {duck(SEARCHES)} r JOIN {duck(HITS)} h USING (row_id))"


def _pairs(spark, sf):
    hits = spark_frame(spark, sf, HITS)
    return spark_frame(spark, sf, SEARCHES).join(hits, "row_id")


def _own_hits(spark, sf, *columns: str):
    """Every order's own lines as the hits of its search."""
    if not columns:
        return spark_frame(spark, sf, OWN_HITS)
    return spark_frame(spark, sf, HITS).select("row_id", F.col("id").alias("pos"), "id", "cand_name", *columns).distinct()


_STORED = f"searches AS {duck(SEARCHES)}, stored AS (SELECT *, id AS pos FROM {duck(HITS)})"


@query(
    "fuzzy_scores",
    f"""WITH am0 AS (SELECT *, {s.norm('name')} AS a, {s.norm('cand_name')} AS b FROM {_ROWS}), {s.fuzzy_cte('SELECT a, b FROM am0')}
    SELECT row_id, id, cand_name, score FROM (SELECT DISTINCT row_id, id, cand_name, a, b FROM am0) JOIN fuzzy USING (a, b)""",
)
def fuzzy_scores(spark, sf):
    pairs = _pairs(spark, sf).select("row_id", "name", "id", "cand_name").distinct()
    return with_fuzzy_scores(pairs, {"score": ("name", "cand_name")}).select("row_id", "id", "cand_name", "score")


@query(
    "best_matches",
    f"""WITH {s.adjusted_cte(_ROWS)}, r AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY {s.RANK}, cand_year) AS rn FROM scored)
    SELECT row_id, id, cand_name, adj AS score, raw AS raw_score FROM r WHERE rn = 1""",
)
def best_matches(spark, sf):
    return pick_best(_pairs(spark, sf), ["row_id"], "name", "cand_name", "id", ["id", "cand_name"], "year_hint", "cand_year")


_RANK_BY_ID = "adj DESC, raw DESC, exact DESC, id, dist, dlc, odiff, ydiff, length(cand_name)"


@query(
    "best_matches_by_id",
    f"""WITH {s.adjusted_cte(_ROWS)}, r AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY {_RANK_BY_ID}, cand_year) AS rn FROM scored)
    SELECT row_id, id, cand_name, adj AS score, raw AS raw_score FROM r WHERE rn = 1""",
)
def best_matches_by_id(spark, sf):
    """Ties after exactness go to the smallest id, whatever the year."""
    columns = ["id", "cand_name"]
    return pick_best(_pairs(spark, sf), ["row_id"], "name", "cand_name", "id", columns, "year_hint", "cand_year", legacy_tiebreak=True)


@query(
    "match_alternatives",
    f"""WITH rows_ AS (SELECT DISTINCT row_id, name, NULL::INT AS year_hint, id, cand_name, NULL::INT AS cand_year FROM {_ROWS}),
    {s.adjusted_cte('rows_', year=False)}, r AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY {s.RANK}) AS rn FROM scored)
    SELECT row_id, max(CASE WHEN rn = 1 THEN id END) AS best_id, max(CASE WHEN rn = 1 THEN adj END) AS best_score,
    coalesce(string_agg(CASE WHEN rn BETWEEN 2 AND 6 AND raw > 0 THEN cand_name || '=' || raw END, '|' ORDER BY rn), '') AS alternatives
    FROM r GROUP BY row_id""",
)
def match_alternatives(spark, sf):
    pairs = _pairs(spark, sf).select("row_id", "name", "id", "cand_name").distinct()
    top = with_alternatives(ranked(pairs, ["row_id"], "name", "cand_name", "id"), ["row_id"], "cand_name", "id")
    shown = F.transform("alternatives", lambda a: F.concat_ws("=", a["name"], a["score"].cast("string")))
    return top.select("row_id", "best_id", "best_score", F.array_join(shown, "|").alias("alternatives"))


def _narrow_steps(first: str, steps: list[str], keys: str = "row_id") -> str:
    """Sequential narrow-only-if-it-helps filters, each over the survivors of the one before; ends in ``n<k>``."""
    out, at = [f"n0 AS (SELECT * FROM {first})"], 0
    for cond in steps:
        out.append(
            f"w{at + 1} AS (SELECT *, coalesce({cond}, false) AS keep, bool_or(coalesce({cond}, false)) OVER (PARTITION BY {keys}) AS any_kept FROM n{at}), "
            f"n{at + 1} AS (SELECT * EXCLUDE (keep, any_kept) FROM w{at + 1} WHERE keep OR NOT any_kept)"
        )
        at += 1
    return ", ".join(out)


_SERIES_A, _SERIES_B = s.series("a"), s.series("b")
_DLC_A = s.overlap(s.tokens("a"), s.words(PROVIDER_DLC_TOKENS))
_DLC_B = s.overlap(s.tokens("b"), s.words(PROVIDER_DLC_TOKENS))
_STEPS = {
    "exact": "a = b",
    "unnumbered": f"a = '' OR len({_SERIES_A}) > 0 OR len({_SERIES_B}) = 0",
    "base": f"{_DLC_A} OR NOT {_DLC_B}",
    "near": "year_hint IS NOT NULL AND cand_year IS NOT NULL AND abs(cand_year - year_hint) <= 2",
}


def _nums(x: str) -> str:
    return f"list_filter({s.tokens(x)}, lambda t: regexp_full_match(t, '\\d+') AND NOT regexp_full_match(t, '(19|20)\\d\\d'))"


def _text_words(x: str) -> str:
    return f"list_filter({s.tokens(x)}, lambda t: NOT regexp_full_match(t, '\\d+'))"


_STEPS["numbers"] = (
    f"len({_nums('a')}) = 0 OR (coalesce(list_has_all({_nums('b')}, {_nums('a')}), false) AND (len({_text_words('a')}) = 0 "
    f"OR {s.overlap(_text_words('a'), _text_words('b'))}))"
)


@query(
    "narrowed_candidates",
    f"""WITH am0 AS (SELECT *, {s.norm('name')} AS a, {s.norm('cand_name')} AS b FROM {_ROWS}),
    {_narrow_steps('am0', [_STEPS[k] for k in ('exact', 'unnumbered', 'base', 'near', 'numbers')])}
    SELECT row_id, id, cand_name, released FROM n5""",
)
def narrowed_candidates(spark, sf):
    pairs = once_per_pair(_pairs(spark, sf), ["name", "cand_name"], lambda titles: with_name_predicates(titles, "cand_name", "name"))
    near = F.abs(F.col("cand_year") - F.col("year_hint")) <= 2
    kept = narrow(pairs, ["row_id"], [F.col("p_exact"), F.col("p_unnumbered"), F.col("p_base"), near, F.col("p_numbers")])
    return kept.select("row_id", "id", "cand_name", "released")


_RAWG_ROWS = "(SELECT row_id, name, year_hint, id, pos, cand_name, cand_year, released FROM searches JOIN stored USING (row_id))"


@query(
    "select_rawg",
    f"""WITH {_STORED}, {s.adjusted_cte(_RAWG_ROWS)},
    {_narrow_steps('scored', [_STEPS[k] for k in ('exact', 'unnumbered', 'base', 'near', 'numbers')])},
    r AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY {s.RANK}, pos) AS rn FROM n5),
    f AS (SELECT row_id, id, cand_name, CASE WHEN adj < 65 AND starts_with(b, a) AND len({_nums('a')}) > 0 THEN 65 ELSE adj END AS score FROM r WHERE rn = 1)
    SELECT * FROM f WHERE score >= 65""",
)
def rawg_selection(spark, sf):
    hits = _own_hits(spark, sf, "released")
    return select_rawg(spark_frame(spark, sf, SEARCHES), hits)


_IGDB_ROWS = (
    "(SELECT row_id, name, year_hint, id, pos, cand_name, cand_year, CASE WHEN id % 3 = 0 THEN 0 WHEN id % 3 = 1 THEN 4 END AS category "
    "FROM searches JOIN stored USING (row_id))"
)
_WINDOW = "year_hint IS NOT NULL AND cand_year BETWEEN year_hint - 1 AND year_hint + 1"


@query(
    "select_igdb",
    f"""WITH {_STORED}, {s.adjusted_cte(_IGDB_ROWS)},
    {_narrow_steps('scored', [_WINDOW, _STEPS['exact'], f'{_DLC_A} OR category = 0 OR category IS NULL', *[_STEPS[k] for k in ('unnumbered', 'base', 'near')]])},
    r AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY {s.RANK}, pos) AS rn FROM n6)
    SELECT row_id, id, cand_name, adj AS score FROM r WHERE rn = 1 AND adj >= 65""",
)
def igdb_selection(spark, sf):
    hits = _own_hits(spark, sf, "cand_year")
    seconds = F.date_diff(F.make_date("cand_year", F.lit(6), F.lit(1)), F.lit("1970-01-01").cast("date")).cast("bigint") * 86400
    category = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 3 == 1, 4)
    hits = hits.select("row_id", "pos", "id", "cand_name", seconds.alias("first_release_date"), category.alias("category"))
    return select_igdb(spark_frame(spark, sf, SEARCHES), hits)


_VARIANT_ROWS = f"""v AS (SELECT row_id, name, 0 AS no, false AS cased, name AS term FROM searches
        UNION ALL SELECT row_id, name, 1000, true, lower(name) FROM searches WHERE lower(name) <> name
        UNION ALL SELECT row_id, name, 1001, true, upper(name) FROM searches WHERE upper(name) <> name),
    am0 AS (SELECT v.*, pos, id, cand_name, {s.norm('name')} AS a, {s.norm('cand_name')} AS b FROM v JOIN (SELECT DISTINCT row_id, pos, id, cand_name FROM stored) USING (row_id))"""


@query(
    "select_playtime",
    f"""WITH {_STORED}, {_VARIANT_ROWS}, {s.fuzzy_cte('SELECT a, b FROM am0')},
    t AS (SELECT row_id, cased, no, term, max(score) AS top, arg_max(id, (score, -pos)) AS id, arg_max(cand_name, (score, -pos)) AS cand_name
        FROM am0 JOIN fuzzy USING (a, b) GROUP BY row_id, cased, no, term),
    o AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY cased, (top >= 95 AND NOT cased) DESC,
        CASE WHEN top >= 95 AND NOT cased THEN no ELSE 0 END, top DESC, no) AS rn FROM t)
    SELECT row_id, id, cand_name, top AS score, term FROM o WHERE rn = 1 AND top >= 65""",
)
def playtime_selection(spark, sf):
    """Order titles carry no year, colon or roman numeral, so their only plain variant is themselves."""
    hits = _own_hits(spark, sf)
    return select_playtime(spark_frame(spark, sf, SEARCHES).select("row_id", "name"), hits)


_EDITIONS = s.words(STORE_EDITION_TOKENS)
_STORE_NUMBER = "len(list_filter({tokens}, lambda t: regexp_full_match(t, '\\d{{1,2}}') AND t NOT IN ('0', '1'))) > 0"


def _bare(norm: str) -> str:
    return f"array_to_string(list_filter({s.tokens(norm)}, lambda t: NOT list_contains({_EDITIONS}, t)), ' ')"


def _store_number(norm: str) -> str:
    return _STORE_NUMBER.format(tokens=s.tokens(norm))


def _best(rows: str, order: str, columns: str, keys: str = "row_id") -> str:
    """Best candidate per key of a sub-select, as a nested statement of its own."""
    return f"""(WITH {s.adjusted_cte(rows)}, r AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn FROM scored)
        SELECT {columns} FROM r WHERE rn = 1)"""


_DETAILS = """SELECT p_partkey AS did, title AS d_name, CASE WHEN p_type = 'SMALL' THEN 'dlc' ELSE 'game' END AS d_type, p_size % 8 + 1994 AS d_year FROM titles"""
_CODE = f"""(CASE WHEN b = a THEN 8 ELSE 0 END + CASE WHEN b = a THEN 4 ELSE 0 END + CASE WHEN {_bare('a')} <> '' AND NOT {_store_number(_bare('a'))}
    AND {_bare('b')} = {_bare('a')} AND NOT {_store_number('b')} THEN 2 ELSE 0 END + CASE WHEN {_DLC_A} OR NOT {_DLC_B} THEN 1 ELSE 0 END)"""
_D_DLC = s.overlap(s.tokens(s.norm("d_name")), s.words(PROVIDER_DLC_TOKENS))
_SECOND_ROWS = "(SELECT row_id, name, year_hint, did AS id, pos, d_name AS cand_name, d_year AS cand_year FROM sample)"
_MEMBER_ROWS = "(SELECT row_id, name, year_hint, did AS id, app_no AS pos, d_name AS cand_name, d_year AS cand_year FROM members)"


@query(
    "select_store",
    f"""WITH {_STORED}, titles AS {duck(TITLES)}, details AS ({_DETAILS}),
    found AS (SELECT row_id, name, year_hint, id, pos, cand_name, year_hint IS NOT NULL AS dated, TRY_CAST(regexp_extract(cand_name, '(?:19|20)\\d\\d') AS INT) AS cand_year
        FROM searches JOIN (SELECT DISTINCT row_id, pos, id, cand_name FROM stored) USING (row_id)),
    apps AS (SELECT * FROM found WHERE id % 5 <> 0),
    cand AS (SELECT *, {_CODE} AS code FROM (SELECT *, {s.norm('name')} AS a, {s.norm('cand_name')} AS b FROM apps)),
    best AS {_best('cand', f'code DESC, {s.RANK}, pos', f'row_id, name, year_hint, a, b, code, id, cand_name, adj AS score, {_DLC_A} AS q_dlc, {_DLC_B} AS c_dlc, list_sort(qs) <> list_sort(cs) AS other_number')},
    first AS (SELECT *, CASE WHEN NOT q_dlc THEN d_type = 'game' AND NOT {_D_DLC} END AS valid FROM best JOIN details ON did = id),
    doubt AS (SELECT row_id, code AS top FROM first WHERE year_hint IS NOT NULL OR score < 90 OR (c_dlc AND NOT q_dlc) OR NOT coalesce(valid, true) OR other_number),
    few AS (SELECT * FROM (SELECT cand.*, row_number() OVER (PARTITION BY row_id ORDER BY pos) AS k FROM cand JOIN doubt USING (row_id) WHERE code = top) WHERE k <= 10),
    sample AS (SELECT row_id, name, year_hint, pos, did, d_name, d_year FROM few JOIN details ON did = id WHERE d_type = 'game' AND ({_DLC_A} OR NOT {_D_DLC})),
    second AS {_best(_SECOND_ROWS, f'{s.RANK}, pos', 'row_id, id AS id2, cand_name AS name2, adj AS score2')},
    swap AS (SELECT first.* EXCLUDE (did, d_name, d_type, d_year), id2, name2, score2,
        coalesce(score2 >= 65 AND (NOT coalesce(valid, true) OR score2 >= greatest(score, 65)), false) AS swapped FROM first LEFT JOIN second USING (row_id)),
    pick AS (SELECT row_id, q_dlc, CASE WHEN swapped THEN id2 ELSE id END AS id, CASE WHEN swapped THEN name2 ELSE cand_name END AS cand_name,
        CASE WHEN swapped THEN score2 ELSE score END AS score FROM swap),
    judged AS (SELECT *, CASE WHEN NOT q_dlc AND d_type <> 'game' THEN 'type_' || d_type
        WHEN NOT q_dlc AND ({_D_DLC} OR {s.overlap(s.tokens(s.norm('cand_name')), s.words(PROVIDER_DLC_TOKENS))}) THEN 'dlc_like'
        WHEN score < 65 THEN 'low_score' END AS reason FROM pick JOIN details ON did = id),
    subs AS (SELECT found.*, t.no AS term_no FROM found JOIN (VALUES (0), (1)) t(no) ON t.no = 0 OR dated WHERE id % 5 = 0 AND row_id NOT IN (SELECT row_id FROM apps)),
    packs AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY term_no, pos) AS k FROM subs) WHERE k <= 10),
    once AS (SELECT row_id, name, year_hint, app, min((k, app_pos)) AS seen FROM (SELECT *, id + app_pos AS app FROM packs JOIN (VALUES (0), (1), (2)) o(app_pos) ON true)
        WHERE id IN (SELECT did FROM details) GROUP BY ALL),
    tried AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY seen) AS app_no FROM once),
    members AS (SELECT * FROM tried JOIN details ON did = app WHERE app_no <= 10 AND d_type = 'game'),
    bought AS {_best(_MEMBER_ROWS, f'{s.RANK}, pos', 'row_id, id, cand_name, adj AS score, cand_year AS release_year')}
    SELECT row_id, CAST(CASE WHEN reason IS NULL THEN id END AS VARCHAR) AS id, CASE WHEN reason IS NULL THEN cand_name END AS cand_name,
    CASE WHEN reason IS NULL THEN score END AS score, CASE WHEN reason IS NULL THEN d_year END AS release_year, coalesce(reason, '') AS rejected_reason FROM judged
    UNION ALL SELECT row_id, CAST(id AS VARCHAR), cand_name, score, release_year, '' FROM bought WHERE score >= 65""",
)
def store_selection(spark, sf):
    hits = _own_hits(spark, sf).withColumn("cand_type", F.when(F.col("id") % 5 == 0, "sub").otherwise("app"))
    titles = spark_frame(spark, sf, TITLES)
    details = titles.select(
        F.col("p_partkey").alias("id"),
        F.col("title").alias("d_name"),
        F.when(F.col("p_type") == "SMALL", "dlc").otherwise("game").alias("d_type"),
        F.concat(F.lit("1 Jan, "), (F.col("p_size") % 8 + 1994).cast("string")).alias("d_date"),
    )
    packages = titles.select(
        F.col("p_partkey").alias("package_id"), F.posexplode(F.sequence("p_partkey", F.col("p_partkey") + 2)).alias("pos", "app_id")
    )
    found = select_store(spark_frame(spark, sf, SEARCHES), hits, details, packages)
    return found.withColumn("id", F.col("id").cast("string"))


_ENTITY_ROWS = """(SELECT row_id, term_no, term AS name, year_hint, id, pos, cand_name, CASE WHEN id % 4 = 0 THEN 1995 END AS cand_year,
        CASE id % 4 WHEN 0 THEN 'game' WHEN 1 THEN 'film' WHEN 2 THEN 'demo' ELSE '' END AS kind, p_type <> 'PROMO' AS real
        FROM tries JOIN (SELECT DISTINCT row_id, pos, id, cand_name FROM stored) USING (row_id) JOIN part ON p_partkey = id)"""


@query(
    "select_entity",
    f"""WITH {_STORED}, tries AS (SELECT row_id, year_hint, no AS term_no, name || suffix AS term FROM searches
        JOIN (VALUES (0, ''), (1, ' video game'), (2, ' (video game)')) t(no, suffix) ON true),
    {s.adjusted_cte(_ENTITY_ROWS)},
    w AS (SELECT *, len(list_filter(regexp_extract_all(lower(cand_name), '[a-z0-9]+'), lambda t: NOT list_contains(regexp_extract_all(lower(name), '[a-z0-9]+'), t))) > 0 AS adds,
        row_number() OVER (PARTITION BY row_id, term_no ORDER BY {s.RANK}, pos) AS k, row_number() OVER (PARTITION BY row_id, term_no ORDER BY raw DESC, pos) AS near FROM scored),
    g AS (SELECT row_id, term_no, list(struct_pack(id := id, label := cand_name, adj := adj, adds := adds, kind := kind, real := real) ORDER BY k) AS l,
        min(k) FILTER (kind = 'game') AS kp, min(k) FILTER (kind IN ('game', 'demo')) AS kg, min(k) FILTER (NOT adds) AS ks, min(k) FILTER (near <= 10 AND real) AS kv
        FROM w GROUP BY row_id, term_no),
    f AS (SELECT *, CASE WHEN coalesce(l[kp].adj >= 65, false) THEN kp ELSE coalesce(kg, 1) END AS k1 FROM g),
    u AS (SELECT *, CASE WHEN l[k1].adj < 90 AND l[k1].adds AND coalesce(l[ks].adj >= 65, false) THEN ks ELSE k1 END AS k2 FROM f),
    v AS (SELECT *, CASE WHEN l[k2].kind <> 'film' THEN k2 WHEN l[kv].adj >= 65 THEN kv WHEN l[kg].adj >= 65 THEN kg END AS k3 FROM u),
    x AS (SELECT *, CASE WHEN l[k3].real THEN k3 WHEN l[kv].adj >= 65 AND l[kv].id <> l[k3].id THEN kv END AS k4 FROM v),
    o AS (SELECT *, CASE WHEN l[k2].adj < 65 THEN 'retry' WHEN k3 IS NULL THEN 'reject' WHEN NOT l[k3].real THEN CASE WHEN k4 IS NULL THEN 'retry' ELSE 'accepted' END
        ELSE 'accepted' END AS outcome FROM x),
    own AS (SELECT row_id, outcome, l[k4] AS hit FROM o WHERE term_no = 0),
    again AS (SELECT row_id, arg_min(l[k4], term_no) AS hit FROM o WHERE term_no > 0 AND outcome = 'accepted' GROUP BY row_id),
    r AS (SELECT row_id, CASE WHEN outcome = 'accepted' THEN own.hit WHEN outcome = 'retry' THEN again.hit END AS hit FROM own LEFT JOIN again USING (row_id))
    SELECT row_id, hit.id AS id, hit.label AS label, hit.adj AS score FROM r WHERE hit IS NOT NULL""",
)
def entity_selection(spark, sf):
    hits = _own_hits(spark, sf).withColumnRenamed("cand_name", "label")
    kind = F.when(F.col("id") % 4 == 0, "1995 video game").when(F.col("id") % 4 == 1, "film").when(F.col("id") % 4 == 2, "demo of a video game")
    instances = spark_frame(spark, sf, TITLES).select(
        F.col("p_partkey").alias("id"),
        F.when(F.col("p_type") == "PROMO", F.array(F.lit("game demo"))).otherwise(F.array(F.lit("video game"))).alias("instance_of"),
        F.lit("").alias("description"),
    )
    return select_entity(spark_frame(spark, sf, SEARCHES), hits.withColumn("description", F.coalesce(kind, F.lit(""))), instances)


@query(
    "add_on_hits",
    f"SELECT row_id, id, {s.overlap(s.tokens('b'), s.words(PROVIDER_DLC_TOKENS))} AS add_on FROM "
    f"(SELECT DISTINCT row_id, id, {s.norm('cand_name')} AS b FROM {duck(HITS)})",
)
def add_on_hits(spark, sf):
    hits = spark_frame(spark, sf, HITS).select("row_id", "id", "cand_name").distinct()
    return hits.select("row_id", "id", provider_dlc_like(title_tokens(F.col("cand_name"))).alias("add_on"))
