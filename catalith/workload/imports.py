"""Import of a whole list of titles, matched against five stores of records by an index of title words."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalith.constants import PROVIDER_DLC_TOKENS
from catalith.operators.search import indexed_search, search_titles, title_index
from catalith.operators.selection import (
    entity_terms, igdb_terms, playtime_terms, rawg_terms, select_entity, select_igdb, select_playtime, select_rawg, select_store, store_terms,
)
from catalith.plans.imports import LABELS, import_catalog  # noqa: F401
from catalith.workload import sql as s
from catalith.workload.frames import TITLES, duck, spark_frame, table
from catalith.workload.matching import _CODE, _D_DLC, _DLC_A, _DLC_B, _STEPS, _WINDOW, _best, _narrow_steps, _nums
from catalith.workload.registry import query

# A user's list: one row per part, some with pins of the store that name no record, no game, or the right one.
LIST = """SELECT 'rid:' || CAST(p_partkey AS STRING) AS RowId, p_partkey, CASE p_partkey % 5 WHEN 0 THEN p_name || ' 2' WHEN 1 THEN upper(p_name)
        WHEN 2 THEN p_name || ': the long winding saga' ELSE p_name END AS Name,
    CASE WHEN p_size % 3 = 0 THEN CAST(1992 + p_size % 7 AS STRING) ELSE '' END AS YearHint, CASE WHEN p_size % 11 = 0 THEN 'YES' ELSE '' END AS Disabled,
    CASE WHEN p_size % 7 = 0 THEN 'PlayStation' WHEN p_size % 5 = 0 THEN 'PC' ELSE '' END AS Platform,
    CASE WHEN p_size % 17 = 0 THEN '__NOT_FOUND__' WHEN p_size % 10 = 9 THEN CAST(p_partkey AS STRING) ELSE '' END AS RAWG_ID, '' AS IGDB_ID,
    CASE p_size % 6 WHEN 0 THEN CAST(p_partkey * 10 AS STRING) WHEN 1 THEN '999' || CAST(p_partkey AS STRING) ELSE '' END AS Steam_AppID,
    '' AS HLTB_ID, '' AS Wikidata_QID FROM {part}"""
# The stores: one record per name, year and kind. Facts of every id, for pins and answers.
RECORDS = {
    "rawg": f"SELECT title, min(p_partkey) AS id, 1992 + p_size % 7 AS y FROM ({TITLES}) t GROUP BY title, 1992 + p_size % 7",
    "igdb": "SELECT p_name AS title, min(p_partkey) AS id, 1990 + p_size % 9 AS y, CASE WHEN p_size % 3 = 0 THEN 0 WHEN p_size % 3 = 1 THEN 4 END AS category "
            "FROM {part} GROUP BY p_name, 1990 + p_size % 9, CASE WHEN p_size % 3 = 0 THEN 0 WHEN p_size % 3 = 1 THEN 4 END",
    "steam": f"SELECT title, min(p_partkey) * 10 AS id FROM ({TITLES}) t GROUP BY title",
    "hltb": "SELECT title, min(p_partkey) AS id FROM (SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_name || ' 2' ELSE p_name END AS title FROM {part}) t GROUP BY title",
    "wikidata": "SELECT title, 'Q' || CAST(min(p_partkey) AS STRING) AS id, kind FROM (SELECT p_partkey, p_size % 4 AS kind, CASE WHEN p_size % 7 = 0 "
                "THEN p_name || ' (video game)' ELSE p_name END AS title FROM {part}) t GROUP BY title, kind",
}
FACTS = {
    "rawg": f"SELECT CAST(p_partkey AS STRING) AS id, title AS m_name, 1992 + p_size % 7 AS m_year FROM ({TITLES}) t",
    "igdb": "SELECT CAST(p_partkey AS STRING) AS id, p_name AS m_name, 1990 + p_size % 9 AS m_year FROM {part}",
    "steam": f"SELECT CAST(p_partkey * 10 AS STRING) AS id, title AS m_name, 1994 + p_size % 8 AS m_year FROM ({TITLES}) t",
    "hltb": "SELECT CAST(p_partkey AS STRING) AS id, CASE WHEN p_size % 2 = 0 THEN p_name || ' 2' ELSE p_name END AS m_name, CAST(NULL AS INT) AS m_year FROM {part}",
    "wikidata": "SELECT 'Q' || CAST(p_partkey AS STRING) AS id, CASE WHEN p_size % 7 = 0 THEN p_name || ' (video game)' ELSE p_name END AS m_name, "
                "CAST(NULL AS INT) AS m_year FROM {part}",
}
DETAILS = f"SELECT p_partkey * 10 AS id, title AS d_name, CASE WHEN p_type = 'SMALL' THEN 'dlc' ELSE 'game' END AS d_type, 1994 + p_size % 8 AS d_year FROM ({TITLES}) t"
_KIND = ("1995 video game", "film", "demo of a video game")


def searchers(spark, sf, providers: tuple[str, ...] = tuple(RECORDS)) -> dict:
    """Searches of the stores by provider."""
    records = {p: spark_frame(spark, sf, t) for p, t in RECORDS.items()}
    seconds = F.date_diff(F.make_date("y", F.lit(6), F.lit(1)), F.lit("1970-01-01").cast("date")).cast("bigint") * 86400
    kind = F.coalesce(*[F.when(F.col("kind") == k, F.lit(t)) for k, t in enumerate(_KIND)], F.lit(""))
    details = spark_frame(spark, sf, DETAILS).withColumn("d_date", F.concat(F.lit("1 Jan, "), F.col("d_year").cast("string")))
    instances = table(spark, sf, "part").select(
        F.concat(F.lit("Q"), F.col("p_partkey").cast("string")).alias("id"),
        F.when(F.col("p_type") == "PROMO", F.array(F.lit("game demo"))).otherwise(F.array(F.lit("video game"))).alias("instance_of"),
        F.lit("").alias("description"),
    )
    shaped = {
        "rawg": records["rawg"].withColumn("released", F.concat(F.col("y").cast("string"), F.lit("-01-01"))).withColumn("cand_name", F.col("title")).drop("y"),
        "igdb": records["igdb"].select("title", "id", "category", F.col("title").alias("cand_name"), seconds.alias("first_release_date")),
        "steam": records["steam"].select("title", "id", F.col("title").alias("cand_name"), F.lit("app").alias("cand_type")),
        "hltb": records["hltb"].withColumn("cand_name", F.col("title")),
        "wikidata": records["wikidata"].select("title", "id", F.col("title").alias("label"), kind.alias("description")),
    }
    rules = {
        "rawg": (rawg_terms, select_rawg), "igdb": (igdb_terms, select_igdb), "steam": (store_terms, lambda q, h: select_store(q, h, details)),
        "hltb": (playtime_terms, select_playtime), "wikidata": (entity_terms, lambda q, h: select_entity(q, h, instances)),
    }
    return {p: indexed_search(shaped[p], terms, select) for p, (terms, select) in rules.items() if p in providers}


def _cross_ids(spark, sf):
    """Store ids in the payloads of pinned IGDB records: of every fifth record none, else the part's, which may be no game."""

    def found(catalog):
        asked = catalog.select("RowId", F.col("IGDB_ID").try_cast("bigint").alias("k"))
        implied = F.when(F.col("k") % 5 != 0, (F.col("k") * 10).cast("string"))
        return asked.select("RowId", implied.alias("igdb_steam_id"), F.lit(None).cast("string").alias("rawg_steam_id"))

    return found


_PINS = {"rawg": ("RAWG", "RAWG_ID"), "igdb": ("IGDB", "IGDB_ID"), "steam": ("Steam", "Steam_AppID"), "hltb": ("HLTB", "HLTB_ID"), "wikidata": ("Wikidata", "Wikidata_QID")}
OUT = ["RowId"] + [c for p, (label, pin) in _PINS.items() for c in (pin, "Wikidata_MatchedLabel" if p == "wikidata" else f"{label}_MatchedName", f"{label}_MatchScore", f"{label}_MatchedYear")] + ["Steam_RejectedReason"]


def _words(x: str) -> str:
    return f"list_distinct({s.tokens(s.norm(x))})"


def _letters(ws: str) -> str:
    return f"coalesce(list_sum([length(w) FOR w IN {ws}]), 0)"


def strip_year(x: str) -> str:
    return f"coalesce(nullif(trim(regexp_replace(trim({x}), '\\s*\\((19|20)\\d\\d\\)\\s*$', '')), ''), trim({x}))"


def strip_phrases(x: str) -> str:
    """Titles of the tables hold one phrase only."""
    return f"coalesce(nullif(trim(regexp_replace(trim(regexp_replace({x}, '(?i)\\bdefinitive\\s+edition\\b', '', 'g')), '\\s{{2,}}', ' ', 'g')), ''), {x})"


def searched_sql(terms: str, titles: str) -> str:
    """Every text of ``terms`` (column term) against every one of ``titles`` (column title): (term, title, shared)."""
    return f"""(SELECT term, title, shared FROM (SELECT term, title, {_letters('tw')} AS n, {_letters('list_intersect(tw, sw)')} AS shared
        FROM (SELECT DISTINCT term, {_words('term')} AS tw FROM {terms} WHERE term IS NOT NULL) a, (SELECT DISTINCT title, {_words('title')} AS sw FROM {titles}) b)
        WHERE shared > 0 AND shared * 100 >= n * 60)"""


def _hits(p: str, terms: str) -> str:
    """CTE ``hits_<p>`` (term, title, id, .., pos)."""
    return f"""rec_{p} AS {duck(RECORDS[p])}, hits_{p} AS (SELECT term, r.*, row_number() OVER (PARTITION BY term ORDER BY shared DESC, length(title), title, id) AS pos
        FROM {searched_sql(terms, f'rec_{p}')} f JOIN rec_{p} r USING (title))"""


def _asked(p: str, rows: str, where: str = "") -> str:
    """CTE ``ask_<p>``: distinct names and years of the rows to search for."""
    pin = _PINS[p][1]
    return f"""ask_{p} AS (SELECT DISTINCT Name || '|' || coalesce(hint, '') AS row_id, Name AS name, TRY_CAST(hint AS INT) AS year_hint FROM {rows}
        WHERE Disabled <> 'YES' AND {pin} = '' {where})"""


def rawg_sql() -> str:
    """CTEs from ``ask_rawg`` to ``sel_rawg`` (row_id, id)."""
    rows = "(SELECT row_id || '#' || term_no AS row_id, row_id AS asked, term_no, term AS name, year_hint, id, pos, title AS cand_name, y AS cand_year FROM terms_rawg JOIN hits_rawg USING (term))"
    return f"""terms_rawg AS (SELECT row_id, year_hint, 0 AS term_no, {strip_year('name')} AS term FROM ask_rawg
        UNION ALL SELECT row_id, year_hint, 1, trim(string_split({strip_year('name')}, ':')[1]) FROM ask_rawg WHERE contains({strip_year('name')}, ':')),
    {_hits('rawg', 'terms_rawg')},
    sel_rawg AS (WITH {s.adjusted_cte(rows)}, {_narrow_steps('scored', [_STEPS[k] for k in ('exact', 'unnumbered', 'base', 'near', 'numbers')])},
        r AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY {s.RANK}, pos) AS rn FROM n5),
        f AS (SELECT asked, term_no, id, cand_name, cand_year, CASE WHEN adj < 65 AND starts_with(b, a) AND len({_nums('a')}) > 0 THEN 65 ELSE adj END AS score FROM r WHERE rn = 1),
        g AS (SELECT *, row_number() OVER (PARTITION BY asked ORDER BY term_no = 0 AND score >= 65 DESC, score DESC, term_no) AS k FROM f)
        SELECT asked AS row_id, CAST(id AS VARCHAR) AS id, cand_name, score FROM g WHERE k = 1 AND score >= 65)"""


def igdb_sql() -> str:
    rows = f"(SELECT row_id, {strip_year('name')} AS name, year_hint, id, pos, title AS cand_name, y AS cand_year, category FROM ask_igdb JOIN hits_igdb ON term = {strip_year('name')})"
    steps = [_WINDOW, _STEPS["exact"], f"{_DLC_A} OR category = 0 OR category IS NULL", *[_STEPS[k] for k in ("unnumbered", "base", "near")]]
    return f"""{_hits('igdb', f"(SELECT {strip_year('name')} AS term FROM ask_igdb)")},
    sel_igdb AS (WITH {s.adjusted_cte(rows)}, {_narrow_steps('scored', steps)}, r AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY {s.RANK}, pos) AS rn FROM n6)
        SELECT row_id, CAST(id AS VARCHAR) AS id, cand_name, adj AS score FROM r WHERE rn = 1 AND adj >= 65)"""


def steam_sql() -> str:
    """Store rule without packages; the first text that finds apps counts."""
    second = "(SELECT row_id, name, year_hint, did AS id, pos, d_name AS cand_name, d_year AS cand_year FROM st_sample)"
    best_columns = f"row_id, name, year_hint, a, b, code, id, cand_name, adj AS score, {_DLC_A} AS q_dlc, {_DLC_B} AS c_dlc, list_sort(qs) <> list_sort(cs) AS other_number"
    return f"""terms_steam AS (SELECT row_id, {strip_year('name')} AS query, year_hint, no, CASE no WHEN 0 THEN {strip_year('name')} WHEN 1 THEN {strip_phrases(strip_year('name'))}
        WHEN 2 THEN trim(name) ELSE {strip_year('name')} || ' ' || year_hint END AS term FROM ask_steam, (VALUES (0), (1), (2), (3)) t(no)),
    {_hits('steam', 'terms_steam')},
    met_steam AS (SELECT *, min(no) OVER (PARTITION BY row_id) AS first_no FROM terms_steam JOIN hits_steam USING (term)),
    st_details AS (SELECT id AS did, d_name, d_type, d_year FROM {duck(DETAILS)}),
    st_cand AS (SELECT *, {_CODE} AS code FROM (SELECT DISTINCT row_id, query AS name, year_hint, id, pos, title AS cand_name,
        TRY_CAST(regexp_extract(title, '(?:19|20)\\d\\d') AS INT) AS cand_year, {s.norm('query')} AS a, {s.norm('title')} AS b FROM met_steam WHERE no = first_no)),
    st_best AS {_best('st_cand', f'code DESC, {s.RANK}, pos', best_columns)},
    st_first AS (SELECT *, CASE WHEN NOT q_dlc THEN d_type = 'game' AND NOT {_D_DLC} END AS valid FROM st_best JOIN st_details ON did = id),
    st_doubt AS (SELECT row_id, code AS top FROM st_first WHERE year_hint IS NOT NULL OR score < 90 OR (c_dlc AND NOT q_dlc) OR NOT coalesce(valid, true) OR other_number),
    st_few AS (SELECT * FROM (SELECT st_cand.*, row_number() OVER (PARTITION BY row_id ORDER BY pos) AS k FROM st_cand JOIN st_doubt USING (row_id) WHERE code = top) WHERE k <= 10),
    st_sample AS (SELECT row_id, name, year_hint, pos, did, d_name, d_year FROM st_few JOIN st_details ON did = id WHERE d_type = 'game' AND ({_DLC_A} OR NOT {_D_DLC})),
    st_second AS {_best(second, f'{s.RANK}, pos', 'row_id, id AS id2, cand_name AS name2, adj AS score2')},
    st_swap AS (SELECT st_first.* EXCLUDE (did, d_name, d_type, d_year), id2, name2, score2,
        coalesce(score2 >= 65 AND (NOT coalesce(valid, true) OR score2 >= greatest(score, 65)), false) AS swapped FROM st_first LEFT JOIN st_second USING (row_id)),
    st_pick AS (SELECT row_id, q_dlc, CASE WHEN swapped THEN id2 ELSE id END AS id, CASE WHEN swapped THEN name2 ELSE cand_name END AS cand_name,
        CASE WHEN swapped THEN score2 ELSE score END AS score FROM st_swap),
    sel_steam AS (SELECT row_id, CASE WHEN reason IS NULL THEN CAST(id AS VARCHAR) END AS id, CASE WHEN reason IS NULL THEN cand_name END AS cand_name, score, coalesce(reason, '') AS reason
        FROM (SELECT *, CASE WHEN NOT q_dlc AND d_type <> 'game' THEN 'type_' || d_type
            WHEN NOT q_dlc AND ({_D_DLC} OR {s.overlap(s.tokens(s.norm('cand_name')), s.words(PROVIDER_DLC_TOKENS))}) THEN 'dlc_like'
            WHEN score < 65 THEN 'low_score' END AS reason FROM st_pick JOIN st_details ON did = id))"""


_ENTITY = """(SELECT row_id || '#' || term_no AS row_id, row_id AS asked, term_no, term AS name, year_hint, h.id, h.pos, title AS cand_name, CASE WHEN kind = 0 THEN 1995 END AS cand_year,
        CASE kind WHEN 0 THEN 'game' WHEN 1 THEN 'film' WHEN 2 THEN 'demo' ELSE '' END AS kind, p_type <> 'PROMO' AS real
        FROM tries_w JOIN hits_wikidata h USING (term) JOIN part ON h.id = 'Q' || p_partkey)"""


def wikidata_sql() -> str:
    return f"""tries_w AS (SELECT row_id, year_hint, no AS term_no, name || suffix AS term FROM ask_wikidata JOIN (VALUES (0, ''), (1, ' video game'), (2, ' (video game)')) t(no, suffix) ON true),
    {_hits('wikidata', 'tries_w')},
    sel_wikidata AS (WITH {s.adjusted_cte(_ENTITY)},
    w AS (SELECT *, len(list_filter(regexp_extract_all(lower(cand_name), '[a-z0-9]+'), lambda t: NOT list_contains(regexp_extract_all(lower(name), '[a-z0-9]+'), t))) > 0 AS adds,
        row_number() OVER (PARTITION BY row_id ORDER BY {s.RANK.rsplit(', id', 1)[0]}, pos) AS k, row_number() OVER (PARTITION BY row_id ORDER BY raw DESC, pos) AS near FROM scored),
    g AS (SELECT asked, term_no, list(struct_pack(id := id, label := cand_name, adj := adj, adds := adds, kind := kind, real := real) ORDER BY k) AS l,
        min(k) FILTER (kind = 'game') AS kp, min(k) FILTER (kind IN ('game', 'demo')) AS kg, min(k) FILTER (NOT adds) AS ks, min(k) FILTER (near <= 10 AND real) AS kv
        FROM w GROUP BY asked, term_no),
    f AS (SELECT *, CASE WHEN coalesce(l[kp].adj >= 65, false) THEN kp ELSE coalesce(kg, 1) END AS k1 FROM g),
    u AS (SELECT *, CASE WHEN l[k1].adj < 90 AND l[k1].adds AND coalesce(l[ks].adj >= 65, false) THEN ks ELSE k1 END AS k2 FROM f),
    v AS (SELECT *, CASE WHEN l[k2].kind <> 'film' THEN k2 WHEN l[kv].adj >= 65 THEN kv WHEN l[kg].adj >= 65 THEN kg END AS k3 FROM u),
    x AS (SELECT *, CASE WHEN l[k3].real THEN k3 WHEN l[kv].adj >= 65 AND l[kv].id <> l[k3].id THEN kv END AS k4 FROM v),
    o AS (SELECT *, CASE WHEN l[k2].adj < 65 THEN 'retry' WHEN k3 IS NULL THEN 'reject' WHEN NOT l[k3].real THEN CASE WHEN k4 IS NULL THEN 'retry' ELSE 'accepted' END
        ELSE 'accepted' END AS outcome FROM x),
    own AS (SELECT asked, outcome, l[k4] AS hit FROM o WHERE term_no = 0),
    again AS (SELECT asked, arg_min(l[k4], term_no) AS hit FROM o WHERE term_no > 0 AND outcome = 'accepted' GROUP BY asked),
    r AS (SELECT coalesce(own.asked, again.asked) AS asked, CASE WHEN outcome = 'accepted' THEN own.hit WHEN outcome = 'retry' THEN again.hit END AS hit FROM own FULL JOIN again ON again.asked = own.asked)
    SELECT asked AS row_id, hit.id AS id FROM r WHERE hit IS NOT NULL)"""


def hltb_sql() -> str:
    return f"""var_h AS (SELECT row_id, name, 0 AS no, false AS cased, name AS term FROM ask_hltb
        UNION ALL SELECT row_id, name, 1, false, trim(string_split(name, ':')[1]) FROM ask_hltb WHERE contains(name, ':')
        UNION ALL SELECT row_id, name, 1000, true, lower(name) FROM ask_hltb WHERE lower(name) <> name
        UNION ALL SELECT row_id, name, 1001, true, upper(name) FROM ask_hltb WHERE upper(name) <> name),
    {_hits('hltb', 'var_h')},
    am_h AS (SELECT v.*, pos, id, title AS cand_name, {s.norm('name')} AS a, {s.norm('title')} AS b FROM var_h v JOIN hits_hltb USING (term)),
    fz_h AS (WITH {s.fuzzy_cte('SELECT a, b FROM am_h')} SELECT * FROM fuzzy),
    t_h AS (SELECT row_id, cased, no, max(score) AS top, arg_max(id, (score, -pos)) AS id FROM am_h JOIN fz_h USING (a, b) GROUP BY row_id, cased, no),
    sel_hltb AS (SELECT row_id, CAST(id AS VARCHAR) AS id FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY cased, (top >= 95 AND NOT cased) DESC,
        CASE WHEN top >= 95 AND NOT cased THEN no ELSE 0 END, top DESC, no) AS rn FROM t_h) WHERE rn = 1 AND top >= 65)"""


def _pinned(p: str) -> str:
    """CTE ``pin_<p>``: RowId, the pin after the provider's stage, and its facts."""
    pin = _PINS[p][1]
    rows = {"steam": "inferred"}.get(p, "cat")
    pc = "AND Platform <> 'PlayStation'" if p == "steam" else ""
    return f"""pin_{p} AS (SELECT RowId, Name, pin, asked, reason, CASE WHEN Disabled <> 'YES' THEN m_name END AS m_name, CASE WHEN Disabled <> 'YES' THEN m_year END AS m_year FROM
        (SELECT c.RowId, Name, Disabled, CASE WHEN {pin} = '' AND Disabled <> 'YES' THEN coalesce(s.id, '') ELSE {pin} END AS pin, {pin} = '' AS asked, {'s.reason' if p == 'steam' else 'NULL'} AS reason
         FROM {rows} c LEFT JOIN sel_{p} s ON s.row_id = Name || '|' || coalesce(hint, '') AND {pin} = '' AND Disabled <> 'YES' {pc})
        LEFT JOIN {duck(FACTS[p])} f ON f.id = pin)"""


_PAIRS = " UNION ALL ".join(f"SELECT {s.norm('Name')} AS a, {s.norm('m_name')} AS b FROM pin_{p} WHERE m_name IS NOT NULL" for p in _PINS)
_SHOWN = ", ".join(
    f"{p}.pin AS {pin}, coalesce({p}.m_name, '') AS {'Wikidata_MatchedLabel' if p == 'wikidata' else label + '_MatchedName'}, "
    f"CASE WHEN {p}.m_name IS NULL THEN '' ELSE CAST(z_{p}.score AS VARCHAR) END AS {label}_MatchScore, coalesce(CAST({p}.m_year AS VARCHAR), '') AS {label}_MatchedYear"
    for p, (label, pin) in _PINS.items()
)
_JOINS = " ".join(
    [f"JOIN pin_{p} {p} ON {p}.RowId = cat.RowId" for p in _PINS]
    + [f"LEFT JOIN fz_all z_{p} ON z_{p}.a = {s.norm(f'{p}.Name')} AND z_{p}.b = {s.norm(f'{p}.m_name')} AND {p}.m_name IS NOT NULL" for p in _PINS]
)


@query(
    "imported_catalog",
    f"""WITH cat AS (SELECT *, nullif(YearHint, '') AS hint FROM {duck(LIST)}),
    {_asked('rawg', 'cat')}, {rawg_sql()}, {_pinned('rawg')},
    {_asked('igdb', 'cat')}, {igdb_sql()}, {_pinned('igdb')},
    det AS {duck(DETAILS)},
    valid AS (SELECT cat.* EXCLUDE (Steam_AppID), CASE WHEN Disabled <> 'YES' AND Steam_AppID <> '' AND coalesce(d_type, '') <> 'game' THEN '' ELSE Steam_AppID END AS Steam_AppID
        FROM cat LEFT JOIN det ON CAST(det.id AS VARCHAR) = Steam_AppID),
    inferred AS (SELECT v.* EXCLUDE (Steam_AppID), CASE WHEN v.Steam_AppID = '' AND Disabled <> 'YES' AND Platform <> 'PlayStation' AND d_type = 'game' THEN CAST(det.id AS VARCHAR)
        ELSE v.Steam_AppID END AS Steam_AppID
        FROM valid v JOIN pin_igdb g ON g.RowId = v.RowId LEFT JOIN det ON g.pin <> '' AND CAST(nullif(g.pin, '') AS BIGINT) % 5 <> 0 AND det.id = CAST(nullif(g.pin, '') AS BIGINT) * 10),
    {_asked('steam', 'inferred', "AND Platform <> 'PlayStation'")}, {steam_sql()}, {_pinned('steam')},
    {_asked('hltb', 'cat')}, {hltb_sql()}, {_pinned('hltb')},
    {_asked('wikidata', 'cat')}, {wikidata_sql()}, {_pinned('wikidata')},
    fz_all AS (WITH {s.fuzzy_cte(_PAIRS)} SELECT * FROM fuzzy)
    SELECT cat.RowId, {_SHOWN}, CASE WHEN steam.asked THEN coalesce(steam.reason, '') ELSE '' END AS Steam_RejectedReason FROM cat {_JOINS}""",
)
def imported_catalog(spark, sf):
    """The whole list through all stages: five searched stores, store pins dropped, implied by other records or searched again, and what was matched."""
    details = spark_frame(spark, sf, DETAILS).withColumns({"id": F.col("id").cast("string"), "d_date": F.concat(F.lit("1 Jan, "), F.col("d_year").cast("string"))})
    facts = {p: spark_frame(spark, sf, t) for p, t in FACTS.items()}
    out = import_catalog(spark_frame(spark, sf, LIST), "p_partkey", searchers(spark, sf), facts, store_details=details, cross_ids=_cross_ids(spark, sf))
    return out.select(*OUT)


_ALL = f"(SELECT DISTINCT title AS term FROM {duck(TITLES)})"


@query("title_search", f"SELECT term, title, CAST(shared AS INT) AS shared FROM {searched_sql(_ALL, duck(TITLES))}")
def title_search(spark, sf):
    """Every title looked up among all titles by the index of words."""
    titles = spark_frame(spark, sf, TITLES).select("title")
    return search_titles(titles.withColumnRenamed("title", "term"), title_index(titles))
