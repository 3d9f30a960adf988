"""Agreement between the sources of a title."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalith.functions.company import company_key_set, company_name_set
from catalith.functions.lists import joined
from catalith.functions.text import genre_set, platform_import_set
from catalith.operators.consensus import (
    actionable_tags,
    canonical_title,
    company_majority,
    company_tags,
    consensus_tags,
    intersection,
    main_genre,
    provider_consensus,
    set_outlier_tags,
    year_outlier_tags,
)
from catalith.operators.columns import columns_with_values
from catalith.workload import sql as s
from catalith.workload.frames import SOURCES, duck, spark_frame
from catalith.workload.registry import query

_PROVIDERS = {"rawg": "RAWG", "igdb": "IGDB", "steam": "Steam", "hltb": "HLTB"}
_YEARS = {"rawg": "RAWG_Year", "igdb": "IGDB_Year", "steam": "Steam_ReleaseYear", "hltb": "HLTB_ReleaseYear"}


def _long(columns: dict[str, str], value: str = "v") -> str:
    """One row per (RowId, provider) of a column set."""
    parts = [f"SELECT RowId, {i} AS pi, '{p}' AS p, {c} AS {value} FROM src" for i, (p, c) in enumerate(columns.items())]
    return " UNION ALL ".join(parts)


def tag_list_sql(parts: str) -> str:
    return f"coalesce(array_to_string({parts}, ', '), '')"


YEAR_TAGS_CTE = f"""yl AS ({_long(_YEARS)}),
    yc AS (SELECT RowId, v, count(*) AS c FROM yl WHERE v IS NOT NULL AND p <> 'steam' GROUP BY RowId, v),
    yn AS (SELECT RowId, sum(c) AS n, max(CASE WHEN c * 2 > tot THEN v END) AS maj FROM
        (SELECT *, sum(c) OVER (PARTITION BY RowId) AS tot FROM yc) GROUP BY RowId),
    ytags AS (SELECT yn.RowId, CASE WHEN n < 2 THEN []::VARCHAR[] WHEN maj IS NULL THEN ['year_no_consensus']
        ELSE list_filter(list('year_outlier:' || p ORDER BY pi) FILTER (WHERE abs(v - maj) > 1), lambda x: true) END AS tags
        FROM yn JOIN yl USING (RowId) GROUP BY yn.RowId, n, maj)"""


@query("year_votes", f"WITH src AS {duck(SOURCES)}, {YEAR_TAGS_CTE} SELECT RowId, {tag_list_sql('tags')} AS tags FROM ytags")
def year_votes(spark, sf):
    return spark_frame(spark, sf, SOURCES).select("RowId", joined(year_outlier_tags(_YEARS)).alias("tags"))


def set_vote_ctes(prefix: str, columns: dict[str, str], item: str, kind: str) -> str:
    """CTEs ending in ``<prefix>tags(RowId, tags)`` and ``<prefix>common(RowId, common)``; ``item`` normalises ``x``."""
    return f"""{prefix}l AS ({_long(columns)}),
    {prefix}i AS (SELECT DISTINCT RowId, pi, p, x FROM (SELECT RowId, pi, p, {item} AS x FROM
        (SELECT RowId, pi, p, unnest(v) AS x FROM {prefix}l) q) WHERE coalesce(x, '') <> ''),
    {prefix}n AS (SELECT RowId, count(DISTINCT p) AS n FROM {prefix}i GROUP BY RowId),
    {prefix}h AS (SELECT RowId, x, count(*) AS c FROM {prefix}i GROUP BY RowId, x),
    {prefix}m AS (SELECT RowId, list(x) AS held FROM {prefix}h JOIN {prefix}n USING (RowId) WHERE c * 2 > n GROUP BY RowId),
    {prefix}o AS (SELECT RowId, pi, p FROM {prefix}i LEFT JOIN {prefix}m USING (RowId) GROUP BY RowId, pi, p, held
        HAVING bool_and(NOT coalesce(list_contains(held, x), false))),
    {prefix}tags AS (SELECT b.RowId, CASE WHEN coalesce(n, 0) < 2 THEN []::VARCHAR[] WHEN held IS NULL THEN ['{kind}_no_consensus']
        ELSE coalesce((SELECT list('{kind}_outlier:' || p ORDER BY pi) FROM {prefix}o o WHERE o.RowId = b.RowId), []) END AS tags
        FROM (SELECT RowId FROM src) b LEFT JOIN {prefix}n USING (RowId) LEFT JOIN {prefix}m USING (RowId)),
    {prefix}common AS (SELECT RowId, list(x ORDER BY x) AS common FROM {prefix}h JOIN {prefix}n USING (RowId) WHERE c = n AND n >= 2 GROUP BY RowId)"""


_XN = s.norm("x")
IMPORT_FAMILY = f"""CASE WHEN contains({_XN}, 'pc') OR contains({_XN}, 'windows') OR contains({_XN}, 'mac') OR contains({_XN}, 'linux') THEN 'pc'
    WHEN contains({_XN}, 'playstation') OR starts_with({_XN}, 'ps') THEN 'playstation' WHEN contains({_XN}, 'xbox') THEN 'xbox'
    WHEN contains({_XN}, 'nintendo') OR contains({_XN}, 'wii') THEN 'nintendo' WHEN contains({_XN}, 'mobile') THEN 'mobile' END"""
PLATFORM_COLUMNS = {p: f"{label}_Platforms" for p, label in _PROVIDERS.items()}
GENRE_COLUMNS = {"rawg": "RAWG_Genres", "igdb": "IGDB_Genres", "steam": "Steam_Tags"}


@query(
    "platform_votes",
    f"""WITH src AS {duck(SOURCES)}, {set_vote_ctes('p', PLATFORM_COLUMNS, IMPORT_FAMILY, 'platform')}
    SELECT RowId, {tag_list_sql('tags')} AS tags, {tag_list_sql('common')} AS common FROM ptags LEFT JOIN pcommon USING (RowId)""",
)
def platform_votes(spark, sf):
    sets = {p: f"__{p}" for p in PLATFORM_COLUMNS}
    df = spark_frame(spark, sf, SOURCES).withColumns({sets[p]: platform_import_set(F.col(c)) for p, c in PLATFORM_COLUMNS.items()})
    return df.select("RowId", joined(set_outlier_tags(sets, "platform")).alias("tags"), joined(intersection(sets)).alias("common"))


@query(
    "genre_votes",
    f"""WITH src AS {duck(SOURCES)}, {set_vote_ctes('g', GENRE_COLUMNS, _XN, 'genre')}
    SELECT RowId, {tag_list_sql('tags')} AS tags, {tag_list_sql('common')} AS common FROM gtags LEFT JOIN gcommon USING (RowId)""",
)
def genre_votes(spark, sf):
    sets = {p: f"__{p}" for p in GENRE_COLUMNS}
    df = spark_frame(spark, sf, SOURCES).withColumns({sets[p]: genre_set(F.col(c)) for p, c in GENRE_COLUMNS.items()})
    return df.select("RowId", joined(set_outlier_tags(sets, "genre")).alias("tags"), joined(intersection(sets)).alias("common"))


def component_ctes(prefix: str, nodes: str, edge: str, min_n: int) -> str:
    """CTEs ending in ``<prefix>best(RowId, n, members, outliers)``: the largest component per row.

    ``nodes``: sub-select with ``RowId, p, ..``; ``edge``: condition on node aliases ``a`` and ``b``.
    """
    return f"""{prefix}v AS (SELECT * FROM {nodes} nn),
    {prefix}e AS (SELECT a.RowId, a.p AS x, b.p AS y FROM {prefix}v a JOIN {prefix}v b ON a.RowId = b.RowId AND ({edge})),
    {prefix}r AS (SELECT RowId, p AS x, p AS y FROM {prefix}v UNION SELECT e.RowId, r.x, e.y FROM {prefix}r r JOIN {prefix}e e
        ON e.RowId = r.RowId AND e.x = r.y),
    {prefix}c AS (SELECT RowId, x, list(y ORDER BY y) AS comp FROM {prefix}r GROUP BY RowId, x),
    {prefix}n AS (SELECT RowId, count(*) AS n, list(p ORDER BY p) AS present FROM {prefix}v GROUP BY RowId),
    {prefix}b AS (SELECT RowId, comp, row_number() OVER (PARTITION BY RowId ORDER BY len(comp) DESC, array_to_string(comp, '+')) AS rn
        FROM {prefix}c),
    {prefix}best AS (SELECT n.RowId, n, present, comp AS members, list_filter(present, lambda q: NOT list_contains(comp, q)) AS outliers,
        len(comp) * 2 > n AND n >= 2 AS has FROM {prefix}n n JOIN {prefix}b b ON b.RowId = n.RowId AND b.rn = 1 WHERE n >= {min_n})"""


NAME_COLUMNS = {p: f"{label}_Name" for p, label in _PROVIDERS.items()}
PROVIDER_NODES = (
    "(SELECT t.RowId, t.p, " + s.norm("t.v") + " AS nrm, y.v AS yr FROM (" + _long(NAME_COLUMNS) + ") t JOIN ("
    + _long(_YEARS) + ") y ON y.RowId = t.RowId AND y.p = t.p WHERE trim(t.v) <> '')"
)
PROVIDER_FUZZY = s.fuzzy_cte(f"SELECT a.nrm AS a, b.nrm AS b FROM {PROVIDER_NODES} a JOIN {PROVIDER_NODES} b ON a.RowId = b.RowId")
PROVIDER_EDGE = (
    "a.p <> b.p AND EXISTS (SELECT 1 FROM fuzzy f WHERE f.a = a.nrm AND f.b = b.nrm AND f.score >= 90) "
    "AND (a.p = 'steam' OR b.p = 'steam' OR coalesce(abs(a.yr - b.yr) <= 1, true))"
)


def provider_ctes(min_n: int) -> str:
    return f"{PROVIDER_FUZZY}, {component_ctes('c', PROVIDER_NODES, PROVIDER_EDGE, min_n)}"


CONS_TAGS = """CASE WHEN cbest.RowId IS NULL THEN []::VARCHAR[] WHEN NOT has THEN ['provider_no_consensus']
    ELSE list_concat(['provider_consensus:' || array_to_string(members, '+')], list_transform(outliers, lambda o: 'provider_outlier:' || o)) END"""
PRESENT_YEARS = (
    "list_filter([CASE WHEN list_contains(present, 'rawg') THEN RAWG_Year END, CASE WHEN list_contains(present, 'igdb') THEN IGDB_Year END, "
    "CASE WHEN list_contains(present, 'steam') THEN Steam_ReleaseYear END, CASE WHEN list_contains(present, 'hltb') THEN HLTB_ReleaseYear END], "
    "lambda y: y IS NOT NULL)"
)
ACTIONABLE = f"""CASE WHEN NOT coalesce(has, false) THEN []::VARCHAR[] ELSE list_concat(
    list_transform(list_filter(outliers, lambda o: list_contains(yt, 'year_outlier:' || o) OR list_contains(pt, 'platform_outlier:' || o)),
        lambda o: 'likely_wrong:' || o),
    CASE WHEN len(outliers) = 0 AND len(list_distinct({PRESENT_YEARS})) >= 2 AND list_max({PRESENT_YEARS}) - list_min({PRESENT_YEARS}) >= 5
        AND len(list_filter({PRESENT_YEARS}, lambda y: len(list_filter({PRESENT_YEARS}, lambda z: z = y)) * 2 > len({PRESENT_YEARS}))) = 0
        THEN ['ambiguous_title_year'] ELSE [] END) END"""


@query(
    "provider_agreement",
    f"""WITH RECURSIVE src AS {duck(SOURCES)}, {YEAR_TAGS_CTE}, {set_vote_ctes('p', PLATFORM_COLUMNS, IMPORT_FAMILY, 'platform')}, {provider_ctes(3)},
    t AS (SELECT src.*, members, outliers, present, has, cbest.RowId IS NOT NULL AS known, {CONS_TAGS} AS ct,
        coalesce(ytags.tags, []) AS yt, ptags.tags AS pt
        FROM src LEFT JOIN cbest ON cbest.RowId = src.RowId LEFT JOIN ytags ON ytags.RowId = src.RowId JOIN ptags ON ptags.RowId = src.RowId)
    SELECT RowId, {tag_list_sql('ct')} AS tags, {tag_list_sql(ACTIONABLE)} AS actionable FROM t""",
)
def provider_agreement(spark, sf):
    sets = {p: f"__p_{p}" for p in PLATFORM_COLUMNS}
    df = spark_frame(spark, sf, SOURCES).withColumns({sets[p]: platform_import_set(F.col(c)) for p, c in PLATFORM_COLUMNS.items()})
    df = provider_consensus(df, NAME_COLUMNS, _YEARS)
    cons = F.col("consensus")
    actionable = actionable_tags(cons, _YEARS, year_outlier_tags(_YEARS), set_outlier_tags(sets, "platform"))
    return df.select("RowId", joined(consensus_tags(cons)).alias("tags"), joined(actionable).alias("actionable"))


_DEVELOPERS = {p: f"{c}_Developers" for p, c in (("steam", "Steam"), ("rawg", "RAWG"), ("igdb", "IGDB"), ("wikidata", "Wikidata"))}
PUBLISHERS = {p: c.replace("Developers", "Publishers") for p, c in _DEVELOPERS.items()}
_DEV_ITEMS = f"(SELECT RowId, p, unnest(v) AS x FROM ({_long(_DEVELOPERS)}))"
_KEYS = s.company_key("x")
_GENERIC = "(games?|software|studios?|interactive|entertainment|publish(ing|er)|digital|media|productions?)"


def company_nodes(columns: dict[str, str]) -> str:
    """(RowId, p, ks): company keys and their variants of every provider."""
    listed = f"(SELECT RowId, p, unnest(v) AS x FROM ({_long(columns)}))"
    return f"""(SELECT RowId, p, list(DISTINCT k) AS ks FROM (
    SELECT RowId, p, {_KEYS} AS k FROM {listed} i1 UNION SELECT RowId, p, regexp_replace({_KEYS}, ' {_GENERIC}$', '') FROM {listed} i2)
    WHERE k <> '' AND k NOT IN ('feral interactive', 'aspyr', 'aspyr media') GROUP BY RowId, p)"""


def company_tags_sql(best: str, kind: str) -> str:
    return f"""CASE WHEN {best}.RowId IS NULL OR len({best}.outliers) = 0 OR ({best}.n >= 3 AND NOT {best}.has) THEN []::VARCHAR[]
        WHEN {best}.has THEN list_concat(['{kind}_disagree'], list_transform({best}.outliers, lambda o: '{kind}_outlier:' || o)) ELSE ['{kind}_disagree'] END"""


SHARED_KEY = "a.p <> b.p AND list_has_any(a.ks, b.ks)"


@query(
    "company_disagreement",
    f"""WITH RECURSIVE src AS {duck(SOURCES)}, {component_ctes('d', company_nodes(_DEVELOPERS), SHARED_KEY, 2)}
    SELECT src.RowId, {tag_list_sql(company_tags_sql('dbest', 'developer'))} AS tags FROM src LEFT JOIN dbest ON dbest.RowId = src.RowId""",
)
def company_disagreement(spark, sf):
    sets = {p: f"__{p}" for p in _DEVELOPERS}
    df = spark_frame(spark, sf, SOURCES).withColumns({sets[p]: company_key_set(F.col(c)) for p, c in _DEVELOPERS.items()})
    return df.select("RowId", joined(company_tags(sets, "developer")).alias("tags"))


_NAME_NODES = f"""(SELECT RowId, p, list(DISTINCT k) AS ks FROM (SELECT RowId, p, lower({s.company('x')}) AS k FROM {_DEV_ITEMS} i1)
    WHERE k <> '' GROUP BY RowId, p)"""


@query(
    "company_majorities",
    f"""WITH RECURSIVE src AS {duck(SOURCES)}, {component_ctes('m', _NAME_NODES, "a.p <> b.p AND list_has_any(a.ks, b.ks)", 2)},
    k AS (SELECT v.RowId, unnest(ks) AS key, len(members) AS size, members FROM mv v JOIN mbest ON mbest.RowId = v.RowId
        WHERE has AND list_contains(members, v.p)),
    g AS (SELECT RowId, key, any_value(members) AS members FROM k GROUP BY RowId, key, size HAVING count(*) = size),
    f AS (SELECT RowId, array_to_string(any_value(members), '+') AS providers, string_agg(key, ', ' ORDER BY key) AS keys FROM g GROUP BY RowId)
    SELECT src.RowId, coalesce(providers, '') AS providers, coalesce(keys, '') AS keys FROM src LEFT JOIN f ON f.RowId = src.RowId""",
)
def company_majorities(spark, sf):
    sets = {p: f"__{p}" for p in _DEVELOPERS}
    df = spark_frame(spark, sf, SOURCES).withColumns({sets[p]: company_name_set(F.col(c)) for p, c in _DEVELOPERS.items()})
    df = df.withColumn("shared", company_majority(sets))
    return df.select("RowId", joined(F.col("shared.providers"), "+").alias("providers"), joined(F.col("shared.keys")).alias("keys"))


_CANON = {"Steam": "Steam_Name", "RAWG": "RAWG_Name", "IGDB": "IGDB_Name", "HLTB": "HLTB_Name"}
CANON_CTE = f"""ct AS (SELECT RowId, pi, p, trim(v) AS title, {s.norm('v')} AS nrm FROM ({_long(_CANON)}) WHERE trim(v) <> ''),
    cg AS (SELECT RowId, nrm, count(*) AS c, min(pi) AS best, arg_min(title, pi) AS title, arg_min(p, pi) AS source,
        string_agg(p, '+' ORDER BY p) AS sources FROM ct GROUP BY RowId, nrm),
    canon AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY RowId ORDER BY c DESC, best) AS rn FROM cg) WHERE rn = 1)"""


@query(
    "canonical_titles",
    f"""WITH src AS {duck(SOURCES)}, {CANON_CTE}
    SELECT src.RowId, coalesce(title, '') AS title, coalesce(source, '') AS source, CAST(coalesce(c, 0) AS INT) AS n,
        CASE WHEN c >= 2 THEN sources ELSE '' END AS sources FROM src LEFT JOIN canon ON canon.RowId = src.RowId""",
)
def canonical_titles(spark, sf):
    df = spark_frame(spark, sf, SOURCES).withColumn("c", canonical_title(_CANON))
    return df.select("RowId", F.col("c.title").alias("title"), F.col("c.source").alias("source"), F.col("c.count").alias("n"), F.col("c.sources").alias("sources"))


_GENRES = {"igdb": "IGDB_Genres", "rawg": "RAWG_Genres", "wikidata": "Wikidata_Genres", "steam": "Steam_Tags"}


@query(
    "main_genres",
    f"""WITH src AS {duck(SOURCES)}, i AS (SELECT RowId, pi, p, trim(unnest(v)) AS x, generate_subscripts(v, 1) AS pos FROM ({_long(_GENRES)})),
    n AS (SELECT *, {_XN} AS nrm FROM i WHERE x <> ''),
    g AS (SELECT RowId, nrm, count(DISTINCT p) AS c, min(pi * 1000 + pos) AS first, arg_min(x, pi * 1000 + pos) AS label,
        string_agg(DISTINCT p, '+' ORDER BY p) AS sources FROM n GROUP BY RowId, nrm),
    r AS (SELECT *, row_number() OVER (PARTITION BY RowId ORDER BY CASE WHEN c >= 2 THEN c ELSE 1 END DESC,
        CASE WHEN c >= 2 THEN nrm END, first) AS rn FROM g)
    SELECT RowId, label, sources FROM r WHERE rn = 1""",
)
def main_genres(spark, sf):
    df = spark_frame(spark, sf, SOURCES).withColumn("g", main_genre(_GENRES))
    return df.select("RowId", F.col("g.label").alias("label"), F.col("g.sources").alias("sources"))


@query(
    "provider_presence",
    f"""SELECT bool_or(trim(RAWG_ID) <> '') AS RAWG_ID, bool_or(trim(IGDB_ID) <> '') AS IGDB_ID, bool_or(trim(Steam_AppID) <> '') AS Steam_AppID,
    bool_or(HLTB_Main IS NOT NULL) AS HLTB_Main, false AS Wikidata_QID FROM {duck(SOURCES)}""",
)
def provider_presence(spark, sf):
    return columns_with_values(spark_frame(spark, sf, SOURCES), ["RAWG_ID", "IGDB_ID", "Steam_AppID", "HLTB_Main", "Wikidata_QID"])
