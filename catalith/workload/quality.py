"""Tags, confidence, validation report, review queue and pin repair."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalith.constants import REPORT_EDITION_TOKENS, ReviewConfig
from catalith.functions.text import genre_set, platform_import_set
from catalith.operators.diagnostics import review_tags
from catalith.operators.matching import pick_best
from catalith.operators.resolve import auto_unpin, plan_actions, retry_query, with_majority
from catalith.operators.review import review_queue
from catalith.operators.validation import validation_report
from catalith.plans.repair import planned_repairs, resolve_pins
from catalith.session import materialize
from catalith.sources.registry import default_registry
from catalith.workload import imports
from catalith.workload import sql as s
from catalith.workload.frames import SOURCES, duck, spark_frame, table
from catalith.workload.registry import query
from catalith.workload.votes import (
    _DEVELOPERS,
    ACTIONABLE,
    CANON_CTE,
    CONS_TAGS,
    GENRE_COLUMNS,
    IMPORT_FAMILY,
    PLATFORM_COLUMNS,
    PUBLISHERS,
    SHARED_KEY,
    YEAR_TAGS_CTE,
    company_nodes,
    company_tags_sql,
    component_ctes,
    provider_ctes,
    set_vote_ctes,
    tag_list_sql,
)

# Titles with matching diagnostics: what an import leaves behind.
_MATCHED = SOURCES.replace(
    "SELECT 'rid:'",
    """SELECT CASE WHEN p_size % 19 = 0 THEN '' ELSE CAST(100 - p_size % 40 AS STRING) END AS RAWG_MatchScore,
    CAST(100 - p_size % 7 AS STRING) AS IGDB_MatchScore, '100' AS Steam_MatchScore, CASE WHEN p_size % 5 = 1 THEN '90' ELSE '' END AS HLTB_MatchScore,
    CASE WHEN p_size % 16 = 0 THEN 'type_dlc' ELSE '' END AS Steam_RejectedReason, '' AS HLTB_Query,
    CASE WHEN p_size % 21 = 0 THEN 'wikidata_hint, junk' WHEN p_size % 10 = 1 THEN 'autounpinned:steam' ELSE '' END AS ReviewTags, '' AS MatchConfidence,
    'rid:'""",
    1,
)


def _diagnosed(spark, sf):
    """Matched names and the facts of the pinned payloads."""
    df = spark_frame(spark, sf, _MATCHED)
    names = {f"{p}_MatchedName": F.col(f"{p}_Name") for p in ("RAWG", "IGDB", "Steam", "HLTB")}
    facts = {
        "rawg_year": F.col("RAWG_Year"), "igdb_year": F.col("IGDB_Year"), "steam_year": F.col("Steam_ReleaseYear"), "hltb_year": F.col("HLTB_ReleaseYear"),
        **{f"{p.lower()}_platforms": platform_import_set(F.col(f"{p}_Platforms")) for p in ("RAWG", "IGDB", "Steam", "HLTB")},
        "rawg_genres": genre_set(F.col("RAWG_Genres")), "igdb_genres": genre_set(F.col("IGDB_Genres")),
        "igdb_steam_id": F.col("IGDB_SteamAppID"), "igdb_related": F.col("IGDB_VersionParent") != "", "steam_type": F.col("Steam_StoreType"),
    }
    return df.withColumns({**names, **facts})


def _pinned(pin: str, column: str, empty: str = "NULL") -> str:
    return f"CASE WHEN {pin} NOT IN ('', '__NOT_FOUND__') THEN {column} ELSE {empty} END AS {column}"


_PIN = {"RAWG": "RAWG_ID", "IGDB": "IGDB_ID", "Steam": "Steam_AppID", "HLTB": "HLTB_ID"}
_MASKED = ", ".join(
    [_pinned(_PIN[p], c) for p, c in (("RAWG", "RAWG_Year"), ("IGDB", "IGDB_Year"), ("Steam", "Steam_ReleaseYear"), ("HLTB", "HLTB_ReleaseYear"))]
    + [_pinned(_PIN[p], f"{p}_Platforms", "[]") for p in _PIN]
    + [_pinned(_PIN[p], f"{p}_Genres", "[]") for p in ("RAWG", "IGDB")]
    + [_pinned("IGDB_ID", "IGDB_SteamAppID"), _pinned("IGDB_ID", "IGDB_VersionParent", "''"), _pinned("Steam_AppID", "Steam_StoreType", "''")]
)
_REPLACED = "RAWG_Year, IGDB_Year, Steam_ReleaseYear, HLTB_ReleaseYear, RAWG_Platforms, IGDB_Platforms, Steam_Platforms, HLTB_Platforms, RAWG_Genres, IGDB_Genres, IGDB_SteamAppID, IGDB_VersionParent, Steam_StoreType"
_SRC = f"src AS (SELECT * EXCLUDE ({_REPLACED}), {_MASKED} FROM {duck(_MATCHED)})"
_X = s.norm("x")


def _import_numbers(x: str) -> str:
    n = s.norm(x)
    return f"list_sort(list_distinct(list_filter({s.tokens(n)}, lambda w: regexp_full_match(w, '[1-9]|[1-4]\\d|50'))))"


def _opt(cond: str, tag: str) -> str:
    return f"CASE WHEN {cond} THEN {tag} END"


_MISSING_STORE = "(Steam_AppID = '' AND Platform <> 'PlayStation')"
_NO_PC = "(len(others) > 0 AND NOT list_contains(others, 'pc'))"
_DISAGREE = "coalesce(Steam_AppID <> '' AND regexp_full_match(IGDB_SteamAppID, '\\d+') AND IGDB_SteamAppID <> Steam_AppID, false)"
_SERIES = f"(Steam_AppID <> '' AND Steam_Name <> '' AND {_import_numbers('Name')} <> {_import_numbers('Steam_Name')})"
_TYPE = "(Steam_AppID <> '' AND Steam_Name <> '' AND Steam_StoreType NOT IN ('', 'game'))"
_GENRES = "(len(rg) > 0 AND len(ig) > 0 AND NOT list_has_any(rg, ig))"
_HEAD = ", ".join(
    [
        _opt("Disabled = 'YES'", "'disabled'"),
        _opt("RAWG_ID = '__NOT_FOUND__'", "'rawg_not_found'"), _opt("RAWG_ID = ''", "'missing_rawg'"),
        _opt("RAWG_ID NOT IN ('', '__NOT_FOUND__') AND RAWG_Name = ''", "'rawg_id_unresolved'"),
        _opt("IGDB_ID = ''", "'missing_igdb'"), _opt("IGDB_ID <> '' AND IGDB_Name = ''", "'igdb_id_unresolved'"),
        _opt(f"{_MISSING_STORE} AND Steam_RejectedReason <> ''", "'steam_rejected'"),
        _opt(f"{_MISSING_STORE} AND Steam_RejectedReason <> ''", "'steam_rejected:' || Steam_RejectedReason"),
        _opt("Steam_AppID <> '' AND Steam_Name = ''", "'steam_id_unresolved'"),
        _opt("HLTB_Name = ''", "'missing_hltb'"), _opt(_DISAGREE, "'steam_appid_disagree:igdb'"),
        *[_opt(f"{c} <> '' AND CAST(nullif({c}, '') AS INT) < 100", f"'{p}_score:' || {c}") for p, c in (("rawg", "RAWG_MatchScore"), ("igdb", "IGDB_MatchScore"), ("steam", "Steam_MatchScore"), ("hltb", "HLTB_MatchScore"))],
        _opt(f"{_MISSING_STORE} AND {_NO_PC}", "'missing_steam_nonpc'"), _opt(f"{_MISSING_STORE} AND NOT {_NO_PC}", "'missing_steam'"),
    ]
)
_SCORE_VALUES = ("RAWG_MatchScore", "IGDB_MatchScore", "Steam_MatchScore", "HLTB_MatchScore")
_LOW_SCORE = " OR ".join(f"coalesce(CAST(nullif({c}, '') AS INT) < 80, false)" for c in _SCORE_VALUES)
_MID_SCORE = " OR ".join(f"coalesce(CAST(nullif({c}, '') AS INT) BETWEEN 80 AND 94, false)" for c in _SCORE_VALUES)
_WEAK = f"""(len(yt) > 0 AND len(list_filter(yt, lambda t: t <> 'year_outlier:steam')) = 0 AND NOT coalesce(list_contains(outliers, 'steam'), false)
    AND NOT list_contains(pt, 'platform_outlier:steam') AND NOT {_DISAGREE})"""
_TAGGED_CTES = f"""{_SRC}, {YEAR_TAGS_CTE}, {set_vote_ctes('p', PLATFORM_COLUMNS, IMPORT_FAMILY, 'platform')},
    {set_vote_ctes('g', GENRE_COLUMNS, _X, 'genre')}, {provider_ctes(2)},
    oth AS (SELECT RowId, list(DISTINCT x) AS others FROM pi WHERE p <> 'steam' GROUP BY RowId),
    gen AS (SELECT RowId, list(x) FILTER (WHERE p = 'rawg') AS rg, list(x) FILTER (WHERE p = 'igdb') AS ig FROM gi GROUP BY RowId),
    base AS (SELECT src.*, coalesce(others, []) AS others, coalesce(rg, []) AS rg, coalesce(ig, []) AS ig, members, outliers, present, has,
        {CONS_TAGS} AS ct, cbest.RowId IS NOT NULL AS known, coalesce(ytags.tags, []) AS yt, ptags.tags AS pt
        FROM src LEFT JOIN cbest ON cbest.RowId = src.RowId LEFT JOIN ytags ON ytags.RowId = src.RowId JOIN ptags ON ptags.RowId = src.RowId
        LEFT JOIN oth ON oth.RowId = src.RowId LEFT JOIN gen ON gen.RowId = src.RowId),
    acted AS (SELECT *, {ACTIONABLE} AS act FROM base),
    listed AS (SELECT *, list_concat(list_filter([{_HEAD}], lambda t: t IS NOT NULL), pt,
        CASE WHEN list_contains(yt, 'year_outlier:steam') AND IGDB_VersionParent <> '' THEN ['edition_or_port_suspected'] ELSE [] END, ct, yt,
        CASE WHEN {_GENRES} THEN ['genre_disagree'] ELSE [] END, act,
        list_filter([{_opt(_SERIES, "'steam_series_mismatch'")}, {_opt(_TYPE, "'store_type_not_game:' || Steam_StoreType")}], lambda t: t IS NOT NULL),
        CASE WHEN starts_with(ReviewTags, 'wikidata_hint') THEN ['wikidata_hint'] WHEN ReviewTags <> '' THEN [ReviewTags] ELSE [] END) AS tags FROM acted),
    tagged AS (SELECT *, CASE WHEN Disabled = 'YES' THEN '' WHEN (RAWG_ID NOT IN ('', '__NOT_FOUND__') AND RAWG_Name = '') OR (IGDB_ID <> '' AND IGDB_Name = '')
        OR (Steam_AppID <> '' AND Steam_Name = '') OR ({_MISSING_STORE} AND Steam_RejectedReason <> '') OR {_DISAGREE} OR {_LOW_SCORE} OR len(pt) > 0
        OR (known AND NOT has) OR (len(yt) > 0 AND NOT {_WEAK}) OR len(act) > 0 OR {_SERIES} OR {_TYPE} THEN 'LOW'
        WHEN RAWG_ID = '' OR IGDB_ID = '' OR HLTB_Name = '' OR ({_MISSING_STORE} AND NOT {_NO_PC}) OR {_MID_SCORE} OR (has AND len(outliers) > 0) OR {_WEAK}
        OR {_GENRES} THEN 'MEDIUM' ELSE 'HIGH' END AS conf FROM listed)"""


@query(
    "import_tags",
    f"WITH RECURSIVE {_TAGGED_CTES} SELECT RowId, {tag_list_sql('tags')} AS ReviewTags, conf AS MatchConfidence FROM tagged",
)
def import_tags(spark, sf):
    return review_tags(_diagnosed(spark, sf)).select("RowId", "ReviewTags", "MatchConfidence")


def _tagged(spark, sf, majority: bool = False):
    """Tagged titles as an import stores them: written once, so later filters meet plain columns."""
    years = {"RAWG_MatchedYear": "RAWG_Year", "IGDB_MatchedYear": "IGDB_Year", "Steam_MatchedYear": "Steam_ReleaseYear", "HLTB_MatchedYear": "HLTB_ReleaseYear"}
    tagged = review_tags(_diagnosed(spark, sf)).withColumns({c: F.col(y) for c, y in years.items()})
    stored = materialize(tagged, "tagged")
    return materialize(with_majority(stored), "majority") if majority else stored


_POINTS = """list_sum(list_transform(list_concat([''], tags), lambda t: CASE WHEN starts_with(t, 'likely_wrong:') THEN 40 WHEN starts_with(t, 'provider_outlier:') THEN 12
    WHEN t IN ('steam_appid_disagree:igdb', 'steam_appid_disagree:rawg', 'steam_rejected') THEN 10 WHEN starts_with(t, 'year_outlier:') OR starts_with(t, 'platform_outlier:') THEN 6
    WHEN t IN ('genre_disagree', 'ambiguous_title_year') THEN 4 ELSE 0 END)) + CASE conf WHEN 'LOW' THEN 50 WHEN 'MEDIUM' THEN 20 ELSE 0 END"""
_OUTLIER = "len(list_filter(tags, lambda t: starts_with(t, 'likely_wrong:') OR starts_with(t, 'provider_outlier:') OR starts_with(t, 'year_outlier:') OR starts_with(t, 'platform_outlier:'))) > 0"
_SUGGEST = " ".join(f"WHEN {p}_Name <> '' AND {s.norm(p + '_Name')} <> {s.norm('Name')} THEN {p}_Name" for p in ("IGDB", "RAWG", "Steam", "HLTB"))


@query(
    "review_queue",
    f"""WITH RECURSIVE {_TAGGED_CTES}, q AS (SELECT *, {_POINTS} AS points FROM tagged WHERE Disabled <> 'YES' AND (conf IN ('LOW', 'MEDIUM') OR {_OUTLIER})
        ORDER BY points DESC, Name, RowId LIMIT 200)
    SELECT RowId, Name, conf AS MatchConfidence, {tag_list_sql('tags')} AS ReviewTags, CASE {_SUGGEST} ELSE '' END AS SuggestedTitle,
    CASE WHEN Steam_AppID <> '' THEN 'https://store.steampowered.com/app/' || Steam_AppID || '/' ELSE '' END AS Steam_URL,
    CASE WHEN HLTB_ID <> '' THEN 'https://howlongtobeat.com/game/' || HLTB_ID ELSE '' END AS HLTB_URL, p_partkey AS RAWG_RatingsCount FROM q""",
)
def queue_for_review(spark, sf):
    """The review queue is a top-200 by design. It carries a context column from the enriched table."""
    tagged = _tagged(spark, sf).select(
        "RowId", "Name", "Disabled", "ReviewTags", "MatchConfidence", "Steam_AppID", "HLTB_ID", *[f"{p}_MatchedName" for p in ("RAWG", "IGDB", "Steam", "HLTB")]
    )
    enriched = spark_frame(spark, sf, SOURCES).select("RowId", F.col("p_partkey").alias("RAWG_Website"))
    out = review_queue(tagged, default_registry(), enriched, ReviewConfig())
    return out.select("RowId", "Name", "MatchConfidence", "ReviewTags", "SuggestedTitle", "Steam_URL", "HLTB_URL", F.col("RAWG_Website").alias("RAWG_RatingsCount"))


def _wrong(p: str, pin: str) -> str:
    return f"({pin} NOT IN ('', '__NOT_FOUND__') AND coalesce(has, false) AND list_contains(tags, 'provider_outlier:{p}') AND list_contains(tags, 'likely_wrong:{p}'))"


_UNPIN_TAGS = "tags"
for _p, _pin in (("steam", "Steam_AppID"), ("rawg", "RAWG_ID"), ("igdb", "IGDB_ID"), ("hltb", "HLTB_ID")):
    _UNPIN_TAGS = f"list_concat({_UNPIN_TAGS}, CASE WHEN {_wrong(_p, _pin)} AND NOT list_contains(tags, 'autounpinned:{_p}') THEN ['autounpinned:{_p}'] ELSE [] END)"


@query(
    "auto_unpin",
    f"""WITH RECURSIVE {_TAGGED_CTES} SELECT RowId, {', '.join(f"CASE WHEN {_wrong(p, pin)} THEN '' ELSE {pin} END AS {pin}" for p, pin in (('steam', 'Steam_AppID'), ('rawg', 'RAWG_ID'), ('igdb', 'IGDB_ID'), ('hltb', 'HLTB_ID')))},
    CASE WHEN {_wrong('igdb', 'IGDB_ID')} THEN '' ELSE IGDB_Name END AS IGDB_MatchedName, {tag_list_sql(_UNPIN_TAGS)} AS ReviewTags FROM tagged""",
)
def unpinned(spark, sf):
    out = auto_unpin(_tagged(spark, sf))
    pins = [F.coalesce(c, F.lit("")).alias(c) for c in ("Steam_AppID", "RAWG_ID", "IGDB_ID", "HLTB_ID", "IGDB_MatchedName")]
    return out.select("RowId", *pins, "ReviewTags")


_MAJ_NODES = "(SELECT RowId, p, t FROM (SELECT RowId, p, v AS t FROM (SELECT RowId, 'rawg' AS p, RAWG_Name AS v FROM src UNION ALL SELECT RowId, 'igdb', IGDB_Name FROM src UNION ALL SELECT RowId, 'steam', Steam_Name FROM src UNION ALL SELECT RowId, 'hltb', HLTB_Name FROM src)) WHERE t <> '')"
_NAME_PAIRS = f"SELECT {s.norm('src.Name')} AS a, {s.norm('n.t')} AS b FROM src JOIN {_MAJ_NODES} n ON n.RowId = src.RowId"


_YEAR_OF = {"rawg": "RAWG_Year", "igdb": "IGDB_Year", "hltb": "HLTB_ReleaseYear"}
_VOTES = " UNION ALL ".join(f"SELECT src.RowId, {y} AS v FROM src JOIN cbest c ON c.RowId = src.RowId WHERE has AND list_contains(members, '{p}') AND {y} IS NOT NULL" for p, y in _YEAR_OF.items())

@query(
    "majority_titles",
    f"""WITH RECURSIVE src AS {duck(_MATCHED)}, {provider_ctes(2)},
    f2 AS (SELECT * FROM (WITH {s.fuzzy_cte(_NAME_PAIRS)} SELECT a, b, score FROM fuzzy)),
    m AS (SELECT c.RowId, n.t, n.p, score FROM cbest c JOIN {_MAJ_NODES} n ON n.RowId = c.RowId AND list_contains(members, n.p) JOIN src ON src.RowId = c.RowId
        JOIN f2 ON f2.a = {s.norm('src.Name')} AND f2.b = {s.norm('n.t')} WHERE has),
    t AS (SELECT RowId, arg_max(t, (score, CASE p WHEN 'hltb' THEN 4 WHEN 'igdb' THEN 3 WHEN 'rawg' THEN 2 ELSE 1 END)) AS majority_title FROM m GROUP BY RowId),
    v AS ({_VOTES}), y AS (SELECT RowId, CASE WHEN max(n) >= 2 THEN max(v) FILTER (c * 2 > n) END AS majority_year FROM
        (SELECT RowId, v, count(*) AS c, sum(count(*)) OVER (PARTITION BY RowId) AS n FROM v GROUP BY RowId, v) GROUP BY RowId)
    SELECT src.RowId, coalesce(majority_title, '') AS majority_title, CAST(majority_year AS INT) AS majority_year FROM src LEFT JOIN t ON t.RowId = src.RowId LEFT JOIN y ON y.RowId = src.RowId""",
)
def majority_titles(spark, sf):
    df = _diagnosed(spark, sf).withColumns({f"{p}_MatchedYear": F.col(c) for p, c in (("RAWG", "RAWG_Year"), ("IGDB", "IGDB_Year"), ("Steam", "Steam_ReleaseYear"), ("HLTB", "HLTB_ReleaseYear"))})
    return with_majority(df).select("RowId", F.coalesce("majority_title", F.lit("")).alias("majority_title"), "majority_year")


_MAJORITY = f"""maj AS (WITH RECURSIVE src AS {duck(_MATCHED)}, {provider_ctes(2)},
    f2 AS (SELECT * FROM (WITH {s.fuzzy_cte(_NAME_PAIRS)} SELECT a, b, score FROM fuzzy)),
    m AS (SELECT c.RowId, n.t, n.p, score FROM cbest c JOIN {_MAJ_NODES} n ON n.RowId = c.RowId AND list_contains(members, n.p) JOIN src ON src.RowId = c.RowId
        JOIN f2 ON f2.a = {s.norm('src.Name')} AND f2.b = {s.norm('n.t')} WHERE has),
    t AS (SELECT RowId, arg_max(t, (score, CASE p WHEN 'hltb' THEN 4 WHEN 'igdb' THEN 3 WHEN 'rawg' THEN 2 ELSE 1 END)) AS majority_title FROM m GROUP BY RowId),
    v AS ({_VOTES}), y AS (SELECT RowId, CASE WHEN max(n) >= 2 THEN max(v) FILTER (c * 2 > n) END AS majority_year FROM
        (SELECT RowId, v, count(*) AS c, sum(count(*)) OVER (PARTITION BY RowId) AS n FROM v GROUP BY RowId, v) GROUP BY RowId)
    SELECT t.RowId, majority_title, majority_year FROM t LEFT JOIN y USING (RowId))"""
_PIN_NAMES = {"steam": "Steam_AppID", "rawg": "RAWG_ID", "igdb": "IGDB_ID"}
_TARGET_ROWS = " UNION ALL ".join(
    f"""SELECT RowId, Name, '{p}' AS provider, majority_title, majority_year, CASE WHEN {_wrong(p, pin)} THEN 'fix_wrong_pin'
        WHEN {pin} = '' AND list_contains(tags, 'autounpinned:{p}') THEN 'fill_after_unpin' WHEN {pin} = '' THEN 'fill_missing' END AS reason
        FROM tagged JOIN maj USING (RowId) WHERE Disabled <> 'YES'""" for p, pin in _PIN_NAMES.items()
)
_RETRIES = f"""rq AS (SELECT RowId, majority_title AS target, unnest([majority_title, Steam_Name, RAWG_Name, IGDB_Name]) AS title, unnest([0, 1, 2, 3]) AS pos FROM tagged JOIN maj USING (RowId)),
    rn_ AS (SELECT *, {s.norm('target')} AS a, {s.norm('title')} AS b FROM rq WHERE trim(title) <> ''),
    rf AS (WITH {s.fuzzy_cte('SELECT a, b FROM rn_')} SELECT * FROM fuzzy),
    retry AS (SELECT RowId, arg_max(title, (score, -length(title), -pos)) AS name FROM rn_ JOIN rf USING (a, b) GROUP BY RowId),
    ask AS (SELECT retry.RowId, retry.name, coalesce(majority_year, TRY_CAST(nullif(regexp_extract(src.Name, '\\((19\\d\\d|20\\d\\d)\\)', 1), '') AS INT)) AS year_hint
        FROM retry JOIN maj USING (RowId) JOIN src USING (RowId)),
    {', '.join(f"ask_{p} AS (SELECT DISTINCT name || '|' || coalesce(CAST(year_hint AS VARCHAR), '') AS row_id, name, year_hint FROM ask JOIN (SELECT RowId FROM target WHERE provider = '{p}') USING (RowId))" for p in _PIN_NAMES)}"""
_OFFERED = " UNION ALL ".join(
    f"""SELECT RowId, '{p}' AS provider, f.id, m_name, m_year FROM ask JOIN sel_{p} s ON s.row_id = name || '|' || coalesce(CAST(year_hint AS VARCHAR), '')
        JOIN {duck(imports.FACTS[p])} f ON f.id = s.id""" for p in _PIN_NAMES
)
_NEAR_PAIRS = f"SELECT {s.norm('majority_title')} AS a, {s.norm('m_name')} AS b FROM offered UNION SELECT {s.norm('Name')}, {s.norm('m_name')} FROM offered"
_ACTIONS = f"""{_TAGGED_CTES}, {_MAJORITY}, target AS (SELECT * FROM ({_TARGET_ROWS}) WHERE reason IS NOT NULL), {_RETRIES},
    {imports.rawg_sql()}, {imports.igdb_sql()}, {imports.steam_sql()},
    offered AS (SELECT t.*, o.id, m_name, m_year FROM target t JOIN ({_OFFERED}) o USING (RowId, provider)), nf AS (WITH {s.fuzzy_cte(_NEAR_PAIRS)} SELECT * FROM fuzzy),
    judged AS (SELECT o.RowId, o.provider, o.id, m_name, m_year, g.score >= 90 OR coalesce(abs(m_year - majority_year) <= 1, true) AS repin, w.score AS own
        FROM offered o JOIN nf g ON g.a = {s.norm('majority_title')} AND g.b = {s.norm('m_name')} JOIN nf w ON w.a = {s.norm('o.Name')} AND w.b = {s.norm('m_name')}),
    acts AS (SELECT t.RowId, t.provider, reason, CASE WHEN coalesce(repin, false) THEN 'repin' WHEN reason = 'fix_wrong_pin' THEN 'unpin' ELSE 'keep' END AS action,
        CASE WHEN repin THEN id END AS new_id, CASE WHEN repin THEN m_name END AS new_name, CASE WHEN repin THEN CAST(m_year AS VARCHAR) END AS new_year, CASE WHEN repin THEN own END AS new_score
        FROM target t LEFT JOIN judged j ON j.RowId = t.RowId AND j.provider = t.provider)"""


def _repairs(spark, sf) -> dict:
    """Arguments of a resolve run over all titles: re-matches are searched in the three stores of an import by the index of title words."""
    years = {"RAWG_MatchedYear": "RAWG_Year", "IGDB_MatchedYear": "IGDB_Year", "Steam_MatchedYear": "Steam_ReleaseYear", "HLTB_MatchedYear": "HLTB_ReleaseYear"}
    catalog = _diagnosed(spark, sf).withColumns({c: F.col(y) for c, y in years.items()})

    def named(provider, search):
        facts = spark_frame(spark, sf, imports.FACTS[provider]).select(F.col("id").alias("_id"), F.col("m_name").alias("new_name"), F.col("m_year").alias("new_year"))
        return lambda queries: search(queries).join(facts, F.col("id").cast("string") == F.col("_id"))

    searches = {p: named(p, search) for p, search in imports.searchers(spark, sf, tuple(_PIN_NAMES)).items()}
    return {"catalog": catalog, "searchers": searches, "titles": [F.array("Steam_Name", "RAWG_Name"), F.array("IGDB_Name")], "retry_missing": True}


@query(
    "resolve_actions",
    f"WITH RECURSIVE {_ACTIONS} SELECT RowId, provider, reason, action, coalesce(new_id, '') AS new_id, coalesce(new_name, '') AS new_name, coalesce(new_year, '') AS new_year, new_score FROM acts",
)
def resolve_actions(spark, sf):
    """Every pin that is contradicted, was taken off or is missing: what its search among all records of its store leads to."""
    _, actions, _ = planned_repairs(**_repairs(spark, sf))
    texts = [F.coalesce(c, F.lit("")).alias(c) for c in ("new_id", "new_name", "new_year")]
    return actions.select("RowId", "provider", "reason", "action", *texts, "new_score")


@query(
    "resolve_stats",
    f"""WITH RECURSIVE {_ACTIONS} SELECT count(*) AS attempted, count(*) FILTER (action = 'repin') AS repinned, count(*) FILTER (action = 'unpin') AS unpinned,
    count(*) FILTER (action = 'keep') AS kept, 0::BIGINT AS wikidata_hint_added FROM acts""",
)
def stats_of_resolution(spark, sf):
    """Counts of a run that changes nothing."""
    return resolve_pins(**_repairs(spark, sf))[1]


def _applied(p: str, pin: str) -> str:
    label = {"steam": "Steam", "rawg": "RAWG", "igdb": "IGDB"}[p]
    return f"""coalesce(CASE {p}.action WHEN 'repin' THEN {p}.new_id WHEN 'unpin' THEN '' ELSE {pin} END, {pin}) AS {pin},
        coalesce(CASE {p}.action WHEN 'repin' THEN {p}.new_name WHEN 'unpin' THEN '' ELSE {label}_Name END, {label}_Name) AS {label}_MatchedName"""


@query(
    "resolved_catalog",
    f"""WITH RECURSIVE {_ACTIONS} SELECT src.RowId, {', '.join(_applied(p, pin) for p, pin in _PIN_NAMES.items())}
    FROM src {' '.join(f"LEFT JOIN acts {p} ON {p}.RowId = src.RowId AND {p}.provider = '{p}'" for p in _PIN_NAMES)}""",
)
def resolved_catalog(spark, sf):
    """The catalog after a run that writes its repairs: pins and matched names of every row."""
    out = resolve_pins(**_repairs(spark, sf), apply=True)[0]
    columns = [c for p, pin in _PIN_NAMES.items() for c in (pin, f"{imports.LABELS[p]}_MatchedName")]
    return out.select("RowId", *[F.coalesce(c, F.lit("")).alias(c) for c in columns])


_RETRY = f"""o AS (SELECT RowId, Name AS target, unnest([RAWG_Name, IGDB_Name, Steam_Name, HLTB_Name]) AS title, unnest([0, 1, 2, 3]) AS pos FROM src),
    n AS (SELECT *, {s.norm('target')} AS a, {s.norm('title')} AS b FROM o WHERE trim(title) <> '')"""


@query(
    "retry_queries",
    f"""WITH src AS {duck(SOURCES)}, {_RETRY}, {s.fuzzy_cte('SELECT a, b FROM n')}
    SELECT RowId, arg_max(title, (score, -length(title), -pos)) AS retry_query FROM n JOIN fuzzy USING (a, b) GROUP BY RowId""",
)
def retry_queries(spark, sf):
    """The sources' title nearest to the row's own, as the text to search again with."""
    titles = [F.array("RAWG_Name", "IGDB_Name"), F.array("Steam_Name", "HLTB_Name")]
    return retry_query(spark_frame(spark, sf, SOURCES), titles, F.col("Name"))


_TARGETS = f"""SELECT RowId, p_partkey, Name, CASE WHEN p_size % 9 = 0 THEN NULL ELSE IGDB_Name END AS majority_title, CAST(RAWG_Year AS INT) AS majority_year,
    CASE p_size % 3 WHEN 0 THEN 'fix_wrong_pin' WHEN 1 THEN 'fill_after_unpin' ELSE 'fill_missing' END AS reason FROM ({SOURCES}) s WHERE RAWG_Year IS NOT NULL"""
_OFFERS = """SELECT RowId, p_partkey, Name, majority_title, majority_year, q.k AS id, q.cand_name, CASE WHEN q.k % 4 = 0 THEN NULL ELSE 1992 + q.k % 7 END AS cand_year
    FROM t JOIN (SELECT p_partkey AS k, p_name AS cand_name FROM part) q ON q.k BETWEEN t.p_partkey - 1 AND t.p_partkey + 1 AND t.p_partkey % 10 <> 0"""
_GOAL = "coalesce(nullif(majority_title, ''), Name)"


@query(
    "resolve_plan",
    f"""WITH t AS {duck(_TARGETS)}, offers AS ({_OFFERS}),
    best AS (SELECT * FROM (WITH {s.adjusted_cte(f"(SELECT RowId AS row_id, {_GOAL} AS name, majority_year AS year_hint, id, cand_name, cand_year FROM offers)")},
        r AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY {s.RANK}) AS rn FROM scored) SELECT row_id, id, cand_name, cand_year, raw FROM r WHERE rn = 1)),
    j AS (SELECT t.*, id, cand_name, id IS NOT NULL AND (coalesce(raw, 0) >= 90 OR coalesce(abs(cand_year - majority_year) <= 1, true)) AS repin FROM t LEFT JOIN best ON row_id = RowId)
    SELECT RowId, reason, CASE WHEN repin THEN 'repin' WHEN reason = 'fix_wrong_pin' THEN 'unpin' ELSE 'keep' END AS action,
    coalesce(CASE WHEN repin THEN CAST(id AS VARCHAR) END, '') AS new_id, coalesce(CASE WHEN repin THEN cand_name END, '') AS new_name FROM j""",
)
def resolve_plan(spark, sf):
    """Pins tried again with the ranking search over the titles near by: repinned when title or year is near, else taken off or kept."""
    targets = spark_frame(spark, sf, _TARGETS).withColumn("provider", F.lit("igdb"))
    titles = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("cand_name"))
    near = targets.where("p_partkey % 10 <> 0").withColumn("id", F.explode(F.sequence(F.col("p_partkey") - 1, F.col("p_partkey") + 1)))
    offers = near.join(titles, "id").withColumns(
        {"goal": F.coalesce(F.nullif("majority_title", F.lit("")), F.col("Name")), "cand_year": F.when(F.col("id") % 4 != 0, 1992 + F.col("id") % 7).cast("int")}
    )
    found = pick_best(offers, ["RowId"], "goal", "cand_name", "id", ["id", "cand_name", "cand_year"], "majority_year", "cand_year").select(
        "RowId", F.lit("igdb").alias("provider"), F.col("id").cast("string").alias("new_id"), F.col("cand_name").alias("new_name"), F.col("cand_year").alias("new_year")
    )
    actions = plan_actions(targets.drop("p_partkey"), found)
    return actions.select("RowId", "reason", "action", F.coalesce("new_id", F.lit("")).alias("new_id"), F.coalesce("new_name", F.lit("")).alias("new_name"))


_REPORT_FAMILY = """CASE WHEN contains(lower(x), 'pc') OR contains(lower(x), 'windows') THEN 'pc' WHEN contains(lower(x), 'playstation') OR starts_with(lower(x), 'ps') THEN 'playstation'
    WHEN contains(lower(x), 'xbox') THEN 'xbox' WHEN contains(lower(x), 'nintendo') OR contains(lower(x), 'switch') OR contains(lower(x), 'wii') THEN 'nintendo'
    WHEN contains(lower(x), 'mac') THEN 'mac' WHEN contains(lower(x), 'linux') THEN 'linux' ELSE lower(trim(x)) END"""


_NAMES = ("RAWG", "IGDB", "Steam", "HLTB")
_NORMS = ", ".join(f"{s.norm(p + '_Name')} AS n_{p}" for p in _NAMES)
_ED = {p: s.editions(f"n_{p}") for p in _NAMES}
_RS = {
    p: f"list_sort(list_distinct(list_transform(list_filter({s.tokens('n_' + p)}, lambda w: regexp_full_match(w, '0*([1-9]|[1-4]\\d|50)')), lambda w: CAST(w AS INT))))"
    for p in _NAMES
}


def _summary(parts: dict[str, str]) -> str:
    items = ", ".join(f"CASE WHEN len({v}) > 0 THEN '{p}:' || array_to_string({v}, ',') END" for p, v in parts.items())
    return f"array_to_string(list_filter([{items}], lambda t: t IS NOT NULL), '; ')"


def _distinct_sets(parts: dict[str, str], shown: dict[str, str]) -> str:
    items = ", ".join(f"CASE WHEN {shown[p]} THEN array_to_string({v}, ',') END" for p, v in parts.items())
    return f"len(list_distinct(list_filter([{items}], lambda t: t IS NOT NULL)))"


_REPORT_PLATFORMS = {p.lower(): f"{p}_Platforms" for p in _NAMES}
_SHOWN = " ".join(f"WHEN '{p.lower()}' THEN '{p}'" for p in _NAMES)
_SCORED = " UNION ALL ".join(f"SELECT nn AS a, n_{p} AS b FROM src WHERE trim({p}_Name) <> ''" for p in _NAMES)
_SCORES = ", ".join(f"(SELECT score FROM sc WHERE a = nn AND b = n_{p} AND trim({p}_Name) <> '') AS s_{p}" for p in _NAMES)
_RANKED = ", ".join(f"CASE WHEN s_{p} IS NOT NULL THEN struct_pack(v := s_{p}, k := {k}, p := '{p}') END" for k, p in enumerate(_NAMES))
_WORST = f"list_sort(list_filter([{_RANKED}], lambda t: t IS NOT NULL))[1]"
_TITLED = {p: f"trim({p}_Name) <> ''" for p in _NAMES}
_DATED = {"RAWG": "RAWG_Year", "IGDB": "IGDB_Year", "Steam": "Steam_ReleaseYear", "HLTB": "HLTB_ReleaseYear"}
_YEARS_SHOWN = "array_to_string(list_filter([" + ", ".join(f"'{p}:' || {y}" for p, y in _DATED.items()) + "], lambda t: t IS NOT NULL), '; ')"
_EDITION_OR_PORT = s.overlap(s.tokens("n_Steam"), s.words(REPORT_EDITION_TOKENS))


def _set_texts(prefix: str, label: str) -> str:
    """CTE ``<prefix>txt``: ``A:x,y; B:z`` of the sets of each row."""
    return f"""{prefix}txt AS (SELECT RowId, string_agg({label} || ':' || xs, '; ' ORDER BY pi) AS txt, count(*) AS voters
        FROM (SELECT RowId, pi, p, string_agg(x, ',' ORDER BY x) AS xs FROM {prefix}i GROUP BY RowId, pi, p) GROUP BY RowId)"""


_SURE = "agreed OR (Steam_AppID <> '' AND IGDB_SteamAppID <> '' AND Steam_AppID = IGDB_SteamAppID)"
_FLAGS = {
    "title_mismatch": "title_apart", "year_disagree_rawg_igdb": "years_apart", "steam_year_disagree": "store_year_apart",
    "platform_disagree": "platforms_apart", "steam_appid_mismatch": "ids_apart", "edition_disagree": "edition_apart", "steam_dlc_like": "store_dlc",
    "series_disagree": "series_apart", "suggest_rename": f"renamed AND (title_apart OR years_apart OR platforms_apart OR ids_apart) AND ({_SURE})",
    "needs_review": "reason <> ''",
}
_LACKING = {
    "RAWG": "RAWG_ID = ''", "IGDB": "IGDB_ID = ''", "Steam": "Steam_AppID = ''", "HLTB": "HLTB_Main IS NULL",
    "SteamSpy": "coalesce(SteamSpy_Owners, '') = '' AND Steam_AppID <> ''",
}
_MISSING_TAGS = ", ".join(
    f"CASE WHEN {c} THEN " + ("CASE WHEN on_pc THEN 'missing:Steam' ELSE 'missing_ok:Steam' END" if p == "Steam" else f"'missing:{p}'") + " END"
    for p, c in _LACKING.items()
)
_FLAG_TAGS = ", ".join(f"CASE WHEN {c} THEN '{t}' END" for t, c in _FLAGS.items())
_MISSING_NAMES = ", ".join(f"CASE WHEN {c} THEN '{p}' END" for p, c in _LACKING.items())
_TITLES_SHOWN = ", ".join(f"trim({p}_Name) AS {p}_Name" for p in _NAMES)
_APART = " OR ".join(f"coalesce(s_{p} < 90, false)" for p in _NAMES)
_REPORT_SQL = f"""WITH RECURSIVE src AS (SELECT *, {_NORMS}, {s.norm('Name')} AS nn FROM {duck(SOURCES)}), {YEAR_TAGS_CTE},
    {set_vote_ctes('p', {k: v for k, v in _REPORT_PLATFORMS.items() if k != 'hltb'}, _REPORT_FAMILY, 'platform')}, {_set_texts('p', f'CASE p {_SHOWN} END')},
    {set_vote_ctes('q', _REPORT_PLATFORMS, _REPORT_FAMILY, 'platform')}, {set_vote_ctes('g', GENRE_COLUMNS, _X, 'genre')}, {_set_texts('g', 'p')},
    {provider_ctes(3)}, {component_ctes('d', company_nodes(_DEVELOPERS), SHARED_KEY, 2)}, {component_ctes('u', company_nodes(PUBLISHERS), SHARED_KEY, 2)},
    {CANON_CTE}, sc AS (WITH {s.fuzzy_cte(_SCORED)} SELECT * FROM fuzzy),
    b0 AS (SELECT src.*, {_SCORES}, cbest.RowId IS NOT NULL AS known, members, cbest.outliers AS outliers, cbest.present AS present, cbest.has AS has,
        coalesce(ytags.tags, []) AS yt, qtags.tags AS pt, gtags.tags AS gt, {company_tags_sql('dbest', 'developer')} AS dt, {company_tags_sql('ubest', 'publisher')} AS ut,
        coalesce(ptxt.txt, '') AS platforms, coalesce(ptxt.voters, 0) AS voters, pcommon.common AS p_common, coalesce(gtxt.txt, '') AS genres,
        gcommon.common AS g_common, coalesce(canon.title, '') AS c_title, coalesce(canon.source, '') AS c_source, coalesce(canon.c, 0) AS c_count,
        CASE WHEN canon.c >= 2 THEN canon.sources ELSE '' END AS c_sources, coalesce(canon.nrm, '') AS c_norm,
        src.RowId IN (SELECT RowId FROM qi WHERE x = 'pc') AS on_pc,
        CASE WHEN cbest.RowId IS NULL THEN []::VARCHAR[] WHEN NOT cbest.has THEN ['provider_no_consensus'] ELSE list_concat(['provider_consensus:' || array_to_string(members, '+')],
            list_transform(cbest.outliers, lambda o: 'provider_outlier:' || o)) END AS ctags
        FROM src LEFT JOIN cbest ON cbest.RowId = src.RowId LEFT JOIN ytags ON ytags.RowId = src.RowId JOIN qtags ON qtags.RowId = src.RowId
        JOIN gtags ON gtags.RowId = src.RowId LEFT JOIN (SELECT RowId, n, has, outliers FROM dbest) dbest ON dbest.RowId = src.RowId
        LEFT JOIN (SELECT RowId, n, has, outliers FROM ubest) ubest ON ubest.RowId = src.RowId
        LEFT JOIN ptxt ON ptxt.RowId = src.RowId LEFT JOIN gtxt ON gtxt.RowId = src.RowId LEFT JOIN pcommon ON pcommon.RowId = src.RowId
        LEFT JOIN gcommon ON gcommon.RowId = src.RowId LEFT JOIN canon ON canon.RowId = src.RowId),
    b1 AS (SELECT *, CASE WHEN {_WORST}.v < 90 THEN {_WORST}.p ELSE '' END AS worst, {_APART} AS title_apart,
        coalesce(abs(RAWG_Year - IGDB_Year) > 1, false) AS years_apart, Steam_ReleaseYear - coalesce(IGDB_Year, RAWG_Year) AS year_diff,
        voters >= 2 AND p_common IS NULL AS platforms_apart, Steam_AppID <> '' AND IGDB_SteamAppID <> '' AND Steam_AppID <> IGDB_SteamAppID AS ids_apart,
        {_distinct_sets(_ED, _TITLED)} >= 2 AS edition_apart, {_distinct_sets(_RS, {p: f'len({_RS[p]}) > 0' for p in _NAMES})} >= 2 AS series_apart,
        {s.dlc('n_Steam', True)} OR list_contains(Steam_Categories, 'Downloadable Content') AS store_dlc, {ACTIONABLE} AS act,
        c_title <> '' AND trim(Name) <> '' AND nn <> c_norm AS renamed, c_count >= 2 AS agreed,
        len(list_filter(IGDB_Platforms, lambda x: contains(lower(x), 'web browser'))) > 0 AS browser FROM b0),
    b2 AS (SELECT *, coalesce(abs(year_diff) > 1, false) AND NOT {_EDITION_OR_PORT} AS store_year_apart,
        CASE WHEN ids_apart THEN CASE WHEN coalesce(worst, '') <> '' THEN worst WHEN coalesce(s_Steam >= 90, false) THEN 'IGDB' ELSE 'Steam' END
            WHEN platforms_apart THEN CASE WHEN browser THEN 'IGDB' ELSE coalesce(worst, '') END
            WHEN years_apart THEN CASE WHEN coalesce(abs(Steam_ReleaseYear - RAWG_Year) <= 1, false) THEN 'IGDB'
                WHEN coalesce(abs(Steam_ReleaseYear - IGDB_Year) <= 1, false) THEN 'RAWG' ELSE 'RAWG/IGDB' END
            WHEN title_apart THEN worst ELSE '' END AS culprit0,
        coalesce(CASE WHEN renamed THEN CASE WHEN agreed THEN 'provider consensus (' || c_sources || ')'
            WHEN c_source = 'Steam' AND Steam_AppID <> '' THEN 'steam appid present' WHEN ids_apart THEN 'steam appid mismatch'
            WHEN title_apart THEN 'title mismatch' END END, CASE WHEN store_dlc THEN 'steam looks like dlc/demo' END, '') AS reason FROM b1)
    SELECT RowId, coalesce(array_to_string(list_concat(list_filter([{_MISSING_TAGS},
        CASE WHEN Steam_StoreType NOT IN ('', 'game') THEN 'store_type_not_game:' || Steam_StoreType END, {_FLAG_TAGS}], lambda t: t IS NOT NULL),
        dt, ut, ctags, pt, yt, gt, act), ', '), '') AS ValidationTags,
    coalesce(array_to_string(list_filter([{_MISSING_NAMES}], lambda t: t IS NOT NULL), ', '), '') AS MissingProviders, {_TITLES_SHOWN}, coalesce({_YEARS_SHOWN}, '') AS Years,
    coalesce(CAST(year_diff AS VARCHAR), '') AS SteamYearDiffVsPrimary, {_summary(_ED)} AS EditionTokens, {_summary(_RS)} AS SeriesNumbers,
    platforms AS Platforms, {tag_list_sql('p_common')} AS PlatformIntersection, genres AS Genres, {tag_list_sql('g_common')} AS GenreIntersection,
    Steam_AppID AS SteamAppID, IGDB_SteamAppID,
    CASE WHEN store_dlc THEN 'Steam' WHEN culprit0 = '' AND series_apart THEN 'RAWG/IGDB/Steam/HLTB' ELSE culprit0 END AS SuggestedCulprit,
    c_title AS SuggestedCanonicalTitle, c_source AS SuggestedCanonicalSource, CASE WHEN reason <> '' THEN 'YES' ELSE '' END AS ReviewTitle,
    reason AS ReviewTitleReason FROM b2"""


@query("validation_report", _REPORT_SQL)
def report(spark, sf):
    """All findings of every row."""
    return validation_report(spark_frame(spark, sf, SOURCES)).drop("Name")


@query(
    "validation_findings",
    f"""WITH src AS (SELECT *, {_NORMS} FROM {duck(SOURCES)}), {set_vote_ctes('p', {p.lower(): f'{p}_Platforms' for p in ('RAWG', 'IGDB', 'Steam')}, _REPORT_FAMILY, 'platform')},
    {set_vote_ctes('g', GENRE_COLUMNS, _X, 'genre')}
    SELECT src.RowId, {_summary(_ED)} AS EditionTokens, {_summary(_RS)} AS SeriesNumbers, {tag_list_sql('pcommon.common')} AS PlatformIntersection,
    {tag_list_sql('gcommon.common')} AS GenreIntersection,
    {_distinct_sets(_ED, {p: f"n_{p} <> ''" for p in _NAMES})} >= 2 AS edition_disagree, {_distinct_sets(_RS, {p: f"len({_RS[p]}) > 0" for p in _NAMES})} >= 2 AS series_disagree,
    coalesce(abs(RAWG_Year - IGDB_Year) > 1, false) AS year_disagree, Steam_AppID <> '' AND IGDB_SteamAppID <> '' AND Steam_AppID <> IGDB_SteamAppID AS appid_mismatch,
    coalesce(array_to_string(list_filter([CASE WHEN RAWG_ID = '' THEN 'RAWG' END, CASE WHEN IGDB_ID = '' THEN 'IGDB' END, CASE WHEN Steam_AppID = '' THEN 'Steam' END,
        CASE WHEN HLTB_Main IS NULL THEN 'HLTB' END, CASE WHEN Steam_AppID <> '' AND SteamSpy_Owners = '' THEN 'SteamSpy' END], lambda t: t IS NOT NULL), ', '), '') AS MissingProviders,
    {s.dlc('n_Steam', True)} OR list_contains(Steam_Categories, 'Downloadable Content') AS dlc_like,
    coalesce(CAST(Steam_ReleaseYear - coalesce(IGDB_Year, RAWG_Year) AS VARCHAR), '') AS SteamYearDiffVsPrimary
    FROM src LEFT JOIN pcommon ON pcommon.RowId = src.RowId LEFT JOIN gcommon ON gcommon.RowId = src.RowId""",
)
def validation_findings(spark, sf):
    out = validation_report(spark_frame(spark, sf, SOURCES))
    tags = F.split("ValidationTags", ", ")

    def has(tag):
        return F.array_contains(tags, tag)

    return out.select(
        "RowId", "EditionTokens", "SeriesNumbers", "PlatformIntersection", "GenreIntersection", has("edition_disagree").alias("edition_disagree"),
        has("series_disagree").alias("series_disagree"), has("year_disagree_rawg_igdb").alias("year_disagree"), has("steam_appid_mismatch").alias("appid_mismatch"),
        "MissingProviders", has("steam_dlc_like").alias("dlc_like"), "SteamYearDiffVsPrimary",
    )
