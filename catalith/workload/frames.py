"""Input frames derived from the given tables, as SQL both engines read.

The tables hold parts, orders and lines; a part stands for a catalog title, its lines for what several providers know
about it, an order for a search whose lines are the hits. Templates name tables as ``{part}`` and lists as ``[[a, b]]``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def spark_frame(spark: SparkSession, sf: str, template: str) -> DataFrame:
    """Run a frame template on Spark."""
    text = re.sub(r"\[\[(.*?)\]\]", r"array(\1)", template, flags=re.S)
    return spark.sql(text.format(**{t: f"parquet.`{sf}/{t}.parquet`" for t in TABLES}))


def duck(template: str) -> str:
    """The same template as a DuckDB sub-select."""
    text = re.sub(r"\[\[(.*?)\]\]", r"[\1]", template, flags=re.S)
    return "(" + text.format(**{t: t for t in TABLES}) + ")"


_TITLE = """CASE p_type
    WHEN 'PROMO' THEN p_name || ' Demo'
    WHEN 'ECONOMY' THEN 'The ' || p_name || ': Definitive Edition'
    WHEN 'SMALL' THEN p_name || ' II'
    WHEN 'MEDIUM' THEN p_name || ' (' || CAST(1990 + p_size % 30 AS STRING) || ')'
    WHEN 'LARGE' THEN p_name || ' ' || substr(p_brand, 7)
    ELSE upper(p_name) || '!' END"""

# One title per part.
TITLES = f"SELECT p_partkey, p_name, p_brand, p_type, p_size, {_TITLE} AS title FROM {{part}}"

# What several sources know about each title: years, names, companies, counts. One row per part.
_LINES = """SELECT l_partkey, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty,
    CAST(sum(CAST(floor(l_extendedprice) AS BIGINT)) AS BIGINT) AS rev,
    CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS returned,
    CAST(min(year(l_shipdate)) AS INT) AS y0, CAST(max(year(l_shipdate)) AS INT) AS y1,
    min(l_suppkey) AS s0, max(l_suppkey) AS s1
    FROM {lineitem} GROUP BY l_partkey"""

SOURCES = f"""SELECT 'rid:' || CAST(p_partkey AS STRING) AS RowId, p_partkey, p_size, {_TITLE} AS Name,
    CASE WHEN p_size % 11 = 0 THEN 'YES' ELSE '' END AS Disabled,
    CASE WHEN p_size % 7 = 0 THEN 'PlayStation' WHEN p_size % 5 = 0 THEN 'PC' ELSE '' END AS Platform,
    CASE WHEN p_size % 13 = 0 THEN '' WHEN p_size % 17 = 0 THEN '__NOT_FOUND__' ELSE CAST(p_partkey AS STRING) END AS RAWG_ID,
    CASE WHEN p_size % 9 = 0 THEN '' ELSE CAST(p_partkey + 5 AS STRING) END AS IGDB_ID,
    CASE WHEN p_size % 8 = 0 THEN '' ELSE CAST(p_partkey * 10 AS STRING) END AS Steam_AppID,
    CASE WHEN p_size % 6 = 0 THEN '' ELSE CAST(p_partkey + 9 AS STRING) END AS HLTB_ID,
    CASE WHEN p_size % 13 = 0 THEN '' WHEN p_size % 4 = 0 THEN p_name || ' Remastered' ELSE {_TITLE} END AS RAWG_Name,
    CASE WHEN p_size % 9 = 0 THEN '' WHEN p_size % 10 = 0 THEN 'old anvil 3' ELSE p_name END AS IGDB_Name,
    CASE WHEN p_size % 8 = 0 THEN '' ELSE upper({_TITLE}) END AS Steam_Name,
    CASE WHEN p_size % 6 = 0 THEN '' WHEN p_size % 5 = 0 THEN 'Collection of gizmo' ELSE p_name || ' 2' END AS HLTB_Name,
    y0 AS RAWG_Year, CASE WHEN p_size % 3 = 0 THEN y0 ELSE y1 END AS IGDB_Year,
    CASE WHEN p_size % 4 = 0 THEN y0 + 3 ELSE y1 END AS Steam_ReleaseYear, y0 AS HLTB_ReleaseYear,
    CASE WHEN p_size % 3 = 0 THEN [['PC', 'Xbox One']] WHEN p_size % 3 = 1 THEN [['PlayStation 4', 'Linux']]
         ELSE [['Nintendo Switch', 'PC (Microsoft Windows)']] END AS RAWG_Platforms,
    CASE WHEN p_size % 5 = 0 THEN [['Web browser']] WHEN p_size % 5 = 1 THEN [['PC', 'PC', '']] ELSE [['Mac', 'PlayStation 4']]
         END AS IGDB_Platforms,
    CASE WHEN p_size % 2 = 0 THEN [['Windows', 'macOS']] ELSE [['Windows', 'Linux']] END AS Steam_Platforms,
    CASE WHEN p_size % 7 = 0 THEN [['Mobile', 'Wii U']] ELSE [['PC', 'Xbox 360']] END AS HLTB_Platforms,
    CASE WHEN p_size % 4 = 0 THEN [['Action', 'Role-Playing']] WHEN p_size % 4 = 1 THEN [['Puzzle']] ELSE [['Action', 'Strategy', 'Indie']]
         END AS RAWG_Genres,
    CASE WHEN p_size % 3 = 0 THEN [['Strategy', 'action']] WHEN p_size % 3 = 1 THEN [['Role-playing', 'Puzzle']] ELSE [['Shooter']]
         END AS IGDB_Genres,
    CASE WHEN p_size % 2 = 0 THEN [['Indie', 'Action']] ELSE [['Casual', 'Open World']] END AS Steam_Tags,
    CASE WHEN p_type = 'PROMO' THEN [['Steam Workshop', 'Multi-player', 'Co-op']] WHEN p_type = 'LARGE'
         THEN [['Includes level editor', 'PvP']] WHEN p_type = 'SMALL' THEN [['Mod support', 'Downloadable Content']]
         ELSE [['Single-player']] END AS Steam_Categories,
    CASE p_type WHEN 'PROMO' THEN 'demo' WHEN 'SMALL' THEN 'dlc' WHEN 'LARGE' THEN '' ELSE 'game' END AS Steam_StoreType,
    CASE WHEN p_size % 10 = 3 THEN '7' WHEN p_size % 10 = 4 THEN '' ELSE CAST(p_partkey * 10 AS STRING) END AS IGDB_SteamAppID,
    CASE WHEN p_type = 'MEDIUM' THEN p_name ELSE '' END AS IGDB_VersionParent,
    CASE WHEN p_type = 'SMALL' THEN p_name WHEN p_type = 'LARGE' THEN ' ' ELSE '' END AS IGDB_ParentGame,
    CASE WHEN p_size % 2 = 0 THEN [['Season One', 'Official Soundtrack', 'Strategy Guide']] ELSE [['Artbook', 'The OST']] END AS IGDB_DLCs,
    CASE WHEN p_size % 6 = 1 THEN [['Big Expansion']] ELSE [['']] END AS IGDB_Expansions,
    CASE WHEN p_size % 6 = 2 THEN [['Port A', 'Port B']] ELSE [['']] END AS IGDB_Ports,
    [['Supplier ' || CAST(s0 AS STRING) || ', Inc.', 'Brand ' || substr(p_brand, 7) || ' Games']] AS Steam_Developers,
    [['supplier ' || CAST(s0 AS STRING), 'Aspyr (Mac, Linux)']] AS RAWG_Developers,
    [['SUPPLIER ' || CAST(CASE WHEN p_size % 3 = 0 THEN s1 ELSE s0 END AS STRING) || ' Ltd.']] AS IGDB_Developers,
    CASE WHEN p_size % 4 = 0 THEN [['Brand ' || substr(p_brand, 7)]] ELSE [['']] END AS Wikidata_Developers,
    [['Brand ' || substr(p_brand, 7) || ' Publishing LLC']] AS Steam_Publishers,
    [['Feral Interactive', 'Brand ' || substr(p_brand, 7)]] AS RAWG_Publishers,
    CASE WHEN p_size % 2 = 0 THEN [['Supplier ' || CAST(s1 AS STRING) || ' GmbH']] ELSE [['']] END AS IGDB_Publishers,
    [['']] AS Wikidata_Publishers,
    qty AS RAWG_RatingsCount, n * 7 AS IGDB_ScoreCount, CASE WHEN p_size % 3 = 0 THEN NULL ELSE n END AS IGDB_CriticScoreCount,
    CASE WHEN p_size % 4 = 0 THEN NULL ELSE rev END AS RAWG_Added, qty * 3 AS RAWG_AddedByStatusOwned,
    CASE WHEN p_size % 2 = 0 THEN n ELSE NULL END AS RAWG_AddedByStatusBeaten,
    rev % 101 AS RAWG_Score_100, CASE WHEN p_size % 5 = 0 THEN NULL ELSE qty % 101 END AS IGDB_Score_100,
    rev % 97 AS SteamSpy_Score_100, CASE WHEN p_size % 6 = 0 THEN NULL ELSE n * 3 % 101 END AS HLTB_Score_100,
    returned * 100 AS SteamSpy_Negative, qty * 10 AS SteamSpy_Positive, rev AS Steam_ReviewCount,
    CASE WHEN p_size % 2 = 0 THEN rev % 120 ELSE NULL END AS Steam_Metacritic, qty % 110 AS RAWG_Metacritic,
    CASE WHEN p_size % 3 = 1 THEN n % 100 ELSE NULL END AS IGDB_CriticScore_100,
    CASE WHEN p_size % 9 = 4 THEN '' WHEN p_size % 2 = 0
         THEN CAST(rev AS STRING) || ' .. ' || CAST(rev + qty * 2 + 1 AS STRING)
         ELSE CAST(rev * 2 AS STRING) || '-' || CAST(rev AS STRING) END AS SteamSpy_Owners,
    qty AS SteamSpy_CCU, CASE WHEN p_size % 2 = 1 THEN rev ELSE NULL END AS SteamSpy_Players2Weeks,
    CASE WHEN p_size % 4 = 1 THEN NULL ELSE n * 13 % 90 END AS SteamSpy_PlaytimeAvg2Weeks, CASE WHEN p_size % 4 = 2 THEN NULL ELSE n * 7 % 60 END AS SteamSpy_PlaytimeMedian2Weeks,
    CASE WHEN p_size % 5 = 1 THEN [['Strategy video game', 'action']] WHEN p_size % 5 = 2 THEN [['Indie', ' ']] ELSE [['']] END AS Wikidata_Genres,
    qty * 11 AS Wikidata_Pageviews30d, rev AS Wikidata_Pageviews365d,
    CASE WHEN p_size % 5 = 2 THEN NULL ELSE qty * 5 END AS Wikidata_PageviewsFirst90d,
    CASE WHEN p_size % 6 = 0 THEN NULL ELSE CAST(n AS DOUBLE) END AS HLTB_Main,
    CASE WHEN p_size % 2 = 0 THEN CAST(n AS DOUBLE) * 1.5 ELSE NULL END AS HLTB_Extra, CAST(n + p_size AS DOUBLE) AS HLTB_Completionist
    FROM {{part}} LEFT JOIN ({_LINES}) t ON l_partkey = p_partkey"""

# Searches: one per order, asking for the title of its smallest part; and their hits, one per line.
SEARCHES = f"""SELECT o_orderkey AS row_id, q.title || CASE WHEN o_orderkey % 4 = 0 THEN ' 2' ELSE '' END AS name,
    CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(year(o_orderdate) AS INT) END AS year_hint
    FROM {{orders}} JOIN (SELECT l_orderkey, min(l_partkey) AS k FROM {{lineitem}} GROUP BY l_orderkey) f ON l_orderkey = o_orderkey
    JOIN (SELECT p_partkey, p_name AS title FROM {{part}}) q ON q.p_partkey = f.k"""
HITS = f"""SELECT DISTINCT l_orderkey AS row_id, l_partkey AS id, {_TITLE} AS cand_name,
    CASE WHEN l_partkey % 6 = 0 THEN '' ELSE CAST(year(l_shipdate) AS STRING) || '-01-01' END AS released,
    CASE WHEN l_partkey % 6 = 0 THEN NULL ELSE CAST(year(l_shipdate) AS INT) END AS cand_year
    FROM {{lineitem}} JOIN {{part}} ON p_partkey = l_partkey"""

# The hits with what is asked of most searches: HITS without its years. Lines are dealt by their part, by which they are made distinct and meet its title.
OWN_HITS = f"""SELECT row_id, id AS pos, id, cand_name FROM (SELECT DISTINCT row_id, id FROM (SELECT /*+ REPARTITION(id) */ l_orderkey AS row_id, l_partkey AS id FROM {{lineitem}})) l
    JOIN (SELECT DISTINCT p_partkey, {_TITLE} AS cand_name FROM {{part}}) t ON p_partkey = id"""
