"""Enrichment from end to end: a catalog with pins, overrides, stale columns and stored payloads of two providers."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalith.plans.enrich import enrich
from catalith.sources.registry import default_registry
from catalith.workload.frames import TITLES, duck, spark_frame
from catalith.workload.registry import query

_CATALOG = f"""SELECT p_partkey, 'rid:' || CAST(p_partkey AS STRING) AS RowId, CASE WHEN p_size = 50 THEN ' ' ELSE title END AS Name,
    CASE WHEN p_size % 11 = 0 THEN 'YES' ELSE '' END AS Disabled, 'note ' || CAST(p_size AS STRING) AS Notes,
    CASE WHEN p_size % 13 = 0 THEN '' WHEN p_size % 17 = 0 THEN '__NOT_FOUND__' ELSE CAST(p_partkey AS STRING) END AS RAWG_ID,
    CASE WHEN p_size % 4 = 0 THEN '' ELSE CAST(p_partkey AS STRING) END AS HLTB_ID, 'stale' AS RAWG_Name, 'old' AS ReviewTags,
    CASE WHEN p_size % 19 = 0 THEN CAST(p_partkey + 1 AS STRING) ELSE '' END AS over, p_name, p_size FROM ({TITLES}) titles"""


@query(
    "enriched_catalog",
    f"""WITH c AS {duck(_CATALOG)}, r AS (SELECT *, CASE WHEN over <> '' THEN over ELSE RAWG_ID END AS pin, Disabled <> 'YES' AND trim(Name) <> '' AS active FROM c)
    SELECT r.RowId, r.Name, r.Notes, coalesce(w.p_name, '') AS rawg_name, coalesce(1990 + w.p_size % 30, -1)::BIGINT AS rawg_year, coalesce(w.p_size * 10, -1)::BIGINT AS rawg_votes,
    coalesce(h.p_size, -1)::DOUBLE AS hltb_main, false AS has_tags
    FROM r LEFT JOIN c w ON active AND pin = CAST(w.p_partkey AS VARCHAR) AND w.p_partkey % 7 <> 0
    LEFT JOIN c h ON active AND r.HLTB_ID = CAST(h.p_partkey AS VARCHAR)""",
)
def enriched_catalog(spark, sf):
    """Every title: overridden pins, the not-found mark, absent payloads, disabled rows; stale provider and diagnostic columns go."""
    rows = spark_frame(spark, sf, _CATALOG)
    catalog = rows.select("RowId", "Name", "Disabled", "Notes", "RAWG_ID", "HLTB_ID", "RAWG_Name", "ReviewTags")
    key = F.col("p_partkey").cast("string").alias("id")
    rawg = F.struct(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.concat((1990 + F.col("p_size") % 30).cast("string"), F.lit("-05-01")).alias("released"),
        (F.col("p_size") * 10).alias("ratings_count"),
    )
    rawg = rows.select(key, F.when(F.col("p_partkey") % 7 != 0, F.parse_json(F.to_json(rawg))).alias("payload"))
    hltb = F.struct(F.col("p_partkey").alias("game_id"), F.col("p_name").alias("game_name"), F.col("p_size").cast("double").alias("main_story"))
    hltb = rows.select(key, F.parse_json(F.to_json(hltb)).alias("payload"))
    overrides = rows.where("over <> ''").select("RowId", F.col("over").alias("RAWG_ID"), F.lit("").alias("HLTB_ID"))
    out = enrich(catalog, {"rawg": rawg, "hltb": hltb}, default_registry(), "rawg,hltb", overrides=overrides)
    number = lambda c, kind: F.coalesce(F.col(c).cast(kind), F.lit(-1).cast(kind))
    return out.select(
        "RowId", "Name", "Notes", F.coalesce("RAWG_Name", F.lit("")).alias("rawg_name"), number("RAWG_Year", "bigint").alias("rawg_year"),
        number("RAWG_RatingsCount", "bigint").alias("rawg_votes"), number("HLTB_Main", "double").alias("hltb_main"),
        F.lit("ReviewTags" in out.columns).alias("has_tags"),
    )
