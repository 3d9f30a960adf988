"""Derived and composite scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalith.constants import SIGNALS
from catalith.functions.scores import half_even
from catalith.operators.signals import (
    Inputs,
    content_metrics,
    keyword_metrics,
    now_metrics,
    rating_metrics,
    reach_metrics,
    replay_score,
    with_company_consensus,
    with_keyword_text,
    with_signals,
)
from catalith.functions.text import normalize_tag
from catalith.sources.registry import default_registry
from catalith.workload import sql as s
from catalith.workload.frames import SOURCES, duck, spark_frame, table
from catalith.workload import votes  # noqa: F401  (its SQL is part of the flagship's)
from catalith.workload.registry import ORACLES, query


def _apply(df, metrics, registry):
    return df.select("RowId", *[F.coalesce(v.cast("bigint"), F.lit(-1).cast("bigint")).alias(registry.column(k)) for k, v in metrics.items()])


_OWN = "regexp_split_to_array(SteamSpy_Owners, ' \\.\\. |-')"
_OA, _OB = f"CAST({_OWN}[1] AS BIGINT)", f"CAST({_OWN}[2] AS BIGINT)"
_SOME = "coalesce(SteamSpy_Owners, '') <> ''"
_LOW, _HIGH = f"CASE WHEN {_SOME} THEN least({_OA}, {_OB}) END", f"CASE WHEN {_SOME} THEN greatest({_OA}, {_OB}) END"
_MID = f"(CASE WHEN {_SOME} THEN CAST(round_even(({_OA} + {_OB}) / 2.0::DOUBLE, 0) AS BIGINT) END)"
_ADDED = (
    "coalesce(RAWG_Added, CASE WHEN RAWG_AddedByStatusOwned IS NOT NULL OR RAWG_AddedByStatusBeaten IS NOT NULL "
    "THEN coalesce(RAWG_AddedByStatusOwned, 0) + coalesce(RAWG_AddedByStatusBeaten, 0) END)"
)
_REACH = s.blend(
    [
        (s.log_scale(v, k), str(k.weight))
        for v, k in (
            (_MID, SIGNALS.owners), ("Steam_ReviewCount", SIGNALS.reviews), ("RAWG_RatingsCount", SIGNALS.votes), (_ADDED, SIGNALS.added),
            ("IGDB_ScoreCount", SIGNALS.votes), ("IGDB_CriticScoreCount", SIGNALS.critic_votes), ("Wikidata_Pageviews365d", SIGNALS.pageviews),
        )
    ]
)


@query(
    "reach_scores",
    f"""SELECT RowId, coalesce({_LOW}, -1) AS Reach_SteamSpyOwners_Low, coalesce({_HIGH}, -1) AS Reach_SteamSpyOwners_High,
    coalesce({_MID}, -1) AS Reach_SteamSpyOwners_Mid, coalesce(Steam_ReviewCount, -1) AS Reach_SteamReviews,
    coalesce(RAWG_RatingsCount, -1) AS Reach_RAWGRatingsCount, coalesce(IGDB_ScoreCount, -1) AS Reach_IGDBRatingCount,
    coalesce(IGDB_CriticScoreCount, -1) AS Reach_IGDBAggregatedRatingCount, coalesce({_REACH}, -1) AS Reach_Composite FROM {duck(SOURCES)}""",
)
def reach_scores(spark, sf):
    registry = default_registry()
    df = spark_frame(spark, sf, SOURCES)
    return _apply(df, reach_metrics(Inputs(df, registry)), registry)


_COMMUNITY = s.blend(
    [
        ("SteamSpy_Score_100::DOUBLE", s.log_weight("(coalesce(SteamSpy_Positive, 0) + coalesce(SteamSpy_Negative, 0))")),
        ("RAWG_Score_100::DOUBLE", s.log_weight("RAWG_RatingsCount")),
        ("IGDB_Score_100::DOUBLE", s.log_weight("IGDB_ScoreCount")),
        ("HLTB_Score_100::DOUBLE", "1.0"),
    ]
)
_CRITIC = s.blend(
    [
        ("(CASE WHEN Steam_Metacritic BETWEEN 0 AND 100 THEN Steam_Metacritic::DOUBLE END)", "1.0"),
        ("(CASE WHEN RAWG_Metacritic BETWEEN 0 AND 100 THEN RAWG_Metacritic::DOUBLE END)", "1.0"),
        ("(CASE WHEN IGDB_CriticScore_100 BETWEEN 0 AND 100 THEN IGDB_CriticScore_100::DOUBLE END)", s.log_weight("IGDB_CriticScoreCount")),
    ]
)


@query(
    "rating_scores",
    f"SELECT RowId, coalesce({_COMMUNITY}, -1) AS CommunityRating_Composite_100, coalesce({_CRITIC}, -1) AS CriticRating_Composite_100 FROM {duck(SOURCES)}",
)
def rating_scores(spark, sf):
    registry = default_registry()
    df = spark_frame(spark, sf, SOURCES)
    return _apply(df, rating_metrics(Inputs(df, registry)), registry)


_NOW = s.blend(
    [
        (s.log_scale(v, k), str(k.weight))
        for v, k in (("SteamSpy_CCU", SIGNALS.ccu), ("SteamSpy_Players2Weeks", SIGNALS.players_2w), ("Wikidata_Pageviews30d", SIGNALS.now_pageviews))
    ]
)
_LAUNCH = f"CAST(round_even({s.log_scale('Wikidata_PageviewsFirst90d', SIGNALS.now_pageviews)}, 0) AS BIGINT)"


@query(
    "interest_scores",
    f"""SELECT RowId, coalesce(SteamSpy_PlaytimeAvg2Weeks, -1)::BIGINT AS Now_SteamSpyPlaytimeAvg2Weeks, coalesce(SteamSpy_PlaytimeMedian2Weeks, -1)::BIGINT AS Now_SteamSpyPlaytimeMedian2Weeks,
    coalesce({_NOW}, -1) AS Now_Composite, coalesce({_LAUNCH}, -1) AS Launch_Interest_100 FROM {duck(SOURCES)}""",
)
def interest_scores(spark, sf):
    registry = default_registry()
    df = spark_frame(spark, sf, SOURCES)
    return _apply(df, now_metrics(Inputs(df, registry)), registry)


_CT = """CASE WHEN sv <> '' AND iv <> '' AND sv <> iv THEN '' WHEN sv <> '' THEN sv ELSE iv END"""
_CONTENT_SQL = f"""SELECT RowId, {_CT} AS content_type,
    CASE WHEN sv <> '' AND iv <> '' AND sv = iv THEN 'igdb+steam' WHEN sv <> '' AND iv <> '' THEN '' WHEN sv <> '' THEN 'steam'
        WHEN iv <> '' THEN 'igdb' ELSE '' END AS voters,
    array_to_string(list_filter([CASE WHEN Steam_StoreType <> '' THEN 'steam:type=' || Steam_StoreType END,
        CASE WHEN IGDB_VersionParent <> '' THEN 'igdb:version_parent' END, CASE WHEN trim(IGDB_ParentGame) <> '' THEN 'igdb:parent_game' END,
        CASE WHEN p_size % 2 = 0 THEN 'igdb:dlcs=1' END, CASE WHEN p_size % 6 = 1 THEN 'igdb:expansions=1' END,
        CASE WHEN p_size % 6 = 2 THEN 'igdb:ports=2' END], lambda x: x IS NOT NULL), ', ') AS signals,
    CASE WHEN sv <> '' AND iv <> '' AND sv <> iv THEN 'YES' ELSE '' END AS conflict,
    p_size % 2 = 0 AS dlcs, p_size % 6 = 1 AS expansions, p_size % 6 = 2 AS ports
    FROM (SELECT *, CASE Steam_StoreType WHEN 'game' THEN 'base_game' ELSE Steam_StoreType END AS sv,
        CASE WHEN IGDB_VersionParent <> '' THEN 'port' WHEN trim(IGDB_ParentGame) <> '' THEN 'dlc' ELSE '' END AS iv FROM {duck(SOURCES)})"""


@query("content_types", _CONTENT_SQL)
def content_types(spark, sf):
    df = spark_frame(spark, sf, SOURCES)
    m = content_metrics(Inputs(df, default_registry()))

    def t(key):
        return F.coalesce(m[f"derived.content_type.{key}"], F.lit(""))

    def b(key):
        return F.coalesce(m[f"derived.igdb.has_{key}"], F.lit(False))

    return df.select(
        "RowId", t("value").alias("content_type"), t("consensus_providers").alias("voters"), t("source_signals").alias("signals"),
        t("conflict").alias("conflict"), b("dlcs").alias("dlcs"), b("expansions").alias("expansions"), b("ports").alias("ports"),
    )


_HOURS = "coalesce(HLTB_Completionist / HLTB_Main >= 2.0, false) OR coalesce(HLTB_Extra / HLTB_Main >= 1.5, false)"
_PVP = "Steam_StoreType = ''"
_SYS = "p_size % 2 = 1 OR p_size % 4 IN (2, 3) OR p_size % 3 = 0"


@query(
    "keyword_scores",
    f"""SELECT RowId, CAST(least(100, 20 + CASE WHEN {_PVP} THEN 60 ELSE 0 END + CASE WHEN {_SYS} THEN 20 ELSE 0 END
        + CASE WHEN {_HOURS} THEN 10 ELSE 0 END) AS BIGINT) AS Replayability_100,
    array_to_string(list_filter([CASE WHEN {_PVP} THEN 'multiplayer, pvp' END, CASE WHEN {_SYS} THEN 'systemic' END,
        CASE WHEN {_HOURS} THEN 'optional_content' END], lambda x: x IS NOT NULL), ', ') AS replay_signals,
    Steam_StoreType = 'demo' AS HasWorkshop, CAST(CASE Steam_StoreType WHEN 'demo' THEN 90 WHEN '' THEN 75 WHEN 'dlc' THEN 70 ELSE 0 END AS BIGINT) AS ModdingSignal_100,
    CASE Steam_StoreType WHEN 'demo' THEN 'steam_workshop' WHEN '' THEN 'level_editor' WHEN 'dlc' THEN 'mod_tools' ELSE '' END AS mod_signals
    FROM {duck(SOURCES)}""",
)
def keyword_scores(spark, sf):
    df = spark_frame(spark, sf, SOURCES).withColumn("SteamSpy_Tags", F.when(F.col("p_size") % 2 == 1, F.col("Steam_Tags")))
    df = with_keyword_text(df, default_registry())
    m = keyword_metrics(Inputs(df, default_registry()))
    return df.select(
        "RowId",
        m["derived.replayability.score_100"].alias("Replayability_100"),
        F.coalesce(m["derived.replayability.source_signals"], F.lit("")).alias("replay_signals"),
        F.coalesce(m["derived.modding.has_workshop"], F.lit(False)).alias("HasWorkshop"),
        m["derived.modding.score_100"].alias("ModdingSignal_100"),
        F.coalesce(m["derived.modding.source_signals"], F.lit("")).alias("mod_signals"),
    )


_DOC_TAG = "trim(regexp_replace(regexp_replace(replace(lower(text), '&', ' and '), '[^a-z0-9\\s:+/-]', ' ', 'g'), '\\s+', ' ', 'g'))"


def _any(*needles: str) -> str:
    return "(" + " OR ".join(f"contains(t, '{n}')" for n in needles) + ")"


@query(
    "document_keywords",
    f"""SELECT doc_id, CAST(CASE WHEN t = '' THEN -1 ELSE least(100, 20
        + CASE WHEN {_any('multiplayer', 'multi player', 'pvp', 'mmorpg', 'battle royale')} THEN 50 ELSE 0 END
        + CASE WHEN {_any('co op', 'coop', 'co-operative')} THEN 20 ELSE 0 END
        + CASE WHEN {_any('pvp', 'competitive', 'ranked', 'versus')} THEN 10 ELSE 0 END
        + CASE WHEN {_any('roguelike', 'roguelite')} THEN 25 WHEN {_any('procedural')} THEN 15 ELSE 0 END
        + CASE WHEN {_any('sandbox', 'open world', 'strategy', '4x', 'simulation', 'city builder', 'management', 'survival', 'crafting', 'building')}
            THEN 20 ELSE 0 END) END AS BIGINT) AS score FROM (SELECT doc_id, {_DOC_TAG} AS t FROM documents)""",
)
def document_keywords(spark, sf):
    none = F.lit(None).cast("double")
    score, _ = replay_score(F.col("t"), none, none, none)
    return table(spark, sf, "documents").select("doc_id", normalize_tag(F.col("text")).alias("t")).select("doc_id", F.coalesce(score, F.lit(-1).cast("bigint")).alias("score"))


@query(
    "weighted_ratings",
    """SELECT l_suppkey, CAST(round_even(num::DOUBLE / (den * 100)::DOUBLE, 0) AS BIGINT) AS rating FROM
    (SELECT l_suppkey, sum(CAST(round(l_quantity * 100) AS BIGINT) * CAST(round(l_discount * 100) AS BIGINT)) AS num,
        sum(CAST(round(l_discount * 100) AS BIGINT)) AS den FROM lineitem WHERE l_discount > 0 GROUP BY l_suppkey) WHERE den > 0""",
)
def weighted_ratings(spark, sf):
    """Weighted average in long form: rows are votes, weights at or below zero do not count.

    Votes and weights have two decimals and are added up as hundredths: sums of doubles depend on their order, and so would an average that ends in .5.
    """

    def hundredths(c):
        return F.round(F.col(c) * 100).cast("bigint")

    votes = table(spark, sf, "lineitem").where(F.col("l_discount") > 0).select("l_suppkey", hundredths("l_quantity").alias("v"), hundredths("l_discount").alias("w"))
    sums = votes.groupBy("l_suppkey").agg(F.sum(F.col("v") * F.col("w")).alias("num"), F.sum("w").alias("den"))
    return sums.where("den > 0").select("l_suppkey", half_even(F.col("num") / (F.col("den") * 100)).alias("rating"))


@query(
    "company_names_shared",
    f"""SELECT RowId, CASE WHEN p_size % 12 = 0 AND s0 <> s1 THEN '' ELSE 'Supplier ' || CAST(s0 AS VARCHAR) || ', Inc.' END AS names FROM
    (SELECT *, CAST(regexp_extract(Steam_Developers[1], '(\\d+)', 1) AS BIGINT) AS s0, CAST(regexp_extract(IGDB_Developers[1], '(\\d+)', 1) AS BIGINT) AS s1
     FROM {duck(SOURCES)})""",
)
def company_names_shared(spark, sf):
    """Display names of the developers most providers share."""
    df = with_company_consensus(spark_frame(spark, sf, SOURCES), default_registry())
    return df.select("RowId", F.coalesce(F.array_join("Developers_Consensus", "|"), F.lit("")).alias("names"))


_PARTS = {
    "reach_scores": "", "rating_scores": "", "interest_scores": "", "company_names_shared": "names AS Developers_Consensus",
    "content_types": "content_type AS ContentType, voters AS ContentType_ConsensusProviders, signals AS ContentType_SourceSignals, conflict AS ContentType_Conflict, "
                     "dlcs AS HasDLCs, expansions AS HasExpansions, ports AS HasPorts",
    "keyword_scores": "Replayability_100, replay_signals AS Replayability_SourceSignals, HasWorkshop, ModdingSignal_100, mod_signals AS Modding_SourceSignals",
    "main_genres": "label AS Genre_Main, sources AS Genre_MainSources",
}
_JOINED = " ".join(f"JOIN (SELECT RowId, {columns or '* EXCLUDE (RowId)'} FROM ({ORACLES[name]})) USING (RowId)" for name, columns in _PARTS.items())


@query("enriched_scores", f"SELECT * FROM (SELECT RowId, Name FROM {duck(SOURCES)}) {_JOINED}")
def enriched_scores(spark, sf):
    """Flagship: reach, ratings, interest, content type, replayability, modding, main genre and shared developers of every title."""
    registry = default_registry()
    rows = spark_frame(spark, sf, SOURCES).withColumn("SteamSpy_Tags", F.when(F.col("p_size") % 2 == 1, F.col("Steam_Tags")))
    scored = with_signals(rows, registry)
    texts = ("ContentType", "ContentType_ConsensusProviders", "ContentType_SourceSignals", "ContentType_Conflict", "Replayability_SourceSignals", "Modding_SourceSignals",
             "Genre_Main", "Genre_MainSources")
    flags = ("HasDLCs", "HasExpansions", "HasPorts", "HasWorkshop")
    numbers = [registry.column(k) for k in (*reach_metrics(Inputs(rows, registry)), *rating_metrics(Inputs(rows, registry)), *now_metrics(Inputs(rows, registry)))]
    return scored.select(
        "RowId", "Name", *[F.coalesce(F.col(c).cast("bigint"), F.lit(-1).cast("bigint")).alias(c) for c in numbers], "Replayability_100", "ModdingSignal_100",
        *[F.coalesce(c, F.lit("")).alias(c) for c in texts], *[F.coalesce(c, F.lit(False)).alias(c) for c in flags],
        F.coalesce(F.array_join("Developers_Consensus", "|"), F.lit("")).alias("Developers_Consensus"),
    )
