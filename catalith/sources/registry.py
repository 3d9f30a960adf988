"""Metric registry: dotted metric key <-> column name and type, plus the diagnostics section."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from catalith.constants import PROVIDER_PREFIX

SPARK_TYPES = {
    "string": "string",
    "int": "bigint",
    "float": "double",
    "bool": "boolean",
    "json": "array<string>",
    "list_csv": "array<string>",
}


@dataclass(frozen=True)
class Registry:
    by_key: dict[str, tuple[str, str]]
    diagnostics: dict[str, tuple[str, str]] = field(default_factory=dict)

    @property
    def by_column(self) -> dict[str, tuple[str, str]]:
        return {c: (k, t) for k, (c, t) in self.by_key.items()}

    @property
    def diagnostic_columns(self) -> set[str]:
        return {c for c, _t in self.diagnostics.values()}

    def column(self, key: str) -> str | None:
        """Column of a metric or diagnostic key."""
        hit = self.by_key.get(key) or self.diagnostics.get(key)
        return hit[0] if hit else None

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [(k, c, t, "metrics") for k, (c, t) in self.by_key.items()]
        rows += [(k, c, t, "diagnostics") for k, (c, t) in self.diagnostics.items()]
        return spark.createDataFrame(rows, "metric_key string, column string, type string, section string")


def default_column(key: str) -> str:
    """Column name of a key without one of its own: provider prefix plus the rest, dots as underscores."""
    head, _, rest = key.partition(".")
    prefix = PROVIDER_PREFIX.get(head.casefold())
    rest = "_".join(p for p in rest.split(".") if p)
    return f"{prefix}{rest or 'value'}" if prefix else key.replace(".", "_")


def _section(spec: dict, name: str) -> dict[str, tuple[str, str]]:
    out: dict[str, tuple[str, str]] = {}
    for raw, entry in (spec or {}).items():
        key = str(raw).strip()
        if not key:
            continue
        if not isinstance(entry, dict):
            raise ValueError(f"{name}['{key}'] must be a mapping")
        out[key] = (str(entry.get("column") or "").strip() or default_column(key), str(entry.get("type") or "string"))
    return out


def registry_from_spec(spec: dict) -> Registry:
    """Registry from a version-2 mapping; columns mapped twice are rejected."""
    if int(spec.get("version") or 0) != 2:
        raise ValueError("metric registry must say version: 2")
    if not isinstance(spec.get("metrics") or {}, dict) or not isinstance(spec.get("diagnostics") or {}, dict):
        raise ValueError("metrics and diagnostics must be mappings")
    registry = Registry(_section(spec.get("metrics"), "metrics"), _section(spec.get("diagnostics"), "diagnostics"))
    columns = [c for c, _t in registry.by_key.values()] + [c for c, _t in registry.diagnostics.values()]
    twice = sorted({c for c in columns if columns.count(c) > 1})
    if twice:
        raise ValueError(f"column mapped twice: {', '.join(twice)}")
    return registry


def load_registry(path: str, spark: SparkSession | None = None) -> Registry:
    """Registry from a JSON file, or from YAML where a YAML reader is installed. With ``spark`` the path may be of any file system that Spark reads."""
    if spark is None:
        with open(path, encoding="utf-8") as f:
            raw = f.read()
    else:
        raw = "\n".join(r.value for r in spark.read.text(path).collect())  # one small document
    if not path.endswith((".yaml", ".yml")):
        return registry_from_spec(json.loads(raw))
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("reading YAML registries needs a YAML package; JSON needs none") from e
    return registry_from_spec(yaml.safe_load(raw) or {})


# Registered metrics as key: (column, type).
_METRICS = {
    "rawg.id": ("RAWG_ID", "string"),
    "rawg.name": ("RAWG_Name", "string"),
    "rawg.name_original": ("RAWG_NameOriginal", "string"),
    "rawg.released": ("RAWG_Released", "string"),
    "rawg.year": ("RAWG_Year", "int"),
    "rawg.website": ("RAWG_Website", "string"),
    "rawg.description_raw": ("RAWG_DescriptionRaw", "string"),
    "rawg.reddit_url": ("RAWG_RedditURL", "string"),
    "rawg.metacritic_url": ("RAWG_MetacriticURL", "string"),
    "rawg.background_image": ("RAWG_BackgroundImage", "string"),
    "rawg.genres": ("RAWG_Genres", "json"),
    "rawg.platforms": ("RAWG_Platforms", "json"),
    "rawg.tags": ("RAWG_Tags", "json"),
    "rawg.esrb": ("RAWG_ESRB", "string"),
    "rawg.score_100": ("RAWG_Score_100", "int"),
    "rawg.ratings_count": ("RAWG_RatingsCount", "int"),
    "rawg.metacritic_100": ("RAWG_Metacritic", "int"),
    "rawg.popularity.added_total": ("RAWG_Added", "int"),
    "rawg.popularity.added_by_status.owned": ("RAWG_AddedByStatusOwned", "int"),
    "rawg.popularity.added_by_status.playing": ("RAWG_AddedByStatusPlaying", "int"),
    "rawg.popularity.added_by_status.beaten": ("RAWG_AddedByStatusBeaten", "int"),
    "rawg.popularity.added_by_status.toplay": ("RAWG_AddedByStatusToplay", "int"),
    "rawg.popularity.added_by_status.dropped": ("RAWG_AddedByStatusDropped", "int"),
    "rawg.developers": ("RAWG_Developers", "json"),
    "rawg.publishers": ("RAWG_Publishers", "json"),
    "igdb.id": ("IGDB_ID", "string"),
    "igdb.name": ("IGDB_Name", "string"),
    "igdb.year": ("IGDB_Year", "int"),
    "igdb.summary": ("IGDB_Summary", "string"),
    "igdb.websites": ("IGDB_Websites", "json"),
    "igdb.alternative_names": ("IGDB_AlternativeNames", "json"),
    "igdb.platforms": ("IGDB_Platforms", "json"),
    "igdb.genres": ("IGDB_Genres", "json"),
    "igdb.themes": ("IGDB_Themes", "json"),
    "igdb.keywords": ("IGDB_Keywords", "json"),
    "igdb.game_modes": ("IGDB_GameModes", "json"),
    "igdb.perspectives": ("IGDB_Perspectives", "json"),
    "igdb.franchise": ("IGDB_Franchise", "json"),
    "igdb.engine": ("IGDB_Engine", "json"),
    "igdb.relationships.parent_game": ("IGDB_ParentGame", "string"),
    "igdb.relationships.version_parent": ("IGDB_VersionParent", "string"),
    "igdb.relationships.dlcs": ("IGDB_DLCs", "json"),
    "igdb.relationships.expansions": ("IGDB_Expansions", "json"),
    "igdb.relationships.ports": ("IGDB_Ports", "json"),
    "igdb.cross_ids.steam_app_id": ("IGDB_SteamAppID", "string"),
    "igdb.developers": ("IGDB_Developers", "json"),
    "igdb.publishers": ("IGDB_Publishers", "json"),
    "igdb.score_count": ("IGDB_ScoreCount", "int"),
    "igdb.score_100": ("IGDB_Score_100", "int"),
    "igdb.critic_score_count": ("IGDB_CriticScoreCount", "int"),
    "igdb.critic.score_100": ("IGDB_CriticScore_100", "int"),
    "steam.app_id": ("Steam_AppID", "string"),
    "steam.name": ("Steam_Name", "string"),
    "steam.url": ("Steam_URL", "string"),
    "steam.website": ("Steam_Website", "string"),
    "steam.short_description": ("Steam_ShortDescription", "string"),
    "steam.store_type": ("Steam_StoreType", "string"),
    "steam.release_year": ("Steam_ReleaseYear", "int"),
    "steam.platforms": ("Steam_Platforms", "json"),
    "steam.tags": ("Steam_Tags", "json"),
    "steam.review_count": ("Steam_ReviewCount", "int"),
    "steam.price": ("Steam_Price", "string"),
    "steam.categories": ("Steam_Categories", "json"),
    "steam.metacritic_100": ("Steam_Metacritic", "int"),
    "steam.developers": ("Steam_Developers", "json"),
    "steam.publishers": ("Steam_Publishers", "json"),
    "steamspy.owners": ("SteamSpy_Owners", "string"),
    "steamspy.players": ("SteamSpy_Players", "int"),
    "steamspy.players_2weeks": ("SteamSpy_Players2Weeks", "int"),
    "steamspy.ccu": ("SteamSpy_CCU", "int"),
    "steamspy.playtime_avg": ("SteamSpy_PlaytimeAvg", "int"),
    "steamspy.playtime_avg_2weeks": ("SteamSpy_PlaytimeAvg2Weeks", "int"),
    "steamspy.playtime_median_2weeks": ("SteamSpy_PlaytimeMedian2Weeks", "int"),
    "steamspy.playtime_median": ("SteamSpy_PlaytimeMedian", "int"),
    "steamspy.positive": ("SteamSpy_Positive", "int"),
    "steamspy.negative": ("SteamSpy_Negative", "int"),
    "steamspy.price": ("SteamSpy_Price", "int"),
    "steamspy.initial_price": ("SteamSpy_InitialPrice", "int"),
    "steamspy.discount_percent": ("SteamSpy_DiscountPercent", "int"),
    "steamspy.developer": ("SteamSpy_Developer", "string"),
    "steamspy.publisher": ("SteamSpy_Publisher", "string"),
    "steamspy.popularity.tags": ("SteamSpy_Tags", "json"),
    "steamspy.popularity.tags_top": ("SteamSpy_TagsTop", "json"),
    "steamspy.score_100": ("SteamSpy_Score_100", "int"),
    "hltb.name": ("HLTB_Name", "string"),
    "hltb.time.main": ("HLTB_Main", "float"),
    "hltb.time.extra": ("HLTB_Extra", "float"),
    "hltb.time.completionist": ("HLTB_Completionist", "float"),
    "hltb.release_year": ("HLTB_ReleaseYear", "int"),
    "hltb.platforms": ("HLTB_Platforms", "json"),
    "hltb.score_100": ("HLTB_Score_100", "int"),
    "hltb.url": ("HLTB_URL", "string"),
    "hltb.aliases": ("HLTB_Aliases", "json"),
    "wikidata.qid": ("Wikidata_QID", "string"),
    "wikidata.label": ("Wikidata_Label", "string"),
    "wikidata.description": ("Wikidata_Description", "string"),
    "wikidata.release_year": ("Wikidata_ReleaseYear", "int"),
    "wikidata.release_date": ("Wikidata_ReleaseDate", "string"),
    "wikidata.developers": ("Wikidata_Developers", "json"),
    "wikidata.publishers": ("Wikidata_Publishers", "json"),
    "wikidata.platforms": ("Wikidata_Platforms", "json"),
    "wikidata.series": ("Wikidata_Series", "json"),
    "wikidata.genres": ("Wikidata_Genres", "json"),
    "wikidata.instance_of": ("Wikidata_InstanceOf", "json"),
    "wikidata.enwiki_title": ("Wikidata_EnwikiTitle", "string"),
    "wikidata.wikipedia": ("Wikidata_Wikipedia", "string"),
    "wikipedia.page_url": ("Wikidata_WikipediaPage", "string"),
    "wikipedia.summary": ("Wikidata_WikipediaSummary", "string"),
    "wikipedia.thumbnail": ("Wikidata_WikipediaThumbnail", "string"),
    "wikipedia.pageviews_30d": ("Wikidata_Pageviews30d", "int"),
    "wikipedia.pageviews_90d": ("Wikidata_Pageviews90d", "int"),
    "wikipedia.pageviews_365d": ("Wikidata_Pageviews365d", "int"),
    "wikipedia.pageviews_first_30d": ("Wikidata_PageviewsFirst30d", "int"),
    "wikipedia.pageviews_first_90d": ("Wikidata_PageviewsFirst90d", "int"),
    "derived.reach.steamspy_owners_low": ("Reach_SteamSpyOwners_Low", "int"),
    "derived.reach.steamspy_owners_high": ("Reach_SteamSpyOwners_High", "int"),
    "derived.reach.steamspy_owners_mid": ("Reach_SteamSpyOwners_Mid", "int"),
    "composite.reach.score_100": ("Reach_Composite", "int"),
    "derived.reach.steam_reviews": ("Reach_SteamReviews", "int"),
    "derived.reach.rawg_ratings_count": ("Reach_RAWGRatingsCount", "int"),
    "derived.reach.igdb_rating_count": ("Reach_IGDBRatingCount", "int"),
    "derived.reach.igdb_aggregated_rating_count": ("Reach_IGDBAggregatedRatingCount", "int"),
    "composite.launch_interest.score_100": ("Launch_Interest_100", "int"),
    "composite.community_rating.score_100": ("CommunityRating_Composite_100", "int"),
    "composite.critic_rating.score_100": ("CriticRating_Composite_100", "int"),
    "derived.companies.developers_consensus_providers": ("Developers_ConsensusProviders", "string"),
    "derived.companies.developers_consensus": ("Developers_Consensus", "list_csv"),
    "derived.companies.developers_consensus_provider_count": ("Developers_ConsensusProviderCount", "int"),
    "derived.companies.publishers_consensus_providers": ("Publishers_ConsensusProviders", "string"),
    "derived.companies.publishers_consensus": ("Publishers_Consensus", "list_csv"),
    "derived.companies.publishers_consensus_provider_count": ("Publishers_ConsensusProviderCount", "int"),
    "derived.content_type.value": ("ContentType", "string"),
    "derived.content_type.consensus_providers": ("ContentType_ConsensusProviders", "string"),
    "derived.content_type.source_signals": ("ContentType_SourceSignals", "string"),
    "derived.content_type.conflict": ("ContentType_Conflict", "string"),
    "derived.igdb.has_dlcs": ("HasDLCs", "bool"),
    "derived.igdb.has_expansions": ("HasExpansions", "bool"),
    "derived.igdb.has_ports": ("HasPorts", "bool"),
    "derived.genre.main": ("Genre_Main", "string"),
    "derived.genre.sources": ("Genre_MainSources", "string"),
    "derived.replayability.score_100": ("Replayability_100", "int"),
    "derived.replayability.source_signals": ("Replayability_SourceSignals", "string"),
    "derived.modding.has_workshop": ("HasWorkshop", "bool"),
    "derived.modding.score_100": ("ModdingSignal_100", "int"),
    "derived.modding.source_signals": ("Modding_SourceSignals", "string"),
    "derived.production.tier": ("Production_Tier", "string"),
    "derived.production.tier_reason": ("Production_TierReason", "string"),
    "derived.now.steamspy_playtime_avg_2weeks": ("Now_SteamSpyPlaytimeAvg2Weeks", "int"),
    "derived.now.steamspy_playtime_median_2weeks": ("Now_SteamSpyPlaytimeMedian2Weeks", "int"),
    "composite.now.score_100": ("Now_Composite", "int"),
}
# Diagnostics as key: (column, type).
_DIAGNOSTICS = {
    "diagnostics.rawg.matched_name": ("RAWG_MatchedName", "string"),
    "diagnostics.rawg.match_score": ("RAWG_MatchScore", "int"),
    "diagnostics.rawg.matched_year": ("RAWG_MatchedYear", "int"),
    "diagnostics.igdb.matched_name": ("IGDB_MatchedName", "string"),
    "diagnostics.igdb.match_score": ("IGDB_MatchScore", "int"),
    "diagnostics.igdb.matched_year": ("IGDB_MatchedYear", "int"),
    "diagnostics.steam.matched_name": ("Steam_MatchedName", "string"),
    "diagnostics.steam.match_score": ("Steam_MatchScore", "int"),
    "diagnostics.steam.matched_year": ("Steam_MatchedYear", "int"),
    "diagnostics.steam.rejected_reason": ("Steam_RejectedReason", "string"),
    "diagnostics.hltb.matched_name": ("HLTB_MatchedName", "string"),
    "diagnostics.hltb.match_score": ("HLTB_MatchScore", "int"),
    "diagnostics.hltb.matched_year": ("HLTB_MatchedYear", "int"),
    "diagnostics.hltb.matched_platforms": ("HLTB_MatchedPlatforms", "list_csv"),
    "diagnostics.wikidata.matched_label": ("Wikidata_MatchedLabel", "string"),
    "diagnostics.wikidata.match_score": ("Wikidata_MatchScore", "int"),
    "diagnostics.wikidata.matched_year": ("Wikidata_MatchedYear", "int"),
    "diagnostics.review.tags": ("ReviewTags", "string"),
    "diagnostics.match.confidence": ("MatchConfidence", "string"),
}


def default_registry() -> Registry:
    """The standard registry: 150 metrics and 19 diagnostics."""
    section = lambda table: {key: {"column": column, "type": kind} for key, (column, kind) in table.items()}
    return registry_from_spec({"version": 2, "metrics": section(_METRICS), "diagnostics": section(_DIAGNOSTICS)})
