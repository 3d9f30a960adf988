"""Derived and composite scores of an enriched row: column expressions over registered columns, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.constants import MODDING_NEEDLES, REPLAY_NEEDLES, REPLAY_POINTS, SIGNALS, STORE_TYPE_CONTENT, SignalConfig
from catalith.functions.company import company_name_set, normalize_company
from catalith.functions.lists import clean_list, compact, contains_any, is_blank, tag_if, text
from catalith.functions.parse import owner_range, positive_hours
from catalith.functions.scores import blend, half_even, log_scale, log_weight, sum_if_any, within_0_100
from catalith.functions.text import normalize_tag, tag_text
from catalith.operators.consensus import company_majority, main_genre
from catalith.sources.registry import SPARK_TYPES, Registry

COMPANY_PROVIDERS = ("steam", "igdb", "rawg", "wikidata")


class Inputs:
    """Metric key -> Column over a frame with registered columns; a missing column is a typed NULL."""

    def __init__(self, df: DataFrame, registry: Registry):
        self.df, self.registry = df, registry

    def __call__(self, key: str) -> Column:
        column, type_ = self.registry.by_key.get(key, (None, "string"))
        if column and column in self.df.columns:
            return F.col(column)
        return F.lit(None).cast(SPARK_TYPES.get(type_, "string"))

    def number(self, key: str) -> Column:
        return self(key).cast("double")

    def integer(self, key: str) -> Column:
        column, _ = self.registry.by_key.get(key, (None, ""))
        c = self(key)
        if column in self.df.columns and self.df.schema[column].dataType.typeName() in ("double", "float"):
            return F.when(c == F.floor(c), c.cast("bigint"))
        return c.cast("bigint")


def reach_metrics(m: Inputs, cfg: SignalConfig = SIGNALS) -> dict[str, Column]:
    """Owner range, reach counters and the reach composite."""
    low, high, mid = owner_range(m("steamspy.owners"))
    reviews, rawg_votes = m.integer("steam.review_count"), m.integer("rawg.ratings_count")
    igdb_votes, critics = m.integer("igdb.score_count"), m.integer("igdb.critic_score_count")
    buckets = [m.integer(f"rawg.popularity.added_by_status.{s}") for s in ("owned", "playing", "beaten", "toplay", "dropped")]
    added = F.coalesce(m.integer("rawg.popularity.added_total"), sum_if_any(buckets))
    parts = [
        (mid, cfg.owners),
        (reviews, cfg.reviews),
        (rawg_votes, cfg.votes),
        (added, cfg.added),
        (igdb_votes, cfg.votes),
        (critics, cfg.critic_votes),
        (m.integer("wikipedia.pageviews_365d"), cfg.pageviews),
    ]
    return {
        "derived.reach.steamspy_owners_low": low,
        "derived.reach.steamspy_owners_high": high,
        "derived.reach.steamspy_owners_mid": mid,
        "derived.reach.steam_reviews": reviews,
        "derived.reach.rawg_ratings_count": rawg_votes,
        "derived.reach.igdb_rating_count": igdb_votes,
        "derived.reach.igdb_aggregated_rating_count": critics,
        "composite.reach.score_100": blend([(log_scale(v, s), s.weight) for v, s in parts]),
    }


def rating_metrics(m: Inputs) -> dict[str, Column]:
    """Community and critic composites."""
    spy_votes = F.coalesce(m.integer("steamspy.positive"), F.lit(0)) + F.coalesce(m.integer("steamspy.negative"), F.lit(0))
    community = [
        (m.number("steamspy.score_100"), log_weight(spy_votes)),
        (m.number("rawg.score_100"), log_weight(m.integer("rawg.ratings_count"))),
        (m.number("igdb.score_100"), log_weight(m.integer("igdb.score_count"))),
        (m.number("hltb.score_100"), 1.0),
    ]
    critic = [
        (within_0_100(m.number("steam.metacritic_100")), 1.0),
        (within_0_100(m.number("rawg.metacritic_100")), 1.0),
        (within_0_100(m.number("igdb.critic.score_100")), log_weight(m.integer("igdb.critic_score_count"))),
    ]
    return {
        "composite.community_rating.score_100": blend(community),
        "composite.critic_rating.score_100": blend(critic),
    }


def now_metrics(m: Inputs, cfg: SignalConfig = SIGNALS) -> dict[str, Column]:
    """Current-interest composite, launch interest and playtime copies."""
    parts = [
        (m.integer("steamspy.ccu"), cfg.ccu),
        (m.integer("steamspy.players_2weeks"), cfg.players_2w),
        (m.integer("wikipedia.pageviews_30d"), cfg.now_pageviews),
    ]
    return {
        "derived.now.steamspy_playtime_avg_2weeks": m.integer("steamspy.playtime_avg_2weeks"),
        "derived.now.steamspy_playtime_median_2weeks": m.integer("steamspy.playtime_median_2weeks"),
        "composite.now.score_100": blend([(log_scale(v, s), s.weight) for v, s in parts]),
        "composite.launch_interest.score_100": half_even(
            log_scale(m.integer("wikipedia.pageviews_first_90d"), cfg.now_pageviews)
        ),
    }


def non_content_addon(title: Column) -> Column:
    """Whether an add-on title is a soundtrack, art book, wallpaper, manual or strategy guide."""
    t = normalize_tag(title)
    return (
        contains_any(t, ("soundtrack", "artbook", "art book", "wallpaper"))
        | t.rlike(r"\bost\b")
        | t.rlike(r"\bmanual\b")
        | (t.rlike(r"\bguide\b") & F.contains(t, F.lit("strategy")))
    )


def related_counts(m: Inputs) -> tuple[Column, Column, Column]:
    """(content add-ons, expansions, ports)."""
    dlcs = F.filter(clean_list(m("igdb.relationships.dlcs")), lambda x: ~non_content_addon(x))
    return (
        F.size(dlcs),
        F.size(clean_list(m("igdb.relationships.expansions"))),
        F.size(clean_list(m("igdb.relationships.ports"))),
    )


def content_metrics(m: Inputs) -> dict[str, Column]:
    """Content type by two explicit votes, the signals behind it, conflict flag and related-content flags."""
    store = F.lower(text(m("steam.store_type")))
    steam_vote = F.lit("")
    for kind, content in STORE_TYPE_CONTENT.items():
        steam_vote = F.when(store == kind, content).otherwise(steam_vote)
    version, parent = ~is_blank(m("igdb.relationships.version_parent")), ~is_blank(m("igdb.relationships.parent_game"))
    igdb_vote = F.when(version, "port").when(parent, "dlc").otherwise("")
    both = (steam_vote != "") & (igdb_vote != "")
    same = both & (steam_vote == igdb_vote)
    dlcs, expansions, ports = related_counts(m)
    signals = compact(
        tag_if(store != "", F.concat(F.lit("steam:type="), store)),
        tag_if(version, "igdb:version_parent"),
        tag_if(parent, "igdb:parent_game"),
        tag_if(dlcs > 0, F.concat(F.lit("igdb:dlcs="), dlcs.cast("string"))),
        tag_if(expansions > 0, F.concat(F.lit("igdb:expansions="), expansions.cast("string"))),
        tag_if(ports > 0, F.concat(F.lit("igdb:ports="), ports.cast("string"))),
    )

    def or_null(c: Column) -> Column:
        return F.nullif(c, F.lit(""))

    value = F.when(both & ~same, "").when(steam_vote != "", steam_vote).otherwise(igdb_vote)
    voters = (
        F.when(same, "igdb+steam")
        .when(both, "")
        .when(steam_vote != "", "steam")
        .when(igdb_vote != "", "igdb")
        .otherwise("")
    )
    return {
        "derived.content_type.value": or_null(value),
        "derived.content_type.consensus_providers": or_null(voters),
        "derived.content_type.source_signals": or_null(F.array_join(signals, ", ")),
        "derived.content_type.conflict": F.when(both & ~same, "YES"),
        "derived.igdb.has_dlcs": F.when(dlcs > 0, True),
        "derived.igdb.has_expansions": F.when(expansions > 0, True),
        "derived.igdb.has_ports": F.when(ports > 0, True),
    }


def keyword_flags(combined: Column) -> dict[str, Column]:
    return {name: contains_any(combined, needles) for name, needles in REPLAY_NEEDLES.items()}


def replay_score(combined: Column, main: Column, extra: Column, completionist: Column) -> tuple[Column, Column]:
    """(score, signals) of the replayability heuristic; NULL without any input."""
    has = keyword_flags(combined)
    has["procedural"] = has["procedural"] & ~has["roguelike"]
    has["optional_content"] = F.coalesce(completionist / main >= 2.0, F.lit(False)) | F.coalesce(
        extra / main >= 1.5, F.lit(False)
    )
    points = F.lit(REPLAY_POINTS["base"])
    for name, cond in has.items():
        points = points + F.when(cond, REPLAY_POINTS[name]).otherwise(0)
    any_input = (combined != "") | F.coalesce(main, extra, completionist).isNotNull()
    signals = F.array_join(compact(*[tag_if(cond, name) for name, cond in has.items()]), ", ")
    return (
        F.when(any_input, F.least(points, F.lit(100)).cast("bigint")),
        F.when(any_input, F.nullif(signals, F.lit(""))),
    )


def modding_score(categories_text: Column) -> tuple[Column, Column, Column]:
    """(has workshop, score, signals); 0 when there are categories without a signal, NULL without categories."""
    some = categories_text != ""
    has = {name: contains_any(categories_text, needles) for name, (_p, needles) in MODDING_NEEDLES.items()}
    best = F.greatest(F.lit(0), *[F.when(has[n], p).otherwise(0) for n, (p, _needles) in MODDING_NEEDLES.items()])
    signals = F.array_join(compact(*[tag_if(cond, name) for name, cond in has.items()]), ", ")
    return (
        F.when(some & has["steam_workshop"], True),
        F.when(some, best.cast("bigint")),
        F.when(some, F.nullif(signals, F.lit(""))),
    )


KEYWORD_KEYS = (
    "steam.categories", "steamspy.popularity.tags", "igdb.game_modes", "rawg.tags", "rawg.genres", "igdb.genres",
)


def with_keyword_text(df: DataFrame, registry: Registry) -> DataFrame:
    """Add the searchable tag texts ``__keywords`` and ``__categories`` once, for the many needles to come."""
    m = Inputs(df, registry)
    return df.withColumns(
        {"__keywords": tag_text(*[m(k) for k in KEYWORD_KEYS]), "__categories": tag_text(m("steam.categories"))}
    )


def keyword_metrics(m: Inputs) -> dict[str, Column]:
    """Replayability and modding of a frame with :func:`with_keyword_text` columns."""
    hours = [positive_hours(m(f"hltb.time.{k}").cast("string")) for k in ("main", "extra", "completionist")]
    score, signals = replay_score(F.col("__keywords"), *hours)
    workshop, mod_score, mod_signals = modding_score(F.col("__categories"))
    return {
        "derived.replayability.score_100": score,
        "derived.replayability.source_signals": signals,
        "derived.modding.has_workshop": workshop,
        "derived.modding.score_100": mod_score,
        "derived.modding.source_signals": mod_signals,
    }


def with_company_consensus(df: DataFrame, registry: Registry) -> DataFrame:
    """Developers and publishers most providers share: names by provider priority, the providers and their number."""
    out = df
    m = Inputs(df, registry)
    for kind in ("developers", "publishers"):
        lists = {p: m(f"{p}.{kind}") for p in COMPANY_PROVIDERS}
        work = {f"__c_{p}": company_name_set(c) for p, c in lists.items()}
        out = out.withColumns(work)
        out = out.withColumn("__shared", company_majority({p: f"__c_{p}" for p in COMPANY_PROVIDERS}))
        out = out.withColumns({"__providers": F.col("__shared.providers"), "__keys": F.col("__shared.keys")}).drop("__shared")
        spelled = F.flatten(
            F.array(
                *[
                    F.when(
                        F.array_contains("__providers", p),
                        F.transform(
                            clean_list(lists[p]),
                            lambda n: F.struct(F.lower(normalize_company(n)).alias("key"), n.alias("name")),
                        ),
                    ).otherwise(F.array().cast("array<struct<key:string,name:string>>"))
                    for p in COMPANY_PROVIDERS
                ]
            )
        )
        out = out.withColumn("__spelled", spelled)
        names = F.transform(
            "__keys", lambda k: F.get(F.filter(F.col("__spelled"), lambda s: s["key"] == k), F.lit(0))["name"]
        )
        some = F.size("__providers") > 0
        metrics = {
            f"derived.companies.{kind}_consensus_providers": F.when(some, F.array_join("__providers", "+")),
            f"derived.companies.{kind}_consensus_provider_count": F.when(some, F.size("__providers").cast("bigint")),
            f"derived.companies.{kind}_consensus": F.when(some, names),
        }
        out = out.withColumns({registry.by_key[k][0]: v for k, v in metrics.items() if k in registry.by_key})
        out = out.drop(*work, "__providers", "__keys", "__spelled")
    return out


def with_main_genre(df: DataFrame, registry: Registry) -> DataFrame:
    m = Inputs(df, registry)
    keys = {"igdb": "igdb.genres", "rawg": "rawg.genres", "wikidata": "wikidata.genres", "steam": "steam.tags"}
    work = {f"__g_{p}": clean_list(m(k)) for p, k in keys.items()}
    out = df.withColumns(work).withColumn("__genre", main_genre({p: f"__g_{p}" for p in keys}))
    metrics = {
        "derived.genre.main": F.nullif(F.col("__genre.label"), F.lit("")),
        "derived.genre.sources": F.nullif(F.col("__genre.sources"), F.lit("")),
    }
    out = out.withColumns({registry.by_key[k][0]: v for k, v in metrics.items() if k in registry.by_key})
    return out.drop("__genre", *work)


def with_signals(df: DataFrame, registry: Registry, cfg: SignalConfig = SIGNALS) -> DataFrame:
    """All derived and composite metrics except the production tier; stale values are replaced."""
    stale = [c for k, (c, _t) in registry.by_key.items() if k.startswith(("derived.", "composite."))]
    out = with_main_genre(with_company_consensus(df.drop(*stale), registry), registry)
    out = with_keyword_text(out, registry)
    m = Inputs(out, registry)
    metrics = {
        **reach_metrics(m, cfg),
        **rating_metrics(m),
        **content_metrics(m),
        **keyword_metrics(m),
        **now_metrics(m, cfg),
    }
    scored = out.withColumns({registry.by_key[k][0]: v for k, v in metrics.items() if k in registry.by_key})
    return scored.drop("__keywords", "__categories")
