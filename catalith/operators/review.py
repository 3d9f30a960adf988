"""Review queue: the rows worth a look, most urgent first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.constants import (
    CONFIDENCE_POINTS,
    REVIEW,
    REVIEW_PREFIXES,
    TAG_POINTS,
    TAG_PREFIX_POINTS,
    ReviewConfig,
)
from catalith.functions.lists import is_blank, text
from catalith.functions.parse import is_yes
from catalith.functions.text import normalize_title, playtime_url, store_url
from catalith.operators.diagnostics import split_tags
from catalith.sources.registry import Registry

# Enriched metrics shown next to a row under review, in order (fixed values).
CONTEXT_KEYS = (
    "steam.name", "steam.website", "steam.short_description", "steam.developers", "steam.publishers",
    "rawg.name", "rawg.website", "rawg.description_raw", "rawg.developers", "rawg.publishers",
    "igdb.name", "igdb.summary", "igdb.websites", "igdb.developers", "igdb.publishers",
    "hltb.name", "wikidata.wikipedia", "wikipedia.page_url", "wikipedia.thumbnail", "wikipedia.summary",
)
_LEAD = (
    "RowId", "Name", "YearHint", "Platform", "MatchConfidence", "ReviewTags", "SuggestedTitle",
    "RAWG_ID", "IGDB_ID", "Steam_AppID", "HLTB_ID", "HLTB_Query", "Wikidata_QID",
)
_MATCH_FIELDS = ("MatchedName", "MatchedYear", "MatchScore")


def priority(tags: Column, confidence: Column) -> Column:
    """Urgency: points for confidence and for each tag."""
    conf = F.upper(text(confidence))
    start = F.lit(0)
    for level, points in CONFIDENCE_POINTS.items():
        start = start + F.when(conf == level, points).otherwise(0)

    def points_of(t: Column) -> Column:
        out = F.lit(0)
        for tag, points in TAG_POINTS.items():
            out = F.when(t == tag, points).otherwise(out)
        for prefix, points in TAG_PREFIX_POINTS:
            out = F.when(t.startswith(prefix), points).otherwise(out)
        return out

    return F.aggregate(tags, start, lambda acc, t: acc + points_of(t))


def needs_review(tags: Column, confidence: Column, disabled: Column) -> Column:
    """Active rows of low or medium confidence, or with an outlier tag."""

    def outlier(t: Column) -> Column:
        cond = F.lit(False)
        for prefix in REVIEW_PREFIXES:
            cond = cond | t.startswith(prefix)
        return cond

    return ~is_yes(disabled) & (F.upper(text(confidence)).isin(*CONFIDENCE_POINTS) | F.exists(tags, outlier))


def suggested_title(columns: list[str]) -> Column:
    """First matched title, in source preference order, that differs from the user's name."""
    own = normalize_title(F.col("Name"))
    picks = []
    for p in ("IGDB", "RAWG", "Steam", "HLTB"):
        c = f"{p}_MatchedName"
        if c in columns:
            picks.append(F.when(~is_blank(F.col(c)) & (normalize_title(F.col(c)) != own), text(F.col(c))))
    return F.coalesce(*picks, F.lit(""))


def review_queue(
    catalog: DataFrame, registry: Registry, enriched: DataFrame | None = None, cfg: ReviewConfig = REVIEW
) -> DataFrame:
    """The first ``max_rows`` rows by urgency, then name: a distributed top-k, no full sort.

    Rows are chosen before the enriched context is joined, so only the queue itself is widened. The catalog should be a
    stored table: the filter reads its tags.
    """
    cols = catalog.columns
    blank = F.lit("")
    tags = split_tags(F.col("ReviewTags")) if "ReviewTags" in cols else split_tags(blank)
    conf = F.col("MatchConfidence") if "MatchConfidence" in cols else blank
    off = F.col("Disabled") if "Disabled" in cols else blank
    work = catalog.withColumns({"__tags": tags, "__conf": conf})
    work = work.where(needs_review(F.col("__tags"), F.col("__conf"), off))
    work = work.withColumn("__priority", priority(F.col("__tags"), F.col("__conf")))
    order = [F.desc("__priority"), F.asc("Name"), F.asc("RowId")]
    queue = work.orderBy(*order).limit(cfg.max_rows)

    context: list[str] = []
    if enriched is not None:
        for key in ("steam.url", *CONTEXT_KEYS):
            c = registry.column(key)
            if c and c in enriched.columns and c not in cols:
                context.append(c)
        side = enriched.select(F.col("RowId").alias("__rk"), *context)
        queue = queue.join(side, F.col("RowId") == F.col("__rk"), "left").drop("__rk")
    have = set(cols) | set(context)
    for c, pin, build in (("Steam_URL", "Steam_AppID", store_url), ("HLTB_URL", "HLTB_ID", playtime_url)):
        own = text(F.col(c)) if c in have else blank
        made = build(F.col(pin)) if pin in cols else blank
        queue = queue.withColumn(c, F.when(own != "", own).otherwise(made))
    summary = registry.column("wikipedia.summary")
    if summary in have:
        s = F.col(summary)
        queue = queue.withColumn(
            summary, F.when(F.length(s) > 300, F.concat(F.substring(s, 1, 300), F.lit("…"))).otherwise(s)
        )
    queue = queue.withColumn("SuggestedTitle", suggested_title(cols))

    lead = list(_LEAD)
    for p in ("RAWG", "IGDB", "Steam"):
        lead += [f"{p}_{f}" for f in _MATCH_FIELDS]
    lead += ["Steam_RejectedReason", *[f"HLTB_{f}" for f in _MATCH_FIELDS], "HLTB_MatchedPlatforms"]
    lead += ["Wikidata_MatchedLabel", "Wikidata_MatchedYear", "Wikidata_MatchScore", "Steam_URL", "HLTB_URL"]
    lead += [registry.column(k) for k in CONTEXT_KEYS if registry.column(k)]
    out = [c for c in dict.fromkeys(lead) if c in queue.columns]
    out += [c for c in queue.columns if c not in out and not c.startswith("__")]
    return queue.orderBy(*order).select(*out)
