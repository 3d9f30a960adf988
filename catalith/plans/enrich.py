"""Enrichment: pins to payloads to typed metrics, overlaid on the user's columns, scored and ordered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.constants import ENRICH_SOURCES, NOT_FOUND, PROVIDER_PREFIX, SOURCE_ALIASES
from catalith.functions.lists import is_blank, text
from catalith.functions.parse import iso_date
from catalith.functions.text import normalize_title
from catalith.operators.columns import (
    active_rows,
    clear_when_not_found,
    columns_with_values,
    drop_deprecated,
    drop_diagnostics,
    is_processed,
    parse_sources,
    personal_base,
    reorder,
    with_missing_columns,
)
from catalith.operators.extract import extract, summary_metrics, wikidata_frame
from catalith.operators.keys import lookup, missing_rows
from catalith.operators.overlay import overlay, overlay_providers, with_recomputed
from catalith.operators.series import launch_sums, trailing_sums
from catalith.operators.signals import with_signals
from catalith.operators.tiers import with_production_tier
from catalith.operators.validation import validation_report
from catalith.sources.registry import Registry

PIN_OF = {
    "rawg": "RAWG_ID", "igdb": "IGDB_ID", "steam": "Steam_AppID", "steamspy": "Steam_AppID", "hltb": "HLTB_ID",
    "wikidata": "Wikidata_QID",
}
# Metrics that mark a row as done for a provider (fixed values).
REQUIRED = {
    "rawg": ("rawg.id", "rawg.year", "rawg.genres"),
    "igdb": ("igdb.name",),
    "steam": ("steam.name",),
    "steamspy": ("steamspy.owners",),
    "hltb": ("hltb.time.main",),
    "wikidata": ("wikidata.label",),
}


def with_overrides(df: DataFrame, overrides: DataFrame | None, pin: str) -> DataFrame:
    """Pin column with the user's overrides on top; ``__moved`` tells where the override changed it."""
    own = text(F.col(pin)) if pin in df.columns else F.lit("")
    if overrides is None:
        return df.withColumns({pin: own, "__moved": F.lit(False)})
    side = overrides.select(F.col("RowId").alias("__ok"), text(F.col(pin)).alias("__pin"))
    joined = df.withColumn(pin, own).join(side, F.col("RowId") == F.col("__ok"), "left")
    given = F.coalesce(F.col("__pin"), F.lit("")) != ""
    return joined.withColumns(
        {"__moved": given & (F.col("__pin") != F.col(pin)), pin: F.when(given, F.col("__pin")).otherwise(F.col(pin))}
    ).drop("__ok", "__pin")


def enrich_provider(
    catalog: DataFrame,
    provider: str,
    payloads: DataFrame,
    registry: Registry,
    overrides: DataFrame | None = None,
    labels: DataFrame | None = None,
) -> DataFrame:
    """One provider's frame: row id, name and registered columns of all named rows.

    Rows whose pin is the not-found sentinel are cleared; rows already filled keep their values unless the pin moved
    (or, for playtimes, unless the stored name differs from the query). Each pinned payload is extracted once.
    """
    pin, prefix = PIN_OF[provider], PROVIDER_PREFIX[provider]
    rows = with_overrides(active_rows(with_missing_columns(catalog, {pin: ""})), overrides, pin)
    if provider == "hltb" and "HLTB_Query" in rows.columns:
        rows = rows.withColumn(pin, F.when(text(F.col("HLTB_Query")) == NOT_FOUND, NOT_FOUND).otherwise(F.col(pin)))
    rows = clear_when_not_found(rows, pin, prefix)
    required = [c for c in (registry.column(k) for k in REQUIRED[provider]) if c]
    done = is_processed(rows, required) & ~F.col("__moved")
    if provider == "hltb" and {"HLTB_Name"} <= set(rows.columns):
        query = F.coalesce(F.nullif(text(F.col("HLTB_Query")), F.lit("")), F.col("Name")) if "HLTB_Query" in rows.columns else F.col("Name")
        done = done & (normalize_title(F.col("HLTB_Name")) == normalize_title(query))
    own = [c for c in rows.columns if c.startswith(prefix) and c != pin]
    rows = rows.select("RowId", "Name", pin, *own, done.alias("__done"))

    wanted = rows.where(~F.col("__done") & ~is_blank(F.col(pin))).select(text(F.col(pin)).alias("id")).distinct()
    known = payloads.join(wanted, "id", "left_semi")
    if provider == "wikidata" and labels is not None:
        fresh = wikidata_frame(known.where("payload is not null"), labels, registry).drop("payload", "provider")
    else:
        fresh = extract(known, provider, registry)
    new = [c for c in fresh.columns if c != "id"]
    asked = rows.withColumn("__ask", F.when(~F.col("__done"), F.col(pin)))
    found = lookup(asked.select("RowId", "__ask"), fresh, "__ask", "id", "RowId").select("RowId", *new)
    out = overlay(rows.drop("__done"), found, "RowId")
    return out


def with_pageviews(
    wikidata: DataFrame, series: DataFrame, summaries: DataFrame | None, registry: Registry, as_of: Column
) -> DataFrame:
    """Encyclopedia metrics on the entity frame: trailing and launch sums of its article, summary texts.

    ``series``: ``article, day, views``; ``summaries``: ``article, payload``. Each distinct (article, release) is
    computed once and joined back.
    """
    title, release = registry.column("wikidata.enwiki_title"), registry.column("wikidata.release_date")
    tasks = wikidata.where(~is_blank(F.col(title))).select(
        F.col(title).alias("article"), F.col(release).alias("release_text")
    ).distinct()
    recent = trailing_sums(series, "article", as_of, (30, 90, 365))
    dated = tasks.withColumn("release", iso_date(F.col("release_text"))).where("release is not null")
    dated = dated.join(series.select("article").distinct(), "article", "left_semi")
    keyed = series.join(dated.select("article", "release_text", "release"), "article").withColumn(
        "task", F.concat_ws("|", "article", "release_text")
    )
    launches = launch_sums(
        keyed.select("task", "day", "views"),
        dated.select(F.concat_ws("|", "article", "release_text").alias("task"), "release"),
        "task",
        as_of,
    )
    out = wikidata.join(recent.withColumnRenamed("article", "__a"), F.col(title) == F.col("__a"), "left").drop("__a")
    out = out.withColumn("__task", F.concat_ws("|", F.col(title), F.col(release)))
    out = out.join(launches.withColumnRenamed("task", "__t"), F.col("__task") == F.col("__t"), "left").drop("__t", "__task")
    names = {
        "views_30d": "wikipedia.pageviews_30d", "views_90d": "wikipedia.pageviews_90d",
        "views_365d": "wikipedia.pageviews_365d", "views_first_30d": "wikipedia.pageviews_first_30d",
        "views_first_90d": "wikipedia.pageviews_first_90d",
    }
    out = out.withColumnsRenamed({c: registry.column(k) or c for c, k in names.items()})
    if summaries is not None:
        texts = summaries.select(
            F.col("article").alias("__a"),
            *[v.alias(registry.column(k)) for k, v in summary_metrics(F.col("payload")).items() if registry.column(k)],
        )
        out = out.join(texts, F.col(title) == F.col("__a"), "left").drop("__a")
    return out


def reuse_or_compute(catalog: DataFrame, earlier: DataFrame | None, compute) -> DataFrame:
    """Keep an earlier provider frame and compute only the rows it lacks (``compute``: rows -> frame)."""
    if earlier is None:
        return compute(catalog)
    return with_recomputed(earlier, compute(missing_rows(catalog, earlier)))


def enrich(
    catalog: DataFrame,
    payloads: dict[str, DataFrame],
    registry: Registry,
    sources: str = "all",
    tiers: DataFrame | None = None,
    labels: DataFrame | None = None,
    series: DataFrame | None = None,
    summaries: DataFrame | None = None,
    as_of: Column | None = None,
    earlier: dict[str, DataFrame] | None = None,
    overrides: DataFrame | None = None,
) -> DataFrame:
    """The merged catalog: user columns and pins, all provider columns, derived and composite scores, in view order.

    ``payloads`` maps provider to ``(id, payload VARIANT)``. One lazy plan; providers are independent stages.
    """
    chosen = parse_sources(sources, ENRICH_SOURCES, SOURCE_ALIASES)
    base = personal_base(catalog, registry.diagnostic_columns)
    frames: dict[str, DataFrame] = {}
    for provider in (p for p in PROVIDER_PREFIX if p in chosen and p in payloads):
        def compute(rows: DataFrame, provider: str = provider) -> DataFrame:
            return enrich_provider(rows, provider, payloads[provider], registry, overrides, labels)

        frame = reuse_or_compute(base, (earlier or {}).get(provider), compute)
        if provider == "wikidata" and series is not None:
            frame = with_pageviews(frame, series, summaries, registry, as_of if as_of is not None else F.date_sub(F.current_date(), 1))
        frames[provider] = frame
    merged = with_signals(overlay_providers(base, frames), registry)
    if tiers is not None:
        merged = with_production_tier(merged, tiers, registry)
    return drop_deprecated(drop_diagnostics(reorder(merged, registry), registry.diagnostic_columns))


PRESENCE = {
    "rawg": "RAWG_ID", "igdb": "IGDB_ID", "steam": "Steam_AppID", "steamspy": "SteamSpy_Owners", "hltb": "HLTB_Main",
    "wikidata": "Wikidata_QID",
}


def validate(enriched: DataFrame, sources: str = "all") -> DataFrame:
    """Validation report over the providers asked for plus those that fill any row of the table."""
    chosen = set(parse_sources(sources, ENRICH_SOURCES, SOURCE_ALIASES))
    has = columns_with_values(enriched, list(PRESENCE.values())).first()
    chosen |= {p for p, c in PRESENCE.items() if has[c]}
    return validation_report(enriched, chosen)
