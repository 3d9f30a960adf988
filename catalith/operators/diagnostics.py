"""Import diagnostics: review tags and match confidence of a pinned row, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.constants import NOT_FOUND, STABLE_TAG_PREFIXES
from catalith.functions.lists import clean_list, is_blank, strings, tag_if, text
from catalith.functions.parse import is_yes
from catalith.functions.text import import_series_numbers, normalize_title, pc_like
from catalith.operators.consensus import (
    actionable_tags,
    consensus_tags,
    provider_consensus,
    set_outlier_tags,
    year_outlier_tags,
)

# What the tagging reads about each provider's pinned payload; `facts_from_payloads` in the plans builds these columns.
FACT_TYPES = {
    "rawg_year": "int", "igdb_year": "int", "steam_year": "int", "hltb_year": "int",
    "rawg_platforms": "array<string>", "igdb_platforms": "array<string>", "steam_platforms": "array<string>",
    "hltb_platforms": "array<string>",
    "rawg_genres": "array<string>", "igdb_genres": "array<string>",
    "igdb_steam_id": "string", "rawg_steam_id": "string", "igdb_related": "boolean", "steam_type": "string",
}


def split_tags(c: Column) -> Column:
    """Comma-joined tags as a list."""
    return clean_list(F.split(text(c), ","))


def add_tag(tags: Column, tag: str | Column) -> Column:
    """Tag list with one more tag, unless it is there."""
    return F.array_union(tags, F.array(F.lit(tag) if isinstance(tag, str) else tag))


def stable_tags(tags: Column) -> Column:
    """Tags that survive a recomputation."""

    def keep(t: Column) -> Column:
        cond = F.lit(False)
        for prefix in STABLE_TAG_PREFIXES:
            cond = cond | t.startswith(prefix)
        return cond

    return F.filter(tags, keep)


def _facts(df: DataFrame, pins: dict[str, Column], sources: set[str]) -> DataFrame:
    """Fact columns, typed NULL where absent, and NULL where the provider is off or not pinned."""
    out = {}
    for c, t in FACT_TYPES.items():
        provider = c.split("_", 1)[0]
        value = F.col(c).cast(t) if c in df.columns else F.lit(None).cast(t)
        pinned = (pins[provider] != "") & (pins[provider] != NOT_FOUND) & F.lit(provider in sources)
        if t == "array<string>":
            value = F.coalesce(value, strings(()))
            out[f"__f_{c}"] = F.when(pinned, value).otherwise(strings(()))
        else:
            out[f"__f_{c}"] = F.when(pinned, value)
    return df.withColumns(out)


def review_tags(df: DataFrame, sources: set[str] | None = None) -> DataFrame:
    """Recompute ``ReviewTags`` and ``MatchConfidence`` of catalog rows.

    Reads pins, matching diagnostics (``*_MatchedName``, ``*_MatchScore``) and the optional fact columns listed in
    ``FACT_TYPES``. Each provider's checks depend on that provider alone.
    """
    sources = sources if sources is not None else {"rawg", "igdb", "steam", "hltb"}
    before = list(df.columns)

    def col(c: str) -> Column:
        return text(F.col(c)) if c in before else F.lit("")

    def matched(prefix: str) -> Column:
        return col(f"{prefix}_MatchedName")

    pins = {"rawg": col("RAWG_ID"), "igdb": col("IGDB_ID"), "steam": col("Steam_AppID"), "hltb": col("HLTB_ID")}
    labels = {"rawg": "RAWG", "igdb": "IGDB", "steam": "Steam", "hltb": "HLTB"}
    on = {p: F.lit(p in sources) for p in pins}
    titles = {f"__m_{p}": F.when(on[p], matched(labels[p])).otherwise("") for p in pins}
    work = _facts(df, pins, sources).withColumns(titles)

    def fact(c: str) -> Column:
        return F.col(f"__f_{c}")

    years = {p: f"__f_{p}_year" for p in pins}
    work = provider_consensus(work, {p: f"__m_{p}" for p in pins}, years, min_providers=2, out="__cons")
    platforms = {p: f"__f_{p}_platforms" for p in pins}
    year_tags, platform_tags = year_outlier_tags(years), set_outlier_tags(platforms, "platform")
    work = work.withColumns({"__yt": year_tags, "__pt": platform_tags})
    cons, yt, pt = F.col("__cons"), F.col("__yt"), F.col("__pt")

    disabled = is_yes(F.col("Disabled")) if "Disabled" in before else F.lit(False)
    steam, named = pins["steam"], col("Name") != ""
    steam_expected = pc_like(F.col("Platform")) if "Platform" in before else F.lit(True)
    missing_store = on["steam"] & (steam == "") & steam_expected
    rejected = F.when(missing_store, col("Steam_RejectedReason")).otherwise("")
    other_platforms = F.array_distinct(F.concat(fact("rawg_platforms"), fact("igdb_platforms"), fact("hltb_platforms")))
    no_pc = (F.size(other_platforms) > 0) & ~F.array_contains(other_platforms, "pc")

    def unresolved(p: str) -> Column:
        return on[p] & (pins[p] != "") & (pins[p] != NOT_FOUND) & (matched(labels[p]) == "")

    gone = {p: on[p] & (pins[p] == NOT_FOUND) for p in pins}
    gone["hltb"] = on["hltb"] & ((pins["hltb"] == NOT_FOUND) | (col("HLTB_Query") == NOT_FOUND))
    missing = {p: on[p] & (pins[p] == "") for p in ("rawg", "igdb")}
    missing["hltb"] = on["hltb"] & ~gone["hltb"] & (matched("HLTB") == "")

    has_store = (steam != "") & (steam != NOT_FOUND)

    def disagrees(c: str) -> Column:
        return has_store & F.coalesce(fact(c).rlike(r"^\d+$") & (fact(c) != steam), F.lit(False))

    disagree = {"igdb": disagrees("igdb_steam_id"), "rawg": disagrees("rawg_steam_id")}
    scores = {
        p: F.when(on[p] & col(f"{labels[p]}_MatchScore").rlike(r"^\d+$"), col(f"{labels[p]}_MatchScore").try_cast("int"))
        for p in pins
    }
    edition = F.array_contains(yt, "year_outlier:steam") & F.coalesce(fact("igdb_related"), F.lit(False))
    genres_apart = (
        (F.size(fact("rawg_genres")) > 0)
        & (F.size(fact("igdb_genres")) > 0)
        & ~F.arrays_overlap(fact("rawg_genres"), fact("igdb_genres"))
    )
    actionable = actionable_tags(cons, years, yt, pt)
    store_named = on["steam"] & has_store & named & (matched("Steam") != "")
    series_apart = store_named & (
        import_series_numbers(normalize_title(F.col("Name"))) != import_series_numbers(normalize_title(matched("Steam")))
    )
    store_type = F.lower(text(fact("steam_type")))
    wrong_type = store_named & (store_type != "") & (store_type != "game")

    head = [
        tag_if(disabled, "disabled"),
        *[x for p in ("rawg", "igdb") for x in (
            tag_if(gone[p], f"{p}_not_found"), tag_if(missing[p], f"missing_{p}"), tag_if(unresolved(p), f"{p}_id_unresolved"))],
        tag_if(gone["steam"], "steam_not_found"),
        tag_if(rejected != "", "steam_rejected"),
        tag_if(rejected != "", F.concat(F.lit("steam_rejected:"), rejected)),
        tag_if(unresolved("steam"), "steam_id_unresolved"),
        tag_if(gone["hltb"], "hltb_not_found"),
        tag_if(missing["hltb"], "missing_hltb"),
        tag_if(disagree["igdb"], "steam_appid_disagree:igdb"),
        tag_if(disagree["rawg"], "steam_appid_disagree:rawg"),
        *[tag_if(scores[p] < 100, F.concat(F.lit(f"{p}_score:"), scores[p].cast("string"))) for p in pins],
        tag_if(missing_store & no_pc, "missing_steam_nonpc"),
        tag_if(missing_store & ~no_pc, "missing_steam"),
    ]
    tail = [
        tag_if(series_apart, "steam_series_mismatch"),
        tag_if(wrong_type, F.concat(F.lit("store_type_not_game:"), store_type)),
    ]
    tags = F.concat(
        F.array_compact(F.array(*head)),
        pt,
        F.array_compact(F.array(tag_if(edition, "edition_or_port_suspected"))),
        consensus_tags(cons),
        yt,
        F.array_compact(F.array(tag_if(genres_apart, "genre_disagree"))),
        actionable,
        F.array_compact(F.array(*tail)),
    )
    earlier = stable_tags(split_tags(F.col("ReviewTags"))) if "ReviewTags" in before else strings(())
    all_tags = F.concat(tags, F.array_except(earlier, tags))

    # The store type is judged after the years, so a bad type does not make a store-only year difference serious.
    only_store_year = (F.size(yt) > 0) & F.forall(yt, lambda t: t == "year_outlier:steam")
    paired = (
        F.coalesce(F.array_contains(cons["outliers"], "steam"), F.lit(False))
        | F.array_contains(pt, "platform_outlier:steam")
        | disagree["igdb"]
        | disagree["rawg"]
    )
    weak_year = only_store_year & ~paired

    def any_of(conds: list[Column]) -> Column:
        out = F.lit(False)
        for c in conds:
            out = out | F.coalesce(c, F.lit(False))
        return out

    low = any_of(
        [
            unresolved("rawg"), unresolved("igdb"), unresolved("steam"), rejected != "", disagree["igdb"], disagree["rawg"],
            *[s < 80 for s in scores.values()], F.size(pt) > 0, cons.isNotNull() & ~cons["has_majority"],
            (F.size(yt) > 0) & ~weak_year, F.size(actionable) > 0, series_apart, wrong_type,
        ]
    )
    medium = any_of(
        [
            missing["rawg"], missing["igdb"], missing["hltb"], missing_store & ~no_pc,
            *[(s >= 80) & (s < 95) for s in scores.values()], F.size(cons["outliers"]) > 0, weak_year, genres_apart,
        ]
    )
    confidence = F.when(disabled, "").when(low, "LOW").when(medium, "MEDIUM").otherwise("HIGH")
    keep = [c for c in before if c not in ("ReviewTags", "MatchConfidence", "NeedsReview")]
    return work.select(*keep, F.array_join(all_tags, ", ").alias("ReviewTags"), confidence.alias("MatchConfidence"))


def is_pinned(c: Column) -> Column:
    return ~is_blank(c) & (text(c) != NOT_FOUND)
