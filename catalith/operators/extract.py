"""Provider payloads (VARIANT) to metric expressions, one dict of ``metric key -> Column`` per provider.

Only the metrics a registry selects end up in the plan, so unselected paths are never read from the payload.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.constants import LIMITS, LINK_PROPERTIES, RELEASE_PROPERTY, ListLimits
from catalith.functions.company import split_company_list
from catalith.functions.lists import bind, clean_list, distinct_labels, strings, text
from catalith.functions.parse import (
    claim_date,
    claim_year,
    float_from_text,
    int_from_text,
    json_text,
    strict_float,
    strict_int,
    variant_at,
    year_from_epoch,
    year_from_text,
)
from catalith.functions.scores import half_even
from catalith.functions.text import drop_cyrillic, store_url, truncate, wiki_url
from catalith.operators.columns import apply_registry
from catalith.operators.crosswalk import linked_labels, store_id_from_external
from catalith.sources.registry import Registry

_NAMED = "array<struct<name:string>>"
_EXTERNAL = "array<struct<external_game_source:string,uid:string,category:string>>"
_INVOLVED = "array<struct<company:struct<name:string>,developer:boolean,publisher:boolean>>"


def _text(p: Column, path: str) -> Column:
    return json_text(variant_at(p, path))


def _int(p: Column, path: str) -> Column:
    return strict_int(variant_at(p, path))


def _names(p: Column, path: str) -> Column:
    """Names of a list of objects, or of a list of strings, or of one object."""

    def found(v: Column) -> Column:
        many = F.transform(variant_at(v, "$", _NAMED), lambda x: x["name"])
        one = variant_at(v, "$.name", "string")
        plain = F.when(F.schema_of_variant(v) == "ARRAY<STRING>", variant_at(v, "$", "array<string>"))
        return F.coalesce(plain, many, F.when(one.isNotNull(), F.array(one)))

    return distinct_labels(bind(variant_at(p, path), found))


def _strings(p: Column, path: str) -> Column:
    return distinct_labels(variant_at(p, path, "array<string>"))


def _field(p: Column, path: str, name: str) -> Column:
    return F.transform(variant_at(p, path, f"array<struct<{name}:string>>"), lambda x: x[name])


def rawg_metrics(p: Column) -> dict[str, Column]:
    platforms = F.transform(
        variant_at(p, "$.platforms", "array<struct<platform:struct<name:string>>>"), lambda x: x["platform"]["name"]
    )
    released = _text(p, "$.released")
    status = {
        f"rawg.popularity.added_by_status.{s}": _int(p, f"$.added_by_status.{s}")
        for s in ("owned", "playing", "beaten", "toplay", "dropped")
    }
    return {
        "rawg.id": _text(p, "$.id"),
        "rawg.name": _text(p, "$.name"),
        "rawg.name_original": _text(p, "$.name_original"),
        "rawg.released": released,
        "rawg.year": year_from_text(released).cast("bigint"),
        "rawg.website": _text(p, "$.website"),
        "rawg.description_raw": truncate(variant_at(p, "$.description_raw", "string"), 500, 500, "…"),
        "rawg.reddit_url": _text(p, "$.reddit_url"),
        "rawg.metacritic_url": _text(p, "$.metacritic_url"),
        "rawg.background_image": _text(p, "$.background_image"),
        "rawg.genres": _names(p, "$.genres"),
        "rawg.platforms": distinct_labels(platforms),
        "rawg.tags": distinct_labels(drop_cyrillic(F.transform(variant_at(p, "$.tags", _NAMED), lambda x: x["name"]))),
        "rawg.esrb": _text(p, "$.esrb_rating.name"),
        "rawg.score_100": half_even(strict_float(variant_at(p, "$.rating")) / 5.0 * 100.0),
        "rawg.ratings_count": _int(p, "$.ratings_count"),
        "rawg.metacritic_100": _int(p, "$.metacritic"),
        "rawg.popularity.added_total": _int(p, "$.added"),
        **status,
        "rawg.developers": _names(p, "$.developers"),
        "rawg.publishers": _names(p, "$.publishers"),
    }


def igdb_metrics(p: Column, limits: ListLimits = LIMITS) -> dict[str, Column]:
    involved = F.filter(variant_at(p, "$.involved_companies", _INVOLVED), lambda x: text(x["company"]["name"]) != "")

    def role(name: str) -> Column:
        return distinct_labels(F.transform(F.filter(involved, lambda x: x[name]), lambda x: x["company"]["name"]))

    lists = {
        "alternative_names": "alternative_names", "platforms": "platforms", "genres": "genres", "themes": "themes",
        "keywords": "keywords", "game_modes": "game_modes", "perspectives": "player_perspectives",
        "franchise": "franchises", "engine": "game_engines", "relationships.dlcs": "dlcs",
        "relationships.expansions": "expansions", "relationships.ports": "ports",
    }
    parents = {
        f"igdb.relationships.{k}": F.coalesce(F.get(_names(p, f"$.{k}"), F.lit(0)), F.lit(""))
        for k in ("parent_game", "version_parent")
    }
    return {
        "igdb.id": _text(p, "$.id"),
        "igdb.name": _text(p, "$.name"),
        "igdb.year": year_from_epoch(_int(p, "$.first_release_date")).cast("bigint"),
        "igdb.summary": truncate(variant_at(p, "$.summary", "string"), 500, 500, "…"),
        "igdb.websites": F.slice(F.array_distinct(clean_list(_field(p, "$.websites", "url"))), 1, limits.websites),
        **parents,
        **{f"igdb.{k}": _names(p, f"$.{field}") for k, field in lists.items()},
        "igdb.cross_ids.steam_app_id": store_id_from_external(variant_at(p, "$.external_games", _EXTERNAL)),
        "igdb.developers": role("developer"),
        "igdb.publishers": role("publisher"),
        "igdb.score_count": _int(p, "$.rating_count"),
        "igdb.critic_score_count": _int(p, "$.aggregated_rating_count"),
        "igdb.score_100": half_even(strict_float(variant_at(p, "$.rating"))),
        "igdb.critic.score_100": half_even(strict_float(variant_at(p, "$.aggregated_rating"))),
    }


def steam_metrics(p: Column, app_id: Column) -> dict[str, Column]:
    free = F.coalesce(variant_at(p, "$.is_free", "boolean"), F.lit(False))

    def flag(name: str, label: str) -> Column:
        return F.when(variant_at(p, f"$.platforms.{name}", "boolean"), F.lit(label))

    def companies(field: str) -> Column:
        one = F.array(variant_at(p, f"$.{field}", "string"))
        is_text = F.schema_of_variant(variant_at(p, f"$.{field}")) == "STRING"
        return F.when(is_text, one).otherwise(variant_at(p, f"$.{field}", "array<string>"))

    return {
        "steam.app_id": text(app_id),
        "steam.name": _text(p, "$.name"),
        "steam.url": store_url(app_id),
        "steam.website": _text(p, "$.website"),
        "steam.short_description": _text(p, "$.short_description"),
        "steam.store_type": F.lower(_text(p, "$.type")),
        "steam.release_year": year_from_text(variant_at(p, "$.release_date.date", "string")).cast("bigint"),
        "steam.platforms": F.array_compact(F.array(flag("windows", "Windows"), flag("mac", "macOS"), flag("linux", "Linux"))),
        "steam.tags": distinct_labels(_field(p, "$.genres", "description")),
        "steam.review_count": _int(p, "$.recommendations.total"),
        "steam.price": F.when(free, "Free").otherwise(_text(p, "$.price_overview.final_formatted")),
        "steam.categories": distinct_labels(_field(p, "$.categories", "description")),
        "steam.metacritic_100": _int(p, "$.metacritic.score"),
        "steam.developers": distinct_labels(split_company_list(companies("developers"))),
        "steam.publishers": distinct_labels(companies("publishers")),
    }


def tag_cloud(tags: Column, limit: int) -> Column:
    """``(name, count)`` pairs of a tag map: positive counts, most counted first, then by name."""
    pairs = F.transform(
        F.map_entries(tags), lambda e: F.struct((-int_from_text(e["value"])).alias("c"), F.lower(e["key"]).alias("k"), text(e["key"]).alias("name"))
    )
    kept = F.array_sort(F.filter(pairs, lambda e: (e["c"] < 0) & (e["name"] != "")))
    return F.slice(F.transform(kept, lambda e: F.struct(e["name"].alias("tag"), (-e["c"]).alias("count"))), 1, limit)


def steamspy_metrics(p: Column, limits: ListLimits = LIMITS) -> dict[str, Column]:
    def num(field: str) -> Column:
        return int_from_text(variant_at(p, f"$.{field}"))

    positive, negative = num("positive"), num("negative")
    votes = positive + negative
    tags = variant_at(p, "$.tags", "map<string,variant>")
    return {
        "steamspy.owners": _text(p, "$.owners"),
        "steamspy.players": num("players_forever"),
        "steamspy.players_2weeks": num("players_2weeks"),
        "steamspy.ccu": num("ccu"),
        "steamspy.playtime_avg": num("average_forever"),
        "steamspy.playtime_avg_2weeks": num("average_2weeks"),
        "steamspy.playtime_median_2weeks": num("median_2weeks"),
        "steamspy.playtime_median": num("median_forever"),
        "steamspy.positive": positive,
        "steamspy.negative": negative,
        "steamspy.score_100": F.when(votes > 0, half_even(positive / votes.cast("double") * 100.0)),
        "steamspy.price": num("price"),
        "steamspy.initial_price": num("initialprice"),
        "steamspy.discount_percent": num("discount"),
        "steamspy.developer": _text(p, "$.developer"),
        "steamspy.publisher": _text(p, "$.publisher"),
        "steamspy.popularity.tags": F.coalesce(
            distinct_labels(F.transform(tag_cloud(tags, limits.tags), lambda t: t["tag"])), strings(())
        ),
        "steamspy.popularity.tags_top": tag_cloud(tags, limits.top_tags),
    }


def hltb_metrics(p: Column) -> dict[str, Column]:
    review = float_from_text(variant_at(p, "$.review_score"))
    game_id = _text(p, "$.game_id")
    alias = variant_at(p, "$.game_alias")
    one = F.when(F.schema_of_variant(alias) == "STRING", F.array(variant_at(alias, "$", "string")))
    return {
        "hltb.id": F.when(F.lower(game_id) == "nan", "").otherwise(game_id),
        "hltb.name": _text(p, "$.game_name"),
        "hltb.time.main": float_from_text(variant_at(p, "$.main_story")),
        "hltb.time.extra": float_from_text(variant_at(p, "$.main_extra")),
        "hltb.time.completionist": float_from_text(variant_at(p, "$.completionist")),
        "hltb.release_year": int_from_text(variant_at(p, "$.release_world")),
        "hltb.platforms": _strings(p, "$.profile_platforms"),
        "hltb.score_100": F.when(review.between(0, 100), half_even(review)),
        "hltb.url": _text(p, "$.game_web_link"),
        "hltb.aliases": distinct_labels(F.coalesce(one, variant_at(alias, "$", "array<string>"))),
    }


def _language(p: Column, path: str) -> Column:
    """English value first (en, en-gb, en-ca), else the first non-blank language."""
    values = variant_at(p, path, "map<string,struct<value:string>>")
    picks = [F.nullif(text(F.try_element_at(values, F.lit(k))["value"]), F.lit("")) for k in ("en", "en-gb", "en-ca")]
    others = F.filter(F.transform(F.map_values(values), lambda v: text(v["value"])), lambda v: v != "")
    return F.coalesce(*picks, F.get(others, F.lit(0)), F.lit(""))


def claim_times(p: Column) -> Column:
    """Non-blank time strings of the release claims, in order."""
    claims = variant_at(p, f"$.claims.{RELEASE_PROPERTY}", "array<struct<mainsnak:struct<datavalue:struct<value:variant>>>>")
    return F.filter(
        F.transform(claims, lambda c: variant_at(c["mainsnak"]["datavalue"]["value"], "$.time", "string")),
        lambda t: F.coalesce(t, F.lit("")) != "",
    )


def wikidata_metrics(p: Column) -> dict[str, Column]:
    """Entity metrics except the linked labels, which :func:`wikidata_frame` joins in."""
    times = claim_times(p)
    dates = F.filter(F.transform(times, claim_date), lambda d: d != "")
    years = F.array_compact(F.transform(times, claim_year))
    title = F.coalesce(variant_at(p, "$.sitelinks.enwiki.title", "string"), F.lit(""))
    label = _language(p, "$.labels")
    return {
        "wikidata.qid": _text(p, "$.id"),
        "wikidata.label": F.when(label == "", title).otherwise(label),
        "wikidata.description": _language(p, "$.descriptions"),
        "wikidata.release_year": F.get(years, F.lit(0)).cast("bigint"),
        "wikidata.release_date": F.coalesce(F.get(dates, F.lit(0)), F.lit("")),
        "wikidata.enwiki_title": title,
        "wikidata.wikipedia": wiki_url(title),
    }


def entity_edges(payloads: DataFrame) -> DataFrame:
    """Linked entities of all payloads as ``(qid, prop, target)``."""
    claim = "array<struct<mainsnak:struct<datavalue:struct<value:struct<id:string>>>>>"
    per_prop = F.array(
        *[
            F.struct(F.lit(prop).alias("prop"), variant_at(F.col("payload"), f"$.claims.{prop}", claim).alias("claims"))
            for prop in LINK_PROPERTIES.values()
        ]
    )
    opened = payloads.select(F.col("id").alias("qid"), F.inline(per_prop))
    return opened.select("qid", "prop", F.explode("claims").alias("c")).select(
        "qid", "prop", text(F.col("c.mainsnak.datavalue.value.id")).alias("target")
    ).where("target <> ''")


def wikidata_frame(payloads: DataFrame, labels: DataFrame, registry: Registry) -> DataFrame:
    """Entity payloads ``(id, payload)`` to registered columns, linked labels included."""
    plain = apply_registry(payloads, wikidata_metrics(F.col("payload")), registry)
    linked = linked_labels(entity_edges(payloads), labels).withColumnRenamed("qid", "__qid")
    joined = plain.join(linked, F.col("id") == F.col("__qid"), "left")
    lists = {f"wikidata.{field}": F.coalesce(F.col(field), strings(())) for field in LINK_PROPERTIES}
    return apply_registry(joined, lists, registry).drop("__qid", *LINK_PROPERTIES)


def summary_metrics(p: Column) -> dict[str, Column]:
    """Encyclopedia summary payload: extract of at most 320 characters, thumbnail, page link."""
    return {
        "wikipedia.summary": truncate(variant_at(p, "$.extract", "string"), 317, 320, "..."),
        "wikipedia.thumbnail": _text(p, "$.thumbnail.source"),
        "wikipedia.page_url": _text(p, "$.content_urls.desktop.page"),
    }


def alternative_names(p: Column) -> Column:
    """Alternative names in payload order, distinct."""
    return F.array_distinct(clean_list(_field(p, "$.alternative_names", "name")))


def entity_aliases(p: Column, language: str = "en", limit: int = LIMITS.aliases) -> Column:
    """First aliases of one language, distinct."""
    return F.array_distinct(F.slice(clean_list(_field(p, f"$.aliases.{language}", "value")), 1, limit))


EXTRACTORS = {
    "rawg": lambda p, _id, _limits=LIMITS: rawg_metrics(p),
    "igdb": lambda p, _id, limits=LIMITS: igdb_metrics(p, limits),
    "steam": lambda p, id_, _limits=LIMITS: steam_metrics(p, id_),
    "steamspy": lambda p, _id, limits=LIMITS: steamspy_metrics(p, limits),
    "hltb": lambda p, _id, _limits=LIMITS: hltb_metrics(p),
    "wikidata": lambda p, _id, _limits=LIMITS: wikidata_metrics(p),
}


def extract(payloads: DataFrame, provider: str, registry: Registry, limits: ListLimits = LIMITS) -> DataFrame:
    """Payload table ``(id, payload)`` to the provider's registered columns, keyed by ``id``."""
    known = payloads.where(F.col("payload").isNotNull())
    return apply_registry(known, EXTRACTORS[provider](F.col("payload"), F.col("id"), limits), registry).drop("payload", "provider")
