"""Every registered metric of every provider, out of payloads built from orders, with values that vary from row to row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalith.constants import LINK_PROPERTIES
from catalith.functions.lists import is_tag_list
from catalith.operators.extract import EXTRACTORS, extract, wikidata_frame
from catalith.operators.series import last_day
from catalith.plans.enrich import with_pageviews
from catalith.sources.registry import default_registry
from catalith.workload.extraction import _ORDER, _named, _payload
from catalith.workload.frames import duck, spark_frame
from catalith.workload.registry import query


def _plain(df, columns: list[str]):
    """Columns as they are compared: NULL numbers as -1, lists joined by ``|``, tags as ``tag=count``."""
    out = [F.col("id")]
    for c in columns:
        kind = df.schema[c].dataType
        col = F.col(c)
        if is_tag_list(kind):
            col = F.transform(col, lambda t: F.concat_ws("=", t["tag"], t["count"].cast("string")))
        if kind.typeName() == "array":
            out.append(F.coalesce(F.array_join(col.cast("array<string>"), "|"), F.lit("")).alias(c))
        elif kind.typeName() == "string":
            out.append(F.coalesce(col, F.lit("")).alias(c))
        else:
            out.append(F.coalesce(col.cast("double"), F.lit(-1.0)).alias(c))
    return df.select(*out)


def _all_metrics(provider: str, body: Callable[[], dict[str, Column]], metrics: dict[str, str]) -> None:
    """Register ``<provider>_metrics``: ``metrics`` gives each registered key's value in SQL over :data:`_ORDER`."""
    columns = {default_registry().column(key): sql for key, sql in metrics.items()}

    @query(f"{provider}_metrics", "SELECT CAST(o_orderkey AS VARCHAR) AS id, " + ", ".join(f'{v} AS "{c}"' for c, v in columns.items()) + f" FROM {duck(_ORDER)}")
    def run(spark, sf):
        registry = default_registry()
        known = {k for k in EXTRACTORS[provider](F.col("payload"), F.col("id")) if k in registry.by_key}
        assert known == set(metrics), known ^ set(metrics)
        return _plain(extract(_payload(spark, sf, body()), provider, registry), list(columns))

    run.__doc__ = f"All registered metrics of {provider}."


def _s(c: str) -> Column:
    return F.col(c).cast("string")


def _cat(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _rawg() -> dict[str, Column]:
    k, price, cust = F.col("k"), F.col("price"), _s("o_custkey")
    return {
        "id": F.col("o_orderkey"), "name": _cat(" Order ", _s("o_orderkey"), "  "), "name_original": F.when(k != 4, _cat("Original ", cust)),
        "released": F.when(k != 3, _cat(_s("y"), "-0", _s("k"), "-11")), "website": _cat("http://w/", cust),
        "description_raw": F.when(k == 0, F.repeat(F.lit("word "), 120)).otherwise(_cat("text ", cust)),
        "reddit_url": F.when(k == 1, _cat("http://r/", cust)), "metacritic_url": _cat("http://m/", _s("k")), "background_image": F.when(k < 2, F.lit("img.png")),
        "genres": _named("Action", F.col("o_orderpriority"), " action "),
        "platforms": F.transform(F.array(F.lit("PC"), F.col("o_orderstatus"), F.lit("pc")), lambda n: F.struct(F.struct(n.alias("name")).alias("platform"))),
        "tags": _named("fast", "Экшен", "", "FAST", _cat("t", _s("k"))), "esrb_rating": F.struct(F.when(k > 0, _cat("E", _s("k"))).alias("name")),
        "rating": F.when(k != 0, k * F.lit(1.15)), "ratings_count": F.when(k != 1, price), "metacritic": F.when(k != 2, k + 60), "added": price * 2,
        "added_by_status": F.struct(*[F.when(k != n, price + n).alias(s) for n, s in enumerate(("owned", "playing", "beaten", "toplay", "dropped"))]),
        "developers": _named(_cat("Dev ", cust), "Shared"), "publishers": _named("Shared", "shared", _cat("Pub ", _s("k"))),
    }


_STATUS = {
    f"rawg.popularity.added_by_status.{s}": f"CASE WHEN k = {n} THEN -1.0 ELSE price + {n} END::DOUBLE" for n, s in enumerate(("owned", "playing", "beaten", "toplay", "dropped"))
}
_all_metrics("rawg", _rawg, {
    "rawg.id": "CAST(o_orderkey AS VARCHAR)", "rawg.name": "'Order ' || o_orderkey", "rawg.name_original": "CASE WHEN k = 4 THEN '' ELSE 'Original ' || o_custkey END",
    "rawg.released": "CASE WHEN k = 3 THEN '' ELSE y || '-0' || k || '-11' END", "rawg.year": "CASE WHEN k = 3 THEN -1 ELSE y END::DOUBLE",
    "rawg.website": "'http://w/' || o_custkey", "rawg.description_raw": "CASE WHEN k = 0 THEN rtrim(substr(repeat('word ', 120), 1, 500)) || '…' ELSE 'text ' || o_custkey END",
    "rawg.reddit_url": "CASE WHEN k = 1 THEN 'http://r/' || o_custkey ELSE '' END", "rawg.metacritic_url": "'http://m/' || k",
    "rawg.background_image": "CASE WHEN k < 2 THEN 'img.png' ELSE '' END", "rawg.genres": "'Action|' || o_orderpriority", "rawg.platforms": "'PC|' || o_orderstatus",
    "rawg.tags": "'fast|t' || k", "rawg.esrb": "CASE WHEN k > 0 THEN 'E' || k ELSE '' END",
    "rawg.score_100": "CASE WHEN k = 0 THEN -1.0 ELSE round_even(k * 1.15::DOUBLE / 5.0::DOUBLE * 100.0::DOUBLE, 0) END",
    "rawg.ratings_count": "CASE WHEN k = 1 THEN -1 ELSE price END::DOUBLE", "rawg.metacritic_100": "CASE WHEN k = 2 THEN -1 ELSE k + 60 END::DOUBLE",
    "rawg.popularity.added_total": "(price * 2)::DOUBLE", **_STATUS, "rawg.developers": "'Dev ' || o_custkey || '|Shared'", "rawg.publishers": "'Shared|Pub ' || k",
})

_IGDB_LISTS = {
    "alternative_names": "alternative_names", "platforms": "platforms", "genres": "genres", "themes": "themes", "keywords": "keywords", "game_modes": "game_modes",
    "perspectives": "player_perspectives", "franchise": "franchises", "engine": "game_engines", "relationships.dlcs": "dlcs", "relationships.expansions": "expansions",
    "relationships.ports": "ports",
}


def _igdb() -> dict[str, Column]:
    k, cust = F.col("k"), _s("o_custkey")
    seconds = F.date_diff(F.make_date("y", F.lit(3), F.lit(3)), F.lit("1970-01-01").cast("date")).cast("bigint") * 86400

    def company(name, dev, pub):
        return F.struct(F.struct(name.alias("name")).alias("company"), dev.alias("developer"), pub.alias("publisher"))

    lists = {field: _named(_cat(f"{field} ", _s("k")), _cat("x", cust), f"{field} 1") for field in _IGDB_LISTS.values()}
    return {
        "id": F.col("o_orderkey"), "name": _cat("G ", cust), "first_release_date": F.when(k != 2, seconds), "summary": F.when(k == 1, F.repeat(F.lit("abcd "), 130)).otherwise(_cat("s ", cust)),
        "websites": F.transform(F.array(*[_cat(u, _s("k")) for u in ("u", "v", "u", "w", "x", "y", "z")]), lambda u: F.struct(u.alias("url"))), **lists,
        "parent_game": F.struct(F.when(k == 1, _cat("Parent ", cust)).alias("name")), "version_parent": F.struct(F.when(k == 3, _cat("Version ", cust)).alias("name")),
        "external_games": F.array(F.struct(F.lit(5).alias("external_game_source"), F.lit("1").alias("uid")), F.struct(F.when(k != 0, 1).otherwise(7).alias("external_game_source"), cust.alias("uid"))),
        "involved_companies": F.array(company(_cat("Pub ", cust), F.lit(False), F.lit(True)), company(_cat("Dev ", F.col("o_orderstatus")), k != 3, F.lit(False)), company(_cat("Both ", _s("k")), k > 1, k > 2)),
        "rating": F.when(k != 4, k * F.lit(12.5)), "rating_count": F.col("price"), "aggregated_rating": k * F.lit(20.5), "aggregated_rating_count": F.when(k != 0, k),
    }


_all_metrics("igdb", _igdb, {
    "igdb.id": "CAST(o_orderkey AS VARCHAR)", "igdb.name": "'G ' || o_custkey", "igdb.year": "CASE WHEN k = 2 THEN -1 ELSE y END::DOUBLE",
    "igdb.summary": "CASE WHEN k = 1 THEN rtrim(substr(repeat('abcd ', 130), 1, 500)) || '…' ELSE 's ' || o_custkey END",
    "igdb.websites": "'u' || k || '|v' || k || '|w' || k || '|x' || k || '|y' || k",
    **{f"igdb.{key}": f"'{field} ' || k || '|x' || o_custkey || CASE WHEN k = 1 THEN '' ELSE '|{field} 1' END" for key, field in _IGDB_LISTS.items()},
    "igdb.relationships.parent_game": "CASE WHEN k = 1 THEN 'Parent ' || o_custkey ELSE '' END", "igdb.relationships.version_parent": "CASE WHEN k = 3 THEN 'Version ' || o_custkey ELSE '' END",
    "igdb.cross_ids.steam_app_id": "CASE WHEN k = 0 THEN '' ELSE CAST(o_custkey AS VARCHAR) END",
    "igdb.developers": "concat_ws('|', CASE WHEN k <> 3 THEN 'Dev ' || o_orderstatus END, CASE WHEN k > 1 THEN 'Both ' || k END)",
    "igdb.publishers": "'Pub ' || o_custkey || CASE WHEN k > 2 THEN '|Both ' || k ELSE '' END", "igdb.score_count": "price::DOUBLE",
    "igdb.score_100": "CASE WHEN k = 4 THEN -1.0 ELSE round_even(k * 12.5::DOUBLE, 0) END", "igdb.critic_score_count": "CASE WHEN k = 0 THEN -1 ELSE k END::DOUBLE",
    "igdb.critic.score_100": "round_even(k * 20.5::DOUBLE, 0)",
})


def _steam() -> dict[str, Column]:
    k, cust = F.col("k"), _s("o_custkey")

    def described(*names):
        return F.transform(F.array(*[_cat(n) if isinstance(n, str) else n for n in names]), lambda n: F.struct(n.alias("description")))

    return {
        "name": _cat(" S ", cust), "type": F.when(k == 0, "DLC").otherwise("Game"), "website": F.when(k != 1, _cat("http://s/", cust)), "short_description": _cat("about ", cust),
        "is_free": k == 0, "price_overview": F.struct(_cat("$", _s("price")).alias("final_formatted")),
        "platforms": F.struct((k == 1).alias("windows"), (k == 2).alias("mac"), (k != 3).alias("linux")),
        "release_date": F.struct(F.when(k != 4, _cat("3 Mar, ", _s("y"))).otherwise("soon").alias("date")), "recommendations": F.struct(F.when(k != 2, F.col("price")).alias("total")),
        "metacritic": F.struct(F.when(k > 1, k * 20).alias("score")), "genres": described("Indie", _cat("g", _s("k")), "INDIE"), "categories": described("Co-op", _cat("c", _s("k")), "co-op"),
        "developers": F.array(_cat("Ubisoft ", _s("k"), ", Toronto, and ", cust), F.lit("B")), "publishers": F.array(_cat("P ", cust), F.lit("b"), F.lit("B")),
    }


_all_metrics("steam", _steam, {
    "steam.app_id": "CAST(o_orderkey AS VARCHAR)", "steam.name": "'S ' || o_custkey", "steam.url": "'https://store.steampowered.com/app/' || o_orderkey || '/'",
    "steam.website": "CASE WHEN k = 1 THEN '' ELSE 'http://s/' || o_custkey END", "steam.short_description": "'about ' || o_custkey", "steam.store_type": "CASE WHEN k = 0 THEN 'dlc' ELSE 'game' END",
    "steam.release_year": "CASE WHEN k = 4 THEN -1 ELSE y END::DOUBLE",
    "steam.platforms": "concat_ws('|', CASE WHEN k = 1 THEN 'Windows' END, CASE WHEN k = 2 THEN 'macOS' END, CASE WHEN k <> 3 THEN 'Linux' END)", "steam.tags": "'Indie|g' || k",
    "steam.review_count": "CASE WHEN k = 2 THEN -1 ELSE price END::DOUBLE", "steam.price": "CASE WHEN k = 0 THEN 'Free' ELSE '$' || price END", "steam.categories": "'Co-op|c' || k",
    "steam.metacritic_100": "CASE WHEN k > 1 THEN k * 20 ELSE -1 END::DOUBLE", "steam.developers": "'Ubisoft ' || k || '|Ubisoft Toronto|' || o_custkey || '|B'", "steam.publishers": "'P ' || o_custkey || '|b'",
})
_SPY_NUMBERS = {
    "players": "players_forever", "players_2weeks": "players_2weeks", "ccu": "ccu", "playtime_avg": "average_forever", "playtime_avg_2weeks": "average_2weeks",
    "playtime_median_2weeks": "median_2weeks", "playtime_median": "median_forever", "price": "price", "initial_price": "initialprice", "discount_percent": "discount",
}


def _steamspy() -> dict[str, Column]:
    k, price = F.col("k"), F.col("price")
    numbers = {field: F.when(k != n % 5, (price + n).cast("string")).otherwise("n/a") for n, field in enumerate(_SPY_NUMBERS.values())}
    tags = F.transform(F.sequence(F.lit(1), F.lit(6)), lambda i: F.struct(F.concat(F.lit("t"), i.cast("string")), (i * 10 + k).cast("string")))
    return {
        "owners": _cat(_s("price"), " .. ", (price * 2).cast("string")), **numbers, "positive": price, "negative": F.when(k != 0, F.col("o_custkey")),
        "developer": _cat("D ", _s("o_custkey")), "publisher": F.when(k != 3, F.lit("P")), "tags": F.map_from_entries(tags),
    }


_all_metrics("steamspy", _steamspy, {
    "steamspy.owners": "price || ' .. ' || price * 2", **{f"steamspy.{key}": f"CASE WHEN k = {n % 5} THEN -1 ELSE price + {n} END::DOUBLE" for n, key in enumerate(_SPY_NUMBERS)},
    "steamspy.positive": "price::DOUBLE", "steamspy.negative": "CASE WHEN k = 0 THEN -1 ELSE o_custkey END::DOUBLE",
    "steamspy.score_100": "CASE WHEN k = 0 OR price + o_custkey = 0 THEN -1.0 ELSE round_even(price / (price + o_custkey)::DOUBLE * 100.0::DOUBLE, 0) END",
    "steamspy.developer": "'D ' || o_custkey", "steamspy.publisher": "CASE WHEN k = 3 THEN '' ELSE 'P' END",
    "steamspy.popularity.tags": "array_to_string(list_transform(range(6, 0, -1), lambda i: 't' || i), '|')",
    "steamspy.popularity.tags_top": "array_to_string(list_transform(range(6, 0, -1), lambda i: 't' || i || '=' || (i * 10 + k)), '|')",
})


def _hltb() -> dict[str, Column]:
    k = F.col("k")
    return {
        "game_id": F.col("o_orderkey"), "game_name": _cat("H ", _s("o_custkey")), "main_story": F.when(k != 0, (k + 0.5).cast("string")).otherwise("--"), "main_extra": k + F.lit(1.25),
        "completionist": F.when(k != 2, F.col("price").cast("double")), "review_score": k * F.lit(30.5), "release_world": F.when(k != 1, _s("y")), "game_web_link": _cat("http://h/", _s("o_orderkey")),
        "profile_platforms": F.array(F.lit("PC"), _cat("P", _s("k")), F.lit("pc")), "game_alias": F.when(k != 4, _cat("Alias ", F.col("o_orderstatus"))),
    }


_all_metrics("hltb", _hltb, {
    "hltb.name": "'H ' || o_custkey", "hltb.time.main": "CASE WHEN k = 0 THEN -1.0 ELSE k + 0.5 END::DOUBLE", "hltb.time.extra": "(k + 1.25)::DOUBLE",
    "hltb.time.completionist": "CASE WHEN k = 2 THEN -1 ELSE price END::DOUBLE", "hltb.release_year": "CASE WHEN k = 1 THEN -1 ELSE y END::DOUBLE", "hltb.platforms": "'PC|P' || k",
    "hltb.score_100": "CASE WHEN k = 4 THEN -1.0 ELSE round_even(k * 30.5::DOUBLE, 0) END", "hltb.url": "'http://h/' || o_orderkey", "hltb.aliases": "CASE WHEN k = 4 THEN '' ELSE 'Alias ' || o_orderstatus END",
})

_LABELS = """SELECT 'Q' || CAST(c_custkey AS STRING) AS qid, CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE '' END AS label,
    CASE WHEN c_custkey % 3 = 1 THEN 'Site_' || CAST(c_custkey AS STRING) ELSE '' END AS site_title FROM {customer}"""
_SHOWN = "CASE WHEN label <> '' THEN label WHEN site_title <> '' THEN replace(site_title, '_', ' ') ELSE '__NOT_FOUND__' END"


def _linked(n: int) -> str:
    """The label of customer ``o_custkey + n``; unknown ones show nothing, and the first property names two."""
    more = ", 'Q' || (o_custkey + 100)" if n == 0 else ""
    return f"coalesce((SELECT string_agg(v, '|' ORDER BY v) FROM (SELECT DISTINCT {_SHOWN} AS v FROM lb WHERE qid IN ('Q' || (o_custkey + {n}){more}))), '')"


@query(
    "wikidata_metrics",
    f"""WITH lb AS {duck(_LABELS)} SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_orderkey AS VARCHAR) AS "Wikidata_QID",
    CASE k WHEN 0 THEN 'en ' || o_orderkey WHEN 1 THEN 'gb' WHEN 2 THEN 'Titel ' || o_custkey ELSE 'Page ' || o_orderkey END AS "Wikidata_Label",
    CASE WHEN k = 3 THEN '' ELSE 'd ' || o_custkey END AS "Wikidata_Description", CASE WHEN k = 4 THEN -1 ELSE y END::DOUBLE AS "Wikidata_ReleaseYear",
    CASE WHEN k = 4 THEN '' ELSE y || '-02-03' END AS "Wikidata_ReleaseDate", 'Page ' || o_orderkey AS "Wikidata_EnwikiTitle",
    'https://en.wikipedia.org/wiki/Page_' || o_orderkey AS "Wikidata_Wikipedia",
    {', '.join(f'{_linked(n)} AS "{default_registry().column(f"wikidata.{field}")}"' for n, field in enumerate(LINK_PROPERTIES))} FROM {duck(_ORDER)}""",
)
def wikidata_metrics(spark, sf):
    """All registered metrics of entities: six kinds of linked labels, some with a site title only, some without any, some unknown."""
    registry = default_registry()
    df = wikidata_frame(_payload(spark, sf, _wikidata()), spark_frame(spark, sf, _LABELS), registry)
    keys = ("qid", "label", "description", "release_year", "release_date", "enwiki_title", "wikipedia", *LINK_PROPERTIES)
    return _plain(df, [registry.column(f"wikidata.{key}") for key in keys])


def _wikidata() -> dict[str, Column]:
    k, cust = F.col("k"), F.col("o_custkey")

    def claim(*values):
        return F.array(*[F.struct(F.struct(F.struct(v.alias("value")).alias("datavalue")).alias("mainsnak")) for v in values])

    def entity(n: int) -> Column:
        return F.struct(F.concat(F.lit("Q"), (cust + n).cast("string")).alias("id"))

    def value(cond, v) -> Column:
        return F.when(cond, F.struct(v.alias("value")))

    links = {prop: claim(entity(n), *([entity(100)] if n == 0 else [])) for n, prop in enumerate(LINK_PROPERTIES.values())}
    time = F.when(k != 4, F.concat(F.lit("+"), _s("y"), F.lit("-02-03T00:00:00Z")))
    return {
        "id": _s("o_orderkey"),
        "labels": F.struct(value(k == 0, _cat("en ", _s("o_orderkey"))).alias("en"), value(k <= 1, F.lit("gb")).alias("en-gb"), value(k == 2, _cat("Titel ", _s("o_custkey"))).alias("de")),
        "descriptions": F.struct(value(k != 3, _cat("d ", _s("o_custkey"))).alias("en")),
        "sitelinks": F.struct(F.struct(_cat("Page ", _s("o_orderkey")).alias("title")).alias("enwiki")),
        "claims": F.struct(claim(F.struct(time.alias("time"))).alias("P577"), *[v.alias(prop) for prop, v in links.items()]),
    }


_ARTICLES = "SELECT 'user ' || CAST(user_id AS STRING) AS article, CAST(ts AS DATE) AS day, count(*) AS views FROM {events} GROUP BY user_id, CAST(ts AS DATE)"
_ENTITIES = """SELECT u AS id, CASE WHEN u % 7 = 0 THEN '' ELSE 'user ' || CAST(u AS STRING) END AS title, CASE u % 3 WHEN 0 THEN '2024-01-05' WHEN 1 THEN '' ELSE '2011-11-11' END AS released
    FROM (SELECT DISTINCT user_id AS u FROM {events}) t"""


def _sum(cond: str) -> str:
    return f"CASE WHEN a.article IS NULL THEN -1 ELSE coalesce((SELECT sum(views) FROM s WHERE s.article = e.title AND {cond}), 0) END::DOUBLE"


@query(
    "pageview_metrics",
    f"""WITH s AS {duck(_ARTICLES)}, l AS (SELECT max(day) AS last FROM s), e AS {duck(_ENTITIES)}, a AS (SELECT DISTINCT article FROM s)
    SELECT CAST(id AS VARCHAR) AS id, {', '.join(f'{_sum(f"day > last - {n} AND day <= last")} AS "Wikidata_Pageviews{n}d"' for n in (30, 90, 365))},
    {', '.join(f'''CASE WHEN released <> '2024-01-05' THEN -1 ELSE {_sum(f"day >= DATE '2024-01-05' AND day < DATE '2024-01-05' + {n} AND day <= last")} END::DOUBLE AS "Wikidata_PageviewsFirst{n}d"''' for n in (30, 90))},
    CASE WHEN title = '' THEN '' WHEN id % 5 = 0 THEN rtrim(substr(repeat('word ', 80), 1, 317)) || '...' ELSE 'about ' || id END AS "Wikidata_WikipediaSummary",
    CASE WHEN title = '' THEN '' ELSE 'http://img/' || id END AS "Wikidata_WikipediaThumbnail", CASE WHEN title = '' THEN '' ELSE 'http://page/' || id END AS "Wikidata_WikipediaPage"
    FROM e CROSS JOIN l LEFT JOIN a ON a.article = e.title""",
)
def pageview_metrics(spark, sf):
    """Trailing and launch views, summary, thumbnail and page of every entity that has an article."""
    registry = default_registry()
    entities = spark_frame(spark, sf, _ENTITIES)
    frame = entities.select("id", F.col("title").alias(registry.column("wikidata.enwiki_title")), F.col("released").alias(registry.column("wikidata.release_date")))
    text = F.when(F.col("id") % 5 == 0, F.repeat(F.lit("word "), 80)).otherwise(_cat("about ", _s("id")))
    body = F.struct(
        text.alias("extract"), F.struct(_cat("http://img/", _s("id")).alias("source")).alias("thumbnail"),
        F.struct(F.struct(_cat("http://page/", _s("id")).alias("page")).alias("desktop")).alias("content_urls"),
    )
    summaries = entities.where("title <> ''").select(F.col("title").alias("article"), F.parse_json(F.to_json(body)).alias("payload"))
    series = spark_frame(spark, sf, _ARTICLES)
    out = with_pageviews(frame, series, summaries, registry, last_day(series)).withColumn("id", _s("id"))
    keys = ("pageviews_30d", "pageviews_90d", "pageviews_365d", "pageviews_first_30d", "pageviews_first_90d", "summary", "thumbnail", "page_url")
    return _plain(out, [registry.column(f"wikipedia.{key}") for key in keys])
