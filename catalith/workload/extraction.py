"""Nested JSON payloads to typed metrics. Payloads are built from orders, lines and titles, then read back as JSON."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalith.functions.parse import float_from_text, int_from_text, json_text, strict_float, strict_int, variant_at
from catalith.operators.extract import alternative_names, entity_aliases, extract, summary_metrics, tag_cloud, wikidata_frame
from catalith.operators.profile import path_types
from catalith.sources.registry import default_registry
from catalith.workload.frames import duck, spark_frame
from catalith.workload.registry import query

# One row per order: what a payload of it holds. Lists are built from the lines by grouping.
_ORDER = """SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, CAST(year(o_orderdate) AS INT) AS y,
    CAST(floor(o_totalprice) AS BIGINT) AS price, o_orderkey % 5 AS k FROM {orders}"""


def _payload(spark, sf, fields: dict):
    """Payloads of all orders. Small rows become long work, so they are dealt to all cores first: a file of a few MB is one split."""
    df = spark_frame(spark, sf, _ORDER).repartition(4 * spark.sparkContext.defaultParallelism)
    body = F.struct(*[v.alias(k) for k, v in fields.items()])
    return df.select(F.col("o_orderkey").cast("string").alias("id"), F.parse_json(F.to_json(body)).alias("payload"))


def _named(*names):
    return F.array(*[F.struct((F.lit(n) if isinstance(n, str) else n).alias("name")) for n in names])


def _shown(df, columns: dict[str, str]):
    """Select ``output -> column`` with NULL numbers as -1 and lists joined by ``|``."""
    out = [F.col("id")]
    for name, c in columns.items():
        kind = df.schema[c].dataType.typeName()
        col = F.col(c)
        if kind == "array":
            out.append(F.coalesce(F.array_join(col.cast("array<string>"), "|"), F.lit("")).alias(name))
        elif kind == "string":
            out.append(F.coalesce(col, F.lit("")).alias(name))
        else:
            out.append(F.coalesce(col.cast("double"), F.lit(-1.0)).alias(name))
    return df.select(*out)


@query(
    "extract_rawg",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS id, 'Order ' || o_orderkey AS name, CAST(y AS DOUBLE) AS year, CAST(CASE WHEN k = 0 THEN -1 ELSE k * 20 END AS DOUBLE) AS score,
    CASE WHEN k = 1 THEN -1.0::DOUBLE ELSE price::DOUBLE END AS votes, CASE WHEN k = 2 THEN 3.0 ELSE -1.0 END::DOUBLE AS owned, 'Action|' || o_orderpriority AS genres,
    'PC|' || o_orderstatus AS platforms, 'fast' AS tags, 'Dev ' || o_custkey AS developers, (-1.0)::DOUBLE AS metacritic FROM {duck(_ORDER)}""",
)
def extract_rawg(spark, sf):
    k, price = F.col("k"), F.col("price")
    body = {
        "id": F.col("o_orderkey"),
        "name": F.concat(F.lit(" Order "), F.col("o_orderkey").cast("string"), F.lit(" ")),
        "released": F.concat(F.col("y").cast("string"), F.lit("-05-01")),
        "rating": F.when(k != 0, k.cast("double")),
        "ratings_count": F.when(k != 1, price),
        "metacritic": F.lit("77"),
        "added_by_status": F.struct(F.when(k == 2, F.lit(3.0)).alias("owned")),
        "genres": _named("Action", F.col("o_orderpriority"), " action "),
        "platforms": F.array(
            F.struct(F.struct(F.lit("PC").alias("name")).alias("platform")), F.struct(F.struct(F.col("o_orderstatus").alias("name")).alias("platform"))
        ),
        "tags": _named("fast", "Экшен", "", "FAST"),
        "developers": _named(F.concat(F.lit("Dev "), F.col("o_custkey").cast("string"))),
    }
    df = extract(_payload(spark, sf, body), "rawg", default_registry())
    return _shown(
        df,
        {
            "name": "RAWG_Name", "year": "RAWG_Year", "score": "RAWG_Score_100", "votes": "RAWG_RatingsCount", "owned": "RAWG_AddedByStatusOwned",
            "genres": "RAWG_Genres", "platforms": "RAWG_Platforms", "tags": "RAWG_Tags", "developers": "RAWG_Developers", "metacritic": "RAWG_Metacritic",
        },
    )


@query(
    "extract_igdb",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(y AS DOUBLE) AS year, round_even(k * 12.5::DOUBLE, 0) AS score, CAST(k AS DOUBLE) AS critics,
    'Pub ' || o_custkey AS publishers, CASE WHEN k = 3 THEN '' ELSE 'Dev ' || o_orderstatus END AS developers,
    CASE WHEN k = 0 THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS store_id, 'u1|u2|u3|u4|u5' AS websites, 'Parent' AS parent,
    'Alt ' || o_orderstatus || '|Alt B' AS alternatives FROM {duck(_ORDER)}""",
)
def extract_igdb(spark, sf):
    k = F.col("k")
    seconds = F.date_diff(F.make_date("y", F.lit(3), F.lit(3)), F.lit("1970-01-01").cast("date")).cast("bigint") * 86400

    def company(name, dev, pub):
        return F.struct(F.struct(name.alias("name")).alias("company"), dev.alias("developer"), pub.alias("publisher"))

    body = {
        "id": F.col("o_orderkey"),
        "name": F.lit("x"),
        "first_release_date": seconds,
        "rating": k * F.lit(12.5),
        "aggregated_rating_count": k,
        "involved_companies": F.array(
            company(F.concat(F.lit("Pub "), F.col("o_custkey").cast("string")), F.lit(False), F.lit(True)),
            company(F.concat(F.lit("Dev "), F.col("o_orderstatus")), k != 3, F.lit(False)),
        ),
        "external_games": F.array(
            F.struct(F.lit(5).alias("external_game_source"), F.lit("1").alias("uid")),
            F.struct(F.when(k != 0, 1).otherwise(7).alias("external_game_source"), F.col("o_custkey").cast("string").alias("uid")),
        ),
        "websites": F.transform(F.array(*[F.lit(u) for u in ("u1", "u2", "u1", "u3", "u4", "u5", "u6")]), lambda u: F.struct(u.alias("url"))),
        "parent_game": F.struct(F.lit("Parent").alias("name")),
        "alternative_names": _named(F.concat(F.lit("Alt "), F.col("o_orderstatus")), "Alt B"),
    }
    payloads = _payload(spark, sf, body)
    df = extract(payloads.withColumn("alts", alternative_names(F.col("payload"))), "igdb", default_registry())
    return _shown(
        df,
        {
            "year": "IGDB_Year", "score": "IGDB_Score_100", "critics": "IGDB_CriticScoreCount", "publishers": "IGDB_Publishers", "developers": "IGDB_Developers",
            "store_id": "IGDB_SteamAppID", "websites": "IGDB_Websites", "parent": "IGDB_ParentGame", "alternatives": "alts",
        },
    )


@query(
    "extract_steam",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS id, 'https://store.steampowered.com/app/' || o_orderkey || '/' AS url, CASE WHEN k = 0 THEN 'Free' ELSE '$' || price END AS price_text,
    CASE WHEN k = 1 THEN 'Windows|Linux' ELSE 'Linux' END AS platforms, CAST(y AS DOUBLE) AS year, 'game' AS store_type, 'Ubisoft A|Ubisoft Toronto|B' AS developers,
    CASE WHEN k = 2 THEN -1.0 ELSE price::DOUBLE END AS reviews, 'Co-op|Multi' AS categories FROM {duck(_ORDER)}""",
)
def extract_steam(spark, sf):
    k = F.col("k")

    def described(*names):
        return F.transform(F.array(*[F.lit(n) for n in names]), lambda n: F.struct(n.alias("description")))

    body = {
        "name": F.lit("x"),
        "type": F.lit("Game"),
        "is_free": k == 0,
        "price_overview": F.struct(F.concat(F.lit("$"), F.col("price").cast("string")).alias("final_formatted")),
        "platforms": F.struct((k == 1).alias("windows"), F.lit(False).alias("mac"), F.lit(True).alias("linux")),
        "release_date": F.struct(F.concat(F.lit("3 Mar, "), F.col("y").cast("string")).alias("date")),
        "recommendations": F.struct(F.when(k != 2, F.col("price")).alias("total")),
        "developers": F.array(F.lit("Ubisoft A, Toronto, and B"), F.lit("B")),
        "categories": described("Co-op", "Multi", "co-op"),
    }
    df = extract(_payload(spark, sf, body), "steam", default_registry())
    return _shown(
        df,
        {
            "url": "Steam_URL", "price_text": "Steam_Price", "platforms": "Steam_Platforms", "year": "Steam_ReleaseYear", "store_type": "Steam_StoreType",
            "developers": "Steam_Developers", "reviews": "Steam_ReviewCount", "categories": "Steam_Categories",
        },
    )


@query(
    "extract_steamspy",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS id, CASE WHEN k = 0 THEN -1.0 ELSE price::DOUBLE END AS positive,
    CASE WHEN k = 0 OR price + o_custkey = 0 THEN -1.0 ELSE round_even(price / (price + o_custkey)::DOUBLE * 100.0, 0) END AS score,
    '10 .. 20' AS owners, CASE WHEN k >= 2 THEN 'b|A|c' WHEN k = 0 THEN 'b|c' ELSE 'b|c|A' END AS tags FROM {duck(_ORDER)}""",
)
def extract_steamspy(spark, sf):
    k = F.col("k")
    body = {
        "owners": F.lit(" 10 .. 20"),
        "positive": F.when(k != 0, F.col("price").cast("string")).otherwise("n/a"),
        "negative": F.col("o_custkey"),
        "tags": F.create_map(F.lit("A"), k.cast("int"), F.lit("b"), F.lit(9), F.lit("c"), F.lit(2), F.lit("none"), F.lit(0)),
    }
    payloads = _payload(spark, sf, body)
    df = extract(payloads, "steamspy", default_registry())
    return _shown(df, {"positive": "SteamSpy_Positive", "score": "SteamSpy_Score_100", "owners": "SteamSpy_Owners", "tags": "SteamSpy_Tags"})


_TAGS = "SELECT event_type, user_id, count(*) AS n FROM {events} GROUP BY event_type, user_id"


@query(
    "tag_clouds",
    f"""SELECT user_id, string_agg(event_type || '=' || n, '|' ORDER BY n DESC, event_type) AS cloud FROM
    (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS rn FROM {duck(_TAGS)}) WHERE rn <= 3 GROUP BY user_id""",
)
def tag_clouds(spark, sf):
    """Three most counted event types per user, out of a map with one entry per type."""
    counted = spark_frame(spark, sf, _TAGS)
    pair = F.struct(F.col("event_type").alias("k"), F.parse_json(F.col("n").cast("string")).alias("v"))
    maps = counted.groupBy("user_id").agg(F.map_from_entries(F.collect_list(pair)).alias("tags"))
    shown = F.transform(tag_cloud(F.col("tags"), 3), lambda t: F.concat_ws("=", t["tag"], t["count"].cast("string")))
    return maps.select("user_id", F.array_join(shown, "|").alias("cloud"))


@query(
    "extract_hltb",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS id, CASE WHEN k = 0 THEN -1.0 ELSE k + 0.5::DOUBLE END AS main, CASE WHEN k = 4 THEN -1.0 ELSE round_even(k * 30.5::DOUBLE, 0) END AS score,
    CAST(y AS DOUBLE) AS year, 'PC|PS4' AS platforms, 'Alias ' || o_orderstatus AS aliases FROM {duck(_ORDER)}""",
)
def extract_hltb(spark, sf):
    k = F.col("k")
    body = {
        "game_id": F.col("o_orderkey"),
        "game_name": F.lit("x"),
        "main_story": F.when(k != 0, (k + 0.5).cast("string")).otherwise("--"),
        "review_score": k * F.lit(30.5),
        "release_world": F.col("y").cast("string"),
        "profile_platforms": F.array(F.lit("PC"), F.lit("PS4"), F.lit("pc")),
        "game_alias": F.concat(F.lit("Alias "), F.col("o_orderstatus")),
    }
    df = extract(_payload(spark, sf, body), "hltb", default_registry())
    return _shown(df, {"main": "HLTB_Main", "score": "HLTB_Score_100", "year": "HLTB_ReleaseYear", "platforms": "HLTB_Platforms", "aliases": "HLTB_Aliases"})


_LABELS = "SELECT 'Q' || CAST(c_custkey AS STRING) AS qid, c_name AS label, '' AS site_title FROM {customer}"


@query(
    "extract_wikidata",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS id, CASE k WHEN 0 THEN 'en ' || o_orderkey WHEN 1 THEN 'gb' ELSE 'Page ' || o_orderkey END AS label, CAST(y AS DOUBLE) AS year,
    y || '-02-03' AS release_date, c_name AS developers, 'https://en.wikipedia.org/wiki/Page_' || o_orderkey AS wikipedia, 'a|b' AS aliases
    FROM {duck(_ORDER)} JOIN customer ON c_custkey = o_custkey""",
)
def extract_wikidata(spark, sf):
    k = F.col("k")

    def claim(value):
        return F.array(F.struct(F.struct(F.struct(value.alias("value")).alias("datavalue")).alias("mainsnak")))

    title = F.concat(F.lit("Page "), F.col("o_orderkey").cast("string"))
    body = {
        "id": F.col("o_orderkey").cast("string"),
        "labels": F.struct(
            F.when(k == 0, F.struct(F.concat(F.lit("en "), F.col("o_orderkey").cast("string")).alias("value"))).alias("en"),
            F.when(k <= 1, F.struct(F.lit("gb").alias("value"))).alias("en-gb"),
        ),
        "sitelinks": F.struct(F.struct(title.alias("title")).alias("enwiki")),
        "aliases": F.struct(F.transform(F.array(F.lit("a"), F.lit("b"), F.lit("a")), lambda x: F.struct(x.alias("value"))).alias("en")),
        "claims": F.struct(
            claim(F.struct(F.concat(F.lit("+"), F.col("y").cast("string"), F.lit("-02-03T00:00:00Z")).alias("time"))).alias("P577"),
            claim(F.struct(F.concat(F.lit("Q"), F.col("o_custkey").cast("string")).alias("id"))).alias("P178"),
        ),
    }
    payloads = _payload(spark, sf, body)
    df = wikidata_frame(payloads, spark_frame(spark, sf, _LABELS), default_registry()).withColumn("al", entity_aliases(F.col("payload")))
    return _shown(
        df,
        {
            "label": "Wikidata_Label", "year": "Wikidata_ReleaseYear", "release_date": "Wikidata_ReleaseDate", "developers": "Wikidata_Developers",
            "wikipedia": "Wikidata_Wikipedia", "aliases": "al",
        },
    )


_SUMMARY = "SELECT doc_id, text FROM {documents}"


@query(
    "extract_summary",
    """SELECT doc_id, CASE WHEN length(t) > 320 THEN rtrim(substr(t, 1, 317)) || '...' ELSE t END AS summary, 'http://img/' || doc_id AS thumbnail
    FROM (SELECT doc_id, trim(text, ' ' || chr(9) || chr(10) || chr(13)) AS t FROM documents)""",
)
def extract_summary(spark, sf):
    body = F.struct(F.col("text").alias("extract"), F.struct(F.concat(F.lit("http://img/"), F.col("doc_id").cast("string")).alias("source")).alias("thumbnail"))
    df = spark_frame(spark, sf, _SUMMARY).select("doc_id", F.parse_json(F.to_json(body)).alias("payload"))
    m = summary_metrics(F.col("payload"))
    return df.select("doc_id", m["wikipedia.summary"].alias("summary"), m["wikipedia.thumbnail"].alias("thumbnail"))


_PROPS = "SELECT event_id, props, value FROM {events}"


@query(
    "event_numbers",
    f"""SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS strict, CAST(json_extract(props, '$.k') AS BIGINT) AS from_text,
    json_extract_string(props, '$.k') AS shown, CAST(json_extract(props, '$.k') AS DOUBLE) AS real, CAST(-1 AS BIGINT) AS from_string, true AS absent FROM {duck(_PROPS)}""",
)
def event_numbers(spark, sf):
    p = F.col("p")
    k = variant_at(p, "$.k")
    quoted = F.parse_json(F.to_json(F.struct(F.col("props").alias("k"))))
    df = spark_frame(spark, sf, _PROPS).select("event_id", F.parse_json("props").alias("p"), quoted.alias("q"))
    return df.select(
        "event_id", strict_int(k).alias("strict"), int_from_text(k).alias("from_text"), json_text(k).alias("shown"), float_from_text(k).alias("real"),
        F.coalesce(strict_int(variant_at(F.col("q"), "$.k")), F.lit(-1).cast("bigint")).alias("from_string"), strict_float(variant_at(p, "$.zz")).isNull().alias("absent"),
    )


_DOCS = """SELECT o_orderkey, o_orderstatus, CAST(o_custkey AS BIGINT) AS o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS note FROM {orders}"""


_DEEP = 10


def _deep_paths(depth: int = _DEEP) -> str:
    """Rows (path, type) of the chain a.a. .. .a under ``deep``, whose end is a number or, in orders of even key, a text."""
    inner = " UNION ALL ".join(f"SELECT 'deep{'.a' * k}', 'dict' FROM orders" for k in range(depth))
    return f"{inner} UNION ALL SELECT 'deep{'.a' * depth}', CASE WHEN o_orderkey % 2 = 1 THEN 'int' ELSE 'str' END FROM orders"


@query(
    "json_profile",
    f"""SELECT path, string_agg(DISTINCT type, ', ' ORDER BY type) AS types FROM (
    SELECT unnest(['<root>', 'lines', 'lines[]']) AS path, unnest(['dict', 'list', 'dict']) AS type FROM orders
    UNION ALL SELECT 'key', 'int' FROM orders WHERE o_orderkey IS NOT NULL
    UNION ALL SELECT 'lines[].status', 'str' FROM orders WHERE o_orderstatus IS NOT NULL
    UNION ALL SELECT 'lines[].mixed', CASE WHEN o_orderkey % 2 = 1 THEN 'int' ELSE 'str' END FROM orders
    UNION ALL SELECT 'note', 'str' FROM {duck(_DOCS)} WHERE note IS NOT NULL UNION ALL {_deep_paths()}) GROUP BY path""",
)
def json_profile(spark, sf):
    """Paths and types of JSON made from all orders, ten levels deep."""
    odd = F.col("o_orderkey") % 2 == 1
    mixed = F.when(odd, F.parse_json(F.lit("1"))).otherwise(F.parse_json(F.lit('"x"')))
    item = F.struct(F.col("o_orderstatus").alias("status"), mixed.alias("mixed"))
    deep = mixed
    for _ in range(_DEEP):
        deep = F.struct(deep.alias("a"))
    body = F.struct(F.col("o_orderkey").alias("key"), F.array(item, item).alias("lines"), F.col("note"), deep.alias("deep"))
    docs = spark_frame(spark, sf, _DOCS).select(F.parse_json(F.to_json(body)).alias("payload"))
    return path_types(docs).select("path", F.array_join("types", ", ").alias("types"))
