"""Title, tag and parsing functions over whole texts and titles."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalith.constants import EDITION_PHRASES, PROVIDER_DLC_TOKENS, STORE_EDITION_TOKENS
from catalith.functions import text as t
from catalith.functions.lists import distinct_labels
from catalith.functions.parse import (
    claim_date,
    claim_year,
    date_stamp,
    iso_date,
    leading_year,
    owner_range,
    plain_float,
    plain_int,
    positive_hours,
    stamp_date,
    window_key,
    year_from_epoch,
    year_from_text,
)
from catalith.workload import sql as s
from catalith.workload.frames import TITLES, duck, spark_frame, table
from catalith.workload.registry import query


@query(
    "normalize_documents",
    f"SELECT doc_id, CAST(length(n) AS BIGINT) AS n_chars, md5(n) AS digest, CAST(len({s.tokens('n')}) AS BIGINT) AS n_words "
    f"FROM (SELECT doc_id, {s.norm('text')} AS n FROM documents)",
)
def normalize_documents(spark, sf):
    n = table(spark, sf, "documents").select("doc_id", t.normalize_title(F.col("text")).alias("n"))
    return n.select(
        "doc_id", F.length("n").cast("bigint").alias("n_chars"), F.md5("n").alias("digest"),
        F.size(t.tokens(F.col("n"))).cast("bigint").alias("n_words"),
    )


@query(
    "normalize_titles",
    f"SELECT p_partkey, title, {s.norm('title')} AS normalized, "
    f"coalesce(CAST(CAST(nullif(regexp_extract(title, '(?:^|[\\s(])(19\\d\\d|20\\d\\d)(?:$|[\\s)])', 1), '') AS INT) AS VARCHAR), '') "
    f"AS year FROM {duck(TITLES)}",
)
def normalize_titles(spark, sf):
    return spark_frame(spark, sf, TITLES).select(
        "p_partkey", "title", t.normalize_title(F.col("title")).alias("normalized"), t.query_year_or_blank(F.col("title")).alias("year")
    )


_NUMBERED = (
    "SELECT p_partkey, title || CASE WHEN p_size % 3 = 0 THEN ' 40,000' WHEN p_size % 3 = 1 THEN ' 007' ELSE ' 1' END "
    f"|| ' ' || CAST(p_size AS STRING) AS title FROM ({TITLES}) x"
)
_T = s.tokens("n")
_NEXT = f"coalesce(i < len({_T}) AND {_T}[i + 1] = '000', false)"


@query(
    "series_numbers",
    f"""SELECT p_partkey, title,
    array_to_string(list_sort({s.series('n')}), ',') AS matcher,
    array_to_string(list_sort(list_distinct(list_transform(list_filter({_T}, lambda w, i: regexp_full_match(w, '0*([1-9]|[1-4]\\d|50)')
        AND NOT {_NEXT}), lambda w: CAST(w AS INT)))), ',') AS report,
    array_to_string(list_sort(list_distinct(list_transform(list_filter({_T}, lambda w, i: regexp_full_match(w, '[1-9]|[1-4]\\d|50')
        AND NOT {_NEXT}), lambda w: CAST(w AS INT)))), ',') AS imported,
    len(list_filter({_T}, lambda w: regexp_full_match(w, '\\d\\d?') AND w NOT IN ('0', '1'))) > 0 AS store,
    array_to_string(list_sort(list_distinct(list_filter({_T}, lambda w: regexp_full_match(w, '\\d+')
        AND NOT regexp_full_match(w, '(19|20)\\d\\d')))), ',') AS numbers
    FROM (SELECT p_partkey, title, {s.norm('title')} AS n FROM {duck(_NUMBERED)})""",
)
def series_numbers(spark, sf):
    df = spark_frame(spark, sf, _NUMBERED).withColumn("n", t.normalize_title(F.col("title")))
    n = F.col("n")
    return df.select(
        "p_partkey",
        "title",
        F.array_join(t.match_series_numbers(n), ",").alias("matcher"),
        F.array_join(t.report_series_numbers(n).cast("array<string>"), ",").alias("report"),
        F.array_join(t.import_series_numbers(n).cast("array<string>"), ",").alias("imported"),
        t.store_has_series_number(n).alias("store"),
        F.array_join(F.sort_array(t.non_year_numbers(n)), ",").alias("numbers"),
    )


_strip_words = f"array_to_string(list_filter({_T}, lambda w: NOT list_contains({s.words(STORE_EDITION_TOKENS)}, w)), ' ')"
_phrases = "title"
for _p in EDITION_PHRASES:
    _phrases = f"trim(regexp_replace({_phrases}, {s.lit('(?i)' + _p)}, '', 'g'))"
_phrases = f"trim(regexp_replace({_phrases}, '\\s{{2,}}', ' ', 'g'))"


@query(
    "edition_words",
    f"""SELECT p_partkey, title, array_to_string({s.editions('n')}, ',') AS editions, {_strip_words} AS bare,
    coalesce(nullif({_phrases}, ''), title) AS searched,
    coalesce(nullif(trim(regexp_replace(title, '\\s*\\(\\s*(19\\d\\d|20\\d\\d)\\s*\\)\\s*$', '')), ''), title) AS undated,
    {s.overlap(_T, s.words(PROVIDER_DLC_TOKENS))} AS add_on, {s.dlc('n')} AS matcher_add_on
    FROM (SELECT p_partkey, title, {s.norm('title')} AS n FROM {duck(TITLES)})""",
)
def edition_words(spark, sf):
    title = F.col("title")
    words = t.title_tokens(title)
    return spark_frame(spark, sf, TITLES).select(
        "p_partkey",
        "title",
        F.array_join(t.edition_tokens(title), ",").alias("editions"),
        t.strip_edition_tokens(title).alias("bare"),
        t.strip_edition_phrases(title).alias("searched"),
        t.strip_trailing_year(title).alias("undated"),
        t.provider_dlc_like(words).alias("add_on"),
        t.match_dlc_like(words).alias("matcher_add_on"),
    )


_roman = "title"
for _i, _r in enumerate(("I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX", "X"), 1):
    _roman = f"regexp_replace({_roman}, '\\b{_r}\\b', '{_i}', 'g')"
_dated = "regexp_matches(title, '(?:^|[\\s(])(19\\d\\d|20\\d\\d)(?:$|[\\s)])')"


@query(
    "query_variants",
    f"""WITH v AS (SELECT p_partkey, unnest([title,
        CASE WHEN {_dated} THEN trim(regexp_replace(title, '\\s*\\(\\s*(19\\d\\d|20\\d\\d)\\s*\\)\\s*$', '')) END,
        CASE WHEN {_dated} THEN trim(regexp_replace(title, '\\s+(19\\d\\d|20\\d\\d)\\s*$', '')) END,
        translate(title, '–—−', '---'), trim(regexp_replace(title, '[!?\\.]+$', '')),
        trim(regexp_replace(title, '(?i)\\bFull\\s+HD\\b', 'HD', 'g')),
        CASE WHEN contains(title, ':') THEN trim(split_part(title, ':', 1)) END,
        CASE WHEN contains(title, ' - ') THEN trim(split_part(title, ' - ', 1)) END, {_roman}]) AS variant,
        generate_subscripts([1, 2, 3, 4, 5, 6, 7, 8, 9], 1) AS pos FROM {duck(TITLES)}),
    f AS (SELECT p_partkey, variant, min(pos) AS pos FROM v WHERE coalesce(variant, '') <> '' GROUP BY ALL)
    SELECT p_partkey, variant, CAST(row_number() OVER (PARTITION BY p_partkey ORDER BY pos) - 1 AS BIGINT) AS pos FROM f""",
)
def query_variants(spark, sf):
    variants = spark_frame(spark, sf, TITLES).select("p_partkey", F.posexplode(t.query_variants(F.col("title"))).alias("pos", "variant"))
    return variants.select("p_partkey", "variant", F.col("pos").cast("bigint").alias("pos"))


_TAG = (
    "trim(regexp_replace(regexp_replace(replace(lower(text), '&', ' and '), '[^a-z0-9\\s:+/-]', ' ', 'g'), '\\s+', ' ', 'g'))"
)


@query(
    "document_tags",
    f"""SELECT doc_id, md5({_TAG}) AS tag_digest,
    CASE WHEN length(trim(text)) > 500 THEN rtrim(substr(trim(text), 1, 500)) || '…' ELSE trim(text) END AS blurb,
    CASE WHEN length(trim(text)) > 320 THEN rtrim(substr(trim(text), 1, 317)) || '...' ELSE trim(text) END AS summary,
    regexp_matches(text, '[Ѐ-ԯ]') AS cyrillic,
    coalesce(CAST(nullif(regexp_extract(text, '\\b(19\\d\\d|20\\d\\d)\\b', 1), '') AS INT), 0) AS year
    FROM (SELECT doc_id, trim(text, ' ' || chr(9) || chr(10) || chr(13)) AS text FROM documents)""",
)
def document_tags(spark, sf):
    text = F.col("text")
    return table(spark, sf, "documents").select(
        "doc_id",
        F.md5(t.normalize_tag(text)).alias("tag_digest"),
        t.truncate(text, 500, 500, "…").alias("blurb"),
        t.truncate(text, 317, 320, "...").alias("summary"),
        t.has_cyrillic(text).alias("cyrillic"),
        F.coalesce(t.year_in_text(text), F.lit(0)).alias("year"),
    )


_LINKS = (
    "SELECT page_id, url, replace(replace(url, '/en/', '/app/'), '/es/', '/app/') AS link, "
    "regexp_extract(url, '/([0-9]+)', 1) AS num FROM {pages}"
)


@query(
    "store_links",
    f"""SELECT page_id, regexp_extract(link, '/app/(\\d+)\\b', 1) AS store_id,
    CASE WHEN regexp_full_match(num, '\\d+') THEN 'https://store.steampowered.com/app/' || num || '/' ELSE '' END AS store_url,
    CASE WHEN regexp_full_match(num, '\\d+') THEN 'https://howlongtobeat.com/game/' || num ELSE '' END AS playtime_url,
    'https://en.wikipedia.org/wiki/' || replace('page ' || num, ' ', '_') AS wiki_url
    FROM {duck(_LINKS)}""",
)
def store_links(spark, sf):
    num = F.col("num")
    return spark_frame(spark, sf, _LINKS).select(
        "page_id",
        t.first_store_id(F.array(F.lit(None).cast("string"), F.col("link"))).alias("store_id"),
        t.store_url(num).alias("store_url"),
        t.playtime_url(num).alias("playtime_url"),
        t.wiki_url(F.concat(F.lit("page "), num)).alias("wiki_url"),
    )


_HANDHELD = (
    "SELECT c_custkey, CASE c_custkey % 9 WHEN 0 THEN 'PC (Windows)' WHEN 1 THEN 'PlayStation 5' WHEN 2 THEN 'Xbox One' "
    "WHEN 3 THEN 'Nintendo Switch' WHEN 4 THEN 'macOS' WHEN 5 THEN 'Linux' WHEN 6 THEN 'Android' WHEN 7 THEN 'PS Vita' "
    "ELSE c_mktsegment END AS platform FROM {customer}"
)
_low = "lower(trim(platform))"
_pn = s.norm("platform")


def _has(x: str, *needles: str) -> str:
    return "(" + " OR ".join(f"contains({x}, '{n}')" for n in needles) + ")"


@query(
    "platform_families",
    f"""SELECT c_custkey, platform,
    CASE WHEN {_has(_low, 'pc', 'windows')} THEN 'pc' WHEN contains({_low}, 'playstation') OR starts_with({_low}, 'ps') THEN 'playstation'
      WHEN contains({_low}, 'xbox') THEN 'xbox' WHEN {_has(_low, 'nintendo', 'switch', 'wii')} THEN 'nintendo'
      WHEN contains({_low}, 'mac') THEN 'mac' WHEN contains({_low}, 'linux') THEN 'linux' ELSE {_low} END AS report_family,
    CASE WHEN {_has(_pn, 'pc', 'windows', 'mac', 'osx', 'linux')} THEN 'pc'
      WHEN contains({_pn}, 'playstation') OR starts_with({_pn}, 'ps') THEN 'playstation' WHEN contains({_pn}, 'xbox') THEN 'xbox'
      WHEN {_has(_pn, 'nintendo', 'switch', 'wii')} THEN 'nintendo' WHEN {_has(_pn, 'ios', 'android', 'mobile')} THEN 'mobile'
      ELSE '' END AS import_family,
    {_has(_low, 'pc', 'windows', 'steam', 'linux', 'mac', 'osx')} AS pc_like FROM {duck(_HANDHELD)}""",
)
def platform_families(spark, sf):
    p = F.col("platform")
    return spark_frame(spark, sf, _HANDHELD).select(
        "c_custkey",
        "platform",
        t.platform_report_bucket(p).alias("report_family"),
        F.coalesce(t.platform_import_bucket(p), F.lit("")).alias("import_family"),
        t.pc_like(p).alias("pc_like"),
    )


_NUMBERS = """SELECT o_orderkey, o_orderdate, o_custkey,
    CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_custkey + 1000 AS STRING) || ',000 .. ' || CAST(o_custkey AS STRING) || ',500'
         WHEN o_orderkey % 5 = 1 THEN CAST(o_custkey + 1 AS STRING) || '-' || CAST(o_custkey + 2 AS STRING)
         WHEN o_orderkey % 5 = 2 THEN '0 .. 10' WHEN o_orderkey % 5 = 3 THEN 'unknown' ELSE '' END AS owners,
    CASE WHEN o_orderkey % 3 = 0 THEN ' -1,2 ' || CAST(o_custkey AS STRING) WHEN o_orderkey % 3 = 1 THEN 'x1' ELSE 'nan' END AS num,
    CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_custkey AS STRING) || '.5' WHEN o_orderkey % 4 = 1 THEN 'inf' WHEN o_orderkey % 4 = 2
         THEN '-3' ELSE 'n/a' END AS dec FROM {orders}"""
_LO = "CAST(nullif(replace(replace(regexp_extract(owners, '^\\s*([\\d,\\s]+)\\s*(?:\\.\\.|-)\\s*([\\d,\\s]+)\\s*$', {g}), ',', ''), ' ', ''), '') AS BIGINT)"
_A, _B = _LO.format(g=1), _LO.format(g=2)
_OK = f"coalesce({_A} > 0 AND {_B} > 0, false)"
_CLEAN = "replace(replace(num, ',', ''), ' ', '')"


@query(
    "text_numbers",
    f"""SELECT o_orderkey, CASE WHEN {_OK} THEN least({_A}, {_B}) ELSE -1 END AS low, CASE WHEN {_OK} THEN greatest({_A}, {_B}) ELSE -1 END AS high,
    CASE WHEN {_OK} THEN CAST(round_even(({_A} + {_B}) / 2.0::DOUBLE, 0) AS BIGINT) ELSE -1 END AS mid,
    CASE WHEN regexp_full_match({_CLEAN}, '-?\\d+') THEN CAST({_CLEAN} AS BIGINT) ELSE 0 END AS whole,
    CASE WHEN o_orderkey % 4 IN (0, 2) THEN CAST(dec AS DOUBLE) ELSE -1.0 END AS fraction,
    CASE WHEN o_orderkey % 4 = 0 AND CAST(dec AS DOUBLE) > 0 THEN CAST(dec AS DOUBLE) ELSE 0.0 END AS hours FROM {duck(_NUMBERS)}""",
)
def text_numbers(spark, sf):
    low, high, mid = owner_range(F.col("owners"))
    none = F.lit(-1).cast("bigint")
    return spark_frame(spark, sf, _NUMBERS).select(
        "o_orderkey",
        F.coalesce(low, none).alias("low"),
        F.coalesce(high, none).alias("high"),
        F.coalesce(mid, none).alias("mid"),
        F.coalesce(plain_int(F.col("num")), F.lit(0).cast("bigint")).alias("whole"),
        F.coalesce(plain_float(F.col("dec")), F.lit(-1.0)).alias("fraction"),
        F.coalesce(positive_hours(F.col("dec")), F.lit(0.0)).alias("hours"),
    )


_DATES = """SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS d,
    substr(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, 10) AS iso FROM {orders}"""


@query(
    "date_formats",
    f"""SELECT o_orderkey, CAST(year(d) AS BIGINT) AS from_iso, CAST(year(d) AS BIGINT) AS from_free, CAST(year(d) AS BIGINT) AS from_epoch,
    iso AS claimed, CAST(year(d) AS BIGINT) AS claim_year, strftime(d, '%Y%m%d') || '00' AS stamp, iso AS stamped,
    iso AS strict_date, CASE WHEN o_orderkey % 2 = 0 THEN 'Art|icle' ELSE 'Plain' END AS article, CAST(8 AS BIGINT) AS days
    FROM {duck(_DATES)}""",
)
def date_formats(spark, sf):
    d = spark_frame(spark, sf, _DATES)
    epoch = F.date_diff(F.col("d"), F.lit("1970-01-01").cast("date")).cast("bigint") * 86400 + F.lit(3600)
    article = F.when(F.col("o_orderkey") % 2 == 0, "Art|icle").otherwise("Plain")
    key = F.concat_ws("|", F.lit("en"), F.lit("all"), F.lit("user"), article, F.lit("daily"), date_stamp(F.col("d")), date_stamp(F.date_add("d", 7)))
    parts = window_key(key)
    return d.select(
        "o_orderkey",
        leading_year(F.col("iso")).cast("bigint").alias("from_iso"),
        year_from_text(F.concat(F.lit("Released in "), F.year("d").cast("string"), F.lit("."))).cast("bigint").alias("from_free"),
        year_from_epoch(epoch).cast("bigint").alias("from_epoch"),
        claim_date(F.concat(F.lit("+"), F.col("iso"), F.lit("T00:00:00Z"))).alias("claimed"),
        claim_year(F.concat(F.lit("+"), F.col("iso"))).cast("bigint").alias("claim_year"),
        date_stamp(F.col("d")).alias("stamp"),
        stamp_date(date_stamp(F.col("d"))).cast("string").alias("stamped"),
        iso_date(F.col("iso")).cast("string").alias("strict_date"),
        parts["article"].alias("article"),
        parts["days"].cast("bigint").alias("days"),
    )


_QUOTED = "SELECT doc_id, '\"' || translate(text, '0123456789', '０１２３４５６７８９') || ' (1999)' AS text FROM {documents}"


@query(
    "search_texts",
    r"""SELECT doc_id, md5(trim(replace(replace(regexp_replace('"' || text, '\p{C}', ' ', 'g'), chr(92), chr(92) || chr(92)), '"', chr(92) || '"'))) AS digest
    FROM documents""",
)
def search_texts(spark, sf):
    """Digits come in their full-width forms, which the compatibility normalisation undoes."""
    return spark_frame(spark, sf, _QUOTED).select("doc_id", F.md5(t.search_text(F.col("text"))).alias("digest"))


_LABELS = (
    "SELECT doc_id, text, CASE doc_id % 5 WHEN 0 THEN 'a 2016 video game by ' || source WHEN 1 THEN '1993 film' "
    "WHEN 2 THEN 'demo of a video game' WHEN 3 THEN 'ESRB content descriptor' ELSE lang END AS description FROM {documents}"
)
_W = "list_distinct(regexp_extract_all(lower({x}), '([a-z0-9]+)', 1))"


@query(
    "label_classes",
    f"""SELECT doc_id, contains(d, 'video game') OR contains(d, 'computer game') AS game,
    contains(d, 'demo') OR contains(d, 'esrb') OR contains(d, 'content descriptor') AS unwanted,
    contains(d, 'film') OR contains(d, 'movie') OR contains(d, 'television') OR contains(d, 'tv series') OR contains(d, 'anime')
      OR contains(d, 'manga') OR contains(d, 'comic') OR contains(d, 'soundtrack') OR contains(d, 'album') OR contains(d, 'song')
      OR contains(d, 'novel') OR contains(d, 'book') AS other_media,
    (contains(d, 'video game') OR contains(d, 'computer game') OR contains(d, 'expansion pack') OR contains(d, 'downloadable content')
      OR contains(d, 'dlc')) AND NOT (contains(d, 'game demo') OR contains(d, 'content descriptor')) AS valid_instance,
    CAST(len({_W.format(x='text')}) AS BIGINT) AS n_words,
    len({_W.format(x='text')}) > 0 AND len({_W.format(x='description')}) > 0
      AND len(list_filter({_W.format(x='description')}, lambda w: NOT list_contains({_W.format(x='text')}, w))) > 0 AS adds
    FROM (SELECT *, lower(description) AS d FROM {duck(_LABELS)})""",
)
def label_classes(spark, sf):
    d = F.col("description")
    return spark_frame(spark, sf, _LABELS).select(
        "doc_id",
        t.describes_game(d).alias("game"),
        t.describes_unwanted(d).alias("unwanted"),
        t.describes_other_media(d).alias("other_media"),
        t.valid_instance(d).alias("valid_instance"),
        F.size(t.word_tokens(F.col("text"))).cast("bigint").alias("n_words"),
        t.adds_tokens(F.col("text"), d).alias("adds"),
    )


_FLAGS = "SELECT p_partkey, [[p_type, lower(p_type), p_brand, '', ' ' || p_name || ' ', upper(p_name)]] AS items FROM {part}"


@query(
    "distinct_labels",
    f"""WITH u AS (SELECT p_partkey, trim(unnest(items)) AS x, generate_subscripts(items, 1) AS i FROM {duck(_FLAGS)}),
    f AS (SELECT p_partkey, lower(x) AS k, arg_min(x, i) AS x, min(i) AS i FROM u WHERE x <> '' GROUP BY p_partkey, lower(x))
    SELECT p_partkey, string_agg(x, '|' ORDER BY i) AS labels FROM f GROUP BY p_partkey""",
)
def first_spellings(spark, sf):
    return spark_frame(spark, sf, _FLAGS).select("p_partkey", F.array_join(distinct_labels(F.col("items")), "|").alias("labels"))
