"""Company names, tallies and tiers."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalith.constants import GENERIC_COMPANY_TOKENS
from catalith.functions.company import company_key, company_keys, normalize_company, split_company_text, wanted_company
from catalith.functions.lists import joined
from catalith.operators.tiers import collect_tiers, dedupe_tiers, production_tier
from catalith.sources.registry import default_registry
from catalith.workload import sql as s
from catalith.workload.frames import SOURCES, duck, spark_frame
from catalith.workload.registry import query

_NAMES = """SELECT c_custkey, CASE c_custkey % 8 WHEN 0 THEN 'Éditions ' || c_mktsegment || ' Games, Inc.'
    WHEN 1 THEN c_mktsegment || ' Studios Entertainment Co., Ltd.' WHEN 2 THEN c_name || ' (Mac, Linux)'
    WHEN 3 THEN '2015' WHEN 4 THEN c_mktsegment || '-Média™  GmbH' WHEN 5 THEN 'Aspyr Media, Inc. (Mac)'
    WHEN 6 THEN 'and ' || c_mktsegment || ' LLC Ltd' ELSE 'North America' END AS company FROM {customer}"""
_GEN = s.words(GENERIC_COMPANY_TOKENS)
_KW = "string_split(k, ' ')"


@query(
    "company_names",
    f"""SELECT c_custkey, n AS normalized, k AS company_key,
    array_to_string(list_sort(list_transform(list_filter(range(1, len({_KW}) + 1),
        lambda i: len(list_filter({_KW}[i + 1:], lambda w: NOT list_contains({_GEN}, w))) = 0),
        lambda i: array_to_string({_KW}[:i], ' '))), '|') AS key_variants,
    NOT contains(company, '''''''') AND k NOT IN ('north america') AND n <> '' AND NOT starts_with(lower(n), 'and ') AS wanted,
    NOT contains(company, '''''''') AND k NOT IN ('north america') AND n <> '' AND NOT starts_with(lower(n), 'and ')
        AND lower(n) NOT IN ('feral interactive', 'aspyr', 'aspyr media') AS wanted_strict
    FROM (SELECT *, {s.company('company')} AS n, {s.company_key('company')} AS k FROM {duck(_NAMES)})""",
)
def company_names(spark, sf):
    c = F.col("company")
    df = spark_frame(spark, sf, _NAMES)
    return df.select(
        "c_custkey",
        normalize_company(c).alias("normalized"),
        company_key(c).alias("company_key"),
        joined(F.sort_array(company_keys(c)), "|").alias("key_variants"),
        wanted_company(c).alias("wanted"),
        wanted_company(c, False).alias("wanted_strict"),
    )


_LISTED = """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'Ubisoft ' || o_orderpriority || ', Toronto, and Red ' || o_orderstatus
    WHEN 1 THEN 'A' || o_orderstatus || ', B, , C' WHEN 2 THEN 'Solo, Inc.' ELSE 'Port (x, y, z)' END AS company FROM {orders}"""


@query(
    "company_lists",
    f"""SELECT o_orderkey, CASE o_orderkey % 4
    WHEN 0 THEN replace(replace(company, ', Toronto', '|Ubisoft Toronto'), ', and ', '|')
    WHEN 1 THEN replace(replace(company, ', ,', ','), ', ', '|') ELSE company END AS companies FROM {duck(_LISTED)}""",
)
def company_lists(spark, sf):
    return spark_frame(spark, sf, _LISTED).select("o_orderkey", joined(split_company_text(F.col("company")), "|").alias("companies"))


_MENTIONS = """SELECT CASE WHEN l_returnflag = 'R' THEN 'publisher' ELSE 'developer' END AS kind,
    'Supplier ' || CAST(l_suppkey AS STRING) || CASE l_linenumber % 5 WHEN 0 THEN ', Inc.' WHEN 1 THEN ' Ltd' WHEN 2 THEN ' (Mac)'
        WHEN 3 THEN ' Games' ELSE '' END AS company,
    CASE WHEN l_partkey % 7 = 0 THEN '' ELSE p_name END AS title, l_orderkey, l_linenumber, l_partkey, l_suppkey
    FROM {lineitem} JOIN {part} ON p_partkey = l_partkey"""
_TIERS = """SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'publisher' ELSE 'developer' END AS kind,
    CASE WHEN s_suppkey % 3 = 0 THEN 'SUPPLIER ' ELSE 'Supplier ' END || CAST(s_suppkey AS STRING) || CASE WHEN s_suppkey % 5 = 0 THEN ' Inc' ELSE '' END AS label,
    CASE s_suppkey % 4 WHEN 0 THEN 'AAA' WHEN 1 THEN 'AA' WHEN 2 THEN 'Unknown' ELSE '' END AS tier FROM {supplier}
    UNION ALL SELECT 'developer', 'Supplier ' || CAST(s_suppkey AS STRING), 'Indie' FROM {supplier} WHERE s_suppkey % 7 = 3
    UNION ALL SELECT 'publisher', 'Brand 7 Publishing', 'AAA' FROM {region} WHERE r_regionkey = 0
    UNION ALL SELECT 'publisher', 'Brand ' || CAST(r_regionkey + 10 AS STRING), 'Unknown' FROM {region}"""
_ORD = "(l_orderkey, l_linenumber, l_partkey, l_suppkey)"
_DIM = f"""SELECT kind, k, arg_max(tier, row(trim(label), tier)) AS tier, max(trim(label)) AS tier_label FROM
    (SELECT kind, {s.company_key('label')} AS k, tier, label FROM {duck(_TIERS)} t0) WHERE tier <> '' AND k <> '' GROUP BY kind, k"""


def _mentions(spark, sf):
    return spark_frame(spark, sf, _MENTIONS).withColumn("ord", F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))


@query(
    "company_tally",
    f"""WITH m AS (SELECT *, {s.company_key('company')} AS k, {s.company('company')} AS n,
        row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, kind) AS ord FROM {duck(_MENTIONS)}),
    t AS (SELECT kind, k, count(*) AS mentions, arg_min(n, ord) AS label FROM m GROUP BY kind, k),
    e AS (SELECT kind, k, title, min(ord) AS ord FROM m WHERE title <> '' GROUP BY kind, k, title),
    r AS (SELECT *, row_number() OVER (PARTITION BY kind, k ORDER BY ord) AS rn FROM e),
    x AS (SELECT kind, k, string_agg(title, '|' ORDER BY ord) AS examples FROM r WHERE rn <= 6 GROUP BY kind, k),
    d AS ({_DIM})
    SELECT t.kind, t.label, t.mentions, coalesce(x.examples, '') AS examples FROM t LEFT JOIN x USING (kind, k) LEFT JOIN d USING (kind, k)
    WHERE d.tier IS NULL AND t.mentions >= 2""",
)
def company_tally(spark, sf):
    """Companies still without a tier, with counts and example titles."""
    out = collect_tiers(_mentions(spark, sf), spark_frame(spark, sf, _TIERS), only_missing=True, min_count=2)
    return out.select("kind", "label", "mentions", F.coalesce(joined(F.col("examples"), "|"), F.lit("")).alias("examples"))


@query(
    "tiered_companies",
    f"""WITH m AS (SELECT *, {s.company_key('company')} AS k, {s.company('company')} AS n,
        row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, kind) AS ord FROM {duck(_MENTIONS)}),
    t AS (SELECT kind, k, count(*) AS mentions, arg_min(n, ord) AS label FROM m GROUP BY kind, k), d AS ({_DIM})
    SELECT kind, label, tier, mentions FROM t JOIN d USING (kind, k)""",
)
def tiered_companies(spark, sf):
    return collect_tiers(_mentions(spark, sf), spark_frame(spark, sf, _TIERS)).select("kind", "label", "tier", "mentions")


@query(
    "tier_dedupe",
    f"""WITH k AS (SELECT kind, label, tier, {s.company_key('label')} AS company_key, {s.company('label')} AS n,
        CASE tier WHEN 'AAA' THEN 3 WHEN 'AA' THEN 2 WHEN 'Indie' THEN 1 ELSE 0 END AS r FROM {duck(_TIERS)}),
    p AS (SELECT *, CASE WHEN upper(n) = n THEN 20 ELSE 0 END + CASE WHEN lower(n) = n THEN 5 ELSE 0 END AS pen FROM k WHERE r > 0),
    o AS (SELECT *, row_number() OVER (PARTITION BY kind, company_key ORDER BY pen, -length(n), label) AS rn FROM p)
    SELECT kind, company_key, max(CASE WHEN rn = 1 THEN label END) AS label, arg_max(tier, r) AS tier,
        count(DISTINCT label) > 1 AS merged, count(DISTINCT tier) > 1 AS conflict FROM o GROUP BY kind, company_key""",
)
def tier_dedupe(spark, sf):
    return dedupe_tiers(spark_frame(spark, sf, _TIERS))


def _lists(kind: str) -> str:
    return "list_concat(" * 3 + f"Steam_{kind}, IGDB_{kind}), RAWG_{kind}), Wikidata_{kind})"


@query(
    "production_tiers",
    f"""WITH e AS (SELECT RowId, 'publisher' AS kind, 0 AS base, unnest({_lists('Publishers')}) AS company,
            generate_subscripts({_lists('Publishers')}, 1) AS pos FROM {duck(SOURCES)}
        UNION ALL SELECT RowId, 'developer', 1000, unnest({_lists('Developers')}), generate_subscripts({_lists('Developers')}, 1)
            FROM {duck(SOURCES)}),
    c AS (SELECT RowId, kind, base + pos AS rank, trim(company) AS company, {s.company_key('company')} AS k, lower({s.company('company')}) AS n
        FROM e WHERE trim(coalesce(company, '')) <> ''),
    d AS ({_DIM}),
    j AS (SELECT c.*, CASE WHEN starts_with(n, 'aspyr') OR starts_with(n, 'feral interactive') THEN NULL ELSE tier END AS tier, tier_label
        FROM c LEFT JOIN d USING (kind, k)),
    b AS (SELECT RowId, min(CASE WHEN tier <> 'Unknown' THEN rank END) AS known, min(CASE WHEN tier = 'Unknown' THEN rank END) AS unk
        FROM j GROUP BY RowId)
    SELECT b.RowId, coalesce(j.tier, 'Unknown') AS tier, coalesce(j.kind || ':' || coalesce(tier_label, company), '') AS tier_reason
    FROM b LEFT JOIN j ON j.RowId = b.RowId AND j.rank = coalesce(known, unk)""",
)
def production_tiers(spark, sf):
    return production_tier(spark_frame(spark, sf, SOURCES), spark_frame(spark, sf, _TIERS), default_registry())
