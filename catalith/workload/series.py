"""Daily series over orders and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalith.functions.parse import date_stamp
from catalith.operators.series import daily_items, dense_days, last_day, latest_windows, launch_sums, trailing_sums
from catalith.workload.frames import duck, spark_frame
from catalith.workload.registry import query

_DAILY = "SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, count(*) AS views FROM {orders} GROUP BY o_custkey, CAST(o_orderdate AS DATE)"
_EARLIEST = "1900-01-01"


@query(
    "trailing_views",
    f"""WITH d AS {duck(_DAILY)}, e AS (SELECT max(day) AS last FROM d)
    SELECT c_custkey AS o_custkey, CAST(coalesce(sum(CASE WHEN day > last - 30 THEN views END), 0) AS BIGINT) AS views_30d,
    CAST(coalesce(sum(CASE WHEN day > last - 90 THEN views END), 0) AS BIGINT) AS views_90d,
    CAST(coalesce(sum(CASE WHEN day > last - 365 THEN views END), 0) AS BIGINT) AS views_365d
    FROM customer CROSS JOIN e LEFT JOIN d ON o_custkey = c_custkey GROUP BY c_custkey""",
)
def trailing_views(spark, sf):
    """Every customer, also those without an order on any day of the windows."""
    daily = spark_frame(spark, sf, _DAILY)
    keys = spark_frame(spark, sf, "SELECT c_custkey AS o_custkey FROM {customer}")
    return trailing_sums(daily, "o_custkey", last_day(daily), keys=keys)


_SHIPPED = "SELECT l_orderkey, CAST(l_shipdate AS DATE) AS day, count(*) AS views FROM {lineitem} GROUP BY l_orderkey, CAST(l_shipdate AS DATE)"
_RELEASES = "SELECT o_orderkey AS l_orderkey, CAST(o_orderdate AS DATE) AS release FROM {orders}"


@query(
    "launch_views",
    f"""WITH d AS {duck(_SHIPPED)}, r AS {duck(_RELEASES)}, e AS (SELECT max(day) AS last FROM d)
    SELECT r.l_orderkey, CAST(coalesce(sum(CASE WHEN day >= release AND day < release + 30 THEN views END), 0) AS BIGINT) AS views_first_30d,
    CAST(coalesce(sum(CASE WHEN day >= release AND day < release + 90 THEN views END), 0) AS BIGINT) AS views_first_90d
    FROM r CROSS JOIN e LEFT JOIN d ON d.l_orderkey = r.l_orderkey AND day <= last WHERE release <= last GROUP BY r.l_orderkey""",
)
def launch_views(spark, sf):
    shipped = spark_frame(spark, sf, _SHIPPED)
    return launch_sums(shipped, spark_frame(spark, sf, _RELEASES), "l_orderkey", last_day(shipped), earliest=_EARLIEST)


_EVENT_DAYS = "SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS views FROM {events} GROUP BY user_id, CAST(ts AS DATE)"


@query(
    "dense_days",
    f"""WITH d AS {duck(_EVENT_DAYS)}, b AS (SELECT user_id, min(day) AS s, max(day) AS e FROM d GROUP BY user_id),
    g AS (SELECT user_id, CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS day FROM b)
    SELECT g.user_id, CAST(g.day AS VARCHAR) AS day, coalesce(d.views, 0) AS views FROM g LEFT JOIN d ON d.user_id = g.user_id AND d.day = g.day""",
)
def days_without_gaps(spark, sf):
    series = spark_frame(spark, sf, _EVENT_DAYS)
    bounds = series.groupBy("user_id").agg(F.min("day").alias("start"), F.max("day").alias("end"))
    return dense_days(series, bounds, "user_id").withColumn("day", F.col("day").cast("string"))


@query(
    "series_payloads",
    f"SELECT user_id, CAST(day AS VARCHAR) AS day, views FROM {duck(_EVENT_DAYS)}",
)
def series_payloads(spark, sf):
    """Series payloads as a provider returns them, read back to days; a repeated day keeps its last item."""
    item = F.struct(date_stamp(F.col("day")).alias("timestamp"), F.col("views"))
    old = F.struct(date_stamp(F.col("day")).alias("timestamp"), F.lit(0).cast("bigint").alias("views"))
    body = F.struct(F.array(old, item).alias("items"))
    daily = spark_frame(spark, sf, _EVENT_DAYS).select("user_id", F.parse_json(F.to_json(body)).alias("payload"))
    return daily_items(daily, "user_id").withColumn("day", F.col("day").cast("string"))


_WINDOWS = "SELECT user_id, CAST(ts AS DATE) AS s, event_id % 3 AS n FROM {events}"
_STAMP = "strftime({d}, '%Y%m%d') || '00'"


@query(
    "latest_windows",
    f"""SELECT 'art|' || user_id AS article, CAST(n * 30 + 1 AS BIGINT) AS days, max('en|all|user|art|' || user_id || '|daily|' || {_STAMP.format(d='s')} || '|' || {_STAMP.format(d='s + CAST(n * 30 AS INT)')}) AS request_key
    FROM {duck(_WINDOWS)} GROUP BY user_id, n""",
)
def newest_windows(spark, sf):
    d = spark_frame(spark, sf, _WINDOWS)
    end = F.date_add("s", (F.col("n") * 30).cast("int"))
    key = F.concat_ws(
        "|", F.lit("en"), F.lit("all"), F.lit("user"), F.lit("art"), F.col("user_id").cast("string"), F.lit("daily"), date_stamp(F.col("s")), date_stamp(end)
    )
    return latest_windows(d.select(key.alias("request_key"))).select("article", F.col("days").cast("bigint").alias("days"), "request_key")
