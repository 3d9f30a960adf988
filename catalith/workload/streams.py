"""Streaming enrichment over the event files."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalith.session import shared_dir
from catalith.streaming.pins import append_output, distinct_tasks, drained, enrich_batches, fresh_pins, latest_view, read_stream, task_totals, trailing_totals
from catalith.workload.frames import table
from catalith.workload.registry import query


def _events(spark, sf):
    schema = table(spark, sf, "events").schema
    return read_stream(spark, sf, schema, "events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))


@query(
    "stream_enrichment",
    "SELECT event_id, CAST(user_id AS VARCHAR) AS pin, p_name FROM events JOIN part ON p_partkey = user_id",
)
def stream_enrichment(spark, sf):
    """Pins from the event stream, looked up in the title table and upserted per batch."""
    pins = _events(spark, sf).select("event_id", F.col("user_id").cast("string").alias("pin"))
    titles = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("id"), "p_name")
    out = shared_dir(spark, "stream")
    enrich_batches(pins, titles, "pin", "event_id", out, shared_dir(spark, "stream-state")).awaitTermination()
    return latest_view(spark, out, "event_id").where(F.col("p_name").isNotNull()).select(F.col("event_id").cast("bigint").alias("event_id"), "pin", "p_name")


@query("stream_fresh_pins", "SELECT DISTINCT user_id FROM events")
def stream_fresh_pins(spark, sf):
    """Each pin once within the watermark, which spans the table here."""
    pins = fresh_pins(_events(spark, sf).select("user_id", "ts"), "user_id", "ts", "60 days").select("user_id")
    out = shared_dir(spark, "fresh")
    append_output(pins, out, shared_dir(spark, "fresh-state")).awaitTermination()
    return spark.read.parquet(out)


@query(
    "stream_task_totals",
    """SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events
    GROUP BY ALL HAVING date_trunc('day', any_value(ts)) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""",
)
def stream_task_totals(spark, sf):
    """Closed daily windows per event type; windows the watermark has not passed are not final yet."""
    totals = task_totals(_events(spark, sf), "ts", "1 hour", ["event_type"], "1 day")
    out = shared_dir(spark, "totals")
    append_output(totals.select(F.col("window.start").alias("start"), "event_type", "n"), out, shared_dir(spark, "totals-state")).awaitTermination()
    return spark.read.parquet(out).select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n")


@query(
    "stream_article_tasks",
    """SELECT event_id, event_type AS title, strftime(ts, '%Y-%m-%d') AS release, count(*) OVER (PARTITION BY event_type, ts::DATE) AS views FROM events""",
)
def stream_article_tasks(spark, sf):
    """Tasks by (title, release date), each looked up once, drained to all rows that asked for them."""
    rows = _events(spark, sf).select("event_id", F.col("event_type").alias("title"), F.date_format("ts", "yyyy-MM-dd").alias("release"), "ts")
    out = shared_dir(spark, "tasks")
    tasks = distinct_tasks(rows, ["title", "release"], "ts", "60 days").select("title", "release")
    append_output(tasks, out, shared_dir(spark, "tasks-state")).awaitTermination()
    still = table(spark, sf, "events").select("event_id", F.col("event_type").alias("title"), F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd").alias("release"))
    views = still.groupBy("title", "release").agg(F.count("*").alias("views"))
    results = spark.read.parquet(out).join(views, ["title", "release"])
    return drained(still, results, ["title", "release"]).select("event_id", "title", "release", F.coalesce("views", F.lit(0)).alias("views"))


@query(
    "stream_restart",
    """SELECT event_id, CAST(user_id AS VARCHAR) AS pin, p_name, CASE WHEN event_id % 2 = 0 THEN 1 ELSE 2 END AS run FROM events JOIN part ON p_partkey = user_id
    WHERE event_id % 5 <> 0""",
)
def stream_restart(spark, sf):
    """Two runs on one checkpoint, with new files in between; rows that an earlier output holds are passed over in both."""
    source, out, state, done = (shared_dir(spark, n) for n in ("files", "restart", "restart-state", "done"))
    pins = table(spark, sf, "events").select("event_id", F.col("user_id").cast("string").alias("pin"))
    titles = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("id"), "p_name")
    pins.where("event_id % 5 = 0").select("event_id").write.parquet(done)
    for run in (0, 1):
        pins.where(F.col("event_id") % 2 == run).write.mode("append").parquet(source)
        enrich_batches(read_stream(spark, source, pins.schema), titles, "pin", "event_id", out, state, done).awaitTermination()
    rows = spark.read.parquet(out).where("p_name is not null")
    return rows.select(F.col("event_id").cast("bigint").alias("event_id"), "pin", "p_name", (F.col("batch") + 1).cast("int").alias("run"))


@query(
    "stream_trailing_views",
    """WITH e AS (SELECT *, event_id % 3 = 0 AS late FROM events), w AS (SELECT max(ts) FILTER (NOT late) - INTERVAL 1 HOUR AS first, max(ts) - INTERVAL 1 HOUR AS last FROM e),
    d AS (SELECT event_type, late, date_trunc('day', ts) - to_days(k::INT) AS start FROM e, range(7) r(k))
    SELECT strftime(start, '%Y-%m-%d') AS day, event_type, count(*) AS views FROM d, w
    WHERE start + INTERVAL 7 DAY <= last AND (NOT late OR start + INTERVAL 7 DAY > first) GROUP BY ALL""",
)
def stream_trailing_views(spark, sf):
    """Views of the last seven days for every day. A third of the rows comes in a second run: too late for the windows that the first run has closed."""
    source, out, state = (shared_dir(spark, n) for n in ("views", "trailing", "trailing-state"))
    rows = table(spark, sf, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), F.lit(1).cast("long").alias("views"))
    for late in (False, True):
        rows.where((F.col("event_id") % 3 == 0) == late).drop("event_id").write.mode("append").parquet(source)
        sums = trailing_totals(read_stream(spark, source, rows.drop("event_id").schema), "event_type", "ts", "views", 7, "1 hour")
        append_output(sums.select(F.col("window.start").alias("start"), "event_type", "views"), out, state).awaitTermination()
    return spark.read.parquet(out).select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "views")
