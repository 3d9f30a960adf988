"""Incremental enrichment with Structured Streaming.

Pins and tasks arrive as files, are looked up against static payload tables and written per batch. Each batch owns one
partition folder that a replay overwrites, so a restart after a lost executor or driver repeats no row.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from catalith.functions.lists import is_blank
from catalith.operators.keys import last_per_key, lookup


def read_stream(spark: SparkSession, path: str, schema, pattern: str = "*.parquet", files_per_batch: int | None = None) -> DataFrame:
    """Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def fresh_pins(pins: DataFrame, key: str, time: str, delay: str) -> DataFrame:
    """Each pin once within the watermark: the state kept per pin is dropped when the watermark passes it."""
    return pins.where(~is_blank(F.col(key))).withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def distinct_tasks(rows: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """Each task (the values of ``keys``) once within the watermark, however many rows ask for it."""
    asked = rows.where(~is_blank(F.col(keys[0]).cast("string"))).select(*keys, time)
    return asked.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def drained(rows: DataFrame, results: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the result of their task; a task that was answered twice counts once."""
    return rows.join(results.dropDuplicates(keys), keys, "left")


def enrich_batches(
    pins: DataFrame, payloads: DataFrame, pin: str, row_key: str, out: str, checkpoint: str, done: str | None = None
) -> StreamingQuery:
    """Look up every batch of pins in a static payload table ``(id, ..)`` and write it; rows already done are skipped.

    ``done`` names a folder of earlier output whose row ids are left out. Runs until the available files are used up.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch
        if done is not None:
            seen = batch.sparkSession.read.parquet(done).select(row_key).distinct()
            rows = rows.join(seen, row_key, "left_anti")
        found = lookup(rows, payloads, pin, "id", row_key)
        found.write.mode("overwrite").parquet(os.path.join(out, f"batch={batch_id}"))

    return (
        pins.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def latest_view(spark: SparkSession, out: str, row_key: str) -> DataFrame:
    """Upserted state: the row of the newest batch per row id."""
    return last_per_key(spark.read.parquet(out), row_key, "batch").drop("batch")


def task_totals(tasks: DataFrame, time: str, delay: str, keys: list[str], window: str) -> DataFrame:
    """Rows per event-time window and key; late rows are settled by the watermark."""
    marked = tasks.withWatermark(time, delay)
    return marked.groupBy(F.window(time, window), *keys).agg(F.count(F.lit(1)).alias("n"))


def trailing_totals(rows: DataFrame, key: str, time: str, value: str, days: int, delay: str) -> DataFrame:
    """Sums of ``value`` per key over the last ``days`` days, for every day: sliding event-time windows that close when the watermark passes their end.

    A row that comes late still counts in the windows that are open, and in none that is closed. State is one sum per key and open window.
    """
    sliding = F.window(F.col(time), f"{days} days", "1 day").alias("window")
    return rows.withWatermark(time, delay).groupBy(sliding, key).agg(F.sum(value).alias(value))


def append_output(df: DataFrame, out: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Write a stream to Parquet until the available files are used up."""
    return (
        df.writeStream.outputMode(mode)
        .format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
