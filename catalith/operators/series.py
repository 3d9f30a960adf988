"""Daily series: dense days, trailing windows, windows since release, latest stored window."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from catalith.constants import EARLIEST_PAGEVIEWS
from catalith.functions.parse import stamp_date, window_key


def daily_items(payloads: DataFrame, key: str = "article") -> DataFrame:
    """Series payloads ``{"items": [{timestamp, views}]}`` to ``(key, day, views)``; the last item of a day stands."""
    items = F.try_variant_get("payload", "$.items", "array<struct<timestamp:string,views:bigint>>")
    opened = payloads.select(key, F.posexplode(items).alias("pos", "item"))
    dated = opened.select(key, "pos", stamp_date(F.col("item.timestamp")).alias("day"), F.col("item.views").alias("views"))
    return dated.where("day is not null and views >= 0").groupBy(key, "day").agg(F.max_by("views", "pos").alias("views"))


def dense_days(series: DataFrame, bounds: DataFrame, key: str, value: str = "views") -> DataFrame:
    """One row per key and day of ``bounds(key, start, end)``, zero where the series has none."""
    spine = bounds.select(key, F.explode(F.sequence(F.col("start"), F.col("end"))).alias("day"))
    return spine.join(series.select(key, "day", value), [key, "day"], "left").select(
        key, "day", F.coalesce(F.col(value), F.lit(0).cast("bigint")).alias(value)
    )


def last_day(series: DataFrame) -> Column:
    """The newest day of a series, as a constant: one small aggregate."""
    return F.lit(series.agg(F.max("day")).first()[0]).cast("date")


def _zeros(sums: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``sums`` for every key; a key without a day in any window has 0, as a series of empty days sums to."""
    values = [c for c in sums.columns if c != key]
    return keys.select(key).distinct().join(sums, key, "left").select(key, *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in values])


def trailing_sums(
    series: DataFrame, key: str, end: Column, days: Iterable[int] = (30, 90, 365), value: str = "views", keys: DataFrame | None = None
) -> DataFrame:
    """Sums over the last N days up to ``end`` inclusive: one pre-aggregated pass, all windows at once.

    Missing days count as zero, so no dense series is needed. ``keys`` lists the keys with a stored series; without it, they are those of ``series``.
    """
    days = list(days)
    recent = series.where((F.col("day") <= end) & (F.col("day") > F.date_sub(end, max(days))))
    sums = recent.groupBy(key).agg(
        *[F.sum(F.when(F.col("day") > F.date_sub(end, n), F.col(value)).otherwise(0)).alias(f"{value}_{n}d") for n in days]
    )
    return _zeros(sums, series if keys is None else keys, key)


def launch_sums(
    series: DataFrame,
    releases: DataFrame,
    key: str,
    end: Column,
    days: Iterable[int] = (30, 90),
    value: str = "views",
    earliest: str = EARLIEST_PAGEVIEWS,
) -> DataFrame:
    """Sums over the first N days since release, for releases between ``earliest`` and ``end``.

    ``releases``: ``key, release`` (DATE), the keys with a stored series; a window without data sums to 0. No day is joined with a release: the ends of the
    windows are put among a key's days, a running sum of views passes over both, and a window is the difference of two of its values. A key has a row a day
    at most, so its running sum is short.
    """
    days = list(days)
    eligible = releases.where((F.col("release") >= F.lit(earliest).cast("date")) & (F.col("release") <= end))
    ends = [F.date_sub("release", 1), *[F.least(F.date_add("release", n - 1), end) for n in days]]
    marks = eligible.select(key, F.posexplode(F.array(*ends)).alias("mark", "day"))
    both = series.select(key, "day", F.col(value).alias("__v"), F.lit(-1).alias("mark")).unionByName(marks.withColumn("__v", F.lit(0).cast("bigint")))
    so_far = Window.partitionBy(key).orderBy("day", "mark").rowsBetween(Window.unboundedPreceding, 0)
    passed = both.withColumn("__sum", F.sum("__v").over(so_far)).where("mark >= 0")
    start = F.sum(F.when(F.col("mark") == 0, F.col("__sum")))
    return passed.groupBy(key).agg(
        *[(F.sum(F.when(F.col("mark") == k, F.col("__sum"))) - start).cast("bigint").alias(f"{value}_first_{n}d") for k, n in enumerate(days, 1)]
    )


def latest_windows(keys: DataFrame, column: str = "request_key") -> DataFrame:
    """Latest stored request per (project, access, article, length) out of window keys."""
    parts = window_key(F.col(column))
    parsed = keys.select(column, *[v.alias(k) for k, v in parts.items()]).where("valid")
    return (
        parsed.groupBy("project", "access", "article", "days")
        .agg(F.max_by(F.struct(column, "start", "end"), F.struct("end", column)).alias("w"))
        .select("project", "access", "article", "days", "w.*")
    )
