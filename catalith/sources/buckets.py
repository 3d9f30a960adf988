"""A catalog kept in buckets of row ids, synced only where an edited export has changed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.functions.lists import is_blank, text
from catalith.operators.overlay import sync_back, sync_columns
from catalith.session import materialize

_BUCKET = "__bucket"


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(text(F.col("RowId"))), F.lit(buckets)).cast("int")


def write_buckets(catalog: DataFrame, path: str, buckets: int = 256) -> None:
    """The catalog as one folder per bucket of row ids under ``path``; an earlier one there is replaced, its digests forgotten."""
    catalog.withColumn(_BUCKET, _bucket(buckets)).repartition(_BUCKET).write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{path}/rows")
    catalog.sparkSession.createDataFrame([], _DIGEST).write.mode("overwrite").parquet(f"{path}/digests")


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    """The whole catalog; a column that some buckets do not have yet is blank there."""
    rows = spark.read.option("mergeSchema", True).parquet(f"{path}/rows").drop(_BUCKET)
    return rows.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in rows.columns])


_DIGEST = f"{_BUCKET} int, n bigint, digest decimal(38,0)"


def edit_digests(edited: DataFrame, columns: list[str], buckets: int) -> DataFrame:
    """(bucket, n, digest): rows of an edit per bucket, and a sum of their hashes that no order changes."""
    names = F.lit("\x1f".join(sorted(columns)))
    row = F.xxhash64(names, *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in sorted(columns)])
    rows = edited.where(~is_blank(F.col("RowId"))).select(_bucket(buckets).alias(_BUCKET), row.cast("decimal(38,0)").alias("h"))
    return rows.groupBy(_BUCKET).agg(F.count("*").alias("n"), F.sum("h").cast("decimal(38,0)").alias("digest"))


def sync_buckets(
    spark: SparkSession, path: str, edited: DataFrame, buckets: int = 256, diagnostic_columns: set[str] = frozenset(), derived_columns: set[str] = frozenset()
) -> list[int]:
    """:func:`sync_back` of an edited export into a catalog of :func:`write_buckets`, which disables rows the export lacks; returns the buckets written.

    The edit is read and hashed; of the catalog only buckets whose part of the edit differs from that of the last sync are read and written. Digests are
    written last, so a sync that was cut short is done again, which changes nothing that is done already. As many numbers as buckets come to the driver.
    """
    columns = sync_columns(edited.columns, set(derived_columns))
    now = materialize(edit_digests(edited, columns, buckets), "digests")
    before = spark.read.schema(_DIGEST).parquet(f"{path}/digests")
    old = before.select(F.col(_BUCKET), F.col("n").alias("n0"), F.col("digest").alias("d0"))
    if before.isEmpty():
        changed = list(range(buckets))
    else:
        same = F.col("n").eqNullSafe(F.col("n0")) & F.col("digest").eqNullSafe(F.col("d0"))
        changed = sorted(r[0] for r in now.join(old, _BUCKET, "full_outer").where(~same).select(_BUCKET).collect())
    if changed:
        rows = spark.read.option("mergeSchema", True).parquet(f"{path}/rows").where(F.col(_BUCKET).isin(changed)).drop(_BUCKET)
        part = edited.withColumn(_BUCKET, _bucket(buckets)).where(F.col(_BUCKET).isin(changed)).drop(_BUCKET)
        synced = materialize(sync_back(rows, part, "disable", diagnostic_columns, derived_columns), "synced")
        placed = synced.withColumn(_BUCKET, _bucket(buckets)).repartition(_BUCKET)
        placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(_BUCKET).parquet(f"{path}/rows")
    now.write.mode("overwrite").parquet(f"{path}/digests")
    return changed
