"""Helpers of the training-data operators: tables, Arrow batches of bytes, scratch tables, connected components."""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalith.session import shared_dir

#: The ASCII white space that separates words everywhere in this package; ``bytes.split()`` splits at the same characters.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and safe when executors are lost."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete the tables behind frames that ``stored`` returned, once all that reads them is stored itself."""
    for frame in frames:
        spark = frame.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(frame._stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release() -> None:
    """Let Spark drop the shuffle files of finished steps."""
    gc.collect()
    SparkSession.active().sparkContext._jvm.System.gc()


def values(batch: pa.RecordBatch, name: str) -> list:
    """A column of a batch as Python values."""
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def long_column(items, mask=None) -> pa.Array:
    """Signed 64-bit column from integers or a numpy array; unsigned input keeps its bits."""
    return pa.array(np.asarray(items).astype(np.int64, copy=False) if not isinstance(items, list) else items, pa.int64(), mask=mask)


def list_column(parts: list[np.ndarray]) -> pa.ListArray:
    """Column of int64 lists out of one array per row."""
    ends = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=ends[1:])
    flat = np.concatenate(parts).astype(np.int64, copy=False) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def small_batches(batches: Iterator[pa.RecordBatch], name: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in slices whose column ``name`` holds about ``most`` bytes at most, or one row."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(name))
        start, size = 0, 0
        for i, n in enumerate(pc.binary_length(column).to_pylist()):
            if i > start and size + (n or 0) > most:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n or 0
        if start < batch.num_rows:
            yield batch.slice(start)


def components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """Connected components of the undirected ``edges`` (a, b): one row (node, component) per node that has an edge to another node.

    The component is the smallest node in it. Large-star and small-star steps alternate until the edges no longer change: every step is a minimum per
    node and a join back, so no component is ever gathered, and the number of rounds grows with the logarithm of the longest path. Equal rows,
    loops and NULL ends are ignored.
    """
    now = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), purpose
    )
    mark = _fingerprint(now)
    files = 1 + mark[0] // 500_000
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large, before = stored(large.coalesce(files), purpose), now
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
        now = stored(small.select("e.u", F.col("e.m").alias("v")).where("u <> v").distinct().coalesce(files), purpose)
        discard(large, before)
        mark, last = _fingerprint(now), mark
        if mark == last:
            break
    parents = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return parents.unionByName(parents.select(F.col("component").alias("node"), "component").distinct())


def _fingerprint(pairs: DataFrame) -> tuple:
    row = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def widened(schema: T.StructType, ddl: str) -> T.StructType:
    """``schema`` with the fields of ``ddl`` after its own."""
    return T.StructType(schema.fields + T.StructType.fromDDL(ddl).fields)


def run_pairs(starts: np.ndarray, ends: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j), i < j, inside each run [start, end) of rows, some at a time."""
    rows = np.arange(starts[0], ends[-1]) if len(starts) else np.zeros(0, np.int64)
    partners = np.repeat(ends, ends - starts) - rows - 1
    total = np.cumsum(partners)
    at = 0
    while at < len(rows):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + most, "right")))
        own = partners[at:to]
        i = np.repeat(rows[at:to], own)
        j = np.arange(len(i)) - np.repeat(np.cumsum(own) - own, own) + i + 1
        yield i, j
        at = to


def finished_groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...], least: int = 4096) -> Iterator[pa.Table]:
    """Rows that come sorted by ``keys``, in tables of ``least`` rows or more that hold whole groups only; the last may be smaller."""
    left: pa.Table | None = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        left = t if left is None else pa.concat_tables([left, t])
        if left.num_rows < least:
            continue
        left = left.combine_chunks()
        differs = np.flatnonzero(np.any([(c := left[k].to_numpy()) != c[-1] for k in keys], 0))
        if len(differs):
            cut = int(differs[-1]) + 1
            yield left.slice(0, cut).combine_chunks()
            left = left.slice(cut)
    if left is not None and left.num_rows:
        yield left.combine_chunks()


def whole_vectors(vectors: DataFrame, key: str, column: str, scale: int) -> DataFrame:
    """(key, x, width): every entry as floor(scale * entry), for rows whose vector and entries are neither NULL nor non-finite.

    Entries beyond the range of a long become the nearest long. The key keeps its type under the name ``key``.
    """
    real = F.transform(column, lambda v: v.cast("double"))
    fine = F.forall(real, lambda v: v.isNotNull() & (F.abs(v) < float("inf")))  # NaN is above infinity to Spark
    kept = vectors.where(F.col(column).isNotNull() & fine)
    return kept.select(F.col(key).alias("key"), F.transform(real, lambda v: F.floor(v * float(scale))).alias("x"), F.size(column).alias("width"))


def join_width(rows: DataFrame, facts: DataFrame, salts: int = 32) -> DataFrame:
    """``rows`` with the one row of ``facts`` of their width.

    Most tables hold a single width, so where ``facts`` is too large for Spark to broadcast its rows are repeated under ``salts`` numbers and rows dealt
    among them.
    """
    each = facts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.withColumn("_salt", (F.monotonically_increasing_id() % salts).cast("int")).join(each, ["width", "_salt"]).drop("_salt")


def matrices(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix) for each width of a column of lists of numbers."""
    widths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    for width in np.unique(widths):
        at = np.flatnonzero(widths == width)
        part = column if len(at) == len(column) else column.take(pa.array(at))
        yield at, part.flatten().to_numpy(zero_copy_only=False).reshape(len(at), width)
