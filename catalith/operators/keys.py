"""Keyed steps that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from catalith.functions.lists import blank_to_null, is_blank, strip, text


def lookup(left: DataFrame, right: DataFrame, left_key: str, right_key: str, spread_by: str) -> DataFrame:
    """Left join on a pin; rows without a pin are spread by ``spread_by`` instead of meeting on one NULL partition.

    ``right`` is unique on its key. Hot pins are split by adaptive skew-join handling, which can split the left side.
    """
    pin = blank_to_null(F.col(left_key))
    keyed = left.withColumn(
        "__k", F.coalesce(F.concat(F.lit("k:"), pin), F.concat(F.lit("none:"), F.col(spread_by).cast("string")))
    )
    target = right.withColumn("__rk", F.concat(F.lit("k:"), text(F.col(right_key)))).drop(right_key)
    return keyed.join(target, F.col("__k") == F.col("__rk"), "left").drop("__k", "__rk")


def lookup_stored(left: DataFrame, store: DataFrame, left_key: str, right_key: str, spread_by: str) -> DataFrame:
    """:func:`lookup` in a large table that is laid out by its key (``sources.tables.stored_payloads``), which is not shuffled.

    The distinct pins, reduced before they are shuffled, meet the table where it lies; only what they find is joined to the rows. So a pin that a third of the
    rows holds is asked once, and the table costs its scan. What was found, one row per pin, is hashed, so the rows of a hot pin stream past it and are not sorted.
    """
    asked = left.select(blank_to_null(F.col(left_key)).alias("__asked")).where("__asked is not null").distinct()
    found = asked.join(store, F.col("__asked") == F.col(right_key)).drop("__asked")
    return lookup(left, found.hint("shuffle_hash"), left_key, right_key, spread_by)


def occurrence_number(df: DataFrame, keys: list[str], order: str, out: str = "occ", chunk_rows: int = 1_000_000) -> DataFrame:
    """Number the rows of each key from 0 in ``order`` (an integer ordinal), without one task per key.

    Rows are numbered inside chunks of the ordinal; the chunk totals (pre-aggregated before the shuffle) give each
    chunk its offset. A key that fills the table is thus numbered by as many tasks as it has chunks.
    """
    chunk = "__chunk"
    cut = df.withColumn(chunk, F.floor(F.col(order) / F.lit(chunk_rows)))
    totals = cut.groupBy(*keys, chunk).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, chunk, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    local = Window.partitionBy(*keys, chunk).orderBy(order)
    numbered = cut.withColumn("__local", F.row_number().over(local) - 1)
    cond = F.lit(True)
    for k in [*keys, chunk]:
        cond = cond & numbered[k].eqNullSafe(offsets[k])
    joined = numbered.join(offsets, cond, "left").select(
        *[numbered[c] for c in df.columns], (F.col("__local") + F.col("__off")).cast("bigint").alias(out)
    )
    return joined


def last_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """Last row of each non-blank key: a partial aggregate, so a hot key is reduced before the shuffle."""
    key_col = strip(F.col(key).cast("string"))
    rest = [c for c in df.columns if c != key]
    picked = (
        df.where(~is_blank(F.col(key)))
        .groupBy(key_col.alias(key))
        .agg(F.max_by(F.struct(*rest), F.col(order)).alias("__row"))
    )
    return picked.select(key, "__row.*").select(*df.columns)


def ensure_row_ids(df: DataFrame, order: str, name: str = "Name", col: str = "RowId", salt: str = "") -> DataFrame:
    """Fill blank row ids and re-id every repeat but the first; new ids come from name, ordinal and the run's ``salt``.

    An id made that a row holds already (it was made for the same name and ordinal, and its row moved) is made anew from itself. The first holder of each id is found by a pre-aggregated minimum and matched on (id, ordinal), a pair that is
    unique, so neither blank nor repeated ids gather in one task. ``__new_id`` marks the created ids.
    """
    base = df.withColumn(col, text(F.col(col))) if col in df.columns else df.withColumn(col, F.lit(""))
    firsts = (
        base.where(F.col(col) != "")
        .groupBy(F.col(col).alias("__fid"))
        .agg(F.min(order).alias("__ford"))
        .withColumn("__first", F.lit(True))
    )
    marked = base.join(firsts, (F.col(col) == F.col("__fid")) & (F.col(order) == F.col("__ford")), "left")
    keep = F.coalesce(F.col("__first"), F.lit(False))

    def made(*parts: Column) -> Column:
        return F.concat(F.lit("rid:"), F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 32))

    fresh = made(text(F.col(name)), F.col(order).cast("string"), *([F.lit(salt)] if salt else []))
    given = marked.select("*", F.when(keep, F.col(col)).otherwise(fresh).alias("__id"), (~keep).alias("__new_id"))
    held = firsts.select(F.col("__fid").alias("__held"))
    met = given.join(held, F.col("__new_id") & (F.col("__id") == F.col("__held")), "left")
    unique = F.when(F.col("__held").isNotNull(), made(F.col("__id"), F.lit("again"))).otherwise(F.col("__id"))
    return met.select(*[unique.alias(c) if c == col else F.col(c) for c in base.columns], "__new_id")


def duplicate_ids(df: DataFrame, col: str = "RowId") -> DataFrame:
    """Ids held by more than one row, blanks included, with their counts."""
    return df.groupBy(text(F.col(col)).alias(col)).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def require_unique(df: DataFrame, col: str = "RowId") -> DataFrame:
    """Fail the job when an id repeats; an eager check of one small aggregate."""
    if not duplicate_ids(df, col).isEmpty():
        raise ValueError(f"duplicate {col} values; fix them before importing")
    return df


def missing_rows(expected: DataFrame, present: DataFrame, key: str = "RowId") -> DataFrame:
    """Rows whose id is absent from an earlier output."""
    return expected.where(~is_blank(F.col(key))).join(present.select(key), key, "left_anti")


def keep_ids(df: DataFrame, ids: DataFrame, key: str = "RowId") -> DataFrame:
    """Rows whose id is in a set of ids."""
    wanted = ids.select(text(F.col(key)).alias("__id")).where(F.col("__id") != "")
    return df.join(wanted, text(F.col(key)) == F.col("__id"), "left_semi")


def first_n(df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """First ``n`` rows per key; Spark limits each group map-side before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)
