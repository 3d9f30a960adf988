"""Overlay, resume and sync joins on the row id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.constants import PIN_COLUMNS, PROVIDER_PREFIX
from catalith.functions.lists import is_blank, text
from catalith.operators.columns import with_missing_columns


def present(df: DataFrame, c: str) -> Column:
    """The column when it holds something: blank text and empty lists count as missing."""
    kind = df.schema[c].dataType.typeName()
    col = F.col(c)
    if kind == "string":
        return F.when(~is_blank(col), col)
    if kind in ("array", "map"):
        return F.when(F.size(col) > 0, col)
    return col


def overlay(base: DataFrame, other: DataFrame, key: str = "RowId", how: str = "left") -> DataFrame:
    """Join ``other`` onto ``base`` by row id; present values of ``other`` win, missing ones never overwrite."""
    new = [c for c in other.columns if c != key]
    renamed = other.select(F.col(key).alias("__rk"), *[present(other, c).alias(f"__n_{i}") for i, c in enumerate(new)])
    out = base.join(renamed, F.col(key) == F.col("__rk"), how)
    at = {c: i for i, c in enumerate(new)}
    cols = [F.coalesce(F.col(key), F.col("__rk")).alias(key) if c == key else
            F.coalesce(F.col(f"__n_{at[c]}"), F.col(c)).alias(c) if c in at else F.col(c)
            for c in base.columns]
    cols += [F.col(f"__n_{i}").alias(c) for c, i in at.items() if c not in base.columns]
    return out.select(*cols)


def overlay_providers(base: DataFrame, frames: dict[str, DataFrame], key: str = "RowId") -> DataFrame:
    """Overlay each provider's own columns in the given order.

    All joins share the row id, so the base is shuffled once and keeps its partitioning through the chain.
    """
    out = base
    for provider, frame in frames.items():
        prefix = PROVIDER_PREFIX[provider]
        out = overlay(out, frame.select(key, *[c for c in frame.columns if c.startswith(prefix)]), key)
    return out


def carry_columns(df: DataFrame, earlier: DataFrame, keep: list[str], key: str = "RowId") -> DataFrame:
    """Resume: carry selected non-blank columns of an earlier output onto the input rows."""
    cols = [c for c in keep if c in earlier.columns]
    known = [c for c in cols if c in df.columns]
    return overlay(df, earlier.select(key, *known), key) if known else df


def with_recomputed(reused: DataFrame, recomputed: DataFrame, key: str = "RowId") -> DataFrame:
    """Outer overlay of recomputed rows onto reused ones."""
    return overlay(reused, recomputed, key, "full_outer")


def sync_columns(columns: list[str], derived: set[str] = frozenset()) -> list[str]:
    """Columns of an edited export that flow back: id, name, pins and user columns."""
    keep = {"RowId", "Name", *PIN_COLUMNS}
    prefixes = tuple(PROVIDER_PREFIX.values())
    return [c for c in columns if c in keep or not (c.startswith(prefixes) or c.startswith("__") or c in derived)]


def sync_back(
    catalog: DataFrame,
    edited: DataFrame,
    deleted_mode: str = "disable",
    diagnostic_columns: set[str] = frozenset(),
    derived_columns: set[str] = frozenset(),
) -> DataFrame:
    """Upsert an edited export into the catalog: one full outer join on the row id.

    Common rows take the user columns and pins of the edit, rows missing from the edit are disabled (or dropped), new
    rows are appended, diagnostics are dropped.
    """
    if deleted_mode not in ("disable", "drop"):
        raise ValueError(f"unknown deleted_mode: {deleted_mode}")
    cols = sync_columns(edited.columns, set(derived_columns))
    flow = [c for c in cols if c != "RowId"]
    old = catalog.withColumn("RowId", text(F.col("RowId")))
    if deleted_mode == "disable":
        old = with_missing_columns(old, {"Disabled": ""})
    new = edited.where(~is_blank(F.col("RowId"))).select(
        text(F.col("RowId")).alias("__rk"), *[F.col(c).cast("string").alias(f"__e_{i}") for i, c in enumerate(flow)]
    )
    joined = old.join(new, F.col("RowId") == F.col("__rk"), "full_outer")
    edited_here, in_catalog = F.col("__rk").isNotNull(), F.col("RowId").isNotNull()
    if deleted_mode == "drop":
        joined = joined.where(edited_here)
    at = {c: i for i, c in enumerate(flow)}

    def out_col(c: str) -> Column:
        if c == "RowId":
            return F.coalesce(F.col("RowId"), F.col("__rk")).alias(c)
        kept = F.col(c) if c in old.columns else F.lit("")
        if c in at:
            kept = F.when(edited_here, F.coalesce(F.col(f"__e_{at[c]}"), F.lit(""))).otherwise(kept)
        else:
            kept = F.when(in_catalog, kept).otherwise(F.lit(""))
        if c == "Disabled" and deleted_mode == "disable":
            kept = F.when(edited_here, kept).otherwise(F.lit("YES"))
        return F.coalesce(kept, F.lit("")).alias(c)

    drop = set(diagnostic_columns) | {"NeedsReview"}
    order = old.columns + [c for c in flow if c not in old.columns]
    return joined.select(*[out_col(c) for c in order if c not in drop])


def sync_envelope(envelope: DataFrame, edited: DataFrame, diagnostic_columns: set[str] = frozenset()) -> DataFrame:
    """Write edited user values and pins into the row envelope; blanks remove keys, metrics stay untouched.

    The result holds the rows of the edit only.
    """
    flow = [c for c in sync_columns(edited.columns) if c != "RowId" and c not in diagnostic_columns]
    pins = [c for c in flow if c in PIN_COLUMNS]
    personal = [c for c in flow if c not in PIN_COLUMNS]

    def as_map(cols: list[str]) -> Column:
        if not cols:
            return F.create_map().cast("map<string,string>")
        return F.create_map(*[x for c in cols for x in (F.lit(c), text(F.col(c)))])

    edits = edited.where(~is_blank(F.col("RowId"))).select(
        text(F.col("RowId")).alias("__rk"), as_map(personal).alias("__personal"), as_map(pins).alias("__pins")
    )
    joined = envelope.join(edits, F.col("row_id") == F.col("__rk"), "right")

    def merged(old: str, new: str) -> Column:
        none = F.create_map().cast("map<string,string>")
        kept = F.map_filter(F.coalesce(F.col(old), none), lambda k, _v: ~F.map_contains_key(F.col(new), k))
        return F.map_filter(F.map_concat(kept, F.col(new)), lambda _k, v: v != "").alias(old)

    rebuilt = {
        "row_id": F.col("__rk").alias("row_id"),
        "personal": merged("personal", "__personal"),
        "pins": merged("pins", "__pins"),
    }
    return joined.select(*[rebuilt.get(c, F.col(c)) for c in envelope.columns])
