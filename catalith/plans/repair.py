"""Resolve: repair likely-wrong pins with the majority of the other providers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.functions.lists import is_blank
from catalith.session import materialize
from catalith.operators.crosswalk import resolve_by_ids
from catalith.operators.diagnostics import review_tags
from catalith.operators.resolve import (
    apply_actions,
    plan_actions,
    resolve_stats,
    retry_query,
    retry_targets,
    search_year,
    with_majority,
)


def planned_repairs(
    catalog: DataFrame,
    searchers: dict[str, Callable[[DataFrame], DataFrame]],
    titles: list[Column] | None = None,
    claims: DataFrame | None = None,
    entities: DataFrame | None = None,
    retry_missing: bool = False,
    sources: set[str] | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """(tagged catalog, one action per pin to try again, entity hints).

    ``searchers`` maps provider to ``queries(row_id, name, year_hint) -> (row_id, id, new_name, new_year)``; ``titles``
    are list columns of known titles of a row besides the majority's, in order of trust.
    """
    # Written once: the steps below filter on tags and majorities, which must not be recomputed inside every filter.
    work = materialize(with_majority(materialize(review_tags(catalog, sources), "tagged")), "majority")
    tagged = work.drop("majority_title", "majority_year")
    targets = retry_targets(work, tuple(p for p in ("steam", "rawg", "igdb") if p in searchers), retry_missing)
    rows = work.where(F.col("majority_title").isNotNull())
    listed = [F.array(F.col("majority_title")), *(titles or [])]
    target = F.coalesce(F.nullif(F.col("majority_title"), F.lit("")), F.col("Name"))
    queries = retry_query(rows, listed, target).join(rows.select("RowId", search_year(catalog.columns).alias("year_hint")), "RowId")
    queries = materialize(queries.select(F.col("RowId").alias("row_id"), F.col("retry_query").alias("name"), "year_hint"), "retries")
    found: DataFrame | None = None
    for provider, search in searchers.items():
        asked = targets.where(F.col("provider") == provider).select(F.col("RowId").alias("row_id")).distinct()
        hits = search(queries.join(asked, "row_id", "left_semi"))
        named = hits.select(
            F.col("row_id").alias("RowId"), F.lit(provider).alias("provider"), F.col("id").cast("string").alias("new_id"), "new_name", "new_year"
        )
        found = named if found is None else found.unionByName(named)
    actions = materialize(plan_actions(targets, found), "actions")
    hints = None
    if claims is not None and entities is not None:
        lacking = rows.where(is_blank(F.col("Wikidata_QID"))).select(
            F.col("RowId").alias("row_id"), F.col("Steam_AppID").alias("store_id"), F.col("IGDB_ID").alias("game_db_id")
        )
        hints = resolve_by_ids(lacking, claims, entities).select(F.col("row_id").alias("RowId"), "qid")
    return tagged, actions, hints


def resolve_pins(
    catalog: DataFrame, searchers: dict[str, Callable[[DataFrame], DataFrame]], apply: bool = False, sources: set[str] | None = None, **options
) -> tuple[DataFrame, DataFrame]:
    """Repaired catalog (unchanged but for fresh tags unless ``apply``) and one row of statistics; ``options`` as for :func:`planned_repairs`."""
    tagged, actions, hints = planned_repairs(catalog, searchers, sources=sources, **options)
    stats = resolve_stats(actions, hints)
    if not apply:
        return tagged, stats
    return review_tags(apply_actions(tagged, actions, hints), sources), stats
