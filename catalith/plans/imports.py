"""Import: normalise a user's list, match every provider, tag the result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.constants import NOT_FOUND, PIN_COLUMNS
from catalith.functions.fuzzy import with_fuzzy_scores
from catalith.functions.lists import is_blank, text
from catalith.functions.parse import is_game_type, is_yes
from catalith.functions.text import pc_like, row_year_hint
from catalith.operators.columns import active_rows, fill_year_hint, with_missing_columns
from catalith.operators.crosswalk import infer_store_ids
from catalith.operators.diagnostics import review_tags
from catalith.operators.keys import ensure_row_ids, lookup, occurrence_number, require_unique
from catalith.session import materialize

CARRIED = ("RowId", "Disabled", "YearHint", *PIN_COLUMNS)
LABELS = {"rawg": "RAWG", "igdb": "IGDB", "steam": "Steam", "hltb": "HLTB", "wikidata": "Wikidata"}
PIN = {"rawg": "RAWG_ID", "igdb": "IGDB_ID", "steam": "Steam_AppID", "hltb": "HLTB_ID", "wikidata": "Wikidata_QID"}


def carry_by_occurrence(df: DataFrame, previous: DataFrame, order: str, name: str = "Name") -> DataFrame:
    """Carry ids and pins of an earlier catalog onto a fresh export: the n-th row of a name meets the earlier n-th.

    Only blanks are filled. Both sides are numbered chunk-wise, so a name in a third of the rows stays distributed, and
    the join key (name, number) is unique on both sides.
    """
    carried = [c for c in CARRIED if c in previous.columns]
    left = occurrence_number(df, [name], order, "__occ")
    right = occurrence_number(previous.select(name, order, *carried), [name], order, "__occ")
    side = right.select(
        F.col(name).alias("__pn"), F.col("__occ").alias("__po"), *[F.col(c).alias(f"__prev_{c}") for c in carried]
    )
    joined = left.join(side, F.col(name).eqNullSafe(F.col("__pn")) & (F.col("__occ") == F.col("__po")), "left")
    filled = {
        c: F.when(text(F.col(c)) != "", F.col(c)).otherwise(F.col(f"__prev_{c}")) if c in df.columns else F.col(f"__prev_{c}")
        for c in carried
    }
    return joined.withColumns(filled).drop("__pn", "__po", "__occ", *[f"__prev_{c}" for c in carried])


def normalize_catalog(
    df: DataFrame, order: str, previous: DataFrame | None = None, diagnostic_columns: set[str] = frozenset(), check: bool = True
) -> DataFrame:
    """Catalog with ids, pins and trimmed names; repeated ids in the input are refused (``check`` runs that test)."""
    if "Name" not in df.columns:
        raise ValueError("the input has no Name column")
    carried = previous is not None and "RowId" not in df.columns
    out = carry_by_occurrence(df, previous, order) if carried else df
    if check and "RowId" in df.columns:
        require_unique(out.where(~is_blank(F.col("RowId"))))
    needed = ["RowId", "Name", "Disabled", "YearHint", *PIN_COLUMNS, *sorted(diagnostic_columns)]
    out = with_missing_columns(out, {c: "" for c in needed}).withColumn("Name", text(F.col("Name")))
    return ensure_row_ids(out, order).drop("__new_id")


def match_queries(catalog: DataFrame, pin: str, platform_rule: bool = False) -> DataFrame:
    """Rows to search for: active, named, without a pin (and, for stores, on a PC-like platform)."""
    rows = active_rows(catalog).where(is_blank(F.col(pin)))
    if platform_rule and "Platform" in catalog.columns:
        rows = rows.where(pc_like(F.col("Platform")))
    return rows.select(F.col("RowId").alias("row_id"), "Name", row_year_hint(catalog.columns).alias("year_hint")).withColumnRenamed(
        "Name", "name"
    )


def match_pins(
    catalog: DataFrame, provider: str, selected: DataFrame, facts: DataFrame, extra: dict[str, Column] | None = None
) -> DataFrame:
    """Pin the selected ids and write the matching diagnostics of active rows.

    ``selected``: ``row_id, id`` (+ ``rejected_reason`` where a rule refuses hits); ``facts``: ``id, m_name, m_year`` (+ columns used by ``extra``).
    Sentinel rows get blank diagnostics, pinned rows are looked up, the rest take the search result.
    """
    pin, label = PIN[provider], LABELS[provider]
    name_col = "Wikidata_MatchedLabel" if provider == "wikidata" else f"{label}_MatchedName"
    refuses = "rejected_reason" in selected.columns
    why = F.col("rejected_reason") if refuses else F.lit(None).cast("string")
    side = selected.select(F.col("row_id").alias("__sk"), F.col("id").cast("string").alias("__sid"), why.alias("__why"))
    joined = catalog.join(side, F.col("RowId") == F.col("__sk"), "left").drop("__sk")
    usable = ~is_blank(F.col("Name")) & (~is_yes(F.col("Disabled")) if "Disabled" in catalog.columns else F.lit(True))
    own = text(F.col(pin))
    joined = joined.withColumn(pin, F.when((own == "") & usable, F.coalesce(F.col("__sid"), F.lit(""))).otherwise(own)).drop("__sid")
    joined = joined.withColumn("__ask", F.when(usable & (F.col(pin) != NOT_FOUND) & (F.col(pin) != ""), F.col(pin)))
    known = lookup(joined, facts, "__ask", "id", "RowId")
    scored = with_fuzzy_scores(known, {"__score": ("Name", "m_name")})
    found = F.col("m_name").isNotNull()
    gone = F.col(pin) == NOT_FOUND
    new = {
        name_col: text(F.col("m_name")),
        f"{label}_MatchScore": F.when(text(F.col("m_name")) != "", F.col("__score").cast("string")).otherwise(""),
        f"{label}_MatchedYear": F.coalesce(F.col("m_year").cast("string"), F.lit("")),
        **(extra or {}),
    }
    writes = {}
    for c, value in new.items():
        kept = text(F.col(c)) if c in catalog.columns else F.lit("")
        writes[c] = F.when(gone, "").when(found, value).otherwise(kept)
    if refuses:
        reason = f"{label}_RejectedReason"
        writes[reason] = F.coalesce("__why", F.when(F.col(pin) == "", text(F.col(reason)) if reason in catalog.columns else F.lit("")).otherwise(""))
    facts_only = [c for c in facts.columns if c != "id"]
    return scored.withColumns(writes).drop("__ask", "__score", "__why", *facts_only)


def drop_invalid_store_pins(catalog: DataFrame, details: DataFrame) -> DataFrame:
    """Clear store pins whose details are missing or no game, so that the row is searched again."""
    pin = "Steam_AppID"
    asked = catalog.withColumn("__ask", F.when(text(F.col(pin)).rlike(r"^\d+$"), text(F.col(pin))))
    facts = details.select("id", F.col("d_type").alias("__dt"), F.lit(True).alias("__dk"))
    known = lookup(asked, facts, "__ask", "id", "RowId")
    bad = F.col("__ask").isNotNull() & ~(F.coalesce(F.col("__dk"), F.lit(False)) & is_game_type(F.col("__dt")))
    active = ~is_yes(F.col("Disabled")) if "Disabled" in catalog.columns else F.lit(True)
    return known.withColumn(pin, F.when(bad & active, "").otherwise(F.col(pin))).drop("__ask", "__dt", "__dk")


def infer_store_pins(catalog: DataFrame, cross_ids: DataFrame, details: DataFrame) -> DataFrame:
    """Fill blank store pins from other providers' payloads where the implied id is a game.

    ``cross_ids``: ``RowId, igdb_steam_id, rawg_steam_id``; the first is trusted before the second.
    """
    rows = match_queries(catalog, "Steam_AppID", True).join(
        cross_ids.select(F.col("RowId").alias("row_id"), "igdb_steam_id", "rawg_steam_id"), "row_id"
    )
    first = infer_store_ids(rows, "igdb_steam_id", details)
    second = infer_store_ids(rows, "rawg_steam_id", details)
    both = first.select("row_id", "id", F.lit(0).alias("rank")).unionByName(second.select("row_id", "id", F.lit(1).alias("rank")))
    best = both.groupBy(F.col("row_id").alias("__rk")).agg(F.min_by("id", "rank").alias("__id"))
    joined = catalog.join(best, F.col("RowId") == F.col("__rk"), "left")
    own = text(F.col("Steam_AppID"))
    return joined.withColumn("Steam_AppID", F.when(own == "", F.coalesce("__id", F.lit(""))).otherwise(own)).drop("__rk", "__id")


def import_catalog(
    df: DataFrame,
    order: str,
    selectors: dict[str, object],
    facts: dict[str, DataFrame],
    previous: DataFrame | None = None,
    store_details: DataFrame | None = None,
    cross_ids=None,
    payload_facts=None,
    sources: set[str] | None = None,
) -> DataFrame:
    """Import in stages: RAWG and IGDB, then the store, playtimes and entities, then tags.

    Before the store's stage, pins that name no game are dropped, and ids implied by the payloads of the first stages are put in; what is blank then is
    searched for, dropped pins included. ``selectors`` maps provider to ``queries -> (row_id, id, ..)`` (see ``operators.search.indexed_search``);
    ``facts`` maps provider to ``id, m_name, m_year``; ``cross_ids`` and ``payload_facts`` are ``catalog -> DataFrame`` functions keyed by ``RowId``. Each
    stage is written once, as the next one asks about it in several steps.
    """
    out = materialize(fill_year_hint(normalize_catalog(df, order, previous)), "normalized")
    for provider in ("rawg", "igdb", "steam", "hltb", "wikidata"):
        if provider not in selectors:
            continue
        if provider == "steam":
            if store_details is not None:
                out = drop_invalid_store_pins(out, store_details)
            if cross_ids is not None and store_details is not None:
                out = materialize(infer_store_pins(out, cross_ids(out), store_details), "inferred")
        queries = match_queries(out, PIN[provider], provider == "steam")
        out = materialize(match_pins(out, provider, selectors[provider](queries), facts[provider]), provider)
    if payload_facts is not None:
        extra = payload_facts(out).withColumnRenamed("RowId", "__fk")
        names = [c for c in extra.columns if c != "__fk"]
        tagged = review_tags(out.join(extra, F.col("RowId") == F.col("__fk"), "left").drop("__fk"), sources)
        return tagged.drop(*names)
    return review_tags(out, sources)
