"""Identity crosswalks: ids implied by other providers' payloads and by entity claims."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.constants import GAME_DB_ID_PROPERTY, LINK_PROPERTIES, NOT_FOUND, STORE_ID_PROPERTY
from catalith.functions.lists import is_blank, text
from catalith.functions.parse import is_game_type
from catalith.operators.keys import lookup


def store_id_from_external(external: Column) -> Column:
    """Store id out of an ``external_games`` list: first item from source 1 or of category ``steam``."""
    hits = F.filter(
        external,
        lambda x: (x["external_game_source"].cast("string") == "1") | (F.lower(text(x["category"])) == "steam"),
    )
    return F.coalesce(text(F.get(hits, F.lit(0))["uid"]), F.lit(""))


def infer_store_ids(rows: DataFrame, inferred: str, details: DataFrame, key: str = "row_id") -> DataFrame:
    """Accept an inferred store id where its details exist and are a game: ``row_id, id, d_name, d_date``."""
    asked = rows.select(key, inferred).where(F.col(inferred).rlike(r"^\d+$"))
    found = lookup(asked, details, inferred, "id", key)
    ok = found.where(F.col("d_name").isNotNull() & is_game_type(F.col("d_type")))
    return ok.select(key, F.col(inferred).alias("id"), "d_name", "d_date")


def resolve_by_ids(rows: DataFrame, claims: DataFrame, entities: DataFrame, key: str = "row_id") -> DataFrame:
    """Entity of each row by store id first, then by game-database id; only known entities count.

    ``rows``: ``row_id, store_id, game_db_id``; ``claims``: ``qid, prop, value``; ``entities``: ``qid``. When several
    entities carry an id the smallest stands.
    """
    asked = rows.select(
        key,
        F.inline(
            F.array(
                F.struct(F.lit(0).alias("rank"), F.lit(STORE_ID_PROPERTY).alias("prop"), text(F.col("store_id")).alias("value")),
                F.struct(F.lit(1).alias("rank"), F.lit(GAME_DB_ID_PROPERTY).alias("prop"), text(F.col("game_db_id")).alias("value")),
            )
        ),
    ).where("value <> ''")
    known = claims.join(entities.select("qid"), "qid", "left_semi")
    owner = known.groupBy("prop", text(F.col("value")).alias("value")).agg(F.min("qid").alias("qid"))
    return asked.join(owner, ["prop", "value"]).groupBy(key).agg(F.min_by("qid", "rank").alias("qid"))


def linked_labels(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Sorted distinct labels per entity and linked property, one list column per property.

    ``edges``: ``qid, prop, target``; ``labels``: ``qid, label, site_title``. A target without a label shows its site
    title with spaces, or the not-found sentinel; an unknown target shows nothing.
    """
    names = labels.select(
        F.col("qid").alias("target"),
        F.coalesce(
            F.nullif(text(F.col("label")), F.lit("")),
            F.nullif(F.replace(text(F.col("site_title")), F.lit("_"), F.lit(" ")), F.lit("")),
            F.lit(NOT_FOUND),
        ).alias("name"),
    )
    wanted = edges.where(F.col("prop").isin(*LINK_PROPERTIES.values()) & ~is_blank(F.col("target"))).distinct()
    named = wanted.join(names, "target").select("qid", "prop", "name").distinct()
    return named.groupBy("qid").agg(
        *[
            F.array_sort(F.collect_set(F.when(F.col("prop") == prop, F.col("name")))).alias(field)
            for field, prop in LINK_PROPERTIES.items()
        ]
    )
