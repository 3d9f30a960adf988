"""Row envelopes, exports, CSV and payload stores: written to the shared folder and read back."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from catalith.session import shared_dir
from catalith.sources import envelope as ev
from catalith.sources.registry import default_registry, load_registry
from catalith.sources.tables import payload_rows, read_csv, rendered, write_csv
from catalith.workload.frames import SOURCES, duck, spark_frame, table
from catalith.workload.registry import query

_EXPORTED = ["RowId", "Name", "RAWG_ID", "RAWG_RatingsCount", "IGDB_Genres", "HLTB_Main", "Steam_Name", "Absent"]


def _wide(spark, sf):
    return spark_frame(spark, sf, SOURCES).select("RowId", "Name", "RAWG_ID", "RAWG_RatingsCount", "IGDB_Genres", "HLTB_Main", "Steam_Name", "IGDB_CriticScoreCount")


_VIEW = f"""SELECT RowId, Name, CAST(RAWG_RatingsCount AS DOUBLE) AS votes, array_to_string(IGDB_Genres, '|') AS genres, coalesce(HLTB_Main, -1.0::DOUBLE) AS hours,
    coalesce(IGDB_CriticScoreCount, -1) AS critics, RAWG_ID AS pin FROM {duck(SOURCES)}"""


def _typed(envelope):
    view = ev.registered_view(envelope, default_registry(), ["rawg.ratings_count", "igdb.genres", "hltb.time.main", "igdb.critic_score_count"])
    own = ev.catalog_view(envelope, False, {"personal": ["Name"], "pins": ["RAWG_ID"]})
    return view.join(own, "RowId").select(
        "RowId", "Name", F.col("RAWG_RatingsCount").cast("double").alias("votes"), F.array_join("IGDB_Genres", "|").alias("genres"),
        F.coalesce("HLTB_Main", F.lit(-1.0)).alias("hours"), F.coalesce("IGDB_CriticScoreCount", F.lit(-1).cast("bigint")).alias("critics"),
        F.coalesce("RAWG_ID", F.lit("")).alias("pin"),
    )


@query("envelope_rows", _VIEW)
def envelope_rows(spark, sf):
    return _typed(ev.to_envelope(_wide(spark, sf), default_registry()))


@query("envelope_round_trip", _VIEW)
def envelope_round_trip(spark, sf):
    path = shared_dir(spark, "envelope")
    ev.write_envelope(ev.to_envelope(_wide(spark, sf), default_registry(), provider="rawg"), path)
    return _typed(ev.read_envelope_strict(spark, path))


@query(
    "export_cells",
    f"""SELECT RowId, Name, RAWG_ID, CAST(RAWG_RatingsCount AS VARCHAR) AS RAWG_RatingsCount, array_to_string(IGDB_Genres, ', ') AS IGDB_Genres,
    coalesce(CAST(CAST(HLTB_Main AS DECIMAL(18, 1)) AS VARCHAR), '') AS HLTB_Main, Steam_Name, '' AS Absent FROM {duck(SOURCES)}""",
)
def export_cells(spark, sf):
    registry = default_registry()
    return ev.export_csv_view(ev.to_envelope(_wide(spark, sf), registry), ev.manifest_of(_EXPORTED, registry), registry)


@query(
    "export_json",
    f"""SELECT RowId AS row_id, Name AS name, coalesce(CAST(RAWG_RatingsCount AS VARCHAR), '') AS votes, CAST(len(IGDB_Genres) AS BIGINT) AS n_genres,
    HLTB_Main IS NOT NULL AS has_hours FROM {duck(SOURCES)}""",
)
def export_json(spark, sf):
    registry = default_registry()
    lines = ev.export_json_view(ev.to_envelope(_wide(spark, sf), registry), ev.manifest_of(_EXPORTED, registry), registry)
    return lines.select(
        F.get_json_object("value", "$.RowId").alias("row_id"), F.get_json_object("value", "$.Name").alias("name"),
        F.coalesce(F.get_json_object("value", "$.RAWG_RatingsCount"), F.lit("")).alias("votes"),
        F.json_array_length(F.get_json_object("value", "$.IGDB_Genres")).cast("bigint").alias("n_genres"),
        F.get_json_object("value", "$.HLTB_Main").isNotNull().alias("has_hours"),
    )


_COUNTED = {
    "RAWG_RatingsCount": "rawg.ratings_count", "IGDB_CriticScoreCount": "igdb.critic_score_count", "HLTB_Main": "hltb.time.main", "Steam_Name": "steam.name",
    "IGDB_Genres": "igdb.genres", "RAWG_HypeScore2024": "rawg.hype_score_2024", "SteamSpy_Tier-Name": "steamspy.tier_name",
}
_FILLED = {
    "Steam_Name": "nullif(Steam_Name, '')", "RAWG_HypeScore2024": "CASE WHEN p_size % 3 > 0 THEN 1 END", "SteamSpy_Tier-Name": "CASE WHEN p_size % 4 = 1 THEN 1 END",
}


@query(
    "metric_coverage",
    " UNION ALL ".join(
        f"SELECT '{key}' AS metric_key, count({_FILLED.get(c, c)}) AS filled, {'false' if c in ('RAWG_HypeScore2024', 'SteamSpy_Tier-Name') else 'true'} AS registered FROM {duck(SOURCES)}"
        for c, key in _COUNTED.items()
    ),
)
def metric_coverage(spark, sf):
    """How many rows fill each metric, by a registry read from a file; columns that it does not map go by keys derived from their names."""
    registry, path = default_registry(), shared_dir(spark, "registry")
    spec = {"version": 2, "metrics": {k: {"column": c, "type": t} for k, (c, t) in registry.by_key.items()}}
    spark.createDataFrame([(json.dumps(spec),)], "value string").coalesce(1).write.text(path)
    loaded = load_registry(path, spark)
    extra = {"RAWG_HypeScore2024": F.when(F.col("p_size") % 3 > 0, "high").otherwise(" "), "SteamSpy_Tier-Name": F.when(F.col("p_size") % 4 == 1, "A")}
    wide = spark_frame(spark, sf, SOURCES).withColumns(extra).select("RowId", "Name", *[f"`{c}`" for c in _COUNTED])
    keys = F.map_keys(F.try_variant_get("metrics", "$", "map<string,variant>"))
    counts = ev.to_envelope(wide, loaded, all_metrics=True).select(F.explode(keys).alias("metric_key")).groupBy("metric_key").agg(F.count("*").alias("filled"))
    known = loaded.frame(spark).select("metric_key", F.lit(True).alias("registered"))
    return counts.join(known, "metric_key", "left").select("metric_key", "filled", F.coalesce("registered", F.lit(False)).alias("registered"))


_METRICS = """SELECT 'e' || CAST(event_id AS STRING) AS row_id, CASE event_id % 5 WHEN 0 THEN '{{"rawg.ratings_count": 3, "rawg.name": "x"}}'
    WHEN 1 THEN '{{"rawg.ratings_count": "3"}}' WHEN 2 THEN '{{"rawg.ratings_count": 3.0, "hltb.time.main": true}}' WHEN 3 THEN '{{"igdb.genres": "a", "unknown.key": 1}}'
    ELSE '[1]' END AS metrics FROM {events}"""


@query(
    "envelope_violations",
    """SELECT 'e' || event_id AS row_id, CASE event_id % 5 WHEN 1 THEN 'rawg.ratings_count' WHEN 2 THEN 'hltb.time.main' WHEN 3 THEN 'igdb.genres' ELSE '' END AS metric_key,
    CASE event_id % 5 WHEN 1 THEN 'int' WHEN 2 THEN 'float' WHEN 3 THEN 'json' ELSE 'object' END AS expected,
    CASE event_id % 5 WHEN 1 THEN 'STRING' WHEN 2 THEN 'BOOLEAN' WHEN 3 THEN 'STRING' ELSE 'ARRAY<BIGINT>' END AS got FROM events WHERE event_id % 5 <> 0""",
)
def envelope_violations(spark, sf):
    rows = spark_frame(spark, sf, _METRICS).select("row_id", F.parse_json("metrics").alias("metrics"))
    return ev.violations(rows, default_registry())


@query("csv_round_trip", "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name || ' \"q\", x' AS p_name, p_brand, CASE WHEN p_size % 2 = 0 THEN 'YES' ELSE '' END AS flag FROM part")
def csv_round_trip(spark, sf):
    path = shared_dir(spark, "csv")
    df = table(spark, sf, "part").select(
        "p_partkey", F.concat("p_name", F.lit(' "q",\n x')).alias("p_name"), "p_brand", (F.col("p_size") % 2 == 0).alias("flag")
    )
    write_csv(df, path)
    return read_csv(spark, path)


@query("rendered_cells", "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus || ', b' AS tags, CASE WHEN o_orderkey % 2 = 0 THEN 'YES' ELSE '' END AS flag, '' AS hole FROM orders")
def rendered_cells(spark, sf):
    df = table(spark, sf, "orders").select(
        "o_orderkey", F.array(F.col("o_orderstatus"), F.lit(" "), F.lit("b")).alias("tags"), (F.col("o_orderkey") % 2 == 0).alias("flag"), F.lit("NaN").alias("hole")
    )
    return rendered(df)


@query("payload_store", "SELECT CAST(o_orderkey AS VARCHAR) AS id, CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE o_orderstatus END AS status, o_orderkey % 4 = 0 AS missing FROM orders")
def payload_store(spark, sf):
    """Store documents ``{"by_id": {..}}``, one per order here; a null payload is a remembered absence."""
    body = F.when(F.col("o_orderkey") % 4 != 0, F.struct(F.col("o_orderstatus").alias("status")))
    doc = F.to_json(F.struct(F.create_map(F.concat(F.lit("en:"), F.col("o_orderkey").cast("string")), body).alias("by_id")))
    out = payload_rows(table(spark, sf, "orders").select(doc.alias("value")), "igdb")
    return out.select("id", F.coalesce(F.try_variant_get("payload", "$.status", "string"), F.lit("")).alias("status"), F.col("payload").isNull().alias("missing"))
