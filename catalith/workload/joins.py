"""Overlay, carry, sync and crosswalk joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalith.operators.columns import (
    active_rows,
    clear_when_not_found,
    derived_year_hint,
    fallback_titles,
    fill_year_hint,
    is_processed,
)
from catalith.operators.crosswalk import infer_store_ids, linked_labels, resolve_by_ids, store_id_from_external
from catalith.operators.keys import duplicate_ids, ensure_row_ids, keep_ids, last_per_key, lookup, lookup_stored, missing_rows
from catalith.operators.overlay import carry_columns, overlay_providers, sync_back, sync_envelope, with_recomputed
from catalith.plans.imports import carry_by_occurrence, match_queries
from catalith.session import shared_dir
from catalith.sources.buckets import read_buckets, sync_buckets, write_buckets
from catalith.sources.tables import identity_overrides, stored_payloads, work_list
from catalith.workload.frames import SOURCES, duck, spark_frame, table
from catalith.workload.registry import query

_CATALOG = "SELECT 'c' || CAST(c_custkey AS STRING) AS RowId, c_name AS Name, CASE WHEN c_custkey % 2 = 0 THEN 'old' ELSE '' END AS RAWG_Name, c_mktsegment AS Notes FROM {customer}"
_RAWG = "SELECT 'c' || CAST(o_custkey AS STRING) AS RowId, CASE WHEN count(*) % 2 = 0 THEN '' ELSE 'n' || CAST(count(*) AS STRING) END AS RAWG_Name, count(*) AS RAWG_Added, 'x' AS Other FROM {orders} GROUP BY o_custkey"
_STEAM = "SELECT 'c' || CAST(user_id AS STRING) AS RowId, max(event_type) AS Steam_Name, count(*) AS Steam_ReviewCount FROM {events} GROUP BY user_id"


@query(
    "overlay_providers",
    f"""SELECT c.RowId, c.Name, coalesce(nullif(r.RAWG_Name, ''), c.RAWG_Name) AS RAWG_Name, c.Notes, coalesce(RAWG_Added, -1) AS RAWG_Added,
    coalesce(Steam_Name, '') AS Steam_Name, coalesce(Steam_ReviewCount, -1) AS Steam_ReviewCount
    FROM {duck(_CATALOG)} c LEFT JOIN {duck(_RAWG)} r ON r.RowId = c.RowId LEFT JOIN {duck(_STEAM)} s ON s.RowId = c.RowId""",
)
def overlaid(spark, sf):
    frames = {"rawg": spark_frame(spark, sf, _RAWG), "steam": spark_frame(spark, sf, _STEAM)}
    out = overlay_providers(spark_frame(spark, sf, _CATALOG), frames)
    none = F.lit(-1).cast("bigint")
    return out.withColumns(
        {
            "RAWG_Added": F.coalesce("RAWG_Added", none), "Steam_Name": F.coalesce("Steam_Name", F.lit("")),
            "Steam_ReviewCount": F.coalesce("Steam_ReviewCount", none),
        }
    )


_REUSED = "SELECT 'c' || CAST(c_custkey AS STRING) AS RowId, c_name AS RAWG_Name FROM {customer} WHERE c_nationkey < 15"
_FRESH = "SELECT 'c' || CAST(c_custkey AS STRING) AS RowId, CASE WHEN c_nationkey = 12 THEN '' ELSE c_mktsegment END AS RAWG_Name FROM {customer} WHERE c_nationkey > 10"


@query(
    "recompute_overlay",
    f"SELECT coalesce(a.RowId, b.RowId) AS RowId, coalesce(nullif(b.RAWG_Name, ''), a.RAWG_Name, '') AS RAWG_Name FROM {duck(_REUSED)} a FULL JOIN {duck(_FRESH)} b ON a.RowId = b.RowId",
)
def recompute_overlay(spark, sf):
    out = with_recomputed(spark_frame(spark, sf, _REUSED), spark_frame(spark, sf, _FRESH))
    return out.select("RowId", F.coalesce("RAWG_Name", F.lit("")).alias("RAWG_Name"))


@query(
    "missing_rows",
    f"SELECT c.RowId, c.Name FROM {duck(_CATALOG)} c WHERE NOT EXISTS (SELECT 1 FROM {duck(_STEAM)} r WHERE r.RowId = c.RowId)",
)
def rows_to_compute(spark, sf):
    return missing_rows(spark_frame(spark, sf, _CATALOG), spark_frame(spark, sf, _STEAM)).select("RowId", "Name")


@query(
    "kept_ids",
    f"SELECT c.RowId, c.Name FROM {duck(_CATALOG)} c WHERE c.RowId IN (SELECT RowId FROM {duck(_STEAM)})",
)
def kept_ids(spark, sf):
    return keep_ids(spark_frame(spark, sf, _CATALOG), spark_frame(spark, sf, _STEAM)).select("RowId", "Name")


_EARLIER = "SELECT 'c' || CAST(c_custkey AS STRING) AS RowId, CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE ' ' END AS Notes FROM {customer} WHERE c_nationkey < 20"


@query(
    "resume_carry",
    f"SELECT c.RowId, c.Name, c.RAWG_Name, CASE WHEN trim(coalesce(e.Notes, '')) <> '' THEN e.Notes ELSE c.Notes END AS Notes FROM {duck(_CATALOG)} c LEFT JOIN {duck(_EARLIER)} e ON e.RowId = c.RowId",
)
def resume_carry(spark, sf):
    return carry_columns(spark_frame(spark, sf, _CATALOG), spark_frame(spark, sf, _EARLIER), ["Notes", "Absent"])


_NOW = "SELECT p_partkey AS ord, p_name AS Name, CASE WHEN p_size % 4 = 0 THEN 'pin' ELSE '' END AS RAWG_ID FROM {part}"
_BEFORE = "SELECT CAST(p_size AS BIGINT) * 1000000000000 + p_partkey AS ord, p_name AS Name, 'rid:' || CAST(p_partkey AS STRING) AS RowId, p_brand AS RAWG_ID FROM {part}"


@query(
    "occurrence_carry",
    f"""WITH a AS (SELECT *, row_number() OVER (PARTITION BY Name ORDER BY ord) AS k FROM {duck(_NOW)}),
    b AS (SELECT *, row_number() OVER (PARTITION BY Name ORDER BY ord) AS k FROM {duck(_BEFORE)})
    SELECT a.ord, a.Name, coalesce(CASE WHEN a.RAWG_ID <> '' THEN a.RAWG_ID ELSE b.RAWG_ID END, '') AS RAWG_ID, coalesce(b.RowId, '') AS RowId
    FROM a LEFT JOIN b ON a.Name = b.Name AND a.k = b.k""",
)
def occurrence_carry(spark, sf):
    """A fresh list meets the catalog of an earlier run, which is in another order: n-th row of a name to n-th row."""
    out = carry_by_occurrence(spark_frame(spark, sf, _NOW), spark_frame(spark, sf, _BEFORE), "ord")
    return out.select("ord", "Name", F.coalesce("RAWG_ID", F.lit("")).alias("RAWG_ID"), F.coalesce("RowId", F.lit("")).alias("RowId"))


_IDS = "SELECT o_orderkey AS ord, o_orderpriority AS Name, CASE WHEN o_orderkey % 3 = 0 THEN ' ' ELSE 'r' || CAST(o_custkey AS STRING) END AS RowId FROM {orders}"


@query(
    "row_ids",
    f"""SELECT ord, Name, CASE WHEN k = 1 AND rid <> '' THEN rid ELSE 'rid:' || substr(sha256(Name || '|' || CAST(ord AS VARCHAR)), 1, 32) END AS RowId,
    NOT (k = 1 AND rid <> '') AS fresh FROM (SELECT ord, Name, trim(RowId) AS rid, row_number() OVER (PARTITION BY trim(RowId) ORDER BY ord) AS k FROM {duck(_IDS)})""",
)
def row_ids(spark, sf):
    return ensure_row_ids(spark_frame(spark, sf, _IDS), "ord").withColumnRenamed("__new_id", "fresh")


@query("duplicate_ids", f"SELECT trim(RowId) AS RowId, count(*) AS n FROM {duck(_IDS)} GROUP BY trim(RowId) HAVING count(*) > 1")
def repeated_ids(spark, sf):
    return duplicate_ids(spark_frame(spark, sf, _IDS))


@query(
    "latest_rows",
    f"SELECT trim(RowId) AS RowId, max(ord) AS ord, arg_max(Name, ord) AS Name FROM {duck(_IDS)} WHERE trim(RowId) <> '' GROUP BY trim(RowId)",
)
def latest_rows(spark, sf):
    return last_per_key(spark_frame(spark, sf, _IDS), "RowId", "ord").select("RowId", "ord", "Name")


_PINNED = "SELECT l_orderkey * 10 + l_linenumber AS row_id, CASE WHEN l_returnflag = 'R' THEN '' WHEN l_returnflag = 'A' THEN '7' ELSE CAST(l_partkey AS STRING) END AS pin, l_suppkey FROM {lineitem}"
_PAYLOADS = "SELECT CAST(p_partkey AS STRING) AS id, p_name, p_brand FROM {part}"


@query(
    "payload_lookup",
    f"SELECT row_id, pin, l_suppkey, coalesce(p_name, '') AS p_name, coalesce(p_brand, '') AS p_brand FROM {duck(_PINNED)} LEFT JOIN {duck(_PAYLOADS)} ON pin = id",
)
def payload_lookup(spark, sf):
    """A third of the rows has no pin and another third shares one: neither meets in one task."""
    out = lookup(spark_frame(spark, sf, _PINNED), spark_frame(spark, sf, _PAYLOADS), "pin", "id", "row_id")
    return out.select("row_id", "pin", "l_suppkey", F.coalesce("p_name", F.lit("")).alias("p_name"), F.coalesce("p_brand", F.lit("")).alias("p_brand"))


@query(
    "stored_payload_lookup",
    f"SELECT row_id, pin, l_suppkey, coalesce(p_name, '') AS p_name, coalesce(p_brand, '') AS p_brand FROM {duck(_PINNED)} LEFT JOIN {duck(_PAYLOADS)} ON pin = id",
)
def stored_payload_lookup(spark, sf):
    """The same pins looked up in a payload table that is laid out by id and does not move."""
    store = stored_payloads(spark_frame(spark, sf, _PAYLOADS), 16)
    out = lookup_stored(spark_frame(spark, sf, _PINNED), store, "pin", "id", "row_id")
    return out.select("row_id", "pin", "l_suppkey", F.coalesce("p_name", F.lit("")).alias("p_name"), F.coalesce("p_brand", F.lit("")).alias("p_brand"))


_OLD = "SELECT 's' || CAST(s_suppkey AS STRING) AS RowId, s_name AS Name, '' AS Disabled, 'n' || CAST(s_nationkey AS STRING) AS Notes, CAST(s_suppkey AS STRING) AS RAWG_ID, 'tags' AS ReviewTags FROM {supplier}"
_EDIT = """SELECT 's' || CAST(s_suppkey + 20 AS STRING) AS RowId, s_name || ' edited' AS Name, '' AS Disabled, CASE WHEN s_suppkey % 2 = 0 THEN '' ELSE 'kept' END AS Notes,
    CAST(s_suppkey AS STRING) AS RAWG_ID, 'p' AS Steam_Name, '9' AS Reach_Composite, CAST(s_acctbal AS STRING) AS MyRating FROM {supplier}"""
_EDIT_SQL = _EDIT.replace("CAST(s_acctbal AS STRING)", "CAST(s_nationkey AS STRING)")


@query(
    "sync_catalog",
    f"""SELECT coalesce(o.RowId, e.RowId) AS RowId, coalesce(e.Name, o.Name) AS Name, CASE WHEN e.RowId IS NULL THEN 'YES' ELSE e.Disabled END AS Disabled,
    CASE WHEN e.RowId IS NULL THEN o.Notes ELSE e.Notes END AS Notes, CASE WHEN e.RowId IS NULL THEN o.RAWG_ID ELSE e.RAWG_ID END AS RAWG_ID,
    coalesce(e.MyRating, '') AS MyRating FROM {duck(_OLD)} o FULL JOIN {duck(_EDIT_SQL)} e ON e.RowId = o.RowId""",
)
def sync_catalog(spark, sf):
    return sync_back(spark_frame(spark, sf, _OLD), spark_frame(spark, sf, _EDIT_SQL), "disable", {"ReviewTags"}, {"Reach_Composite"})


_TWICE = "CASE WHEN s_suppkey % 50 = 0 THEN ' twice' ELSE '' END"


@query(
    "sync_by_change",
    f"""SELECT coalesce(o.RowId, e.RowId) AS RowId, CASE WHEN e.RowId IS NULL THEN o.Name ELSE e.Name || more END AS Name, CASE WHEN e.RowId IS NULL THEN 'YES' ELSE e.Disabled END AS Disabled,
    CASE WHEN e.RowId IS NULL THEN o.Notes ELSE e.Notes END AS Notes, CASE WHEN e.RowId IS NULL THEN o.RAWG_ID ELSE e.RAWG_ID END AS RAWG_ID,
    coalesce(e.MyRating, '') AS MyRating FROM {duck(_OLD)} o FULL JOIN
    (SELECT x.*, {_TWICE} AS more FROM {duck(_EDIT_SQL)} x JOIN supplier ON x.RowId = 's' || (s_suppkey + 20)) e ON e.RowId = o.RowId""",
)
def sync_by_change(spark, sf):
    """Two edits of a catalog in buckets, of which the second differs in a few rows: only their buckets are read and written."""
    path = shared_dir(spark, "buckets")
    write_buckets(spark_frame(spark, sf, _OLD), path, 64)
    first = spark_frame(spark, sf, _EDIT_SQL)
    again = F.when((F.substring("RowId", 2, 20).cast("int") - 20) % 50 == 0, F.concat("Name", F.lit(" twice"))).otherwise(F.col("Name"))
    sync_buckets(spark, path, first, 64, {"ReviewTags"}, {"Reach_Composite"})
    sync_buckets(spark, path, first.withColumn("Name", again), 64, {"ReviewTags"}, {"Reach_Composite"})
    return read_buckets(spark, path).select("RowId", "Name", "Disabled", "Notes", "RAWG_ID", "MyRating")


@query(
    "sync_envelope",
    f"""SELECT e.RowId AS row_id, e.Name AS name, e.Notes AS notes, e.RAWG_ID AS rawg_id, coalesce(o.Name, '') AS old_metric, coalesce(o.Notes, '') AS untouched
    FROM {duck(_EDIT_SQL)} e LEFT JOIN {duck(_OLD)} o ON o.RowId = e.RowId""",
)
def synced_envelope(spark, sf):
    old = spark_frame(spark, sf, _OLD).select(
        F.col("RowId").alias("row_id"),
        F.create_map(F.lit("Name"), F.col("Name"), F.lit("Notes"), F.col("Notes"), F.lit("Mood"), F.col("Notes")).alias("personal"),
        F.create_map(F.lit("RAWG_ID"), F.col("RAWG_ID")).alias("pins"),
        F.col("Name").alias("metrics"),
    )
    out = sync_envelope(old, spark_frame(spark, sf, _EDIT_SQL).drop("Reach_Composite"))

    def value(m, k):
        return F.coalesce(F.try_element_at(m, F.lit(k)), F.lit(""))

    return out.select(
        "row_id", value("personal", "Name").alias("name"), value("personal", "Notes").alias("notes"), value("pins", "RAWG_ID").alias("rawg_id"),
        F.coalesce("metrics", F.lit("")).alias("old_metric"), value("personal", "Mood").alias("untouched"),
    )


_EDGES = "SELECT 'Q' || CAST(l_orderkey AS STRING) AS qid, CASE l_returnflag WHEN 'R' THEN 'P178' WHEN 'A' THEN 'P123' ELSE 'P136' END AS prop, 'Q' || CAST(l_suppkey AS STRING) AS target FROM {lineitem}"
_LABELS = "SELECT 'Q' || CAST(s_suppkey AS STRING) AS qid, CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE s_name END AS label, CASE WHEN s_suppkey % 2 = 0 THEN 'Site_of_' || CAST(s_suppkey AS STRING) ELSE '' END AS site_title FROM {supplier}"
_NAMED = f"""(SELECT DISTINCT e.qid, prop, coalesce(nullif(label, ''), nullif(replace(site_title, '_', ' '), ''), '__NOT_FOUND__') AS name
    FROM {duck(_EDGES)} e JOIN {duck(_LABELS)} l ON l.qid = e.target)"""


@query(
    "linked_labels",
    f"""SELECT qid, coalesce(string_agg(CASE WHEN prop = 'P178' THEN name END, '|' ORDER BY name), '') AS developers,
    coalesce(string_agg(CASE WHEN prop = 'P123' THEN name END, '|' ORDER BY name), '') AS publishers,
    coalesce(string_agg(CASE WHEN prop = 'P136' THEN name END, '|' ORDER BY name), '') AS genres FROM {_NAMED} GROUP BY qid""",
)
def labels_of_links(spark, sf):
    out = linked_labels(spark_frame(spark, sf, _EDGES), spark_frame(spark, sf, _LABELS))
    return out.select("qid", *[F.array_join(c, "|").alias(c) for c in ("developers", "publishers", "genres")])


_ASKED = "SELECT o_orderkey AS row_id, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE CAST(o_custkey AS STRING) END AS store_id, CAST(o_custkey + 1 AS STRING) AS game_db_id FROM {orders}"
_CLAIMS = """SELECT 'Q' || CAST(c_custkey AS STRING) AS qid, 'P1733' AS prop, CAST(c_custkey AS STRING) AS value FROM {customer} WHERE c_nationkey < 12
    UNION ALL SELECT 'Q9' || CAST(c_custkey AS STRING), 'P5794', CAST(c_custkey AS STRING) FROM {customer}
    UNION ALL SELECT 'Q8' || CAST(c_custkey AS STRING), 'P5794', CAST(c_custkey AS STRING) FROM {customer} WHERE c_nationkey > 20"""
_ENTITIES = "SELECT 'Q' || CAST(c_custkey AS STRING) AS qid FROM {customer} UNION ALL SELECT 'Q9' || CAST(c_custkey AS STRING) FROM {customer} WHERE c_nationkey <> 5"


@query(
    "entity_crosswalk",
    f"""WITH k AS (SELECT prop, value, min(qid) AS qid FROM {duck(_CLAIMS)} WHERE qid IN (SELECT qid FROM {duck(_ENTITIES)}) GROUP BY prop, value)
    SELECT row_id, coalesce(a.qid, b.qid) AS qid FROM {duck(_ASKED)} r LEFT JOIN k a ON a.prop = 'P1733' AND a.value = store_id AND store_id <> ''
    LEFT JOIN k b ON b.prop = 'P5794' AND b.value = game_db_id WHERE coalesce(a.qid, b.qid) IS NOT NULL""",
)
def entity_crosswalk(spark, sf):
    return resolve_by_ids(spark_frame(spark, sf, _ASKED), spark_frame(spark, sf, _CLAIMS), spark_frame(spark, sf, _ENTITIES))


_DETAILS = "SELECT CAST(p_partkey AS STRING) AS id, p_name AS d_name, CASE p_type WHEN 'PROMO' THEN 'dlc' WHEN 'LARGE' THEN '' ELSE 'Game' END AS d_type, '' AS d_date FROM {part}"
_EXTERNAL = "SELECT l_orderkey * 10 + l_linenumber AS row_id, l_partkey, CASE l_returnflag WHEN 'R' THEN '1' ELSE '5' END AS src, CASE l_linestatus WHEN 'F' THEN 'Steam' ELSE 'gog' END AS cat FROM {lineitem}"


@query(
    "store_inference",
    f"""SELECT row_id, id, d_name FROM (SELECT row_id, CASE WHEN src = '1' OR cat = 'Steam' THEN CAST(l_partkey AS VARCHAR) ELSE '' END AS ext FROM {duck(_EXTERNAL)})
    JOIN {duck(_DETAILS)} ON id = ext WHERE lower(d_type) IN ('', 'game')""",
)
def store_inference(spark, sf):
    listed = F.array(F.struct(F.col("src").alias("external_game_source"), F.col("l_partkey").cast("string").alias("uid"), F.col("cat").alias("category")))
    rows = spark_frame(spark, sf, _EXTERNAL).withColumn("ext", store_id_from_external(listed))
    return infer_store_ids(rows, "ext", spark_frame(spark, sf, _DETAILS)).select("row_id", "id", "d_name")


@query(
    "active_titles",
    f"SELECT RowId, Name FROM {duck(SOURCES)} WHERE trim(Name) <> '' AND upper(trim(Disabled)) NOT IN ('YES', 'Y', 'TRUE', '1')",
)
def active_titles(spark, sf):
    return active_rows(spark_frame(spark, sf, SOURCES)).select("RowId", "Name")


@query(
    "cleared_pins",
    f"""SELECT RowId, CASE WHEN gone THEN '' ELSE RAWG_ID END AS RAWG_ID, CASE WHEN gone THEN '' ELSE RAWG_Name END AS RAWG_Name,
    CASE WHEN gone THEN -1 ELSE RAWG_RatingsCount END AS RAWG_RatingsCount, IGDB_Name, NOT gone AND trim(RAWG_ID) <> '' AND trim(RAWG_Name) <> '' AS done
    FROM (SELECT *, RAWG_ID = '__NOT_FOUND__' AS gone FROM {duck(SOURCES)})""",
)
def cleared_pins(spark, sf):
    out = clear_when_not_found(spark_frame(spark, sf, SOURCES), "RAWG_ID", "RAWG_")
    blank = F.lit("")
    return out.select(
        "RowId", F.coalesce("RAWG_ID", blank).alias("RAWG_ID"), F.coalesce("RAWG_Name", blank).alias("RAWG_Name"),
        F.coalesce("RAWG_RatingsCount", F.lit(-1).cast("bigint")).alias("RAWG_RatingsCount"), "IGDB_Name",
        is_processed(out, ["RAWG_ID", "RAWG_Name"]).alias("done"),
    )


_HINTED = SOURCES.replace("SELECT 'rid:'", "SELECT CASE WHEN p_size % 10 = 0 THEN '1999' ELSE '' END AS YearHint, 'rid:'", 1)
_INFERRED = "regexp_extract(Name, '(?:^|[\\s(])(19\\d\\d|20\\d\\d)(?:$|[\\s)])', 1)"


@query(
    "year_hint_fill",
    f"SELECT RowId, Name, CASE WHEN YearHint <> '' OR Disabled = 'YES' THEN YearHint ELSE {_INFERRED} END AS YearHint FROM {duck(_HINTED)}",
)
def year_hint_fill(spark, sf):
    return fill_year_hint(spark_frame(spark, sf, _HINTED)).select("RowId", "Name", "YearHint")


@query(
    "search_work",
    f"""SELECT RowId AS row_id, Name AS name, coalesce(CAST(nullif(YearHint, '') AS INT), CAST(nullif({_INFERRED}, '') AS INT), 0) AS year_hint
    FROM {duck(_HINTED)} WHERE Disabled <> 'YES' AND Steam_AppID = '' AND Platform <> 'PlayStation'""",
)
def search_work(spark, sf):
    out = match_queries(spark_frame(spark, sf, _HINTED), "Steam_AppID", True)
    return out.withColumn("year_hint", F.coalesce("year_hint", F.lit(0)))


@query(
    "known_missing",
    f"SELECT DISTINCT pin FROM {duck(_PINNED)} WHERE pin <> '' AND pin NOT IN (SELECT CAST(o_custkey AS VARCHAR) FROM orders)",
)
def known_missing(spark, sf):
    """Ids still to look up; facts, empty answers included, are the customers with orders."""
    facts = table(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("pin"))
    return work_list(spark_frame(spark, sf, _PINNED), facts, "pin")


@query(
    "identity_overrides",
    f"SELECT RowId, trim(RAWG_ID) AS RAWG_ID, trim(IGDB_ID) AS IGDB_ID, trim(Steam_AppID) AS Steam_AppID, trim(HLTB_ID) AS HLTB_ID, '' AS HLTB_Query, '' AS Wikidata_QID FROM {duck(SOURCES)}",
)
def overrides(spark, sf):
    return identity_overrides(spark_frame(spark, sf, SOURCES))


@query(
    "fallback_titles",
    f"""SELECT RowId, coalesce(CASE WHEN p_size % 10 = 0 THEN 1999 END, RAWG_Year, IGDB_Year, Steam_ReleaseYear) AS year,
    CASE WHEN Steam_Name = '' THEN '' ELSE Steam_Name END || CASE WHEN RAWG_Name = '' OR RAWG_Name = Steam_Name THEN '' ELSE
        CASE WHEN Steam_Name = '' THEN '' ELSE '|' END || RAWG_Name END || CASE WHEN IGDB_Name = '' OR IGDB_Name IN (Steam_Name, RAWG_Name) THEN '' ELSE
        CASE WHEN Steam_Name = '' AND RAWG_Name = '' THEN '' ELSE '|' END || IGDB_Name END AS titles FROM {duck(SOURCES)}""",
)
def titles_to_try(spark, sf):
    hint = F.when(F.col("p_size") % 10 == 0, "1999").otherwise("")
    return spark_frame(spark, sf, SOURCES).select(
        "RowId", derived_year_hint(hint, F.col("RAWG_Year"), F.col("IGDB_Year"), F.col("Steam_ReleaseYear")).alias("year"),
        F.array_join(fallback_titles(F.col("Steam_Name"), F.col("RAWG_Name"), F.col("IGDB_Name")), "|").alias("titles"),
    )
