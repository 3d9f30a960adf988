"""Artifacts of a run: catalogs, edited exports, provider slices, JSON documents, stored searches; written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from catalith.operators.columns import drop_deprecated, drop_diagnostics, personal_base, provider_columns, reorder, select_registered
from catalith.operators.extract import extract
from catalith.session import materialize, shared_dir
from catalith.sources import envelope as ev
from catalith.sources.registry import default_registry
from catalith.sources.tables import query_rows, read_csv, read_edited, rendered, write_csv, write_provider_csv
from catalith.workload.frames import SOURCES, duck, spark_frame, table
from catalith.workload.registry import query
from catalith.workload.schema import _wide

_NAMED = f"SELECT RowId, Name, RAWG_ID FROM {duck(SOURCES)}"


@query("catalog_from_lines", _NAMED)
def catalog_from_lines(spark, sf):
    """A catalog folder that holds validated envelope lines: they win over the CSV beside them."""
    registry, base = default_registry(), shared_dir(spark, "catalog")
    ev.write_envelope(ev.to_envelope(_wide(spark, sf), registry), f"{base}/jsonl/catalog.jsonl")
    write_csv(_wide(spark, sf).limit(0), f"{base}/catalog.csv")
    return ev.load_catalog(spark, f"{base}/catalog.csv", registry, {"personal": ["Name"], "pins": ["RAWG_ID"]}).select("RowId", "Name", "RAWG_ID")


@query("catalog_from_csv", _NAMED)
def catalog_from_csv(spark, sf):
    """A catalog folder without lines: the CSV is the catalog."""
    base = shared_dir(spark, "catalog")
    write_csv(_wide(spark, sf), f"{base}/catalog.csv")
    return ev.load_catalog(spark, f"{base}/catalog.csv", default_registry()).select("RowId", "Name", "RAWG_ID")


@query("lenient_lines", f"SELECT RowId, Name FROM {duck(SOURCES)} WHERE p_partkey % 5 > 2")
def lenient_lines(spark, sf):
    """Of envelope lines every fifth is cut, blank or a list; those are passed over."""
    path = shared_dir(spark, "lines")
    rows = spark_frame(spark, sf, SOURCES)
    line = F.to_json(F.struct(F.col("RowId").alias("row_id"), F.create_map(F.lit("Name"), F.col("Name")).alias("personal")))
    k = F.col("p_partkey") % 5
    rows.select(F.when(k == 0, F.substring(line, 1, 20)).when(k == 1, F.lit("  ")).when(k == 2, F.lit("[1]")).otherwise(F.concat(F.lit(" "), line)).alias("value")).write.text(path)
    return ev.read_envelope(spark, path).select(F.col("row_id").alias("RowId"), F.try_element_at("personal", F.lit("Name")).alias("Name"))


_BROKEN = """WITH l AS (SELECT row_number() OVER (ORDER BY p_partkey) AS line, p_partkey AS k, p_partkey % 7 AS kind FROM part)
    SELECT line::BIGINT AS line, CASE kind WHEN 0 THEN '{"row_id": "' || k ELSE '[' || k || ']' END AS value FROM l WHERE kind IN (0, 3)"""


@query("broken_lines", _BROKEN)
def broken_lines(spark, sf):
    """Broken lines of one long text by their place in it. The text lies in files in order, each written by a task of its own and read in many splits."""
    k = F.col("p_partkey")
    text = F.concat(k.cast("string"), F.lit('", "personal": {"Name": "'), F.repeat(F.lit("long "), 100), F.lit('"}}'))
    line = F.when(k % 7 == 0, F.concat(F.lit('{"row_id": "'), k.cast("string"))).when(k % 7 == 3, F.concat(F.lit("["), k.cast("string"), F.lit("]")))
    line = F.when(k % 7 == 5, F.lit("  ")).otherwise(F.coalesce(line, F.concat(F.lit('{"row_id": "'), text)))
    path, size = shared_dir(spark, "broken"), spark.conf.get("spark.sql.files.maxPartitionBytes")
    table(spark, sf, "part").select("p_partkey").orderBy("p_partkey").select(line.alias("value")).write.text(path)
    # Files are named in the order of their lines; each one's first line follows the lines of the files before it.
    files = spark.read.text(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("n"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = materialize(files.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")), "broken-files")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        found = ev.broken_lines(spark, path).join(files, "file")
        return materialize(found.select((F.col("before") + F.col("line")).alias("line"), "value"), "broken-lines")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


@query("json_array", f"SELECT p_size AS size, count(*) AS n, sum(CASE WHEN p_partkey = m THEN 0 ELSE 1 END)::BIGINT AS commas FROM part, (SELECT min(p_partkey) AS m FROM part) GROUP BY p_size")
def json_array(spark, sf):
    """One JSON document of values that repeat: its rows read back, all but the first behind a comma."""
    view = table(spark, sf, "part").orderBy("p_partkey").select(F.to_json(F.struct("p_size")).alias("value"))
    rows = ev.json_document(view).where("value not in ('[', ']')")
    size = F.get_json_object(F.regexp_replace("value", "^,", ""), "$.p_size").cast("int").alias("size")
    return rows.select(size, F.col("value").startswith(",").cast("long").alias("comma")).groupBy("size").agg(F.count("*").alias("n"), F.sum("comma").alias("commas"))


@query("edited_export", f"SELECT RowId, Name, CAST(RAWG_RatingsCount AS VARCHAR) AS votes FROM {duck(SOURCES)}")
def edited_export(spark, sf):
    """An export as JSON lines, read as an editor's copy: every cell is text."""
    registry, path = default_registry(), shared_dir(spark, "edited") + ".jsonl"
    manifest = ev.manifest_of(["RowId", "Name", "RAWG_RatingsCount"], registry)
    ev.write_json_lines(ev.export_json_view(ev.to_envelope(_wide(spark, sf), registry), manifest, registry), path)
    return read_edited(spark, path).select("RowId", "Name", F.col("RAWG_RatingsCount").alias("votes"))


@query("manifest_export", f"SELECT Name, RowId, CAST(RAWG_RatingsCount AS VARCHAR) AS RAWG_RatingsCount FROM {duck(SOURCES)}")
def manifest_export(spark, sf):
    """Cells by a manifest that was written and read again."""
    registry, path = default_registry(), shared_dir(spark, "manifest")
    ev.write_manifest(spark, ev.manifest_of(["Name", "RowId", "RAWG_RatingsCount"], registry), path)
    return ev.export_csv_view(ev.to_envelope(_wide(spark, sf), registry), ev.read_manifest(spark, path), registry)


@query(
    "stored_searches",
    "SELECT CAST(o_orderkey AS VARCHAR) AS query, CAST(pos AS INT) AS pos, CASE WHEN pos IS NULL THEN '' ELSE o_orderstatus || pos END AS hit "
    "FROM (SELECT *, unnest(CASE o_orderkey % 3 WHEN 0 THEN [NULL] WHEN 1 THEN [0] ELSE [0, 1] END) AS pos FROM orders)",
)
def stored_searches(spark, sf):
    """Stores ``{"by_query": {..}}``, one per order; a search without hits is remembered."""
    hit = lambda k: F.struct(F.concat("o_orderstatus", F.lit(k)).alias("name"))
    hits = F.slice(F.array(hit("0"), hit("1")), 1, (F.col("o_orderkey") % 3).cast("int"))
    doc = F.to_json(F.struct(F.create_map(F.col("o_orderkey").cast("string"), hits).alias("by_query")))
    out = query_rows(table(spark, sf, "orders").select(doc.alias("value")), "igdb")
    return out.select("query", "pos", F.coalesce(F.try_variant_get("hit", "$.name", "string"), F.lit("")).alias("hit"))


@query("provider_slice", f"SELECT RowId, Name, RAWG_ID, CAST(RAWG_RatingsCount AS VARCHAR) AS RAWG_RatingsCount, Steam_Name FROM {duck(SOURCES)}")
def provider_slice(spark, sf):
    """One provider's columns and an extra, as CSV and back."""
    path = shared_dir(spark, "slice")
    write_provider_csv(_wide(spark, sf), path, "rawg", ("Steam_Name",))
    return read_csv(spark, path)


@query("provider_export", f"SELECT RowId, Name, CAST(RAWG_RatingsCount AS VARCHAR) AS votes FROM {duck(SOURCES)}")
def provider_export(spark, sf):
    """Export of one provider without a manifest: only its columns that hold a value anywhere."""
    registry = default_registry()
    view = ev.provider_view(ev.to_envelope(_wide(spark, sf), registry), "rawg", registry)
    wrong = sorted(c for c in view.columns if c not in ("RowId", "Name") and not c.startswith("RAWG_"))
    assert not wrong, wrong
    return view.select("RowId", "Name", F.col("RAWG_RatingsCount").alias("votes"))


@query(
    "column_steps",
    f"""SELECT RowId, 'RowId,Name,RAWG_ID,Notes' AS base, 'RowId,Name,RAWG_ID,RAWG_RatingsCount' AS slice, Name || '/' || RAWG_ID AS front,
    'RowId,Name,RAWG_ID,Notes,RAWG_RatingsCount' AS selected FROM {duck(SOURCES)}""",
)
def column_steps(spark, sf):
    """Schema steps on every row: what each keeps, as a list of names beside the values."""
    registry = default_registry()
    wide = _wide(spark, sf).select("RAWG_RatingsCount", "RAWG_ID", "Name", "RowId").withColumns({"Notes": F.lit("n"), "RAWG_Unregistered": F.lit("x"), "ReviewTags": F.lit("t")})
    diagnostics = {"ReviewTags"}
    base = reorder(personal_base(drop_deprecated(wide), diagnostics), registry)
    chosen = reorder(select_registered(drop_diagnostics(wide, diagnostics), registry), registry)
    slice_ = provider_columns([c for c in reorder(wide, registry).columns if c != "RAWG_Unregistered"], "RAWG_")
    names = lambda c: F.lit(",".join(c))
    front = F.concat_ws("/", *base.columns[1:3])
    return base.select("RowId", names(base.columns).alias("base"), names(slice_).alias("slice"), front.alias("front"), names(chosen.columns).alias("selected"))


_PAIRS = "CASE WHEN p_size >= 25 THEN '[[\"Fast \\\\\"1\\\\\"\",' || p_size || '],[\"Old\",25]]' ELSE '[[\"Old\",25],[\"Fast \\\\\"1\\\\\"\",' || p_size || ']]' END"


@query(
    "exported_tag_counts",
    f"""SELECT CAST(p_partkey AS VARCHAR) AS id, replace({_PAIRS}, repeat(chr(92), 2), chr(92)) AS exported, replace({_PAIRS}, repeat(chr(92), 2), chr(92)) AS cell,
    CASE WHEN p_size >= 25 THEN 'Fast "1"' ELSE 'Old' END AS first, greatest(p_size, 25)::BIGINT AS most FROM part""",
)
def exported_tag_counts(spark, sf):
    """Tags by count: pairs in the JSON export and in CSV cells, and typed again when read back."""
    registry = default_registry()
    tags = F.create_map(F.lit("Old"), F.lit(25), F.lit('Fast "1"'), F.col("p_size"))
    payloads = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("id"), F.parse_json(F.to_json(F.struct(tags.alias("tags")))).alias("payload"))
    wide = materialize(extract(payloads, "steamspy", registry).select(F.col("id").alias("RowId"), "SteamSpy_TagsTop"), "tags")
    envelope = ev.to_envelope(wide, registry)
    json_view = ev.export_json_view(envelope, ev.manifest_of(["RowId", "SteamSpy_TagsTop"], registry), registry)
    exported = json_view.select(F.get_json_object("value", "$.RowId").alias("id"), F.get_json_object("value", "$.SteamSpy_TagsTop").alias("exported"))
    cells = rendered(wide).select(F.col("RowId").alias("id"), F.col("SteamSpy_TagsTop").alias("cell"))
    back = ev.registered_view(envelope, registry, ["steamspy.popularity.tags_top"])
    typed = back.select(F.col("RowId").alias("id"), F.col("SteamSpy_TagsTop")[0]["tag"].alias("first"), F.col("SteamSpy_TagsTop")[0]["count"].alias("most"))
    return exported.join(cells, "id").join(typed, "id")
