"""Payload tables laid out by id, and sliding sums over a stream."""

from pyspark.sql import functions as F

from catalith.constants import ListLimits
from catalith.operators.extract import extract
from catalith.operators.keys import lookup, lookup_stored
from catalith.operators.overlay import sync_back
from catalith.sources.buckets import read_buckets, sync_buckets, write_buckets
from catalith.sources.registry import default_registry
from catalith.sources.tables import stored_payloads
from catalith.streaming.pins import append_output, read_stream, trailing_totals


def test_stored_payloads_do_not_move(spark):
    payloads = spark.range(500).select(F.col("id").cast("string").alias("id"), F.concat(F.lit("p"), F.col("id").cast("string")).alias("name"))
    pins = [(k, str(7) if k % 3 == 0 else None if k % 3 == 1 else str(k * 2)) for k in range(300)] + [(1000, " "), (1001, "none such")]
    left = spark.createDataFrame(pins, "row_id int, pin string")
    store = stored_payloads(payloads, 8)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = lookup_stored(left, store, "pin", "id", "row_id")
        plan = out._jdf.queryExecution().executedPlan().toString()
        payload_side = plan.split("SortMergeJoin [__asked")[1].split("Scan ExistingRDD")[-1]
        assert "Bucketed: true" in payload_side and "Exchange" not in payload_side, plan
        assert sorted(out.collect(), key=str) == sorted(lookup(left, payloads, "pin", "id", "row_id").collect(), key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_late_rows_count_in_open_windows_only(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for batch in ([("a", "2024-01-01", 1), ("a", "2024-01-10", 2)], [("a", "2024-01-02", 10), ("a", "2024-01-09", 20), ("a", "2024-01-20", 3)]):
        rows = spark.createDataFrame(batch, "k string, t string, views bigint").select("k", F.to_timestamp("t").alias("ts"), "views")
        rows.coalesce(1).write.mode("append").parquet(source)
        sums = trailing_totals(read_stream(spark, source, rows.schema), "k", "ts", "views", 3, "1 hour")
        append_output(sums.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "k", "views"), out, state).awaitTermination()
    got = {r["day"]: r["views"] for r in spark.read.parquet(out).collect()}
    # The first run closes the windows that end by 10 January less an hour: 2 January comes too late, 9 January counts where windows are open.
    assert got == {"2023-12-30": 1, "2023-12-31": 1, "2024-01-01": 1, "2024-01-07": 20, "2024-01-08": 22, "2024-01-09": 22, "2024-01-10": 2}


def test_list_limits_can_be_raised(spark):
    doc = '{"websites": [' + ", ".join(f'{{"url": "u{k}"}}' for k in range(30)) + '], "tags": {' + ", ".join(f'"t{k:02d}": {100 - k}' for k in range(70)) + "}}"
    payloads = spark.createDataFrame([("1", doc)], "id string, doc string").select("id", F.parse_json("doc").alias("payload"))
    for limits, sizes in ((ListLimits(), (5, 15, 50)), (ListLimits(websites=25, tags=40, top_tags=60), (25, 40, 60))):
        sites = extract(payloads, "igdb", default_registry(), limits).first()["IGDB_Websites"]
        spy = extract(payloads, "steamspy", default_registry(), limits).first()
        assert (len(sites), len(spy["SteamSpy_Tags"]), len(spy["SteamSpy_TagsTop"])) == sizes
        assert sites[0] == "u0" and spy["SteamSpy_Tags"][0] == "t00"


def test_sync_touches_changed_buckets_only(spark, tmp_path):
    path = str(tmp_path / "catalog")
    schema = "RowId string, Name string, Notes string, Disabled string"
    old = spark.createDataFrame([(f"r{k}", f"n{k}", "x", "") for k in range(200)], schema)
    write_buckets(old, path, 32)
    rows = {f"r{k}": (f"r{k}", f"n{k} edited", "", "") for k in range(20, 220)}
    edit = lambda: spark.createDataFrame(sorted(rows.values()), schema)
    assert sync_buckets(spark, path, edit(), 32) == list(range(32))
    want = sync_back(old, edit())
    assert sorted(read_buckets(spark, path).select(*want.columns).collect()) == sorted(want.collect())
    assert sync_buckets(spark, path, edit(), 32) == []

    files = lambda: {f: f.stat().st_mtime_ns for f in (tmp_path / "catalog" / "rows").rglob("*.parquet")}
    before = files()
    rows["r50"] = ("r50", "again", "note", "")
    del rows["r60"]
    rows["r999"] = ("r999", "new", "", "")
    changed = sync_buckets(spark, path, edit(), 32)
    assert 1 <= len(changed) <= 3
    kept = {f for f, t in files().items() if before.get(f) == t}
    assert {f.parent.name for f in before} - {f.parent.name for f in kept} == {f"__bucket={b}" for b in changed}
    after = {r["RowId"]: (r["Name"], r["Notes"], r["Disabled"]) for r in read_buckets(spark, path).collect()}
    assert after["r50"] == ("again", "note", "") and after["r60"] == ("n60 edited", "", "YES") and after["r999"] == ("new", "", "") and len(after) == 221
