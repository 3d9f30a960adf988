"""Cases that earlier rounds got wrong."""

import json

import pytest

from pyspark.sql import functions as F

from catalith.functions.company import normalize_company
from catalith.operators.columns import auto_metric_key
from catalith.operators.consensus import provider_consensus
from catalith.operators.keys import ensure_row_ids
from catalith.operators.profile import path_types
from catalith.operators.series import launch_sums, trailing_sums
from catalith.operators.tiers import collect_tiers
from catalith.sources import envelope as ev
from catalith.sources.envelope import json_document
from catalith.sources.registry import default_registry


def test_any_number_of_legal_suffixes(spark):
    names = {"Foo Co., Ltd., Inc., LLC, GmbH": "Foo", "Bar Inc.": "Bar", "Inc": "Inc", "Baz, Ltd. (EU)": "Baz", "Qux LLC ,": "Qux", "Costco": "Costco"}
    rows = spark.createDataFrame([(n,) for n in names], "n string").select("n", normalize_company(F.col("n")).alias("r"))
    assert {r["n"]: r["r"] for r in rows.collect()} == names


def test_moved_rows_keep_ids_apart(spark):
    made = ensure_row_ids(spark.createDataFrame([(5, "Doom", "")], "ord int, Name string, RowId string"), "ord").first()["RowId"]
    rows = [(5, "Doom", ""), (9, "Doom", made), (10, "Doom", made), (11, "Quake", None)]
    out = ensure_row_ids(spark.createDataFrame(rows, "ord int, Name string, RowId string"), "ord").collect()
    ids = {r["ord"]: r["RowId"] for r in out}
    assert len(set(ids.values())) == 4 and ids[9] == made and {r["ord"] for r in out if r["__new_id"]} == {5, 10, 11}
    salted = ensure_row_ids(spark.createDataFrame(rows[:1], "ord int, Name string, RowId string"), "ord", salt="run 2").first()["RowId"]
    assert salted != made


def test_json_document_keeps_equal_rows_and_order(spark):
    values = ['{"a":2}', '{"a":1}', '{"a":1}', '{"b":0}']
    view = spark.createDataFrame([(v,) for v in values], "value string").coalesce(1)
    assert json.loads("\n".join(r["value"] for r in json_document(view).collect())) == [json.loads(v) for v in values]
    assert json.loads("".join(r["value"] for r in json_document(view.limit(0)).collect())) == []


def test_paths_at_any_depth(spark):
    doc = '{"a":' * 12 + "[1]" + "}" * 12
    docs = spark.createDataFrame([(doc,), (None,)], "t string").select(F.parse_json("t").alias("payload"))
    paths = {r["path"] for r in path_types(docs).collect()}
    assert ".".join("a" * 12) in paths and ".".join("a" * 12) + "[]" in paths and len(paths) == 14


def test_windows_without_days_are_zero(spark):
    series = spark.createDataFrame([("a", "2024-01-30", 5), ("b", "2020-01-01", 7)], "k string, d string, views bigint").select("k", F.to_date("d").alias("day"), "views")
    end = F.lit("2024-01-31").cast("date")
    got = {r["k"]: tuple(r)[1:] for r in trailing_sums(series, "k", end, keys=series.select("k").union(spark.createDataFrame([("c",)], "k string"))).collect()}
    assert got == {"a": (5, 5, 5), "b": (0, 0, 0), "c": (0, 0, 0)}
    releases = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-01"), ("z", "2030-01-01")], "k string, d string").select("k", F.to_date("d").alias("release"))
    assert {r["k"]: tuple(r)[1:] for r in launch_sums(series, releases, "k", end).collect()} == {"a": (5, 5), "b": (0, 0)}


def test_consensus_over_long_chains(spark):
    """Seven sources whose years differ by one each: only neighbours agree, and all are one component."""
    names = [f"p{i}" for i in range(7)]
    row = spark.createDataFrame([("Doom",) * 7 + tuple(range(2000, 2007))], ", ".join([f"t{i} string" for i in range(7)] + [f"y{i} int" for i in range(7)]))
    out = provider_consensus(row, {n: f"t{i}" for i, n in enumerate(names)}, {n: f"y{i}" for i, n in enumerate(names)}, yearless=())
    assert sorted(out.first()["consensus"]["majority"]) == names


def test_metric_keys_of_unregistered_columns():
    cases = {
        "RAWG_Added": "rawg.added", "SteamSpy_Score100": "steamspy.score_100", "Steam_X": "steam.x", "HLTB_MainExtra2Go": "hltb.main_extra_2_go", "": "derived.unknown",
        "IGDB_": "igdb.value", "Reach Composite-ABCDef": "derived.reach_composite_abcdef", "Wikidata_Größe": "wikidata.grösse", "a__b": "derived.a_b",
    }
    assert {c: auto_metric_key(c) for c in cases} == cases


def test_line_numbers_over_many_splits(spark, tmp_path):
    good = '{"row_id": "r", "personal": {"Name": "' + "x" * 300 + '"}}'
    names = {"a.jsonl": {3, 700, 2000}, "b.jsonl": {1}, "c.jsonl": set()}
    for name, bad in names.items():
        lines = [("[1]" if k % 2 else "not json") if k in bad else "" if k % 11 == 0 else good for k in range(1, 2001)]
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        rows = ev.broken_lines(spark, str(tmp_path)).collect()
        assert {(r["file"].rsplit("/", 1)[1], r["line"]) for r in rows} == {(n, k) for n, bad in names.items() for k in bad}
        with pytest.raises(ValueError, match=r"line 3 in .*a.jsonl: \[1\]"):
            ev.read_envelope_strict(spark, str(tmp_path))
        assert ev.read_envelope_strict(spark, str(tmp_path / "c.jsonl")).count() == 2000 - 2000 // 11
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_loader_checks_types_while_it_reads(spark, tmp_path):
    (tmp_path / "jsonl").mkdir()
    (tmp_path / "x.csv").write_text("RowId,Name,RAWG_ID\nr1,,\n")
    lines = tmp_path / "jsonl" / "x.jsonl"
    lines.write_text('{"row_id": "r1", "personal": {"Name": "Doom"}, "pins": {}, "metrics": {"rawg.year": "2016"}}\n')
    names = {"personal": ["Name"], "pins": ["RAWG_ID"]}
    with pytest.raises(ValueError, match="rawg.year expected int, got STRING"):
        ev.load_catalog(spark, f"{tmp_path}/x.csv", default_registry(), names)
    lines.write_text('{"row_id": "r1", "personal": {}, "pins": {}, "metrics": {"rawg.year": 2016}}\n')
    from_lines = ev.load_catalog(spark, f"{tmp_path}/x.csv", default_registry(), names).select("RowId", "Name", "RAWG_ID").collect()
    assert from_lines == ev.load_catalog(spark, f"{tmp_path}/x.csv", default_registry(), use_lines=False).collect()


def test_profile_is_one_scan_and_one_shuffle(spark):
    docs = spark.createDataFrame([('{"a": [1, 2.5, null, true, "x", {"late": 1}], "b": {}}',), ("[]",), (None,)], "t string").select(F.parse_json("t").alias("payload"))
    got = {r["path"]: r["types"] for r in path_types(docs).collect()}
    assert got == {"<root>": ["dict", "list"], "a": ["list"], "a[]": ["bool", "float", "int", "null", "str"], "b": ["dict"]}
    assert path_types(docs)._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_launch_windows_by_running_sums(spark):
    days = [("a", f"2024-01-{d:02d}", d) for d in (1, 5, 30, 31)] + [("a", "2023-12-31", 1000), ("a", "2024-02-20", 7), ("b", "2024-01-10", 9)]
    series = spark.createDataFrame(days, "k string, d string, views bigint").select("k", F.to_date("d").alias("day"), "views")
    releases = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-11"), ("c", "2024-01-01"), ("d", "2024-09-09")], "k string, d string")
    out = launch_sums(series, releases.select("k", F.to_date("d").alias("release")), "k", F.lit("2024-02-25").cast("date")).collect()
    assert {tuple(r) for r in out} == {("a", 36, 74), ("b", 0, 0), ("c", 0, 0)}
    plan = launch_sums(series, releases.select("k", F.to_date("d").alias("release")), "k", F.lit("2024-02-25").cast("date"))
    assert "Join" not in plan._jdf.queryExecution().optimizedPlan().toString()


def test_mentions_are_read_once(spark, tmp_path):
    """The tally and its examples come out of one pass over the mentions (F23)."""
    rows = [("publisher", "Acme, Inc.", f"t{i % 9}", i) for i in range(20)] + [("developer", "Solo", "", 99)]
    spark.createDataFrame(rows, "kind string, company string, title string, ord int").write.parquet(str(tmp_path / "mentions"))
    out = collect_tiers(spark.read.parquet(str(tmp_path / "mentions")), min_count=2)
    assert not [f for f in out.inputFiles() if str(tmp_path) in f]
    assert [(r["label"], r["mentions"], r["examples"]) for r in out.collect()] == [("Acme", 20, [f"t{i}" for i in range(6)])]
