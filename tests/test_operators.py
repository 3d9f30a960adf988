import pytest
from pyspark.sql import functions as F

from catalith.operators.columns import auto_metric_key, column_order, parse_sources, registry_check, selected_columns
from catalith.operators.diagnostics import review_tags
from catalith.operators.keys import occurrence_number, require_unique
from catalith.operators.overlay import sync_back
from catalith.operators.resolve import plan_actions, retry_query
from catalith.operators.signals import with_signals
from catalith.operators.validation import validation_report
from catalith.plans import enrich, resolve_pins
from catalith.sources import envelope as ev
from catalith.sources.registry import default_column, default_registry, registry_from_spec


def test_registry_rules():
    reg = default_registry()
    assert (len(reg.by_key), len(reg.diagnostics)) == (150, 19)
    assert default_column("rawg.a.b") == "RAWG_a_b" and default_column("x.y") == "x_y"
    with pytest.raises(ValueError):
        registry_from_spec({"version": 1, "metrics": {}})
    with pytest.raises(ValueError):
        registry_from_spec({"version": 2, "metrics": {"a.b": {"column": "X"}, "a.c": {"column": "X"}}})
    assert auto_metric_key("RAWG_Added") == "rawg.added"
    assert auto_metric_key("SteamSpy_Score100") == "steamspy.score_100"
    assert auto_metric_key("Reach_Composite") == "derived.reach_composite"


def test_sources_and_columns(spark):
    assert parse_sources("core", ("igdb", "rawg", "steam"), {"core": ["igdb", "rawg", "steam"]}) == ["igdb", "rawg", "steam"]
    assert parse_sources("steam, igdb,steam", ("igdb", "steam")) == ["steam", "igdb"]
    with pytest.raises(ValueError):
        parse_sources("nope", ("igdb",))
    reg = default_registry()
    cols = ["Notes", "ReviewTags", "RAWG_Name", "Reach_Composite", "RAWG_ID", "Name", "RowId", "RAWG_Junk"]
    assert column_order(cols, reg) == ["RowId", "Name", "RAWG_ID", "Notes", "RAWG_Junk", "Reach_Composite", "RAWG_Name", "ReviewTags"]
    assert "RAWG_Junk" not in selected_columns(cols, reg)
    issues = {(r.issue, r.name) for r in registry_check(spark.createDataFrame([("x", "y")], "RAWG_Junk string, RAWG_Name string"), reg).collect()}
    assert ("unmapped_column", "RAWG_Junk") in issues and ("unused_key", "igdb.name") in issues and ("unused_key", "rawg.name") not in issues


def test_occurrence_numbers_do_not_depend_on_the_chunk(spark):
    df = spark.createDataFrame([(i, "hot" if i % 3 else "cold") for i in range(200)], "ord bigint, name string")
    small = {r.ord: r.occ for r in occurrence_number(df, ["name"], "ord", chunk_rows=7).collect()}
    seen = {}
    for i in range(200):
        k = "hot" if i % 3 else "cold"
        assert small[i] == seen.get(k, 0)
        seen[k] = seen.get(k, 0) + 1
    with pytest.raises(ValueError):
        require_unique(spark.createDataFrame([("a",), ("a ",)], "RowId string"))


def test_sync_back(spark):
    old = spark.createDataFrame([("rid:1", "A", "5", "tags"), ("rid:2", "B", "6", "")], "RowId string, Name string, MyRating string, ReviewTags string")
    new = spark.createDataFrame([("rid:1", "A2", "9", "x"), ("rid:3", "C", "1", "y")], "RowId string, Name string, MyRating string, RAWG_Name string")
    got = {r.RowId: r for r in sync_back(old, new, diagnostic_columns={"ReviewTags"}).collect()}
    assert got["rid:1"].Name == "A2" and got["rid:1"].MyRating == "9" and got["rid:1"].Disabled == ""
    assert got["rid:2"].Disabled == "YES" and got["rid:2"].Name == "B"
    assert got["rid:3"].Name == "C" and "RAWG_Name" not in got["rid:3"] and "ReviewTags" not in got["rid:3"]
    dropped = sync_back(old, new, "drop")
    assert sorted(r.RowId for r in dropped.collect()) == ["rid:1", "rid:3"]
    same = sync_back(old, old)
    assert sorted(map(tuple, same.select(*old.columns).collect())) == sorted(map(tuple, old.collect()))


def test_validation_cases(spark):
    schema = """RowId string, Name string, RAWG_ID string, IGDB_ID string, Steam_AppID string, IGDB_SteamAppID string, RAWG_Name string, IGDB_Name string, Steam_Name string,
        HLTB_Name string, RAWG_Year int, IGDB_Year int, Steam_ReleaseYear int, HLTB_ReleaseYear int, RAWG_Platforms array<string>, IGDB_Platforms array<string>,
        Steam_Platforms array<string>, HLTB_Main double, SteamSpy_Owners string"""
    rows = [
        ("1", "Doom", "1", "2", "379720", "379720", "Doom", "Doom", "Doom", "Doom", 2016, 2016, 2016, 2016, ["PC"], ["PC"], ["Windows"], 11.0, "1 .. 2"),
        ("2", "Doom", "1", "3", "379720", "9", "Doom", "Doom 3", "DOOM", "", 2016, 2004, 2016, None, ["PC"], ["Xbox"], ["Windows"], None, ""),
    ]
    got = {r.RowId: r for r in validation_report(spark.createDataFrame(rows, schema)).collect()}
    assert "mismatch" not in got["1"].ValidationTags and got["1"].SuggestedCulprit == ""
    tags = got["2"].ValidationTags.split(", ")
    for t in ("title_mismatch", "year_disagree_rawg_igdb", "platform_disagree", "steam_appid_mismatch", "missing:HLTB", "missing:SteamSpy"):
        assert t in tags, (t, tags)
    assert got["2"].SuggestedCanonicalTitle == "DOOM" and got["2"].SuggestedCulprit == "IGDB"


def test_signal_cases(spark):
    schema = "RowId string, SteamSpy_Owners string, SteamSpy_Score_100 bigint, SteamSpy_Positive bigint, SteamSpy_Negative bigint, Steam_StoreType string, IGDB_VersionParent string, IGDB_DLCs array<string>, Steam_Categories array<string>"
    rows = [("1", "1,000,000 .. 2,000,000", 90, 100, 10, "game", "Doom", ["Soundtrack", "Artbook", "DLC 1"], ["Steam Workshop"]), ("2", "", None, None, None, "", "", [], [])]
    got = {r.RowId: r for r in with_signals(spark.createDataFrame(rows, schema), default_registry()).collect()}
    assert (got["1"].Reach_SteamSpyOwners_Low, got["1"].Reach_SteamSpyOwners_High, got["1"].Reach_SteamSpyOwners_Mid) == (1000000, 2000000, 1500000)
    assert got["1"].ContentType is None and got["1"].ContentType_Conflict == "YES" and got["1"].HasDLCs is True
    assert got["1"].CommunityRating_Composite_100 == 90 and got["1"].ModdingSignal_100 == 90 and got["1"].HasWorkshop is True
    assert got["2"].Reach_Composite is None and got["2"].Replayability_100 is None and got["2"].ModdingSignal_100 is None


def test_enrich_end_to_end(spark):
    reg = default_registry()
    catalog = spark.createDataFrame(
        [("r1", "Doom", "1", "10", "note", "old"), ("r2", "Gone", "__NOT_FOUND__", "", "", "stale"), ("r3", "Doom again", "1", "", "", "")],
        "RowId string, Name string, RAWG_ID string, Steam_AppID string, Notes string, RAWG_Name string",
    )

    def payload(rows):
        return spark.createDataFrame(rows, "id string, j string").select("id", F.parse_json("j").alias("payload"))

    rawg = payload([("1", '{"id": 1, "name": "DOOM", "released": "2016-05-13", "rating": 4.5, "ratings_count": 1000, "genres": [{"name": "Shooter"}]}')])
    steam = payload([("10", '{"name": "DOOM", "type": "game", "recommendations": {"total": 5000}, "developers": ["id Software, Inc."]}')])
    tiers = spark.createDataFrame([("developer", "id Software", "AAA")], "kind string, label string, tier string")
    got = {r.RowId: r for r in enrich(catalog, {"rawg": rawg, "steam": steam}, reg, tiers=tiers).collect()}
    assert got["r1"].RAWG_Name == got["r3"].RAWG_Name == "DOOM" and got["r1"].RAWG_Score_100 == 90
    assert got["r2"].RAWG_Name is None and got["r1"].Notes == "note"
    assert got["r1"].Production_Tier == "AAA" and got["r1"].Genre_Main == "Shooter" and got["r1"].Reach_Composite > 0


def _catalog(spark):
    rows = [
        ("r1", "Doom", "1", "2", "3", "4", "Doom", "Quake", "Doom", "Doom", 2016, 1996, 2016, 2016, ""),
        ("r2", "Prey", "1", "", "", "", "Prey", "", "", "", 2017, None, None, None, "wikidata_hint, x"),
    ]
    return spark.createDataFrame(
        rows,
        """RowId string, Name string, RAWG_ID string, IGDB_ID string, Steam_AppID string, HLTB_ID string, RAWG_MatchedName string, IGDB_MatchedName string,
        Steam_MatchedName string, HLTB_MatchedName string, RAWG_MatchedYear int, IGDB_MatchedYear int, Steam_MatchedYear int, HLTB_MatchedYear int, ReviewTags string""",
    ).withColumns({f"{p}_year": F.col(f"{q}_MatchedYear") for p, q in (("rawg", "RAWG"), ("igdb", "IGDB"), ("steam", "Steam"), ("hltb", "HLTB"))})


def test_import_tags(spark):
    got = {r.RowId: r for r in review_tags(_catalog(spark)).collect()}
    for t in ("provider_consensus:hltb+rawg+steam", "provider_outlier:igdb", "year_outlier:igdb", "likely_wrong:igdb"):
        assert t in got["r1"].ReviewTags
    assert got["r1"].MatchConfidence == "LOW"
    assert got["r2"].ReviewTags.endswith("wikidata_hint") and "missing_igdb" in got["r2"].ReviewTags and got["r2"].MatchConfidence == "MEDIUM"


def test_resolve_repins_or_unpins(spark):
    cat = _catalog(spark).withColumn("Wikidata_QID", F.lit(""))

    def search(found):
        return lambda q: q.select("row_id", F.lit(found[0]).alias("id"), F.lit(found[1]).alias("new_name"), F.lit(found[2]).alias("new_year"))

    fixed, stats = resolve_pins(cat, {"igdb": search(("77", "Doom", 2016))}, apply=True)
    row = {r.RowId: r for r in fixed.collect()}["r1"]
    assert row.IGDB_ID == "77" and "repinned_by_resolve:igdb" in row.ReviewTags
    assert stats.first().repinned == 1
    fixed, stats = resolve_pins(cat, {"igdb": search(("77", "Something Else", 1990))}, apply=True)
    row = {r.RowId: r for r in fixed.collect()}["r1"]
    assert not row.IGDB_ID and "autounpinned:igdb" in row.ReviewTags and stats.first().unpinned == 1
    dry, _ = resolve_pins(cat, {"igdb": search(("77", "Doom", 2016))})
    assert {r.RowId: r for r in dry.collect()}["r1"].IGDB_ID == "2"


def test_plan_and_retry_query(spark):
    rows = spark.createDataFrame([("r1", "Doom", ["DOOM Eternal", "Doom"], ["Doom!"])], "RowId string, Name string, a array<string>, b array<string>")
    assert retry_query(rows, [F.col("a"), F.col("b")], F.col("Name")).first().retry_query == "Doom"
    targets = spark.createDataFrame([("r1", "steam", "fill_missing", "Doom", "Doom", 2016)], "RowId string, provider string, reason string, Name string, majority_title string, majority_year int")
    none = spark.createDataFrame([], "RowId string, provider string, new_id string, new_name string, new_year int")
    assert plan_actions(targets, none).first().action == "keep"


def test_envelope_and_export(spark, tmp_path):
    reg = default_registry()
    df = spark.createDataFrame(
        [("r1", "Doom", "620", 42, ["FPS", "Fast"], "LOW")], "RowId string, Name string, Steam_AppID string, Reach_Composite bigint, RAWG_Genres array<string>, MatchConfidence string"
    )
    path = str(tmp_path / "env")
    ev.write_envelope(ev.to_envelope(df, reg, include_diagnostics=True), path)
    back = ev.read_envelope(spark, path)
    manifest = ev.manifest_of([*df.columns, "Play again"], reg)
    assert ev.Manifest.from_json(manifest.to_json()) == manifest
    row = ev.export(back, manifest, reg, "csv").first().asDict()
    assert row["Reach_Composite"] == "42" and row["RAWG_Genres"] == "FPS, Fast" and row["Play again"] == "" and row["Steam_AppID"] == "620"
    assert ev.catalog_view(back).first().MatchConfidence == "LOW"
    lines = [r.value for r in ev.export(back, manifest, reg, "json").collect()]
    assert lines[0] == "[" and lines[-1] == "]"
    bad = tmp_path / "bad.jsonl"
    bad.write_text('{"row_id": "r1", "metrics": {"rawg.year": "2016"}}\nnot json\n[1]\n\n')
    assert ev.read_envelope(spark, str(bad)).count() == 1
    with pytest.raises(Exception, match="invalid envelope line"):
        ev.read_envelope_strict(spark, str(bad)).collect()
    with pytest.raises(ValueError, match="rawg.year"):
        ev.require_valid(ev.read_envelope(spark, str(bad)), reg, "export")
