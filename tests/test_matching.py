from pyspark.sql import functions as F

from catalith.functions.text import year_hint
from catalith.operators.matching import narrow, pick_best, ranked, with_alternatives
from catalith.operators.selection import select_entity, select_igdb, select_playtime, select_rawg, select_store

CASES = [
    ("Doom", None, [(2454, "DOOM (2016)", None), (2280, "DOOM", None)], 2280, 100),
    ("Doom (2016)", None, [(2454, "DOOM (2016)", None), (2280, "DOOM", None)], 2454, 100),
    ("Postal 4", None, [(1, "POSTAL 4: No Regerts", None), (2, "Postal 2", None)], 1, 65),
    ("Trine 2", None, [(204260, "Trine 2 Demo", None), (35700, "Trine 2", None)], 35700, 100),
    ("Doom", 1993, [(1, "Doom", 1993), (2, "Doom", 2016)], 1, 100),
    ("Diablo", None, [(1, "Diablo IV", None), (2, "Diablo", None)], 2, 100),
]


def test_pick_best_and_tie_rules(spark):
    rows = [(q, i, h, cid, name, year) for i, (q, h, cands, _, _) in enumerate(CASES) for cid, name, year in cands]
    df = spark.createDataFrame(rows, "query string, row_id int, hint int, id bigint, name string, year int")
    got = {r.row_id: r for r in pick_best(df, ["row_id"], "query", "name", "id", ["id", "name"], "hint", "year").collect()}
    for i, (_, _, _, want, least) in enumerate(CASES):
        assert got[i].id == want and got[i].score >= least, CASES[i]
    tie = spark.createDataFrame([(1, "Doom", 2000, 5, "Doom 3", 2010), (1, "Doom", 2000, 9, "Doom 4", 2010)], "row_id int, query string, hint int, id bigint, name string, year int")
    for legacy in (False, True):
        assert pick_best(tie, ["row_id"], "query", "name", "id", ["id"], "hint", "year", legacy_tiebreak=legacy).first().id == 5
    close = spark.createDataFrame([(1, "Doom", 2000, 1, "Doom", 2016), (1, "Doom", 2000, 2, "Doom", 2000)], "row_id int, query string, hint int, id bigint, name string, year int")
    assert pick_best(close, ["row_id"], "query", "name", "id", ["id"], "hint", "year").first().id == 2
    assert pick_best(close, ["row_id"], "query", "name", "id", ["id"], "hint", "year", legacy_tiebreak=True).first().id == 1


def test_alternatives_and_narrow(spark):
    df = spark.createDataFrame([(1, "Doom", i, n) for i, n in enumerate(["Doom", "Doom 2", "Doom 3", "Doom 64", "Doom II RPG", "Dooms", "Doomed", "zzz"])], "row_id int, query string, id bigint, name string")
    top = with_alternatives(ranked(df, ["row_id"], "query", "name", "id"), ["row_id"], "name", "id").first()
    assert top.best_id == 0 and len(top.alternatives) == 5
    kept = narrow(df, ["row_id"], [F.col("id") > 99, F.col("id") >= 6]).select("id").collect()
    assert sorted(r.id for r in kept) == [6, 7]


QUERIES = "row_id int, name string, year_hint int"


def test_select_rawg_falls_back_to_the_text_before_a_colon(spark):
    q = spark.createDataFrame([(1, "Gothic: Some Long Subtitle Nobody Uses", None), (2, "Diablo", None), (3, "Zzz", None)], QUERIES)
    h = spark.createDataFrame(
        [("Gothic: Some Long Subtitle Nobody Uses", 0, 9, "Nobody", ""), ("Gothic", 0, 7, "Gothic", "2001-03-15"),
         ("Diablo", 0, 1, "Diablo IV", "2023-06-06"), ("Diablo", 1, 2, "Diablo", "1996-12-31"), ("Zzz", 0, 3, "Other", "")],
        "query string, pos int, id bigint, cand_name string, released string",
    )
    assert {r.row_id: r.id for r in select_rawg(q, h).collect()} == {1: 7, 2: 2}


def test_select_igdb_prefers_the_release_window(spark):
    q = spark.createDataFrame([(1, "Silent Hill", 1999)], QUERIES)
    h = spark.createDataFrame(
        [("Silent Hill", 0, 1, "Silent Hill f", 1758758400, 0), ("Silent Hill", 1, 2, "Silent Hill", 918259200, 0), ("Silent Hill", 2, 3, "Silent Hill", 918259200, 4)],
        "query string, pos int, id bigint, cand_name string, first_release_date bigint, category int",
    )
    assert select_igdb(q, h).first().id == 2


def test_select_store_uses_details(spark):
    q = spark.createDataFrame([(1, "Doom", 1993), (2, "Trine 2", None), (3, "Skyrim Complete Edition", None), (4, "Half", None)], QUERIES)
    h = spark.createDataFrame(
        [("Doom", 0, "379720", "DOOM", "app"), ("Doom", 1, "2280", "DOOM", "app"), ("Trine 2", 0, "1", "Trine 2 Demo", "app"), ("Trine 2", 1, "2", "Trine 2", "app"),
         ("Skyrim Complete Edition", 0, "900", "Skyrim Complete Edition", "sub"), ("Half", 0, "5", "Half", "app")],
        "query string, pos int, id string, cand_name string, cand_type string",
    )
    d = spark.createDataFrame(
        [("379720", "DOOM", "game", "13 May, 2016"), ("2280", "DOOM", "game", "10 Dec, 1993"), ("1", "Trine 2 Demo", "demo", ""), ("2", "Trine 2", "game", ""),
         ("72850", "Skyrim", "game", "2011"), ("72851", "Skyrim DLC", "dlc", ""), ("5", "Half", "dlc", "")],
        "id string, d_name string, d_type string, d_date string",
    )
    p = spark.createDataFrame([("900", 0, "72851"), ("900", 1, "72850")], "package_id string, pos int, app_id string")
    got = {r.row_id: r for r in select_store(q, h, d, p).collect()}
    assert got[1].id == "2280" and got[1].release_year == 1993
    assert got[2].id == "2" and got[3].id == "72850"
    assert got[4].id is None and got[4].rejected_reason == "type_dlc"


def test_select_playtime_stops_at_the_first_good_variant(spark):
    q = spark.createDataFrame([(1, "Doom (2016)", None), (2, "X: Reunion", None), (3, "FEZ", None)], QUERIES)
    h = spark.createDataFrame(
        [("Doom (2016)", 0, 1, "Doom Eternal"), ("Doom", 0, 2, "Doom"), ("X", 0, 3, "X: Reunion"), ("fez", 0, 4, "Fez")],
        "query string, pos int, id bigint, cand_name string",
    )
    assert {r.row_id: r.id for r in select_playtime(q, h).collect()} == {1: 2, 2: 3, 3: 4}


def test_select_entity_prefers_games(spark):
    q = spark.createDataFrame([(1, "Alien", None), (2, "Portal", None), (3, "Solo", None)], QUERIES)
    h = spark.createDataFrame(
        [("Alien", 0, "Q1", "Alien", "1979 film"), ("Alien", 1, "Q2", "Alien", "1982 video game"), ("Portal", 0, "Q3", "Portal", "album"),
         ("Portal video game", 0, "Q4", "Portal", "2007 video game"), ("Solo", 0, "Q5", "Unrelated thing", "2007 video game"), ("Solo video game", 0, "Q6", "Solo video game", "video game")],
        "query string, pos int, id string, label string, description string",
    )
    inst = spark.createDataFrame([(f"Q{i}", ["video game"] if i != 3 else ["album"], "") for i in range(1, 7)], "id string, instance_of array<string>, description string")
    assert {r.row_id: r.id for r in select_entity(q, h, inst).collect()} == {1: "Q2", 3: "Q6"}


def test_year_hint_helper(one):
    assert one(lambda: year_hint(F.col("s")), s="Doom (1993)") == 1993
