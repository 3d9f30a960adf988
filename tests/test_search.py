"""Title search, bounds of scores, and the import and repair that stand on them."""

import random

import pytest
from pyspark.sql import functions as F

from catalith.functions.fuzzy import with_scores
from catalith.functions.text import normalize_title, tokens
from catalith.operators.matching import pick_best, score_bounds, score_candidates
from catalith.operators.search import indexed_search, looked_up, search_titles, title_index
from catalith.operators.selection import igdb_terms, select_igdb, select_store, store_terms
from catalith.plans.imports import import_catalog

WORDS = ("the", "the", "the", "of", "doom", "quake", "lisa", "painful", "saga", "2", "witcher", "wild", "hunt", "ii", "edition", "complete")


def _titles(n, seed):
    rng = random.Random(seed)
    return sorted({" ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 5))) for _ in range(n)} | {"", "!!"})


def _found(term, title, share):
    words = lambda x: {{"ii": "2"}.get(w, w) for w in x.replace("!", " ").split()}
    a, b = words(term), words(title)
    shared = sum(map(len, a & b))
    return shared if shared and shared * 100 >= share * sum(map(len, a)) else None


@pytest.mark.parametrize("share", [1, 60, 100])
def test_search_equals_all_pairs(spark, share):
    terms, titles = _titles(40, 1), _titles(120, 2)
    index = title_index(spark.createDataFrame([(t,) for t in [*titles, None]], "title string"))
    asked = spark.createDataFrame([(t,) for t in [*terms, *terms, None]], "term string")
    got = sorted(tuple(r) for r in search_titles(asked, index, share).collect())
    assert got == sorted((a, b, n) for a in terms for b in titles if (n := _found(a, b, share)))
    if share == 60:
        looked = {(r["term"], r["word"]) for r in looked_up(asked, index.vocabulary, share).collect()}
        assert not any(w == "the" and "witcher" in t.split() for t, w in looked)


def test_bounds_hold_the_score(spark):
    titles = _titles(60, 3) + ["Doom (2016)", "doom eternal", "Eternal Doom", "éa"]
    rng = random.Random(4)
    pairs = [(rng.choice(titles), rng.choice(titles)) for _ in range(600)]
    df = spark.createDataFrame(pairs, "x string, y string").select(normalize_title(F.col("x")).alias("a"), normalize_title(F.col("y")).alias("b"))
    low, high = score_bounds(F.col("a"), F.col("b"), F.array_distinct(tokens(F.col("a"))), F.array_distinct(tokens(F.col("b"))))
    rows = with_scores(df.withColumns({"low": low, "high": high}), {"s": ("a", "b")}).collect()
    assert all(r["low"] <= r["s"] <= r["high"] for r in rows)
    assert sum(r["high"] < 65 for r in rows) > 100


def test_pruned_best_is_the_best(spark):
    rng = random.Random(5)
    titles = _titles(80, 6)
    rows = [(k, rng.choice(titles), 1990 + k % 9, i, rng.choice(titles), 1990 + rng.randint(0, 20) if rng.random() < 0.8 else None) for k in range(60) for i in range(12)]
    df = spark.createDataFrame(rows, "k int, q string, hint int, id int, c string, y int").cache()
    ask = dict(keys=["k"], query="q", name="c", id_="id", payload=["id", "c"], year_hint="hint", candidate_year="y", predicates=[F.col("id") % 5 == 0])
    assert sorted(pick_best(df, **ask).collect()) == sorted(pick_best(df, **ask, prune=True).collect())
    scored = score_candidates(df, "q", "c", "hint", "y", keys=["k"])
    asked = scored.where("m_raw is not null").count()
    assert asked * 2 <= len(rows), asked
    df.unpersist()


@pytest.fixture
def store(spark):
    """Records of a store and of a database that names store ids; with the searches over them."""
    details = spark.createDataFrame(
        [(335670, "LISA: The Painful", "game", "1 Jan, 2014"), (2112230, "Car Mechanic Simulator 2021 - Aston Martin DLC", "dlc", "1 Jan, 2021"),
         (1234, "Car Mechanic Simulator 2021", "game", "1 Jan, 2021"), (70, "Half-Life", "game", "8 Nov, 1998")],
        "id bigint, d_name string, d_type string, d_date string",
    )
    apps = details.where("d_type = 'game'").select(F.col("d_name").alias("title"), "id", F.col("d_name").alias("cand_name"), F.lit("app").alias("cand_type"))
    base = spark.createDataFrame(
        [("Car Mechanic Simulator 2021", 123, None), ("Half-Life", 231, 911520000), ("LISA", 9, None)], "title string, id bigint, first_release_date bigint"
    ).withColumns({"cand_name": F.col("title"), "category": F.lit(0)})
    searches = {
        "igdb": indexed_search(base, igdb_terms, select_igdb),
        "steam": indexed_search(apps, store_terms, lambda q, h: select_store(q, h, details)),
    }
    facts = {
        "igdb": base.select(F.col("id").cast("string").alias("id"), F.col("title").alias("m_name"), F.lit(None).cast("int").alias("m_year")),
        "steam": details.select(F.col("id").cast("string").alias("id"), F.col("d_name").alias("m_name"), F.lit(2000).alias("m_year")),
    }
    implied = {"123": "2112230", "231": "70"}

    def cross_ids(catalog):
        found = F.coalesce(*[F.when(F.col("IGDB_ID") == k, F.lit(v)) for k, v in implied.items()])
        return catalog.select("RowId", found.alias("igdb_steam_id"), F.lit(None).cast("string").alias("rawg_steam_id"))

    return searches, facts, details.withColumn("id", F.col("id").cast("string")), cross_ids


def _imported(spark, store, rows):
    searches, facts, details, cross_ids = store
    df = spark.createDataFrame(rows, "ord int, Name string, IGDB_ID string, Steam_AppID string, Disabled string")
    out = import_catalog(df, "ord", searches, facts, store_details=details, cross_ids=cross_ids, sources={"igdb", "steam"})
    return {r["ord"]: r for r in out.collect()}


def test_import_searches_again_for_pins_that_name_nothing(spark, store):
    out = _imported(spark, store, [
        (1, "LISA: The Painful", None, "77828", ""),  # no such app
        (2, "Car Mechanic Simulator 2021", "123", "", ""),  # the implied id is an add-on: the search stands
        (3, "Half-Life", "", "", ""),  # found in the database, whose record names the store's id
        (4, "LISA: The Painful", "", "77828", "YES"),  # switched off: left alone
        (5, "Half-Life", "", "2112230", ""),  # pinned to an add-on
        (6, None, "", "", ""),
    ])
    assert {k: r["Steam_AppID"] for k, r in out.items()} == {1: "335670", 2: "1234", 3: "70", 4: "77828", 5: "70", 6: ""}
    assert out[3]["IGDB_ID"] == "231" and out[3]["Steam_MatchedName"] == "Half-Life" and out[3]["Steam_MatchScore"] == "100"
    assert all(out[k]["RowId"] for k in out) and out[1]["Steam_RejectedReason"] == ""


def test_one_name_in_many_rows_is_asked_once(spark, store):
    out = _imported(spark, store, [(k, "Half-Life", "", "", "") for k in range(200)] + [(500, "Nothing Like It", "", "", "")])
    assert {r["Steam_AppID"] for k, r in out.items() if k < 500} == {"70"} and out[500]["Steam_AppID"] == ""
    assert len({r["RowId"] for r in out.values()}) == 201
