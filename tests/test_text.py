import random

import pytest
from pyspark.sql import functions as F

from catalith.functions import text as t
from catalith.functions.fuzzy import lcs_lengths, with_fuzzy_scores
from catalith.functions.lists import distinct_labels


@pytest.mark.parametrize(
    "raw, want",
    [
        ("DOOM™ (2016)", "doom 2016"),
        ("Final Fantasy VII: Remake", "final fantasy 7 remake"),
        ("Assassin’s Creed® II", "assassins creed 2"),
        ("a x x b", "a 10 x b"),
        ("  Half-Life — 2 / Episode_One ", "half life 2 episode one"),
        (None, ""),
    ],
)
def test_normalize_title(one, raw, want):
    assert one(lambda: t.normalize_title(F.col("s")), s=raw) == want


@pytest.mark.parametrize("raw, want", [("Doom (2016)", 2016), ("Doom 2016", 2016), ("Doom2016", None), ("1899 x", None), ("", None)])
def test_year_hint(one, raw, want):
    assert one(lambda: t.year_hint(F.col("s")), s=raw) == want


FUZZY = [
    ("60 Seconds!", "60 Seconds Santa Run", lambda s: s < 90),
    ("Doom", "Doom (2016)", lambda s: s == 100),
    ("Borderlands", "Borderlands Game of the Year Enhanced", lambda s: s == 100),
    ("Doom 3", "Doom 2016", lambda s: s < 90),
    ("kitten", "sitting", lambda s: s == 61),
    ("", "", lambda s: s == 100),
    ("", "abc", lambda s: s == 0),
    ("", "2016", lambda s: s == 0),
    ("Creed Directors Cut Assassins", "Assassins Creed", lambda s: s >= 68),
    ("x" * 90 + " 2", "x" * 90 + " 3", lambda s: s == 98),
]


def test_fuzzy_score(spark):
    rows = [(i, a, b) for i, (a, b, _) in enumerate(FUZZY)]
    df = with_fuzzy_scores(spark.createDataFrame(rows, "i int, a string, b string"), {"ab": ("a", "b"), "ba": ("b", "a")})
    got = {r.i: (r.ab, r.ba) for r in df.collect()}
    for i, (a, b, check) in enumerate(FUZZY):
        assert got[i][0] == got[i][1], (a, b)
        assert check(got[i][0]), (a, b, got[i])


def _lcs_table(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = row
        row = [0]
        for j, y in enumerate(b):
            row.append(prev[j] + 1 if x == y else max(prev[j + 1], row[j]))
    return row[-1]


def test_lcs_against_table():
    rng = random.Random(7)
    pairs = [("".join(rng.choice("abcd é") for _ in range(rng.randint(0, n))), "".join(rng.choice("abcd é") for _ in range(rng.randint(0, n))))
             for n in (5, 30, 64, 65, 150) for _ in range(60)]
    pairs += [("a" * 64, "a" * 64), ("a" * 64, "b" * 70), ("a" * 65, "a" * 70)]
    got = lcs_lengths([a for a, _ in pairs], [b for _, b in pairs])
    assert list(got) == [_lcs_table(a, b) for a, b in pairs]


def test_series_number_variants(spark):
    df = spark.createDataFrame([("40 000 007 3 2016 51 0", "1 0 100")], "w string, v string")
    got = df.select(
        t.match_series_numbers(F.col("w")).alias("match"),
        t.report_series_numbers(F.col("w")).alias("report"),
        t.import_series_numbers(F.col("w")).alias("imported"),
        t.store_has_series_number(F.col("v")).alias("store"),
        t.non_year_numbers(F.col("w")).alias("numbers"),
        t.has_other_number(F.lit("doom 2016")).alias("other"),
        t.plain_words(F.lit("doom 2 2 doom eternal")).alias("plain"),
    ).first()
    assert got.match == ["3", "40"]
    assert got.report == [3, 7]
    assert got.imported == [3]
    assert got.store is False
    assert got.numbers == ["40", "000", "007", "3", "51", "0"]
    assert got.other is False
    assert got.plain == ["doom", "eternal"]


def test_editions(one):
    assert one(lambda: t.edition_tokens(F.col("s")), s="X: Game of the Year - Director's Cut HD") == ["directors", "goty", "hd"]
    assert one(lambda: t.strip_edition_tokens(F.col("s")), s="The Witcher: Enhanced Edition") == "witcher"
    assert one(lambda: t.strip_edition_phrases(F.col("s")), s="Skyrim Game of the Year Edition") == "Skyrim"
    assert one(lambda: t.strip_trailing_year(F.col("s")), s="Doom (2016)") == "Doom"


def test_query_variants(one):
    got = one(lambda: t.query_variants(F.col("s")), s="Unreal Tournament III: Full HD (2007)")
    assert got[0] == "Unreal Tournament III: Full HD (2007)"
    assert "Unreal Tournament III: Full HD" in got
    assert "Unreal Tournament III: HD (2007)" in got
    assert "Unreal Tournament III" in got
    assert "Unreal Tournament 3: Full HD (2007)" in got
    assert len(got) == len(set(got))


def test_search_text_and_labels(one):
    assert one(lambda: t.search_text(F.col("s")), s='Area\t51 ² "x" (1999)') == 'Area 51 2 \\"x\\"'
    assert one(lambda: distinct_labels(F.col("w")), w=["Action", " action ", "", "RPG", "ACTION"]) == ["Action", "RPG"]
    assert one(lambda: t.truncate(F.col("s"), 500, 500, "…"), s="x" * 499 + "  y") == "x" * 499 + "…"
    assert one(lambda: t.first_store_id(F.col("w")), w=["https://a/b", "https://store/app/620/", "https://store/app/7"]) == "620"
    assert one(lambda: t.drop_cyrillic(F.col("w")), w=["RPG", "Экшен"]) == ["RPG"]
    assert one(lambda: t.normalize_tag(F.col("s")), s="Hack & Slash (Co-op)") == "hack and slash co-op"


def test_items_of_a_list_are_computed_once(spark):
    """A list's expression stands in the plan of its labels once, outside the lambda that compares spellings."""
    rows = spark.createDataFrame([("a, A,b,, B ,c",), (None,)], "t string")
    out = rows.select(distinct_labels(F.split(F.col("t"), ",")).alias("labels"))
    assert [r["labels"] for r in out.collect()] == [["a", "b", "c"], []]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
