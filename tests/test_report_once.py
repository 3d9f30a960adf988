"""What several steps ask for is computed once."""

from catalith.operators.validation import PROVIDERS, YEAR_SOURCE, validation_report

ROMAN = " [ivx]+ "  # a title's normal form holds this pattern once


def test_validation_normalises_each_title_once(spark):
    names = [f"{p}_Name" for p in PROVIDERS]
    row = ("r1", "Doom II", "Doom 2", "Doom II", "Doom II: Definitive Edition", "Quake", *["1994"] * 4)
    df = spark.createDataFrame([row], ", ".join(f"{c} string" for c in ["RowId", "Name", *names, *YEAR_SOURCE.values()]))
    before = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", "100000")
    try:
        report = validation_report(df.localCheckpoint())
        plan = report._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.debug.maxToStringFields", before)
    # The row's name, four providers' and the canonical one; lists: the store's categories and three providers' genres.
    assert plan.count(ROMAN) == 10
    got = report.first()
    assert (got["SuggestedCanonicalTitle"], got["SeriesNumbers"]) == ("Doom 2", "RAWG:2; IGDB:2; Steam:2")
