"""Candidates of searches are laid out by the row that asked, and are not shuffled again."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from catalith import workload
from catalith.operators import selection
from catalith.session import materialize
from catalith.workload.frames import HITS, OWN_HITS, spark_frame

SMALL = "/root/testdata/sf0.001"


def _shuffles(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(")


def test_entity_rows_are_not_shuffled_again(spark):
    """The plan of the last step had four shuffles of them, beside those of the written steps."""
    workload.load()
    assert _shuffles(workload.QUERIES["select_entity"](spark, SMALL)) == 0


def test_groups_of_a_laid_out_table_need_no_shuffle(spark):
    rows = spark.range(1000).select((F.col("id") % 70).alias("k"), "id")
    out = materialize(rows.repartition("k"), "laid-out", "k")
    sums = out.groupBy("k").agg(F.sum("id").alias("s"))
    assert _shuffles(sums) == 0 and _shuffles(sums.join(out, "k")) == 0
    assert {r.k: r.s for r in sums.collect()} == {r.k: r.s for r in rows.groupBy("k").agg(F.sum("id").alias("s")).collect()}
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("laid_out")]


def test_hits_without_years_are_the_distinct_hits(spark):
    want = spark_frame(spark, SMALL, HITS).select("row_id", F.col("id").alias("pos"), "id", "cand_name").distinct()
    got = spark_frame(spark, SMALL, OWN_HITS)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()


@pytest.mark.parametrize("at, found", [(9, 9), (10, None)])
def test_a_valid_record_counts_among_the_ten_nearest(spark, at, found):
    """Twelve films of one title, one of them a game by its record; it stands in for the first one when it is among ten."""
    queries = spark.createDataFrame([(1, "Blue Anvil", None)], "row_id long, name string, year_hint int")
    hits = spark.createDataFrame([(1, k, k, "Blue Anvil", "film") for k in range(12)], "row_id long, pos long, id long, label string, description string")
    records = [(k, ["video game" if k == at else "film"], "") for k in range(12)]
    instances = spark.createDataFrame(records, "id long, instance_of array<string>, description string")
    assert [r.id for r in selection.select_entity(queries, hits, instances).collect()] == ([found] if found else [])


def test_store_rows_are_not_shuffled_again(spark):
    """Hits keyed by row and by text give one answer: an app, an app seen at the second look, a package's app; and their last step shuffles none of them."""
    queries = spark.createDataFrame([(1, "Doom", 1993), (2, "Trine 2", None), (3, "Skyrim Complete Edition", 2011)], "row_id long, name string, year_hint int")
    rows = [(1, 0, 30, "DOOM", "app"), (1, 1, 20, "DOOM", "app"), (2, 0, 11, "Trine 2 Demo", "app"), (2, 1, 12, "Trine 2", "app"), (2, 2, 90, "Trine 2", "sub"), (3, 0, 90, "Skyrim", "sub")]
    by_row = spark.createDataFrame(rows, "row_id long, pos long, id long, cand_name string, cand_type string")
    by_text = selection.store_terms(queries).select("row_id", F.col("term").alias("query")).join(by_row, "row_id").drop("row_id")
    details = spark.createDataFrame(
        [(30, "DOOM", "game", "2016"), (20, "DOOM", "game", "1993"), (11, "Trine 2 Demo", "demo", ""), (12, "Trine 2", "game", ""), (70, "Skyrim", "game", "2011"), (71, "Skyrim DLC", "dlc", "")],
        "id long, d_name string, d_type string, d_date string",
    )
    packages = spark.createDataFrame([(90, 0, 71), (90, 1, 70)], "package_id long, pos long, app_id long")
    for hits in (by_row, by_text):
        got = selection.select_store(queries, hits, details, packages)
        assert sorted((r.row_id, int(r.id), r.release_year) for r in got.collect()) == [(1, 20, 1993), (2, 12, None), (3, 70, 2011)]
        assert _shuffles(selection.select_store(queries, hits, details)) == 0
