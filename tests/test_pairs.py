"""Pairs of titles are judged once each, whatever number of rows holds them."""

from __future__ import annotations

from pathlib import Path

import pytest

from catalith.operators import matching, selection
from catalith.operators.keys import lookup_stored
from catalith.sources.tables import stored_payloads
from catalith.workload import artifacts


@pytest.fixture
def judged(monkeypatch):
    """Numbers of rows whose titles were scored."""
    seen, plain = [], matching.with_scores

    def counted(df, pairs):
        seen.append(df.count())
        return plain(df, pairs)

    monkeypatch.setattr(matching, "with_scores", counted)
    return seen


def _hits(spark, n, *more):
    rows = [(i, k, 10 * i + k, name, *more) for i in range(n) for k, name in enumerate(("Blue Anvil", "Blue Anvil II", None))]
    return spark.createDataFrame(rows, "row_id long, pos long, id long, cand_name string" + ", x string" * len(more))


def test_titles_of_many_rows_are_scored_once(spark, judged):
    queries = spark.createDataFrame([(i, "Blue Anvil", None) for i in range(50)], "row_id long, name string, year_hint int")
    hits = _hits(spark, 50, "1999-01-01").withColumnRenamed("x", "released")
    got = sorted(selection.select_rawg(queries, hits).collect())
    assert judged == [3]
    assert [(r.row_id, r.id, r.cand_name, r.score) for r in got] == [(i, 10 * i, "Blue Anvil", 100) for i in range(50)]


def test_titles_without_a_text_keep_their_rows(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, "b"), (3, "a", None), (4, None, None)], "k long, q string, c string")
    out = matching.once_per_pair(df, ["q", "c"], lambda pairs: pairs.selectExpr("*", "concat_ws('+', q, c) AS both"))
    assert sorted(tuple(r) for r in out.select("k", "both").collect()) == [(1, "a"), (2, "b"), (3, "a"), (4, "")]


def test_settled_titles_are_not_tried_again(spark, judged):
    queries = spark.createDataFrame([(0, "Blue Anvil", None), (1, "Old Widget", None)], "row_id long, name string, year_hint int")
    hits = spark.createDataFrame(
        [(0, 0, 7, "Blue Anvil", "video game"), (1, 0, 8, "Old Widget (Video Game)", "video game"), (1, 1, 9, "Cat", "film")],
        "row_id long, pos long, id long, label string, description string",
    )
    instances = spark.createDataFrame([(7, ["video game"], ""), (8, ["video game"], "")], "id long, instance_of array<string>, description string")
    got = sorted(selection.select_entity(queries, hits, instances).collect())
    assert [(r.row_id, r.id) for r in got] == [(0, 7), (1, 8)]
    assert judged == [3, 4]


def test_rows_of_a_hot_pin_are_not_sorted(spark):
    rows = spark.range(100).selectExpr("id AS row_id", "CASE WHEN id % 3 = 0 THEN '' ELSE '7' END AS pin")
    store = stored_payloads(spark.range(20).selectExpr("CAST(id AS STRING) AS id", "id * 2 AS twice"), 4)
    out = lookup_stored(rows, store, "pin", "id", "row_id")
    assert sorted(tuple(r) for r in out.select("row_id", "twice").collect()) == [(i, 14 if i % 3 else None) for i in range(100)]
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = lookup_stored(rows, store, "pin", "id", "row_id")._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "ShuffledHashJoin" in plan and "LeftOuter, BuildRight" in plan


def test_a_long_text_is_written_by_many_tasks(spark, tmp_path):
    folder, shared = str(tmp_path), Path(spark.conf.get("spark.checkpoint.dir"))
    spark.range(600).selectExpr("id * 3 AS p_partkey").repartition(3).write.parquet(f"{folder}/part.parquet")
    earlier = set(shared.glob("broken-*/part-*.txt"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = sorted(r.line for r in artifacts.broken_lines(spark, folder).collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == [i + 1 for i in range(600) if i * 3 % 7 in (0, 3)]
    assert len(set(shared.glob("broken-*/part-*.txt")) - earlier) > 1
