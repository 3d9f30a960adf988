"""Queries against their SQL on small tables made so that ties and shared keys count."""

import importlib.util
from pathlib import Path

import duckdb
import pytest

from catalith import workload
from catalith.workload.frames import TABLES, duck
from catalith.workload.joins import _BEFORE

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def same(spark, tmp_path):
    """Compare a query with its SQL on the smallest tables, some of them replaced by the rows of a DuckDB query."""
    spec = importlib.util.spec_from_file_location("check_oracles", Path(__file__).with_name("check_oracles.py"))
    check = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(check)
    workload.load()

    def run(name, **tables):
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"CREATE VIEW small_{t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
            con.execute(f"COPY ({tables.get(t, f'SELECT * FROM small_{t}')}) TO '{tmp_path}/{t}.parquet' (FORMAT parquet)")
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
        message, fine, _ = check.compare(spark, con, name, str(tmp_path))
        assert fine, message
        return con

    return run


def test_ordinals_of_many_parts_stay_apart(same):
    """Part 1,000,001 of size 1 and part 1 of size 2 had one ordinal, so which of them came first was left to chance."""
    parts = "SELECT * REPLACE (i + 1000000 * (2 - s) AS p_partkey, 'ring' AS p_name, s::INT AS p_size) FROM (SELECT * FROM small_part LIMIT 1), range(40) t(i), range(1, 3) u(s)"
    con = same("occurrence_carry", part=parts)
    assert con.execute(f"SELECT count(*), count(DISTINCT ord) FROM {duck(_BEFORE)}").fetchone() == (80, 80)


@pytest.mark.parametrize("name", ["tiered_companies", "production_tiers", "company_tally"])
def test_last_label_of_a_company_key_gives_its_tier(same, name):
    """Supplier 185 has the labels 'Supplier 185' (Indie) and 'Supplier 185 Inc' (AA); the last one in label order stands."""
    same(
        name,
        supplier="SELECT * REPLACE (185 AS s_suppkey) FROM small_supplier LIMIT 1",
        lineitem="SELECT * REPLACE (185 AS l_suppkey, 'N' AS l_returnflag) FROM small_lineitem LIMIT 200",
    )


def test_average_at_one_half_does_not_depend_on_order(same):
    """(1 * 0.01 + 2 * 0.01) / 0.02 and their like end in .5; sums of doubles miss it, by an amount that depends on the order."""
    rows = "SELECT * REPLACE (i // 3 AS l_suppkey, (i // 3 % 40 + [0, 1, 2][i % 3 + 1] * 0.5)::DOUBLE AS l_quantity, [0.07, 0.01, 0.07][i % 3 + 1]::DOUBLE AS l_discount)"
    con = same("weighted_ratings", lineitem=f"{rows} FROM (SELECT * FROM small_lineitem LIMIT 1), range(600) t(i)")
    exact = "round_even((sum((l_quantity * 10)::HUGEINT * (l_discount * 100)::HUGEINT) / (10 * sum((l_discount * 100)::HUGEINT)))::DOUBLE, 0)::BIGINT"
    want = con.execute(f"SELECT l_suppkey, {exact} FROM lineitem GROUP BY 1 ORDER BY 1").fetchall()
    assert con.execute(f"SELECT l_suppkey, rating FROM ({workload.ORACLES['weighted_ratings']}) ORDER BY 1").fetchall() == want


def test_store_selection_hands_the_driver_a_short_plan(spark):
    """First picks and second-look candidates are written once; the final plan held both of their plans again and again (239,247 characters)."""
    workload.load()
    plan = workload.QUERIES["select_store"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert len(plan) < 120_000
