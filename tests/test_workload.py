import os
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from check_oracles import compare  # noqa: E402

from catalith import workload  # noqa: E402
from catalith.workload.frames import TABLES  # noqa: E402

FOLDER = os.environ.get("CATALITH_TABLES", "/root/testdata/sf0.001")
# A cross-section; `python tests/check_oracles.py <folder>` runs them all.
NAMES = (
    "normalize_documents", "series_numbers", "text_numbers", "company_names", "company_tally", "production_tiers", "year_votes", "platform_votes",
    "provider_agreement", "canonical_titles", "reach_scores", "rating_scores", "enriched_scores", "best_matches", "select_rawg", "overlay_providers",
    "occurrence_carry", "row_ids", "sync_catalog", "linked_labels", "extract_rawg", "extract_wikidata", "launch_views", "dense_days", "import_tags",
    "review_queue", "envelope_round_trip", "export_cells", "stream_enrichment", "stream_task_totals", "catalog_from_lines", "catalog_from_csv", "json_array",
    "title_search", "imported_catalog", "resolve_actions", "resolved_catalog", "majority_titles", "validation_report", "broken_lines", "json_profile", "metric_coverage",
    "stored_payload_lookup", "stream_trailing_views", "rawg_metrics", "igdb_metrics", "steam_metrics", "steamspy_metrics", "hltb_metrics", "wikidata_metrics", "pageview_metrics",
)


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(FOLDER):
        pytest.skip("no test tables")
    workload.load()
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, name):
    message, fine, _ = compare(spark, con, name, FOLDER)
    assert fine, message


def test_plans_hold_no_cross_join(spark, con):
    for name in ("best_matches", "overlay_providers", "payload_lookup", "linked_labels", "launch_views"):
        plan = workload.QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
