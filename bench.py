"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from catalith import workload  # noqa: E402
from catalith.session import build_session  # noqa: E402

HEADLINE = (
    "enriched_scores", "reach_scores", "overlay_providers", "payload_lookup", "fuzzy_scores", "best_matches", "select_rawg", "select_igdb",
    "provider_agreement", "import_tags", "production_tiers", "company_tally", "launch_views", "extract_rawg", "linked_labels", "stream_enrichment",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    workload.load()
    spark = build_session(
        "bench", f"local[{cpus}]", spark__ui__enabled="false", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g",
        spark__sql__files__openCostInBytes="262144",
    )
    spark.sparkContext.setLogLevel("ERROR")
    # The first queries of a session pay for compiling and starting workers.
    for name in ("enriched_scores", "fuzzy_scores"):
        workload.QUERIES[name](spark, folder.replace("sf0.1", "sf0.001")).write.format("noop").mode("overwrite").save()
    timings: dict[str, float] = {}
    for name in HEADLINE:
        started = time.time()
        workload.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.time() - started, 3)
    spark.stop()
    print(json.dumps({"metric": "headline_total", "value": round(sum(timings.values()), 3), "unit": "sec", "queries": timings, "sf": Path(folder).name}))


if __name__ == "__main__":
    main()
