"""Headline timings: one JSON line.  Every query is run whole into a no-op sink."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from kinfold.plans.queries import QUERIES  # noqa: E402
from kinfold.session import local_session  # noqa: E402

HEADLINE = [
    "ingest_union", "transform_log", "dq_results", "dq_orders", "dq_lineitem", "block_sizes", "candidate_pair_count",
    "deterministic_links", "match_pairs", "match_bands", "clusters", "golden", "survivorship_decisions", "crosswalk",
    "reconcile_counts", "lineage_trace", "incremental_match", "golden_upsert", "cdc_apply", "scd2_history", "metrics_failures",
    "sar_export", "pr_curve", "part_match_pairs", "part_clusters", "document_clusters", "stream_quality",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "kinfold-bench")
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executor before the clock
    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total seconds of the headline queries", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
