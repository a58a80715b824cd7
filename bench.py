"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the number of local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from jobmill.plans import catalog  # noqa: E402
from jobmill.session import local_session  # noqa: E402

HEADLINE = [
    "classified_postings",
    "c2_infer_roles",
    "c5_classify_experience",
    "c6_early_career",
    "c8_staged_filter",
    "c12_normalize_posting",
    "t2_strip_html",
    "t9_dedupe_text",
    "d3_dedupe_across_sources",
    "d5_match_keys",
    "d6_greedy_dedupe",
    "m1_merge_snapshot",
    "m4_retirement_guards",
    "m5_retire",
    "a5_gate_stats",
    "r1_reclassify_roles",
    "f3_search_ranked",
    "f5_alert_digest",
    "e2_embedding_queue",
    "e9_score_matches",
    "e10_vector_topk",
    "b1_extract_board_slugs",
    "s1_greenhouse",
    "s2_repeated_company_table",
    "s3_personio",
    "s7_comment_thread",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "jobmill-bench")
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/orders.parquet").count()
    times = {}
    for name in HEADLINE:
        started = time.perf_counter()
        catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    total = round(sum(times.values()), 3)
    scale = Path(folder).name.removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": total,
                "unit": "sec",
                "queries": times,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
