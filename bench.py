"""Headline-query benchmark.

Runs the main pipelines at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS] and prints one JSON line.  Each query is executed in full
through the ``noop`` sink (no collect).  Before timing, every headline query
runs once on the smallest tables (other files, so no data is cached): this
warms the JVM and code generation the way a long-running cluster session is.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from treepref.plans import registry  # noqa: E402
from treepref.session import get_session  # noqa: E402

HEADLINE = {
    "pairs_from_ratings": "union_pairs",
    "conversations": "build_conversations",
    "pair_stats": "pair_stats",
    "candidate_values": "candidate_value",
    "search_vote": "answer_vote_value",
    "step_pairs": "distinct_pairs",
    "preference_eval": "preference_results",
    "math_accuracy": "accuracy_avg_any",
    "qa_ground_truth": "join_ground_truth",
    "split_exact": "split_exact",
    "normalize_documents": "normalize_answer",
    "judge_batch": "batch_judge",
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = get_session()
    registry.load_all()
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    for name in HEADLINE.values():
        registry.QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for label, name in HEADLINE.items():
        t0 = time.time()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[label] = round(time.time() - t0, 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": int(os.environ.get("BENCH_CPUS", "8"))}))


if __name__ == "__main__":
    main()
