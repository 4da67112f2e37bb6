"""Benchmark: headline dedup queries on the driver tables.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Each query is timed from a fresh ``Run`` (no reuse between timings), end
to end, its result written to Spark's noop sink.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sameitem.session import get_session  # noqa: E402
from sameitem.plans import queries as Q  # noqa: E402

HEADLINE = [
    ("attributes", Q.q_attributes),
    ("candidate_pair_count", Q.q_candidate_pair_count),
    ("conflict_counts", Q.q_conflict_counts),
    ("match_decisions", Q.q_match_decisions),
    ("product_groups", Q.q_product_groups),
    ("evaluation_metrics", Q.q_evaluation_metrics),
    ("decision_counts", Q.q_decision_counts),
    ("document_attributes", Q.q_document_attributes),
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus))
    times: dict[str, float] = {}
    for name, fn in HEADLINE:
        t0 = time.time()
        df = fn(spark, sf_dir)
        # Every column of every row is computed; a count would let Spark drop most of the work.
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "dedup_headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
