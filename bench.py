"""Benchmark the headline queries.

Runs each query of HEADLINE at $BENCH_SF_DIR (default /root/testdata/sf0.1)
on local[$BENCH_CPUS], materialising the full result with a ``noop`` write.
One warm-up round, then the median of $BENCH_REPEAT runs per query.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cdrflow.plans.reports import QUERIES  # noqa: E402
from cdrflow.session import build_session  # noqa: E402

HEADLINE = [
    "standard_rows",      # scan, as-of format choice, parse (J03, P05-P08)
    "format_rejects",     # quarantine (P14)
    "page_hits",          # flagship count (A05)
    "bucket_counts",      # hourly usage (A04, F16)
    "new_user_ids",       # anti join + distributed dense ids (J01, W01)
    "new_page_ids",       # (J02, W02)
    "enriched_rows",      # both substitutions + text form (J04, J05, S11)
    "dim_two_batches",    # dictionary over two batches (T03)
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")}
    spark = build_session(f"local[{cpus}]", app="cdrflow-bench", shuffle_partitions=cpus, extra=extra)
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for name in HEADLINE:
        run(name)
    results = {name: round(statistics.median(run(name) for _ in range(repeat)), 3)
               for name in HEADLINE}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_total_median",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
        "repeat": repeat,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
