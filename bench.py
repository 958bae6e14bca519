"""Benchmark: run every catalogue query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (all rows produced, nothing
collected to the driver). A short warm-up, then the median of at most $BENCH_REPEATS runs
per query, as many as begin within MAX_QUERY_SECONDS. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from branchlens.plans.catalog import QUERIES  # noqa: E402
from branchlens.session import build_session  # noqa: E402


MAX_QUERY_SECONDS = 20.0


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": "16g"})
    names = [n for n in QUERIES if not only or n in only]
    # Warm-up (JIT, code generation, file listing) on one query of each operator family.
    for n in ("lines_enriched", "product_totals", "branch_kpis", "top_products", "daily_reconciliation",
              "bookings_clean", "dedupe_lines", "json_sales_flat", "payments_live"):
        run(QUERIES[n](spark, sf_dir))
    times = {}
    for n in names:
        samples = []
        for _ in range(repeats):
            spark.catalog.clearCache()  # no repeat may profit from what an earlier one left
            t0 = time.perf_counter()
            run(QUERIES[n](spark, sf_dir))
            samples.append(time.perf_counter() - t0)
            if sum(samples) > MAX_QUERY_SECONDS:  # long queries (commits, streams) are not repeated
                break
        times[n] = round(statistics.median(samples), 4)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": cpus, "repeats": repeats, "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
