"""Benchmark: run the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]
and print one JSON line with per-query seconds.

Each query is executed completely through the ``noop`` sink (no collect to
the driver), after one warm-up run of the smallest query for JVM start-up."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["validate_rows", "canonicalize", "transaction_currency", "sku_uniqueness",
            "check_foreign_keys", "file_verdicts"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from sluice.session import build_session
    from sluice.plans.queries import QUERIES

    spark = build_session(f"local[{cpus}]", app="sluice-bench",
                          shuffle_partitions=int(cpus) * 2)
    names = [n for n in HEADLINE if n in QUERIES]
    QUERIES[names[0]](spark, sf_dir).write.format("noop").mode("overwrite").save()
    timings = {}
    for name in names:
        t = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t, 3)
        spark.catalog.clearCache()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
