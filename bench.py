"""Bench: time every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

The star warehouse (the six-table source join written as a month-partitioned
fact table) is built first and timed as ``warehouse_build`` (reused when the
shared scratch folder already holds it for the same inputs). Each query is then
warm-up), executed to completion through the no-op sink. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [k for k in os.environ.get("BENCH_QUERIES", "").split(",") if k]
    from branchbook.plans import catalog
    from branchbook.session import local_session
    from branchbook.sources.star import star

    spark = local_session(cores=cpus, shuffle_partitions=int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    catalog.load_all()

    timings: dict[str, float] = {}
    t0 = time.time()
    star(spark, sf_dir).build_fact()
    timings["warehouse_build"] = round(time.time() - t0, 3)

    keys = only or list(catalog.QUERIES)
    for k in keys:
        fn = catalog.QUERIES[k]
        try:
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
            t = time.time()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            timings[k] = round(time.time() - t, 3)
        except Exception as exc:  # noqa: BLE001 - report and go on
            print(f"bench: {k} failed: {exc}", file=sys.stderr)
    total = round(sum(timings.values()), 3)  # the build included
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "total_query_sec", "value": total, "unit": "sec", "queries": timings, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
