"""Benchmark: run the registered queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
(of those over a freshly built store three, unless they are named).

Each query is executed in full through the ``noop`` sink (all rows computed,
nothing collected to the driver) and timed; prints ONE JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

    BENCH_SF_DIR=/root/testdata/sf0.01 python bench.py [name ...]
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main(argv: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from quartier.plans.catalog import QUERIES, load_all
    from quartier.session import get_session

    load_all()
    spark = get_session(f"local[{cpus}]", app="quartier-bench", shuffle_partitions=cpus,
                        extra={"spark.driver.memory": "8g"})
    from quartier.sources import fixtures
    fixtures.readings(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up

    # queries over the store build it from the events first, each the same way: one
    # of each kind stands for them, the others run when named
    built = ("store_rollup", "store_tsquery", "store_retention")
    names = argv or [n for n in QUERIES if not n.startswith("store_") or n in built]
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({"metric": "total_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
