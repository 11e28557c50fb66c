"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries": {name: sec}, "sf", ...}.
Each query is fully executed (written to a no-op sink), not just planned.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Observation  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from stopwise.plans import registry  # noqa: E402
from stopwise.session import build_session  # noqa: E402

HEADLINE = [
    "detect_arrivals",        # flagship: windows + array lookup
    "arrival_events",
    "stop_passages",
    "vehicle_state",
    "ingest_positions",       # two de-dup scans + record
    "dedup_vehicle_ts",
    "merge_stop_times",       # widest remap
    "merge_gtfs",             # the whole merge
    "merge_transfers",        # six left joins + surrogate keys
    "trip_runtime",           # geometry: densify + project stops
    "arrivals_from_positions",  # raw coordinates to arrivals
    "project_along",          # projection alone
    "stream_arrivals",        # keyed state over ordered micro-batches
    "latest_positions",
    "federated_sql",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = build_session(f"local[{cpus}]", app="stopwise-bench", shuffle_partitions=int(os.environ.get("BENCH_PARTITIONS", cpus * 2)),
                          extra={"spark.driver.memory": "16g"})
    registry.load_all()
    names = [n for n in HEADLINE if n in registry.QUERIES]
    times: dict[str, float] = {}
    rows: dict[str, int] = {}
    # Warm-up, not counted: JVM class loading and parquet footers, and the Python workers
    # that Arrow UDFs use (on the smallest tables, so no headline data is cached).
    registry.QUERIES["vehicle_progress"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(small):
        registry.QUERIES["geodesic_direct"](spark, small).write.format("noop").mode("overwrite").save()
    for n in names:
        t0 = time.perf_counter()
        df = registry.QUERIES[n](spark, sf_dir)
        # The row count rides along with the one execution (no second job, no pruned plan).
        obs = Observation(f"rows_{n}")
        df.observe(obs, F.count(F.lit(1)).alias("rows")).write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)
        rows[n] = int(obs.get["rows"])
    total = round(sum(times.values()), 3)
    rate = {n: round(rows[n] / times[n]) for n in names if times[n] > 0}
    print(json.dumps({"metric": "headline_total_wall", "value": total, "unit": "sec", "queries": times,
                      "sf": sf, "cpus": cpus, "rows": rows, "rows_per_sec": rate}))
    spark.stop()


if __name__ == "__main__":
    main()
