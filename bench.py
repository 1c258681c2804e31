"""Time the headline queries: one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the cores. Results go to a sink
that reads every row and keeps none.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stayflow.catalog import QUERIES  # noqa: E402
from stayflow.session import build_session  # noqa: E402

HEADLINE = [
    "stay_nights",
    "daily_snapshot",
    "rooms_on_books",
    "pickup_metric",
    "pickup_rooms_multi",
    "cancellations_7d",
    "last_status",
    "status_by_segment",
    "parse_event",
    "route_events",
    "resolve_identifier",
    "classify_responses",
    "transform_reservation",
    "merge_core",
    "insert_if_absent",
    "register_events",
    "fifo_prefix",
    "stage_latency",
    "daily_tables",
    "stream_dedup",
    "stream_enrich",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["rooms_on_books"](spark, sf_dir).count()  # start-up cost is not a query's
    took = {}
    for name in HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - started, 3)
    total = round(sum(took.values()), 3)
    print(json.dumps({"metric": "headline queries, total", "value": total, "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
