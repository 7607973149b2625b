"""Time the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from legmeter.catalog.queries import QUERIES  # noqa: E402
from legmeter.session import build_session  # noqa: E402

HEADLINE = [
    "legs_market",
    "legs_water",
    "food_order_info",
    "artisan_order_info",
    "refill_info",
    "price_legs_table",
    "price_legs_haversine",
    "legs_with_return",
    "trip_legs_food",
    "finalize_market",
    "finalize_food",
    "upsert_market",
    "upsert_route",
    "market_missing",
    "water_missing",
    "food_missing",
    "artisan_missing",
    "predict_missing_market",
    "gps_distance_info",
    "gps_routes",
    "route_points",
    "route_retention",
    "partner_export",
    "water_km_capped",
    "run_osrm",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="8g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start the JVM's and the Python workers' machinery before the clock runs.
    for name in ("water_km_capped", "route_points"):
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        started = time.perf_counter()
        # Building the plan counts: it may look at the data to decide on splitting large groups.
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
