"""Time the headline queries at $BENCH_SF_DIR and print one JSON line.

Each query runs once to warm the JVM and is then timed as a full execution (write to the no-op sink). ``first_runs`` has
the times of the first runs: those of searches include the building of their stored index.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from lampyris.catalog import load_all  # noqa: E402
from lampyris.session import build_session  # noqa: E402

HEADLINE = [
    "faulty_nearest_supplier",
    "nearest_supplier",
    "knn_join",
    "supplier_coverage_counts",
    "supplier_coverage_bands",
    "zone_nearest_supplier",
    "zone_stats",
    "spatial_join_within",
    "spatial_join_dwithin",
    "uncovered_lights",
    "lights_near_center",
    "lights_enriched",
    "requests_enriched",
    "highest_risk_lights",
    "issue_resolution",
    "seasonal_patterns",
    "hazard_text_search",
    "requests_by_zone",
    "lights_by_urban_class",
    "rolling_features",
    "rolling_features_by_zone",
    "forecast_30d",
    "forecast_comparison",
    "monthly_budget",
    "search",
    "search_scan",
    "search_documents",
    "build_index",
    "vector_search",
    "apply_changes",
    "stream_apply",
    "stream_daily_counts",
    "check_fk",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:] or HEADLINE
    spark = build_session("bench", cores=cpus, spark__sql__shuffle__partitions=cpus)
    registry = load_all()
    times: dict[str, float] = {}
    first: dict[str, float] = {}
    for key in wanted:
        run = registry[key].run
        for attempt in range(2):
            start = time.perf_counter()
            run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[key] = round(time.perf_counter() - start, 4)
            first.setdefault(key, times[key])
    print(
        json.dumps(
            {
                "metric": "total_wall_clock",
                "value": round(sum(times.values()), 4),
                "unit": "sec",
                "queries": times,
                "first_runs": first,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
