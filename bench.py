"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` (default sf0.1), ``BENCH_CPUS`` (default 8), ``BENCH_RUNS`` (default 1).
Each query is run once to warm up, then timed; the value is the sum of medians.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "changeset_rollup",
    "enriched_changesets",
    "point_in_polygon_join",
    "daily_cells",
    "daily_cells_events",
    "weekly_chapters",
    "monthly_activity",
    "top15_countries",
    "coarse_cells_6",
    "tile_boxes",
    "public_rollup",
)


def main() -> None:
    from editpulse.checks.registry import QUERIES
    from editpulse.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
