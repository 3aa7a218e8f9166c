"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3 timed
runs after one warm-up; the median counts), BENCH_QUERIES (comma-separated, default HEADLINE).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "curated_status",
    "dead_letter_counts",
    "latest_state",
    "latest_enriched",
    "hourly_aggregate",
    "hourly_well_covered",
    "staged_disruptions",
    "disruption_sections",
    "stations_near_disruptions",
    "impact_comparison",
    "impact_map",
    "ring_comparison",
    "replay_summary",
    "quality_report",
]


def main() -> None:
    from kerbside.session import build_session
    from kerbside.workload import registry

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = build_session(
        "kerbside-bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = registry.queries()

    def once(name: str) -> float:
        start = time.perf_counter()
        registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)

    rows = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    print(
        json.dumps(
            {
                "metric": "headline query time, warm median",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cores": int(cpus),
                "spark": spark.version,
                "shuffle_partitions": int(cpus),
                "flatten_rows_per_sec": round(2 * rows / seconds["curated_status"]) if "curated_status" in seconds else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
