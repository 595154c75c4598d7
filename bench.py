"""Time the headline queries; prints one JSON line.

Each query runs once to warm up and is then timed; the whole result is computed and
thrown away (``noop`` sink).  ``value`` is the sum over the queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from contract import QUERIES  # noqa: E402
from feedlake.session import build_session  # noqa: E402

HEADLINE = (
    "growth_rate", "volume_by_source", "volume_by_week", "volume_by_month", "volume_rollups", "hourly_activity",
    "remapping_stats", "content_stats", "extended_summary", "trending_keywords", "cross_source_keywords",
    "heatmap_source_hour", "sql_volume_7d", "sql_top_keywords", "clean_html", "tag_keywords", "rewrite_content",
    "tag_by_join", "remap_by_join", "normalize_bluesky", "transform_posts", "dedup_posts", "exclude_seen", "stream_dedup",
    "stream_enrich", "build_curated",
)
RUNS = int(os.environ.get("BENCH_RUNS", "1"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "*")
    only = os.environ.get("BENCH_QUERIES")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": "8" if cpus == "*" else cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.feedlake.inputPartitions": "8" if cpus == "*" else cpus,  # the given tables have one row group
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in only.split(",") if only else HEADLINE:
        best = None
        for run in range(RUNS + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            if run:
                best = took if best is None else min(best, took)
        times[name] = round(best, 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
