"""Time the headline queries: BENCH_SF_DIR (default sf0.1) on local[BENCH_CPUS].

Prints one JSON line. Every query is run in full into a sink that keeps nothing; the best of
``BENCH_RUNS`` (default 2) runs counts.
"""

from __future__ import annotations

import json
import os
import time

from collartrail.session import build_session
from workload.queries import QUERIES

HEADLINE = [
    "fixes_window",
    "step_lengths",
    "run_stats",
    "defunct_flags_terminal",
    "defunct_flags_all",
    "mortality_dates",
    "mortality_from_fixes",
    "apply_mortality",
    "utm_projection",
    "movement_paths",
    "base_fixes",
    "parse_video_paths",
    "life_phase",
    "earliest_fixes",
    "pair_exact",
    "pair_approx",
    "pair_videos",
    "pair_videos_staged",
    "copy_manifest",
    "videos_per_class",
    "fix_layers",
    "fix_video_layers",
    "mortality_layers",
    "video_metadata_csv",
    "append_full_join",
    "scan_mounted_videos",
    "organised_layers",
    "mortality_review",
    "read_landed_fixes",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/events.parquet").write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
