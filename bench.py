"""Time the queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Every query is built and run to a no-op sink: one warm-up, then the median of
``$BENCH_RUNS`` runs (default 2). Query names as arguments restrict the run. Beside them
stands the time of one fixed piece of work (``reference_sec``, the median of three runs, not part
of the total): divide by it to compare runs on machines of different speed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from starloom.catalog import ALL  # noqa: E402
from starloom.session import build_session  # noqa: E402

HEADLINE = [
    "trip_fact", "crash_dim", "vendor_crash_count", "vendor_top_factors", "any_key_join_trips",
    "locate_points_in_areas", "songs_dim", "artists_dim", "users_dim_latest", "time_dim",
    "songplays_by_title", "songplays_by_artist", "songplays_left", "songplays_new_only",
    "songplays_dense_key", "dense_id_orders", "users_new_only", "top_songs_by_artist",
    "session_music", "song_per_session", "song_listen_history", "upsert_status",
    "quality_report", "duplicate_line_keys", "json_path_stage", "partitioned_write", "csv_merge",
    "identity_over_loads", "bucketed_lookup", "insert_new_by_bucket", "geojson_two_files",
]


def reference_seconds(spark) -> float:
    """Arithmetic and one shuffle over generated numbers, the same on every machine."""
    seconds = []
    for _ in range(4):
        began = time.perf_counter()
        numbers = spark.range(0, 40_000_000, 1, 8).selectExpr("id % 1000 AS k", "xxhash64(id) % 7919 AS v")
        numbers.groupBy("k").sum("v").write.format("noop").mode("overwrite").save()
        seconds.append(time.perf_counter() - began)
    return round(statistics.median(seconds[1:]), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        seconds = []
        for _ in range(runs + 1):
            began = time.perf_counter()
            ALL[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds.append(time.perf_counter() - began)
            spark.catalog.clearCache()
        timings[name] = round(statistics.median(seconds[1:]), 3)
        print(f"{name}: {timings[name]} (first {seconds[0]:.2f})", file=sys.stderr, flush=True)
    reference = reference_seconds(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(Path(sf_dir).name.removeprefix("sf") or 0),
                "reference_sec": reference,
            }
        )
    )


if __name__ == "__main__":
    main()
