"""Benchmark the headline queries and the builds.

Runs each query at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS] into Spark's ``noop`` sink (no collect), and the builds
from landed JSON into fresh folders.  One untimed round warms every query up;
then the queries run in turn, $BENCH_REPS rounds, and the median of each is
reported, so that no query gains from standing late in the list.  The builds
and the stream, which take as long as all queries, run once at the end.
Prints one JSON line.
"""
from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from clipstar.plans import adapters, landed  # noqa: E402
from clipstar.plans.landed import EVENT_SPLIT_DATE  # noqa: E402
from clipstar.plans.build import full_rebuild, incremental_update  # noqa: E402
from clipstar.plans.registry import QUERIES, load_all  # noqa: E402
from clipstar.schemas import EVENT_DATASET, MEDIA_DATASET  # noqa: E402
from clipstar.session import get_session, scratch_path  # noqa: E402
from clipstar.sources.landing import land_json, read_media_snapshots, read_visitor_events  # noqa: E402

HEADLINE = [
    "silver_visitor_events", "dim_media_channel", "dim_visitor", "fact_media_engagement",
    "kpi_summary", "engagement_by_media", "daily_plays_trend", "visitor_geography",
    "top_countries", "incremental_new_events", "checkpoint_advance", "late_events_audit",
]
STREAMS = ["stream_fact"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    spark = get_session(f"local[{cpus}]", app_name="clipstar-bench", conf={
        "spark.sql.shuffle.partitions": str(int(cpus) * 2),
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    load_all()
    root = landed.landing_root(spark, sf_dir)
    mapping = adapters.channel_mapping(spark, sf_dir)

    # The landing zone in two parts, for an increment.
    first, second = scratch_path(spark, "bench-a"), scratch_path(spark, "bench-b")
    media, events = read_media_snapshots(spark, root), read_visitor_events(spark, root)
    for part, where in ((first, "load_date < DATE '{}'"), (second, "load_date >= DATE '{}'")):
        land_json(events.where(where.format(EVENT_SPLIT_DATE)), part, EVENT_DATASET)
        land_json(media.where(where.format("1998-01-01")), part, MEDIA_DATASET)
    base = full_rebuild(spark, first, scratch_path(spark, "bench-base"), channel_mapping=mapping).root

    def query(name: str) -> Callable[[], None]:
        return lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    def timed(run: Callable[[], object]) -> float:
        began = time.perf_counter()
        run()
        return time.perf_counter() - began

    runs: dict[str, list[float]] = {name: [] for name in HEADLINE}
    for round_ in range(reps + 1):
        for name in HEADLINE:
            seconds = timed(query(name))
            if round_:
                runs[name].append(seconds)
    runs["build_full"] = [timed(lambda: full_rebuild(spark, root, scratch_path(spark, "bench-full"),
                                                     channel_mapping=mapping))]
    runs["build_increment"] = [timed(lambda: incremental_update(spark, second, base, channel_mapping=mapping))]
    for name in STREAMS:
        runs[name] = [timed(query(name))]
    results = {name: round(statistics.median(r), 3) for name, r in runs.items()}
    total = round(sum(results[name] for name in HEADLINE), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": results,
                      "sf": Path(sf_dir).name.removeprefix("sf"), "cpus": int(cpus), "reps": reps}))
    spark.stop()


if __name__ == "__main__":
    main()
