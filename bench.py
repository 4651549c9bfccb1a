"""Times the headline queries and prints one JSON line.

The source and raw tables are made first and not timed. All queries are run twice to warm up, then
BENCH_RUNS times in turn; the median of each counts. Whole jobs, with their writes, are timed once each, with and without
an index of the raw table, and don't count in the value.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from adstrata import queries, samples  # noqa: E402
from adstrata.plans import ingest, refresh  # noqa: E402
from adstrata.session import build_session, staging_path  # noqa: E402
from adstrata.sources.tables import TableRef, append_raw, ensure_raw_table  # noqa: E402
from adstrata.sources.version_index import VersionIndex  # noqa: E402

HEADLINES = (
    "ingest_tracked_all",
    "ingest_window_last_shown",
    "ingest_targeted",
    "ingest_targeted_tables",
    "media_links",
    "media_counters",
    "code_check",
    "latest_version",
    "version_history",
    "mart_creatives",
)


WARM_UP = 2


def jobs(spark, sf_dir: str, indexed: bool) -> dict[str, float]:
    """A window load, a refresh with new versions, and one with nothing new, into a raw table with a history."""
    tables = [TableRef(f"bench_{label}_{indexed}", staging_path(spark, label)) for label in ("raw", "digests")]
    target = ingest.Target(raw=tables[0], market=queries.MARKET, granularity="month", index=VersionIndex(*tables) if indexed else None)
    ensure_raw_table(spark, target.raw)
    append_raw(samples.raw_history(spark, sf_dir), target.raw)
    if target.index:
        target.index.ensure(spark)
    source, tracking = samples.creative_stats(spark, sf_dir), samples.advertisers_tracking(spark, sf_dir)
    runs = {
        "window": lambda: ingest.backfill(spark, source, target, tracking, *queries.WINDOW, gate="same_as_insert"),
        "refresh": lambda: refresh.refresh(spark, "all", source, tracking, target),
        "refresh_nothing_new": lambda: refresh.refresh(spark, "all", source, tracking, target),
    }
    taken = {}
    for name, run in runs.items():
        start = time.perf_counter()
        run()
        taken[f"{name}_indexed" if indexed else name] = round(time.perf_counter() - start, 3)
    return taken


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    start = time.perf_counter()
    samples.raw_versions(spark, sf_dir)
    setup = time.perf_counter() - start
    registered = queries.registered()
    taken: dict[str, list[float]] = {name: [] for name in HEADLINES}
    for _ in range(WARM_UP + runs):
        for name in HEADLINES:
            start = time.perf_counter()
            registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken[name].append(time.perf_counter() - start)
    times = {name: round(statistics.median(seconds[WARM_UP:]), 3) for name, seconds in taken.items()}
    report = {
        "metric": "sum of median query times",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
        "setup_sec": round(setup, 3),
        "jobs": {**jobs(spark, sf_dir, False), **jobs(spark, sf_dir, True)},
    }
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()
