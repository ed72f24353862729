"""Benchmark the headline queries.

Runs on ``local[$BENCH_CPUS]`` against ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) and prints one JSON line.  Each query runs three times
in one session (nothing cached, scan included); the median is reported.
Before timing, every query runs once on the smallest scale factor
(``$BENCH_WARMUP_DIR``, default the sibling ``sf0.001`` folder; other data,
nothing cached) so that code generation and JIT warm-up are not timed; set
``BENCH_WARMUP_DIR=none`` for cold first runs.  The JSON line says which.
The two marts with a published yardstick (standings, per-game) collect their
result like the yardstick did; the others run to completion through the
``noop`` sink (full execution, no driver transfer).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidewater.plans.registry import runner  # noqa: E402
from tidewater.session import local_session  # noqa: E402

COLLECT = ("fact_standings", "fact_per_game", "per_game_core")
HEADLINE = (
    "fact_standings", "fact_per_game", "per_game_core", "fact_standings_by_season", "dim_games", "dim_players",
    "dedupe_latest", "top_n_per_group", "listagg_limited", "inc_merge_clauses", "inc_delete_insert",
    "snapshot_new_record", "dq_aggregated_unique", "column_profile", "date_diff_parts",
    "resultset_rows", "page_list_rows", "page_links",
)


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    df = runner(name)(spark, sf_dir)
    if name in COLLECT:
        df.collect()
    else:
        df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    names = sys.argv[1:] or list(HEADLINE)
    spark = local_session(cores=cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "8")))
    spark.range(1000).selectExpr("sum(id)").collect()
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001"))
    warmed = warm_dir if warm_dir != "none" and os.path.isdir(warm_dir) else None
    if warmed:
        for name in names:
            run_once(spark, name, warmed)
    per_query = {}
    for name in names:
        times = [run_once(spark, name, sf_dir) for _ in range(reps)]
        per_query[name] = round(statistics.median(times), 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    out = {"metric": "total_median_sec", "value": round(sum(per_query.values()), 3), "unit": "sec",
           "queries": per_query, "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
           "cpus": cpus, "reps": reps, "warmup": warmed or "none"}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
