"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query reads its landed inputs and earlier tables as written ones, runs once
to warm up, and is timed as the median of three runs into a no-op sink.
``rebuild_and_gate`` forgets everything written and builds all seven tables from
the raw ones, then runs the whole-database gate.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans import registry, store  # noqa: E402
from tidemark.session import local_session  # noqa: E402

HEADLINES = [
    "b2_daily_market_data", "b3_market_outcomes", "b4_asset_regimes", "b5_macro_conditions", "b6_scheduled_events",
    "b7_calendar_context", "a2_symbol_coverage", "h1_gap_findings", "h2_freshness", "v13_whole_gate", "a11_block_digest",
    "a12_database_digest", "q3_page", "j4_as_of_state", "w4_drawdown_on_ticks", "w15_moving_average_on_ticks",
    "w19_expanding_rank_on_ticks", "s8_artifact_scan", "j19_snapshot_verification", "k1_partition_upsert",
    "b2_daily_by_supplier", "b3_outcomes_by_supplier", "b4_regimes_by_supplier", "a2_coverage_by_supplier", "q3_page_by_supplier",
    "q3_deep_page_by_supplier", "a11_ordered_digest", "k2_partial_upsert_of_rows",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn) -> float:
    t = time.perf_counter()
    fn()
    return time.perf_counter() - t


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = local_session(cpus, "tidemark-bench", shuffle=int(cpus))
    registry.load()
    times: dict[str, float] = {}

    def rebuild() -> None:
        store.forget()
        run(registry.QUERIES["v13_whole_gate"](spark, sf))

    rebuild()
    times["rebuild_and_gate"] = round(timed(rebuild), 3)
    for name in HEADLINES:
        query = registry.QUERIES[name]
        run(query(spark, sf))
        times[name] = round(statistics.median(timed(lambda: run(query(spark, sf))) for _ in range(3)), 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({
        "metric": "headline queries, total", "value": total, "unit": "sec", "queries": times, "sf": os.path.basename(sf),
        "cpus": cpus, "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
