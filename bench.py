"""Headline workloads at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each run writes all of its output: outcomes, messages, rejects, bookmark and metrics. The times are
for whole runs after one small warm-up run."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F

import derived as X
from tidemark.operators import bookmark as B
from tidemark.operators.catalog import catalog_from_schema
from tidemark.plans import run as R
from tidemark.session import build_session, scratch_uri
from tidemark.sources.records import records_from_json
from tidemark.sources.store import Store, write_bookmark, write_catalog

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def main() -> None:
    spark = build_session(
        f"local[{CPUS}]",
        "bench",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    rates: dict[str, float] = {}

    def timed(name: str, rows: int, work) -> None:
        start = time.perf_counter()
        work()
        times[name] = round(time.perf_counter() - start, 3)
        rates[name] = round(rows / times[name])

    def fresh(bookmark=None) -> Store:
        store = Store(spark, scratch_uri(spark, "bench"))
        write_catalog(spark, store.uri, catalog_from_schema(spark, "orders", X.ORDERS_SCHEMA))
        if bookmark is not None:
            write_bookmark(spark, store.uri, bookmark)
        return store

    # Each table is one file with one row group, hence one split. Spread what is read over the cores.
    splits = int(CPUS)

    def spread_lines(lines, ord_: str):
        return records_from_json(lines.repartition(splits), "value", ord=ord_)

    def extract(store: Store) -> None:
        R.run_extract(X.orders_stream(spark, SF_DIR, splits), X.ORDERS, store, X.RUN_TS)

    small = SF_DIR if not os.path.isdir("/root/testdata/sf0.001") else "/root/testdata/sf0.001"
    warm = fresh(X.orders_bookmark(spark, small))
    R.run_extract(X.orders_stream(spark, small), X.ORDERS, warm, X.RUN_TS)
    R.run_discover(X.events_json(spark, small), X.EVENTS, fresh(), X.RUN_TS)

    orders = X.table(spark, SF_DIR, "orders").count()
    events = X.table(spark, SF_DIR, "events").count()

    cold = fresh()
    timed("extract_cold", orders, lambda: extract(cold))
    timed("extract_unchanged", orders, lambda: extract(cold))
    changed = fresh(X.orders_bookmark(spark, SF_DIR))
    timed("extract_third_changed", orders, lambda: extract(changed))
    timed(
        "refresh", orders,
        lambda: R.run_refresh(X.orders_stream(spark, SF_DIR, splits), X.ORDERS, changed, run_ts=X.RUN_TS),
    )
    timed(
        "extract_json_cold", orders,
        lambda: R.run_extract(
            spread_lines(X.orders_lines(spark, SF_DIR), "o_orderkey"), X.ORDERS, fresh(), X.RUN_TS
        ),
    )
    timed(
        "discover", events,
        lambda: R.run_discover(
            spread_lines(X.events_lines(spark, SF_DIR), "event_id"), X.EVENTS, fresh(), X.RUN_TS
        ),
    )

    bookmark = changed.of("orders").bookmark.read()
    updates = bookmark.select(
        "stream", "key", "surrogate_key", F.lit("2024-07-01T00:00:00Z").alias("ts"),
        F.lit(True).alias("emitted"), F.monotonically_increasing_id().alias("ord"),
    )
    merged = lambda: B.advance_bookmark(bookmark, B.fold_updates(updates)).write.parquet(
        scratch_uri(spark, "merged")
    )
    timed("bookmark_merge", orders, merged)

    print(
        json.dumps(
            {
                "metric": "total seconds of headline runs", "value": round(sum(times.values()), 3),
                "unit": "sec", "queries": times, "rows_per_sec": rates,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"), "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
