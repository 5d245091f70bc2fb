"""Incremental runs over arriving files: one micro-batch is one run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark.config import StreamConfig
from tidemark.plans.run import run_discover, run_extract
from tidemark.sources.store import Store

Parse = Callable[[DataFrame], DataFrame]


def _extract_batch(
    batch: DataFrame, batch_id: int, cfg: StreamConfig, store: Store, checkpoint: str, refresh: bool
) -> None:
    """Run one micro-batch. A replayed batch compares with the version before its own and writes its
    own again, so its records come out as they did the first time."""
    info = store.of(cfg.stream_name).bookmark.info()
    replay = info is not None and (info.get("query"), info.get("batch_id")) == (checkpoint, batch_id)
    if replay:
        version, previous = info["version"], info["previous"]
        run_ts = info["last_extraction_started_at"]
    else:
        previous = 0 if info is None else info["version"]
        version, run_ts = previous + 1, None
    run_extract(
        batch, cfg, store, run_ts=run_ts, refresh=refresh, version=version, previous=previous,
        replay=replay, query=checkpoint, batch_id=batch_id,
    )


def stream_changes(
    arriving: DataFrame,
    cfg: StreamConfig,
    store: Store,
    checkpoint: str,
    parse: Parse = lambda df: df,
    refresh: bool = False,
) -> StreamingQuery:
    """Extract each micro-batch of a stream and stop when all that has arrived is done.

    ``parse`` turns a raw batch into records: jsonl_parsed for lines of text and csv_parsed for CSV keep
    the lines that give none for the rejects of the run, jsonl_rows and csv_rows leave them out."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        _extract_batch(parse(batch), batch_id, cfg, store, checkpoint, refresh)

    return _start(arriving, checkpoint, on_batch)


def stream_discover(
    arriving: DataFrame,
    cfg: StreamConfig,
    store: Store,
    checkpoint: str,
    parse: Parse = lambda df: df,
) -> StreamingQuery:
    """Merge the schema of each micro-batch into the catalog. A replayed batch changes nothing, since
    known paths keep what they have."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        run_discover(parse(batch), cfg, store, needs_records=False)

    return _start(arriving, checkpoint, on_batch)


def _start(
    arriving: DataFrame, checkpoint: str, on_batch: Callable[[DataFrame, int], None]
) -> StreamingQuery:
    return (
        arriving.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
