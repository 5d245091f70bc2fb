"""Counts of a run, over written outcomes or observed while they are written."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.operators.outcomes import EMITTED, FILTERED, INVALID, REJECTED, TRANSFORM_FAILED


def _counts() -> list[Column]:
    n = lambda o: F.count_if(F.col("outcome") == o).alias(o)
    return [F.count("*").alias("processed"), n(EMITTED), n(FILTERED), n(INVALID), n(TRANSFORM_FAILED)]


_OUTCOMES = (EMITTED, FILTERED, INVALID, TRANSFORM_FAILED, REJECTED)


def observed(outcomes: DataFrame, streams: Sequence[str] = ()) -> tuple[DataFrame, Observation]:
    """The outcomes, and their counts once an action has run over them: no pass of their own.

    Counts are those of tasks that succeeded, each partition once, as long as nothing is shuffled
    behind the outcomes. With ``streams`` there are counts of each."""
    counts, columns = Observation("run metrics"), []
    for i, stream in enumerate(streams or ("",)):
        own = F.col("stream") == stream if streams else F.lit(True)
        columns.append(F.count_if(own).alias(f"{i}_processed"))
        columns += [F.count_if(own & (F.col("outcome") == o)).alias(f"{i}_{o}") for o in _OUTCOMES]
    counts.streams = tuple(streams)
    return outcomes.observe(counts, *columns), counts


def metrics_of(counts: Observation, stream: str | None = None) -> dict:
    """Counts, of a stream if it is named, as run_metrics gives them, with those of lines that give no record."""
    i = counts.streams.index(stream) if stream is not None else 0
    got = {o: counts.get[f"{i}_{o}"] for o in ("processed", *_OUTCOMES)}
    return got | {"not_emitted_total": got["processed"] - got[EMITTED]}


def run_metrics(outcomes: DataFrame, duration_s: float | None = None) -> DataFrame:
    """One row of counts over an ``outcome`` column, and the rate if the duration is given."""
    counts = outcomes.agg(*_counts())
    total = F.col(FILTERED) + F.col(INVALID) + F.col(TRANSFORM_FAILED)
    counts = counts.withColumn("not_emitted_total", total)
    if duration_s is None:
        return counts
    rate = F.col("processed") / F.lit(float(duration_s)) if duration_s > 0 else F.lit(0.0)
    return counts.withColumns(
        {"duration_s": F.lit(float(duration_s)), "processed_per_second": rate}
    )
