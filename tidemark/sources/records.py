"""Typed tables as record streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def records_from_table(df: DataFrame, *columns: str | Column, ord: str | None = None) -> DataFrame:
    """A ``rec`` struct of the given columns (all by default), and ``ord`` if a column gives it.

    Columns that a stream later drops are pruned from the scan."""
    rec = F.struct(*(columns or df.columns)).alias("rec")
    if ord is not None:
        return df.select(F.col(ord).cast("bigint").alias("ord"), rec)
    # Numbered below the struct, so that selects over its fields still fold into the scan.
    return df.withColumn("ord", F.monotonically_increasing_id()).select("ord", rec)


def records_from_json(df: DataFrame, text: str | Column, ord: str | None = None) -> DataFrame:
    """A ``rec`` VARIANT parsed from JSON text.

    It comes out of a generator, below which no filter is pushed: a test on the record then reads the
    parsed value and does not parse the text a second time."""
    rec = F.explode(F.array(F.try_parse_json(F.col(text) if isinstance(text, str) else text)))
    kept = [] if ord is None else [F.col(ord).cast("bigint").alias("ord")]
    return df.select(*kept, rec.alias("rec"))
