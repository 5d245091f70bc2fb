"""What several operators share: tables, frozen intermediate results, word chunks with a memo."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_uri


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def freeze(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: lineage ends here, and whatever was
    decided by row order inside a task stays decided when an executor is lost."""
    spark = df.sparkSession
    uri = scratch_uri(spark, name)
    df.write.parquet(uri)
    return spark.read.schema(df.schema).parquet(uri)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def rank_within(df: DataFrame, group: str, order: list[str], rank: str, rows: int) -> DataFrame:
    """Number the rows of each group from 0 without bringing a group together.

    Rows are dealt into hash buckets; a bucket numbers its own rows, and starts where the buckets
    before it in the same group end. A group of a third of all rows is spread over all buckets.
    `rows` sizes the buckets only. Rows equal in `order` are interchangeable."""
    from pyspark.sql import Window as W

    buckets = max(16, -(-rows // 100_000))
    dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    starts = (
        dealt.groupBy(group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn(
            "_start",
            F.sum("_n").over(W.partitionBy(group).orderBy("_bucket")) - F.col("_n"),
        )
        .drop("_n")
    )
    own = F.row_number().over(W.partitionBy(group, "_bucket").orderBy(*order)) - 1
    return (
        dealt.withColumn("_own", own)
        .join(starts, [group, "_bucket"])
        .withColumn(rank, (F.col("_own") + F.col("_start")).cast("bigint"))
        .drop("_own", "_start", "_bucket")
    )


class Memo(dict):
    """What a function gives for chunks of text, kept for up to `bound` chunks.

    The bound only decides how often a value is computed again."""

    def __init__(self, function: Callable[[str], object], bound: int = 300_000):
        super().__init__()
        self.function, self.bound = function, bound

    def __missing__(self, chunk: str):
        if len(self) >= self.bound:
            self.clear()
        value = self[chunk] = self.function(chunk)
        return value


def slices(batches, rows: int = 1000):
    """Arrow batches cut to `rows` rows, so that Python holds few texts at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def in_batches(texts: list[str], chars: int = 4_000_000):
    """Ranges of consecutive texts of about so many characters, one text at least."""
    begin, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= chars:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)
