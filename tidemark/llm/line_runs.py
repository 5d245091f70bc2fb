"""Line dedup over levelled sorted runs of line hashes.

Documents come in batches, newest first. The hashes of a batch's lines are folded to one row each and merged
against the runs of the batches before: a hash that no run holds was last seen in this batch, whose largest
document keeps the line. The batch then adds its own run: how many of its documents hold each hash, and who
keeps those that were new. A level that is full is compacted to one run of the next level, so a hash is written
again as often as there are levels.

A run is a bucketed table, sorted by hash, and all runs of a store have one bucket count. A batch is
exchanged once; the runs are merge-joined where they lie.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import freeze, text_or_empty
from tidemark.session import scratch_uri
from tidemark.sources.versions import Files

SPACE = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUN = "h1 bigint, h2 bigint, docs bigint, keeper bigint"
HASH = ["h1", "h2"]
#: Stands for a null id, as one document before all others.
NO_ID = -(1 << 63)


def two_hashes(*columns: Column) -> list[Column]:
    """128 bits: two 64-bit hashes under different seeds."""
    return [F.xxhash64(F.lit(seed), *columns) for seed in ("first", "second")]


@contextmanager
def _order_of_buckets(spark: SparkSession):
    """Let scans of bucketed tables say that a bucket of one file is sorted."""
    name = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


class LineRuns:
    """Runs of line hashes below one folder, level by level; `fan` runs of a level become one of the next."""

    def __init__(self, spark: SparkSession, uri: str, fan: int = 4, buckets: int | None = None):
        self.spark, self.uri, self.fan = spark, uri.rstrip("/"), fan
        self._files = Files(spark)
        state = self._files.read(f"{self.uri}/runs.json")
        state = json.loads(state) if state else {"buckets": buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), "runs": []}
        self.buckets, self.runs = state["buckets"], [tuple(run) for run in state["runs"]]

    def _table(self, name: str) -> DataFrame:
        """A run as a bucketed table, made known to this session where it isn't."""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({RUN}) USING parquet CLUSTERED BY (h1, h2) SORTED BY (h1, h2)"
            f" INTO {self.buckets} BUCKETS LOCATION '{self.uri}/{name}'"
        )
        return self.spark.table(name)

    def _write(self, df: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        (
            df.select("h1", "h2", "docs", "keeper").repartition(self.buckets, *HASH)
            .write.bucketBy(self.buckets, *HASH).sortBy(*HASH)
            .format("parquet").option("path", f"{self.uri}/{name}").saveAsTable(name)
        )
        return name

    def _commit(self, runs: list[tuple[int, str]]) -> None:
        self._files.replace(f"{self.uri}/runs.json", json.dumps({"buckets": self.buckets, "runs": runs}))
        for _, name in set(self.runs) - set(runs):
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.runs = runs

    def merged(self) -> DataFrame:
        """h1, h2, docs, keeper of every hash of the store."""
        out = self.spark.createDataFrame([], RUN)
        for _, name in self.runs:
            out = out.union(self._table(name))
        return out.groupBy(*HASH).agg(F.sum("docs").alias("docs"), F.max("keeper").alias("keeper"))

    def against(self, own: DataFrame) -> DataFrame:
        """`own` (h1, h2, docs, last) with the keeper of hashes that no run holds. A hash has one row with a
        keeper in all runs together, so each merge join gives as many rows as it takes."""
        out, held = own.repartition(self.buckets, *HASH), F.lit(False)
        for i, (_, name) in enumerate(self.runs):
            keepers = self._table(name).filter("keeper is not null").select(*HASH, F.lit(True).alias(f"_held{i}"))
            out = out.join(keepers.hint("merge"), HASH, "left")
            held = held | F.col(f"_held{i}").isNotNull()
        return out.select(*HASH, "docs", F.when(~held, F.col("last")).alias("keeper"))

    def add(self, lines: DataFrame) -> None:
        """Add the run of a batch of lines (h1, h2, doc). Documents of a batch are in no other, and those of
        later batches are smaller."""
        own = lines.groupBy(*HASH).agg(F.count_distinct("doc").alias("docs"), F.max("doc").alias("last"))
        with _order_of_buckets(self.spark):
            self._commit([*self.runs, (0, self._write(self.against(own)))])
            level = 0
            while len(full := [run for run in self.runs if run[0] == level]) >= self.fan:
                both = self._table(full[0][1])
                for _, name in full[1:]:
                    both = both.union(self._table(name))
                folded = both.groupBy(*HASH).agg(F.sum("docs").alias("docs"), F.max("keeper").alias("keeper"))
                self._commit([run for run in self.runs if run not in full] + [(level + 1, self._write(folded))])
                level += 1


def key_of(line: Column) -> Column:
    """A line of a text in lower case without white space at its ends."""
    return F.trim(line, F.lit(SPACE))


def long_lines(docs: DataFrame, least: int) -> DataFrame:
    """Row hashes, doc, pos and line hashes of the lines whose key has `least` code points and more."""
    text = F.translate(text_or_empty(), UPPER, LOWER)
    doc = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID))
    r1, r2 = two_hashes(F.col("doc_id").cast("bigint"), text_or_empty())
    lines = docs.select(r1.alias("r1"), r2.alias("r2"), doc.alias("doc"), F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    keys = lines.withColumn("line", key_of(F.col("line"))).filter(F.char_length("line") >= least)
    h1, h2 = two_hashes(F.col("line"))
    return keys.select("r1", "r2", "doc", "pos", h1.alias("h1"), h2.alias("h2"))


def without_lines(rows: DataFrame) -> DataFrame:
    """doc_id, text, n_lines, n_dropped of (doc_id, text, drops); drops are places of lines, or null."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, sizes, gone = [], [], []
            for text, drops in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                drops, lines = set(drops or ()), text.split(b"\n")
                texts.append(b"\n".join(x for i, x in enumerate(lines) if i not in drops) if drops else text)
                sizes.append(len(lines))
                gone.append(len(drops))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.binary()), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64())],
                names=["doc_id", "text", "n_lines", "n_dropped"],
            )

    out = rows.select("doc_id", F.col("text").cast("binary"), "drops")
    out = out.mapInArrow(cut, "doc_id bigint, text binary, n_lines bigint, n_dropped bigint")
    return out.withColumn("text", F.col("text").cast("string"))


def line_dedup(docs: DataFrame, least: int = 40, copies: int = 5, batches: int = 6, fan: int = 3, uri: str | None = None) -> DataFrame:
    """doc_id, text (lines that stay, joined by \\n), n_lines, n_dropped of every whole text, row by row.

    A line's key is the line in lower case (A-Z) without ASCII white space at its ends. Keys of `least`
    code points in `copies` documents lose their lines but in the largest doc_id. A null or empty text is one
    empty line. Rows with one id are one document, rows without an id are one before all others; repeated
    rows stay. Other columns are not read. An empty table gives an empty result. `batches` and `fan` decide the
    order of work alone. Without `uri` the runs lie in a new folder of the shared one."""
    spark = docs.sparkSession
    cuts = docs.select(
        F.percentile_approx(F.col("doc_id").cast("bigint"), [i / batches for i in range(1, batches)], 1000).alias("cuts")
    ).first().cuts
    batch = F.lit(0)
    for cut in cuts or ():
        batch = batch + F.when(F.col("doc") <= F.lit(cut), 1).otherwise(0)
    lines = freeze(long_lines(docs, least).withColumn("batch", batch), "lines")
    runs = LineRuns(spark, uri or scratch_uri(spark, "line-runs"), fan)
    for i in range(batches):
        runs.add(lines.filter(F.col("batch") == i))
    often = freeze(runs.merged().filter(F.col("docs") >= copies).select(*HASH, "keeper"), "frequent-lines")
    drops = (
        lines.join(often, HASH).filter(F.col("doc") != F.col("keeper"))
        .groupBy("r1", "r2").agg(F.collect_set("pos").alias("drops"))
    )
    drops = freeze(drops, "line-drops")
    r1, r2 = two_hashes(F.col("doc_id").cast("bigint"), text_or_empty())
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"), r1.alias("r1"), r2.alias("r2"))
    return without_lines(rows.join(drops, ["r1", "r2"], "left").select("doc_id", "text", "drops"))
