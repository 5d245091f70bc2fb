"""The bookmark of a stream as bucketed base files and a log of deltas.

A run appends its folded updates as one delta: what it writes follows its own keys, not all keys. Base and deltas
are bucketed by key with one recorded bucket count and sorted within a bucket, so that lookups, merges and
compactions join them where they lie. Once the deltas outgrow a share of the base, or are many, the next run merges
all into a new base. A version's commit names the folders it consists of, which later versions share."""

from __future__ import annotations

import threading
import uuid
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.bookmark import PREVIOUS, advance_bookmark
from tidemark.session import scratch_uri
from tidemark.sources.versions import Files, VersionedTable

KEY = ["stream", "key"]
BUCKET = "key"

#: Batches of up to so many keys are looked up by literals, which reach the scan: only their buckets and pages are read.
LISTED_KEYS = 1_000
#: Of a filter of a batch's keys: words of 64 bits, which bound what is broadcast, and bits a key, below which it is left out.
FILTER_WORDS, BITS_A_KEY = 1 << 20, 8


# Scans of bucketed tables say that a bucket of one file is sorted, and tables that are bucketed by the key alone join on
# stream and key where they lie.
_CO_LOCATED = {
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


_lock, _users = threading.Lock(), {}


@contextmanager
def co_located(spark: SparkSession):
    """Settings under which plans over a log are made. Runs side by side share them; the last restores."""
    with _lock:
        users, before = _users.get(spark, (0, None))
        before = before or {name: spark.conf.get(name) for name in _CO_LOCATED}
        _users[spark] = (users + 1, before)
        for name, value in _CO_LOCATED.items():
            spark.conf.set(name, value)
    try:
        yield
    finally:
        with _lock:
            users, before = _users.pop(spark)
            if users > 1:
                _users[spark] = (users - 1, before)
            else:
                for name, value in before.items():
                    spark.conf.set(name, value)


def key_filter(keys: DataFrame, words: int = FILTER_WORDS) -> DataFrame:
    """(word, bits): a Bloom filter of one hash, as many rows as ``words`` at most."""
    word, bit = _place(words)
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)
    return keys.select(word.alias("_word"), one.alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))


def may_hold(df: DataFrame, bits: DataFrame, words: int = FILTER_WORDS) -> DataFrame:
    """The rows of (stream, key, ...) whose key may be one of the filter's; none of these is lost."""
    word, bit = _place(words)
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)
    # As many rows as the filter has words.
    near = df.withColumn("_at", word).join(F.broadcast(bits), F.col("_at") == F.col("_word"))
    return near.filter(F.col("_bits").bitwiseAND(one) != 0).drop("_at", "_word", "_bits")


def _place(words: int):
    h = F.xxhash64(*KEY)
    return F.pmod(h, F.lit(words)), F.shiftrightunsigned(h, 48).bitwiseAND(F.lit(63)).cast("int")


@dataclass(frozen=True)
class BookmarkLog(VersionedTable):
    """A versioned bookmark. ``ratio`` is the share of the base's rows that deltas may have in all, ``most`` their
    number, and ``buckets`` the bucket count of a first version, the session's shuffle partitions by default."""

    buckets: int | None = None
    ratio: float = 0.5
    most: int = 8
    _written: dict = field(default_factory=dict, compare=False, repr=False)

    # -- folders ------------------------------------------------------------------------------

    def _layout(self, version: int) -> dict | None:
        """The folders of a version; None where it is no version of a log."""
        facts = self._facts(version) if version else None
        return facts if facts and "base" in facts else None

    def _bucket_count(self, version: int) -> int:
        layout = self._layout(version)
        if layout:
            return layout["buckets"]
        return self.buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def _open(self, path: str, buckets: int) -> DataFrame:
        """A folder as a bucketed table."""
        name = f"tidemark_bookmark_{uuid.uuid4().hex}"
        columns = ", ".join(f"`{n}` string" for n in self.spark.createDataFrame([], self.schema).columns)
        self.spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{BUCKET}`)"
            f" SORTED BY (`stream`, `key`) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
        df = self.spark.table(name)
        # The frame keeps the files; the name was needed to say how they are bucketed.
        self.spark.sql(f"DROP TABLE {name}")
        return df

    def _put(self, df: DataFrame, path: str, buckets: int) -> int:
        """Write bucketed rows, which are co-partitioned already or else dealt here; returns their number."""
        name = f"tidemark_bookmark_{uuid.uuid4().hex}"
        with co_located(self.spark):
            (
                df.write.format("parquet").bucketBy(buckets, BUCKET).sortBy(*KEY)
                .option("path", path).saveAsTable(name)
            )
        self.spark.sql(f"DROP TABLE {name}")
        return self.spark.read.schema(self.schema).parquet(path).count()

    # -- versions -----------------------------------------------------------------------------

    def parts(self, version: int) -> list[DataFrame]:
        """The base of a version and its deltas, oldest first."""
        layout = self._layout(version)
        if layout is None:
            return [super().read(version)] if version else []
        return [self._open(path, layout["buckets"]) for path in (layout["base"], *layout["deltas"])]

    def read(self, version: int | None = None) -> DataFrame:
        """A version's rows, one per key: later deltas over earlier ones over the base."""
        version = self.version() if version is None else version
        if self._layout(version) is None:
            return super().read(version)
        return self._merged(self.parts(version))

    @staticmethod
    def _merged(parts: list[DataFrame]) -> DataFrame:
        """Deltas are folded into each other first, so that the base is joined once and isn't exchanged."""
        base, *deltas = parts
        if not deltas:
            return base
        folded = deltas[0]
        for delta in deltas[1:]:
            folded = advance_bookmark(folded, delta)
        return advance_bookmark(base, folded)

    def write(self, df: DataFrame, version: int) -> str:
        """Write a whole version as a base of its own, without making it current."""
        buckets, path = self._bucket_count(version - 1), self.new_path(version)
        rows = self._put(df.repartition(buckets, BUCKET), path, buckets)
        self._written[path] = {"base": path, "deltas": [], "buckets": buckets, "base_rows": rows, "delta_rows": 0}
        return path

    def advance(self, folded: DataFrame, version: int, previous: int, updates: int | None = None) -> str:
        """Write a version that upserts folded updates into the previous one: a delta, or a new base where the
        deltas have outgrown it.

        With the number of ``updates`` before folding, a run that large is merged at once, without a delta of its
        own: a base that is rewritten has ``1 / ratio`` times as many rows as the run had updates at most."""
        layout = self._layout(previous)
        if layout is None:
            known = super().read(previous) if previous else None
            return self.write(folded if known is None else advance_bookmark(known, folded), version)
        buckets, path = layout["buckets"], self.new_path(version)
        most, parts = self.ratio * layout["base_rows"], [layout["base"], *layout["deltas"]]
        if updates is not None and layout["delta_rows"] + updates > most:
            self._written[path] = self._rebased(parts, buckets, path, folded)
            return path
        rows = self._put(folded.repartition(buckets, BUCKET), path, buckets)
        deltas, total = [*layout["deltas"], path], layout["delta_rows"] + rows
        facts = {k: layout[k] for k in ("base", "buckets", "base_rows")} | {"deltas": deltas, "delta_rows": total}
        if len(deltas) > self.most or total > most:
            facts = self._rebased([*parts, path], buckets, f"{path}-base")
        self._written[path] = facts | {"added_rows": rows}
        return path

    def _rebased(self, parts: list[str], buckets: int, base: str, *more: DataFrame) -> dict:
        """Merge folders, and a frame that is dealt to their buckets, into a new base."""
        merged = self._merged([*(self._open(p, buckets) for p in parts), *(df.repartition(buckets, BUCKET) for df in more)])
        return {"base": base, "buckets": buckets, "base_rows": self._put(merged, base, buckets), "deltas": [], "delta_rows": 0}

    def commit(self, version: int, path: str, replay: bool = False, **facts) -> None:
        super().commit(version, path, replay, **self._written.pop(path, {}), **facts)

    def retain(self, keep: int) -> None:
        """Delete folders that none of the last ``keep`` versions consists of."""
        last = self.version()

        def folders(version: int) -> set[str]:
            layout = self._layout(version)
            return {layout["base"], *layout["deltas"]} if layout else set()

        needed = set().union(*(folders(v) for v in range(max(1, last - max(1, keep) + 1), last + 1)))
        files, version = Files(self.spark), last - max(1, keep)
        while version > 0 and (facts := self._facts(version)) is not None:
            mine = {facts["path"], *facts.get("outputs", ()), *folders(version)} - needed
            for path in (*sorted(mine), self._commit_file(version)):
                files.delete(path)
            version -= 1

    # -- lookups ------------------------------------------------------------------------------

    def known(self, keys: DataFrame, version: int | None = None) -> DataFrame:
        """(stream, key, surrogate_key) of those of a batch's keys that a version holds, written to the shared folder.

        Keys are folded and exchanged; base and deltas are not. A batch of few keys reads their buckets and pages
        alone. Of one that is small against the bookmark a Bloom filter goes over the scans before the joins, which
        stay exact."""
        version = self.version() if version is None else version
        parts, layout = self.parts(version), self._layout(version)
        wanted = f"{(uri := scratch_uri(self.spark, 'batch-keys'))}/keys"
        keys.select(*KEY).filter("key IS NOT NULL").distinct().write.parquet(wanted)
        keys = self.spark.read.schema("stream string, key string").parquet(wanted)
        found = self._found(keys, parts, keys.count(), layout)
        out = f"{uri}/known"
        with co_located(self.spark):
            found.write.parquet(out)
        return self.spark.read.schema(found.schema).parquet(out)

    def _found(self, keys: DataFrame, parts: list[DataFrame], n_keys: int, layout: dict | None) -> DataFrame:
        parts = [part.select(*KEY, "surrogate_key") for part in parts]
        if n_keys <= LISTED_KEYS:
            listed = [row.key for row in keys.select("key").distinct().collect()]
            parts = [part.filter(F.col("key").isin(listed)) for part in parts]
        elif layout and n_keys * BITS_A_KEY <= FILTER_WORDS * 64 and 4 * n_keys <= layout["base_rows"]:
            bits = key_filter(keys)
            parts = [may_hold(part, bits) for part in parts]
        out = keys if layout is None else keys.repartition(layout["buckets"], BUCKET)
        for i, part in enumerate(parts):
            # Merged where they lie; without a hint a small side might be sent to all tasks unmeasured.
            out = out.join(part.withColumnRenamed("surrogate_key", f"_{i}").hint("merge"), KEY, "left")
        latest = F.coalesce(*[F.col(f"_{i}") for i in reversed(range(len(parts)))], F.lit(None).cast("string"))
        return out.select(*KEY, latest.alias("surrogate_key")).filter("surrogate_key IS NOT NULL")


__all__ = ["PREVIOUS", "BookmarkLog", "key_filter", "may_hold"]
