"""The tables a stream keeps between runs: its bookmark as a log of deltas, its catalog as versions of one
folder. Streams do not touch each other's."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.bookmark import BOOKMARK_SCHEMA
from tidemark.operators.catalog import CATALOG_SCHEMA
from tidemark.operators.messages import schema_messages
from tidemark.sources.bookmark_log import BookmarkLog
from tidemark.sources.versions import Files, StaleRun, VersionedTable


@dataclass(frozen=True)
class StreamStore:
    """State of one stream: its bookmark, its catalog, and the output of its runs."""

    spark: SparkSession
    uri: str

    @property
    def bookmark(self) -> BookmarkLog:
        return BookmarkLog(self.spark, f"{self.uri}/bookmark", BOOKMARK_SCHEMA)

    @property
    def catalog(self) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.uri}/catalog", CATALOG_SCHEMA)

    def output(self, version: int) -> str:
        """An unused folder for a run's output: outcomes, messages, rejects."""
        return f"{self.uri}/runs/v{version:012d}-{uuid.uuid4().hex[:12]}"


@dataclass(frozen=True)
class Store:
    """Streams below one URI, each with tables, commits and output of its own."""

    spark: SparkSession
    uri: str

    def of(self, stream: str) -> StreamStore:
        return StreamStore(self.spark, f"{self.uri}/{_PREFIX}{quote(stream, safe='')}")

    def streams(self) -> list[str]:
        names = Files(self.spark).names(self.uri)
        return sorted(unquote(n[len(_PREFIX) :]) for n in names if n.startswith(_PREFIX))


_PREFIX = "stream-"


def _read(spark: SparkSession, uri: str, streams: list[str] | None, kind: str, schema: str) -> DataFrame:
    store = Store(spark, uri)
    out = spark.createDataFrame([], schema)
    for stream in store.streams() if streams is None else streams:
        out = out.unionByName(getattr(store.of(stream), kind).read())
    return out


def read_bookmark(spark: SparkSession, uri: str, streams: list[str] | None = None) -> DataFrame:
    """The bookmarks of a store's streams; empty before the first run."""
    return _read(spark, uri, streams, "bookmark", BOOKMARK_SCHEMA)


def write_bookmark(
    spark: SparkSession, uri: str, bookmark: DataFrame, streams: list[str] | None = None, **facts
) -> dict[str, int]:
    """Write a new bookmark version of each stream that has rows, or of those named, and make it current.

    Naming the streams saves a pass over the frame to find them."""
    return _write(spark, uri, "bookmark", bookmark, facts, streams)


def read_catalog(spark: SparkSession, uri: str, streams: list[str] | None = None) -> DataFrame:
    """The catalogs of a store's streams; empty before the first discovery."""
    return _read(spark, uri, streams, "catalog", CATALOG_SCHEMA)


def write_catalog(spark: SparkSession, uri: str, catalog: DataFrame, **facts) -> dict[str, int]:
    """Write a new catalog version of each stream that has rows, and make it current."""
    return _write(spark, uri, "catalog", catalog, facts)


def _write(
    spark: SparkSession, uri: str, kind: str, df: DataFrame, facts: dict, streams: list[str] | None = None
) -> dict[str, int]:
    versions = {}
    if streams is None:
        # As many rows as streams.
        streams = [stream for (stream,) in df.select("stream").distinct().collect()]
    for stream in streams:
        table = getattr(Store(spark, uri).of(stream), kind)
        versions[stream] = table.version() + 1
        path, more = table.write(df.filter(F.col("stream") == stream), versions[stream]), {}
        if kind == "catalog":
            # Built with the catalog, and read by every run under it.
            more["schema_message"] = f"{path}-message"
            messages = schema_messages(spark.read.schema(table.schema).parquet(path))
            messages.select("message").write.text(more["schema_message"])
        table.commit(versions[stream], path, **more, **facts)
    return versions


__all__ = [
    "BookmarkLog", "Files", "StaleRun", "Store", "StreamStore", "VersionedTable", "read_bookmark", "read_catalog",
    "write_bookmark", "write_catalog",
]
