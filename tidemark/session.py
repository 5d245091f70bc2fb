"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that results depend on; scans and runs raise under others.
NEEDED_CONF = {"spark.sql.session.timeZone": ("UTC", "Etc/UTC", "Z", "GMT"), "spark.sql.variant.allowDuplicateKeys": ("true",)}

# Settings a run should be submitted with.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A side of a join is broadcast by its measured size alone. Files hold columns encoded and compressed, and
    # hashes and texts made of them take many times the bytes of the file, from which plans are estimated.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    # A key that holds much of a stream is split by AQE on the record side of the bookmark join.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Skip sorting the records when the bookmark's partitions fit in memory.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # JSON objects that repeat a key keep its last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # A stage whose generated method is too long for the JIT compiler runs as separate, compiled
    # projections instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # The four outcomes of a run are written side by side instead of being sorted first.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    "spark.sql.parquet.compression.codec": "zstd",
}

# Set when a session is built. Plans here are many small columns, and PySpark collects a stack trace
# for each one unless told not to.
BUILD_CONF = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def build_session(master: str | None = None, app: str = "tidemark", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED_CONF, **BUILD_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the recommended SQL settings on a session that is already running."""
    for key, value in RECOMMENDED_CONF.items():
        spark.conf.set(key, value)
    return spark


def check_settings(spark: SparkSession) -> None:
    """Raise under a setting that would change or lose records without a word."""
    for key, values in NEEDED_CONF.items():
        value = spark.conf.get(key)
        if value not in values:
            raise ValueError(f"{key} is {value}; it must be {values[0]} (see tidemark.session.apply_settings)")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees: the session's checkpoint folder.

    Where the session names none, a local session gets a temporary folder; on a cluster this raises,
    since a folder of one machine would not hold what the others write."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(base)
    return base


def scratch_uri(spark: SparkSession, name: str) -> str:
    """A new, unused folder for one written table."""
    return f"{shared_dir(spark).rstrip('/')}/tidemark/{name}-{uuid.uuid4().hex}"
