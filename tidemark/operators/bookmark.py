"""The bookmark: which content was last seen under each key, joined and merged as a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.keys import SURROGATE_KEY

BOOKMARK_SCHEMA = (
    "stream string, key string, surrogate_key string, last_seen string, last_emitted string"
)

PREVIOUS = "previous_surrogate_key"


def empty_bookmark(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], BOOKMARK_SCHEMA)


def join_bookmark(df: DataFrame, bookmark: DataFrame) -> DataFrame:
    """Add the surrogate key the bookmark holds for each record's key.

    A left join with the records on the left: a key that repeats in the run can be split by AQE, and
    the bookmark is broadcast only if its measured size is below the session's limit. Records without
    a key take one of their own, since equal NULLs would all meet in one task."""
    lookup = bookmark.select(
        F.col("stream").alias("_stream"),
        F.col("key").alias("_key"),
        F.col("surrogate_key").alias(PREVIOUS),
    )
    own = F.concat(F.lit("\u0000"), F.col("ord").cast("string"))
    at = F.coalesce(F.col("key"), own) if "ord" in df.columns else F.col("key")
    joined = df.withColumn("_at", at).join(
        lookup, (F.col("stream") == F.col("_stream")) & (F.col("_at") == F.col("_key")), "left"
    )
    return joined.drop("_stream", "_key", "_at")


def is_changed(previous: str = PREVIOUS) -> Column:
    return F.col(previous).isNull() | (F.col(previous) != F.col(SURROGATE_KEY))


def changed_only(df: DataFrame, bookmark: DataFrame, refresh: bool = False) -> DataFrame:
    """Records whose key is unseen or whose content differs; all of them on a refresh."""
    if refresh:
        return df
    return join_bookmark(df, bookmark).filter(is_changed()).drop(PREVIOUS)


def bookmark_updates(outcomes: DataFrame) -> DataFrame:
    """Updates of a run: emitted and unchanged records. Rejected ones leave no trace."""
    return outcomes.filter(F.col("outcome").isin("emitted", "filtered_bookmark")).select(
        "stream",
        "key",
        F.col(SURROGATE_KEY).alias("surrogate_key"),
        F.col("_sdc_timestamp").alias("ts"),
        (F.col("outcome") == "emitted").alias("emitted"),
        "ord",
    )


def fold_updates(updates: DataFrame, stream: str | None = None) -> DataFrame:
    """One row per key: the last content by ``ord``, the time seen, and the time emitted if any.

    Partial aggregation folds a repeated key before the shuffle. Updates that are all of one ``stream`` are dealt
    by their key alone, as the buckets of its bookmark are, so that writing them takes no second shuffle."""
    last = F.struct("ord", "surrogate_key")
    if stream is None:
        grouped = updates.groupBy("stream", "key")
    else:
        grouped = updates.groupBy("key")
    return (
        grouped.agg(
            F.max(last).alias("last"),
            F.max("ts").alias("last_seen"),
            F.max(F.when(F.col("emitted"), F.col("ts"))).alias("last_emitted"),
        )
        .select(
            (F.col("stream") if stream is None else F.lit(stream)).alias("stream"), "key",
            F.col("last.surrogate_key").alias("surrogate_key"), "last_seen", "last_emitted",
        )
    )


def advance_bookmark(bookmark: DataFrame, folded: DataFrame) -> DataFrame:
    """Upsert folded updates; untouched keys keep their row, and so does an old emission time."""
    old, new = bookmark.alias("old"), folded.alias("new")
    same = (F.col("old.stream") == F.col("new.stream")) & (F.col("old.key") == F.col("new.key"))
    return old.join(new, same, "full_outer").select(
        *[
            F.coalesce(f"new.{c}", f"old.{c}").alias(c)
            for c in ("stream", "key", "surrogate_key", "last_seen", "last_emitted")
        ]
    )


def updated_at(bookmark: DataFrame) -> DataFrame:
    """Time of each stream's last update."""
    return bookmark.groupBy("stream").agg(F.max("last_seen").alias("updated_at"))


def _sortable(ts: Column) -> Column:
    """UTC text without its Z and the zeros of its fraction, so that 00:00:00Z sorts before 00:00:00.5Z."""
    return F.regexp_replace(ts, r"(\.[0-9]*[1-9])0*Z$|\.0*Z$|Z$", "$1")


def unseen_keys(
    bookmark: DataFrame, run_started_at: str | Column, rejected: DataFrame | None = None,
    stream: str | None = None,
) -> DataFrame:
    """Keys not seen since a run began, of one stream if it is named: candidates for deletion at the source.

    ``rejected`` (stream, key) names records that were present but did not pass validation."""
    started = F.lit(run_started_at) if isinstance(run_started_at, str) else run_started_at
    out = bookmark.filter(_sortable(F.col("last_seen")) < _sortable(started))
    if stream is not None:
        out = out.filter(F.col("stream") == stream)
    if rejected is not None:
        out = out.join(rejected.select("stream", "key"), ["stream", "key"], "left_anti")
    return out
