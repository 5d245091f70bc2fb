"""Routing: exactly one outcome per processed record."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import keys as K
from tidemark.functions.values import is_variant, settle
from tidemark.operators.bookmark import PREVIOUS, is_changed, join_bookmark
from tidemark.operators.transform import with_unique_key
from tidemark.operators.validate import compile_checks

TRANSFORM_FAILED = "transform_failed"
FILTERED = "filtered_bookmark"
INVALID = "schema_validation_failed"
EMITTED = "emitted"
REJECTED = "rejected"

# What a run writes for each record; ``text`` is NULL where a record is unchanged.
OUTCOME_COLUMNS = (
    "stream", "ord", "key", "nk_json", K.SURROGATE_KEY, K.TIMESTAMP, K.UNIQUE_KEY, "text", "outcome",
)


def route_outcomes(
    df: DataFrame, bookmark: DataFrame | None, schema: Mapping, refresh: bool = False, hide: bool = False,
    disambiguate: bool = False,
) -> DataFrame:
    """Outcome of transformed records, checked in order: readable, key, bookmark, schema.

    ``bookmark=None`` means that nothing was seen yet; then nothing is shuffled. With a lookup only
    the text of a record is shuffled: typed records are checked beforehand, since that costs next to
    nothing, and of VARIANT records the changed ones are parsed again afterwards, for which ``df`` may
    lack ``rec``. Records may come without their extraction key, as transform_all leaves them without ``stamped``;
    it is made behind the lookup then (``disambiguate`` as there). Lines that give no record come in the same pass, and leave with their ``reason``;
    ``text`` is the line, with ``hide`` its SHA-256, since fields of a line that cannot be read can
    neither be dropped nor hashed."""
    ok, told = F.col("key_ok"), ["reason"] if "reason" in df.columns else []
    lookup = bookmark is not None and not refresh
    if "rec" in df.columns and not (lookup and is_variant(df.schema["rec"].dataType)):
        checks = compile_checks(df, schema)
        df = checks.df.select(*checks.columns, checks.is_valid().alias("valid"))
    df = df.drop("rec", K.NATURAL_KEY)
    if lookup:
        routed = join_bookmark(df, bookmark)
        routed = routed.withColumn("changed", ok & is_changed()).drop(PREVIOUS)
    else:
        routed = df.withColumn("changed", ok)
    if "content" in routed.columns:
        routed = with_unique_key(routed, disambiguate)
    if "valid" not in routed.columns:
        routed = routed.select(
            "*",
            F.when(F.col("changed"), F.parse_json("text")).alias("rec"),
            F.when(F.col("changed"), F.parse_json("nk_json")).alias(K.NATURAL_KEY),
        )
        checks = compile_checks(routed, schema)
        routed = checks.df.withColumn("valid", checks.is_valid())
    outcome = (
        F.when(~ok, TRANSFORM_FAILED)
        .when(~F.col("changed"), FILTERED)
        .when(~F.col("valid"), INVALID)
        .otherwise(EMITTED)
    )
    if told:
        outcome = F.when(F.col("reason").isNotNull(), REJECTED).otherwise(outcome)
    routed = settle(routed, outcome, "outcome")
    text = F.when(F.col("outcome") != FILTERED, F.col("text"))
    if told:
        line = F.concat(F.lit("sha256:"), F.sha2("raw", 256)) if hide else F.col("raw")
        text = F.when(F.col("outcome") == REJECTED, line).otherwise(text)
    return routed.withColumn("text", text).select(*OUTCOME_COLUMNS, *told)


def line_rejects(source: DataFrame, stream: str, hide: bool) -> DataFrame:
    """Rows of the quarantine table for the lines of a source, with a ``reason``, that give no record."""
    line = F.concat(F.lit("sha256:"), F.sha2("raw", 256)) if hide else F.col("raw")
    return source.filter("reason IS NOT NULL").select(
        F.lit(stream).alias("stream"), F.lit(REJECTED).alias("outcome"), F.lit(None).cast("string").alias("key"),
        line.alias("raw"), F.array("reason").alias("errors"),
    )


def unreadable_rejects(outcomes: DataFrame) -> DataFrame:
    """Rows of the quarantine table for the lines that give no record."""
    bad = outcomes.filter(F.col("outcome") == REJECTED)
    return bad.select("stream", "outcome", "key", F.col("text").alias("raw"), F.array("reason").alias("errors"))


def rejects(outcomes: DataFrame, schema: Mapping) -> DataFrame:
    """Quarantine table (stream, outcome, key, raw, errors) of the records that were not emitted for
    a fault of their own. Only these are parsed again to name their errors."""
    bad = outcomes.filter(F.col("outcome").isin(TRANSFORM_FAILED, INVALID)).select(
        "*",
        F.parse_json("text").alias("rec"),
        F.parse_json(F.coalesce("nk_json", F.lit("null"))).alias(K.NATURAL_KEY),
    )
    checks = compile_checks(bad, schema)
    named = checks.with_errors(
        checks.df, "stream", "outcome", "key", F.col("text").alias("raw")
    )
    no_key = F.array(F.lit("unique key is missing or empty"))
    return named.withColumn(
        "errors", F.when(F.col("outcome") == INVALID, F.col("errors")).otherwise(no_key)
    )
