"""CSV, JSON-lines and landed API responses as record streams, in batch or as micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.values import is_object
from tidemark.session import check_settings
from tidemark.sources.csv_split import csv_fields, csv_records
from tidemark.sources.versions import Files

CORRUPT = "_corrupt_record"


def _csv_options(multi_line: bool) -> dict:
    return {
        "header": True,
        "multiLine": multi_line,
        "quote": '"',
        "escape": '"',
        "enforceSchema": False,
        "inferSchema": False,
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
        "maxCharsPerColumn": -1,
        # Field counts are checked on whole rows, whatever a query reads of them.
        "columnPruning": False,
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
    }


def _has_large_files(spark: SparkSession, uri: str) -> bool:
    share = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.files.maxPartitionBytes")
    )
    return Files(spark).largest(uri) > share


def csv_schema(spark: SparkSession, uri: str) -> T.StructType:
    """String columns named by the header row, and one for rows that do not fit it."""
    names = spark.read.options(**_csv_options(True)).csv(uri).columns
    fields = [T.StructField(n, T.StringType()) for n in names]
    return T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])


def _csv_rows(df: DataFrame) -> DataFrame:
    """(ord, rec, raw): rec holds strings only, "" for empty; raw is set on rows that do not fit."""
    names = [c for c in df.columns if c != CORRUPT]
    value = lambda c: F.coalesce(F.col("`" + c.replace("`", "``") + "`"), F.lit(""))
    rec = F.struct(*[value(c).alias(c) for c in names])
    # Tied to a field, since Spark does not read the corrupt column by itself.
    raw = F.when(value(names[0]) != "\u0000", F.col(CORRUPT))
    return df.withColumn("ord", F.monotonically_increasing_id()).select(
        "ord", rec.alias("rec"), raw.alias("raw")
    )


def read_csv(
    spark: SparkSession, uri: str, on_bad: str = "fail", multi_line: bool = True, split: bool | None = None
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Records of CSV files, all values strings.

    A row with too few or too many fields fails the job; ``on_bad="quarantine"`` returns
    (records, bad rows) instead, ``on_bad="keep"`` all rows as csv_parsed does. A file is read by one task,
    or with ``split`` by many, for which quotes are counted first; by default that is done where a file is larger
    than a task's share (``spark.sql.files.maxPartitionBytes``). ``multi_line=False`` lets Spark split files
    without that, for data whose quoted fields hold no newlines."""
    if on_bad not in ("fail", "quarantine", "keep"):
        raise ValueError(f"on_bad must be fail, quarantine or keep, got {on_bad!r}")
    schema = csv_schema(spark, uri)
    split = multi_line and (_has_large_files(spark, uri) if split is None else split)
    if split:
        rows = _csv_rows(csv_fields(csv_records(spark, uri), schema, _csv_options(False)))
    else:
        rows = _csv_rows(spark.read.options(**_csv_options(multi_line)).schema(schema).csv(uri))
    if on_bad == "keep":
        return _with_reason(rows)
    if on_bad == "quarantine":
        return rows.filter("raw IS NULL").drop("raw"), rows.filter("raw IS NOT NULL").select("raw")
    # The row itself may hold sensitive fields, so only its place is told.
    file = F.lit("a large file") if split else F.input_file_name()
    place = F.concat(file, F.lit(", row "), F.col("ord").cast("string"), F.lit(" of the scan"))
    message = F.concat(F.lit("a CSV row does not fit the header: "), place)
    ok = F.when(F.col("raw").isNull(), True).otherwise(F.raise_error(message).cast("boolean"))
    return rows.filter(ok).drop("raw")


def jsonl_parsed(lines: DataFrame) -> DataFrame:
    """(ord, rec, raw, reason) of every line but blank ones, from a ``value`` column of lines.

    ``reason`` says why a line gives no record, and is NULL for objects and for a bare null, which
    later fails the key check. The parsed record comes out of a generator, so that no test parses a
    line again. Objects that repeat a key keep its last value, which is a setting of the session."""
    check_settings(lines.sparkSession)
    parsed = F.explode(F.array(F.try_parse_json("value"))).alias("rec")
    rows = lines.filter(F.trim("value") != "").select(parsed, F.col("value").alias("raw"))
    rec = F.col("rec")
    # A line that is too large or too deep for a VARIANT is not told from one that is no JSON.
    reason = F.when(rec.isNull(), "is not JSON, or over the limits of a VARIANT").when(
        ~is_object(rec) & ~F.is_variant_null(rec), "is not an object"
    )
    return rows.withColumn("ord", F.monotonically_increasing_id()).select("ord", "rec", "raw", reason.alias("reason"))


def jsonl_rows(lines: DataFrame) -> DataFrame:
    """(ord, rec, raw) of the lines that give a record."""
    return jsonl_parsed(lines).filter("reason IS NULL").drop("reason")


def read_jsonl(
    spark: SparkSession, uri: str, on_bad: str = "skip"
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Records of JSON lines. Lines that give none are skipped; ``on_bad="quarantine"`` returns
    (records, bad lines with their reasons) instead, ``on_bad="keep"`` all lines as jsonl_parsed does,
    ``on_bad="fail"`` fails the job at the first."""
    if on_bad not in ("skip", "fail", "quarantine", "keep"):
        raise ValueError(f"on_bad must be skip, fail, quarantine or keep, got {on_bad!r}")
    rows = jsonl_parsed(spark.read.text(uri))
    if on_bad == "keep":
        return rows
    if on_bad == "skip":
        return rows.filter("reason IS NULL").drop("reason")
    if on_bad == "quarantine":
        good = rows.filter("reason IS NULL").drop("reason")
        return good, rows.filter("reason IS NOT NULL").select("ord", "raw", "reason")
    message = F.concat(F.lit("a line "), F.col("reason"), F.lit(": "), F.input_file_name())
    ok = F.when(F.col("reason").isNull(), True).otherwise(F.raise_error(message).cast("boolean"))
    return rows.filter(ok).drop("reason")


def stream_jsonl(spark: SparkSession, uri: str, max_files: int | None = None) -> DataFrame:
    """Lines of files as they arrive; parse a micro-batch with jsonl_parsed."""
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(uri)


def stream_csv(
    spark: SparkSession, uri: str, schema: T.StructType, max_files: int | None = None, multi_line: bool = True
) -> DataFrame:
    """CSV rows of files as they arrive, with a schema from csv_schema."""
    reader = spark.readStream.options(**_csv_options(multi_line)).schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(uri)


def _with_reason(rows: DataFrame) -> DataFrame:
    return rows.withColumn("reason", F.when(F.col("raw").isNotNull(), "does not fit the header"))


def csv_parsed(df: DataFrame) -> DataFrame:
    """(ord, rec, raw, reason) of every row of a micro-batch read by stream_csv."""
    return _with_reason(_csv_rows(df))


def csv_rows(df: DataFrame) -> DataFrame:
    """(ord, rec) of a micro-batch read by stream_csv, without the rows that do not fit the header."""
    return _csv_rows(df).filter("raw IS NULL").drop("raw")


def csv_rejects(df: DataFrame) -> DataFrame:
    """(raw) of the rows of a micro-batch that do not fit the header."""
    return _csv_rows(df).filter("raw IS NOT NULL").select("raw")
