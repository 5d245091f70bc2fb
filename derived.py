"""Record streams derived from the driver's tables, used by queries, tests and the benchmark.

Each has a DuckDB counterpart in ``oracle.py``. Streams are whole tables in record form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import StreamConfig
from tidemark.functions.values import timestamp_text
from tidemark.operators.transform import transform
from tidemark.sources.records import records_from_json, records_from_table

RUN_TS = "2024-06-01T00:00:00Z"
OLD_TS = "2024-05-01T00:00:00Z"

ORDERS = StreamConfig(
    "orders",
    ("o_orderkey",),
    drop_field_paths=(("status", "priority"),),
    sensitive_field_paths=(("o_custkey",),),
)
EVENTS = StreamConfig("events", ("event_id",))
CUSTOMERS = StreamConfig("customers", ("c_custkey",), source_type="csv")
TURNS = StreamConfig("turns", ("id",))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _orders_struct() -> list[Column]:
    return [
        F.col("o_orderkey"),
        F.struct(
            F.col("o_orderstatus").alias("code"), F.col("o_orderpriority").alias("priority")
        ).alias("status"),
        F.col("o_custkey"),
        F.col("o_totalprice"),
        F.col("o_orderdate"),
    ]


def spread(df: DataFrame, key: str) -> DataFrame:
    """A table's rows dealt to all cores by its key. A file is read by as many tasks as it has row groups, and a
    record costs far more to extract than to exchange. The number is given, since AQE goes by bytes and would
    leave records that are small and costly to one task."""
    return df.repartition(max(2 * df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions()), key)


def orders_stream(spark: SparkSession, sf_dir: str, splits: int | None = None, spread_out: bool = False) -> DataFrame:
    """Orders as typed records; ``splits`` spreads a table that is a single small file over so many tasks."""
    orders = table(spark, sf_dir, "orders")
    orders = orders if splits is None else orders.repartition(splits)
    orders = spread(orders, "o_orderkey") if spread_out else orders
    return records_from_table(orders, *_orders_struct(), ord="o_orderkey")


def orders_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, value): orders as JSON lines."""
    columns = [c for c in _orders_struct()[:-1]]
    columns.append(timestamp_text(F.col("o_orderdate")).alias("o_orderdate"))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.to_json(F.struct(*columns)).alias("value"))


def orders_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as VARIANT records."""
    return records_from_json(orders_lines(spark, sf_dir), "value", ord="o_orderkey")


def orders_bookmark(spark: SparkSession, sf_dir: str, spread_out: bool = False) -> DataFrame:
    """State of an earlier run over orders: keys divisible by 3 have the same content now, those with
    remainder 1 had another, those with remainder 2 are new. 100 more keys are gone from the source."""
    seen = transform(orders_stream(spark, sf_dir, spread_out=spread_out), ORDERS, OLD_TS).filter("ord % 3 != 2")
    stale = F.sha2(F.concat(F.lit("stale"), F.col("key")), 256)
    bookmark = seen.select(
        "stream",
        "key",
        F.when(F.col("ord") % 3 == 0, F.col("_sdc_surrogate_key")).otherwise(stale).alias("surrogate_key"),
        F.lit(OLD_TS).alias("last_seen"),
        F.lit(OLD_TS).alias("last_emitted"),
    )
    gone = (
        table(spark, sf_dir, "orders").agg(F.max("o_orderkey").alias("top"))
        .select(F.explode(F.sequence(F.col("top") + 1, F.col("top") + 100)).alias("n"))
        .select(F.col("n").cast("string").alias("key"))
        .select(
            F.lit("orders").alias("stream"),
            "key",
            F.sha2(F.concat(F.lit("gone"), F.col("key")), 256).alias("surrogate_key"),
            F.lit(OLD_TS).alias("last_seen"),
            F.lit(None).cast("string").alias("last_emitted"),
        )
    )
    return bookmark.unionByName(gone)


def _event_fields() -> list[Column]:
    return [
        F.col("event_id"),
        timestamp_text(F.col("ts")).alias("ts"),
        F.col("user_id"),
        F.col("event_type"),
        F.col("value"),
        F.parse_json("props").alias("props"),
    ]


def events_lines(spark: SparkSession, sf_dir: str, spread_out: bool = False) -> DataFrame:
    """(event_id, ts, value): events as JSON lines with ``props`` an object."""
    events = table(spark, sf_dir, "events")
    return (spread(events, "event_id") if spread_out else events).select(
        "event_id", "ts", F.to_json(F.struct(*_event_fields())).alias("value")
    )


def events_json(spark: SparkSession, sf_dir: str, spread_out: bool = False) -> DataFrame:
    return records_from_json(events_lines(spark, sf_dir, spread_out), "value", ord="event_id")


def events_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose types drift: of every 50, one has a string value, one scalar props, one no type."""
    drift = F.col("event_id") % 50
    event_id, ts, user_id, event_type, value, props = _event_fields()
    fields = F.struct(
        event_id,
        ts,
        user_id,
        F.when(drift != 2, event_type).alias("event_type"),
        F.when(drift == 0, F.concat(F.lit("v"), F.col("event_id").cast("string")).cast("variant"))
        .otherwise(F.col("value").cast("variant"))
        .alias("value"),
        F.when(drift == 1, F.col("user_id").cast("variant")).otherwise(F.parse_json("props")).alias("props"),
    )
    lines = table(spark, sf_dir, "events").select("event_id", F.to_json(fields).alias("line"))
    return records_from_json(lines, "line", ord="event_id")


# The schema that a discovery of undrifted events gives, used to validate the drifted ones.
EVENTS_SCHEMA = {
    "type": "object",
    "properties": {
        "event_id": {"type": ["number", "null"]},
        "ts": {"type": ["string", "null"], "format": "date-time"},
        "user_id": {"type": ["number", "null"]},
        "event_type": {"type": ["string", "null"]},
        "value": {"type": ["number", "null"]},
        "props": {"type": ["object", "null"], "properties": {"k": {"type": ["number", "null"]}}},
        "_sdc_natural_key": {"type": "number"},
        "_sdc_surrogate_key": {"type": "string", "minLength": 1},
        "_sdc_unique_key": {"type": "string", "minLength": 1},
        "_sdc_timestamp": {"type": ["string", "null"], "format": "date-time"},
    },
}

ORDERS_SCHEMA = {
    "type": "object",
    "properties": {
        "o_orderkey": {"type": ["number", "null"]},
        "status": {"type": ["object", "null"], "properties": {"code": {"type": "string", "enum": ["O", "F"]}}},
        "o_custkey": {"type": ["string", "null"], "minLength": 64},
        "o_totalprice": {"type": ["number", "null"]},
        "o_orderdate": {"type": ["string", "null"], "format": "date-time"},
        "_sdc_natural_key": {"type": "number"},
        "_sdc_surrogate_key": {"type": "string", "minLength": 1},
        "_sdc_unique_key": {"type": "string", "minLength": 1},
    },
}


def turns_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns with an object for a key."""
    turns = table(spark, sf_dir, "conversations")
    key = F.struct(F.col("conv_id").alias("conv"), "turn").alias("id")
    return records_from_table(turns.withColumn("n", F.col("conv_id") * 1000 + F.col("turn")), key, "role", "text", ord="n")


PAGE_SIZE = 100


def orders_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(stream, url, page_no, body): orders in pages that link to the next; the last link of stream s1
    leads nowhere, those of s2 go round in cycles of five pages. A body holds at most 100 records."""
    orders = table(spark, sf_dir, "orders")
    record = F.struct("o_orderkey", "o_orderstatus", "o_totalprice")
    pages = (
        orders.groupBy(F.floor(F.col("o_orderkey") / PAGE_SIZE).cast("bigint").alias("page_no"))
        .agg(F.array_sort(F.collect_list(record)).alias("results"))
    )
    streams = F.explode(F.array(F.lit("s1"), F.lit("s2"))).alias("stream")
    url = lambda n: F.concat(F.lit("http://h/orders?page="), n.cast("string"))
    n = F.col("page_no")
    back = (F.col("stream") == "s2") & (n % 5 == 4)
    ahead = F.when(back, url(n - 4)).otherwise(url(n + 1))
    body = F.to_json(F.struct(F.struct(F.col("next")).alias("info"), F.col("results")))
    return (
        pages.select(streams, "page_no", "results")
        .select("stream", url(n).alias("url"), "page_no", ahead.alias("next"), "results")
        .select("stream", "url", "page_no", body.alias("body"))
    )


def customer_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(stream, page_no, body): bare arrays of customers, and single objects, by turns."""
    customers = table(spark, sf_dir, "customer")
    one = F.to_json(F.struct("c_custkey", "c_name", "c_acctbal"))
    n = F.col("c_custkey")
    body = (
        F.when(n % 3 == 0, F.concat(F.lit("["), one, F.lit(",7,"), one, F.lit("]")))
        .when(n % 3 == 1, one)
        .otherwise(F.lit("[]"))
    )
    return customers.select(F.lit("customers").alias("stream"), n.alias("page_no"), body.alias("body"))
