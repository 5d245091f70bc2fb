"""One query per operator, over the driver's tables. Results hold plain types only: a VARIANT is
returned as its JSON text and a path as its keys joined by dots."""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

import derived as X
from tidemark import StreamConfig
from tidemark.functions import keys as K
from tidemark.functions import paths as P
from tidemark.functions import temporal as D
from tidemark.functions import values as V
from tidemark.operators import bookmark as B
from tidemark.operators import catalog as C
from tidemark.operators import discover as I
from tidemark.operators import messages as M
from tidemark.operators import metrics
from tidemark.operators import outcomes as O
from tidemark.operators import pages as G
from tidemark.operators import transform as T
from tidemark.operators import validate as Y
from tidemark.plans import run as R
from tidemark.session import scratch_uri
from tidemark.sources import files, store
from tidemark.sources.records import records_from_json, records_from_table
from tidemark.streaming import changes

T_DOUBLE = DoubleType()


def rec():
    return F.col("rec")


# --- sources ---------------------------------------------------------------------------------


def _customer_csv(spark: SparkSession, sf: str, one_file: bool = False) -> str:
    """Customers written as CSV, with blank names and fields that hold commas, quotes and newlines."""
    n = F.col("c_custkey")
    name = F.when(n % 10 == 0, F.lit("")).when(
        n % 10 == 1, F.concat(F.lit('a, "b"\n'), F.col("c_name"))
    ).otherwise(F.col("c_name"))
    uri = scratch_uri(spark, "csv")
    rows = X.table(spark, sf, "customer").select(
        n.cast("string").alias("c_custkey"), name.alias("c_name"),
        F.col("c_nationkey").cast("string").alias("c_nationkey"), "c_mktsegment",
    )
    # One file on purpose, where reading a file by many tasks is what is asked.
    rows = rows.coalesce(1) if one_file else rows
    rows.write.option("header", True).option("escape", '"').option("emptyValue", "").csv(uri)
    return uri


def csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    return files.read_csv(spark, _customer_csv(spark, sf)).select("rec.*")


def csv_scan_split(spark: SparkSession, sf: str) -> DataFrame:
    """The same rows from one file that many tasks read."""
    uri = _customer_csv(spark, sf, one_file=True)
    # A small file has splits of 4096 bytes; of a large one they grow with it, so tasks don't become more and more.
    share = {"spark.sql.files.openCostInBytes": "4096", "spark.sql.files.minPartitionNum": "64"}
    before = {key: spark.conf.get(key, None) for key in share}
    for key, value in share.items():
        spark.conf.set(key, value)
    try:
        rows, out = files.read_csv(spark, uri, split=True).select("rec.*"), scratch_uri(spark, "rows")
        rows.write.parquet(out)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    return spark.read.schema(rows.schema).parquet(out)


def jsonl_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Events as lines, with a blank line, a bad one, an array and a null among every hundred."""
    n = F.col("event_id") % 100
    line = (
        F.when(n == 10, "").when(n == 11, "not json").when(n == 12, "[1]").when(n == 13, "null")
        .when(n == 14, "5").otherwise(F.col("value"))
    )
    uri = scratch_uri(spark, "jsonl")
    X.events_lines(spark, sf).select(line.alias("value")).write.text(uri)
    got = files.read_jsonl(spark, uri)
    return got.select(
        P.get_path(rec(), ["event_id"]).try_cast("bigint").alias("event_id"),
        P.get_path(rec(), ["event_type"]).try_cast("string").alias("event_type"),
        P.get_path(rec(), ["props", "k"]).try_cast("bigint").alias("k"),
    )


def jsonl_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Lines that give no record, with their reasons: no JSON, an array and a number among every hundred."""
    n = F.col("event_id") % 100
    line = F.when(n == 11, "not json").when(n == 12, "[1]").when(n == 13, "null").when(n == 14, "5").otherwise(F.col("value"))
    uri = scratch_uri(spark, "jsonl")
    X.events_lines(spark, sf).select(line.alias("value")).write.text(uri)
    _, bad = files.read_jsonl(spark, uri, on_bad="quarantine")
    return bad.groupBy("raw", "reason").agg(F.count(F.lit(1)).alias("n"))


def _ragged_csv(spark: SparkSession, sf: str) -> str:
    """Customers as CSV files, where every tenth row has two fields of three."""
    n = F.col("c_custkey")
    line = F.when(n % 10 == 0, F.concat(n, F.lit(",short"))).otherwise(F.concat_ws(",", n, F.col("c_nationkey"), F.lit('"a, b"')))
    uri = scratch_uri(spark, "csv")
    rows = X.table(spark, sf, "customer").repartition(8, "c_custkey").select(line.alias("value"))
    # Each task writes a file, whose first row brings the header.
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    lines = F.when(first, F.array(F.lit("id,nation,note"), F.col("value"))).otherwise(F.array("value"))
    rows.select(F.explode(lines).alias("value")).write.text(uri)
    return uri


def csv_rejects(spark: SparkSession, sf: str) -> DataFrame:
    _, bad = files.read_csv(spark, _ragged_csv(spark, sf), on_bad="quarantine", multi_line=False)
    return bad


def stream_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Records of a CSV stream, without the ragged rows."""
    uri, out = _ragged_csv(spark, sf), scratch_uri(spark, "rows")
    arriving = files.stream_csv(spark, uri, files.csv_schema(spark, uri), multi_line=False)
    keep = lambda batch, _: files.csv_rows(batch).select("rec.*").write.mode("append").parquet(out)
    stream = arriving.writeStream.foreachBatch(keep).option("checkpointLocation", f"{out}-checkpoint")
    stream.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out)


def api_response_normalise(spark: SparkSession, sf: str) -> DataFrame:
    pages = G.normalise_responses(X.customer_bodies(spark, sf))
    return pages.select(
        "page_no", F.size(G.records_array(F.col("page"))).cast("bigint").alias("n_records")
    )


def api_records_explode(spark: SparkSession, sf: str) -> DataFrame:
    pages = G.normalise_responses(X.customer_bodies(spark, sf))
    return G.explode_records(pages).select(
        "page_no",
        F.col("pos").cast("bigint").alias("pos"),
        P.get_path(rec(), ["c_custkey"]).cast("bigint").alias("c_custkey"),
        P.get_path(rec(), ["c_name"]).cast("string").alias("c_name"),
    )


def api_records_path(spark: SparkSession, sf: str) -> DataFrame:
    """Records at a configured path of an object body."""
    pages = X.orders_pages(spark, sf)
    got = G.explode_records(G.normalise_responses(pages, records_path=["results"]), ["results"])
    return got.select(
        "stream", "page_no", P.get_path(rec(), ["o_orderkey"]).cast("bigint").alias("o_orderkey")
    )


def page_urls(spark: SparkSession, sf: str) -> DataFrame:
    streams = X.table(spark, sf, "pages").select(
        F.col("page_id").cast("string").alias("stream"), "url", F.lit("page").alias("query_parameter"),
        F.lit(2).alias("query_value"), F.lit(1).alias("query_increment"),
    )
    return G.page_urls(streams, 4).select(
        "stream", F.col("page_no").cast("bigint").alias("page_no"), "url"
    )


def pages_until_empty(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as pages of one stream per nation; a page is empty where the key divides by 7."""
    pages = X.table(spark, sf, "customer").select(
        F.col("c_nationkey").cast("string").alias("stream"), F.col("c_custkey").alias("page_no"),
        F.when(F.col("c_custkey") % 7 == 6, 0).otherwise(3).alias("n_records"),
    )
    return G.cut_pages(pages).select("stream", "page_no")


def first_page_only(spark: SparkSession, sf: str) -> DataFrame:
    pages = X.table(spark, sf, "customer").select(
        F.col("c_nationkey").cast("string").alias("stream"), F.col("c_custkey").alias("page_no"),
        F.lit(3).alias("n_records"),
    )
    return G.cut_pages(pages, paginated=False).select("stream", "page_no")


def page_chain(spark: SparkSession, sf: str) -> DataFrame:
    pages = X.orders_pages(spark, sf)
    roots = pages.filter("page_no IN (0, 7)").select("stream", "url")
    return G.follow_next(pages, roots, ["info", "next"])


def read_bookmark(spark: SparkSession, sf: str) -> DataFrame:
    """A bookmark written as a version, made current and read again."""
    uri = scratch_uri(spark, "store")
    store.write_bookmark(spark, uri, X.orders_bookmark(spark, sf))
    return store.read_bookmark(spark, uri, ["orders"])


def write_bookmark(spark: SparkSession, sf: str) -> DataFrame:
    """The second version of a bookmark replaces the first, which stays readable."""
    uri = scratch_uri(spark, "store")
    first = X.orders_bookmark(spark, sf)
    store.write_bookmark(spark, uri, first.filter("last_emitted IS NULL"))
    store.write_bookmark(spark, uri, first)
    table = store.Store(spark, uri).of("orders").bookmark
    old = table.read(1).select("key", F.lit(1).cast("bigint").alias("version"))
    return old.unionByName(table.read().select("key", F.lit(2).cast("bigint").alias("version")))


def _catalog_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "stream", F.array_join("path", ".").alias("path"), "type", "nullable", "format",
        F.col("min_length").cast("bigint").alias("min_length"),
    )


def read_catalog(spark: SparkSession, sf: str) -> DataFrame:
    uri = scratch_uri(spark, "store")
    store.write_catalog(spark, uri, _drift_catalog(spark, sf))
    return _catalog_columns(store.read_catalog(spark, uri, ["events"]))


def write_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """A later version of a catalog, read next to the one before."""
    uri = scratch_uri(spark, "store")
    found = _drift_catalog(spark, sf)
    store.write_catalog(spark, uri, found.filter(F.size("path") == 1))
    store.write_catalog(spark, uri, found)
    table = store.Store(spark, uri).of("events").catalog
    rows = lambda v: table.read(v).select(
        F.array_join("path", ".").alias("path"), "type", F.lit(v).cast("bigint").alias("version")
    )
    return rows(1).unionByName(rows(2))


def catalog_document(spark: SparkSession, sf: str) -> DataFrame:
    """A discovered catalog written as a document and read back from its text."""
    doc = C.catalog_document(_drift_catalog(spark, sf), "events")
    return _catalog_columns(C.catalog_from_document(spark, json.dumps(doc)))


# --- projections -----------------------------------------------------------------------------


def get_path(spark: SparkSession, sf: str) -> DataFrame:
    got = X.orders_json(spark, sf)
    return got.select(
        "ord",
        P.get_path(rec(), ["status", "code"]).cast("string").alias("code"),
        P.get_path(rec(), ["status", "absent"]).cast("string").alias("absent"),
        P.get_path(rec(), ["o_custkey", "below"]).cast("string").alias("below_scalar"),
        F.to_json(P.get_path(rec(), ["status"])).alias("status"),
    )


def set_path(spark: SparkSession, sf: str) -> DataFrame:
    """Replace a leaf, and set one below parents that do not exist."""
    code = F.concat(P.get_path(rec(), ["status", "code"]).cast("string"), F.lit("!")).cast("variant")
    made = P.set_path(P.set_path(rec(), ["status", "code"], code), ["a", "b"], F.col("ord").cast("variant"))
    return X.orders_json(spark, sf).select("ord", V.canonical_text(made).alias("text"))


def drop_paths(spark: SparkSession, sf: str) -> DataFrame:
    paths = [["status", "priority"], ["o_totalprice"], ["absent", "x"], ["o_custkey", "x"]]
    return X.orders_json(spark, sf).select(
        "ord", V.canonical_text(P.drop_paths(rec(), paths)).alias("text")
    )


def hash_sensitive(spark: SparkSession, sf: str) -> DataFrame:
    """A number, a nested string, an absent path, and a child below a hashed parent."""
    paths = [["o_custkey"], ["status", "priority"], ["absent"], ["o_custkey", "x"]]
    return X.orders_json(spark, sf).select(
        "ord", V.canonical_text(P.hash_paths(rec(), paths)).alias("text")
    )


def key_string(spark: SparkSession, sf: str) -> DataFrame:
    price = P.get_path(rec(), ["o_totalprice"])
    return X.orders_json(spark, sf).select(
        "ord",
        V.key_string(P.get_path(rec(), ["o_orderkey"])).alias("whole"),
        V.key_string(price).alias("fraction"),
        V.key_string((F.round(price.cast("double") * 100) * 1e4).cast("variant")).alias("large"),
        V.key_string(P.get_path(rec(), ["status", "code"])).alias("string"),
        V.key_string(P.get_path(rec(), ["absent"])).alias("absent"),
    )


def _number_texts(spark: SparkSession, sf: str, exponent: str) -> DataFrame:
    """Doubles of two digits, typed and as JSON, as text and as keys."""
    digits = "concat(o_orderkey % 9 + 1, '.', o_orderkey % 7 + 2, 'E', " + exponent + ")"
    df = X.table(spark, sf, "orders").select("o_orderkey", F.expr(digits).alias("t"))
    json = F.parse_json(F.concat(F.lit('{"v":'), F.col("t"), F.lit("}")))
    typed, of_json = F.col("t").cast("double"), P.get_path(json, ["v"])
    return df.select(
        "o_orderkey", V.typed_json(typed, T_DOUBLE).alias("typed"), V.canonical_text(of_json).alias("json"),
        V.key_string(typed, T_DOUBLE).alias("typed_key"), V.key_string(of_json).alias("json_key"),
    )


def number_text_small(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers from 1e-4 down to 1e-300."""
    return _number_texts(spark, sf, "-(o_orderkey % 297 + 4)")


def number_text_large(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers from 1e24 up to 1e300."""
    return _number_texts(spark, sf, "o_orderkey % 277 + 24")


def hash_large_integers(spark: SparkSession, sf: str) -> DataFrame:
    """Sensitive integers of 19 digits that differ in the last ones only, typed and as JSON."""
    n = (F.lit(10**18) + F.col("o_orderkey")).alias("n")
    cfg = StreamConfig("orders", ("id",), sensitive_field_paths=(("n",),))
    df = X.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), n)
    lines = df.select("id", F.to_json(F.struct("id", "n")).alias("line"))
    texts = lambda records, name: T.transform(records, cfg, X.RUN_TS).select("ord", F.col("text").alias(name))
    return texts(records_from_table(df, ord="id"), "typed").join(
        texts(records_from_json(lines, "line", ord="id"), "json"), "ord"
    )


def canonical_text(spark: SparkSession, sf: str) -> DataFrame:
    return X.events_json(spark, sf).select("ord", V.canonical_text(rec()).alias("text"))


def natural_key(spark: SparkSession, sf: str) -> DataFrame:
    """An object for a natural key, as JSON and as lookup text."""
    got = T.transform(X.turns_stream(spark, sf), X.TURNS, X.RUN_TS)
    return got.select("ord", F.to_json(F.to_variant_object(K.NATURAL_KEY)).alias("natural_key"), "key")


def _transformed(df: DataFrame, cfg: StreamConfig) -> DataFrame:
    return T.transform(df, cfg, X.RUN_TS).select(
        "key", "text", K.SURROGATE_KEY, K.TIMESTAMP, K.UNIQUE_KEY,
        F.to_json(F.col(K.NATURAL_KEY).cast("variant")).alias(K.NATURAL_KEY),
    )


def surrogate_key(spark: SparkSession, sf: str) -> DataFrame:
    return _transformed(X.events_json(spark, sf), X.EVENTS).select("key", K.SURROGATE_KEY)


def run_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    return _transformed(X.events_json(spark, sf), X.EVENTS).select("key", K.TIMESTAMP)


def unique_key(spark: SparkSession, sf: str) -> DataFrame:
    return _transformed(X.events_json(spark, sf), X.EVENTS).select("key", K.UNIQUE_KEY)


def transform_records(spark: SparkSession, sf: str) -> DataFrame:
    """The whole transform over typed records."""
    return _transformed(X.orders_stream(spark, sf), X.ORDERS)


def transform_json_records(spark: SparkSession, sf: str) -> DataFrame:
    """The same over VARIANT records, with the same result."""
    return _transformed(X.orders_json(spark, sf), X.ORDERS)


# --- filters ---------------------------------------------------------------------------------


def require_key(spark: SparkSession, sf: str) -> DataFrame:
    """Keys that are numbers, numbers as strings, blank strings or null, by turns."""
    n = F.col("o_orderkey")
    key = (
        F.when(n % 4 == 0, (n % 8).cast("variant"))
        .when(n % 4 == 1, F.lit("0").cast("variant"))
        .when(n % 4 == 2, F.lit("").cast("variant"))
    )
    df = X.table(spark, sf, "orders").select(
        n.alias("ord"), F.to_variant_object(F.struct(n.alias("n"), key.alias("id"))).alias("rec")
    )
    ok, failed = T.split_on_key(df, ["id"])
    return ok.select("ord", F.lit(True).alias("ok")).unionByName(
        failed.select("ord", F.lit(False).alias("ok"))
    )


def changed_only(spark: SparkSession, sf: str) -> DataFrame:
    got = T.transform(X.orders_stream(spark, sf), X.ORDERS, X.RUN_TS)
    return B.changed_only(got, X.orders_bookmark(spark, sf)).select("key", K.SURROGATE_KEY)


def _drifted(spark: SparkSession, sf: str) -> DataFrame:
    return T.transform(X.events_drift(spark, sf), X.EVENTS, X.RUN_TS)


def validate_records(spark: SparkSession, sf: str) -> DataFrame:
    valid, rejected = Y.validate(_drifted(spark, sf), X.EVENTS_SCHEMA)
    return valid.select("key", F.lit("").alias("errors")).unionByName(
        rejected.select("key", F.array_join("errors", "; ").alias("errors"))
    )


def check_type(spark: SparkSession, sf: str) -> DataFrame:
    value, kind = P.get_raw(rec(), ["value"]), P.get_raw(rec(), ["event_type"])
    return X.events_drift(spark, sf).select(
        "ord",
        Y.check_type(value, ["number", "null"]).alias("is_number"),
        Y.check_type(value, "string").alias("is_string"),
        Y.check_type(P.get_raw(rec(), ["event_id"]), "integer").alias("is_integer"),
        Y.check_type(P.get_raw(rec(), ["props"]), "object").alias("is_object"),
        Y.check_type(kind, "string").alias("is_present_string"),
    )


def check_min_length(spark: SparkSession, sf: str) -> DataFrame:
    return X.events_json(spark, sf).select(
        "ord", Y.check_min_length(P.get_raw(rec(), ["event_type"]), 6).alias("ok")
    )


def check_format(spark: SparkSession, sf: str) -> DataFrame:
    """Texts that are a date-time, a date, neither, or no such day, by turns."""
    v = _dates(F.col("o_orderkey"), F.col("o_orderdate")).cast("variant")
    return X.table(spark, sf, "orders").select(
        "o_orderkey",
        Y.check_format(v, "date-time").alias("is_date_time"),
        Y.check_format(v, "date").alias("is_date"),
    )


def _dates(n, ts):
    day = F.substring(ts.cast("string"), 1, 10)
    return (
        F.when(n % 6 == 0, V.timestamp_text(ts))
        .when(n % 6 == 1, day)
        .when(n % 6 == 2, F.concat(F.substring(day, 1, 8), F.lit("31")))
        .when(n % 6 == 3, F.concat(day, F.lit("T25:00:00Z")))
        .when(n % 6 == 4, F.concat(day, F.lit("T23:59:59.123456789+02:00")))
        .otherwise(F.concat(day, F.lit(" 00:00:00")))
    )


def check_properties(spark: SparkSession, sf: str) -> DataFrame:
    """Nested properties; a missing one passes."""
    schema = {
        "properties": {
            "props": {"properties": {"k": {"type": "number", "maximum": 50}, "absent": {"type": "string"}}},
        }
    }
    valid, _ = Y.validate(X.events_json(spark, sf), schema)
    return valid.select("ord")


KEYWORDS = {
    "required": {"required": ["absent"]},
    "enum": {"properties": {"event_type": {"enum": ["click", "view", 5]}}},
    "const": {"properties": {"event_type": {"const": "click"}}},
    "minimum": {"properties": {"value": {"minimum": 10}}},
    "maximum": {"properties": {"value": {"maximum": 10}}},
    "exclusiveMinimum": {"properties": {"user_id": {"exclusiveMinimum": 8}}},
    "exclusiveMaximum": {"properties": {"user_id": {"exclusiveMaximum": 8}}},
    "multipleOf": {"properties": {"user_id": {"multipleOf": 4}}},
    "maxLength": {"properties": {"event_type": {"maxLength": 5}}},
    "pattern": {"properties": {"event_type": {"pattern": "^c"}}},
    "additionalProperties": {"properties": {"event_id": {}}, "additionalProperties": False},
}


def check_catalog_keywords(spark: SparkSession, sf: str) -> DataFrame:
    """Invalid events per keyword of a hand-written schema, all in one pass."""
    events = X.events_json(spark, sf).select("ord", "rec")
    return Y.count_invalid(events, KEYWORDS).select(F.col("name").alias("keyword"), "n_invalid")


COMBINATORS = {
    "allOf": {"properties": {"value": {"allOf": [{"minimum": 10}, {"maximum": 90}]}}},
    "anyOf": {"properties": {"event_type": {"anyOf": [{"const": "click"}, {"maxLength": 4}]}}},
    "oneOf": {"properties": {"user_id": {"oneOf": [{"multipleOf": 2}, {"multipleOf": 3}]}}},
    "not": {"properties": {"user_id": {"not": {"multipleOf": 5}}}},
    "nested": {"properties": {"props": {"anyOf": [
        {"properties": {"k": {"maximum": 10}}}, {"properties": {"k": {"minimum": 90}}, "required": ["k"]},
    ]}}},
    "minProperties": {"properties": {"tags": {"minProperties": 2}}},
    "maxProperties": {"properties": {"tags": {"maxProperties": 2}}},
    "uniqueItems": {"properties": {"marks": {"uniqueItems": True}}},
    "items": {"properties": {"marks": {"items": {"anyOf": [{"maximum": 3}, {"minimum": 6}]}}}},
}


def check_combinators(spark: SparkSession, sf: str) -> DataFrame:
    """Valid and invalid events per combining, counting or item keyword, all in one pass."""
    n = F.col("event_id")
    more = F.concat(
        F.lit('"tags":{'), F.array_join(F.transform(F.sequence(F.lit(0), n % 4), lambda i: F.concat(F.lit('"t'), i, F.lit('":1'))), ","),
        F.lit('},"marks":['), n % 3, F.lit(","), n % 5, F.lit(","), n % 7, F.lit("],"),
    )
    lines = X.events_lines(spark, sf).select("event_id", F.concat(F.lit("{"), more, F.substring("value", 2, 1 << 30)).alias("line"))
    return Y.count_invalid(records_from_json(lines, "line", ord="event_id"), COMBINATORS)


def check_items(spark: SparkSession, sf: str) -> DataFrame:
    """Array keywords over records that gather an order's line quantities."""
    lines = X.table(spark, sf, "lineitem").select("l_orderkey", F.col("l_quantity").cast("int").alias("q"))
    orders = lines.groupBy("l_orderkey").agg(F.collect_list("q").alias("q"))
    df = records_from_table(orders, "l_orderkey", "q", ord="l_orderkey")
    df = df.withColumn("rec", F.to_variant_object("rec"))
    schema = {"properties": {"q": {"minItems": 2, "maxItems": 5, "items": {"maximum": 45}}}}
    valid, _ = Y.validate(df, schema)
    return valid.select("ord")


def check_multiple_of(spark: SparkSession, sf: str) -> DataFrame:
    """multipleOf where numbers have over 20 digits, or decimals."""
    n = F.col("o_orderkey").cast("string")
    line = F.concat(F.lit('{"big":'), n, F.lit("0" * 21), F.lit(',"small":0.'), F.lpad(n, 12, "0"), F.lit("}"))
    df = records_from_json(X.table(spark, sf, "orders").select("o_orderkey", line.alias("line")), "line", ord="o_orderkey")
    schema = {"properties": {"big": {"multipleOf": 7}, "small": {"multipleOf": 5e-12}}}
    return Y.all_errors(df, schema).select("ord", F.array_join("errors", "; ").alias("errors"))


def discover_ns_ord(spark: SparkSession, sf: str) -> DataFrame:
    """Discovery in an order of epoch nanoseconds."""
    late = X.events_drift(spark, sf).withColumn("ord", F.col("ord") + F.lit(1_700_000_000_000_000_000))
    return _catalog_columns(I.discover(T.transform(late, X.EVENTS, X.RUN_TS), None, X.RUN_TS, X.EVENTS.unique_key_path))


def objects_only(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("event_id") % 5
    text = (
        F.when(n == 0, F.lit("[1]")).when(n == 1, F.lit("7")).when(n == 2, F.lit("null"))
        .otherwise(F.col("value"))
    )
    df = records_from_json(X.events_lines(spark, sf), text, ord="event_id")
    ok, bad = T.objects_only(df)
    return ok.select("ord", F.lit(True).alias("ok")).unionByName(bad.select("ord", F.lit(False).alias("ok")))


def temporal_kind(spark: SparkSession, sf: str) -> DataFrame:
    return X.table(spark, sf, "orders").select(
        "o_orderkey", D.temporal_kind(_dates(F.col("o_orderkey"), F.col("o_orderdate"))).alias("kind")
    )


# --- joins -----------------------------------------------------------------------------------


def bookmark_lookup(spark: SparkSession, sf: str) -> DataFrame:
    got = T.transform(X.orders_stream(spark, sf), X.ORDERS, X.RUN_TS)
    return B.join_bookmark(got, X.orders_bookmark(spark, sf)).select("key", B.PREVIOUS)


def bookmark_lookup_filtered(spark: SparkSession, sf: str) -> DataFrame:
    """The same lookup against a stored bookmark and its delta, of which the run's own keys are read and joined."""
    uri = scratch_uri(spark, "store")
    whole, share = X.orders_bookmark(spark, sf), F.expr("pmod(hash(key), 10)")
    content = F.when(share < 7, F.col("surrogate_key")).otherwise("older")
    store.write_bookmark(spark, uri, whole.filter(share < 9).withColumn("surrogate_key", content))
    log = store.Store(spark, uri).of("orders").bookmark
    log.commit(2, log.advance(whole.filter(share >= 7), 2, 1))
    got = T.transform(X.orders_stream(spark, sf), X.ORDERS, X.RUN_TS)
    return B.join_bookmark(got, log.known(got)).select("key", B.PREVIOUS)


def _outcomes(spark: SparkSession, sf: str, refresh: bool = False) -> DataFrame:
    return R.outcomes_of(
        X.orders_stream(spark, sf), X.ORDERS, X.orders_bookmark(spark, sf), X.ORDERS_SCHEMA, X.RUN_TS,
        refresh,
    )


def _advanced(spark: SparkSession, sf: str) -> DataFrame:
    folded = B.fold_updates(B.bookmark_updates(_outcomes(spark, sf)))
    return B.advance_bookmark(X.orders_bookmark(spark, sf), folded)


def unseen_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Keys that the run did not see, without those that were seen but rejected."""
    rejected = _outcomes(spark, sf).filter(F.col("outcome") == O.INVALID)
    return B.unseen_keys(_advanced(spark, sf), X.RUN_TS, rejected).select("key", "last_seen")


# --- aggregations ----------------------------------------------------------------------------


def infer_paths(spark: SparkSession, sf: str) -> DataFrame:
    df = X.events_drift(spark, sf).withColumn("stream", F.lit("events"))
    return I.infer_paths(df).select("ord", F.array_join("path", ".").alias("path"), "type", "format")


def merge_schemas(spark: SparkSession, sf: str) -> DataFrame:
    """First types by arrival, with a catalog that knows one path already."""
    df = X.events_drift(spark, sf).withColumn("stream", F.lit("events"))
    known = C.catalog_from_schema(
        spark, "events", {"properties": {"user_id": {"type": "string"}, "gone": {"type": "boolean"}}}
    )
    return I.merge_paths(I.infer_paths(df), known).select(
        F.array_join("path", ".").alias("path"), "type", "nullable", "format"
    )


def _drift_catalog(spark: SparkSession, sf: str) -> DataFrame:
    return I.discover(_drifted(spark, sf), None, X.RUN_TS, X.EVENTS.unique_key_path)


def discover_catalog(spark: SparkSession, sf: str) -> DataFrame:
    return _catalog_columns(_drift_catalog(spark, sf))


def run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.run_metrics(_outcomes(spark, sf))


def run_metrics_observed(spark: SparkSession, sf: str) -> DataFrame:
    """The same counts, observed while the outcomes are written."""
    routed, counts = metrics.observed(_outcomes(spark, sf))
    routed.write.parquet(scratch_uri(spark, "outcomes"))
    got = metrics.metrics_of(counts)
    got.pop(O.REJECTED)
    return spark.createDataFrame([tuple(got.values())], ", ".join(f"{name} bigint" for name in got))


def _updates(spark: SparkSession, sf: str) -> DataFrame:
    """Updates keyed by customer, so that keys repeat within the run."""
    return X.table(spark, sf, "orders").select(
        F.lit("orders").alias("stream"),
        F.col("o_custkey").cast("string").alias("key"),
        F.sha2(F.col("o_orderkey").cast("string"), 256).alias("surrogate_key"),
        V.timestamp_text(F.col("o_orderdate")).alias("ts"),
        (F.col("o_orderstatus") == "F").alias("emitted"),
        F.col("o_orderkey").alias("ord"),
    )


def fold_updates(spark: SparkSession, sf: str) -> DataFrame:
    return B.fold_updates(_updates(spark, sf))


def advance_bookmark(spark: SparkSession, sf: str) -> DataFrame:
    return _advanced(spark, sf)


# --- routing and sinks -----------------------------------------------------------------------


def route_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    return _outcomes(spark, sf).select("ord", "outcome")


def bookmark_updates(spark: SparkSession, sf: str) -> DataFrame:
    return B.bookmark_updates(_outcomes(spark, sf)).select("key", "surrogate_key", "ts", "emitted")


def schema_messages(spark: SparkSession, sf: str) -> DataFrame:
    """The properties that the SCHEMA messages of two streams hold."""
    uri = scratch_uri(spark, "store")
    both = _drift_catalog(spark, sf)
    both = both.unionByName(both.withColumn("stream", F.lit("copy")))
    store.write_catalog(spark, uri, both)
    messages = M.schema_messages(store.read_catalog(spark, uri))
    m = messages.select("stream", F.parse_json("message").alias("rec"))
    properties = P.get_path(rec(), ["schema", "properties"]).cast(V.MAP)
    return m.select(
        "stream",
        P.get_path(rec(), ["type"]).cast("string").alias("type"),
        F.to_json(P.get_path(rec(), ["key_properties"])).alias("key_properties"),
        F.explode(properties).alias("property", "definition"),
    ).select("stream", "type", "key_properties", "property", F.to_json("definition").alias("definition"))


def record_messages(spark: SparkSession, sf: str) -> DataFrame:
    emitted = _outcomes(spark, sf).filter(F.col("outcome") == O.EMITTED)
    return M.record_messages(emitted)


def rejects(spark: SparkSession, sf: str) -> DataFrame:
    return O.rejects(_outcomes(spark, sf), X.ORDERS_SCHEMA).select(
        "outcome", "key", "raw", F.array_join("errors", "; ").alias("errors")
    )


# --- whole runs ------------------------------------------------------------------------------


def run_discover(spark: SparkSession, sf: str) -> DataFrame:
    s = store.Store(spark, scratch_uri(spark, "run"))
    R.run_discover(X.events_drift(spark, sf), X.EVENTS, s, X.RUN_TS)
    return _catalog_columns(s.of("events").catalog.read())


def discover_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Lines that a discovery could not read: a bad one, an array and a number among every hundred."""
    n = F.col("event_id") % 100
    line = F.when(n == 11, "not json").when(n == 12, "[1]").when(n == 14, "5").otherwise(F.col("value"))
    s, uri = store.Store(spark, scratch_uri(spark, "run")), scratch_uri(spark, "jsonl")
    X.events_lines(spark, sf).select(line.alias("value")).write.text(uri)
    cfg = StreamConfig("events", ("event_id",), "jsonl", uri)
    R.run_discover(R.read_source(spark, cfg), cfg, s, X.RUN_TS)
    facts = s.of("events").catalog.info()
    bad = spark.read.parquet(facts["rejects"])
    told = bad.groupBy("raw", F.array_join("errors", "; ").alias("reason")).agg(F.count(F.lit(1)).alias("n"))
    return told.withColumn("n_all", F.lit(facts["rejected"]).cast("bigint"))


def _prepared(spark: SparkSession, sf: str) -> store.Store:
    uri = scratch_uri(spark, "run")
    store.write_bookmark(spark, uri, X.orders_bookmark(spark, sf, spread_out=True), ["orders"])
    store.write_catalog(spark, uri, C.catalog_from_schema(spark, "orders", X.ORDERS_SCHEMA))
    return store.Store(spark, uri)


def _emitted(spark: SparkSession, messages: str) -> DataFrame:
    lines = spark.read.text(f"{messages}/records").select(F.parse_json("value").alias("rec"))
    get = lambda name: P.get_path(rec(), ["record", name]).cast("string").alias(name)
    return lines.select(get("o_orderkey"), get(K.SURROGATE_KEY), get(K.UNIQUE_KEY))


def run_extract(spark: SparkSession, sf: str) -> DataFrame:
    """Records that an incremental run wrote as messages."""
    s = _prepared(spark, sf)
    run = R.run_extract(X.orders_stream(spark, sf, spread_out=True), X.ORDERS, s, X.RUN_TS)
    return _emitted(spark, run.messages)


def run_extract_bookmark(spark: SparkSession, sf: str) -> DataFrame:
    """The bookmark that the run left."""
    s = _prepared(spark, sf)
    R.run_extract(X.orders_stream(spark, sf, spread_out=True), X.ORDERS, s, X.RUN_TS)
    return s.of("orders").bookmark.read()


def run_refresh(spark: SparkSession, sf: str) -> DataFrame:
    s = _prepared(spark, sf)
    run = R.run_refresh(X.orders_stream(spark, sf), X.ORDERS, s, run_ts=X.RUN_TS)
    return _emitted(spark, run.messages)


def two_streams_one_store(spark: SparkSession, sf: str) -> DataFrame:
    """Bookmarks of two streams whose runs both began from an empty store."""
    s = store.Store(spark, scratch_uri(spark, "run"))

    def run(source: tuple[DataFrame, StreamConfig]) -> None:
        R.run_discover(*source, s, X.RUN_TS)
        R.run_extract(*source, s, X.RUN_TS, version=1, previous=0)

    sources = [(X.orders_stream(spark, sf, spread_out=True), X.ORDERS), (X.events_json(spark, sf, spread_out=True), X.EVENTS)]
    # Side by side, as runs of two programs would be; the first error of any ends the query.
    with ThreadPoolExecutor(max_workers=2) as pool:
        list(pool.map(run, sources))
    return store.read_bookmark(spark, s.uri).select("stream", "key", "surrogate_key")


def run_extract_many(spark: SparkSession, sf: str) -> DataFrame:
    """Bookmarks of three streams, typed, JSON and CSV, one of them known before, whose outcomes one job wrote."""
    s = _prepared(spark, sf)
    customers = StreamConfig("customers", ("c_custkey",), "csv", _customer_csv(spark, sf))
    orders, events = X.orders_stream(spark, sf, spread_out=True), X.events_json(spark, sf, spread_out=True)
    sources = [(orders, X.ORDERS), (events, X.EVENTS), (R.read_source(spark, customers), customers)]
    R.run_discover_many(sources[1:], s, X.RUN_TS)
    R.run_extract_many(sources, s, X.RUN_TS)
    got = store.read_bookmark(spark, s.uri)
    return got.select("stream", "key", "surrogate_key", "last_seen", "last_emitted")


def _run_pages(spark: SparkSession, cfg: StreamConfig, pages: DataFrame) -> DataFrame:
    """Discover and extract a REST stream; the keys and contents that its run knows afterwards."""
    s = store.Store(spark, scratch_uri(spark, "run"))
    source = R.read_source(spark, cfg, pages)
    R.run_discover(source, cfg, s, X.RUN_TS)
    R.run_extract(source, cfg, s, X.RUN_TS)
    return s.of(cfg.stream_name).bookmark.read().select("key", "surrogate_key")


def run_extract_next_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Orders behind next links."""
    cfg = StreamConfig(
        "orders", ("o_orderkey",), source_type="rest", url="http://h/orders?page=0", records_path=("results",),
        pagination=True, pagination_strategy="next", pagination_next_path=("info", "next"),
    )
    return _run_pages(spark, cfg, X.orders_pages(spark, sf).filter("stream = 's1'"))


def run_extract_query_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Customers behind a query parameter; the last page but one is empty and ends the stream."""
    cfg = StreamConfig(
        "customers", ("c_custkey",), source_type="rest", url="http://h/c", records_path=("data",), pagination=True,
        pagination_strategy="query", query_parameter="p", query_value=5, query_increment=5,
    )
    n = F.floor(F.col("c_custkey") / 20).cast("bigint")
    pages = X.table(spark, sf, "customer").groupBy(n.alias("n")).agg(
        F.array_sort(F.collect_list(F.struct("c_custkey", "c_name"))).alias("data")
    )
    url = F.when(F.col("n") == 0, "http://h/c").otherwise(F.concat(F.lit("http://h/c?p="), (F.col("n") * 5).cast("string")))
    last = X.table(spark, sf, "customer").agg(F.floor(F.max("c_custkey") / 20)).first()[0]
    body = F.when(F.col("n") == last - 1, '{"data":[]}').otherwise(F.to_json(F.struct("data")))
    return _run_pages(spark, cfg, pages.select(url.alias("url"), body.alias("body")))


def api_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Rejects of a run over pages whose arrays hold numbers and texts among the customers."""
    cfg = StreamConfig(
        "customers", ("c_custkey",), source_type="rest", url="http://h/c?p=0", records_path=("data",), pagination=True,
        pagination_strategy="query", query_parameter="p", query_value=1, query_increment=1,
    )
    n, name = F.col("c_custkey"), F.concat(F.lit('"'), F.col("c_name"), F.lit('"'))
    item = F.when(n % 10 == 3, n.cast("string")).when(n % 10 == 4, name).otherwise(F.to_json(F.struct("c_custkey", "c_name")))
    pages = X.table(spark, sf, "customer").select(F.floor(n / 50).cast("bigint").alias("n"), item.alias("item"))
    pages = pages.groupBy("n").agg(F.concat(F.lit('{"data":['), F.array_join(F.collect_list("item"), ","), F.lit("]}")).alias("body"))
    s = store.Store(spark, scratch_uri(spark, "run"))
    source = R.read_source(spark, cfg, pages.select(F.concat(F.lit("http://h/c?p="), "n").alias("url"), "body"))
    R.run_discover(source, cfg, s, X.RUN_TS)
    run = R.run_extract(source, cfg, s, X.RUN_TS)
    return spark.read.parquet(run.rejects).filter(F.col("outcome") == O.REJECTED).select("raw", F.array_join("errors", "; ").alias("errors"))

def run_extract_bare_array(spark: SparkSession, sf: str) -> DataFrame:
    """Nations from one response that is an array."""
    cfg = StreamConfig("nations", ("n_nationkey",), source_type="rest", url="http://h/n")
    body = F.to_json(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))))
    return _run_pages(spark, cfg, X.table(spark, sf, "nation").agg(body.alias("body")).withColumn("url", F.lit("http://h/n")))


# --- streaming -------------------------------------------------------------------------------


def _arrive(spark: SparkSession, sf: str, uri: str, part: int) -> None:
    """Write one of three batches of event lines; a tenth of the batch before comes again."""
    lines = X.events_lines(spark, sf)
    n = F.col("event_id")
    fresh = n % 3 == part
    again = (n % 3 == part - 1) & (F.floor(n / 3) % 10 == 0)
    lines.filter(fresh | again).select("value").write.mode("append").text(uri)


def stream_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Bookmark after three micro-batches; a record that comes again unchanged is not emitted."""
    s = store.Store(spark, scratch_uri(spark, "stream"))
    store.write_catalog(spark, s.uri, C.catalog_from_schema(spark, "events", X.EVENTS_SCHEMA))
    uri = f"{s.uri}/landing"
    for part in range(3):
        _arrive(spark, sf, uri, part)
        changes.stream_changes(
            files.stream_jsonl(spark, uri), X.EVENTS, s, f"{s.uri}/checkpoint", files.jsonl_parsed
        ).awaitTermination()
    emitted_last = F.col("last_seen") == F.col("last_emitted")
    return s.of("events").bookmark.read().select("key", "surrogate_key", emitted_last.alias("emitted_when_last_seen"))


def stream_changes_deltas(spark: SparkSession, sf: str) -> DataFrame:
    """The same stream over a bookmark of all events but each third: batches append to the log, and what they
    leave is the base with the deltas over it."""
    s = store.Store(spark, scratch_uri(spark, "stream"))
    store.write_catalog(spark, s.uri, C.catalog_from_schema(spark, "events", X.EVENTS_SCHEMA))
    known = T.transform(X.events_json(spark, sf, spread_out=True), X.EVENTS, X.OLD_TS).filter("ord % 3 <> 0")
    store.write_bookmark(spark, s.uri, known.select(
        "stream", "key", F.col("_sdc_surrogate_key").alias("surrogate_key"), F.lit(X.OLD_TS).alias("last_seen"),
        F.lit(X.OLD_TS).alias("last_emitted"),
    ), ["events"])
    uri = f"{s.uri}/landing"
    for part in range(2):
        _arrive(spark, sf, uri, part)
        changes.stream_changes(
            files.stream_jsonl(spark, uri), X.EVENTS, s, f"{s.uri}/checkpoint", files.jsonl_parsed
        ).awaitTermination()
    state = s.of("events").bookmark.read()
    return state.select(
        "key", "surrogate_key", (F.col("last_seen") != X.OLD_TS).alias("seen"), (F.col("last_emitted") != X.OLD_TS).alias("emitted")
    )


def stream_discover(spark: SparkSession, sf: str) -> DataFrame:
    s = store.Store(spark, scratch_uri(spark, "stream"))
    uri = f"{s.uri}/landing"
    for part in range(3):
        _arrive(spark, sf, uri, part)
        changes.stream_discover(
            files.stream_jsonl(spark, uri), X.EVENTS, s, f"{s.uri}/checkpoint", files.jsonl_parsed
        ).awaitTermination()
    return _catalog_columns(s.of("events").catalog.read())


QUERIES = {
    f.__name__: f
    for f in (
        csv_scan, csv_scan_split, jsonl_scan, jsonl_rejects, csv_rejects, stream_csv, two_streams_one_store, check_multiple_of,
        discover_ns_ord, api_response_normalise, api_records_explode, api_records_path, page_urls,
        pages_until_empty, first_page_only, page_chain, read_bookmark, write_bookmark, read_catalog,
        write_catalog, catalog_document, get_path, set_path, drop_paths, hash_sensitive, key_string, canonical_text,
        number_text_small, number_text_large, hash_large_integers,
        natural_key, surrogate_key, run_timestamp, unique_key, transform_records,
        transform_json_records, require_key, changed_only, validate_records, check_type,
        check_min_length, check_format, check_properties, check_catalog_keywords, check_combinators, check_items,
        objects_only, temporal_kind, bookmark_lookup, unseen_keys, infer_paths, merge_schemas,
        discover_catalog, run_metrics, fold_updates, advance_bookmark, route_outcomes,
        bookmark_updates, schema_messages, record_messages, rejects, run_discover, run_extract,
        run_extract_bookmark, run_refresh, run_extract_next_pages, run_extract_query_pages, run_extract_bare_array, stream_changes, stream_changes_deltas,
        stream_discover, bookmark_lookup_filtered, run_metrics_observed, discover_rejects, api_rejects, run_extract_many,
    )
}
