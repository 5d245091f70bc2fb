"""What keeps large runs within time and disk: records on all cores, few passes, few bytes."""

import glob
import json
import threading
from datetime import date, datetime
from decimal import Decimal

import derived as X
import pytest
import queries as Q
from pyspark.sql import functions as F

from tidemark import StreamConfig
from tidemark.operators import bookmark as B
from tidemark.operators import discover as I
from tidemark.operators.bookmark import BOOKMARK_SCHEMA
from tidemark.operators.catalog import catalog_from_schema
from tidemark.operators.transform import transform, transform_all, with_unique_key
from tidemark.plans import run as R
from tidemark.session import scratch_uri
from tidemark.sources.bookmark_log import BookmarkLog
from tidemark.sources.records import records_from_table
from tidemark.sources.store import read_bookmark, write_bookmark, write_catalog

SF = "/root/testdata/sf0.001"
UPDATES = "stream string, key string, surrogate_key string, ts string, emitted boolean, ord long"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_records_are_spread_over_all_cores(spark):
    """Whatever the number of row groups, and before records are built."""
    one = X.orders_stream(spark, SF)
    assert one.rdd.getNumPartitions() == 1
    for spread in (X.orders_stream(spark, SF, spread_out=True), X.events_json(spark, SF, spread_out=True)):
        assert spread.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
        assert "Exchange hashpartitioning" in plan_of(spread)
    assert sorted(map(str, X.orders_stream(spark, SF, spread_out=True).collect())) == sorted(map(str, one.collect()))


def test_two_streams_run_side_by_side(spark, monkeypatch):
    """Neither run waits for the other to end: both must meet before any goes on."""
    meet, extract = threading.Barrier(2, timeout=120), R.run_extract

    def met(*args, **options):
        meet.wait()
        return extract(*args, **options)

    monkeypatch.setattr(R, "run_extract", met)
    got = Q.two_streams_one_store(spark, SF).groupBy("stream").count().collect()
    assert {r.stream for r in got} == {"orders", "events"}


def test_many_discoveries_run_side_by_side(spark, store, records, monkeypatch):
    meet, discover = threading.Barrier(2, timeout=120), R.run_discover

    def met(*args, **options):
        meet.wait()
        return discover(*args, **options)

    monkeypatch.setattr(R, "run_discover", met)
    one, two = StreamConfig("a", ("id",)), StreamConfig("b", ("id",))
    found = R.run_discover_many([(records('{"id":1,"v":"x"}'), one), (records('{"id":2}'), two)], store, "t")
    assert set(found["a"]["properties"]) - set(found["b"]["properties"]) == {"v"}
    assert store.of("b").catalog.info()["version"] == 1
    with pytest.raises(ValueError, match="named twice"):
        R.run_discover_many([(records('{"id":1}'), one)] * 2, store)


def test_typed_records_are_discovered_from_their_columns(spark):
    """The same types as those of their VARIANTs, which aren't built."""
    schema = (
        "id long, s string, d date, t timestamp, n decimal(9,2), b binary, f double, ok boolean, a array<int>, "
        "o struct<x:string, p:struct<y:int, z:timestamp_ntz>, e:struct<>>, _sdc_timestamp string"
    )
    day, at = date(2024, 1, 2), datetime(2024, 1, 2, 3, 4, 5)
    rows = [
        (2, "2024-01-02", day, at, Decimal("1.5"), b"ab", 0.5, True, [], (None, (None, None), ()), "x"),
        (1, "2024-01-02T00:00:00Z", None, None, None, None, float("nan"), None, None, None, None),
        (3, "no date", day, at, None, None, None, False, [1], ("x", (1, at), None), None),
        (4, None, None, None, None, None, None, None, None, ("y", None, ()), None),
    ]
    df = spark.createDataFrame(rows, schema)
    typed = records_from_table(df, *[c for c in df.columns], ord="id")
    typed = transform(typed, StreamConfig("s", ("id",)), "t")
    found = I.found_types(typed, ("id",))
    assert "variant" not in plan_of(found).lower()
    as_variant = typed.withColumn("rec", F.to_variant_object(F.col("rec").dropFields("_sdc_timestamp", "d", "t", "b", "f", "o")))
    same = {"id", "s", "n", "ok", "a"}
    of = lambda df: {(tuple(r.path), r.type, r.nullable, r.format) for r in df.collect()}
    own = {r for r in of(found) if r[0][0] in same | {"_sdc_natural_key"}}
    assert own == {r for r in of(I.found_types(as_variant, ("id",))) if r[0][0] in same | {"_sdc_natural_key"}}
    opened = I._leaves(typed, 4).select("stream", "ord", "k1", "k2", "k3", "k4", "code")
    assert sorted(map(str, I._types_of_values(typed, 4).collect())) == sorted(map(str, opened.collect()))
    deep = spark.createDataFrame([(1, (((((1,),),),),))], "id long, o struct<a:struct<b:struct<c:struct<d:struct<e:int>>>>>")
    deep = transform(records_from_table(deep, "id", "o", ord="id"), StreamConfig("s", ("id",)), "t")
    assert I.found_types(deep).filter("deeper").count() == 1


def test_folded_updates_are_shuffled_once(spark):
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = [("s", str(i % 50), f"v{i}", f"t{i:03d}", i % 3 == 0, i) for i in range(200)]
    updates = spark.createDataFrame(rows, UPDATES)
    folded = B.fold_updates(updates, "s")
    assert plan_of(folded.repartition(n, "key")).count("Exchange hashpartitioning") == 1
    assert sorted(map(tuple, folded.collect())) == sorted(map(tuple, B.fold_updates(updates).collect()))
    for buckets in (n, n + 3):  # another bucket count than the session's takes the exchange, and gives the same
        log = BookmarkLog(spark, scratch_uri(spark, "log"), BOOKMARK_SCHEMA, buckets=buckets)
        log.commit(1, log.advance(folded, 1, 0))
        log.commit(2, log.advance(B.fold_updates(updates.limit(10), "s"), 2, 1))
        assert log.read().count() == 50
        for path in (log.info()["base"], *log.info()["deltas"]):
            assert len(glob.glob(f"{path}/*.parquet".replace("file:", ""))) <= buckets


def test_messages_are_compressed(spark, store, records):
    schema = {"properties": {"id": {"type": ["number", "null"]}, "v": {"type": ["string", "null"]}}}
    write_catalog(spark, store.uri, catalog_from_schema(spark, "s", schema))
    lines = [json.dumps({"id": i, "v": "é   text " * 20}, ensure_ascii=False) for i in range(1, 200)]
    run = R.run_extract(records(*lines), StreamConfig("s", ("id",)), store, "t")
    got = [json.loads(r.value)["record"] for r in spark.read.text(f"{run.messages}/records").collect()]
    assert sorted(r["id"] for r in got) == list(range(1, 200)) and {r["v"] for r in got} == {"é   text " * 20}
    files = glob.glob(f"{run.messages}/records/part-*".replace("file:", ""))
    assert files and all(open(f, "rb").read(2) == b"\x1f\x8b" for f in files)


@pytest.mark.parametrize("disambiguate", [False, True])
def test_extraction_keys_are_made_behind_the_lookup(spark, store, records, disambiguate):
    """Equal keys, also of records that hold metadata of their own, and none of them is shuffled."""
    rows = records('{"id":1,"_sdc_timestamp":"old"}', '{"id":0}', '{"id":3,"v":1}')
    cfg = StreamConfig("s", ("id",))
    made = transform_all(rows, cfg, "t2", disambiguate)
    later = with_unique_key(transform_all(rows, cfg, "t2", disambiguate, stamped=False), disambiguate)
    columns = [c for c in made.columns if not c.startswith("rec") and c != "_sdc_natural_key"]
    assert sorted(map(str, later.select(*columns).collect())) == sorted(map(str, made.select(*columns).collect()))
    schema = {"properties": {"id": {"type": ["number", "null"]}, "v": {"type": ["number", "null"]}}}
    write_catalog(spark, store.uri, catalog_from_schema(spark, "s", schema))
    R.run_extract(records('{"id":3,"v":0}'), cfg, store, "t1")
    run = R._begin(rows, cfg, store, "t2", disambiguate=disambiguate)
    staged = glob.glob(f"{run.output}/records/*.parquet".replace("file:", ""))
    assert "_sdc_unique_key" not in spark.read.parquet(*staged).columns
    got = {r.key: r["_sdc_unique_key"] for r in run.routed.collect()}
    assert got == {r.key: r["_sdc_unique_key"] for r in made.collect()}


def test_named_streams_are_written_in_one_pass(spark, store):
    """The frame is worked out once for each stream that is written, and not before to find them."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = [("s", str(i), "c", "t", None) for i in range(50)]
    frame = spark.createDataFrame(rows, BOOKMARK_SCHEMA).mapInArrow(counted, BOOKMARK_SCHEMA)
    assert write_bookmark(spark, store.uri, frame, ["s"]) == {"s": 1}
    assert seen.value == 50 and read_bookmark(spark, store.uri).count() == 50
    assert write_bookmark(spark, store.uri, frame) == {"s": 2} and seen.value == 150
