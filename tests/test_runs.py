"""Invariants of whole runs, of the stored state and of streams."""

import json
import os

import derived as X
import pytest
from pyspark.sql import functions as F

from tidemark import StreamConfig
from tidemark.operators import outcomes as O
from tidemark.operators.bookmark import join_bookmark, unseen_keys
from tidemark.operators.catalog import catalog_from_schema
from tidemark.operators.transform import transform, transform_all
from tidemark.plans import run as R
from tidemark.sources import files
from tidemark.sources.store import StaleRun, read_bookmark, write_catalog
from tidemark.streaming.changes import _extract_batch, stream_changes

SF = "/root/testdata/sf0.001"
CFG = StreamConfig("s", ("id",))
SCHEMA = {
    "type": "object",
    "properties": {"id": {"type": ["number", "null"]}, "v": {"type": ["number", "null"]}},
}


def emitted(spark, run):
    lines = [json.loads(r.value) for r in spark.read.text(f"{run.messages}/records").collect()]
    return sorted((m["record"]["id"], m["record"].get("v")) for m in lines)


def state(store):
    return {r.key: (r.last_seen, r.last_emitted) for r in store.of("s").bookmark.read().collect()}


@pytest.fixture
def ready(spark, store):
    write_catalog(spark, store.uri, catalog_from_schema(spark, "s", SCHEMA))
    return store


def test_runs(spark, ready, records):
    first = R.run_extract(records('{"id":1,"v":1}', '{"id":2,"v":1}', '{"id":0}'), CFG, ready, "t1")
    assert emitted(spark, first) == [(1, 1), (2, 1)]
    assert first.metrics["processed"] == 3 and first.metrics["transform_failed"] == 1

    again = R.run_extract(records('{"v":1,"id":1}', '{"id":2,"v":1}'), CFG, ready, "t2")
    assert emitted(spark, again) == [] and again.metrics["filtered_bookmark"] == 2
    assert state(ready) == {"1": ("t2", "t1"), "2": ("t2", "t1")}

    # One changed, one invalid: the invalid one leaves its bookmark row alone.
    third = R.run_extract(records('{"id":1,"v":5}', '{"id":2,"v":"x"}', '{"id":3}'), CFG, ready, "t3")
    assert emitted(spark, third) == [(1, 5), (3, None)]
    assert state(ready) == {"1": ("t3", "t3"), "2": ("t2", "t1"), "3": ("t3", "t3")}
    bad = spark.read.parquet(third.rejects).collect()
    assert [(r.key, r.errors) for r in bad] == [("2", ["v: type is not number|null"])]
    m = third.metrics
    assert m["processed"] == m["emitted"] + m["not_emitted_total"] == 3

    rejected = spark.read.parquet(third.rejects)
    gone = unseen_keys(ready.of("s").bookmark.read(), "t3")
    assert [r.key for r in gone.collect()] == ["2"]
    assert unseen_keys(ready.of("s").bookmark.read(), "t3", rejected).isEmpty()

    refreshed = R.run_refresh(records('{"id":1,"v":5}', '{"id":3}'), CFG, ready, run_ts="t4")
    assert emitted(spark, refreshed) == [(1, 5), (3, None)]
    assert state(ready)["1"] == ("t4", "t4") and state(ready)["2"] == ("t2", "t1")


def test_repeats_within_a_run(spark, ready, records):
    run = R.run_extract(records('{"id":1,"v":1}', '{"id":1,"v":2}', '{"id":1,"v":1}'), CFG, ready, "t1")
    assert emitted(spark, run) == [(1, 1), (1, 1), (1, 2)]
    next_run = R.run_extract(records('{"id":1,"v":1}'), CFG, ready, "t2")
    assert emitted(spark, next_run) == []


def test_extraction_needs_a_catalog(store, records):
    with pytest.raises(ValueError, match="run discovery first"):
        R.run_extract(records('{"id":1}'), CFG, store)


def test_discovery(spark, store, records):
    schema = R.run_discover(records('{"id":1,"a":{"b":{"c":{"d":{"e":{"f":true}}}}}}', '{"id":0,"q":1}'), CFG, store, "t1")
    node = schema["properties"]["a"]
    for key in "bcde":
        node = node["properties"][key]
    assert node["properties"] == {"f": {"type": ["boolean", "null"]}} and "q" not in schema["properties"]
    message = json.loads(spark.read.text(store.of("s").catalog.info()["schema_message"]).first().value)
    assert message["schema"] == schema and store.of("s").bookmark.info() is None
    later = R.run_discover(records('{"id":2,"q":"x","a":5}'), CFG, store, "t2")
    assert later["properties"]["q"] == {"type": ["string", "null"]}
    assert later["properties"]["a"] == schema["properties"]["a"]
    with pytest.raises(ValueError, match="no properties"):
        R.run_discover(records('{"id":0}'), StreamConfig("other", ("id",)), store)


def test_csv_run(spark, ready, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n0,x\n,y\n2,\n")
    cfg = StreamConfig("s", ("id",), "csv", str(tmp_path), sensitive_field_paths=(("name",),))
    R.run_discover(R.read_source(spark, cfg), cfg, ready)
    # The string "0" is a key, and the catalog wants a number for it.
    got = R.outcomes_of(R.read_source(spark, cfg), cfg, None, SCHEMA, "t").select("key", "outcome")
    assert sorted(map(tuple, got.collect()), key=str) == [
        ("0", O.INVALID), ("2", O.INVALID), (None, O.TRANSFORM_FAILED)
    ]


def test_failed_run_leaves_the_state(spark, ready, records):
    R.run_extract(records('{"id":1}'), CFG, ready, "t1")
    before = ready.of("s").bookmark.info()
    boom = records('{"id":2}').withColumn("rec", F.raise_error(F.lit("source broke")).cast("variant"))
    with pytest.raises(Exception, match="source broke"):
        R.run_extract(boom, CFG, ready, "t2")
    assert ready.of("s").bookmark.info() == before and list(state(ready)) == ["1"]


def test_outcomes_do_not_depend_on_partitions(spark):
    outcome = lambda n: sorted(
        map(tuple, R.outcomes_of(
            X.orders_stream(spark, SF).repartition(n), X.ORDERS, X.orders_bookmark(spark, SF),
            X.ORDERS_SCHEMA, X.RUN_TS,
        ).collect()), key=str)
    assert outcome(1) == outcome(7)


def test_typed_and_json_records_agree(spark):
    columns = ["key", "text", "_sdc_surrogate_key", "_sdc_unique_key"]
    typed = transform(X.orders_stream(spark, SF), X.ORDERS, X.RUN_TS).select(*columns)
    parsed = transform(X.orders_json(spark, SF), X.ORDERS, X.RUN_TS).select(*columns)
    assert typed.exceptAll(parsed).isEmpty() and parsed.exceptAll(typed).isEmpty()


def plan(df):
    return df._jdf.queryExecution().toString()


def test_dropped_columns_are_not_read(spark):
    df = transform_all(X.orders_stream(spark, SF), X.ORDERS, X.RUN_TS)
    assert "o_orderpriority" not in plan(df).split("ReadSchema")[1]


def test_transform_has_no_shuffle(spark):
    assert "Exchange" not in plan(transform_all(X.orders_json(spark, SF), X.ORDERS, X.RUN_TS))
    cold = R.outcomes_of(X.orders_stream(spark, SF), X.ORDERS, None, X.ORDERS_SCHEMA, X.RUN_TS)
    assert "Exchange" not in plan(cold)


def test_hot_key_is_split(spark):
    """A key with a third of the records does not make one long task of the bookmark join."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        n = F.col("id")
        df = spark.range(0, 60000, 1, 16).select(
            F.lit("s").alias("stream"), n.alias("ord"),
            F.when(n % 3 == 0, "hot").when(n % 3 == 1, n.cast("string")).alias("key"),
            F.sha2(n.cast("string"), 512).alias("_sdc_surrogate_key"),
        )
        bookmark = spark.range(0, 60000).select(
            F.lit("s").alias("stream"), F.when(n == 0, "hot").otherwise(n.cast("string")).alias("key"),
            F.sha2(n.cast("string"), 256).alias("surrogate_key"),
        )
        joined = join_bookmark(df, bookmark)
        counts = joined.groupBy(F.col("previous_surrogate_key").isNull().alias("new")).count()
        out = {r["new"]: r["count"] for r in counts.collect()}
        assert out == {False: 40000, True: 20000}
        assert joined.count() == 60000
        joined.write.format("noop").mode("overwrite").save()
        joined.collect()
        assert "skewed" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_stream_replay_is_idempotent(spark, ready, records):
    batch = records('{"id":1,"v":1}')
    _extract_batch(batch, 0, CFG, ready, "ck", False)
    changed = records('{"id":1,"v":2}')
    _extract_batch(changed, 1, CFG, ready, "ck", False)
    info, rows = ready.of("s").bookmark.info(), state(ready)
    first = emitted(spark, R.RunResult(2, ready.of("s").bookmark.info()["outputs"][0] + "/messages", "", {}))
    _extract_batch(changed, 1, CFG, ready, "ck", False)
    assert emitted(spark, R.RunResult(2, ready.of("s").bookmark.info()["outputs"][0] + "/messages", "", {})) == first == [(1, 2)]
    after = ready.of("s").bookmark.info()
    # A run has folders and an end of its own; everything else is as it was.
    own = {"metrics", "path", "base", "outputs", "last_extraction_ended_at"}
    assert state(ready) == rows and {k: after[k] for k in after.keys() - own} == {k: info[k] for k in info.keys() - own}


def test_stream_reaches_the_state_of_a_batch_run(spark, ready, tmp_path):
    landing = tmp_path / "landing"
    os.makedirs(landing)
    for i in range(3):
        (landing / f"{i}.jsonl").write_text(f'{{"id":{i + 1},"v":{i}}}\n{{"id":9,"v":{i}}}\n')
        os.utime(landing / f"{i}.jsonl", (1_700_000_000 + i, 1_700_000_000 + i))
    stream_changes(
        files.stream_jsonl(spark, str(landing), max_files=1), CFG, ready, str(tmp_path / "ck"), files.jsonl_rows
    ).awaitTermination()
    assert ready.of("s").bookmark.version() == 3
    sk = {r.key: r.surrogate_key for r in ready.of("s").bookmark.read().collect()}
    want = transform(files.read_jsonl(spark, str(landing / "2.jsonl")), CFG, "t").collect()
    assert set(sk) == {"1", "2", "3", "9"}
    assert {r.key: r["_sdc_surrogate_key"] for r in want}.items() <= sk.items()


def test_empty_run(spark, ready, records):
    R.run_extract(records('{"id":1}'), CFG, ready, "t1")
    run = R.run_extract(records('{"id":1}').filter("false"), CFG, ready, "t2")
    assert run.metrics["processed"] == 0 and emitted(spark, run) == []
    assert spark.read.parquet(run.rejects).isEmpty() and state(ready) == {"1": ("t1", "t1")}


def test_two_streams_in_one_store(spark, ready, records):
    """Both begin from nothing, as runs side by side do; neither touches the other's state or output."""
    other = StreamConfig("t", ("id",))
    write_catalog(spark, ready.uri, catalog_from_schema(spark, "t", SCHEMA))
    one = R.run_extract(records('{"id":1}', '{"id":2}'), CFG, ready, version=1, previous=0)
    two = R.run_extract(records('{"id":1}'), other, ready, version=1, previous=0)
    assert read_bookmark(spark, ready.uri, ["s"]).count() == 2 and read_bookmark(spark, ready.uri).count() == 3
    assert spark.read.text(f"{one.messages}/records").count() == 2
    assert spark.read.text(f"{two.messages}/records").count() == 1


def test_a_stale_run_does_not_commit(spark, ready, records):
    R.run_extract(records('{"id":1}'), CFG, ready, version=1, previous=0)
    with pytest.raises(StaleRun):
        R.run_extract(records('{"id":2}'), CFG, ready, version=1, previous=0)
    assert [r.key for r in ready.of("s").bookmark.read().collect()] == ["1"]


def test_old_versions_go(spark, ready, records):
    for i in range(4):
        result = R.run_extract(records(f'{{"id":{i + 1}}}'), CFG, ready, keep_versions=2)
    table = ready.of("s").bookmark
    assert result.version == table.version() == 4 and table.read(3).count() == 3 and table.read().count() == 4
    with pytest.raises(ValueError, match="not there"):
        table.read(2)
    assert table.info()["updated_at"] == table.info()["last_extraction_started_at"]


def test_discovery_of_nothing(spark, store, records):
    with pytest.raises(ValueError, match="found no properties"):
        R.run_discover(records("null"), CFG, store)
    assert R.run_discover(records("null"), CFG, store, needs_records=False) is None
    known = R.run_discover(records('{"id":1}'), CFG, store)
    assert R.run_discover(records("null"), CFG, store) == known


def test_settings_are_checked(spark, ready, records):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        with pytest.raises(ValueError, match="timeZone"):
            R.run_extract(records('{"id":1}'), CFG, ready)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_keys_that_differ_by_case(spark, store, records):
    rows = records('{"id":1,"ID":"x","n":{"a":1,"A":2}}', '{"id":2,"ID":"y","n":{"a":3,"A":"no"}}')
    R.run_discover(rows, CFG, store)
    result = R.run_extract(rows, CFG, store)
    assert (result.metrics["emitted"], result.metrics["schema_validation_failed"]) == (1, 1)


def test_many_streams_equal_runs_of_each(spark, ready, records, tmp_path):
    """First runs, later ones and refreshes of streams of unlike records, also where one has nothing new."""
    from tidemark.session import scratch_uri
    from tidemark.sources.store import Store

    (tmp_path / "a.jsonl").write_text('{"id":1}\nbad\n{"id":2}\n')
    odd = StreamConfig("a b/=\u00e9", ("id",), "jsonl", str(tmp_path / "a.jsonl"))
    typed = X.orders_stream(spark, SF)
    rounds = [
        [(records('{"id":1,"v":1}', '{"id":2,"v":"no"}'), CFG), (R.read_source(spark, odd), odd), (typed, X.ORDERS)],
        [(records('{"id":1,"v":2}', '{"id":0}'), CFG), (R.read_source(spark, odd), odd), (typed.filter("ord < 50"), X.ORDERS)],
        [(records('{"id":5}').filter("false"), CFG), (R.read_source(spark, odd), odd)],
    ]
    each, many = Store(spark, scratch_uri(spark, "each")), Store(spark, scratch_uri(spark, "many"))
    for s in (each, many):
        write_catalog(spark, s.uri, catalog_from_schema(spark, "s", SCHEMA))
        for source, cfg in rounds[0][1:]:
            R.run_discover(source, cfg, s, "t0")
    for i, sources in enumerate(rounds):
        ts, refresh = f"2024-01-0{i + 1}T00:00:00Z", i == 2
        together = R.run_extract_many(sources, many, ts, refresh)
        for source, cfg in sources:
            alone = R.run_extract(source, cfg, each, ts, refresh)
            got = together[cfg.stream_name]
            counted = lambda m: {k: v for k, v in m.items() if "_s" not in k or k.startswith("schema")} | {"processed_per_second": 0}
            assert counted(got.metrics) == counted(alone.metrics) and got.version == alone.version == i + 1
            for part in ("records", "schema"):
                lines = lambda run, p=part: sorted(r.value for r in spark.read.text(f"{run.messages}/{p}").collect())
                assert lines(got) == lines(alone)
            rows = lambda run: sorted(map(str, spark.read.parquet(run.rejects).collect()))
            assert rows(got) == rows(alone)
        state_of = lambda s: sorted(map(tuple, read_bookmark(spark, s.uri).collect()), key=str)
        assert state_of(many) == state_of(each)
    assert together["s"].metrics["processed"] == 0 and together[odd.stream_name].metrics["rejected"] == 1
    with pytest.raises(ValueError, match="named twice"):
        R.run_extract_many([rounds[0][0], rounds[0][0]], many)
    assert R.run_extract_many([], many) == {}
