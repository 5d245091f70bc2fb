"""The bookmark as base files and deltas: what is written, read, exchanged and kept."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from tidemark import StreamConfig
from tidemark.operators.bookmark import BOOKMARK_SCHEMA, advance_bookmark, fold_updates
from tidemark.operators.catalog import catalog_from_schema
from tidemark.plans import run as R
from tidemark.session import scratch_uri
from tidemark.sources import bookmark_log
from tidemark.sources.bookmark_log import BookmarkLog
from tidemark.sources.store import StaleRun, write_catalog

UPDATES = "stream string, key string, surrogate_key string, ts string, emitted boolean, ord long"


@pytest.fixture
def log(spark):
    return BookmarkLog(spark, scratch_uri(spark, "log"), BOOKMARK_SCHEMA, buckets=4, ratio=0.5, most=3)


def folded(spark, version, keys):
    rows = [("s", str(k), f"v{version}-{k}", f"t{version}", k % 2 == 0, k) for k in keys]
    return fold_updates(spark.createDataFrame(rows, UPDATES))


def advance(log, version, keys):
    path = log.advance(folded(log.spark, version, keys), version, version - 1)
    log.commit(version, path)
    return log.info()


def rows(df):
    return sorted(map(tuple, df.collect()))


def written(facts):
    names = glob.glob(f"{facts['path']}/*.parquet")
    return names


def test_equals_merging_all_keys(spark, log):
    """Versions of a log hold what full outer joins of everything give."""
    plain = None
    for version, keys in enumerate([range(100), range(90, 110), [5, 95, 200], range(0, 100, 3), [7], [7, 8], range(300)], 1):
        update = folded(spark, version, keys)
        plain = rows(update if plain is None else advance_bookmark(spark.createDataFrame(plain, BOOKMARK_SCHEMA), update))
        advance(log, version, keys)
        assert rows(log.read()) == plain
        if version == 2:
            second = plain
    assert rows(log.read(2)) == second


def test_a_run_writes_its_own_keys_until_deltas_outgrow_the_base(spark, log):
    first = advance(log, 1, range(1000))
    assert (first["base_rows"], first["deltas"], first["base"]) == (1000, [], first["path"])
    for version in (2, 3, 4):
        facts = advance(log, version, [version, 5000 + version])
        assert facts["base"] == first["base"] and len(facts["deltas"]) == version - 1
        assert spark.read.parquet(facts["path"]).count() == 2 == facts["added_rows"]
    many = advance(log, 5, [1])  # a fourth delta is one too many
    assert many["deltas"] == [] and many["base_rows"] == 1003 and many["base"] != first["base"]
    large = advance(log, 6, range(600))
    assert large["deltas"] == [] and large["base_rows"] == 1003
    path = log.advance(folded(spark, 7, range(2000)), 7, 6, updates=2000)  # merged at once
    log.commit(7, path)
    assert log.info()["base"] == path and "added_rows" not in log.info() and log.read().count() == log.info()["base_rows"] == 2003
    # One sorted file a bucket: the order of a scan follows from it.
    assert len(glob.glob(f"{large['base']}/*.parquet".replace("file:", ""))) <= 4


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bookmark_is_not_exchanged(spark, log):
    """Neither for lookups nor for merges do base and deltas pass an exchange or a sort."""
    advance(log, 1, range(2000))
    advance(log, 2, range(100))
    keys = spark.range(1500).select(F.lit("s").alias("stream"), F.col("id").cast("string").alias("key"))
    uri = scratch_uri(spark, "keys")
    keys.write.parquet(uri)
    keys = spark.read.parquet(uri)
    with bookmark_log.co_located(spark):
        found = log._found(keys, log.parts(2), 1500, log._layout(2))
        plan = plan_of(found)
    assert plan.count("SortMergeJoin") == 2 and plan.count("Bucketed: true") == 2
    assert plan.count("Exchange") == 1 and plan.count(" Sort [") == 1
    with bookmark_log.co_located(spark):
        merged = plan_of(log.read(2))
    assert merged.count("SortMergeJoin") == 1 and "Exchange" not in merged and " Sort [" not in merged


@pytest.mark.parametrize("n", [3, 1500])
def test_lookups(spark, log, n, monkeypatch):
    """Listed keys, filtered scans and plain joins find the same; scans give little more than what is asked for."""
    advance(log, 1, range(20_000))
    advance(log, 2, range(0, 50))
    keys = spark.range(n).select(F.lit("s").alias("stream"), (F.col("id") * 13 - 26).cast("string").alias("key"))
    keys = keys.union(keys).union(spark.createDataFrame([("s", None), ("other", "13")], "stream string, key string"))
    want = {("s", str(k), f"v{2 if k < 50 else 1}-{k}") for k in range(-26, 13 * n - 26, 13) if 0 <= k < 20_000}
    assert set(map(tuple, log.known(keys).collect())) == want
    monkeypatch.setattr(bookmark_log, "LISTED_KEYS", 0)
    assert set(map(tuple, log.known(keys).collect())) == want
    near = bookmark_log.may_hold(log.parts(2)[0], bookmark_log.key_filter(keys.filter("key IS NOT NULL")))
    assert {(r.stream, r.key) for r in near.collect()} >= {(s, k) for s, k, _ in want} and near.count() < n + 100
    monkeypatch.setattr(bookmark_log, "BITS_A_KEY", 1 << 40)
    assert set(map(tuple, log.known(keys).collect())) == want


def test_a_full_filter_loses_nothing(spark):
    keys = spark.range(5000).select(F.lit("s").alias("stream"), F.col("id").cast("string").alias("key"))
    bits = bookmark_log.key_filter(keys, words=16)
    assert bits.count() == 16 and bookmark_log.may_hold(keys, bits, words=16).count() == 5000


def test_few_keys_read_few_buckets(spark):
    """Keys of a small batch reach the scan, which opens their buckets alone."""
    log = BookmarkLog(spark, scratch_uri(spark, "log"), BOOKMARK_SCHEMA, buckets=32)
    advance(log, 1, range(3000))
    keys = spark.createDataFrame([("s", "17")], "stream string, key string")
    with bookmark_log.co_located(spark):
        found = log._found(keys, log.parts(1), 1, log._layout(1))
        assert "SelectedBucketsCount: 1 out of 32" in found._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )
    assert [r.surrogate_key for r in log.known(keys).collect()] == ["v1-17"]


def test_stale_and_replayed_versions(spark, log):
    advance(log, 1, range(10))
    advance(log, 2, [1])
    with pytest.raises(StaleRun):
        log.commit(2, log.advance(folded(spark, 2, [3]), 2, 1))
    log.commit(2, log.advance(folded(spark, 2, [3]), 2, 1), replay=True)
    assert {r.key for r in log.read().filter("last_seen = 't2'").collect()} == {"3"}


def test_shared_folders_outlive_their_version(spark, log):
    first = advance(log, 1, range(100))
    second = advance(log, 2, [1])
    advance(log, 3, [2])
    log.retain(1)
    assert log.read().count() == 100 and os.path.exists(first["base"].replace("file:", "")) and second["path"] in log.info()["deltas"]
    advance(log, 4, range(80))
    log.retain(1)
    assert log.read().count() == 100 and not os.path.exists(first["base"].replace("file:", ""))
    assert not os.path.exists(second["path"].replace("file:", ""))


def test_state_of_an_older_layout(spark, log):
    """A version written as one plain folder is read, and becomes the base of a log."""
    path = f"{log.uri}/old"
    folded(spark, 1, range(10)).write.parquet(path)
    super(BookmarkLog, log).commit(1, path)
    assert log.read().count() == 10
    keys = spark.createDataFrame([("s", "3")], "stream string, key string")
    assert log.known(keys).first().surrogate_key == "v1-3"
    facts = advance(log, 2, [3, 11])
    assert facts["base_rows"] == 11 and log.read().count() == 11


def test_runs_with_a_crowded_key(spark, store, records):
    """A key that holds most of a run is looked up once."""
    cfg = StreamConfig("s", ("id",))
    schema = {"properties": {"id": {"type": ["number", "null"]}, "v": {"type": ["number", "null"]}}}
    write_catalog(spark, store.uri, catalog_from_schema(spark, "s", schema))
    rows = [f'{{"id":{1 if i % 3 else i + 2},"v":7}}' for i in range(300)]
    R.run_extract(records(*rows), cfg, store, "t1")
    again = R.run_extract(records(*rows, '{"id":1,"v":8}'), cfg, store, "t2")
    assert again.metrics["emitted"] == 1 and again.metrics["filtered_bookmark"] == 300
    assert again.metrics["processed"] == 301 == again.metrics["emitted"] + again.metrics["not_emitted_total"]


def test_source_is_scanned_once(spark, store, tmp_path):
    """Unreadable lines leave in the pass that routes records."""
    (tmp_path / "a.jsonl").write_text('{"id":1}\nbad\n')
    cfg = StreamConfig("s", ("id",), "jsonl", str(tmp_path))
    routed = R.outcomes_of(R.read_source(spark, cfg), cfg, None, {"properties": {}}, "t")
    assert plan_of(routed).count("FileScan") == 1
    assert sorted((r.outcome, r.text, r.reason is None) for r in routed.collect()) == [
        ("emitted", '{"id":1}', True), ("rejected", "bad", False)
    ]
