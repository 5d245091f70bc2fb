"""Lines that give no record, through whole runs."""

import pytest

from tidemark import StreamConfig
from tidemark.operators.catalog import catalog_from_schema
from tidemark.plans import run as R
from tidemark.sources import files
from tidemark.sources.store import write_catalog
from tidemark.streaming.changes import stream_changes

LINES = '{"id":1}\nbad\n[1]\n\n' + "[" * 1200 + "]" * 1200 + "\n"


@pytest.fixture
def ready(spark, store):
    schema = {"type": "object", "properties": {"id": {"type": ["number", "string", "null"]}}}
    write_catalog(spark, store.uri, catalog_from_schema(spark, "s", schema))
    return store


def check(spark, store, rejects, bad):
    metrics = store.of("s").bookmark.info()["metrics"]
    assert metrics["rejected"] == len(bad) and metrics["emitted"] == 1
    assert metrics["processed"] == metrics["emitted"] + metrics["not_emitted_total"] == 1 + len(bad)
    rows = spark.read.parquet(rejects).collect()
    assert sorted(r.raw for r in rows) == sorted(bad)
    assert all(r.outcome == "rejected" and r.key is None and len(r.errors) == 1 and r.errors[0] for r in rows)
    assert [r.key for r in store.of("s").bookmark.read().collect()] == ["1"]


def test_batch(spark, ready, tmp_path):
    (tmp_path / "a.jsonl").write_text(LINES)
    cfg = StreamConfig("s", ("id",), "jsonl", str(tmp_path / "a.jsonl"))
    R.run_discover(R.read_source(spark, cfg), cfg, ready)
    done = R.run_extract(R.read_source(spark, cfg), cfg, ready)
    check(spark, ready, done.rejects, LINES.split("\n")[1:3] + LINES.split("\n")[4:5])
    hidden = StreamConfig("s", ("id",), "jsonl", str(tmp_path / "a.jsonl"), sensitive_field_paths=(("x",),))
    done = R.run_extract(R.read_source(spark, hidden), hidden, ready)
    assert all(r.raw.startswith("sha256:") for r in spark.read.parquet(done.rejects).collect())
    cfg = StreamConfig("s", ("id",), "jsonl", str(tmp_path / "a.jsonl"), on_bad="fail")
    with pytest.raises(Exception, match="a line is not"):
        R.run_extract(R.read_source(spark, cfg), cfg, ready)


@pytest.mark.parametrize("kind", ["jsonl", "csv"])
def test_stream(spark, ready, tmp_path, kind):
    landing = tmp_path / "in"
    landing.mkdir()
    (landing / "a").write_text(LINES if kind == "jsonl" else "id,b\n1,x\nshort\n")
    if kind == "jsonl":
        arriving, parse = files.stream_jsonl(spark, str(landing)), files.jsonl_parsed
        bad = LINES.split("\n")[1:3] + LINES.split("\n")[4:5]
    else:
        arriving, parse = files.stream_csv(spark, str(landing), files.csv_schema(spark, str(landing))), files.csv_parsed
        bad = ["short"]
    stream_changes(arriving, StreamConfig("s", ("id",)), ready, str(tmp_path / "ck"), parse).awaitTermination()
    check(spark, ready, ready.of("s").bookmark.info()["outputs"][0] + "/rejects", bad)


def test_discovery_keeps_rejects(spark, store, tmp_path):
    (tmp_path / "a.jsonl").write_text(LINES)
    cfg = StreamConfig("s", ("id",), "jsonl", str(tmp_path / "a.jsonl"))
    R.run_discover(R.read_source(spark, cfg), cfg, store, "t1")
    facts = store.of("s").catalog.info()
    rows = spark.read.parquet(facts["rejects"]).collect()
    assert facts["rejected"] == 3 == len(rows) and {r.outcome for r in rows} == {"rejected"}
    assert sorted(r.raw for r in rows) == sorted(LINES.split("\n")[1:3] + LINES.split("\n")[4:5])
    clean = tmp_path / "b.jsonl"
    clean.write_text('{"id":2}\n')
    other = StreamConfig("s", ("id",), "jsonl", str(clean))
    R.run_discover(R.read_source(spark, other), other, store, "t2")
    assert "rejects" not in store.of("s").catalog.info()


def test_discovery_of_bad_lines_alone(spark, store, tmp_path):
    """They are told of, whether a catalog is there or not; the catalog stays."""
    (tmp_path / "a.jsonl").write_text("bad\n[1]\n")
    cfg = StreamConfig("s", ("id",), "jsonl", str(tmp_path / "a.jsonl"), sensitive_field_paths=(("x",),))
    with pytest.raises(ValueError, match="2 lines gave no record"):
        R.run_discover(R.read_source(spark, cfg), cfg, store, "t1")
    write_catalog(spark, store.uri, catalog_from_schema(spark, "s", {"properties": {"id": {"type": "number"}}}))
    schema = R.run_discover(R.read_source(spark, cfg), cfg, store, "t2", needs_records=False)
    facts = store.of("s").catalog.info()
    assert facts["rejected"] == 2 and "id" in schema["properties"]
    assert all(r.raw.startswith("sha256:") for r in spark.read.parquet(facts["rejects"]).collect())


def test_items_that_are_no_objects(spark, store):
    body = '{"results":[{"id":1},7,"x",null,[1],{"id":2}]}'
    pages = spark.createDataFrame([("http://h", '{"results":[{"id":9}]}', 1), ("http://h", body, 2)], "url string, body string, landed_at long")
    cfg = StreamConfig("s", ("id",), "rest", "http://h", records_path=("results",))
    source = R.read_source(spark, cfg, pages)
    R.run_discover(source, cfg, store, "t1")
    assert store.of("s").catalog.info()["rejected"] == 4
    run = R.run_extract(source, cfg, store)
    assert (run.metrics["emitted"], run.metrics["rejected"], run.metrics["processed"]) == (2, 4, 6)
    rows = spark.read.parquet(run.rejects).collect()
    assert sorted(r.raw for r in rows) == ['"x"', "7", "[1]", "null"] and {tuple(r.errors) for r in rows} == {("is not an object",)}
    assert sorted(r.key for r in store.of("s").bookmark.read().collect()) == ["1", "2"]
