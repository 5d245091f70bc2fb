"""Lines and rows that give no record, in batch and in micro-batches."""

import pytest
from pyspark.sql import functions as F

from tidemark.session import check_settings
from tidemark.sources import files


def test_bad_lines_are_kept_with_reasons(spark, tmp_path):
    deep = "[" * 1200 + "]" * 1200
    (tmp_path / "a.jsonl").write_text(f'{{"id":1}}\n\n  \nbad\n[1]\n5\nnull\n{deep}\n')
    good, bad = files.read_jsonl(spark, str(tmp_path), on_bad="quarantine")
    assert good.count() == 2
    reasons = [r.reason for r in bad.orderBy("ord").collect()]
    assert [r.startswith("is not JSON") for r in reasons] == [True, False, False, True]
    with pytest.raises(Exception, match="a line is not"):
        files.read_jsonl(spark, str(tmp_path), on_bad="fail").count()
    with pytest.raises(ValueError, match="on_bad"):
        files.read_jsonl(spark, str(tmp_path), on_bad="drop")


def test_repeated_keys_need_their_setting(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"a":1,"a":2}\n{"a":1}\n')
    assert files.read_jsonl(spark, str(tmp_path)).count() == 2
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "false")
    try:
        with pytest.raises(ValueError, match="allowDuplicateKeys"):
            files.read_jsonl(spark, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    check_settings(spark)


def test_ragged_rows_of_a_csv_stream(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    (landing / "a.csv").write_text('id,b,c\n1,x,y\n3,short\n4,"q,1",\n')
    seen = []

    def on_batch(batch, _):
        seen.append((files.csv_rows(batch).select("rec.*").collect(), files.csv_rejects(batch).collect()))

    stream = files.stream_csv(spark, str(landing), files.csv_schema(spark, str(landing)))
    query = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True)
    query.start().awaitTermination()
    rows, bad = seen[0]
    assert sorted(tuple(r) for r in rows) == [("1", "x", "y"), ("4", "q,1", "")] and [r.raw for r in bad] == ["3,short"]


def test_csv_error_tells_no_values(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,b\nsecret\n")
    with pytest.raises(Exception, match="does not fit") as e:
        files.read_csv(spark, str(tmp_path)).select(F.col("rec.b")).collect()
    assert "secret" not in str(e.value).split("does not fit")[1][:200]
