"""CSV files read by many tasks against the same files read by one."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.sources import csv_split, files


@pytest.fixture
def small_splits(spark):
    before = {n: spark.conf.get(n) for n in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "16")
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def rows_of(got):
    good, bad = got
    return sorted(map(str, good.select("rec.*").collect())), sorted(r.raw for r in bad.collect())


def field(rng):
    plain = "".join(rng.choice("abc é,;") for _ in range(rng.randint(0, 12))).replace(",", "")
    kind = rng.random()
    if kind < 0.5:
        return plain.strip() or "x"
    if kind < 0.6:
        return ""
    inner = "".join(rng.choice(['a', ',', '\n', '""', 'é', ' ', '\n\n']) for _ in range(rng.randint(0, 60 if kind > 0.97 else 8)))
    return f'"{inner}"'


@pytest.mark.parametrize("seed", range(3))
def test_equals_one_task(spark, tmp_path, small_splits, seed):
    rng = random.Random(seed)
    for name in "ab":
        lines = ["id,x,y"] + [f"{i},{field(rng)},{field(rng)}" for i in range(120)]
        (tmp_path / f"{name}.csv").write_text("\n".join(lines) + ("\n" if name == "a" else ""))
    whole = rows_of(files.read_csv(spark, str(tmp_path), on_bad="quarantine", split=False))
    lines = csv_split.split_lines(spark, str(tmp_path))
    assert lines.select("path", "block").distinct().count() > 30 and csv_split.open_splits(lines).count() > 3
    assert rows_of(files.read_csv(spark, str(tmp_path), on_bad="quarantine", split=True)) == whole
    assert len(whole[0]) == 240 and whole[1] == []


def test_a_field_over_many_splits(spark, tmp_path, small_splits):
    long = "\n".join(["a" * 10] * 100)
    (tmp_path / "a.csv").write_text(f'id,x\n1,"{long}"\n2,y\n3,"{long}""{long}"\n4,"unclosed\n')
    got = files.read_csv(spark, str(tmp_path), on_bad="keep", split=True)
    values = {r.id: r.x for r in got.select("rec.*").collect()}
    assert values["1"] == long and values["2"] == "y" and values["3"] == f'{long}"{long}' and set(values) == {"1", "2", "3", "4"}


def test_ragged_rows_and_line_ends(spark, tmp_path, small_splits):
    (tmp_path / "a.csv").write_bytes(b'id,x\r\n1,"a\r\nb"\r\n\r\n2\r\n3,z,w\r\n4,\r\n' * 1)
    got = files.read_csv(spark, str(tmp_path), on_bad="keep", split=True).select("rec.*", "raw", "reason").collect()
    assert sorted((r.id, r.x) for r in got if r.reason is None) == [("1", "a\nb"), ("4", "")]
    assert sorted(r.raw for r in got if r.reason) == ["2", "3,z,w"]
    with pytest.raises(Exception, match="does not fit the header"):
        files.read_csv(spark, str(tmp_path), split=True).count()


def test_files_of_a_header_alone(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,x\n")
    (tmp_path / "b.csv").write_text("id,x\n1,y")
    (tmp_path / "c.csv").write_text("")
    got = files.read_csv(spark, str(tmp_path), split=True)
    assert [tuple(r) for r in got.select("rec.*").collect()] == [("1", "y")]


def test_large_files_are_split(spark, tmp_path, small_splits):
    (tmp_path / "a.csv").write_text("id\n" + "\n".join(map(str, range(200))))
    assert files.Files(spark).largest(str(tmp_path)) > 64
    assert files.read_csv(spark, str(tmp_path)).rdd.getNumPartitions() > 5
    assert files.read_csv(spark, str(tmp_path)).agg(F.sum(F.col("rec.id").cast("int"))).first()[0] == 19900


def test_splits_of_a_large_file_are_bounded(spark, monkeypatch):
    """The query reads a file in pieces that grow with it, so that tasks don't become more and more."""
    import queries
    from tidemark.sources import csv_split

    made, lines = [], csv_split.split_lines

    def counted(session, uri):
        out = lines(session, uri)
        made.append(out.rdd.getNumPartitions())
        return out

    monkeypatch.setattr(csv_split, "split_lines", counted)
    for sf, least, most in (("sf0.01", 10, 70), ("sf0.1", 10, 70)):
        made.clear()
        queries.csv_scan_split(spark, f"/root/testdata/{sf}")
        assert made and all(least <= n <= most for n in made)
