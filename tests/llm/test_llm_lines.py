"""Line dedup over sorted runs against a plain pass over all lines."""

from collections import Counter, defaultdict

import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from tidemark.llm import line_runs, queries
from tidemark.session import scratch_uri

SF = "/root/testdata/sf0.001"


def key_of(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(line_runs.SPACE))


def plain(rows, least=40, copies=5):
    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= least:
                holders[key_of(line)].add(line_runs.NO_ID if doc_id is None else doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        mine = line_runs.NO_ID if doc_id is None else doc_id
        kept = [x for x in lines if len(holders[key_of(x)]) < copies or mine == max(holders[key_of(x)])]
        out.append((doc_id, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return Counter(out)


def found(df):
    return Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in df.collect())


@pytest.fixture(scope="module")
def lined(odd_texts):
    common = "This line stands on very many pages, Word for word."
    rows = list(odd_texts)
    for i in range(60):
        lines = [common if i % 3 == 0 else f"only here {i} " * 5, "short", f"  {common.upper()}\t" if i % 7 == 0 else ""]
        lines += [f"line of a group of {i // 4} pages, which are four or five" for _ in range(2)]
        lines += [f"line of a group of {i // 6} pages, which are six, \x0b all of them\x0c"]
        rows.append((100 + i % 55, "\n".join(lines)))
    e = "ſ" * 20 + "É" * 19  # 39 code points, many bytes
    rows += [(300 + i, f"{e}\n{e}x\r\n\n") for i in range(6)]
    rows += [(None, common), (None, common), (400, "\n" * 30_000 + common), (401, common), (401, common)]
    return rows


@pytest.mark.parametrize("batches, fan", [(6, 3), (1, 2), (5, 2)])
def test_equals_plain_pass(docs_of, lined, batches, fan):
    got = found(line_runs.line_dedup(docs_of(lined), batches=batches, fan=fan))
    assert got == plain(lined) and sum(n for _, _, _, n in got) > 50


def test_other_bounds(docs_of, lined):
    assert found(line_runs.line_dedup(docs_of(lined), least=3, copies=2)) == plain(lined, 3, 2)


def test_empty(no_docs):
    out = line_runs.line_dedup(no_docs)
    assert out.columns == ["doc_id", "text", "n_lines", "n_dropped"] and out.count() == 0


def test_runs_are_merged_where_they_lie(spark):
    rows = spark.range(3000).select(F.xxhash64("id").alias("h1"), F.xxhash64(-F.col("id")).alias("h2"), F.col("id").alias("doc"))
    runs = line_runs.LineRuns(spark, scratch_uri(spark, "runs"), fan=3)
    for low in (2000, 1500):
        runs.add(rows.filter(F.col("doc") >= low))
    own = rows.groupBy("h1", "h2").agg(F.count_distinct("doc").alias("docs"), F.max("doc").alias("last"))
    with line_runs._order_of_buckets(spark):
        checked = runs.against(own)
        plan = checked._jdf.queryExecution().executedPlan().toString()
        assert checked.filter("keeper is null").count() == 1500
    sides = plan.split("SortMergeJoin")[1:]
    assert len(sides) == 2 and plan.count("Bucketed: true") == 2
    # The batch is exchanged and sorted; no run is.
    assert plan.count(" Sort [") == 1 and plan.count("Exchange") <= 2


def test_levels_and_reopening(spark):
    uri = scratch_uri(spark, "runs")
    rows = spark.range(700).select((F.col("id") % 120).alias("h1"), F.lit(0).cast("bigint").alias("h2"), F.col("id").alias("doc"))
    runs = line_runs.LineRuns(spark, uri, fan=2)
    for i in reversed(range(7)):
        runs.add(rows.filter(F.col("doc").between(100 * i, 100 * i + 99)))
    assert [level for level, _ in runs.runs] == [2, 1, 0]
    again = line_runs.LineRuns(spark, uri, fan=2)
    assert again.runs == runs.runs
    for row in again.merged().collect():
        holders = range(row.h1, 700, 120)
        assert (row.docs, row.keeper) == (len(holders), holders[-1])


def test_sql(spark):
    assert differences(queries.op11_line_dedup(spark, SF), connect(SF), queries.ORACLE["op11_line_dedup"]) == []
