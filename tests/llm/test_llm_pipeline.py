"""The pipeline's stages against their operators, and the driver's contract."""

from collections import Counter

import __spark_entry__ as entry
import corpus_pipeline
import pytest
from test_llm_near_copies import check

from tidemark.llm import near_copies, quality, queries, toxicity
from tidemark.llm.common import freeze, table

SF = "/root/testdata/sf0.001"


def test_registered():
    names = set(entry.queries())
    assert set(queries.QUERIES) <= names and "pipeline" in names
    assert [n for n in range(1, 14) if not any(q.startswith(f"op{n}_") for q in names)] == []
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "near_dedup", "packing"]


def test_stages(spark):
    docs = table(spark, SF, "documents")
    model = toxicity.train(docs, table(spark, SF, "labels"))
    bad = {r.doc_id for r in toxicity.score(docs, model).collect() if r.predicted}
    kept = freeze(corpus_pipeline.STAGES[0][1](spark, docs, SF), "s")
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in docs.collect() if r.doc_id not in bad)
    good = {r.doc_id for r in quality.quality(kept).collect() if r.kept}
    second = freeze(corpus_pipeline.STAGES[1][1](spark, kept, SF), "s")
    assert second.columns == docs.columns and {r.doc_id for r in second.collect()} == good
    third = freeze(corpus_pipeline.STAGES[2][1](spark, second, SF), "s")
    groups = {r.doc_id: r.component_id for r in near_copies.near_groups(second).collect()}
    assert third.columns == docs.columns and sorted(r.doc_id for r in third.collect()) == sorted(set(groups.values()))
    check([(r.doc_id, r.text) for r in second.collect()], [r.doc_id for r in third.collect()])
    last = corpus_pipeline.STAGES[3][1](spark, third, SF).collect()
    assert {r.doc_id for r in last} == {r.doc_id for r in third.collect()}
    assert Counter((r.doc_id, r.start) for r in last) == Counter((r.doc_id, r.start) for r in corpus_pipeline.run(spark, SF).collect())


@pytest.mark.parametrize("name", ["op3_toxicity", "op8_pieces", "op9_warc"])
def test_queries_keep_rows(spark, name):
    of = table(spark, SF, "pages" if name == "op9_warc" else "documents")
    assert queries.QUERIES[name](spark, SF).count() == of.count()
