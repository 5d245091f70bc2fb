"""Ranked lexical search against a loop over all documents, in Python's integers."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from compare import connect, differences

from tidemark.llm import lexical, queries

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, keep):
    own = [(doc_id, Counter(terms(text)), len(terms(text))) for doc_id, text in docs]
    n_docs, n_terms = sum(n > 0 for *_, n in own), sum(n for *_, n in own)
    df = Counter(t for _, counts, _ in own for t in counts)
    out = []
    for item_id, text in items:
        scores = []
        for doc_id, counts, n in own:
            score = 0
            for t in terms(text):
                if t in counts:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    m = 100 - 25 + 25 * n * n_docs // n_terms
                    score += w * (10**9 * counts[t] // (1000 * counts[t] + 12 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, r, x[3], -x[0]) for r, x in enumerate(sorted(scores, key=lambda x: x[:3])[:keep], 1)]
    return Counter(out)


def found(df):
    return Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect())


@pytest.fixture(scope="module")
def items(vocabulary):
    rng = random.Random(11)
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 30)))) for i in range(40)]
    rows += [(50, None), (51, ""), (52, "?! ..."), (None, rows[0][1]), (0, rows[1][1]), (3, rows[3][1])]
    return rows + [(60, "ÜNÏCODE Ünïcode one, two; a-b <|endoftext|> 漢字"), (61, "nowhere1 nowhere2"), (62, "one " * 3000)]


@pytest.mark.parametrize("keep", [3, 20])
def test_equals_plain_loop(spark, odd_docs, odd_texts, items, keep):
    asked = spark.createDataFrame([(*x, 1, "d") for x in items], "item_id long, text string, score int, query string")
    assert found(lexical.search(odd_docs, asked, keep)) == plain(odd_texts, items, keep)


def test_tiles_and_blocks(spark, odd_docs, odd_texts, items, monkeypatch):
    for name, value in {"TILE_ITEMS": 7, "ITEMS": 3, "TERMS": 5, "DOCS": 4, "PENDING": 10, "MERGE": 2}.items():
        monkeypatch.setattr(lexical, name, value)
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert found(lexical.search(odd_docs, asked, 5)) == plain(odd_texts, items, 5)


def test_ties_rank_by_id(spark, docs_of):
    rows = [(i, "same words here") for i in random.Random(2).sample(range(1000), 700)] + [(None, "same words here"), (5000, "other")]
    asked = spark.createDataFrame([(1, "words"), (2, "other")], "item_id long, text string")
    got = lexical.search(docs_of(rows).repartition(9), asked, 20).collect()
    ids = sorted(r[0] for r in rows[:-2])[:20]
    assert [r.doc_id for r in sorted(got, key=lambda r: (r.item_id, r["rank"]))] == [*ids, 5000]


def test_products_stay_exact():
    rng = np.random.default_rng(1)
    impacts = rng.integers(0, 10**6, (6, 40))
    weights = rng.integers(0, 10**10, (40, 3)) // 1_000
    weights[7] = 9 * 10**9  # alone over the bound
    want = [[sum(int(a) * int(b) for a, b in zip(row, column)) for column in weights.T] for row in impacts]
    assert lexical.exact_product(impacts, weights).tolist() == want


def test_empty(spark, no_docs, odd_docs, items):
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert lexical.search(no_docs, asked).collect() == []
    out = lexical.search(odd_docs, asked.limit(0))
    assert out.collect() == [] and out.columns == ["item_id", "rank", "doc_id", "score"]


def test_sql(spark):
    assert differences(queries.op13_lexical(spark, SF), connect(SF), queries.ORACLE["op13_lexical"]) == []
