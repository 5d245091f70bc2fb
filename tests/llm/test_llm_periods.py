"""Periodic runs against a scan of every period."""

import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import periods, queries
from tidemark.llm.common import table

SF = "/root/testdata/sf0.001"


def plain(words):
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            size = i - start + q
            if size >= max(6, 4 * q):
                own = words[start : start + size]
                if not any(own[d:] == own[:-d] for d in range(1, q)):
                    out.append((start, size, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def words_of(text):
    return [w.decode() for w in (text or "").encode().split()]


def some_words(rng):
    size, kinds, out = rng.randint(0, 90), rng.choice([1, 2, 2, 3, 5, 20]), []
    while len(out) < size:
        if rng.random() < 0.4:
            block = [rng.randrange(kinds) for _ in range(rng.randint(1, 11))]
            out += (block * rng.randint(2, 9))[: rng.randint(1, 70)]
        else:
            out.append(rng.randrange(kinds))
    return [str(w) for w in out]


def test_many_texts_at_once():
    rng = random.Random(3)
    texts = [some_words(rng) for _ in range(2000)]
    runs, kept = periods.runs_of_texts([" ".join(t).encode() for t in texts])
    assert runs == [plain(t) for t in texts]
    assert [k.decode() for k in kept] == [collapsed(t, r) for t, r in zip(texts, runs)]
    assert sum(map(len, runs)) > 1000


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("ab"), max_size=120))
def test_two_letters(words):
    assert periods.runs_of_texts([" ".join(words).encode()])[0] == [plain(words)]


@pytest.mark.parametrize("block", [["a"], ["a", "b"], ["a", "a", "b"], [str(i) for i in range(997)]])
def test_long_loops(block):
    n = 200_000
    words = (block * (n // len(block) + 1))[:n]
    lead = ["lead", *words, "tail"]
    assert periods.runs_of_texts([" ".join(lead).encode()])[0] == [[(1, n, len(block))]]


def test_a_text_held_twice_has_no_run():
    words = [str(i) for i in range(100_000)] * 2
    assert periods.runs_of_texts([" ".join(words).encode()]) == ([[]], [" ".join(words).encode()])


def test_rules_spell_the_text():
    import numpy as np

    rng = random.Random(4)
    words = np.array([rng.randrange(3) for _ in range(500)])
    rules, starts, _ = periods.grammar(words, np.zeros(500, int))
    for rule in set(rules[3].tolist()):
        own = rules[:, rules[3] == rule]
        spelled = {tuple(words[a:b]) for a, _, b, _ in own.T.tolist()}
        assert len(spelled) == 1 and len({m - a for a, m, _, _ in own.T.tolist()}) == 1
    # Some pairs overlap and are replaced once only, the rest twice and more.
    assert len(starts) < 200


def test_odd_texts(odd_docs, odd_texts):
    got = sorted(((r.doc_id, tuple(map(tuple, r.runs)), r.collapsed) for r in periods.periodic_runs(odd_docs).collect()), key=str)
    want = []
    for doc_id, text in odd_texts:
        words = words_of(text)
        runs = plain(words) if len(words) < 5000 else []
        want.append((doc_id, tuple(runs), collapsed(words, runs)))
    assert got == sorted(want, key=str)


def test_empty(no_docs):
    assert periods.periodic_runs(no_docs).collect() == []


def test_query(spark):
    docs = table(spark, SF, "documents").collect()
    want = {}
    for row in docs:
        words = words_of(row.text)
        n, h = len(words), zlib.crc32(str(row.doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = plain(words)
        top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        text = "".join(f"{s},{k},{q}\n" for s, k, q in runs)
        milli = 1000 * top[1] // top[2] if runs else None
        sha = [hashlib.sha256(t.encode()).hexdigest() for t in (text, collapsed(words, runs))]
        want[row.doc_id] = (len(runs), *top, milli, *sha)
    got = {r[0]: tuple(r[1:]) for r in queries.op12_periods(spark, SF).collect()}
    assert got == want and any(w[0] for w in want.values())


def test_planted_nulls(spark):
    docs = spark.createDataFrame([(i, t) for i in range(40) for t in (None, "", " \n", "one", "a b  c")], "doc_id long, text string")
    got = queries.planted_loops(docs).collect()
    assert len(got) == 200 and {tuple(words_of(r.text))[:1] for r in got} == {(), ("one",), ("a",)}
