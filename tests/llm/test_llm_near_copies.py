"""The pipeline's near-duplicate stage against brute force over five-word shingles."""

import random
import re
from collections import Counter

import corpus_pipeline
import pytest

from tidemark.llm import near_copies
from tidemark.llm.common import table


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def groups(texts):
    """The group of every text, by all pairs of distinct sets that may reach 0.8 at all."""
    sets = sorted(set(map(shingles, texts)), key=len)
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i + 1, len(sets)):
            b = sets[j]
            if 5 * len(a) < 4 * len(b):
                break
            common = len(a & b)
            if 5 * common >= 4 * (len(a) + len(b) - common):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    at = {s: find(i) for i, s in enumerate(sets)}
    return [at[shingles(t)] for t in texts]


def check(texts, kept):
    of = groups([t for _, t in texts])
    least = {}
    for (i, _), g in zip(texts, of):
        if g not in least or least[g] is None or (i is not None and i < least[g]):
            least[g] = i
    assert Counter(kept) == Counter(least.values())


def test_stage_against_brute_force(spark, docs_of, odd_texts, no_docs):
    rng = random.Random(11)
    texts = list(odd_texts)
    for g in range(25):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([6, 30, 60, 200, 600]))]
        for c in range(5):
            words = list(base)
            for _ in range(rng.randint(0, 1 + len(words) // 40)):
                words[rng.randrange(len(words))] = f"v{rng.randrange(3000)}"
            texts.append((1000 + 10 * g + c, " ".join(words)))
    stage = dict(corpus_pipeline.STAGES)["near_dedup"]
    kept = stage(spark, docs_of(texts), "").collect()
    check(texts, [r.doc_id for r in kept])
    assert stage(spark, no_docs, "").count() == 0


def test_sketches_lose_no_pair():
    """Sketches never differ in more places than sets do, also where places hold many hashes."""
    rng = random.Random(2)
    for n in (1, 6, 300, 20_000):
        words = [f"w{rng.randrange(10**6)}" for _ in range(n)]
        other = [f"v{i}" if rng.random() < 0.02 else w for i, w in enumerate(words)]
        a, b = (near_copies.shingle_set(" ".join(w)) for w in (words, other))
        bits = sum(((x ^ y) % (1 << 64)).bit_count() for x, y in zip(near_copies.sketch(a), near_copies.sketch(b)))
        assert bits <= len(set(a.tolist()) ^ set(b.tolist()))


@pytest.mark.parametrize("sf", ["sf0.01"])
def test_recall_on_documents(spark, sf):
    docs = table(spark, f"/root/testdata/{sf}", "documents")
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert len(set(groups([t for _, t in texts]))) < len({t for _, t in texts})
    check(texts, [r.doc_id for r in near_copies.near_dedup(docs).select("doc_id").collect()])


def templated(rng, n, own=22):
    """Pages of one template: 80 words in common and some of their own, so that none is near another."""
    base = [f"t{i}" for i in range(80)]
    return [(i, " ".join(base[:40] + [f"w{rng.randrange(10**6)}" for _ in range(own)] + base[40:])) for i in range(n)]


def test_crowded_keys(spark, docs_of, monkeypatch):
    """Near pages among those of a template are found by their rarest shingles, and no others."""
    rng = random.Random(4)
    rows = templated(rng, 300)
    for i in range(0, 60, 3):
        words = rows[i][1].split()
        words[50] = "changed"
        rows.append((1000 + i, " ".join(words)))
    for crowd in (0, 64):
        monkeypatch.setattr(near_copies, "CROWD", crowd)
        check(rows, [r.doc_id for r in near_copies.near_dedup(docs_of(rows)).select("doc_id").collect()])


def test_rarest_shingles_of_near_sets_meet(spark, monkeypatch):
    """Whatever the order of shingles: two sets of similarity 0.8 share one of their first."""
    from tidemark.llm.common import freeze

    rng, rows = random.Random(8), []
    for i in range(200):
        n = rng.randint(1, 60)
        base = rng.sample(range(10**6), n)
        common = -(-n * 8 // 9)
        rows += [(2 * i, base), (2 * i + 1, base[:common] + rng.sample(range(10**6, 2 * 10**6), n - common))]
    near = {i for i, (a, b) in enumerate(zip(rows[::2], rows[1::2])) if 5 * len({*a[1]} & {*b[1]}) >= 4 * len({*a[1]} | {*b[1]})}
    nodes = spark.createDataFrame([(i, i, len(s), [0] * 32) for i, s in rows], "node long, root long, size long, sketch array<long>")
    sets = spark.createDataFrame([(i, sorted(s)) for i, s in rows], "node long, hashes array<long>")
    for slots in (1, 4, 1 << 14):
        monkeypatch.setattr(near_copies, "SLOTS", slots)
        met = near_copies._rarest(freeze(nodes, "n"), freeze(sets, "s"))
        pairs = met.alias("a").join(met.alias("b"), "key").selectExpr("a.node AS x", "b.node AS y").distinct().collect()
        assert {x // 2 for x, y in pairs if x // 2 == y // 2 and x < y} >= near and len(near) > 20


def test_joins_grow_with_the_pages(spark, docs_of, monkeypatch):
    """Pages of a template that are not near give no pairs, however many there are."""
    made = []
    pairs = near_copies._near_pairs

    def counted(rows):
        out = pairs(rows)
        made.append((rows.count(), out.count()))
        return out

    monkeypatch.setattr(near_copies, "_near_pairs", counted)
    assert near_copies.near_groups(docs_of(templated(random.Random(5), 1500))).filter("kept").count() == 1500
    # Rows that meet in the joins: few of a direct kind, and none by rare shingles.
    assert all(rows < 20 * 1500 and out == 0 for rows, out in made)


def test_task_functions_need_no_repository(spark, docs_of, tmp_path):
    """The stage runs where workers cannot import the library: their functions come by value."""
    import subprocess
    import sys

    root = near_copies.__file__.rsplit("/tidemark/", 1)[0]
    script = f"""
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
sys.path.remove({root!r})
sys.path.insert(0, {root!r})
from tidemark.llm import near_copies
docs = spark.createDataFrame([(1, "a b c d e f g h"), (2, "A b c d e f g h")], "doc_id long, text string")
print("KEPT", [r.doc_id for r in near_copies.near_dedup(docs).collect()])
"""
    path = tmp_path / "run.py"
    path.write_text(script)
    env = {k: v for k, v in __import__("os").environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(path)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "KEPT [1]" in done.stdout, done.stderr[-2000:]


def test_the_stage_searches_by_fingerprints(spark, docs_of, monkeypatch):
    """With no other search at hand, near copies within three bits still go, and texts that are not near stay."""
    rng, rows = random.Random(9), []
    for g in range(20):
        base = [f"w{rng.randrange(10**6)}" for _ in range(900)]
        rows += [(10 * g + c, " ".join(base[:-c] + [f"v{c}"] if c else base)) for c in range(3)]
    monkeypatch.setattr(near_copies, "search_keys", lambda hashes, factors: [])
    stage = dict(corpus_pipeline.STAGES)["near_dedup"]
    kept = {r.doc_id for r in stage(spark, docs_of(rows), "").select("doc_id").collect()}
    prints = {i: near_copies.majority(near_copies.shingle_set(t)) for i, t in rows}
    near = {i for i in prints if i % 10 and ((prints[i] ^ prints[i - i % 10]) % (1 << 64)).bit_count() <= near_copies.MOST}
    assert len(near) > 20 and not kept & near and {10 * g for g in range(20)} <= kept
