"""SimHash groups, components and sharding against brute force."""

import random
import re
from collections import Counter, defaultdict
import zlib

import pytest
import xxhash

from tidemark.llm import components, sharding, simhash


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def print_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def roots(prints, most=3):
    prints = sorted(set(prints))
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(prints):
        for b in prints[i + 1 :]:
            if (a ^ b).bit_count() <= most:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {p: find(p) for p in prints}


def test_groups_against_brute_force(odd_docs, odd_texts):
    rows = simhash.simhash_groups(odd_docs).collect()
    prints = [(i, print_of(t)) for i, t in odd_texts]
    root = roots(p for _, p in prints)
    least = defaultdict(lambda: None)
    for i, p in prints:
        if i is not None:
            least[root[p]] = i if least[root[p]] is None else min(i, least[root[p]])
    want = Counter((i, p, least[root[p]]) for i, p in prints)
    assert Counter((r.doc_id, r["print"] % (1 << 64), r.component_id) for r in rows) == want


def test_dedup_keeps_one_of_each_group(odd_docs, odd_texts, no_docs):
    kept = simhash.near_dedup(odd_docs).collect()
    root = roots(print_of(t) for _, t in odd_texts)
    groups = Counter(root[print_of(r.text)] for r in kept)
    assert set(groups) == set(root.values()) and set(groups.values()) == {1}
    assert kept[0].asDict().keys() == set(odd_docs.columns)
    assert simhash.near_dedup(no_docs).count() == 0 and simhash.simhash_groups(no_docs).count() == 0


@pytest.mark.parametrize("most", [0, 1, 2, 3, 4])
def test_no_link_is_lost(spark, most):
    """Balls around centres, chains of flips, and bit patterns at the edges of segments."""
    rng = random.Random(most)
    prints = {0, (1 << 64) - 1, 1 << 63, 1, 3, 7, 15}
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(25):
            x = centre
            for bit in rng.sample(range(64), rng.randint(0, 5)):
                x ^= 1 << bit
            prints.add(x)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    got = {r["print"] % (1 << 64): r["root"] % (1 << 64) for r in simhash.near_prints(spark.createDataFrame(signed, "print bigint"), most).collect()}
    want = roots(prints, most)
    assert got.keys() == want.keys()
    together = lambda of: {frozenset(p for p in of if of[p] == r) for r in set(of.values())}
    assert together(got) == together(want)


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(i, i) for i in range(5)] + [(7, 9), (9, 7), (7, 9)]
    edges += [(1000, 1000 + rng.randint(1, 50)) for _ in range(60)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert {n: r for n, r in got.items() if 100 <= n <= 160} == {n: 100 for n in range(100, 161)}
    assert got[7] == got[9] == 7 and not set(range(5)) & set(got)
    assert {got[b] for a, b in edges if a == 1000} == {1000}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_shards_against_their_law(docs_of, odd_texts, no_docs):
    rows_in = odd_texts + [(100 + i, "hot copy") for i in range(40)]
    rows = sharding.shard_documents(docs_of(rows_in), shards=8).collect()
    text = lambda t: (t or "").encode()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == Counter(
        (i, len(text(t)) + 1, zlib.crc32(text(t))) for i, t in rows_in
    )
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(8)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert {r.law for r in rows} == {"rows"} and {r.grown_shard for r in rows} == {None}
    assert sharding.shard_documents(no_docs).count() == 0


def test_copies_stay_together(docs_of):
    rows = [(i, f"text {i // 3}") for i in range(240)] + [(1000 + i, f"single {i}") for i in range(160)]
    got = sharding.shard_documents(docs_of(rows), shards=4).collect()
    shards = defaultdict(set)
    for r in got:
        if r.doc_id < 1000:
            shards[r.doc_id // 3].add(r.shard)
    assert sum(len(s) > 1 for s in shards.values()) <= 4


def test_quotas():
    shares = sharding.granted({(0, 1): 10, (1, 0): 4, (2, 1): 6}, [10, 10, 10], 11)
    moved = {k: round(v * n) for (k, v), n in zip(shares.items(), (10, 4, 6))}
    assert moved[0, 1] == 5 and moved[1, 0] == 4 and moved[2, 1] == 0
