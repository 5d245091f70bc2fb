"""Nearest neighbours against brute force, and WARC archives there and back."""

import base64
import hashlib
import io
import random
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import neighbours, warc
from tidemark.session import scratch_uri

VECTORS = "vec_id bigint, embedding array<float>, label int, k1 int, vec int"
PAGES = "page_id bigint, url string, html string, sha1 int, first string"


def exact(rows, k=5):
    """Query id to [(id, cosine)], nearest first, over valid vectors."""
    good = [(i, np.array(v, dtype=float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    out = {}
    for q, x in good:
        if q % 50 == 0:
            own = {}
            for i, y in good:
                if i != q and len(y) == len(x):
                    own[i] = max(own.get(i, -2), float(x @ y / np.sqrt((x @ x) * (y @ y))))
            out[q] = sorted(own.items(), key=lambda p: (-p[1], p[0]))[:k]
    return out


def found(frame):
    got = defaultdict(list)
    for r in frame.orderBy("query_id", "rank").collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    return got


def test_recall_and_scores(spark):
    rng = np.random.default_rng(1)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(3000, 32)).astype(np.float32))]
    frame = spark.createDataFrame([(*r, 0, 1, 2) for r in rows], VECTORS)
    got, want = found(neighbours.nearest(frame, F.col("vec_id") % 50 == 0, probes=32)), exact(rows)
    assert got.keys() == want.keys()
    hits = 0
    for q, best in want.items():
        assert [r for r, *_ in got[q]] == [1, 2, 3, 4, 5] and [s for *_, s in got[q]] == sorted((s for *_, s in got[q]), reverse=True)
        hits += len({i for _, i, _ in got[q]} & {i for i, _ in best})
        x = np.array(rows[q][1], dtype=float)
        for _, i, s in got[q]:
            y = np.array(rows[i][1], dtype=float)
            assert abs(s - x @ y / np.sqrt((x @ x) * (y @ y))) < 1e-12
    assert hits >= 0.9 * 5 * len(want)


def test_odd_vectors(spark):
    """Copies of one vector, bad rows, few candidates, another dimension; these are found exactly."""
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(0, 130)] + [(200, [1.0, 2.0, 3.0]), (200, [1.0, 2.0, 3.0])]
    rows += [(150, None), (250, []), (300, [0.0, 0.0, 0.0]), (350, [1.0, None, 2.0]), (400, [float("nan"), 1.0, 1.0]),
             (450, [float("inf"), 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (500, [1.0, 0.0]), (501, [0.0, 1.0]), (550, [-1.0, -2.0, -3.0])]
    got = found(neighbours.nearest(spark.createDataFrame([(*r, 0, 1, 2) for r in rows], VECTORS), F.col("vec_id") % 50 == 0))
    want = exact(rows)
    assert {q: [i for _, i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}
    assert [i for _, i, _ in got[0]] == [1, 2, 3, 4, 5] and [i for _, i, _ in got[500]] == [501]
    assert neighbours.nearest(spark.createDataFrame([], VECTORS), F.col("vec_id") % 50 == 0).count() == 0


def test_ties_and_ids_with_many_vectors(spark):
    """Thirty vectors at one cosine, and an id with nine near vectors: both as brute force has them."""
    rng = np.random.default_rng(5)
    base = rng.normal(size=16)
    tied = [(i, (base * 2.0 ** (i % 31 - 15)).tolist()) for i in rng.permutation(np.arange(1, 31)).tolist()]
    rows = [(0, base.tolist()), *tied, *[(100 + i, rng.normal(size=16).tolist()) for i in range(60)]]
    other = rng.normal(size=16)
    rows += [(50, other.tolist()), *[(200, (other + 1e-3 * rng.normal(size=16)).tolist()) for _ in range(9)]]
    rows += [(210 + i, (other + 1e-2 * rng.normal(size=16)).tolist()) for i in range(8)]
    frame = spark.createDataFrame([(*r, 0, 1, 2) for r in rows], VECTORS.replace("float", "double"))
    got, want = found(neighbours.nearest(frame, F.col("vec_id") % 50 == 0, probes=32)), exact(rows)
    assert [i for _, i, _ in got[0]] == [1, 2, 3, 4, 5] == [i for i, _ in want[0]]
    assert [i for _, i, _ in got[50]] == [i for i, _ in want[50]] and got[50][0][1] == 200
    # Id 200 asks once for each of its vectors.
    assert all([r for r, *_ in got[q]] == [1, 2, 3, 4, 5] for q in (0, 50, 100, 150))


def test_blocks_agree(spark, monkeypatch):
    """Small blocks split buckets on both sides and find the same."""
    rng = np.random.default_rng(2)
    rows = [(i, v.tolist(), 0, 1, 2) for i, v in enumerate(rng.normal(size=(400, 8)).astype(np.float32))]
    frame = spark.createDataFrame(rows, VECTORS)
    every = lambda: found(neighbours.nearest(frame, F.col("vec_id") % 5 == 0, probes=16))
    whole = every()
    monkeypatch.setattr(neighbours, "BLOCK", 7)
    assert every() == whole


def test_rotation_keeps_angles():
    x = neighbours.unit(np.random.default_rng(3).normal(size=(20, 50)))
    turned = neighbours.rotated(x, 1)
    assert turned.shape == (20, 64) and np.allclose(turned @ turned.T, x @ x.T)


def pages(seed=4):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    rows = [(i, f"http://x/{i}", f"<html><body>{' '.join(word() for _ in range(rng.randint(0, 300)))}</body></html>") for i in range(80)]
    rows += [(100 + i, None, "same <p>") for i in range(50)] + [(99, "http://a b\r\nc/é", "same <p>"), (300, "u", ""), (301, "u", None), (302, "", "€\r\n\r\nx")]
    return rows + [(400, "u", "twice"), (400, "v", "twice"), (401, "w", "twice"), (None, "n", "none"), (None, None, None), (500, "l", "long " * 300_000)]


def test_round_trip(spark):
    rows = pages()
    first = {}
    for page, _, html in rows:
        if page is not None:
            first[html or ""] = min(page, first.get(html or "", page))
    want = []
    for page, _, html in rows:
        data = (html or "").encode()
        is_first = first.get(html or "", page) == page
        want.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if is_first else "revisit",
                     None if is_first else first[html or ""]))
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], PAGES)
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.round_trip(frame).collect()]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert warc.round_trip(spark.createDataFrame([], PAGES)).count() == 0


def test_small_archives_and_least_size(spark):
    frame = spark.createDataFrame([(*r, 1, "x") for r in pages()], PAGES).coalesce(1)
    uri = scratch_uri(spark, "warc")
    manifest = warc.write_archives(frame, uri, least_bytes=6, archive_bytes_most=20_000)
    assert manifest.count() > 3
    got = warc.read_archives(manifest, uri).collect()
    assert len(got) == len(pages()) and {r.record_type for r in got if r.payload_bytes < 6} == {"response"}
    assert not {r.url for r in got if " " in r.url or "\r" in r.url}


def test_archive_is_what_the_format_says():
    import zstandard

    records = [warc.record(i, "u", f"<p>{i} some words that repeat</p>".encode() * 5, "D", None, "2024-01-01T00:00:00Z") for i in range(200)]
    data = b"".join(warc.archive_bytes(records, 3, 4096, 1 << 20))
    assert list(warc.read_records(io.BytesIO(data))) == records
    plain = sum(len(zstandard.ZstdCompressor(level=3).compress(r)) for r in records)
    assert len(data) < plain
    assert int.from_bytes(data[:4], "little") == 0x184D2A5D and data[8 + int.from_bytes(data[4:8], "little") :][:4] == warc.FRAME
    one = warc.parse(records[3])
    assert one["payload"].startswith(b"<p>3 some") and one["length"] == len(one["payload"])
