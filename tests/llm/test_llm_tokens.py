"""Packing, token counts and SentencePiece against the libraries and brute force."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import packing, pieces, token_counts
from tidemark.session import scratch_uri

BYTE, WORD, PIECE = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def byte_ids():
    tokenizer = Tokenizer.from_file(BYTE)
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def test_pack_against_library(odd_docs, odd_texts, byte_ids):
    rows = packing.pack(odd_docs, BYTE, with_ids=True).collect()
    want = Counter()
    for doc_id, text in odd_texts:
        ids = byte_ids(text)
        for at in range(0, len(ids), 2048):
            piece = np.array(ids[at : at + 2048], dtype="<u4")
            want[doc_id, at, len(piece), zlib.crc32(piece.tobytes()), len(ids), tuple(piece.tolist())] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens, tuple(r.ids)) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


@pytest.mark.parametrize("text", ["\n" * 10**6, "\t" * 10**6, " " * 10**6, "a" * 10**5, "a" + " \n" * 200_000 + "b  c", "x\u2003" * 5 + "\u3000" * 20_000])
def test_long_runs_of_one_kind(docs_of, text, byte_ids):
    ids = byte_ids(text)
    rows = sorted(packing.pack(docs_of([(1, text)]), BYTE, with_ids=True).collect(), key=lambda r: r.start)
    assert [i for r in rows for i in r.ids] == ids


def test_rows_that_repeat_are_dealt_apart(docs_of):
    rows = packing.pack(docs_of([(1, "same")] * 500), BYTE).collect()
    assert "_deal" not in rows[0].asDict() and len({(r.sequence_id, r.offset) for r in rows}) == 500


def test_pack_nothing(no_docs):
    assert packing.pack(no_docs, BYTE).count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_shortest_pack_first_places_all(seed):
    rng = random.Random(seed)
    most = rng.choice([1, 7, 64, 2048])
    histogram = {rng.randint(1, most): rng.randint(1, 10**9) for _ in range(rng.randint(0, 40))}
    patterns = packing.shortest_pack_first(histogram, most)
    placed = Counter()
    for count, pattern in patterns:
        assert count > 0 and sum(length * times for length, times in pattern) <= most
        for length, times in pattern:
            placed[length] += count * times
    assert placed == Counter(histogram)
    by_length = defaultdict(list)
    for length, low, high, times, *_ in packing.slot_ranges(patterns):
        by_length[length].append((low, high))
        assert (high - low) % times == 0
    for length, ranges in by_length.items():
        assert [a for a, _ in ranges] == [0, *(b for _, b in ranges)][:-1] and ranges[-1][1] == histogram[length]


def test_equal_lengths_fill_packs():
    assert packing.shortest_pack_first({100: 41}, 2048) == [(1, [(100, 1)]), (2, [(100, 20)])]


def test_byte_ranks_refuse_other_tokenizers():
    with pytest.raises(ValueError, match="byte-level"):
        packing.byte_ranks(WORD)


def test_counts_against_library(odd_docs, odd_texts, no_docs):
    tokenizer = Tokenizer.from_file(WORD)
    want = Counter(
        (i, len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t in odd_texts
    )
    got = token_counts.token_counts(odd_docs, WORD).collect()
    assert Counter(tuple(r) for r in got) == want
    assert token_counts.token_counts(no_docs, WORD).count() == 0


def test_cache_holds_each_content_once(spark, odd_docs, docs_of):
    uri = scratch_uri(spark, "cache")
    first = Counter(map(tuple, token_counts.token_counts(odd_docs, WORD, uri).collect()))
    stored = spark.read.parquet(uri)
    assert stored.count() == stored.select("digest").distinct().count()
    before = stored.count()
    assert Counter(map(tuple, token_counts.token_counts(odd_docs, WORD, uri).collect())) == first
    assert spark.read.parquet(uri).count() == before
    # Another spelling of the same white space is a hit; a new text is one miss.
    token_counts.token_counts(docs_of([(1, "one\n\n two"), (2, "one two"), (3, "quite new")]), WORD, uri).collect()
    assert spark.read.parquet(uri).count() == before + 1


def best_path(model, text):
    """Plain Viterbi over characters: score and pieces."""
    best = [(0.0, 0)] + [(-float("inf"), 0)] * len(text)
    for j in range(1, len(text) + 1):
        for size in range(1, min(j, 20) + 1):
            known = model.pieces.get(text[j - size : j])
            gain = known[1] if known else model.unknown if size == 1 else None
            if gain is not None and best[j - size][0] + gain > best[j][0] + 1e-12:
                best[j] = (best[j - size][0] + gain, size)
    out, j = [], len(text)
    while j:
        out.append(text[j - best[j][1] : j])
        j -= best[j][1]
    return best[-1][0], out[::-1]


def test_pieces_against_plain_viterbi(odd_docs, odd_texts, no_docs):
    model = pieces.Vocabulary.load(PIECE)
    rows = pieces.encode(odd_docs, PIECE).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in odd_texts)
    assert all(r.round_trip and len(r.ids) == r.n_tokens for r in rows)
    by_text = {}
    for text in {t or "" for _, t in odd_texts if len(t or "") < 6000}:
        score, parts = best_path(model, (" " + text).replace(" ", pieces.SPACE))
        ids = [i for p in parts for i in ([model.pieces[p][0]] if p in model.pieces else [model.bytes_at[b] for b in p.encode()])]
        by_text[zlib.crc32(np.array(ids, "<u4").tobytes())] = score
    for r in rows:
        if r.n_tokens < 3000:
            assert r.ids_crc32 in by_text
    assert pieces.encode(no_docs, PIECE).count() == 0


def test_pieces_round_trip(spark, odd_docs, odd_texts):
    encoded = pieces.encode(odd_docs, PIECE).select("doc_id", "ids")
    got = Counter(tuple(r) for r in pieces.decode(encoded, PIECE).collect())
    assert got == Counter((i, (t or "").replace(pieces.SPACE, " ")) for i, t in odd_texts)
    assert pieces.decode(spark.createDataFrame([(1, None)], "doc_id bigint, ids array<int>"), PIECE).first().text is None
