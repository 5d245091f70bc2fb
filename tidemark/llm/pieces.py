"""SentencePiece encoding and decoding by a batched numpy Viterbi.

A text is the best path through pieces by the sum of their scores. Pieces never cross the place before a run of
spaces, nor a character that is in no longer piece, so words between these are encoded by themselves, once per task
as long as a memo holds them. New words of one length advance together: the hashes of substrings that start at
a place are probed against the sorted hashes of the pieces and of what pieces begin with, longer ones only in words
whose substring so far begins a piece. The maximum over all of them gives each word's score and backpointer at a
place. Characters without a piece fall back to their bytes.
"""

from __future__ import annotations

import array
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import in_batches, text_or_empty

SPACE = "▁"
BASE = 0x9E3779B97F4A7C15
TOGETHER = 1 << 14
FILTER_BITS = 22
MEMO = 400_000


@dataclass
class Vocabulary:
    """Pieces that text can match with their ids and log-probabilities, and the ids of the 256 bytes."""

    pieces: dict[str, tuple[int, float]]
    bytes_at: list[int]
    written: dict[int, bytes]

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """From a model file. A unigram model has log-probabilities. A BPE model has minus the rank of each piece
        instead; these become log-probabilities by Zipf's law, -log(rank + 1)."""
        import math

        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        plain = [
            i for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        scores = {i: model.get_score(i) for i in plain}
        ranks = all(s == int(s) and s <= 0 for s in scores.values())
        value = (lambda s: -math.log1p(1 - s)) if ranks else (lambda s: s)
        pieces = {model.id_to_piece(i): (i, value(scores[i])) for i in plain}
        bytes_at = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(model.is_byte(i) for i in bytes_at):
            raise ValueError("the model has no byte fallback")
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("a piece has a space after another character")
        written = {i: p.encode() for p, (i, _) in pieces.items()} | {i: bytes([b]) for b, i in enumerate(bytes_at)}
        return cls(pieces, bytes_at, written)

    @property
    def unknown(self) -> float:
        """Score of a character without a piece: below that of any piece."""
        return min(s for _, s in self.pieces.values()) - 10.0


def words_of(text: str) -> list[str]:
    """Cut a text, with a space before it and spaces as marks, before each run of spaces."""
    parts = text.split(" ")
    if SPACE not in text and all(parts):
        return [SPACE + p for p in parts]
    return re.findall(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+", (SPACE + text).replace(" ", SPACE))


class Encoder:
    """Viterbi over batches of words, for use inside a task."""

    def __init__(self, vocabulary: Vocabulary):
        import numpy as np

        self.vocabulary = vocabulary
        self.longest = max(map(len, vocabulary.pieces))
        self.unknown = vocabulary.unknown
        self.power = np.array([pow(BASE, i, 1 << 64) for i in range(self.longest + 1)], np.uint64)
        # Pieces, and what pieces begin with at a score that no path takes.
        known = {p[:n]: -np.inf for p in vocabulary.pieces for n in range(1, len(p))}
        known |= {p: score for p, (_, score) in vocabulary.pieces.items()}
        keys = np.array([self._hash(p) for p in known], np.uint64)
        order = np.argsort(keys)
        self.keys, self.scores = keys[order], np.array(list(known.values()))[order]
        texts = list(known)
        self.ids = np.array([vocabulary.pieces.get(texts[i], (0,))[0] for i in order], np.int32)
        self.codes = np.zeros((len(order), self.longest), np.uint32)
        for row, i in enumerate(order):
            self.codes[row, : len(texts[i])] = list(map(ord, texts[i]))
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces have one hash")
        self.maybe = np.zeros(1 << FILTER_BITS, bool)
        self.maybe[(self.keys >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
        inner = {c for p in vocabulary.pieces if len(p) > 1 for c in p}
        self.inner = inner
        self.alone = re.compile("([^" + "".join(map(re.escape, sorted(inner))) + "])")

    @staticmethod
    def _hash(text: str) -> int:
        h = 0
        for c in text:
            h = (h * BASE + ord(c) + 1) % (1 << 64)
        return h

    def _paths(self, words: list[str]) -> list[bytes]:
        """Ids of the best pieces of words of one length, as little-endian 32-bit numbers."""
        import numpy as np

        n, length = len(words), len(words[0])
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(n, length)
        prefix = np.zeros((length + 1, n), np.uint64)
        for j in range(length):
            prefix[j + 1] = prefix[j] * np.uint64(BASE) + codes[:, j] + np.uint64(1)
        best = np.full((length + 1, n), -np.inf)
        best[0] = 0.0
        # Length of the last piece up to a place, and its key; -1 is a character that falls back to its bytes.
        back, piece = np.ones((length + 1, n), np.int32), np.full((length + 1, n), -1, np.int32)
        for i in range(length):
            # Of equal paths the one whose last piece is shortest: the last to come here.
            alone = best[i] + self.unknown
            taken = alone >= best[i + 1]
            best[i + 1][taken], back[i + 1][taken], piece[i + 1][taken] = alone[taken], 1, -1
            begun = np.arange(n)
            for size in range(1, min(self.longest, length - i) + 1):
                hashes = prefix[i + size][begun] - prefix[i][begun] * self.power[size]
                maybe = np.flatnonzero(self.maybe[(hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
                place = np.minimum(np.searchsorted(self.keys, hashes[maybe]), len(self.keys) - 1)
                hit = self.keys[place] == hashes[maybe]
                begun, place = begun[maybe[hit]], place[hit]
                if not len(begun):
                    break
                total, j = best[i][begun] + self.scores[place], i + size
                better = (total >= best[j][begun]) & (total > -np.inf)
                own = begun[better]
                best[j][own], back[j][own], piece[j][own] = total[better], size, place[better]
        # Backpointers of all words are followed side by side, from the right.
        ids, counts = np.zeros((n, length), np.int32), np.zeros(n, np.int64)
        at, bare = np.full(n, length), np.zeros(n, bool)
        for step in range(1, length + 1):
            open_ = np.flatnonzero(at)
            if not len(open_):
                break
            j = at[open_]
            size, key = back[j, open_], piece[j, open_]
            bare[open_[key < 0]] = True
            for k in range(int(size.max())):
                long = (size > k) & (key >= 0)
                if (codes[open_[long], j[long] - size[long] + k] != self.codes[key[long], k]).any():
                    raise ValueError("a hash stood for another piece")
            ids[open_, length - step] = np.where(key < 0, -1 - codes[open_, j - 1].astype(np.int64), self.ids[key])
            at[open_] = j - size
            counts[open_] = step
        out = [row[length - c :].tobytes() for row, c in zip(ids, counts.tolist())]
        for w in np.flatnonzero(bare).tolist():
            spelled = ids[w, length - counts[w] :].tolist()
            out[w] = array.array("I", [x for i in spelled for x in ([i] if i >= 0 else self._bytes(-1 - i))]).tobytes()
        return out

    def _bytes(self, code: int) -> list[int]:
        return [self.vocabulary.bytes_at[b] for b in chr(code).encode("utf-8", "surrogatepass")]

    def encode(self, words: list[str]) -> list[bytes]:
        """Ids of each word, as little-endian 32-bit numbers."""
        parts: dict[str, bytes] = {}
        split = [[w] if self.inner.issuperset(w) else [p for p in self.alone.split(w) if p] for w in words]
        lengths: dict[int, list[str]] = {}
        for part in {p for s in split for p in s}:
            lengths.setdefault(len(part), []).append(part)
        for length, same in lengths.items():
            step = max(1, min(TOGETHER, 4_000_000 // length))
            for at in range(0, len(same), step):
                some = same[at : at + step]
                parts.update(zip(some, self._paths(some)))
        return [parts[s[0]] if len(s) == 1 else b"".join(map(parts.__getitem__, s)) for s in split]


def decode_ids(ids, written: dict[int, bytes]) -> str:
    """Text of ids; the space put before a text is taken off again."""
    text = b"".join(map(written.__getitem__, ids)).decode("utf-8", "replace").replace(SPACE, " ")
    return text[1:] if text.startswith(" ") else text


def encode(docs: DataFrame, model_path: str, with_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_crc32, round_trip and, if asked for, ids of every whole text.

    `round_trip` says that the ids decode to the text, in which the mark for a space counts as one. Null texts are
    empty ones, whose only token is the space before them. Repeated rows stay; other columns are not read. An
    empty table gives an empty result."""
    vocabulary = Vocabulary.load(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        memo: dict[str, bytes] = {}
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in in_batches(texts):
                words = [words_of(t) for t in texts[a:b]]
                new = set().union(*words).difference(memo)
                if len(memo) + len(new) > MEMO:
                    # Words that came again stay.
                    memo = {w: memo[w] for w in set().union(*words).difference(new)}
                listed = list(new)
                memo.update(zip(listed, encoder.encode(listed)))
                out: list[list] = [[], [], [], [], []]
                for key, text, parts in zip(keys[a:b], texts[a:b], words):
                    data = b"".join(map(memo.__getitem__, parts))
                    ids = array.array("I", data)
                    same = decode_ids(ids, vocabulary.written) == text.replace(SPACE, " ")
                    for column, value in zip(out, (key, len(ids), zlib.crc32(data), same)):
                        column.append(value)
                    if with_ids:
                        out[4].append(ids.tolist())
                names = ["doc_id", "n_tokens", "ids_crc32", "round_trip", "ids"][: 5 if with_ids else 4]
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds[: len(names)])], names=names)

    schema = "doc_id bigint, n_tokens bigint, ids_crc32 bigint, round_trip boolean" + ", ids array<int>" * with_ids
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, schema)


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id and text of every row of doc_id and ids; null ids give a null text, unknown ids raise."""
    written = Vocabulary.load(model_path).written

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if i is None else decode_ids(i, written) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("bigint").alias("doc_id"), "ids").mapInArrow(run, "doc_id bigint, text string")
