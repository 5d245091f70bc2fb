"""Toxicity: a lexicon trie met by Levenshtein automata, and a look at the words around each hit.

Training. Terms (words and stems, which are the first letters of words) are counted by label over a
bounded sample of labelled rows. Those that are far likelier in toxic texts, and stand in many different
places there, are the lexicon. A logistic regression over a few sums of hits gives the score.

Scoring. The trie of the lexicon and the Levenshtein automaton of each word are run as one machine whose
states, sets of (trie node, edits so far), are made as words need them. It ends after a few letters for
most words, and every word of a task goes through it once. A hit's weight shrinks if its window shows
quotation: quotation marks around it, or a verb of saying near it.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import freeze, text_or_empty

WINDOW = 6
QUOTES = frozenset("\"“”„«»‹›")
SAYING = frozenset("said says say quoted quote quotes wrote writes called calls term word reported".split())
ADDRESS = frozenset("you your you're youre ur u".split())
STEMS = (4, 5, 6)
WORD = re.compile(r"[^\W_]+(?:'[^\W_]+)?")
FEATURES = ("exact", "fuzzy", "stem", "quoted", "strongest", "aimed", "share")


@dataclass
class Model:
    """Lexicon: term to (weight, is a stem). `weights` has the intercept first, then FEATURES."""

    lexicon: dict[str, tuple[float, bool]] = field(default_factory=dict)
    weights: list[float] = field(default_factory=lambda: [-3.0] + [0.0] * len(FEATURES))


class Machine:
    """Trie and Levenshtein automata as one lazily determinised machine."""

    def __init__(self, lexicon: dict[str, tuple[float, bool]], letters_per_edit: int = 5):
        self.next: list[dict[str, int]] = [{}]
        self.word: list[float | None] = [None]
        self.stem: list[float | None] = [None]
        self.most: list[int] = [0]
        self.edits: list[int] = [0]  # that the word which ends here may have
        for term, (weight, is_stem) in lexicon.items():
            node, edits = 0, 0 if is_stem else min(1, len(term) // letters_per_edit)
            self.most[0] = max(self.most[0], edits)
            for letter in term:
                if letter not in self.next[node]:
                    self.next[node][letter] = len(self.next)
                    self.next.append({})
                    self.word.append(None)
                    self.stem.append(None)
                    self.most.append(0)
                    self.edits.append(0)
                node = self.next[node][letter]
                # An edit is allowed only on the way to words long enough for it.
                self.most[node] = max(self.most[node], edits)
            (self.stem if is_stem else self.word)[node] = weight
            self.edits[node] = edits
        self.allowed = self.most
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.final: list[tuple[str, float] | None] = []
        self.sticky: list[float | None] = []
        self.start = self._state(self._close({(0, 0)}))

    def _close(self, pairs: set) -> frozenset:
        """Add what leaving out a letter of the term reaches; drop pairs that have a better one."""
        out, stack = set(pairs), list(pairs)
        while stack:
            node, edits = stack.pop()
            if edits < self.allowed[node]:
                for child in self.next[node].values():
                    if edits < self.allowed[child] and (child, edits + 1) not in out:
                        out.add((child, edits + 1))
                        stack.append((child, edits + 1))
        return frozenset(p for p in out if not (p[1] and (p[0], p[1] - 1) in out))

    def _state(self, pairs: frozenset) -> int:
        if pairs not in self.states:
            self.states[pairs] = len(self.sets)
            self.sets.append(pairs)
            self.moves.append({})
            exact = [self.word[n] for n, e in pairs if e == 0 and self.word[n] is not None]
            near = [self.word[n] for n, e in pairs if e == 1 and self.word[n] is not None and self.edits[n]]
            self.final.append(("exact", max(exact)) if exact else ("fuzzy", max(near)) if near else None)
            stems = [self.stem[n] for n, e in pairs if e == 0 and self.stem[n] is not None]
            self.sticky.append(max(stems) if stems else None)
        return self.states[pairs]

    def _step(self, state: int, letter: str) -> int:
        out = set()
        for node, edits in self.sets[state]:
            child = self.next[node].get(letter)
            if child is not None:
                out.add((child, edits))
            if edits < self.allowed[node]:
                out.add((node, edits + 1))  # a letter too many
                out.update((c, edits + 1) for c in self.next[node].values() if edits < self.allowed[c])
        return self._state(self._close(out))

    def match(self, word: str) -> tuple[str, float] | None:
        """Best of an exact term, a stem and a term one edit away, with its weight."""
        state, stem = self.start, None
        for letter in word:
            to = self.moves[state].get(letter)
            if to is None:
                to = self.moves[state][letter] = self._step(state, letter)
            state = to
            if self.sticky[state] is not None:
                stem = max(stem or 0.0, self.sticky[state])
            if not self.sets[state]:
                break
        found = self.final[state] if self.sets[state] else None
        if found and found[0] == "exact" or stem is None:
            return found
        return ("stem", stem)


def _pieces_hit(machine: Machine):
    """Memo of pieces between spaces: None, or (kind, weight)."""
    rank = {"exact": 2, "stem": 1, "fuzzy": 0}

    class Hits(dict):
        def __missing__(self, piece: str):
            best = None
            for word in WORD.findall(piece):
                hit = machine.match(word)
                if hit and (best is None or (rank[hit[0]], hit[1]) > (rank[best[0]], best[1])):
                    best = hit
            if len(self) > 300_000:
                self.clear()
            self[piece] = best
            return best

    return Hits()


def quotation(pieces: list[str], at: int, window: int = WINDOW) -> float:
    """0 to 1: how much the window around a piece looks like quotation."""
    before, after = pieces[max(0, at - window) : at + 1], pieces[at : at + window + 1]
    opened = any(p[:1] in QUOTES or p[:1] == "'" for p in before)
    closed = any(p.rstrip(".,;:!?")[-1:] in QUOTES or p.rstrip(".,;:!?")[-1:] == "'" for p in after)
    spoken = any(p.strip(".,;:!?\"'“”«»") in SAYING for p in before[:-1] + after[1:])
    return 0.5 * (opened and closed) + 0.5 * (spoken and (opened or closed)) + 0.2 * (spoken and not (opened or closed))


def features(text: str, hits) -> list[float]:
    """Sums over a whole text, in the order of FEATURES."""
    pieces = text.lower().split()
    found = [(i, h) for i, h in enumerate(map(hits.__getitem__, pieces)) if h]
    out = dict.fromkeys(FEATURES, 0.0)
    for at, (kind, weight) in found:
        said = quotation(pieces, at)
        worth = weight * (1 - 0.7 * said)
        out[kind] += worth
        out["quoted"] += said
        out["strongest"] = max(out["strongest"], worth * (0.5 if kind == "fuzzy" else 1.0))
        near = pieces[max(0, at - WINDOW) : at + WINDOW + 1]
        out["aimed"] += any(p.strip(".,;:!?") in ADDRESS for p in near)
    if found:
        out["share"] = 100.0 * len(found) / len(pieces)
    return [math.log1p(out[f]) for f in FEATURES]


def _term_counts(rows: DataFrame) -> DataFrame:
    """(term, is_stem, toxic, clean, places) over rows of (text, toxic).

    Counts are of rows; `places` is a 63-bit set of the words before the term in toxic rows, so that a
    text with many copies doesn't make its words look common."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        for batch in batches:
            seen: dict[tuple[str, bool], list[int]] = {}
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own: dict[tuple[str, bool], int] = {}
                last = 0
                for word in WORD.findall(text.lower()):
                    if len(word) >= 3 and len(word) <= 30:
                        for term in [(word, False)] + [(word[:n], True) for n in STEMS if len(word) > n]:
                            own[term] = own.get(term, 0) | 1 << last
                    last = zlib.crc32(word.encode()) % 63
                for term, places in own.items():
                    row = seen.setdefault(term, [0, 0, 0])
                    row[0 if toxic else 1] += 1
                    if toxic:
                        row[2] |= places
            keys, values = list(seen), list(seen.values())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.bool_()),
                    *[pa.array([v[i] for v in values], pa.int64()) for i in range(3)],
                ],
                names=["term", "is_stem", "toxic", "clean", "places"],
            )

    parts = rows.select("text", "toxic").mapInArrow(
        count, "term string, is_stem boolean, toxic bigint, clean bigint, places bigint"
    )
    return parts.groupBy("term", "is_stem").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.bit_or("places").alias("places")
    )


def held_out(doc_id: Column, folds: int = 5) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, most_rows: int = 40_000, most_terms: int = 1500, least_rows: int = 5) -> Model:
    """Learn from labelled rows that are not held out: at most `most_rows` of them, those with the smallest
    hashes of their ids, and at most `most_terms` terms, the strongest. Rows without an id, label or
    partner, and ids with labels of both kinds, are left out. With no label of one kind the score is
    that of a text without hits."""
    import numpy as np

    known = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter("doc_id is not null and toxic in (0, 1)").filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("_other")).filter("toxic = _other")
        .select("doc_id", "toxic").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows)
    )
    # Bounded by most_rows, so it can be sent to every executor.
    known = freeze(known, "labels")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text")).join(
        F.broadcast(known), "doc_id"
    )
    rows = freeze(rows.select("text", "toxic"), "labelled")
    totals = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    bad, good = totals.get(1, 0), totals.get(0, 0)
    model = Model()
    if not bad or not good:
        return model
    ratio = F.log((F.col("toxic") + 0.5) / (bad + 1)) - F.log((F.col("clean") + 0.5) / (good + 1))
    terms = (
        _term_counts(rows).withColumn("weight", ratio)
        .filter((F.col("toxic") >= least_rows) & (F.col("weight") > 3) & (F.bit_count("places") >= least_rows))
        .orderBy(F.desc(F.col("weight") * F.log("toxic")), "term", "is_stem").limit(most_terms).collect()
    )
    stems = {r["term"] for r in terms if r["is_stem"]}
    for r in terms:
        # A stem speaks for the longer ones and the words that begin with it.
        shorter = any(r["term"][:n] in stems for n in STEMS if n < len(r["term"]))
        if not shorter and (r["is_stem"] or r["term"] not in model.lexicon):
            model.lexicon[r["term"]] = (float(r["weight"]), bool(r["is_stem"]))
    scored = _with_features(rows, model, ["toxic"]).select("toxic", *FEATURES)
    data = np.array(scored.collect(), dtype=float)  # most_rows rows of a few numbers
    data = data[np.lexsort(data.T)]
    x, y = np.column_stack([np.ones(len(data)), data[:, 1:]]), data[:, 0]
    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-6] + [0.5] * (x.shape[1] - 1))
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(hessian, x.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    model.weights = [float(v) for v in w]
    return model


def _with_features(rows: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """FEATURES of column `text`, beside the columns in `keep`."""
    lexicon = model.lexicon

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits = _pieces_hit(Machine(lexicon))
        n = len(keep)
        for batch in batches:
            found = [features(t, hits) for t in batch.column(n).to_pylist()]
            columns = [batch.column(i) for i in range(n)]
            columns += [pa.array([f[i] for f in found], pa.float64()) for i in range(len(FEATURES))]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *FEATURES])

    kinds = dict(rows.dtypes)
    schema = ", ".join([f"`{k}` {kinds[k]}" for k in keep] + [f"{f} double" for f in FEATURES])
    return rows.select(*keep, "text").mapInArrow(look, schema)


def probability(found: list[float], weights: list[float]) -> float:
    total = weights[0] + sum(f * w for f, w in zip(found, weights[1:]))
    return 1 / (1 + math.exp(-max(-500.0, min(500.0, total))))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0 to 1), predicted of every row, by its whole text alone.

    Null texts are empty ones and score as texts without hits do. Repeated rows stay; other columns
    are not read. An empty table gives an empty result."""
    lexicon, weights = model.lexicon, model.weights

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits = _pieces_hit(Machine(lexicon))
        for batch in batches:
            scores = [probability(features(t, hits), weights) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())],
                names=["doc_id", "score", "predicted"],
            )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(
        judge, "doc_id bigint, score double, predicted int"
    )


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of `docs` that are not predicted toxic, with all their columns, without a shuffle."""
    lexicon, weights, at = model.lexicon, model.weights, docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits = _pieces_hit(Machine(lexicon))
        for batch in batches:
            clean = [probability(features(t or "", hits), weights) < 0.5 for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
