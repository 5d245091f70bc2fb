"""Periodic runs of words, found in a grammar of the text.

The words of a text are compressed by Re-Pair: adjacent symbols that occur together more than once become
a nonterminal, frequent pairs first. Rounds replace at once all pairs that no overlapping pair outranks, where
rank is the count's power of two and then a fixed draw, so that few rounds suffice. What is left of a text is
put under balanced binary nodes. A run lies inside a lowest node and crosses the boundary of its two halves, so
it is looked for there, once for each nonterminal however often that occurs, and then moved to every place
where the nonterminal was derived. Intervals of one period that overlap by a period are parts of one run.

A run repeats its period four times at least, so one of its sides of the boundary holds two periods. Two
words of these are compared for all periods of a node at once, and the rest where they agree.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_or_empty

LEAST, TIMES = 6, 4
AT_ONCE = 1 << 20
WORDS_AT_ONCE = 300_000
RUN = "struct<start: bigint, length: bigint, period: bigint>"


def grammar(symbols, text_of):
    """Re-Pair of many texts at once: (rules, starts, texts).

    `symbols` are word ids that no two texts share, `text_of` the text of each. Rules are (start, boundary, end,
    rule) of every place where a pair was replaced; the first place of a rule stands for it. `starts` and
    `texts` belong to the symbols that are left."""
    import numpy as np

    symbol, at, text = symbols.astype(np.int64), np.arange(len(symbols)), text_of
    end, fresh, rule = len(symbols), int(symbols.max()) + 1, 0
    live, places = np.ones(max(0, len(symbol) - 1), bool), []
    while len(symbol) > 1:
        left, right = symbol[:-1], symbol[1:]
        twins = left == right
        # Of a stretch of one symbol every other pair is taken, from its start.
        index = np.arange(len(left))
        stretch = np.maximum.accumulate(np.where(np.concatenate(([False], twins[:-1])), 0, index))
        odd = twins & ((index - stretch) % 2 == 1)
        taken = np.flatnonzero(live & ~odd & (text[:-1] == text[1:]))
        pairs, which, counts = np.unique(left[taken] * fresh + right[taken], return_inverse=True, return_counts=True)
        often = counts[which] > 1
        taken, which = taken[often], which[often]
        if not len(taken):
            break
        draw = (pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
        rank = np.empty(len(pairs), np.int64)
        rank[np.lexsort((draw, np.log2(counts).astype(np.int64)))] = np.arange(len(pairs))
        own = np.full(len(left) + 2, -1)
        own[taken + 1] = rank[which]
        best = (own[taken + 1] > own[taken]) & (own[taken + 1] > own[taken + 2])
        chosen = taken[best]
        names, name = np.unique(which[best], return_inverse=True)
        ends = np.append(at, end)[chosen + 2]
        places.append(np.stack((at[chosen], at[chosen + 1], ends, rule + name)))
        symbol = symbol.copy()
        symbol[chosen] = fresh + name
        new = np.zeros(len(symbol), bool)
        new[chosen] = True
        kept = np.ones(len(symbol), bool)
        kept[chosen + 1] = False
        again = np.append(odd, False)
        again[taken] = True
        fresh, rule = fresh + len(names), rule + len(names)
        symbol, at, text, new, again = symbol[kept], at[kept], text[kept], new[kept], again[kept]
        live = again[:-1] | new[:-1] | new[1:]
    rules = np.concatenate(places, axis=1) if places else np.zeros((4, 0), np.int64)
    return rules, at, text


def binary_nodes(starts, texts, end):
    """(start, boundary, end) of balanced binary nodes above the symbols that are left of each text."""
    import numpy as np

    edges = np.append(starts, end)
    first = np.flatnonzero(np.concatenate(([True], texts[1:] != texts[:-1])))
    low, high, out = first, np.append(first[1:], len(starts)), []
    while len(low):
        wide = (high - low > 1) & (edges[high] - edges[low] >= LEAST)
        low, high = low[wide], high[wide]
        middle = (low + high) // 2
        out.append(np.stack((edges[low], edges[middle], edges[high])))
        low, high = np.concatenate((low, middle)), np.concatenate((middle, high))
    return np.concatenate(out, axis=1)


def _agree(words, i: int, j: int, most: int) -> int:
    """How many words from i and from j on are the same, `most` at most."""
    done, step = 0, 32
    while done < most:
        step = min(step * 2, most - done, 1 << 16)
        differ = words[i + done : i + done + step] != words[j + done : j + done + step]
        if differ.any():
            return done + int(differ.argmax())
        done += step
    return most


def _agree_back(words, i: int, j: int, most: int) -> int:
    """How many words before i and before j are the same, `most` at most."""
    done, step = 0, 32
    while done < most:
        step = min(step * 2, most - done, 1 << 16)
        differ = words[i - done - step : i - done] != words[j - done - step : j - done]
        if differ.any():
            return done + int(differ[::-1].argmax())
        done += step
    return most


def _candidates(words, nodes):
    """(node, period, right side) where a side of the boundary may hold two periods, by node and period."""
    import numpy as np

    start, middle, end = nodes
    periods = (end - start) // TIMES
    before = np.concatenate(([0], np.cumsum(periods)))
    found = []
    for low in range(0, int(before[-1]), AT_ONCE):
        place = np.arange(low, min(low + AT_ONCE, int(before[-1])))
        node = np.searchsorted(before, place, side="right") - 1
        q, b = place - before[node] + 1, middle[node]
        for right in (True, False):
            fits = np.flatnonzero(b + 2 * q <= end[node] if right else b - 2 * q >= start[node])
            i, d = (b[fits], q[fits]) if right else (b[fits] - 2 * q[fits], q[fits])
            # The first word of a period, its last, and one between.
            for share in (lambda d: 0, lambda d: d - 1, lambda d: d // 2):
                word = i + share(d)
                same = words[word] == words[word + d]
                fits, i, d = fits[same], i[same], d[same]
            found.append(np.stack((node[fits], q[fits], np.full(len(fits), right))))
    if not found:
        return np.zeros((3, 0), np.int64)
    found = np.concatenate(found, axis=1)
    return found[:, np.lexsort((found[1], found[0]))]


def crossing_runs(words, nodes):
    """Runs (node, start, end, period) inside nodes that touch the boundary of their node."""
    out, now, known = [], -1, []
    for node, q, right in _candidates(words, nodes).T.tolist():
        if node != now:
            now, known = node, []
            start, middle, end = nodes[:, node].tolist()
        side = (middle, middle + 2 * q) if right else (middle - 2 * q, middle)
        # A multiple of a period known for the same stretch is none of its own.
        if any(q % d == 0 and a <= side[0] and side[1] <= b for a, b, d in known):
            continue
        if right:
            ahead = _agree(words, middle, middle + q, end - middle - q)
            if ahead < q:
                continue
            back = _agree_back(words, middle, middle + q, middle - start)
            run = (middle - back, middle + q + ahead, q)
        else:
            back = _agree_back(words, middle - q, middle, middle - q - start)
            if back < q:
                continue
            ahead = _agree(words, middle - q, middle, end - middle)
            run = (middle - q - back, middle + ahead, q)
        known.append(run)
        if run[1] - run[0] >= max(LEAST, TIMES * q):
            out.append((node, *run))
    return out


def find_runs(symbols, text_of):
    """Runs (start, length, period) of many texts at once, by start and period; places count over all of them."""
    import numpy as np

    none = np.zeros((3, 0), np.int64)
    if len(symbols) < LEAST:
        return none
    rules, starts, texts = grammar(symbols, text_of)
    first = np.unique(rules[3], return_index=True)[1]
    own = rules[:3, first]
    n_rules = len(first)
    nodes = np.concatenate((own, binary_nodes(starts, texts, len(symbols))), axis=1)
    runs = crossing_runs(symbols, nodes)
    if not runs:
        return none
    node, start, end, period = np.array(runs, np.int64).T
    in_rule = node < n_rules
    parts = [np.stack((start, end, period))[:, ~in_rule]]
    # Places of each rule, side by side.
    by_rule = np.argsort(rules[3], kind="stable")
    edges = np.searchsorted(rules[3][by_rule], np.arange(n_rules + 1))
    for r, a, b, q in zip(*(x[in_rule].tolist() for x in (node, start, end, period))):
        moves = rules[0][by_rule[edges[r] : edges[r + 1]]] - own[0, r]
        parts.append(np.stack((a + moves, b + moves, np.full(len(moves), q))))
    start, end, period = np.concatenate(parts, axis=1)
    order = np.lexsort((start, period))
    start, end, period = start[order], end[order], period[order]
    # The furthest end so far among intervals of the period.
    group = np.cumsum(np.concatenate(([0], period[1:] != period[:-1])))
    size = len(symbols) + 1
    furthest = np.maximum.accumulate(group * size + end) - group * size
    new = np.concatenate(([True], (group[1:] != group[:-1]) | (start[1:] > furthest[:-1] - period[1:])))
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], len(start)) - 1
    start, length, period = start[begin], furthest[last] - start[begin], period[begin]
    order = np.lexsort((period, start))
    return np.stack((start, length, period))[:, order]


def runs_of_texts(texts: list[bytes]) -> tuple[list[list[tuple[int, int, int]]], list[bytes]]:
    """The runs of each text, and the text without the repeats: its kept words, joined by a space."""
    import numpy as np

    runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    kept: list[bytes] = [b""] * len(texts)
    words: list[tuple[int, list[bytes]]] = []

    def flush():
        base, ids = 0, []
        for _, own in words:
            numbers = defaultdict(count(base).__next__)
            ids.append(np.fromiter(map(numbers.__getitem__, own), np.int64, len(own)))
            base += len(numbers)
        sizes = np.array([len(own) for _, own in words])
        edges = np.concatenate(([0], np.cumsum(sizes)))
        found = find_runs(np.concatenate(ids), np.repeat(np.arange(len(words)), sizes))
        for k, (s, n, q) in zip((np.searchsorted(edges, found[0], side="right") - 1).tolist(), found.T.tolist()):
            runs[words[k][0]].append((s - int(edges[k]), n, q))
        for i, own in words:
            if runs[i]:
                change = np.zeros(len(own) + 1, np.int64)
                for s, n, q in runs[i]:
                    change[s + q] += 1
                    change[s + n] -= 1
                own = [own[j] for j in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
            kept[i] = b" ".join(own)
        words.clear()

    held = 0
    for i, text in enumerate(texts):
        own = text.split()
        if len(own) < LEAST:
            kept[i] = b" ".join(own)
            continue
        words.append((i, own))
        held += len(own)
        if held >= WORDS_AT_ONCE:
            flush()
            held = 0
    if words:
        flush()
    return runs, kept


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, runs, collapsed of every whole text, row by row.

    Words stand between ASCII white space. A run is a longest stretch with smallest period q, of 6 words and
    4 q at least; `runs` holds them by start and period, counted in words from 0. `collapsed` is the text
    without the words that a run has after its first q, single-spaced. Null and empty texts have no words.
    Repeated rows, and null or repeated ids, stay as they are; other columns are not read. An empty table
    gives an empty result."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs, kept = runs_of_texts(batch.column(1).to_pylist())
            edges = [0]
            for own in runs:
                edges.append(edges[-1] + len(own))
            flat = [run for own in runs for run in own]
            columns = [pa.array([run[k] for run in flat], pa.int64()) for k in range(3)]
            spans = pa.StructArray.from_arrays(columns, names=["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(edges, pa.int32()), spans), pa.array(kept, pa.binary())],
                names=["doc_id", "runs", "collapsed"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().cast("binary").alias("text"))
    found = rows.mapInArrow(find, f"doc_id bigint, runs array<{RUN}>, collapsed binary")
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))
