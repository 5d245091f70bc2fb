"""Ranked lexical search: dense blocks of item weights times document impacts.

Items are taken in tiles of a bounded number of terms. Spark's tasks count the tile's terms in every whole
document once and write the counts; document frequencies and lengths are aggregates of these. A document's
score is a sum of weight times impact, both integers, so a block of documents by terms times terms by items is a
product of two float64 matrices. Terms are cut so that no partial sum reaches 2^53, where float64 is still exact,
and blocks are added up as 64-bit integers. Each task keeps an item's best documents, all of equal score with
the last among them until their ids decide, and two windows merge them.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import freeze, in_batches, text_or_empty

#: Mean terms and items of a tile. A tile's vocabulary is what is sent to tasks and gathered from them.
TILE_TERMS, TILE_ITEMS = 1 << 19, 1 << 11
DOCS, TERMS, ITEMS = 512, 2048, 512
EXACT = 1 << 53
#: An impact is (10^9 tf) div (1000 tf + 12 m) and so at most 10^6.
MOST_IMPACT = 10**6
PENDING = 1 << 20
MERGE = 64
COUNTS = "doc_id bigint, n bigint, ids array<int>, tfs array<int>"


def _letters() -> bytes:
    """Digits, ASCII letters in lower case and all bytes of other characters; the rest are spaces."""
    out = bytearray(b" " * 256)
    for byte in range(256):
        if byte > 127 or chr(byte).isalnum():
            out[byte] = ord(chr(byte).lower()) if byte < 128 else byte
    return bytes(out)


LETTERS = _letters()


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(LETTERS).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def count_terms(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """doc_id, n (all terms), ids and tfs (terms of the vocabulary) of every whole document."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        number = {term: i for i, term in enumerate(vocabulary)}
        size = max(1, len(vocabulary))
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in in_batches(texts):
                n, found, sizes = [], [], []
                for text in texts[a:b]:
                    terms = terms_of(text)
                    own = [number[t] for t in terms if t in number]
                    n.append(len(terms))
                    sizes.append(len(own))
                    found += own
                row = np.repeat(np.arange(b - a), sizes)
                keys, tfs = np.unique(row * size + np.array(found, np.int64), return_counts=True)
                edges = pa.array(np.searchsorted(keys, np.arange(b - a + 1) * size), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[a:b], pa.array(n, pa.int64()),
                        pa.ListArray.from_arrays(edges, pa.array(keys % size, pa.int32())),
                        pa.ListArray.from_arrays(edges, pa.array(tfs, pa.int32())),
                    ],
                    names=["doc_id", "n", "ids", "tfs"],
                )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().cast("binary").alias("text"))
    return rows.mapInArrow(of, COUNTS)


class Weights:
    """Weights of a tile's terms in its items, kept by term."""

    def __init__(self, items: list[Counter], number: dict[bytes, int], weights: list[int]):
        import numpy as np

        entries = sorted((number[t], i, k * weights[number[t]]) for i, own in enumerate(items) for t, k in own.items())
        table = np.array(entries, np.int64).reshape(-1, 3)
        self.term, self.item, self.value, self.n_items = table[:, 0], table[:, 1], table[:, 2], len(items)
        self.edges = np.searchsorted(self.term, np.arange(len(number) + 1))

    def block(self, terms, low: int, high: int):
        """Terms by the items from low to high, as integers."""
        import numpy as np

        out = np.zeros((len(terms), high - low), np.int64)
        sizes = self.edges[terms + 1] - self.edges[terms]
        row = np.repeat(np.arange(len(terms)), sizes)
        at = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(self.edges[terms], sizes)
        inside = (self.item[at] >= low) & (self.item[at] < high)
        out[row[inside], self.item[at[inside]] - low] = self.value[at[inside]]
        return out


def exact_product(impacts, weights):
    """Product of two integer matrices by float64 blocks whose partial sums stay below 2^53."""
    import numpy as np

    if int(weights.sum(axis=0).max(initial=0)) * MOST_IMPACT < EXACT:
        return (impacts.astype(np.float64) @ weights.astype(np.float64)).astype(np.int64)
    if weights.shape[0] == 1:
        return impacts * weights
    half = weights.shape[0] // 2
    return exact_product(impacts[:, :half], weights[:half]) + exact_product(impacts[:, half:], weights[half:])


class Best:
    """The best documents of each item so far; ties with the last of them stay until ids decide."""

    def __init__(self, n_items: int, keep: int):
        import numpy as np

        self.keep, self.least = keep, np.ones(n_items, np.int64)
        self.held = np.zeros((4, 0), np.int64)
        self.waiting: list = []
        self.n = 0

    def add(self, scores, low: int, ids, no_id):
        import numpy as np

        doc, item = np.nonzero(scores >= self.least[low : low + scores.shape[1]])
        self.waiting.append(np.stack((item + low, scores[doc, item], no_id[doc], ids[doc])))
        self.n += len(doc)
        if self.n > PENDING:
            self.cut()

    def cut(self):
        import numpy as np

        item, score, no_id, ids = rows = np.concatenate([self.held, *self.waiting], axis=1)
        rows = rows[:, np.lexsort((ids, no_id, -score, item))]
        first = np.searchsorted(rows[0], rows[0])
        place = np.arange(rows.shape[1]) - first
        self.held, self.waiting, self.n = rows[:, place < self.keep], [], 0
        full = place == self.keep - 1
        self.least[rows[0, full]] = rows[1, full]


def best_documents(counts: DataFrame, digests: list[str], weights: Weights, n_docs: int, n_terms: int, keep: int) -> DataFrame:
    """(query, doc_id, score): each task's best documents of every item of the tile."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        best = Best(len(digests), keep)
        for batch in batches:
            no_id = np.asarray(batch.column(0).is_null())
            ids = np.asarray(batch.column(0).fill_null(0))
            m = np.array([75 + 25 * n * n_docs // max(1, n_terms) for n in batch.column(1).to_pylist()], np.int64)
            lists, tfs = batch.column(2), np.asarray(batch.column(3).flatten()).astype(np.int64)
            terms, edges = np.asarray(lists.flatten()), np.asarray(lists.value_lengths()).cumsum()
            edges = np.concatenate(([0], edges))
            for low in range(0, batch.num_rows, DOCS):
                high = min(low + DOCS, batch.num_rows)
                span = slice(edges[low], edges[high])
                columns, column = np.unique(terms[span], return_inverse=True)
                row = np.repeat(np.arange(high - low), np.diff(edges[low : high + 1]))
                impact = 10**9 * tfs[span] // (1000 * tfs[span] + 12 * m[low:high][row])
                for left in range(0, len(digests), ITEMS):
                    right = min(left + ITEMS, len(digests))
                    scores = np.zeros((high - low, right - left), np.int64)
                    for a in range(0, len(columns), TERMS):
                        own = columns[a : a + TERMS]
                        here = (column >= a) & (column < a + len(own))
                        tile = np.zeros((high - low, len(own)), np.int64)
                        tile[row[here], column[here] - a] = impact[here]
                        scores += exact_product(tile, weights.block(own, left, right))
                    best.add(scores, left, ids[low:high], no_id[low:high])
        best.cut()
        item, score, no_id, ids = best.held
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([digests[i] for i in item.tolist()], pa.string()),
                pa.array(ids, pa.int64(), mask=no_id.astype(bool)), pa.array(score, pa.int64()),
            ],
            names=["query", "doc_id", "score"],
        )

    return counts.filter(F.size("ids") > 0).mapInArrow(of, "query string, doc_id bigint, score bigint")


def _ranked(df: DataFrame, keys: list[str], keep: int) -> DataFrame:
    order = W.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep)


def _search_tile(docs: DataFrame, texts: list[str], keep: int) -> DataFrame:
    own = [Counter(terms_of(t.encode("utf-8", "surrogatepass"))) for t in texts]
    vocabulary = sorted({t for item in own for t in item})
    number = {term: i for i, term in enumerate(vocabulary)}
    counts = freeze(count_terms(docs, vocabulary), "term-counts")
    totals = counts.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    # As many rows as the tile's vocabulary has terms.
    df = dict(counts.select(F.explode("ids").alias("id")).groupBy("id").count().collect())
    weights = Weights(own, number, [weight(totals[0], df.get(i, 0)) for i in range(len(vocabulary))])
    digests = [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in texts]
    found = best_documents(counts, digests, weights, totals[0], totals[1], keep)
    # Tasks' lists are merged in groups of tasks before all of an item come together.
    some = _ranked(found.withColumn("group", F.spark_partition_id() % MERGE), ["query", "group"], keep)
    return freeze(_ranked(some.drop("rank", "group"), ["query"], keep), "ranked")


def search(docs: DataFrame, items: DataFrame, keep: int = 20) -> DataFrame:
    """item_id, rank, doc_id, score: the `keep` documents of highest score above 0 for each item.

    Terms are runs of ASCII letters, digits and other than ASCII characters, A-Z in lower case. Equal scores rank by
    doc_id, null ids last. Rows are documents: those that repeat an id or a whole row count, and rank, each for
    itself. Items with equal texts are searched once; an item_id that repeats has its ranks once a row. Null
    and empty texts have no terms, and such items no rows. Other columns are not read. Empty tables give
    an empty result. Documents are read once a tile of items."""
    spark = docs.sparkSession
    items = items.select(F.col("item_id").cast("bigint").alias("item_id"), text_or_empty().alias("text"))
    words = F.regexp_count("text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))
    texts = freeze(items.select("text").distinct().withColumn("n", words).filter("n > 0"), "queries")
    n_texts, n_terms = texts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    tiles = max(-(-n_terms // TILE_TERMS), -(-n_texts // TILE_ITEMS))
    found = None
    for tile in range(tiles):
        own = texts.filter(F.pmod(F.xxhash64("text"), F.lit(tiles)) == tile).select("text")
        ranked = _search_tile(docs, sorted(row.text for row in own.collect()), keep)
        found = ranked if found is None else found.union(ranked)
    if found is None:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    asked = items.select("item_id", F.sha2("text", 256).alias("query"))
    return asked.join(found, "query").select("item_id", "rank", "doc_id", "score")
