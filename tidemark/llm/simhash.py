"""SimHash near-duplicates by pigeonring filtering.

Fingerprints within `most` differing bits are linked. The 64 bits form a ring of most + 1 segments. If two
fingerprints are within the budget, some segment starts a chain in which the first l segments differ in at
most floor(l * most / (most + 1)) bits, for every l. So the first segment is equal and the second differs in
one bit at most: both are the key of a hash join, tried as it is and with each of its set bits cleared. The
longer chains and the whole distance are part of the join's condition. No link is lost.

Only distinct fingerprints take part. Those that share a key are first linked to the key's smallest where
it is near enough. The join then looks for links between different components only, so a large group of
copies doesn't emit its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import freeze, text_or_empty
from tidemark.llm.components import components

SEED = 42
BITS = 64
AT_ONCE = 1 << 16


def shingle_hashes(text: str, shingle: int):
    """Hashes of the shingles, repeats included. Words stand between ASCII white space, A-Z in lower case.
    Fewer words than a shingle make one shingle; no words give none."""
    import numpy as np
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle, len(words))
    first, last = starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(line[a:b], SEED) for a, b in zip(first, last)), np.uint64, len(first))


def majority(hashes) -> int:
    """Signed 64 bits: a bit is set if more than half of the hashes have it; no hashes give 0."""
    import numpy as np

    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), AT_ONCE):
        part = hashes[at : at + AT_ONCE].astype("<u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0])


def fingerprint(text: str, shingle: int) -> int:
    """Signed 64-bit fingerprint of a text's shingles; no words give 0."""
    return majority(shingle_hashes(text, shingle))


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, digest, print) of every whole text; null texts are empty ones. The digest tells texts of
    rows that share a doc_id apart."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = pa.array([fingerprint(t, shingle) for t in batch.column(2).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), prints], names=["doc_id", "digest", "print"]
            )

    text = text_or_empty()
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("digest"), text.alias("text"))
    return rows.mapInArrow(of, "doc_id bigint, digest bigint, print bigint")


class Ring:
    """Segments of a fingerprint around a ring, and the budgets of chains of them."""

    def __init__(self, most: int):
        self.most, self.n = most, most + 1
        cuts = [BITS * i // self.n for i in range(self.n + 1)]
        self.low, self.width = cuts[:-1], [b - a for a, b in zip(cuts, cuts[1:])]

    def segment(self, value: Column, i: int) -> Column:
        i %= self.n
        return F.shiftrightunsigned(value, self.low[i]).bitwiseAND(F.lit((1 << self.width[i]) - 1).cast("bigint"))

    def mask(self, i: int, length: int) -> int:
        bits = 0
        for j in range(i, i + length):
            bits |= ((1 << self.width[j % self.n]) - 1) << self.low[j % self.n]
        return bits - (1 << 64) if bits >> 63 else bits

    def key(self, value: Column, i: int) -> Column:
        """Chain start and its first two segments, hashed to one long where they don't fit."""
        first, second = self.segment(value, i), self.segment(value, i + 1)
        return F.xxhash64(F.lit(i), first, second) if self.n < 3 else (
            F.lit(i << 48).cast("bigint") + F.shiftleft(first, self.width[(i + 1) % self.n]) + second
        )

    def keys(self, value: Column) -> Column:
        return F.array(*[self.key(value, i) for i in range(self.n)])

    def probes(self, value: Column) -> Column:
        """Keys with one set bit of the second segment cleared; null where the bit isn't set."""
        out = []
        for i in range(self.n):
            j = (i + 1) % self.n
            for bit in range(self.width[j]):
                one = F.lit(_signed(1 << (self.low[j] + bit)))
                cleared = value.bitwiseAND(F.lit(_signed(~(1 << (self.low[j] + bit)))))
                out.append(F.when(value.bitwiseAND(one) != 0, self.key(cleared, i)))
        return F.array(*out)

    def holds(self, differ: Column, i: int) -> Column:
        """Every chain from segment i is within its budget."""
        return _all(
            F.bit_count(differ.bitwiseAND(F.lit(self.mask(i, l)))) <= l * self.most // self.n
            for l in range(1, self.n + 1)
        )

    def first_start(self, differ: Column) -> Column:
        """The first segment whose chains hold; null if the two aren't linked."""
        return F.coalesce(*[F.when(self.holds(differ, i), i) for i in range(self.n)])


def _signed(value: int) -> int:
    value &= (1 << 64) - 1
    return value - (1 << 64) if value >> 63 else value


def _all(conditions) -> Column:
    out = None
    for c in conditions:
        out = c if out is None else out & c
    return out


def near_prints(prints: DataFrame, most: int = 3) -> DataFrame:
    """(print, root) of distinct fingerprints with a link; root is the smallest that is reachable."""
    if most == 0:
        return prints.select("print", F.col("print").alias("root"))
    ring = Ring(most)
    value = F.col("print")
    indexed = prints.select("print", F.explode(ring.keys(value)).alias("key"))
    smallest = indexed.groupBy("key").agg(F.min("print").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    differ = F.col("print").bitwiseXOR(F.col("least"))
    near = indexed.join(smallest, "key").filter((F.bit_count(differ) <= most) & (differ != 0))
    stars = freeze(components(near.select("print", "least")), "stars")
    known = freeze(
        prints.join(stars, prints["print"] == stars["node"], "left").select("print", F.coalesce("root", "print").alias("root")),
        "known",
    )
    right = known.select(F.col("print").alias("other"), F.col("root").alias("other_root"), F.explode(ring.keys(value)).alias("key"))
    probes = F.concat(ring.keys(value), ring.probes(value))
    left = known.select("print", "root", F.posexplode(probes).alias("pos", "key")).filter("key is not null")
    start = F.when(F.col("pos") < ring.n, F.col("pos"))
    at = ring.n
    for i in range(ring.n):
        at += ring.width[(i + 1) % ring.n]
        start = F.coalesce(start, F.when(F.col("pos") < at, i))
    left = left.select("print", "root", "key", (F.col("pos") < ring.n).alias("same"), start.alias("start"))
    differ = F.col("print").bitwiseXOR(F.col("other"))
    links = left.join(right.hint("shuffle_hash"), "key").filter(
        (F.col("root") != F.col("other_root"))
        & (~F.col("same") | (F.col("print") < F.col("other")))
        & (F.bit_count(differ) <= most)
        & (ring.first_start(differ) == F.col("start"))
    )
    joined = components(links.select("root", "other_root").distinct())
    joined = joined.select(F.col("node").alias("root"), F.col("root").alias("top"))
    return known.join(joined, "root", "left").select("print", F.coalesce("top", "root").alias("root"))


def simhash_groups(docs: DataFrame, shingle: int = 3, most: int = 3) -> DataFrame:
    """doc_id, digest, print, component_id (smallest doc_id reachable over links), kept of every row.

    Equal fingerprints are linked at distance 0; texts without words share fingerprint 0. Repeated
    rows stay, and are all kept if one is. A null doc_id takes part, and is the component's id only
    where no other is there. Other columns are not read. An empty table gives an empty result."""
    own = freeze(fingerprints(docs, shingle), "prints")
    # Nulls last, then the smallest id, then any one of the texts that share it.
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")
    prints = freeze(own.groupBy("print").agg(F.min(first).alias("first")), "distinct-prints")
    roots = freeze(near_prints(prints.select("print"), most), "roots")
    # Read from a table, both sides of the join are plain exchanges, of which a crowded root is split.
    firsts = freeze(prints.join(roots, "print").groupBy("root").agg(F.min("first").alias("first")), "firsts")
    per_print = roots.join(firsts, "root").select("print", "first")
    return own.join(per_print, "print").select(
        "doc_id", "digest", "print", F.col("first.doc_id").alias("component_id"),
        (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("digest") == F.col("first.digest"))).alias("kept"),
    )


def near_dedup(docs: DataFrame, shingle: int = 3, most: int = 3) -> DataFrame:
    """The rows of `docs` with one document kept of each group: that with the smallest doc_id.

    All columns stay. Rows that repeat a kept document, id and text, are kept once."""
    kept = simhash_groups(docs, shingle, most).filter("kept").select(
        F.col("doc_id").alias("_kept_id"), F.col("digest").alias("_kept_digest")
    )
    rows = docs.withColumns({"_kept_id": F.col("doc_id").cast("bigint"), "_kept_digest": F.xxhash64(text_or_empty())})
    same = rows["_kept_id"].eqNullSafe(kept["_kept_id"]) & (rows["_kept_digest"] == kept["_kept_digest"])
    return rows.join(kept, same, "left_semi").dropDuplicates(["_kept_id", "_kept_digest"]).drop("_kept_id", "_kept_digest")
