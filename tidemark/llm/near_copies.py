"""Near copies by SimHash and the Jaccard similarity of their five-word shingles: links are exact, candidates are wide.

The pigeonring join of simhash brings together texts whose fingerprints lie within three bits, over chains of such.
Each text of a group is compared with one of it, and linked if the sets of shingles reach the similarity.
Near copies of short texts differ in more bits than unrelated texts would within a useful radius, so
what fingerprints leave apart is searched by minima as well: of a text's set of shingles 128 minima under different hashes are taken, and joined by fours to 32 keys.
Two texts with similarity s share a key with probability 1 - (1 - s^4)^32: all but 5 in 100 million at 0.8,
and more above it, whatever their length. Each pair that shares a key is a candidate, and is linked if the
sets themselves reach the similarity.

Texts with equal sets are one node. The nodes of a key are first compared with one of them, which each key
draws by its own hash, and then only those that are still in different components with each other. Keys that
few such nodes share join these directly. The nodes of crowded keys, as pages of one template that are not near, meet
by a prefix filter instead: of two near sets the fifth of each that is rarest among these nodes has a shingle in
common, and rare shingles have few nodes. No join emits pairs that cannot be near: a sketch holds the parity of the
set's hashes in each of 2048 places, and two sketches differ in no more places than the sets have hashes in
which they differ.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import freeze, slices, text_or_empty
from tidemark.llm.components import components
from tidemark.llm.simhash import SEED, majority, near_prints, shingle_hashes

SHINGLE = 5
#: The similarity 0.8 as a fraction.
TOP, BELOW = 4, 5
KEYS, AT_A_TIME = 32, 4
AT_ONCE = 1 << 12
PLACES = 2048
#: Bits in which fingerprints of one group differ at most.
MOST = 3
#: Nodes of different components that a key joins directly.
CROWD = 64
SLOTS = 1 << 14


def shingle_set(text: str, shingle: int = SHINGLE):
    """Sorted distinct 64-bit hashes of the shingles, as in simhash.shingle_hashes."""
    import numpy as np

    return np.unique(shingle_hashes(text, shingle))


def _factors():
    import numpy as np

    return np.random.default_rng(SEED).integers(1 << 62, 1 << 64, KEYS * AT_A_TIME, np.uint64)[:, None] | np.uint64(1)


def search_keys(hashes, factors) -> list[int]:
    """Signed keys of a set under `_factors`, of which near sets share one; an empty set has none."""
    import numpy as np
    import xxhash

    if not len(hashes):
        return []
    least = np.full(KEYS * AT_A_TIME, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), AT_ONCE):
        least = np.minimum(least, (hashes[None, at : at + AT_ONCE] * factors).min(axis=1))
    rows = least.reshape(KEYS, AT_A_TIME)
    return np.array([xxhash.xxh64_intdigest(row.tobytes(), i) for i, row in enumerate(rows)], np.uint64).view(np.int64).tolist()


def sketch(hashes) -> list[int]:
    """Parities of the counts of a set's hashes in PLACES places, as signed longs."""
    import numpy as np

    odd = np.bincount((hashes & np.uint64(PLACES - 1)).astype(np.int64), minlength=PLACES) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8").tolist()


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, node, print, size, keys, sketch) of every row: node stands for the set, print is its fingerprint,
    size counts it."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import xxhash

        factors = _factors()
        for batch in slices(batches):
            nodes, prints, sizes, keys, sketches = [], [], [], [], []
            for text in batch.column(2).to_pylist():
                hashes = shingle_set(text)
                nodes.append(xxhash.xxh64_intdigest(hashes.tobytes(), SEED))
                prints.append(majority(hashes))
                sizes.append(len(hashes))
                keys.append(search_keys(hashes, factors))
                sketches.append(sketch(hashes))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(np.array(nodes, np.uint64).view(np.int64)),
                    pa.array(prints, pa.int64()), pa.array(sizes, pa.int64()), pa.array(keys, pa.list_(pa.int64())),
                    pa.array(sketches, pa.list_(pa.int64())),
                ],
                names=["doc_id", "digest", "node", "print", "size", "keys", "sketch"],
            )

    text = text_or_empty()
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("digest"), text.alias("text"))
    return rows.mapInArrow(of, "doc_id bigint, digest bigint, node bigint, print bigint, size bigint, keys array<bigint>, sketch array<bigint>")


def _sets(rows: DataFrame) -> DataFrame:
    """(node, hashes) of rows of (node, text)."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in slices(batches):
            sets = [shingle_set(text).view(np.int64) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["node", "hashes"]
            )

    return rows.select("node", "text").mapInArrow(of, "node bigint, hashes array<bigint>")


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (node, other) whose sets reach the similarity."""
    left = sets.select("node", F.col("hashes").alias("own"))
    right = sets.select(F.col("node").alias("other"), "hashes")
    common = F.size(F.array_intersect("own", "hashes"))
    # common / (a + b - common) >= TOP / BELOW, in whole numbers.
    near = (TOP + BELOW) * common >= TOP * (F.size("own") + F.size("hashes"))
    return pairs.join(left, "node").join(right, "other").filter(near).select("node", "other")


def _rarest(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """(key, node, root, size, sketch): the shingles by which each node may have a near one among the nodes.

    Sets a and b of the similarity have TOP / BELOW of the larger one in common. Under one order of all shingles the
    first len - ceil(len * TOP / BELOW) + 1 of each then share one. Any order will do; in this one those come first
    whose slot of SLOTS counters holds few of the nodes' shingles, so what a template repeats comes last."""
    own = freeze(nodes.select("node").join(sets, "node").select("node", "hashes"), "crowded-sets")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        held = np.zeros(SLOTS, np.int64)
        for batch in batches:
            held += np.bincount(np.asarray(batch.column(1).flatten()) & (SLOTS - 1), minlength=SLOTS)
        used = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(held[used])], names=["slot", "n"])

    # A row a slot at most.
    counted = own.mapInArrow(count, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).collect()
    counts = [0] * SLOTS
    for row in counted:
        counts[row.slot] = row.n

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        often = np.array(counts)
        for batch in slices(batches):
            nodes, keys = [], []
            for node, hashes in zip(batch.column(0).to_pylist(), batch.column(1)):
                hashes = np.asarray(hashes.values)
                n = len(hashes)
                keys.append(hashes[np.lexsort((hashes, often[hashes & (SLOTS - 1)]))][: n + 1 + -n * TOP // BELOW])
                nodes.append(np.full(len(keys[-1]), node))
            if nodes:
                columns = [pa.array(np.concatenate(c), pa.int64()) for c in (nodes, keys)]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "key"])

    rarest = freeze(own.mapInArrow(first, "node bigint, key bigint").join(nodes, "node"), "rarest")
    apart = rarest.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low != high")
    return freeze(rarest.join(freeze(apart.select("key"), "apart"), "key"), "rarest-shared")


def _near_pairs(rows: DataFrame) -> DataFrame:
    """(node, other) of different components that share a key and may be near, by their sizes and sketches."""
    right = rows.select("key", *[F.col(c).alias(f"other_{c}") for c in ("node", "root", "size", "sketch")])
    differ = sum((F.bit_count(F.col("sketch")[i].bitwiseXOR(F.col("other_sketch")[i])) for i in range(PLACES // 64)), F.lit(0))
    both = F.col("size") + F.col("other_size")
    # Sets of the similarity differ in (BELOW - TOP) / (BELOW + TOP) of both sizes at most.
    return rows.join(right, "key").filter(
        (F.col("node") < F.col("other_node")) & (F.col("root") != F.col("other_root"))
        & (BELOW * F.least("size", "other_size") >= TOP * F.greatest("size", "other_size"))
        & ((BELOW + TOP) * differ <= (BELOW - TOP) * both)
    ).select("node", F.col("other_node").alias("other"))


def print_stars(nodes: DataFrame) -> DataFrame:
    """(node, other): each node whose fingerprint is near that of others, and one node of its group."""
    prints = nodes.filter("size > 0").select("node", "print")
    roots = freeze(near_prints(freeze(prints.select("print").distinct(), "prints"), MOST), "print-roots")
    placed = freeze(prints.join(roots, "print").select("node", "root"), "placed")
    # Written first: joined with a plain exchange a crowded group can be split.
    drawn = F.min(F.struct(F.xxhash64("node", "root"), "node"))["node"]
    hubs = freeze(placed.groupBy("root").agg(drawn.alias("other"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "hubs")
    return placed.join(hubs, "root").filter("node != other").select("node", "other")


def near_groups(docs: DataFrame) -> DataFrame:
    """doc_id, digest, component_id (smallest doc_id reachable over links), kept of every row.

    Texts without words are one group. Null ids and repeated rows are as in simhash.simhash_groups."""
    own = freeze(signatures(docs), "signatures")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")
    same = [F.first(c).alias(c) for c in ("print", "size", "keys", "sketch")]
    nodes = freeze(own.groupBy("node").agg(F.min(first).alias("first"), *same), "nodes")

    alike = freeze(print_stars(nodes), "print-stars")
    indexed = nodes.select("node", F.explode("keys").alias("key"))
    drawn = F.min(F.struct(F.xxhash64("node", "key"), "node"))["node"]
    crowded = indexed.groupBy("key").agg(drawn.alias("hub"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    # Written first, here and below: joined with a plain exchange a crowded key can be split.
    crowded = freeze(crowded, "crowded")
    shared = freeze(indexed.join(crowded, "key"), "shared")
    met = shared.select("node").union(alike.select(F.explode(F.array("node", "other")).alias("node"))).distinct()
    members = met.join(nodes.select("node", "first"), "node")
    ids = members.select("node", F.col("first.doc_id").alias("_id"), F.col("first.digest").alias("_digest"))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    rows = rows.withColumn("digest", F.xxhash64("text"))
    found = rows.join(ids, F.col("digest").eqNullSafe(F.col("_digest")) & F.col("doc_id").eqNullSafe(F.col("_id")))
    sets = freeze(_sets(found.select("node", "text").dropDuplicates(["node"])), "sets")

    stars = shared.filter("node != hub").select("node", F.col("hub").alias("other"))
    stars = freeze(alike.union(stars).distinct(), "star-pairs")
    linked = freeze(_links(stars, sets), "star-links")
    roots = freeze(components(linked), "star-roots")

    # Of the keys that several components share, the pairs between components that were not compared yet.
    held = shared.join(roots.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left")
    held = freeze(held.select("key", "node", "hub", F.coalesce("root", "node").alias("root")), "held")
    mixed = held.groupBy("key").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("n")
    ).filter("low != high").select("key", (F.col("n") > CROWD).alias("many"))
    held = held.join(freeze(mixed, "mixed"), "key").filter("node != hub").drop("hub")
    held = freeze(held.join(nodes.select("node", "size", "sketch"), "node"), "compared")
    few = held.filter("NOT many").select("key", "node", "root", "size", "sketch")
    many = held.filter("many").dropDuplicates(["node"]).select("node", "root", "size", "sketch")
    pairs = _near_pairs(few).union(_near_pairs(_rarest(freeze(many, "many"), sets)))
    pairs = freeze(pairs.distinct(), "pairs")
    linked = freeze(linked.union(_links(pairs, sets)), "links")
    roots = components(linked).withColumnRenamed("node", "_node")
    tops = freeze(
        nodes.join(roots, F.col("node") == F.col("_node"), "left").select("node", "first", F.coalesce("root", "node").alias("root")), "roots"
    )
    firsts = freeze(tops.groupBy("root").agg(F.min("first").alias("first")), "firsts")
    per_node = tops.select("node", "root").join(firsts, "root").select("node", "first")
    return own.select("doc_id", "digest", "node").join(per_node, "node").select(
        "doc_id", "digest", F.col("first.doc_id").alias("component_id"),
        (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("digest") == F.col("first.digest"))).alias("kept"),
    )


def near_dedup(docs: DataFrame) -> DataFrame:
    """The rows of `docs` with one document kept of each group: that with the smallest doc_id.

    All columns stay. Rows that repeat a kept document, id and text, are kept once."""
    kept = near_groups(docs).filter("kept").select(F.col("doc_id").alias("_kept_id"), F.col("digest").alias("_kept_digest"))
    rows = docs.withColumns({"_kept_id": F.col("doc_id").cast("bigint"), "_kept_digest": F.xxhash64(text_or_empty())})
    same = rows["_kept_id"].eqNullSafe(kept["_kept_id"]) & (rows["_kept_digest"] == kept["_kept_digest"])
    return rows.join(kept, same, "left_semi").dropDuplicates(["_kept_id", "_kept_digest"]).drop("_kept_id", "_kept_digest")
