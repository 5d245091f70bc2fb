"""Approximate nearest neighbours by cross-polytope hashing.

Each table turns unit vectors by a fast pseudo-rotation (three rounds of random signs and a Hadamard transform) and
assigns them to the nearest of the 2 * dimension signed axes. Queries probe the axes nearest to them, most
promising first. What shares a bucket is scored exactly, in blocks of bounded size: a bucket that holds much
of the table is split on both sides. Equal vectors are searched once, and stand for their smallest ids.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import freeze

BLOCK = 20_000
#: More than products of unit vectors are off by.
ROUNDING = 1e-11
VALID = (
    "vec_id is not null and vec is not null and size(vec) > 0 and exists(vec, x -> x <> 0)"
    " and not exists(vec, x -> x is null or isnan(x) or abs(x) = double('infinity'))"
)


def rotated(vectors, table: int):
    """Unit vectors after the pseudo-rotation of one table; dimensions are padded to a power of two."""
    import numpy as np

    n, d = vectors.shape
    size = 1 << max(0, d - 1).bit_length()
    x = np.zeros((n, size))
    x[:, :d] = vectors
    signs = np.random.default_rng([table, size])
    for _ in range(3):
        x = x * signs.choice([-1.0, 1.0], size)
        h = 1
        while h < size:
            pairs = x.reshape(n, -1, 2, h)
            x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, size)
            h *= 2
        x /= np.sqrt(size)
    return x


def unit(vectors):
    import numpy as np

    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _matrix(column, dim: int):
    import numpy as np

    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(-1, dim)


def coded(vectors: DataFrame, tables: int, probes: int | None) -> DataFrame:
    """(k1, k2, dim, vec, members, tab, axis): one axis a table, or the `probes` nearest ones."""

    def code(batches):
        import numpy as np

        for batch in batches:
            dims = np.array(batch.column(2).to_pylist())
            for dim in np.unique(dims).tolist():
                rows = batch.filter(pa.array(dims == dim))
                if not rows.num_rows:
                    continue
                units = unit(_matrix(rows.column(3), dim))
                for table in range(tables):
                    turned = rotated(units, table)
                    axes = np.concatenate([turned, -turned], axis=1)
                    width = 1 if probes is None else min(probes, axes.shape[1])
                    best = np.argsort(-axes, axis=1, kind="stable")[:, :width]
                    at = np.repeat(np.arange(len(units)), width)
                    for begin in range(0, len(at), BLOCK):
                        part = at[begin : begin + BLOCK]
                        taken = rows.take(pa.array(part))
                        yield pa.RecordBatch.from_arrays(
                            [*taken.columns, pa.array(np.full(len(part), table), pa.int32()),
                             pa.array(best.reshape(-1)[begin : begin + BLOCK], pa.int32())],
                            names=[*taken.schema.names, "tab", "axis"],
                        )

    schema = f"k1 bigint, k2 bigint, dim int, vec {dict(vectors.dtypes)['vec']}, members array<bigint>, tab int, axis int"
    return vectors.select("k1", "k2", "dim", "vec", "members").mapInArrow(code, schema)


def _candidates(near, ids, keep: int):
    """Rows of `near`, rounded cosines, that may hold the `keep` best ids: enough for as many different ids, and
    all within rounding of the last of these."""
    import numpy as np

    more = min(2 * keep, len(near))
    while True:
        last = np.partition(near, len(near) - more)[len(near) - more]
        own = np.flatnonzero(near >= last - ROUNDING)
        if more == len(near) or len({i for j in own.tolist() for i in ids[j]}) >= keep:
            return own
        more = min(2 * max(more, len(own)), len(near))


def best_in_block(keep: int):
    """Function of a bucket's vectors and the queries that probe it: the `keep` best ids of each query, each with
    its nearest vector's score; ties by id."""

    def search(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        import numpy as np

        out: list[list] = [[], [], [], []]
        if vectors.num_rows and queries.num_rows:
            dim = vectors.column("dim")[0].as_py()
            v, q = _matrix(vectors.column("vec"), dim), _matrix(queries.column("vec"), dim)
            v_unit, q_unit = unit(v), unit(q)
            members = vectors.column("members").to_pylist()
            q1, q2 = queries.column("k1").to_pylist(), queries.column("k2").to_pylist()
            v_norm = np.sqrt((v * v).sum(axis=1))
            step = max(1, 2_000_000 // len(v))
            for a in range(0, len(q), step):
                for i, near in enumerate(q_unit[a : a + step] @ v_unit.T):
                    own, x = _candidates(near, members, keep), q[a + i]
                    # Row by row, so that a pair has one score whatever block it meets in.
                    exact = (v[own] * x).sum(axis=1) / (v_norm[own] * np.sqrt((x * x).sum()))
                    bad = ~np.isfinite(exact)
                    if bad.any():
                        exact[bad] = (v_unit[own[bad]] * q_unit[a + i]).sum(axis=1)
                    best: dict[int, float] = {}
                    for j, score in zip(own.tolist(), exact.tolist()):
                        for member in members[j]:
                            best[member] = max(score, best.get(member, score))
                    for member, score in sorted(best.items(), key=lambda p: (-p[1], p[0]))[:keep]:
                        for column, value in zip(out, (q1[a + i], q2[a + i], member, score)):
                            column.append(value)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64()]
        return pa.table([pa.array(x, k) for x, k in zip(out, kinds)], names=["k1", "k2", "vec_id", "score"])

    return search


def _found(vectors: DataFrame, queries: DataFrame, tables: int, probes: int, keep: int) -> DataFrame:
    """(k1, k2, vec_id, score): for each query vector the `keep` best ids of its buckets."""
    spark = vectors.sparkSession
    bucket = ["dim", "tab", "axis"]
    index, asked = coded(vectors, tables, None), coded(queries, tables, probes)
    # A row for each dimension, table and axis at most.
    sizes = {tuple(r[:3]): r[3] for r in index.groupBy(*bucket).count().collect()}
    asks = {tuple(r[:3]): r[3] for r in asked.groupBy(*bucket).count().collect()}
    plan = [(*b, -(-n // BLOCK), -(-asks[b] // BLOCK)) for b, n in sizes.items() if b in asks]
    splits = F.broadcast(spark.createDataFrame(plan, "dim int, tab int, axis int, n int, m int"))
    block = [*bucket, "i", "j"]
    key = F.xxhash64("k1", "k2")
    index = index.join(splits, bucket).select(
        *bucket, "vec", "members", F.pmod(key, F.col("n")).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("j")
    )
    asked = asked.join(splits, bucket).select(
        *bucket, "k1", "k2", "vec", F.pmod(key, F.col("m")).cast("int").alias("j"), F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("i")
    )
    pairs = index.groupBy(*block).cogroup(asked.groupBy(*block)).applyInArrow(
        best_in_block(keep), "k1 bigint, k2 bigint, vec_id bigint, score double"
    )
    ids = pairs.groupBy("k1", "k2", "vec_id").agg(F.max("score").alias("score"))
    order = W.partitionBy("k1", "k2").orderBy(F.desc("score"), "vec_id")
    return ids.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= keep).drop("r")


def nearest(
    embeddings: DataFrame, queries, k: int = 5, tables: int = 2, probes: int = 64, vector: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest by cosine of each row that `queries`, a condition on vec_id, selects.

    Rows without an id or vector, zero vectors, and vectors that hold null or a non-finite number take no
    part; vectors meet those of their own dimension. A row's own id is no neighbour; an id with several
    vectors counts by its nearest. Repeated rows count once. Ties go to the smaller id. A query whose
    buckets hold fewer than k others looks into all buckets. An empty table gives an empty result."""
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col(vector).alias("vec")).filter(VALID)
    rows = rows.withColumns({"k1": F.xxhash64("vec"), "k2": F.xxhash64(F.lit(1), "vec")})
    keep = k + 1  # one of them may be the query itself
    same = W.partitionBy("k1", "k2").orderBy("vec_id")
    vectors = freeze(
        rows.withColumn("r", F.dense_rank().over(same)).filter(F.col("r") <= keep)
        .groupBy("k1", "k2").agg(F.first("vec").alias("vec"), F.array_sort(F.collect_set("vec_id")).alias("members"))
        .withColumn("dim", F.size("vec")),
        "vectors",
    )
    wanted = freeze(rows.filter(queries).select("k1", "k2", F.col("vec_id").alias("query_id")).distinct(), "queries")

    def ranked(of: DataFrame, tables: int, probes: int) -> DataFrame:
        asked = vectors.join(of.select("k1", "k2").distinct(), ["k1", "k2"], "left_semi")
        found = _found(vectors, freeze(asked, "asked"), tables, probes, keep)
        order = W.partitionBy("query_id", "k1", "k2").orderBy(F.desc("score"), "vec_id")
        return (
            of.join(found, ["k1", "k2"]).filter("vec_id <> query_id")
            .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        )

    first = freeze(ranked(wanted, tables, probes), "found")
    full = first.groupBy("query_id", "k1", "k2").count().filter(F.col("count") >= k)
    short = freeze(wanted.join(full, ["query_id", "k1", "k2"], "left_anti"), "short")
    if not short.isEmpty():
        again = ranked(short, 1, 1 << 30)
        first = first.join(short, ["query_id", "k1", "k2"], "left_anti").unionByName(again)
    return first.select("query_id", "rank", "vec_id", "score")
