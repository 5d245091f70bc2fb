"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import freeze


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_003)).first()
    return row[0], row[1]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge to another; root is the component's smallest node.

    `edges` has two columns of longs. Each round links larger neighbours, then smaller ones, to the
    smallest neighbour, with minima that fold before their shuffle; the state is written after each
    round. The number of rounds grows with the logarithm of a component's size."""
    a, b = edges.columns
    now = freeze(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u != v").distinct(), "edges"
    )
    state = _state(now)
    while state[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
            .union(smallest.select("u", F.col("m").alias("v"))).distinct()
        )
        now = freeze(small, "edges")
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
