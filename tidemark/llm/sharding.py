"""Sharding by balanced label propagation, in DataFrame operations only.

Every linked document starts in a shard by hash. In each round it looks up its neighbours' shards and asks to move
where most of them are. Requests are summed to one count per pair of shards; opposite flows are
exchanged, the rest moves as far as the target's quota goes, and each request is granted with the
probability that this leaves it. Documents without links then fill all shards to their exact sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import freeze, rank_within, text_or_empty


def granted(flows: dict[tuple[int, int], int], sizes: list[int], quota: int) -> dict[tuple[int, int], float]:
    """Share of the requests of each (from, to) that is granted, so that no shard outgrows the quota."""
    grant = {k: min(n, flows.get((k[1], k[0]), 0)) for k, n in flows.items()}
    room = [max(0, quota - s) for s in sizes]
    for (a, b), n in sorted(flows.items(), key=lambda x: (-x[1], x[0])):
        more = min(n - grant[a, b], room[b])
        grant[a, b] += more
        room[b] -= more
        room[a] += more
    return {k: grant[k] / n for k, n in flows.items()}


def propagate(links: DataFrame, shards: int, quota: int, rounds: int = 10) -> DataFrame:
    """(node, shard) of every linked node; `links` has columns a and b, each link once.

    Half of the nodes may ask in a round, drawn anew each time, so that two neighbours don't change
    places for ever. It ends when nobody wants to move. Only counts per shard and per pair of shards
    reach the driver."""
    spark = links.sparkSession
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    state = freeze(
        both.select(F.col("a").alias("node")).distinct()
        .withColumn("shard", F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int")),
        "shards",
    )
    for turn in range(rounds):
        at_b = state.select(F.col("node").alias("b"), "shard")
        votes = both.join(at_b, "b").groupBy("a", "shard").agg(F.count(F.lit(1)).alias("votes"))
        # Most votes; of equal ones the smaller shard.
        best = votes.groupBy(F.col("a").alias("node")).agg(
            F.max(F.struct("votes", (-F.col("shard")).alias("minus"))).alias("best"),
            F.map_from_entries(F.collect_list(F.struct("shard", "votes"))).alias("all"),
        )
        asked = (
            state.join(best, "node")
            .withColumn("to", -F.col("best.minus"))
            .filter((F.col("to") != F.col("shard"))
                    & (F.col("best.votes") > F.coalesce(F.col("all")[F.col("shard")], F.lit(0))))
            .select("node", "shard", "to", (F.pmod(F.xxhash64("node", F.lit(-turn)), F.lit(2)) == 0).alias("drawn"))
        )
        asked = freeze(asked, "moves")
        wanted = asked.groupBy("shard", "to").agg(F.count_if("drawn")).collect()
        if not wanted:
            break
        flows = {(r[0], r[1]): r[2] for r in wanted if r[2]}
        asked = asked.filter("drawn").select("node", "to")
        counted = {r[0]: r[1] for r in state.groupBy("shard").agg(F.count(F.lit(1))).collect()}
        shares = granted(flows, [counted.get(s, 0) for s in range(shards)], quota)
        grants = spark.createDataFrame([(a, b, p) for (a, b), p in shares.items()], "shard int, to int, share double")
        draw = F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(1 << 20)) / (1 << 20)
        state = freeze(
            state.join(asked, "node", "left").join(F.broadcast(grants), ["shard", "to"], "left")
            .select("node", F.when(draw < F.col("share"), F.col("to")).otherwise(F.col("shard")).alias("shard")),
            "shards",
        )
    return state


def equal_text_links(nodes: DataFrame) -> DataFrame:
    """Each node with a text that others have, linked to the first of them: one link a node."""
    hubs = nodes.groupBy("digest").agg(F.min("node").alias("a"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    # Read from a table, both sides of the join are plain exchanges, of which a crowded digest is split.
    hubs = freeze(hubs, "hubs")
    return nodes.join(hubs, "digest").filter("node != a").select("a", F.col("node").alias("b"))


def fill(nodes: DataFrame, placed: DataFrame, shards: int) -> DataFrame:
    """Adds shard and slot to every node, with shards' counts at most one apart.

    Placed nodes stay in their shard up to its size. The others, and nodes that have no place, fill what
    is free, in order of the shards. Slots are gapless from 0."""
    total = nodes.count()
    target = [total // shards + (s < total % shards) for s in range(shards)]
    spark = nodes.sparkSession
    taken = {r[0]: r[1] for r in placed.groupBy("shard").agg(F.count(F.lit(1))).collect()}
    used = [min(target[s], taken.get(s, 0)) for s in range(shards)]
    ranked = freeze(rank_within(placed, "shard", ["node"], "slot", max(1, placed.count())), "placed")
    sizes = spark.createDataFrame(list(enumerate(target)), "shard int, size bigint")
    stay = ranked.join(F.broadcast(sizes), "shard").filter("slot < size").select("node", "shard", "slot")
    rest = nodes.select("node", F.lit(0).alias("one")).join(stay, "node", "left_anti")
    rest = rank_within(rest, "one", ["node"], "place", max(1, total))
    shard = slot = F.lit(None)
    begin, place = 0, F.col("place")
    for s in range(shards):
        # The last shard whose gap begins at or before a place has it; shards without a gap are passed over.
        shard = F.when(place >= begin, s).otherwise(shard)
        slot = F.when(place >= begin, place - begin + used[s]).otherwise(slot)
        begin += target[s] - used[s]
    filled = rest.select("node", shard.alias("shard"), slot.alias("slot"))
    return nodes.join(stay.union(filled), "node")


def shard_documents(docs: DataFrame, shards: int = 8, rounds: int = 10) -> DataFrame:
    """doc_id, size, text_crc32, law (`rows`), shard, slot, grown_shard of every row.

    Documents with equal texts are linked, and stay together as far as even counts allow. Null texts
    count as empty ones, with size 1. Repeated rows and null ids are documents of their own; other columns
    are not read. An empty table gives an empty result."""
    text = text_or_empty()
    nodes = freeze(
        docs.select(
            "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"), F.md5(text.cast("binary")).alias("digest"),
            F.monotonically_increasing_id().alias("node"),
        ),
        "nodes",
    )
    links = freeze(equal_text_links(nodes.select("node", "digest")), "links")
    quota = nodes.count() // shards
    placed = propagate(links, shards, quota, rounds)
    out = fill(nodes.select("node", "doc_id", "size", "text_crc32"), placed, shards)
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
