"""Shards from a consistent-hash ring with virtual nodes and bounded loads.

A document's hash is a place on the ring and goes to the shard of the next
virtual node clockwise; what overflows a full shard goes on clockwise to the
next node whose shard has room. Loads are counts: their bounds add up to the
number of documents and differ by one at most, so in the end every shard is
full and the law ``rows`` holds, whatever the hashes.

The flow over the ring only depends on how many documents start at each virtual
node. Those counts, of a number fixed by parameters, are all that the driver
sees; it sends back, for each node, which of its documents (by rank) go to which
shard. A document's rank comes from a window over one of many equal arcs.

Defined cases: a null text has no bytes and the check sum of an empty one; a
null doc_id is a key like any other; rows that are the same in all that is hashed
share an arc and get different slots; an empty table gives no rows; other
columns are not read. Loads at most one apart leave no room to keep equal texts
in one shard, so they are placed by their ids like all others.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SHARDS = 24
NODES_PER_SHARD = 64
#: Arcs that a virtual node's documents are ranked in; the more, the smaller a window.
ARCS_PER_NODE = 16
#: Places on the ring: hashes have 60 bits.
RING = 1 << 60


@dataclass(frozen=True)
class Node:
    place: int
    shard: int


def ring(shards: int, nodes: int = NODES_PER_SHARD) -> list[Node]:
    """Virtual nodes in clockwise order; a shard's places depend on its number alone."""
    return sorted((Node(int(hashlib.md5(f"shard {s} node {k}".encode()).hexdigest()[:15], 16), s) for s in range(shards) for k in range(nodes)), key=lambda n: (n.place, n.shard))


@dataclass(frozen=True)
class Piece:
    """Documents first..last-1 of a node go to a shard, the first of them to this slot."""

    node: int
    first: int
    last: int
    shard: int
    slot: int


def flow(nodes: list[Node], counts: list[int], capacity: list[int]) -> list[Piece]:
    """Deal each node's documents out, in rounds clockwise.

    In a round every node offers what it has left to one node further on; of the
    nodes that reach a shard in the same round, the first on the ring go first.
    """
    room, used = list(capacity), [0] * len(capacity)
    left = list(counts)
    dealt = [0] * len(counts)
    pieces = []
    waiting = [k for k, n in enumerate(left) if n]
    step = 0
    while waiting:
        for k in waiting:
            shard = nodes[(k + step) % len(nodes)].shard
            n = min(left[k], room[shard])
            if n:
                pieces.append(Piece(k, dealt[k], dealt[k] + n, shard, used[shard]))
                dealt[k] += n
                left[k] -= n
                room[shard] -= n
                used[shard] += n
        waiting = [k for k in waiting if left[k]]
        step += 1
    return pieces


def bounds(rows: int, shards: int) -> list[int]:
    """The most rows of each shard: they add up to all rows and are at most one apart."""
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def place(key: Column) -> Column:
    """A key's place on the ring."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("null"))), 1, 15), 16, 10).cast("long")


def shard(docs: DataFrame, shards: int = SHARDS, nodes: int = NODES_PER_SHARD) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row of docs (doc_id, text)."""
    virtual = ring(shards, nodes)
    places = [n.place for n in virtual]
    # equal arcs, so many that each holds about as few as wanted; a node owns those parts of arcs up to its place
    arcs = shards * nodes * ARCS_PER_NODE
    width = RING // arcs + 1
    at = place(F.col("doc_id"))
    # the number of nodes before a place, by its arc's first node and the few places inside the arc
    inside: dict[int, list[int]] = {}
    for p in places:
        inside.setdefault(p // width, []).append(p)
    before = [bisect_right(places, a * width - 1) for a in range(arcs)]
    rows = [(a, before[a], inside.get(a, [])) for a in range(arcs)]
    spark = docs.sparkSession
    table = F.broadcast(spark.createDataFrame(rows, "arc long, before int, inside array<long>"))
    binary = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")

    def placed(frame: DataFrame, *kept: str) -> DataFrame:
        out = frame.withColumn("at", at).withColumn("arc", F.floor(F.col("at") / width) if width <= (1 << 20) else F.expr(f"at div {width}"))
        out = out.join(table, "arc")
        node = (F.col("before") + F.size(F.filter("inside", lambda p: p < F.col("at")))) % len(places)
        return out.select(*kept, "at", "arc", node.cast("int").alias("node"))

    counted = placed(docs.select("doc_id")).groupBy("node", "arc").agg(F.count("*").alias("n")).collect()
    starts: dict[tuple[int, int], int] = {}
    totals = [0] * len(virtual)
    for r in sorted(counted, key=lambda r: (r["node"], r["arc"])):
        starts[r["node"], r["arc"]] = totals[r["node"]]
        totals[r["node"]] += r["n"]
    pieces = flow(virtual, totals, bounds(sum(totals), shards))
    # for each (node, arc): where its ranks start in the node, and the node's pieces
    of: dict[int, list[Piece]] = {}
    for p in pieces:
        of.setdefault(p.node, []).append(p)
    plan = [(n, a, s, [(p.first, p.last, p.shard, p.slot) for p in of[n]]) for (n, a), s in sorted(starts.items())]
    plan_table = F.broadcast(spark.createDataFrame(plan, "node int, arc long, start long, pieces array<struct<first:long,last:long,shard:int,slot:long>>"))
    rows = placed(docs.select("doc_id", (F.octet_length(binary) + 8).cast("long").alias("size"), F.crc32(binary).alias("text_crc32")), "doc_id", "size", "text_crc32")
    order = Window.partitionBy("node", "arc").orderBy("at", "doc_id", "text_crc32", "size")
    ranked = rows.withColumn("rank", F.row_number().over(order) - 1).join(plan_table, ["node", "arc"])
    rank = F.col("start") + F.col("rank")
    piece = F.filter("pieces", lambda p: (p["first"] <= rank) & (rank < p["last"]))[0]
    return ranked.withColumn("piece", piece).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("piece.shard").alias("shard"),
        (F.col("piece.slot") + rank - F.col("piece.first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
