"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

A key belongs to the shard whose virtual node is next clockwise. A shard takes no more than
its capacity, its own keys first; keys beyond it go on clockwise to the next shard with
room. All keys of an arc go the same way, so the walk needs only how many keys each arc
has, and a key needs only its place within its arc.
"""

from __future__ import annotations

from collections import defaultdict

import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logquarry.llm.common import table

SHARDS = 16
VIRTUAL_NODES = 64
#: Rows that are ranked together; longer arcs are ranked piece by piece.
PIECE_ROWS = 20_000
_RING_BITS = 31
_CELLS = 4_096


def ring(shards: int, virtual_nodes: int = VIRTUAL_NODES) -> list[tuple[int, int]]:
    """Sorted positions of the virtual nodes, and their shards."""
    shift = 64 - _RING_BITS
    return sorted(
        (xxhash.xxh64_intdigest(f"shard {s} node {v}") >> shift, s)
        for s in range(shards)
        for v in range(virtual_nodes)
    )


def capacities(rows: int, shards: int, slack: float = 0.0) -> list[int]:
    """Most rows of each shard; without slack they differ by one at most and all fill up."""
    if slack:
        return [-(-int(rows * (1 + slack)) // shards)] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def walk(
    owners: list[int], counts: dict[int, int], room: list[int]
) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``(arc, begin, end, shard, slot)`` of the arcs, by place within the arc.

    Every shard takes its own arcs' keys first, in ring order; then what is left of each arc
    goes on clockwise. Each piece knows the slot of its first key in the shard.
    """
    room, used, pieces, left = list(room), defaultdict(int), [], []

    def place(arc: int, begin: int, end: int, shard: int) -> int:
        n = min(end - begin, room[shard])
        if n:
            pieces.append((arc, begin, begin + n, shard, used[shard]))
            room[shard] -= n
            used[shard] += n
        return begin + n

    for arc, n in sorted(counts.items()):
        left.append((arc, place(arc, 0, n, owners[arc]), n))
    for arc, begin, end in left:
        node = arc
        while begin < end:
            node = (node + 1) % len(owners)
            begin = place(arc, begin, end, owners[node])
    return pieces


def shard_rows(
    docs: DataFrame,
    id_col: str = "doc_id",
    shards: int = SHARDS,
    slack: float = 0.0,
    virtual_nodes: int = VIRTUAL_NODES,
) -> DataFrame:
    """``docs`` with ``shard`` and ``slot``, gapless from 0 in each shard.

    Rows are counted by a scan of the id alone. Rows that repeat an id, or have none, are
    keys at one position, ranked in no particular order among equals. Columns of ``docs``
    with the names ``shard`` and ``slot`` are replaced. An empty table gives no rows.
    """
    spark = docs.sparkSession
    nodes = ring(shards, virtual_nodes)
    owners = [s for _, s in nodes]
    width = (1 << _RING_BITS) // _CELLS
    # Positions (low, high] go to node k; beyond the last node the ring begins again.
    edges = [-1, *(p for p, _ in nodes), (1 << _RING_BITS) - 1]
    cells = [
        (c, k % len(nodes), low, high)
        for k, (low, high) in enumerate(zip(edges, edges[1:], strict=False))
        for c in range((low + 1) // width, high // width + 1)
        if high > low
    ]
    cells = F.broadcast(spark.createDataFrame(cells, "cell_ long, arc_ int, low_ long, high_ long"))
    position = F.shiftrightunsigned(F.xxhash64(F.col("row")[id_col]), 64 - _RING_BITS)
    packed = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    placed = (
        packed.withColumn("position_", position)
        .withColumn("cell_", F.expr(f"position_ div {width}"))
        .join(cells, "cell_")
        .filter("low_ < position_ and position_ <= high_")
    )
    slim = (
        docs.select(F.struct(F.col(id_col)).alias("row"))
        .withColumn("position_", position)
        .withColumn("cell_", F.expr(f"position_ div {width}"))
        .join(cells, "cell_")
        .filter("low_ < position_ and position_ <= high_")
    )
    rows = docs.count()
    pieces = max(1, -(-rows // PIECE_ROWS))
    number = F.shiftright(F.col("position_") * pieces, _RING_BITS).alias("piece_")
    sums = slim.groupBy("arc_", number).agg(F.count(F.lit(1)).alias("n"))
    counts = {r.arc_: r.n for r in sums.groupBy("arc_").agg(F.sum("n").alias("n")).collect()}
    # A row per arc and shard at most.
    plan = walk(owners, counts, capacities(rows, shards, slack))
    plan = F.broadcast(
        spark.createDataFrame(plan, "arc_ int, begin_ long, end_ long, shard_ int, slot_ long")
    )
    # The last arc goes on at the ring's begin: positions above the last node come first.
    turn = F.when(F.col("position_") > nodes[-1][0], 0).otherwise(1)
    before = (
        Window.partitionBy("arc_").orderBy("turn_", "piece_").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        slim.groupBy("arc_", turn.alias("turn_"), number)
        .agg(F.count(F.lit(1)).alias("n"))
        .select("arc_", "turn_", "piece_", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset_"))
    )
    inside = Window.partitionBy("arc_", "turn_", "piece_").orderBy("position_", F.col("row")[id_col])
    ranked = (
        placed.withColumn("turn_", turn)
        .withColumn("piece_", number)
        .withColumn("place_", F.row_number().over(inside) - 1)
        .join(offsets, ["arc_", "turn_", "piece_"])
        .withColumn("rank_", F.col("offset_") + F.col("place_"))
        .join(plan, "arc_")
        .filter("begin_ <= rank_ and rank_ < end_")
    )
    others = [F.col("row")[c].alias(c) for c in docs.columns if c.lower() not in ("shard", "slot")]
    slot = F.col("slot_") + F.col("rank_") - F.col("begin_")
    return ranked.select(*others, F.col("shard_").alias("shard"), slot.alias("slot"))


def op5_bounded_ring(spark, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
    return shard_rows(docs).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )
