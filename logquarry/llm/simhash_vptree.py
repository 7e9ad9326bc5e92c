"""Near duplicates by SimHash, found in vantage-point trees.

Fingerprints are partitioned by their Hamming distance to vantage points. On all 64 bits at
once distances crowd around 32, and the triangle bound with a radius of 4 prunes little. So
there is one tree for each of three blocks of the bits. Two fingerprints that differ in at
most 4 bits differ in at most 1 within some block, where the bound leaves a shard plus the
thin rim beyond its boundary. What meets in a shard is compared on all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logquarry.llm.common import attach, components, stored, table

RADIUS = 4
BLOCKS = 3
#: Trees are fitted on so many fingerprints at most, and a quarter of them, taken by hash; all
#: are indexed.
SAMPLE_ROWS = 32_768
#: Rows of a shard that belong there, aimed at; so many levels at most.
LEAF_ROWS = 1_000
MAX_DEPTH = 13
#: A shard with more rows is dealt out in pairs of blocks of this size.
TASK_ROWS = 16_000
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
_hash = partial(xxhash.xxh64_intdigest, seed=42)


def simhash(text: bytes | None, shingle: int = 4) -> int:
    """Signed 64-bit SimHash of the word shingles; 0 if there is no word."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    begins = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle, len(words))
    cuts = zip(begins[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)
    hashes = np.array([_hash(joined[i:j]) for i, j in cuts], dtype="<u8")
    columns = hashes.view(np.uint8).reshape(-1, 8).T
    ones = np.concatenate([np.bincount(c, minlength=256) @ _BITS for c in columns])
    set_bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(set_bits.view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text_hash, fp)`` for every row; null and blank texts have the fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            prints = pa.array([simhash(t.as_py()) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), prints], ["doc_id", "text_hash", "fp"]
            )

    kept = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(text_col).alias("text_hash"),
        F.col(text_col).alias("text"),
    )
    return kept.mapInArrow(run, "doc_id long, text_hash long, fp long")


def _block(prints: np.ndarray, tree: int) -> np.ndarray:
    """The bits of one block, as unsigned numbers."""
    cuts = [64 * i // BLOCKS for i in range(BLOCKS + 1)]
    low, high = cuts[tree], cuts[tree + 1]
    return (prints.view(np.uint64) >> np.uint64(low)) & np.uint64((1 << (high - low)) - 1)


def fit_tree(sample: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Vantage points and boundaries of a full tree, node k's children at 2k + 1 and 2k + 2.

    Of some rows of a node the one that splits it most evenly becomes its vantage point.
    Any choice gives right results; a poor one only gives uneven shards.
    """
    points = np.zeros(2**depth - 1, np.uint64)
    bounds = np.zeros(2**depth - 1, np.int16)
    rows = {0: sample}
    for node in range(2**depth - 1):
        own = rows.pop(node)
        if len(own):
            tried = []
            for point in own[:: max(1, len(own) // 8)]:
                far = np.bitwise_count(own ^ point)
                bound = int(np.median(far))
                tried += [(abs(2 * int((far <= b).sum()) - len(own)), b, point) for b in (bound - 1, bound)]
            _, bounds[node], points[node] = min(tried, key=lambda t: t[:2])
        near = np.bitwise_count(own ^ points[node]).astype(np.int16) <= bounds[node]
        rows[2 * node + 1], rows[2 * node + 2] = own[near], own[~near]
    return points, bounds


def shards_of(
    blocks: np.ndarray, tree: tuple[np.ndarray, np.ndarray], depth: int, radius: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, shard and whether it belongs there, for each shard that a row has to be in.

    A row belongs to one shard. It also visits those that may hold a row within ``radius``
    on the near side of a boundary; a visitor goes down both ways where the bound allows.
    """
    row = np.arange(len(blocks))
    node = np.zeros(len(blocks), np.int64)
    own = np.ones(len(blocks), bool)
    points, bounds = tree
    for _ in range(depth):
        far = np.bitwise_count(blocks[row] ^ points[node]).astype(np.int16)
        bound = bounds[node]
        inside = far <= bound
        left = inside | (far <= bound + radius)
        right = np.where(own, ~inside, far > bound - radius)
        row = np.concatenate((row[left], row[right]))
        # In the left shard only rows within the boundary belong.
        own = np.concatenate(((own & inside)[left], own[right]))
        node = np.concatenate((2 * node[left] + 1, 2 * node[right] + 2))
    return row, node - (2**depth - 1), own


def _links(group: pd.DataFrame, radius: int) -> pd.DataFrame:
    """A star for each set of linked fingerprints among the rows of one task."""
    group = group.sort_values("own", ascending=False, kind="stable")
    prints = group["fp"].to_numpy()
    bits, part = prints.view(np.uint64), group["part"].to_numpy()
    apart = part.min() != part.max()
    label = np.arange(len(prints))
    for begin in range(0, int(group["own"].sum()), 256):
        some = slice(begin, min(begin + 256, int(group["own"].sum())))
        near = np.bitwise_count(bits[some, None] ^ bits[None, :]) <= radius
        if apart:  # two blocks of a large shard: each has a task for itself
            near &= part[some, None] != part[None, :]
        for k in np.flatnonzero(near.any(axis=1)):
            met = np.append(label[near[k]], label[begin + k])
            least = met.min()
            if (met != least).any():
                label[np.isin(label, met)] = least
    smallest = pd.Series(prints).groupby(label).transform("min").to_numpy()
    moved = prints != smallest
    return pd.DataFrame({"a": prints[moved], "b": smallest[moved]})


def similar_fingerprints(distinct: DataFrame, total: int, radius: int = RADIUS) -> DataFrame:
    """Links ``(a, b)`` that connect all of the ``total`` distinct ``fp`` within ``radius`` bits.

    Linked sets are given as stars, at most one link per row and shard, never as all pairs.
    """
    spark = distinct.sparkSession
    ordered = distinct.orderBy(F.xxhash64("fp"), "fp").limit(min(SAMPLE_ROWS, total // 4))
    sample = np.array([r.fp for r in ordered.select("fp").collect()], np.int64)
    depth = int(np.clip(np.ceil(np.log2(max(1, total) / LEAF_ROWS)), 0, MAX_DEPTH))
    trees = [fit_tree(_block(sample, t), depth) for t in range(BLOCKS)]
    near = radius // BLOCKS

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column(0).to_numpy()
            for t, tree in enumerate(trees):
                row, shard, own = shards_of(_block(prints, t), tree, depth, near)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(row), t, np.int32)),
                        pa.array(shard.astype(np.int32)),
                        pa.array(prints[row]),
                        pa.array(own),
                    ],
                    ["tree", "shard", "fp", "own"],
                )

    dealt = stored(
        distinct.select("fp").mapInArrow(deal, "tree int, shard int, fp long, own boolean"), "shards"
    )
    # One row per shard, BLOCKS * 2 ** MAX_DEPTH of them at most.
    parts = dealt.groupBy("tree", "shard").agg(
        F.ceil(F.count(F.lit(1)) / TASK_ROWS).cast("int").alias("parts")
    )
    part = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    tasks = (
        dealt.join(F.broadcast(parts), ["tree", "shard"])
        .withColumn("part", part)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumn("i", F.least("part", "other"))
        .withColumn("j", F.greatest("part", "other"))
        .select("tree", "shard", "i", "j", "part", "fp", "own")
    )
    return tasks.groupBy("tree", "shard", "i", "j").applyInPandas(
        lambda group: _links(group, radius), "a long, b long"
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS
) -> DataFrame:
    """``(doc_id, text_hash, fp, root, component_id)`` for every row.

    ``component_id`` is the smallest id that can be reached over links, ``root`` the smallest
    fingerprint. Equal fingerprints are linked; so are all texts without words, nulls included
    (fingerprint 0). Rows that repeat an id are documents of their own with that id; a null
    id is never the smallest. An empty table gives no rows.
    """
    prints = stored(fingerprints(docs, id_col, text_col), "prints")
    distinct = stored(
        prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")), "distinct"
    )
    rows, total = prints.count(), distinct.count()
    roots = components(similar_fingerprints(distinct, total, radius))
    linked = distinct.join(roots.withColumnRenamed("a", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    linked = stored(linked, "linked")
    groups = linked.groupBy("root").agg(
        F.min("first").alias("component_id"), F.count(F.lit(1)).alias("size")
    )
    known = attach(linked, groups, ["root"], total, n="size")
    return attach(prints, known.select("fp", "root", "component_id", "n"), ["fp"], rows)


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The row with the smallest id of each group of near duplicates, with all its columns.

    Of rows that repeat this id, the one with the smallest hash of its text stays; of rows
    that repeat the text as well, any one. A null id counts as the largest.
    """
    key = F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)).alias("key_")
    found = near_duplicates(docs, id_col, text_col).withColumnRenamed("doc_id", "id_")
    order = F.struct(F.coalesce("id_", F.lit((1 << 63) - 1)).alias("key_"), F.col("text_hash").alias("hash_"))
    first = found.groupBy("root").agg(F.min(order).alias("first")).select("first.*")
    packed = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"),
        key,
        F.xxhash64(text_col).alias("hash_"),
    )
    # Joined and reduced on the same keys: texts move once.
    kept = packed.join(first, ["key_", "hash_"], "left_semi")
    return kept.dropDuplicates(["key_", "hash_"]).select("row.*")


def op1_simhash_vptree(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
