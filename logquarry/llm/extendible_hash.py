"""Exact duplicates through an extendible-hash index on shared files.

The index has one entry per hash and digest. Its directory is what doubling arrives at: a
bucket with too many entries is split by one more bit of the hash, until it fits or the bits
run out. Owner tasks hold ranges of buckets; entries with one hash are chained. Which row of a
group stays and how many it has is read from the index, once the texts of the entry's rows have
been compared byte by byte.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logquarry.llm.common import attach, lower_ascii, stored, table

#: Entries of a bucket, and bits that the directory may use: 2 ** MAX_DEPTH buckets at most.
BUCKET_ROWS = 50_000
MAX_DEPTH = 16
#: Texts are picked for comparison by so many bits of their hash, a broadcast of that many rows.
PICK_BITS = 16


def _hashed(docs: DataFrame, text_col: str, hash_bits: int) -> tuple[Column, Column]:
    text = lower_ascii(F.coalesce(F.col(text_col), F.lit("")))
    return text, F.shiftrightunsigned(F.xxhash64(text), 64 - hash_bits)


def directory(keys: DataFrame, bucket_rows: int = BUCKET_ROWS, max_depth: int = MAX_DEPTH) -> DataFrame:
    """``(address, depth, bucket)`` for the addresses, the last bits of the hash ``h``, in use."""
    address = F.pmod("h", F.lit(1 << max_depth)).cast("int").alias("address")
    counts = keys.groupBy(address).agg(F.count(F.lit(1)).alias("n"))
    levels = counts.withColumn("depth", F.explode(F.sequence(F.lit(0), F.lit(max_depth)))).withColumn(
        "bucket", F.expr("address % cast(pow(2, depth) as int)")
    )
    sizes = levels.groupBy("depth", "bucket").agg(F.sum("n").alias("entries"))
    # 2 ** (max_depth + 1) rows at most; all addresses meet in the one bucket of depth 0.
    fitting = F.broadcast(sizes.filter((F.col("entries") <= bucket_rows) | (F.col("depth") == max_depth)))
    # An address stops at the first doubling at which its bucket fits.
    return (
        levels.join(fitting, ["depth", "bucket"])
        .groupBy("address")
        .agg(F.min(F.struct("depth", "bucket", "entries")).alias("at"))
        .select("address", "at.depth", "at.bucket", "at.entries")
    )


def build_index(entries: DataFrame, bucket_rows: int = BUCKET_ROWS, max_depth: int = MAX_DEPTH) -> DataFrame:
    """The index on shared files: bucket, hash, place in the chain, digest, rows, largest id.

    Rows are reduced to entries map-side, so a text that fills the table is one entry. What
    owner tasks get are whole buckets or parts of them, sorted by hash.
    """
    keys = stored(
        entries.groupBy("h", "sha").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n")),
        "keys",
    )
    address = F.pmod("h", F.lit(1 << max_depth)).cast("int")
    # No more rows than the directory has addresses.
    known = F.broadcast(directory(keys, bucket_rows, max_depth).select("address", "bucket", "depth"))
    chain = F.row_number().over(Window.partitionBy("bucket", "h").orderBy("sha"))
    placed = keys.withColumn("address", address).join(known, "address").drop("address")
    owned = placed.repartitionByRange("bucket", "h").withColumn("chain", chain)
    return stored(owned, "index")


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket_rows: int = BUCKET_ROWS,
    hash_bits: int = 64,
) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)`` for every row.

    Texts are equal when identical after lower-casing A-Z; a null text is an empty one. The
    row with the largest id stays; of rows that also repeat this id, one does. An id that is
    null is smaller than all others.
    """
    text, h = _hashed(docs, text_col, hash_bits)
    read = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), h.alias("h"))
    entries = stored(read.select("doc_id", "h", F.sha2("text", 256).alias("sha")), "entries")
    index = build_index(entries, bucket_rows)

    pick = F.pmod("h", F.lit(1 << PICK_BITS)).cast("int").alias("pick")
    several = F.broadcast(index.filter("n > 1").select(pick).distinct())
    picked = read.withColumn("pick", pick).join(several, "pick", "left_semi")
    # What the index says of an entry holds if all rows with its hash and digest have one text.
    texts = picked.groupBy("h", "text").agg(F.count(F.lit(1)).alias("rows"))
    compared = texts.groupBy("h", F.sha2("text", 256).alias("sha")).agg(
        F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("texts")
    )
    equal = (F.col("texts") == 1) & (F.col("rows") == F.col("n"))
    groups = (
        index.filter("n > 1")
        .join(compared, ["h", "sha"], "left")
        .select("h", "sha", "keep_id", F.when(equal, F.col("n")).otherwise(F.raise_error(F.lit("two texts with one SHA-256"))).alias("n"))
    )
    same = entries.groupBy("doc_id", "h", "sha").agg(F.count(F.lit(1)).alias("copies"))
    found = attach(
        same.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))),
        stored(groups, "groups").withColumn("group_size", F.col("n")),
        ["h", "sha"],
        max(1, entries.count()),
        how="left",
    )
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return found.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (F.col("doc_id").eqNullSafe(keep) & (F.col("copy") == 1)).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def op2_extendible_hash(spark, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


OP2_SQL = """
WITH t AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
"""
