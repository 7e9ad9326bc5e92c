"""What several operators share: tables, scratch tables, skew-proof look-ups, components."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logquarry.session import scratch_folder

#: A key with more than this share of all rows is looked up by broadcast. There can be no
#: more than 1 / share such keys, whatever the data.
HOT_SHARE = 1 / 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again: it cuts the lineage."""
    spark = df.sparkSession
    path = scratch_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else; whole ASCII texts take the fast path."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    )


def attach(
    rows: DataFrame,
    facts: DataFrame,
    keys: Sequence[str],
    total: int,
    n: str = "n",
    how: str = "inner",
) -> DataFrame:
    """``rows`` with the one row of ``facts`` per key; ``n`` is how many rows the key has.

    Keys that hold more than HOT_SHARE of the ``total`` rows are few by arithmetic, so they
    are broadcast and their rows stay where they are. The others are joined by a shuffle in
    which no key can be hot. ``how`` (inner or left) decides about rows without a fact.
    """
    keys = list(keys)
    limit = total * HOT_SHARE
    hot = F.broadcast(facts.filter(F.col(n) > limit).drop(n))
    even = facts.filter(F.col(n) <= limit).drop(n)
    rest = rows.join(hot.select(keys), keys, "left_anti").join(even, keys, how)
    return rows.join(hot, keys).unionByName(rest)


def _digest(edges: DataFrame) -> tuple:
    found = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
    return tuple(found)


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    least = both.groupBy("u").agg(
        F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("n")
    )
    moved = attach(both, least, ["u"], 2 * total).filter("v > u")
    return moved.select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))
    moved = attach(edges, least, ["a"], total).filter("b > m")
    return (
        moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
        .unionByName(least.select("a", F.col("m").alias("b")))
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """``(a, root)`` for every node but the roots: the smallest node that ``a`` is linked to.

    ``edges`` has the columns ``a`` and ``b``, comparable and not null. Alternating large
    and small stars: each round reduces per node before it joins, and the rounds grow with
    the logarithm of the longest path. No edges give no rows.
    """
    ordered = edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    edges = stored(ordered.distinct(), "edges")
    before = _digest(edges)
    while before[0]:
        # Each half is stored: nested, their plans would hold a dozen copies of the edges.
        large = stored(_large_star(edges, before[0]), "edges")
        edges = stored(_small_star(large, before[0]), "edges")
        now = _digest(edges)
        if now == before:
            break
        before = now
    return edges.withColumnRenamed("b", "root")
