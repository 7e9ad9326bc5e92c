"""Log lines and layers from files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from logquarry.operators.cleaning import map_strings
from logquarry.sources.csv_text import CSV_OPTIONS, unmarked


def read_log_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per line in ``value``; local, HDFS or object-store paths."""
    return spark.read.text(path)


def spread_rows(df: DataFrame, partitions: int) -> DataFrame:
    """Deal rows out evenly over ``partitions`` tasks, by a shuffle.

    For a source that comes as few tasks, such as a gzip log, ahead of work bound by CPU.
    """
    return df.repartition(partitions)


#: Splits of one log that can be numbered; their offsets, 24 bytes each, are broadcast.
MAX_SPLITS = 4_000_000


def read_numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines with ``line_no``: 0, 1, 2, … in file order, for the seed generators.

    A line's number is its place in its input split plus the lines before that split, summed
    up within its file and then over files. Splits are known by a 64-bit hash; two with one
    hash, or more than MAX_SPLITS, end the query with an error. The log itself never moves.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"),
    )
    split = F.xxhash64("file", "start").alias("split")
    splits = lines.groupBy("file", "start").agg(
        F.min("place").alias("first"), F.count(F.lit(1)).alias("n")
    )
    in_file = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    # One row per file.
    over_files = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    up_to = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, 0)
    files = (
        splits.groupBy("file")
        .agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("splits"))
        .select(
            "file",
            F.coalesce(F.sum("n").over(over_files), F.lit(0)).alias("before"),
            F.sum("splits").over(up_to).alias("splits"),
        )
    )
    offset = F.col("before") + F.coalesce(F.sum("n").over(in_file), F.lit(0)) - F.col("first")
    offsets = (
        splits.join(files, "file")
        .select(split, "splits", offset.alias("offset"))
        .groupBy("split")
        .agg(
            F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("two splits with one hash")))
            .when(F.max("splits") > MAX_SPLITS, F.raise_error(F.lit(f"more than {MAX_SPLITS} splits")))
            .otherwise(F.max("offset"))
            .cast("bigint")
            .alias("offset")
        )
    )
    numbered = lines.select("value", "place", split).join(F.broadcast(offsets), "split")
    return numbered.select((F.col("offset") + F.col("place")).alias("line_no"), "value")


def read_layer_csv(
    spark: SparkSession, path: str, schema: StructType | None = None, **options
) -> DataFrame:
    """A layer folder that ``write_layer_csv`` wrote; all strings unless ``schema`` is given."""
    reader = spark.read.options(**(CSV_OPTIONS | options))
    if schema is not None:
        # Check the header's names too: a folder written without one must not pass.
        reader = reader.schema(schema).option("enforceSchema", False)
    return map_strings(reader.csv(path, header=True), unmarked)


def read_layer_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
