"""Duplicate requests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logquarry.schema import DEDUP_KEYS


def dedup_requests(df: DataFrame, keys: Sequence[str] = DEDUP_KEYS) -> DataFrame:
    """Keep one row per key: the one with the lowest ``id``.

    Both ways reduce a key to one row per map task before the shuffle, so a key that
    holds a third of the log does not overload a task. A frame of just the keys and the
    id takes a hash aggregate. With other columns it is a row number, whose limit Spark
    applies on the map side as well; their strings would turn the aggregate into a
    slower sort-based one.
    """
    if set(df.columns) <= {*keys, "id"}:
        return df.groupBy(*keys).agg(F.min("id").alias("id")).select(df.columns)
    first = Window.partitionBy(*keys).orderBy("id")
    return df.withColumn("nth_of_key", F.row_number().over(first)).where("nth_of_key = 1").select(df.columns)
