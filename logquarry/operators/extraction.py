"""Lines to raw columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logquarry.functions.extract import extract_field
from logquarry.schema import EXTRACTED_COLUMNS


def line_id(lines: DataFrame) -> DataFrame:
    """Give every line an ``id``: unique, not dense. An ``id`` that is there is kept.

    Ids are set at the scan, ahead of any shuffle, so a task that is run again after an
    executor is lost hands out the same ones.
    """
    if "id" in lines.columns:
        return lines
    return lines.select(F.monotonically_increasing_id().alias("id"), *lines.columns)


def extract_columns(
    lines: DataFrame,
    family: str = "loose",
    columns: Sequence[str] = EXTRACTED_COLUMNS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """``value`` to ``id``, the columns to ``keep`` and the extracted ones, all strings."""
    return line_id(lines).select(
        "id", *keep, *[extract_field("value", name, family).alias(name) for name in columns]
    )
