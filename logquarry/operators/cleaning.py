"""Cleaning steps over whole frames.

The null conventions of the layers apply to string columns only: comparing a number
with ``'-'`` or ``''`` is an error under ANSI mode.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType

from logquarry.functions import clean
from logquarry.functions.patterns import METHODS, MISSING
from logquarry.schema import COLUMN_TYPES, REFERER_PRESENT, WAREHOUSE_COLUMNS


def map_strings(df: DataFrame, change: Callable[[Column], Column]) -> DataFrame:
    """``df`` with ``change`` applied to every string column."""
    return df.select(
        [
            change(F.col(f.name)).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def dash_to_null(df: DataFrame) -> DataFrame:
    """``-`` becomes NULL in every string column."""
    return map_strings(df, clean.dash_null)


def empty_to_na(df: DataFrame) -> DataFrame:
    """``''`` becomes ``NA`` in every string column."""
    return map_strings(df, clean.empty_na)


def blank_to_null(df: DataFrame) -> DataFrame:
    """Trim every string column of blanks and control characters; NULL if nothing is left."""
    return map_strings(df, clean.blank_null)


def fill_na(df: DataFrame) -> DataFrame:
    """NULL becomes ``NA`` in every string column."""
    return df.na.fill(MISSING)


def null_profile(df: DataFrame) -> DataFrame:
    """One row: per column, how many values are NULL (or NaN, where the type has it)."""
    counts = []
    for field in df.schema.fields:
        missing = F.col(field.name).isNull()
        if isinstance(field.dataType, (DoubleType, FloatType)):
            missing = missing | F.isnan(field.name)
        counts.append(F.count_if(missing).alias(field.name))
    return df.agg(*counts)


def type_columns(df: DataFrame, types: dict[str, str] = COLUMN_TYPES) -> DataFrame:
    """Cast the columns of ``types`` that the frame has; NULL where the text does not fit.

    ``id`` is not among them: its upper half holds the partition number, so it stays bigint.
    """
    return df.withColumns(
        {name: F.col(name).try_cast(dtype) for name, dtype in types.items() if name in df.columns}
    )


def referer_flag(df: DataFrame) -> DataFrame:
    """Add ``referer_present(Y/N)``."""
    return df.withColumn(REFERER_PRESENT, clean.referer_present("referer"))


def drop_referer(df: DataFrame) -> DataFrame:
    return df.drop("referer")


def method_markers(df: DataFrame) -> DataFrame:
    """Add ``no_get``, ``no_post`` and ``no_head``, each holding its method or NULL."""
    return df.withColumns(
        {f"no_{name.lower()}": clean.method_marker("method_GET", name) for name in METHODS}
    )


def request_times(df: DataFrame) -> DataFrame:
    """Add ``day``, ``hour`` and ``day_hour`` of ``datetime_confirmed``."""
    return df.withColumns(
        {
            "day": clean.request_day("datetime_confirmed"),
            "hour": clean.request_hour("datetime_confirmed"),
        }
    ).withColumn("day_hour", clean.day_hour("day", "hour"))


def curated_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Select and reorder by name, ignoring case; the frame's own spelling is kept."""
    spelling = {name.lower(): name for name in df.columns}
    return df.select([spelling[name.lower()] for name in names])


def warehouse_projection(curated: DataFrame) -> DataFrame:
    """The columns a warehouse table gets; the flag loses its ``(Y/N)``."""
    return curated.withColumnRenamed(REFERER_PRESENT, "referer_present").select(*WAREHOUSE_COLUMNS)
