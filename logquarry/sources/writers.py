"""Layers, tables and generated logs to storage.

``files`` caps the number of output files by merging partitions without a shuffle. It
also caps the tasks of the stage that feeds the write, so it is for small results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter

from logquarry.operators.cleaning import map_strings
from logquarry.sources.csv_text import CSV_OPTIONS, marked


def _writer(
    df: DataFrame,
    mode: str,
    files: int | None = None,
    partition_by: Sequence[str] = (),
) -> DataFrameWriter:
    writer = (df.coalesce(files) if files else df).write.mode(mode)
    return writer.partitionBy(*partition_by) if partition_by else writer


def write_layer_csv(
    df: DataFrame,
    path: str,
    header: bool = True,
    files: int | None = None,
    partition_by: Sequence[str] = (),
    **options,
) -> None:
    """Overwrite a CSV folder. Layers keep their header: readers go by it."""
    writer = _writer(map_strings(df, marked), "overwrite", files, partition_by)
    writer.options(**(CSV_OPTIONS | options)).csv(path, header=header)


def write_layer_parquet(
    df: DataFrame,
    path: str,
    files: int | None = None,
    partition_by: Sequence[str] = (),
    **options,
) -> None:
    """Overwrite a Parquet folder."""
    _writer(df, "overwrite", files, partition_by).options(**options).parquet(path)


def save_table(
    df: DataFrame,
    name: str,
    mode: str = "errorifexists",
    fmt: str | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    """Save as a managed catalog table, in the session's default format or ``fmt``."""
    writer = _writer(df, mode, partition_by=partition_by)
    (writer.format(fmt) if fmt else writer).saveAsTable(name)


def write_connector(
    df: DataFrame,
    fmt: str,
    options: dict[str, str],
    table: str,
    mode: str = "overwrite",
) -> None:
    """Write to a warehouse table through any installed Spark connector."""
    df.write.format(fmt).options(**options).option("dbtable", table).mode(mode).save()


def append_log_text(df: DataFrame, path: str) -> None:
    """Add the lines in ``value`` to a folder of text files."""
    df.select("value").write.mode("append").text(path)
