"""Whole pipelines that write every layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from logquarry.functions.clean import request_day
from logquarry.operators.aggregate import (
    count_clients,
    first_hour_of_clients,
    hourly_per_client_agg,
    per_client_rows,
    per_device_agg,
    roll_up_clients,
    totals_of_devices,
)
from logquarry.plans.layers import to_cleansed, to_curated, to_raw
from logquarry.plans.profiles import LOOSE, LogProfile
from logquarry.sources.readers import read_layer_csv, read_layer_parquet
from logquarry.sources.writers import write_layer_csv, write_layer_parquet

LAYERS = ("raw", "cleansed", "curated")


def publish_layers(
    lines: DataFrame,
    folder: str,
    profile: LogProfile = LOOSE,
    fmt: str = "parquet",
    keep: Sequence[str] = LAYERS,
    by_day: bool = False,
) -> dict[str, DataFrame]:
    """Write every layer and aggregate under ``folder`` and return them as read back.

    Each step reads the files of the one before, so lines are parsed once and a lost
    executor costs one step's tasks at most. Three aggregates scan the curated layer; the
    others come from their written rows, which are few next to the log. Of the layers only
    those to ``keep`` are written; one that is not is worked out again by whatever reads it,
    so leave out ``curated`` for small logs only. ``by_day`` gives the curated layer a
    ``day`` column and a folder for each, for readers bound in time.
    """
    if fmt not in ("parquet", "csv"):
        raise ValueError(f"layers are written as parquet or csv, not {fmt}")
    if unknown := set(keep) - set(LAYERS):
        raise ValueError(f"no such layers: {sorted(unknown)}")
    spark = lines.sparkSession

    def store(name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        if name in LAYERS and name not in keep:
            return df
        path = f"{folder.rstrip('/')}/{name}"
        if fmt == "csv":
            write_layer_csv(df, path, partition_by=partition_by)
            return read_layer_csv(spark, path, df.schema)
        write_layer_parquet(df, path, partition_by=partition_by)
        return read_layer_parquet(spark, path)

    raw = store("raw", to_raw(lines, profile))
    cleansed = store("cleansed", to_cleansed(raw, profile))
    curated = to_curated(cleansed)
    if by_day:
        curated = curated.withColumn("day", request_day("datetime_confirmed"))
    curated = store("curated", curated, ["day"] if by_day else [])
    hourly = store("hourly_per_client", hourly_per_client_agg(curated))
    devices = store("per_device", per_device_agg(curated))
    clients = store("per_client", per_client_rows(curated))
    return {
        "raw": raw,
        "cleansed": cleansed,
        "curated": curated,
        "hourly_per_client": hourly,
        "hourly_across": store("hourly_across", roll_up_clients(hourly)),
        "hourly_distinct": store("hourly_distinct", count_clients(hourly)),
        "per_device": devices,
        "per_client": clients.drop("first_id"),
        "across_totals": store("across_totals", totals_of_devices(devices)),
        "across_first_hour": store("across_first_hour", first_hour_of_clients(clients)),
    }
