"""Web access-log analytics on Spark: lines to layers to request counts."""

from logquarry.plans.jobs import publish_layers
from logquarry.plans.layers import aggregate_layers, curate, to_cleansed, to_curated, to_raw
from logquarry.plans.profiles import DISTINCT, LOOSE, PROFILES, STRICT, TYPED, LogProfile
from logquarry.session import build_session, object_store_conf, scratch_folder
from logquarry.sources.readers import (
    read_layer_csv,
    read_layer_parquet,
    read_log_lines,
    read_numbered_lines,
    spread_rows,
)

__all__ = [
    "DISTINCT",
    "LOOSE",
    "PROFILES",
    "STRICT",
    "TYPED",
    "LogProfile",
    "aggregate_layers",
    "build_session",
    "curate",
    "object_store_conf",
    "publish_layers",
    "read_layer_csv",
    "read_layer_parquet",
    "read_log_lines",
    "read_numbered_lines",
    "scratch_folder",
    "spread_rows",
    "to_cleansed",
    "to_curated",
    "to_raw",
]
