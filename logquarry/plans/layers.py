"""Lines → raw → cleansed → curated → aggregates.

Each function is lazy. Chained without writing, they make one plan, and a query that
ends in an aggregate only evaluates the patterns whose columns it reads.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from logquarry.functions.clean import first_token, parse_timestamp, size_to_kb
from logquarry.functions.patterns import TIME_FORMAT
from logquarry.operators import aggregate
from logquarry.operators.cleaning import blank_to_null, drop_referer, fill_na, referer_flag, type_columns
from logquarry.operators.dedup import dedup_requests
from logquarry.operators.extraction import extract_columns
from logquarry.plans.profiles import LOOSE, LogProfile
from logquarry.schema import COLUMN_TYPES, DEDUP_KEYS, EXTRACTED_COLUMNS


def to_raw(
    lines: DataFrame, profile: LogProfile = LOOSE, columns: Sequence[str] = EXTRACTED_COLUMNS
) -> DataFrame:
    """Extract, remove duplicates, strip the request, size to KB, mark what is missing.

    With fewer ``columns`` the later layers stay as narrow. Counting requests takes
    ``DEDUP_KEYS`` only, and removing duplicates among those alone is cheaper. Otherwise the
    line is carried along, and the other fields are extracted from lines that stay.
    """
    if profile.dedup:
        rest = [c for c in columns if c not in DEDUP_KEYS]
        keyed = extract_columns(lines, profile.family, DEDUP_KEYS, keep=["value"] if rest else [])
        kept = dedup_requests(keyed)
        raw = extract_columns(kept, profile.family, rest, keep=[c for c in columns if c in DEDUP_KEYS])
    else:
        raw = extract_columns(lines, profile.family, columns)
    raw = raw.select("id", *columns)
    if profile.strip and "request" in columns:
        raw = raw.withColumn("request", profile.strip("request"))
    if profile.kb_digits is not None and "size" in columns:
        raw = raw.withColumn("size", size_to_kb("size", profile.kb_digits))
    return profile.mark_missing(raw) if profile.mark_missing else raw


def to_cleansed(
    raw: DataFrame, profile: LogProfile = LOOSE, time_format: str = TIME_FORMAT
) -> DataFrame:
    """Type the time and the status, settle missing strings, flag the referer.

    A raw layer in memory and one read back from files give the same rows: where files
    would trim strings and make blanks NULL, ``blank_to_null`` does.
    """
    if profile.blanks_null:
        raw = blank_to_null(raw)
    cleansed = raw
    if "datetime_confirmed" in raw.columns:
        time = parse_timestamp(first_token("datetime_confirmed"), time_format)
        cleansed = raw.withColumn("datetime_confirmed", time)
    types = dict(COLUMN_TYPES)
    if profile.kb_digits is not None:
        del types["size"]  # KB are numbers already.
    cleansed = type_columns(cleansed, types)
    if profile.fill:
        cleansed = fill_na(cleansed)
    return referer_flag(cleansed) if "referer" in raw.columns else cleansed


def to_curated(cleansed: DataFrame) -> DataFrame:
    return drop_referer(cleansed)


def curate(
    lines: DataFrame, profile: LogProfile = LOOSE, columns: Sequence[str] = EXTRACTED_COLUMNS
) -> DataFrame:
    """Lines straight to the curated layer."""
    return to_curated(to_cleansed(to_raw(lines, profile, columns), profile))


def aggregate_layers(curated: DataFrame, cache: bool = False) -> dict[str, DataFrame]:
    """All aggregates of a curated layer, by table name.

    ``cache`` marks them for reuse; the caller unpersists. Cache aggregates, not layers:
    they are small and each would otherwise scan the layer again.
    """
    frames = {
        "per_device": aggregate.per_device_agg(curated),
        "per_client": aggregate.per_client_agg(curated),
        "hourly_per_client": aggregate.hourly_per_client_agg(curated),
        "across_totals": aggregate.across_device_totals(curated),
        "across_first_hour": aggregate.across_clients_first_hour(curated),
        "hourly_across": aggregate.hourly_across_agg(curated),
        "hourly_distinct": aggregate.hourly_distinct_clients(curated),
    }
    return {name: df.cache() for name, df in frames.items()} if cache else frames
