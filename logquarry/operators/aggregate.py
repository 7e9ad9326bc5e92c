"""Request counts per device, per client and across all of them.

Every aggregate starts with a map-side partial, so the shuffle carries at most one row
per group and task, however many requests one client or hour has. Hours are grouped as
(date, int) pairs and spelled out as ``day_hour`` afterwards, once per group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logquarry.functions.clean import day_hour, method_marker, request_day, request_hour
from logquarry.functions.extract import extract_device
from logquarry.functions.patterns import METHODS

_TIME = "datetime_confirmed"


def _method_counts(prefix: str = "") -> list[Column]:
    return [
        F.count(method_marker("method_GET", name)).alias(prefix + name.lower()) for name in METHODS
    ]


def _with_hour(curated: DataFrame) -> DataFrame:
    return curated.withColumns({"day": request_day(_TIME), "hour": request_hour(_TIME)})


def _spell_hour(grouped: DataFrame) -> DataFrame:
    rest = [c for c in grouped.columns if c not in ("day", "hour")]
    return grouped.select(day_hour("day", "hour").alias("day_hour"), *rest)


def per_device_agg(curated: DataFrame) -> DataFrame:
    """device → get, post, head, hour (the sum of hours), no_of_client (requests)."""
    return (
        curated.withColumns({"device": extract_device("user_agent"), "hour": request_hour(_TIME)})
        .groupBy("device")
        .agg(
            *_method_counts(),
            F.sum("hour").alias("hour"),
            F.count("clientip").alias("no_of_client"),
        )
    )


def per_client_rows(curated: DataFrame) -> DataFrame:
    """The rows of :func:`per_client_agg` with the ``first_id`` of each client."""
    return (
        curated.withColumn("hour", request_hour(_TIME))
        .groupBy("clientip")
        .agg(
            *_method_counts(),
            F.min_by("hour", "id").alias("hour"),
            F.count("clientip").alias("no_of_client"),
            F.min("id").alias("first_id"),
        )
    )


def per_client_agg(curated: DataFrame) -> DataFrame:
    """clientip → get, post, head, hour (of its lowest id), no_of_client (requests)."""
    return per_client_rows(curated).drop("first_id")


def hourly_per_client_agg(curated: DataFrame) -> DataFrame:
    """day_hour, clientip → count_row, get, post, head."""
    return (
        _with_hour(curated)
        .groupBy("day", "hour", "clientip")
        .agg(F.count("id").alias("count_row"), *_method_counts())
        .transform(_spell_hour)
    )


def across_device_totals(curated: DataFrame) -> DataFrame:
    """One row: no_get, no_post, no_head, day_hour (the sum of hours), no_of_clients (requests)."""
    return aggregate_row_id(
        curated.withColumn("hour", request_hour(_TIME)).agg(
            *_method_counts("no_"),
            F.sum("hour").alias("day_hour"),
            F.count("clientip").alias("no_of_clients"),
        )
    )


def across_clients_first_hour(curated: DataFrame) -> DataFrame:
    """One row over the per-client rows: each no_* counts clients, day_hour is the first hour.

    The method columns of a per-client row are counts, hence never NULL, so counting them
    gives the number of per-client rows each time.
    """
    return first_hour_of_clients(per_client_rows(curated))


def first_hour_of_clients(per_client: DataFrame) -> DataFrame:
    """:func:`across_clients_first_hour` from the rows of :func:`per_client_rows`."""
    return aggregate_row_id(
        per_client.agg(
            *[F.count(name.lower()).alias(f"no_{name.lower()}") for name in METHODS],
            F.min_by("hour", "first_id").alias("day_hour"),
            F.count("clientip").alias("no_of_clients"),
        )
    )


def totals_of_devices(per_device: DataFrame) -> DataFrame:
    """The row of :func:`across_device_totals` from those of :func:`per_device_agg`."""
    total = lambda name: F.coalesce(F.sum(name), F.lit(0))
    return aggregate_row_id(
        per_device.agg(
            *[total(name.lower()).alias(f"no_{name.lower()}") for name in METHODS],
            F.sum("hour").alias("day_hour"),
            total("no_of_client").alias("no_of_clients"),
        )
    )


def hourly_across_agg(curated: DataFrame) -> DataFrame:
    """day_hour → no_of_clients (requests with a client), count_row, get, post, head."""
    return (
        _with_hour(curated)
        .groupBy("day", "hour")
        .agg(
            F.count("clientip").alias("no_of_clients"),
            F.count("id").alias("count_row"),
            *_method_counts(),
        )
        .transform(_spell_hour)
    )


def roll_up_clients(hourly_per_client: DataFrame) -> DataFrame:
    """The rows of :func:`hourly_across_agg`, from those of :func:`hourly_per_client_agg`.

    A written per-client table holds far fewer rows than the log, so the hourly totals
    need not parse it a second time.
    """
    return hourly_per_client.groupBy("day_hour").agg(
        F.coalesce(
            F.sum(F.when(F.col("clientip").isNotNull(), F.col("count_row"))), F.lit(0)
        ).alias("no_of_clients"),
        F.sum("count_row").alias("count_row"),
        *[F.sum(name.lower()).alias(name.lower()) for name in METHODS],
    )


def count_clients(hourly_per_client: DataFrame) -> DataFrame:
    """day_hour → no_of_clients, id, no_get, no_post, no_head over per-client rows.

    Each output counts the rows of the hour, that is its distinct clients; only
    ``no_of_clients`` leaves out a NULL client.
    """
    return hourly_per_client.groupBy("day_hour").agg(*_client_counts())


def hourly_distinct_clients(curated: DataFrame) -> DataFrame:
    """:func:`count_clients` straight from the curated layer.

    Two aggregates, not one ``count(DISTINCT)`` per output: the first one removes repeats
    on the map side, so a busy hour reaches the second as one row per client.
    """
    clients = _with_hour(curated).select("day", "hour", "clientip").distinct()
    return clients.groupBy("day", "hour").agg(*_client_counts()).transform(_spell_hour)


def _client_counts() -> list[Column]:
    rows = ["id", *[f"no_{name.lower()}" for name in METHODS]]
    return [
        F.count("clientip").alias("no_of_clients"),
        *[F.count(F.lit(1)).alias(name) for name in rows],
    ]


def aggregate_row_id(df: DataFrame) -> DataFrame:
    """Add ``row_id``: 0 on a one-row total, else unique but not dense."""
    return df.withColumn("row_id", F.monotonically_increasing_id())


def row_count(df: DataFrame) -> DataFrame:
    """The number of rows, as a frame, so that asking for it runs nothing yet."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))
