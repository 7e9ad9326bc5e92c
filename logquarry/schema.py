"""Columns and types of the layers."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

REFERER_PRESENT = "referer_present(Y/N)"


def _schema(**types) -> StructType:
    return StructType([StructField(name, dtype) for name, dtype in types.items()])


RAW_SCHEMA = _schema(
    id=LongType(),
    clientip=StringType(),
    datetime_confirmed=StringType(),
    method_GET=StringType(),
    request=StringType(),
    status_code=StringType(),
    size=DoubleType(),
    referer=StringType(),
    user_agent=StringType(),
)

CLEANSED_SCHEMA = _schema(
    id=LongType(),
    clientip=StringType(),
    datetime_confirmed=TimestampNTZType(),
    method_GET=StringType(),
    request=StringType(),
    status_code=IntegerType(),
    size=DoubleType(),
    referer=StringType(),
    user_agent=StringType(),
    **{REFERER_PRESENT: StringType()},
)

CURATED_SCHEMA = StructType([f for f in CLEANSED_SCHEMA.fields if f.name != "referer"])

RAW_COLUMNS = RAW_SCHEMA.names
EXTRACTED_COLUMNS = RAW_COLUMNS[1:]
DEDUP_KEYS = ["clientip", "datetime_confirmed", "method_GET"]
# Extracted text to numbers; a response can be larger than an int holds.
COLUMN_TYPES = {"status_code": "int", "size": "bigint"}
WAREHOUSE_COLUMNS = [
    "id",
    "clientip",
    "datetime_confirmed",
    "method_GET",
    "status_code",
    "size",
    "user_agent",
    "referer_present",
]
