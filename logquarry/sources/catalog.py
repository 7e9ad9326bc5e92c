"""What the catalog holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def list_databases(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES")


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN `{database}`" if database else "SHOW TABLES")
