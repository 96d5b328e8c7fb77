"""Catalog scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def scan_table(spark: SparkSession, table: str, database: str | None = None) -> DataFrame:
    return spark.table(f"{database}.{table}" if database else table)
