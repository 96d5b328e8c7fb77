"""Tables that come from parameters: constant rows and calendar days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def inline_rows(spark: SparkSession, rows: Sequence[tuple], schema: str | T.StructType) -> DataFrame:
    """A small constant table."""
    return spark.createDataFrame(list(rows), schema)


def days_between(bounds: DataFrame, start: Column, end: Column, keep: Sequence[str] = ()) -> DataFrame:
    """One ``Date`` row per day from ``start`` to ``end``, both included, for each row of ``bounds``."""
    return bounds.select(*keep, F.explode(F.sequence(F.to_date(start), F.to_date(end))).alias("Date"))


def generate_dates(spark: SparkSession, start: str, end: str) -> DataFrame:
    return days_between(spark.range(1), F.lit(start), F.lit(end))
