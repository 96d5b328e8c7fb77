"""Sorting and first rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwright.functions.rules import first_match
from layerwright.operators.keys import row_hash


def order_rows(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Sort by ``keys``; ties in a fixed order.

    The tie columns (row hash, then the partition a row came from) let the range
    partitioner cut inside a run of equal keys or equal rows.
    """
    ties = {"__row_hash": row_hash(df), "__came_from": F.spark_partition_id()}
    return df.withColumns(ties).orderBy(*keys, *ties).drop(*ties)


def sort_by_other_column(df: DataFrame, shown: str, other: str) -> DataFrame:
    """The distinct values of ``shown`` in the order of ``other``."""
    return order_rows(df.groupBy(shown).agg(F.min(other).alias("__other")), "__other", shown).select(shown)


def order_by_rank_rule(
    df: DataFrame, text: str, ranks: Mapping[str, int], default: int, then: str | Column
) -> DataFrame:
    """Sort by the rank of the first keyword found in ``text``, then by input order ``then``."""
    return order_rows(df, first_match(F.col(text), ranks, ignore_case=False, default=default), then)


def first_row(df: DataFrame, *keys: str | Column) -> DataFrame:
    """The first row in the order of ``keys``: each task keeps one row, nothing is sorted whole."""
    return df.orderBy(*keys).limit(1)
