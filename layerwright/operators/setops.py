"""Unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_all_append(first: DataFrame, *others: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, others, first)


def union_distinct(first: DataFrame, *others: DataFrame) -> DataFrame:
    return union_all_append(first, *others).distinct()
