"""Filters that depend on parameters."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwright.functions.text import normalize_space
from layerwright.operators.ordering import first_row


def filter_group(df: DataFrame, group: str | None, column: str = "group") -> DataFrame:
    """Rows of one group; no group given is all rows."""
    return df.where(F.col(f"`{column}`") == F.lit(group)) if group else df


def filter_enabled(df: DataFrame, *flags: str) -> DataFrame:
    """Rows whose flags are all set."""
    return df.where(reduce(lambda a, b: a & b, [F.col(flag) for flag in flags]))


def in_list_or_prefix(name: Column, names: str | None = None, prefix: str | None = None) -> Column:
    """``name`` is in a comma list or starts with a prefix.

    Either parameter may be left out or empty; with neither every row passes.
    """
    wanted = []
    if names:
        wanted.append(name.isin(names.split(",")))
    if prefix:
        wanted.append(name.startswith(prefix))
    return reduce(lambda a, b: a | b, wanted) if wanted else F.lit(True)


def must_and_any(name: Column, must: str, any_of: Sequence[str]) -> Column:
    """``name`` holds ``must`` and at least one of ``any_of``, whatever the case."""
    lowered = F.coalesce(F.lower(name), F.lit(""))
    either = reduce(lambda a, b: a | b, [lowered.contains(part.lower()) for part in any_of], F.lit(False))
    return lowered.contains(must.lower()) & either


def lookup_by_name(df: DataFrame, column: str, value: str, order_by: str) -> DataFrame:
    """The first row, by ``order_by``, whose name with white space normalised is ``value``."""
    return first_row(df.where(normalize_space(F.col(column)) == value), order_by)


def slicer_values(df: DataFrame, column: str) -> DataFrame:
    """The distinct values for a filter list, in order."""
    return df.select(column).distinct().orderBy(column)
