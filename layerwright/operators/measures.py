"""Measures over a documentation table, hierarchy counts and pivots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwright.operators.ordering import order_rows

# Fixed value: what a supported identity is marked with.
YES = "Yes"
# All, none and some rows support an identity.
ALL_SUPPORTED = "✅"
NONE_SUPPORTED = "❌"
SOME_SUPPORTED = "🟡"


def row_count() -> Column:
    return F.count(F.lit(1))


def yes_count(column: str) -> Column:
    """The number of rows marked Yes; no such row is blank, not 0."""
    return F.nullif(F.count_if(F.col(column) == YES), F.lit(0))


def count_rows_filtered(df: DataFrame, marks: Mapping[str, str]) -> DataFrame:
    """One row: ``n_rows`` and for each ``output: column`` of ``marks`` its Yes count."""
    return df.agg(row_count().alias("n_rows"), *[yes_count(c).alias(name) for name, c in marks.items()])


def measure_by_selection(df: DataFrame, selections: Mapping[int, str]) -> DataFrame:
    """``selection, measure, n_rows``: one row per selectable id, and one with a NULL id for no selection.

    An id picks the Yes count of its column, no selection the count of all rows.
    All measures come out of one pass over ``df``.
    """
    counted = df.agg(row_count().alias("n_rows"), *[yes_count(c).alias(f"m{i}") for i, c in selections.items()])
    picked = [F.struct(F.lit(i).alias("selection"), F.col(f"m{i}").alias("measure"), "n_rows") for i in selections]
    unpicked = F.struct(
        F.lit(None).cast("int").alias("selection"), F.nullif("n_rows", F.lit(0)).alias("measure"), "n_rows"
    )
    return counted.select(F.inline(F.array(*picked, unpicked)))


def disconnected_measure_join(
    df: DataFrame, choices: DataFrame, selection: str, selections: Mapping[int, str]
) -> DataFrame:
    """``choices`` with ``measure`` and ``n_rows`` of ``df`` for the id in column ``selection``.

    ``choices`` has no relation to ``df``: an id without a column of its own gets
    the count of all rows. The measures are one row per selectable id and one
    more, whatever the size of ``df``, so they are broadcast.
    """
    measures = measure_by_selection(df, selections).withColumnRenamed("selection", "__selection")
    picked = F.when(F.col(selection).isin(list(selections)), F.col(selection).cast("int"))
    return choices.join(F.broadcast(measures), picked.eqNullSafe(F.col("__selection")), "left").drop("__selection")


def coverage_flag(measure: Column, n_rows: Column) -> Column:
    """All rows, none or some; NULL when there are no rows at all."""
    return (
        F.when(n_rows == 0, F.lit(None))
        .when(measure == n_rows, ALL_SUPPORTED)
        .when(measure.isNull(), NONE_SUPPORTED)
        .otherwise(SOME_SUPPORTED)
    )


def min_per_group(df: DataFrame, group: str | Sequence[str], column: str, output: str) -> DataFrame:
    groups = [group] if isinstance(group, str) else list(group)
    return df.groupBy(*groups).agg(F.min(column).alias(output))


def measure_filter(df: DataFrame, groups: Sequence[str], measure: Column, output: str) -> DataFrame:
    """Groups whose measure is above 0; a blank measure is not."""
    return df.groupBy(*groups).agg(measure.alias(output)).where(F.col(output) > 0)


def order_by_measure(df: DataFrame, groups: Sequence[str], measure: Column, output: str) -> DataFrame:
    return order_rows(df.groupBy(*groups).agg(measure.alias(output)), output)


def hierarchy_rollup(df: DataFrame, levels: Sequence[str], output: str = "n_rows") -> DataFrame:
    """Row counts along a drill path, with ``level_mask`` telling subtotals from NULL values.

    The rows are counted at the lowest level first, so that only groups, not
    rows, are repeated for the upper levels.
    """
    lowest = df.groupBy(*levels).agg(row_count().alias("__n"))
    return lowest.rollup(*levels).agg(
        F.sum("__n").cast("bigint").alias(output), F.grouping_id().cast("int").alias("level_mask")
    )


def kv_rows_to_columns(
    df: DataFrame, group: Sequence[str], key: str, value: str, position: str, names: Mapping[str, str]
) -> DataFrame:
    """One row per group with a column for each ``output: key`` of ``names``.

    Of a repeated key the last value by position wins. Only the named keys are
    held, one value each, however many rows a group has.
    """
    last = [
        F.max_by(F.col(value), F.when(F.col(key) == wanted, F.col(position))).alias(name)
        for name, wanted in names.items()
    ]
    return df.groupBy(*group).agg(*last)


def pivot_environments(
    df: DataFrame, keys: Sequence[str], environment: str, environments: Sequence[str], value: str, position: str
) -> DataFrame:
    """``value`` of each key spread over one column per environment; the last by position wins."""
    return df.groupBy(*keys).pivot(environment, list(environments)).agg(F.max_by(value, position))
