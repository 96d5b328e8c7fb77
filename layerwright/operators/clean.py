"""De-duplication, null filling, defaults."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MISSING_TEXT = "N/A"


def dedupe_rows(df: DataFrame) -> DataFrame:
    """Drop rows equal in all columns; NULL equals NULL and NaN equals NaN.

    Copies are folded on the map side, so a hot row crosses the shuffle once per
    task.
    """
    return df.dropDuplicates()


def fill_numeric_zero(df: DataFrame) -> DataFrame:
    return df.na.fill(0)


def fill_string_na(df: DataFrame) -> DataFrame:
    return df.na.fill(MISSING_TEXT)


def cleanse(df: DataFrame) -> DataFrame:
    return fill_string_na(fill_numeric_zero(dedupe_rows(df)))


def apply_defaults(df: DataFrame, defaults: Mapping[str, Any]) -> DataFrame:
    """Put the column default where a value is missing; a column that is not there is added."""
    return df.withColumns(
        {
            name: F.coalesce(F.col(f"`{name}`"), F.lit(value)) if name in df.columns else F.lit(value)
            for name, value in defaults.items()
        }
    )
