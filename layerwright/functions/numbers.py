"""Casts and divisions that give NULL where the operand is no number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_WHOLE_PART = r"^\s*([+-]?\d+)(?:\.\d*)?\s*$"


def text_to_int(column: Column, to: str = "int") -> Column:
    """The whole part of a number in text; NULL for other text or out of range."""
    return F.regexp_extract(column, _WHOLE_PART, 1).try_cast(to)


def int_or_null(df: DataFrame, name: str, to: str = "int") -> Column:
    """Column ``name`` of ``df`` as an integer, whether it holds text or numbers."""
    if dict(df.dtypes)[name] == "string":
        return text_to_int(F.col(name), to)
    return F.col(name).try_cast(to)


def double_or_null(column: Column) -> Column:
    return column.try_cast("double")


def ratio_or_null(dividend: Column, divisor: Column) -> Column:
    """``dividend / divisor`` as double; NULL for text operands and for division by zero."""
    return F.try_divide(double_or_null(dividend), double_or_null(divisor))
