"""Ordered keyword rules."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_match(text: Column, rules: Mapping[str, Any], ignore_case: bool = True, default: Any = None) -> Column:
    """The value of the first rule whose keyword stands in ``text``, else ``default``.

    Values may be plain values or columns.
    """
    searched = F.lower(text) if ignore_case else text
    branches = None
    for keyword, value in rules.items():
        found = searched.contains(keyword.lower() if ignore_case else keyword)
        branches = F.when(found, F.lit(value)) if branches is None else branches.when(found, F.lit(value))
    return F.lit(default) if branches is None else branches.otherwise(F.lit(default))
