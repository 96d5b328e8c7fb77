"""Column lists that stand as JSON text in metadata."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_column_list(text: Column) -> Column:
    """True when ``text`` is a JSON list that holds nothing but strings, NULL for no text."""
    items = F.try_variant_get(F.try_parse_json(text), "$", "array<variant>")
    only_strings = F.forall(items, lambda item: F.schema_of_variant(item) == "STRING")
    return F.when(text.isNotNull(), F.coalesce(only_strings, F.lit(False)))


def parse_column_list(text: Column, strict: bool = True) -> Column:
    """``ARRAY<STRING>`` of a JSON list of strings, NULL for no text.

    Anything else is an error, or NULL when not ``strict``.
    """
    refused = (
        F.raise_error(F.concat(F.lit('not a JSON list of column names such as ["a", "b"]: '), text))
        if strict
        else F.lit(None)
    ).cast("array<string>")
    return F.when(is_column_list(text), F.from_json(text, "array<string>")).when(text.isNotNull(), refused)
