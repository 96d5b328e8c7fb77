"""Projections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwright.operators.ordering import order_rows

# The types a model column may have.
MODEL_TYPES = {"string": "string", "integer": "int"}


@dataclass(frozen=True)
class ModelColumn:
    name: str
    source: str
    data_type: str = "string"
    hidden: bool = False
    sort_by: str | None = None


def project_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The listed columns in list order; no list, or an empty one, is all."""
    return df.select(*columns) if columns else df


def project_alias(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """The source columns of ``names`` under their business names, in mapping order."""
    return df.select(*[F.col(source).alias(target) for source, target in names.items()])


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def derive_columns(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add or replace computed columns."""
    return df.withColumns(dict(columns))


def model_view(df: DataFrame, columns: Sequence[ModelColumn], show_hidden: bool = False) -> DataFrame:
    """Rename and cast by a column map, sort by the columns others are sorted by, leave out hidden ones."""
    view = df.select(*[F.col(c.source).cast(MODEL_TYPES[c.data_type]).alias(c.name) for c in columns])
    sort_keys = [c.sort_by for c in columns if c.sort_by]
    if sort_keys:
        view = order_rows(view, *sort_keys)
    return view if show_hidden else view.select(*[c.name for c in columns if not c.hidden])
