"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerwright.session import stage

ID_COLUMN = "Id"


def add_surrogate_id(df: DataFrame, name: str = ID_COLUMN) -> DataFrame:
    """A unique positive BIGINT in front, with gaps; unchanged when the column is there.

    Needs no shuffle. The first row of the first partition gets 1. The numbers
    may differ between runs.
    """
    if name in df.columns:
        return df
    return df.select((F.monotonically_increasing_id() + 1).alias(name), "*")


def row_hash(df: DataFrame) -> Column:
    """One hash over all columns, maps included."""
    columns = [
        F.to_json(F.struct(F.col(f"`{name}`"))) if "map<" in dtype or "variant" in dtype else F.col(f"`{name}`")
        for name, dtype in df.dtypes
    ]
    return F.xxhash64(*columns)


def add_dense_id(df: DataFrame, keys: Sequence[str], name: str = ID_COLUMN) -> DataFrame:
    """Number the rows 1..n in the order of ``keys``, the same way in every run.

    The rows are range-partitioned and sorted once and staged as Parquet files
    in key order; a row's number is the row count of the files before its own
    plus its place in the file. So no task sees more than its range. Rows with
    one key are split by row hash, and copies of one row by the partition they
    came from, both of which stay the same when a lost task runs again.
    """
    ties = {"__row_hash": row_hash(df), "__came_from": F.spark_partition_id()}
    order = [*keys, *ties]
    ranged = df.withColumns(ties).repartitionByRange(*order).sortWithinPartitions(*order).drop(*ties)
    staged = stage(ranged, "dense-id")

    file_name = F.col("_metadata.file_name")
    per_file = staged.groupBy(file_name.alias("__file")).agg(F.count(F.lit(1)).alias("__rows"))
    # One row per file, so at most one per shuffle partition: small for a window
    # and for a broadcast.
    in_order = Window.orderBy(
        F.regexp_extract("__file", r"^part-(\d+)", 1).cast("int"),
        F.regexp_extract("__file", r"-c(\d+)", 1).cast("int"),
    ).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_file.select("__file", F.coalesce(F.sum("__rows").over(in_order), F.lit(0)).alias("__offset"))

    numbered = staged.select("*", file_name.alias("__file"), F.col("_metadata.row_index").alias("__place"))
    return numbered.join(F.broadcast(offsets), "__file").select(
        (F.col("__offset") + F.col("__place") + 1).alias(name), *df.columns
    )
