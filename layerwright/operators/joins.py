"""Joins.

No join forces a broadcast of a table of unknown size. Spark broadcasts by
measured size (``spark.sql.autoBroadcastJoinThreshold``) and else sort-merges,
with skewed partitions split by AQE; rows listed in code have exact sizes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwright.functions.numbers import int_or_null
from layerwright.sources.generated import inline_rows


def map_lookup_join(
    df: DataFrame, column: str, mapping: Mapping[str, Any], output: str, value_type: str = "string"
) -> DataFrame:
    """Add ``output``, the value the mapping has for ``column``; NULL where it has none."""
    listed = inline_rows(df.sparkSession, list(mapping.items()), f"`__key` string, `{output}` {value_type}")
    return df.join(listed, F.col(column) == F.col("__key"), "left").drop("__key")


def split_lookup(df: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join ``df`` with ``lookup``, one row per key out of an aggregation, so that hot keys can be split.

    Joined on the keys alone the lookup would keep the partitions of its
    aggregation, and AQE only splits what was shuffled for the join itself.
    Joined on the keys and their hash it is shuffled once more, at one row per
    key, and a hot key of ``df`` is cut into as many tasks as its size asks for.
    Key columns that are NULL never match.
    """
    key_hash = {"__key_hash": F.xxhash64(*keys)}
    return df.withColumns(key_hash).join(lookup.withColumns(key_hash), ["__key_hash", *keys], how).drop("__key_hash")


def join_ingest_lookup(connections: DataFrame, objects: DataFrame, connection_name: str | None = None) -> DataFrame:
    """The enabled objects of enabled connections, of one connection if named."""
    conn = connections.alias("conn").where("conn.is_enabled")
    if connection_name is not None:
        conn = conn.where(F.col("conn.connection_name") == F.lit(connection_name))
    obj = objects.alias("obj").where("obj.is_enabled")
    return conn.join(obj, F.col("conn.id") == F.col("obj.connection_id")).select(
        "conn.connection_id", "conn.connection_name", "obj.schema_name", "obj.table_name"
    )


def _attributes(dimension: DataFrame, prefix: str, key: Column, leave_out: set[str]) -> DataFrame:
    columns = [F.col(name).alias(f"{prefix}_{name}") for name in dimension.columns if name not in leave_out]
    return dimension.select(key.alias(f"__{prefix}"), *columns)


def star_join(
    fact: DataFrame,
    dim_date: DataFrame | None = None,
    dim_customer: DataFrame | None = None,
    dim_product: DataFrame | None = None,
) -> DataFrame:
    """Fact rows with the attributes of their dimensions, prefixed by the dimension's name.

    Customers and products match on the business key, which is what the fact
    carries. A dimension that is not given is not joined; a fact row without a
    match keeps NULL attributes.
    """
    joined = fact
    if dim_date is not None:
        days = _attributes(dim_date, "Date", F.col("DWID_Date"), {"DWID_Date"})
        joined = joined.join(days, F.col("DWID_Date") == F.col("__Date"), "left").drop("__Date")
    if dim_customer is not None:
        customers = _attributes(dim_customer, "Customer", int_or_null(dim_customer, "CustomerID"), {"DWID_Customer"})
        joined = joined.join(customers, F.col("DWID_Customer") == F.col("__Customer"), "left").drop("__Customer")
    if dim_product is not None:
        products = _attributes(dim_product, "Product", int_or_null(dim_product, "ProductsId"), {"DWID_Product"})
        joined = joined.join(products, F.col("DWID_Product") == F.col("__Product"), "left").drop("__Product")
    return joined
