"""The star schema: date, customer and product dimensions, the sales fact, and counts over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwright.functions.dates import date_key, day_parts
from layerwright.functions.numbers import double_or_null, int_or_null, ratio_or_null
from layerwright.functions.text import full_name
from layerwright.operators.joins import star_join
from layerwright.operators.keys import ID_COLUMN, add_dense_id
from layerwright.operators.projection import derive_columns, project_alias
from layerwright.sources.generated import days_between, generate_dates


def with_date_parts(days: DataFrame) -> DataFrame:
    """``DateId, Date, Year, Month, Day`` of a table of ``Date``."""
    parts = derive_columns(days, {"DateId": date_key(F.col("Date")), **day_parts(F.col("Date"))})
    return parts.select("DateId", "Date", "Year", "Month", "Day")


def base_dim_date(spark: SparkSession, start: str, end: str) -> DataFrame:
    """The calendar from ``start`` to ``end``; the table sink puts the ``Id`` in front."""
    return with_date_parts(generate_dates(spark, start, end))


def calendar_of(df: DataFrame, day: str) -> DataFrame:
    """The calendar from the first to the last day found in ``df``."""
    bounds = df.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    return with_date_parts(days_between(bounds, F.col("first"), F.col("last")))


def dim_date(base: DataFrame) -> DataFrame:
    return project_alias(
        base, {"DateId": "DWID_Date", "Date": "Date", "Year": "Year", "Month": "Month", "Day": "Day"}
    )


def _keyed(base: DataFrame, business_key: str) -> DataFrame:
    """``base`` with its ``Id``, or with one that follows the business key if it has none."""
    return base if ID_COLUMN in base.columns else add_dense_id(base, [business_key])


def customer_attributes(base: DataFrame) -> DataFrame:
    """The customer dimension but for its key: what a join by business key needs."""
    customers = project_alias(base, {name: name for name in ("CustomerID", "FirstName", "LastName")})
    return derive_columns(customers, {"FullName": full_name(F.col("FirstName"), F.col("LastName"))})


def product_attributes(base: DataFrame) -> DataFrame:
    """The product dimension but for its key."""
    names = {name: name for name in ("Manufacturer", "ProductName", "Price")}
    return project_alias(base, {"ProductId": "ProductsId", **names})


def dim_customer(base: DataFrame) -> DataFrame:
    names = {name: name for name in ("CustomerID", "FirstName", "LastName")}
    customers = project_alias(_keyed(base, "CustomerID"), {ID_COLUMN: "DWID_Customer", **names})
    return derive_columns(customers, {"FullName": full_name(F.col("FirstName"), F.col("LastName"))})


def dim_product(base: DataFrame) -> DataFrame:
    names = {name: name for name in ("Manufacturer", "ProductName", "Price")}
    return project_alias(
        _keyed(base, "ProductId"), {ID_COLUMN: "DWID_Product", "ProductId": "ProductsId", **names}
    )


def fact_sales(base: DataFrame, key_type: str = "int") -> DataFrame:
    """The sales fact. A value that is no number is NULL, and so is a unit price for quantity 0.

    ``key_type`` may be ``bigint`` where business keys outgrow INT.
    """
    return base.select(
        date_key(F.col("TransactionDate")).alias("DWID_Date"),
        int_or_null(base, "CustomerId", key_type).alias("DWID_Customer"),
        int_or_null(base, "ProductID", key_type).alias("DWID_Product"),
        "TransactionID",
        int_or_null(base, "Quantity").alias("M_Quantity"),
        ratio_or_null(F.col("TotalPrice"), F.col("Quantity")).alias("M_UnitPrice"),
        double_or_null(F.col("TotalPrice")).alias("M_TotalPrice"),
    )


def sales_rollup(
    fact: DataFrame,
    dates: DataFrame,
    customers: DataFrame | None = None,
    levels: Sequence[str] = ("Date_Year", "Date_Month"),
) -> DataFrame:
    """Sales counts and quantities along ``levels``, with ``level_mask`` for the subtotals.

    The fact is summed up by its dimension keys before any join, so only one row
    per key combination meets the dimensions.
    """
    keys = ["DWID_Date"] + (["DWID_Customer"] if customers is not None else [])
    summed = fact.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__sales"), F.sum(F.col("M_Quantity").cast("bigint")).alias("__quantity")
    )
    lowest = star_join(summed, dates, customers).groupBy(*levels).agg(
        F.sum("__sales").alias("__sales"), F.sum("__quantity").alias("__quantity")
    )
    return lowest.rollup(*levels).agg(
        F.sum("__sales").cast("bigint").alias("n_sales"),
        F.sum("__quantity").cast("bigint").alias("quantity"),
        F.grouping_id().cast("int").alias("level_mask"),
    )
