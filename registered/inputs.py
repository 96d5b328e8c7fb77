"""Business tables derived from the driver's tables, in Spark and as SQL of the same name."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwright.session import scratch_path


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt to as many tasks as a shuffle has: for work that is long per row, on a table of few row groups."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def scratch_database(spark: SparkSession, layer: str) -> str:
    """A new database with its own folder in the shared scratch folder."""
    name = f"{layer}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, name)}'")
    return name


def customers(spark: SparkSession, sf: str) -> DataFrame:
    """``CustomerID, FirstName, LastName`` from the two halves of the customer name."""
    halves = F.split("c_name", "#")
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("CustomerID"), halves[0].alias("FirstName"), halves[1].alias("LastName")
    )


CUSTOMERS = """SELECT c_custkey AS CustomerID, split_part(c_name, '#', 1) AS FirstName,
       split_part(c_name, '#', 2) AS LastName FROM customer"""


def products(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").selectExpr(
        "p_partkey AS ProductId", "p_brand AS Manufacturer", "p_name AS ProductName", "p_retailprice AS Price"
    )


PRODUCTS = """SELECT p_partkey AS ProductId, p_brand AS Manufacturer, p_name AS ProductName,
       p_retailprice AS Price FROM part"""


def transactions(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(
        "l_orderkey AS TransactionID",
        "o_orderdate AS TransactionDate",
        "o_custkey AS CustomerId",
        "l_partkey AS ProductID",
        "l_quantity AS Quantity",
        "l_extendedprice AS TotalPrice",
    )


TRANSACTIONS = """SELECT l_orderkey AS TransactionID, o_orderdate AS TransactionDate, o_custkey AS CustomerId,
       l_partkey AS ProductID, l_quantity AS Quantity, l_extendedprice AS TotalPrice
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

FACT = f"""SELECT CAST(strftime(TransactionDate, '%Y%m%d') AS INTEGER) AS DWID_Date,
       CAST(CustomerId AS INTEGER) AS DWID_Customer, CAST(ProductID AS INTEGER) AS DWID_Product,
       TransactionID, CAST(trunc(Quantity) AS INTEGER) AS M_Quantity,
       CASE WHEN Quantity = 0 THEN NULL ELSE TotalPrice / Quantity END AS M_UnitPrice,
       TotalPrice AS M_TotalPrice FROM ({TRANSACTIONS})"""

CALENDAR = """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS DateId, CAST(d AS DATE) AS Date,
       CAST(year(d) AS INTEGER) AS Year, CAST(month(d) AS INTEGER) AS Month, CAST(day(d) AS INTEGER) AS Day
  FROM (SELECT unnest(generate_series(min(o_orderdate)::DATE::TIMESTAMP, max(o_orderdate)::DATE::TIMESTAMP,
                                      INTERVAL 1 DAY)) AS d FROM orders)"""


def docs(spark: SparkSession, sf: str) -> DataFrame:
    """A documentation table: regions are services, nations APIs and customers articles."""
    nation = table(spark, sf, "nation").join(table(spark, sf, "region"), F.expr("n_regionkey = r_regionkey"))
    return (
        table(spark, sf, "customer")
        .join(nation, F.expr("c_nationkey = n_nationkey"))
        .selectExpr(
            "c_name AS Title",
            "concat('https://docs.example/', c_custkey) AS ArticleUrl",
            "CASE WHEN c_acctbal < 0 THEN 'No' ELSE 'Yes' END AS SupportUserIdentity",
            "CASE c_mktsegment WHEN 'BUILDING' THEN 'Yes' WHEN 'MACHINERY' THEN 'N/A' ELSE 'No' END AS SupportSpnAndMi",
            "r_name AS Service",
            "n_name AS API",
        )
    )


DOCS = """SELECT c_name AS Title, 'https://docs.example/' || c_custkey AS ArticleUrl,
       CASE WHEN c_acctbal < 0 THEN 'No' ELSE 'Yes' END AS SupportUserIdentity,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'Yes' WHEN 'MACHINERY' THEN 'N/A' ELSE 'No' END AS SupportSpnAndMi,
       r_name AS Service, n_name AS API
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


def environment_items(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as items of three environments: tst lacks negative balances, prd lacks one segment."""
    return table(spark, sf, "customer").selectExpr(
        "explode(filter(array('dev', IF(c_acctbal >= 0, 'tst', NULL), IF(c_mktsegment != 'BUILDING', 'prd', NULL)),"
        " e -> e IS NOT NULL)) AS environment",
        "c_mktsegment AS layer",
        "concat('Nation', c_nationkey) AS item_type",
        "c_name AS item_name",
        "'item' AS id_kind",
        "c_custkey AS position",
    ).withColumn("id", F.concat_ws("-", "environment", "position"))


ENVIRONMENT_ITEMS = """SELECT environment, c_mktsegment AS layer, 'Nation' || c_nationkey AS item_type,
       c_name AS item_name, 'item' AS id_kind, c_custkey AS position, environment || '-' || c_custkey AS id
  FROM customer CROSS JOIN (VALUES ('dev'), ('tst'), ('prd')) e(environment)
 WHERE environment = 'dev' OR (environment = 'tst' AND c_acctbal >= 0)
    OR (environment = 'prd' AND c_mktsegment <> 'BUILDING')"""


def orchestrator_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Metadata rows: orders wait for customers, those for nations, those for regions and an earlier nation.

    Orders in status P name their customer with an S too many.
    """
    regions = table(spark, sf, "region").selectExpr(
        "concat('region/', r_regionkey) AS notebook_name", "CAST(NULL AS STRING) AS dependencies", "'dimension' AS `group`"
    )
    nations = table(spark, sf, "nation").selectExpr(
        "concat('nation/', n_nationkey) AS notebook_name",
        """concat('["region/', n_regionkey, '"', IF(n_nationkey >= 5, concat(', "nation/', n_nationkey - 5, '"'), ''), ']')
           AS dependencies""",
        "'dimension' AS `group`",
    )
    buyers = table(spark, sf, "customer").selectExpr(
        "concat('customer/', c_custkey) AS notebook_name",
        """concat('["nation/', c_nationkey, '"]') AS dependencies""",
        "'dimension' AS `group`",
    )
    orders = table(spark, sf, "orders").selectExpr(
        "concat('order/', o_orderkey) AS notebook_name",
        """concat('["customer/', o_custkey, IF(o_orderstatus = 'P', 'S', ''), '", "region/0"]') AS dependencies""",
        "'fact' AS `group`",
    )
    return (
        regions.unionByName(nations)
        .unionByName(buyers)
        .unionByName(orders)
        .selectExpr(
            "notebook_name",
            "concat('/load/', notebook_name) AS notebook_path",
            "IF(`group` = 'fact', 600, 300) AS cell_timeout",
            "1 AS retry_count",
            "10 AS retry_interval",
            """IF(`group` = 'fact', '{"useRootDefaultLakehouse": true, "mode": "full"}', NULL) AS arguments""",
            "dependencies",
            "`group`",
            "notebook_name NOT LIKE 'nation/%4' AS is_enabled",
        )
    )


ACTIVITIES = """SELECT 'region/' || r_regionkey AS name, [] ::VARCHAR[] AS deps, 'dimension' AS grp FROM region
 UNION ALL SELECT 'nation/' || n_nationkey,
        CASE WHEN n_nationkey >= 5 THEN ['region/' || n_regionkey, 'nation/' || (n_nationkey - 5)]
             ELSE ['region/' || n_regionkey] END, 'dimension' FROM nation
 UNION ALL SELECT 'customer/' || c_custkey, ['nation/' || c_nationkey], 'dimension' FROM customer
 UNION ALL SELECT 'order/' || o_orderkey,
        ['customer/' || o_custkey || CASE WHEN o_orderstatus = 'P' THEN 'S' ELSE '' END, 'region/0'], 'fact' FROM orders"""


def upper_nodes(spark: SparkSession, sf: str) -> DataFrame:
    """Regions and nations as a table of contents; one nation is titled Overview."""
    return (
        table(spark, sf, "region")
        .selectExpr(
            "concat('r', r_regionkey) AS id",
            "CAST(NULL AS STRING) AS parent_id",
            "CAST(r_regionkey AS BIGINT) AS ord",
            "r_name AS title",
            "CAST(NULL AS STRING) AS href",
        )
        .unionByName(
            table(spark, sf, "nation").selectExpr(
                "concat('n', n_nationkey) AS id",
                "concat('r', n_regionkey) AS parent_id",
                "CAST(n_nationkey AS BIGINT) AS ord",
                "IF(n_name = 'NATION_7', 'Overview', n_name) AS title",
                "IF(n_regionkey = 0, NULL, concat('nation/', n_nationkey)) AS href",
            )
        )
    )


def tree_nodes(spark: SparkSession, sf: str) -> DataFrame:
    """The upper nodes with customers and orders below them."""
    return (
        upper_nodes(spark, sf)
        .unionByName(
            table(spark, sf, "customer").selectExpr(
                "concat('c', c_custkey) AS id",
                "concat('n', c_nationkey) AS parent_id",
                "c_custkey AS ord",
                "c_name AS title",
                "concat('customer/', c_custkey) AS href",
            )
        )
        .unionByName(
            table(spark, sf, "orders").selectExpr(
                "concat('o', o_orderkey) AS id",
                "concat('c', o_custkey) AS parent_id",
                "o_orderkey AS ord",
                "o_orderpriority AS title",
                "concat('order/', o_orderkey) AS href",
            )
        )
    )


TREE_NODES = """SELECT 'r' || r_regionkey AS id, NULL ::VARCHAR AS parent_id, r_regionkey::BIGINT AS ord,
       r_name AS title, NULL ::VARCHAR AS href FROM region
 UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, n_nationkey,
       CASE WHEN n_name = 'NATION_7' THEN 'Overview' ELSE n_name END,
       CASE WHEN n_regionkey = 0 THEN NULL ELSE 'nation/' || n_nationkey END FROM nation
 UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, c_custkey, c_name, 'customer/' || c_custkey FROM customer
 UNION ALL SELECT 'o' || o_orderkey, 'c' || o_custkey, o_orderkey, o_orderpriority, 'order/' || o_orderkey FROM orders"""
