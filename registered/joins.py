"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from layerwright.operators import dag, joins, measures, xref
from layerwright.operators.metadata import dag_from_metadata as parse_activities
from layerwright.plans import star
from layerwright.plans.docs import IDENTITY_MEASURES
from registered import Registry, inputs
from registered.inputs import table

registry = Registry()


@registry.query(
    """SELECT 'conn-' || n_nationkey AS connection_id, 'region_' || n_regionkey AS connection_name,
              c_mktsegment AS schema_name, c_name AS table_name
         FROM nation JOIN customer ON c_nationkey = n_nationkey
        WHERE n_regionkey = 2 AND n_nationkey <> 7 AND c_acctbal >= 0"""
)
def join_ingest_lookup(spark, sf):
    connections = table(spark, sf, "nation").selectExpr(
        "n_nationkey AS id",
        "concat('conn-', n_nationkey) AS connection_id",
        "concat('region_', n_regionkey) AS connection_name",
        "n_nationkey <> 7 AS is_enabled",
    )
    objects = table(spark, sf, "customer").selectExpr(
        "c_nationkey AS connection_id",
        "c_mktsegment AS schema_name",
        "c_name AS table_name",
        "c_acctbal >= 0 AS is_enabled",
    )
    return joins.join_ingest_lookup(connections, objects, "region_2")


@registry.query(
    f"""SELECT f.*, d.Date AS Date_Date, d.Year AS Date_Year, d.Month AS Date_Month, d.Day AS Date_Day,
               c.CustomerID AS Customer_CustomerID, c.FirstName AS Customer_FirstName, c.LastName AS Customer_LastName,
               c.FirstName || ' ' || c.LastName AS Customer_FullName,
               p.ProductId AS Product_ProductsId, p.Manufacturer AS Product_Manufacturer,
               p.ProductName AS Product_ProductName, p.Price AS Product_Price
          FROM ({inputs.FACT}) f
          LEFT JOIN ({inputs.CALENDAR}) d ON f.DWID_Date = d.DateId
          LEFT JOIN ({inputs.CUSTOMERS}) c ON f.DWID_Customer = c.CustomerID
          LEFT JOIN ({inputs.PRODUCTS}) p ON f.DWID_Product = p.ProductId"""
)
def star_join(spark, sf):
    return joins.star_join(
        star.fact_sales(inputs.transactions(spark, sf)),
        star.dim_date(star.calendar_of(table(spark, sf, "orders"), "o_orderdate")),
        star.customer_attributes(inputs.customers(spark, sf)),
        star.product_attributes(inputs.products(spark, sf)),
    )


def _choices(spark, sf):
    """Nations as the rows of a table without relation to the documents."""
    return table(spark, sf, "nation").selectExpr("n_nationkey AS IdentityNo", "n_name AS Identity")


@registry.query(
    f"""WITH docs AS ({inputs.DOCS})
        SELECT n_nationkey AS IdentityNo, n_name AS Identity,
               nullif(CASE n_nationkey
                      WHEN 1 THEN (SELECT count(*) FROM docs WHERE SupportUserIdentity = 'Yes')
                      WHEN 2 THEN (SELECT count(*) FROM docs WHERE SupportSpnAndMi = 'Yes')
                      ELSE (SELECT count(*) FROM docs) END, 0) AS measure,
               (SELECT count(*) FROM docs) AS n_rows FROM nation"""
)
def disconnected_measure_join(spark, sf):
    return measures.disconnected_measure_join(
        inputs.docs(spark, sf), _choices(spark, sf), "IdentityNo", IDENTITY_MEASURES
    )


_XREF = f"""WITH items AS ({inputs.ENVIRONMENT_ITEMS})
    SELECT d.id AS primary_id, d.layer, d.item_type, d.item_name, d.id_kind, t.id AS tst, p.id AS prd
      FROM items d
      LEFT JOIN items t ON t.environment = 'tst' AND t.layer = d.layer AND t.item_type = d.item_type AND t.item_name = d.item_name
      LEFT JOIN items p ON p.environment = 'prd' AND p.layer = d.layer AND p.item_type = d.item_type AND p.item_name = d.item_name
     WHERE d.environment = 'dev' AND (t.id IS NOT NULL OR p.id IS NOT NULL)"""


@registry.query(_XREF)
def xref_environments(spark, sf):
    return xref.xref_environments(inputs.environment_items(spark, sf), "dev", ["tst", "prd"])


@registry.query(f"SELECT *, item_type || ' Guid - ' || item_name AS label FROM ({_XREF})")
def xref_ordered(spark, sf):
    found = xref.xref_environments(inputs.environment_items(spark, sf), "dev", ["tst", "prd"])
    return xref.ordered_id_map(found, "primary_id")


@registry.query(
    """SELECT 'dev-' || c_custkey AS primary_id, c_mktsegment AS layer, 'Lakehouse' AS item_type, c_name AS item_name,
              'item' AS id_kind, 'prd-' || c_custkey AS prd FROM customer WHERE c_acctbal >= 0
       UNION ALL SELECT 'dev-w' || c_custkey, c_mktsegment, 'Workspace', c_mktsegment, 'workspace', 'prd-w' || c_custkey
         FROM (SELECT c_mktsegment, max(c_custkey) AS c_custkey FROM customer GROUP BY c_mktsegment)"""
)
def definition_ids(spark, sf):
    """A definition per customer and environment; prd lacks customers with a negative balance.

    Every definition of a segment names the same workspace.
    """
    people = table(spark, sf, "customer")
    workspaces = people.groupBy("c_mktsegment").agg(F.max("c_custkey").alias("w"))
    definitions = people.join(workspaces, "c_mktsegment").selectExpr(
        "explode(array('dev', 'prd')) AS environment", "c_custkey", "c_name", "c_acctbal", "c_mktsegment", "w"
    )
    text = F.expr(
        """concat('{"layers": {"', c_mktsegment, '": {"workspace_id": ', IF(c_custkey = w, concat('"', environment, '-w', w, '"'), 'null'),
                  ', "items": {"Lakehouse": [{"item_name": "', c_name, '", "id": ',
                  IF(environment = 'dev' OR c_acctbal >= 0, concat('"', environment, '-', c_custkey, '"'), 'null'), '}]}}}}')"""
    )
    ids = xref.definition_ids(definitions.select("environment", text.alias("definition")), "definition", ["environment"])
    return xref.xref_environments(ids, "dev", ["prd"])


@registry.query(
    f"""WITH a AS ({inputs.ACTIVITIES}), e AS (SELECT name, unnest(deps) AS dependency FROM a)
        SELECT name, dependency FROM e WHERE dependency NOT IN (SELECT name FROM a)"""
)
def dag_dangling(spark, sf):
    return dag.dag_dangling(parse_activities(inputs.orchestrator_rows(spark, sf), only_enabled=False))


@registry.query(
    """SELECT c_custkey, c_mktsegment, CASE c_mktsegment WHEN 'BUILDING' THEN 'Lakehouse' WHEN 'MACHINERY' THEN 'Pipelines'
              WHEN 'HOUSEHOLD' THEN 'Notebook' END AS icon FROM customer"""
)
def map_lookup_join(spark, sf):
    icons = {"BUILDING": "Lakehouse", "MACHINERY": "Pipelines", "HOUSEHOLD": "Notebook"}
    people = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return joins.map_lookup_join(people, "c_mktsegment", icons, "icon")


@registry.query(
    """SELECT event_id, user_id, n FROM events JOIN (SELECT user_id, count(*) AS n FROM events GROUP BY user_id) USING (user_id)"""
)
def split_lookup(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id")
    per_user = events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return joins.split_lookup(events, per_user, ["user_id"])
