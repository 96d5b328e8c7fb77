"""Measures, rollups, pivots."""

from __future__ import annotations

from pyspark.sql import functions as F

from layerwright.operators import measures
from layerwright.plans.docs import IDENTITY_MEASURES
from registered import Registry, inputs
from registered.inputs import table

registry = Registry()


@registry.query(
    f"""SELECT count(*) AS n_rows, nullif(count(*) FILTER (WHERE SupportUserIdentity = 'Yes'), 0) AS supports_user,
               nullif(count(*) FILTER (WHERE SupportSpnAndMi = 'Yes'), 0) AS supports_service,
               nullif(count(*) FILTER (WHERE Service = 'Yes'), 0) AS never FROM ({inputs.DOCS})"""
)
def count_rows_filtered(spark, sf):
    marks = {"supports_user": "SupportUserIdentity", "supports_service": "SupportSpnAndMi", "never": "Service"}
    return measures.count_rows_filtered(inputs.docs(spark, sf), marks)


@registry.query(
    f"""WITH docs AS ({inputs.DOCS}), n AS (SELECT count(*) AS n_rows FROM docs)
        SELECT 1 AS selection, (SELECT count(*) FROM docs WHERE SupportUserIdentity = 'Yes') AS measure, n_rows FROM n
        UNION ALL SELECT 2, (SELECT count(*) FROM docs WHERE SupportSpnAndMi = 'Yes'), n_rows FROM n
        UNION ALL SELECT NULL, n_rows, n_rows FROM n"""
)
def measure_by_selection(spark, sf):
    return measures.measure_by_selection(inputs.docs(spark, sf), IDENTITY_MEASURES)


@registry.query(
    """SELECT c_nationkey, c_mktsegment,
              CASE WHEN yes = n THEN '✅' WHEN yes = 0 THEN '❌' ELSE '🟡' END AS flag
         FROM (SELECT c_nationkey, c_mktsegment, count(*) AS n,
                      count(*) FILTER (WHERE c_acctbal >= 500) AS yes FROM customer GROUP BY ALL)"""
)
def coverage_flag(spark, sf):
    marked = table(spark, sf, "customer").selectExpr(
        "c_nationkey", "c_mktsegment", "IF(c_acctbal >= 500, 'Yes', 'No') AS supported"
    )
    counted = marked.groupBy("c_nationkey", "c_mktsegment").agg(
        measures.yes_count("supported").alias("m"), measures.row_count().alias("n")
    )
    flag = measures.coverage_flag(F.col("m"), F.col("n")).alias("flag")
    return counted.select("c_nationkey", "c_mktsegment", flag)


@registry.query(f"SELECT Service, API, min(ArticleUrl) AS first_url FROM ({inputs.DOCS}) GROUP BY ALL")
def min_per_group(spark, sf):
    return measures.min_per_group(inputs.docs(spark, sf), ["Service", "API"], "ArticleUrl", "first_url")


@registry.query(
    f"""SELECT Service, API, Title, count(*) AS n_rows, CAST(grouping_id(Service, API, Title) AS INTEGER) AS level_mask
          FROM ({inputs.DOCS}) GROUP BY ROLLUP (Service, API, Title)"""
)
def hierarchy_rollup(spark, sf):
    return measures.hierarchy_rollup(inputs.docs(spark, sf), ["Service", "API", "Title"])


@registry.query(
    """SELECT user_id, arg_max(props, event_id) FILTER (WHERE event_type = 'click') AS click_props,
              arg_max(props, event_id) FILTER (WHERE event_type = 'view') AS view_props FROM events GROUP BY user_id"""
)
def kv_rows_to_map(spark, sf):
    names = {"click_props": "click", "view_props": "view"}
    return measures.kv_rows_to_columns(
        table(spark, sf, "events"), ["user_id"], "event_type", "props", "event_id", names
    )


@registry.query(
    f"""SELECT layer, item_type, item_name, max(id) FILTER (WHERE environment = 'dev') AS dev,
               max(id) FILTER (WHERE environment = 'tst') AS tst, max(id) FILTER (WHERE environment = 'prd') AS prd
          FROM ({inputs.ENVIRONMENT_ITEMS}) GROUP BY ALL"""
)
def pivot_environments(spark, sf):
    return measures.pivot_environments(
        inputs.environment_items(spark, sf),
        ["layer", "item_type", "item_name"],
        "environment",
        ["dev", "tst", "prd"],
        "id",
        "position",
    )
