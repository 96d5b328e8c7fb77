"""Projections, filters, sorts, unions, null handling."""

from __future__ import annotations

from pyspark.sql import functions as F

from layerwright.functions.dates import date_key, day_parts
from layerwright.functions.rules import first_match
from layerwright.operators import clean, measures, ordering, predicates, projection, setops
from layerwright.operators.projection import ModelColumn
from registered import Registry, inputs
from registered.inputs import table

registry = Registry()


@registry.query("SELECT p_brand, p_partkey, p_size FROM part")
def project_columns(spark, sf):
    return projection.project_columns(table(spark, sf, "part"), ["p_brand", "p_partkey", "p_size"])


@registry.query(inputs.PRODUCTS)
def project_alias(spark, sf):
    names = {"p_partkey": "ProductId", "p_brand": "Manufacturer", "p_name": "ProductName", "p_retailprice": "Price"}
    return projection.project_alias(table(spark, sf, "part"), names)


@registry.query(
    """SELECT s_name AS "Supplier Name", CAST(s_nationkey AS VARCHAR) AS Nation FROM supplier"""
)
def model_view(spark, sf):
    columns = [
        ModelColumn("SupplierNo", "s_suppkey", "integer", hidden=True),
        ModelColumn("Supplier Name", "s_name", sort_by="SupplierNo"),
        ModelColumn("Nation", "s_nationkey"),
    ]
    return projection.model_view(table(spark, sf, "supplier"), columns)


@registry.query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def drop_columns(spark, sf):
    return projection.drop_columns(table(spark, sf, "orders"), "o_orderdate", "o_orderpriority")


@registry.query(
    """SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS DateId,
              CAST(year(o_orderdate) AS INTEGER) AS Year, CAST(month(o_orderdate) AS INTEGER) AS Month,
              CAST(day(o_orderdate) AS INTEGER) AS Day FROM orders"""
)
def derive_column(spark, sf):
    day = F.col("o_orderdate")
    derived = projection.derive_columns(table(spark, sf, "orders"), {"DateId": date_key(day), **day_parts(day)})
    return derived.select("o_orderkey", "DateId", "Year", "Month", "Day")


@registry.query(
    """SELECT event_id, event_type, 'one' AS asked FROM events WHERE event_type = 'click'
       UNION ALL SELECT event_id, event_type, 'all' FROM events"""
)
def filter_group(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type")
    one = predicates.filter_group(events, "click", "event_type").withColumn("asked", F.lit("one"))
    every = predicates.filter_group(events, None, "event_type").withColumn("asked", F.lit("all"))
    return one.unionByName(every)


@registry.query(
    """SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey
        WHERE c_acctbal >= 0 AND n_regionkey <> 3"""
)
def filter_enabled(spark, sf):
    people = table(spark, sf, "customer").selectExpr("c_custkey", "c_nationkey", "c_acctbal >= 0 AS customer_enabled")
    nations = table(spark, sf, "nation").selectExpr("n_nationkey", "n_name", "n_regionkey <> 3 AS nation_enabled")
    joined = people.join(nations, F.expr("c_nationkey = n_nationkey"))
    return predicates.filter_enabled(joined, "customer_enabled", "nation_enabled").select("c_custkey", "n_name")


@registry.query(
    """SELECT doc_id, source IN ('src0', 'src7') AS by_list, starts_with(source, 'src1') AS by_prefix,
              source IN ('src0', 'src7') OR starts_with(source, 'src1') AS by_both, TRUE AS by_none FROM documents"""
)
def filter_list_or_prefix(spark, sf):
    source = F.col("source")
    return table(spark, sf, "documents").select(
        "doc_id",
        predicates.in_list_or_prefix(source, "src0,src7", "").alias("by_list"),
        predicates.in_list_or_prefix(source, None, "src1").alias("by_prefix"),
        predicates.in_list_or_prefix(source, "src0,src7", "src1").alias("by_both"),
        predicates.in_list_or_prefix(source, "", "").alias("by_none"),
    )


@registry.query(
    """SELECT page_id, url FROM pages WHERE lower(url) LIKE '%example.%'
          AND (lower(url) LIKE '%/en/%' OR lower(url) LIKE '%page=%' OR lower(url) LIKE '%#top%')"""
)
def filter_must_and_any(spark, sf):
    wanted = predicates.must_and_any(F.col("url"), "EXAMPLE.", ["/En/", "PAGE=", "#top"])
    return table(spark, sf, "pages").where(wanted).select("page_id", "url")


@registry.query(
    """SELECT c_custkey, c_name FROM customer
        WHERE regexp_replace(trim('  ' || replace(c_name, '#', '   ') || ' '), '\\s+', ' ', 'g') = 'Customer 000000007'
        ORDER BY c_custkey LIMIT 1"""
)
def lookup_by_name(spark, sf):
    spaced = table(spark, sf, "customer").withColumn("spaced", F.expr("concat('  ', replace(c_name, '#', '   '), ' ')"))
    return predicates.lookup_by_name(spaced, "spaced", "Customer 000000007", "c_custkey").select("c_custkey", "c_name")


@registry.query("SELECT DISTINCT p_type FROM part")
def slicer_values(spark, sf):
    return predicates.slicer_values(table(spark, sf, "part"), "p_type")


@registry.query(
    f"""SELECT Service, API, Title, nullif(count(*) FILTER (WHERE SupportSpnAndMi = 'Yes'), 0) AS measure
          FROM ({inputs.DOCS}) GROUP BY ALL HAVING measure > 0"""
)
def measure_filter(spark, sf):
    supported = measures.yes_count("SupportSpnAndMi")
    return measures.measure_filter(inputs.docs(spark, sf), ["Service", "API", "Title"], supported, "measure")


@registry.query(f"SELECT Service, API, Title FROM ({inputs.DOCS}) ORDER BY Service")
def order_by_column(spark, sf):
    return ordering.order_rows(inputs.docs(spark, sf).select("Service", "API", "Title"), "Service")


@registry.query("SELECT p_brand, p_type, count(*) AS n_parts FROM part GROUP BY ALL ORDER BY n_parts")
def order_by_measure(spark, sf):
    return measures.order_by_measure(table(spark, sf, "part"), ["p_brand", "p_type"], F.count(F.lit(1)), "n_parts")


@registry.query("SELECT DISTINCT n_name FROM nation JOIN customer ON c_nationkey = n_nationkey")
def sort_by_other_column(spark, sf):
    people = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.expr("c_nationkey = n_nationkey"))
    return ordering.sort_by_other_column(people, "n_name", "n_nationkey")


@registry.query(
    """SELECT o_orderkey, o_orderpriority, CASE WHEN contains(o_orderpriority, 'URGENT') THEN 1
              WHEN contains(o_orderpriority, 'HIGH') THEN 2 WHEN contains(o_orderpriority, 'MEDIUM') THEN 3
              WHEN contains(o_orderpriority, 'LOW') THEN 4 ELSE 5 END AS rank FROM orders"""
)
def order_by_rank_rule(spark, sf):
    ranks = {"URGENT": 1, "HIGH": 2, "MEDIUM": 3, "LOW": 4}
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    ordered = ordering.order_by_rank_rule(orders, "o_orderpriority", ranks, 5, "o_orderkey")
    return ordered.withColumn("rank", first_match(F.col("o_orderpriority"), ranks, ignore_case=False, default=5))


@registry.query("SELECT event_id, user_id FROM events WHERE event_type = 'error' ORDER BY ts, event_id LIMIT 1")
def first_row(spark, sf):
    errors = table(spark, sf, "events").where("event_type = 'error'")
    return ordering.first_row(errors, "ts", "event_id").select("event_id", "user_id")


@registry.query(
    """SELECT c_nationkey AS nation, 'customer' AS kind FROM customer UNION SELECT s_nationkey, 'supplier' FROM supplier
       UNION SELECT n_nationkey, 'customer' FROM nation"""
)
def union_distinct(spark, sf):
    buyers = table(spark, sf, "customer").selectExpr("c_nationkey AS nation", "'customer' AS kind")
    sellers = table(spark, sf, "supplier").selectExpr("s_nationkey AS nation", "'supplier' AS kind")
    nations = table(spark, sf, "nation").selectExpr("n_nationkey AS nation", "'customer' AS kind")
    return setops.union_distinct(buyers, sellers, nations)


@registry.query(
    "SELECT n_name AS title, n_regionkey AS parent FROM nation UNION ALL SELECT c_name, c_nationkey FROM customer"
)
def union_all_append(spark, sf):
    nations = table(spark, sf, "nation").selectExpr("n_name AS title", "n_regionkey AS parent")
    people = table(spark, sf, "customer").selectExpr("c_nationkey AS parent", "c_name AS title")
    return setops.union_all_append(nations, people)


def _with_gaps(spark, sf):
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        "nullif(o_custkey, 5) AS o_custkey",
        "IF(o_orderstatus = 'O', NULL, IF(o_orderstatus = 'P', double('NaN'), o_totalprice)) AS o_totalprice",
        "CAST(IF(o_orderstatus = 'F', NULL, 1.25) AS DECIMAL(9,2)) AS rate",
        "IF(o_orderpriority = '5-LOW', NULL, o_orderpriority) AS o_orderpriority",
        "IF(o_orderstatus = 'F', NULL, o_orderstatus = 'O') AS is_open",
        "IF(o_orderstatus = 'P', NULL, CAST(o_orderdate AS DATE)) AS o_orderdate",
    )


_GAPS = """SELECT o_orderkey, nullif(o_custkey, 5) AS o_custkey,
       CASE o_orderstatus WHEN 'O' THEN NULL WHEN 'P' THEN 'NaN'::DOUBLE ELSE o_totalprice END AS o_totalprice,
       CAST(CASE WHEN o_orderstatus <> 'F' THEN 1.25 END AS DECIMAL(9,2)) AS rate,
       CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS o_orderpriority,
       CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus = 'O' END AS is_open,
       CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS o_orderdate FROM orders"""


@registry.query(
    f"""SELECT o_orderkey, coalesce(o_custkey, 0) AS o_custkey,
               CASE WHEN o_totalprice IS NULL OR isnan(o_totalprice) THEN 0 ELSE o_totalprice END AS o_totalprice,
               CAST(coalesce(rate, 0) AS DOUBLE) AS rate, o_orderpriority, is_open, o_orderdate FROM ({_GAPS})"""
)
def fill_numeric_zero(spark, sf):
    return clean.fill_numeric_zero(_with_gaps(spark, sf)).withColumn("rate", F.col("rate").cast("double"))


@registry.query(
    f"""SELECT o_orderkey, o_custkey, CAST(rate AS DOUBLE) AS rate, coalesce(o_orderpriority, 'N/A') AS o_orderpriority,
               is_open, o_orderdate FROM ({_GAPS})"""
)
def fill_string_na(spark, sf):
    gaps = _with_gaps(spark, sf).drop("o_totalprice")
    return clean.fill_string_na(gaps).withColumn("rate", F.col("rate").cast("double"))


@registry.query(
    """SELECT p_partkey, coalesce(nullif(p_size, 10), 90) AS cell_timeout, coalesce(nullif(p_type, 'ECONOMY'), 'default') AS "group",
              TRUE AS is_enabled FROM part"""
)
def apply_defaults(spark, sf):
    rows = table(spark, sf, "part").selectExpr(
        "p_partkey", "nullif(p_size, 10) AS cell_timeout", "nullif(p_type, 'ECONOMY') AS `group`"
    )
    return clean.apply_defaults(rows, {"cell_timeout": 90, "group": "default", "is_enabled": True})


@registry.query(
    """SELECT DISTINCT l_orderkey, l_partkey, nullif(l_linenumber, 3) AS l_linenumber, l_returnflag FROM lineitem"""
)
def dedupe_rows(spark, sf):
    lines = table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_partkey", "nullif(l_linenumber, 3) AS l_linenumber", "l_returnflag"
    )
    return clean.dedupe_rows(lines.unionByName(lines))


@registry.query("SELECT user_id, event_type FROM events UNION SELECT user_id, 'any' FROM events")
def distinct_rows(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_type")
    return setops.union_distinct(events, events.withColumn("event_type", F.lit("any")))
