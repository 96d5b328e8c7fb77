"""The composite plans, end to end."""

from __future__ import annotations

from pyspark.sql import functions as F

from layerwright.functions import text
from layerwright.operators.clean import cleanse
from layerwright.operators.metadata import dag_from_metadata
from layerwright.plans import curated, docs, icons, ingest, landing, star
from layerwright.session import scratch_path
from layerwright.sinks.tables import write_overwrite
from layerwright.sources.files import read_landing_text
from layerwright.sources.generated import inline_rows
from registered import Registry, inputs
from registered.inputs import scratch_database, table
from registered.nested import ANCHOR, IDENTITY_FACTS, IDENTITY_NAMES, pages_with_identities
from registered.tables import RUN_TIME

registry = Registry()


def _land(spark, sf):
    """Customers and transactions as packed semicolon text, products as Parquet, all with copies of every row; metadata for them."""
    root = scratch_path(spark, "files")
    people = inputs.customers(spark, sf).withColumn("LastName", F.expr("nullif(LastName, '000000007')"))
    people.unionByName(people).write.options(sep=";", header=True).csv(f"{root}/Sales/Customers", compression="gzip")
    goods = inputs.products(spark, sf).withColumn("Price", F.expr("nullif(Price, 900.0)"))
    goods.unionByName(goods).write.parquet(f"{root}/Sales/Products")
    sales = inputs.transactions(spark, sf).withColumn("TransactionDate", F.col("TransactionDate").cast("date"))
    sales.unionByName(sales).write.options(sep=";", header=True).csv(f"{root}/Sales/Transactions", compression="gzip")
    rows = [
        ("Sales/Customers", "csv", "sales_customers", '["CustomerID", "FirstName", "LastName"]'),
        ("Sales/Products", "parquet", "sales_products", "[]"),
        ("Sales/Transactions", "csv", "sales_transactions", None),
    ]
    return root, inline_rows(spark, rows, "source string, format string, destination string, projected_columns string")


LANDED_CUSTOMERS = f"""SELECT CAST(CustomerID AS VARCHAR) AS CustomerID, FirstName,
       CASE WHEN LastName = '000000007' THEN 'N/A' ELSE LastName END AS LastName FROM ({inputs.CUSTOMERS})"""
LANDED_PRODUCTS = f"""SELECT ProductId, Manufacturer, ProductName, CASE WHEN Price = 900.0 THEN 0.0 ELSE Price END AS Price
       FROM ({inputs.PRODUCTS})"""


@registry.query(
    f"""SELECT 'sales_customers' AS destination, CustomerID AS key, FirstName || '/' || LastName AS content FROM ({LANDED_CUSTOMERS})
        UNION ALL SELECT 'sales_products', CAST(ProductId AS VARCHAR),
               Manufacturer || '/' || ProductName || '/' || CAST(Price AS VARCHAR) FROM ({LANDED_PRODUCTS})
        UNION ALL SELECT 'sales_transactions', CAST(TransactionID AS VARCHAR), CAST(CAST(TransactionDate AS DATE) AS VARCHAR)
               || '/' || CustomerId || '/' || ProductID || '/' || Quantity || '/' || TotalPrice
          FROM (SELECT DISTINCT * FROM ({inputs.TRANSACTIONS}))
        UNION ALL SELECT 'dim_date', CAST(strftime(d, '%Y%m%d') AS VARCHAR), '2022-2023'
          FROM (SELECT unnest(generate_series(TIMESTAMP '2022-01-01', TIMESTAMP '2023-12-31', INTERVAL 1 DAY)) AS d)"""
)
def landing_to_base(spark, sf):
    base = scratch_database(spark, "base")
    root, metadata = _land(spark, sf)
    landing.landing_to_base(metadata, base, root, ("2022-01-01", "2023-12-31"))
    contents = {
        "sales_customers": ("CustomerID", "concat_ws('/', FirstName, LastName)"),
        "sales_products": ("CAST(ProductId AS STRING)", "concat_ws('/', Manufacturer, ProductName, Price)"),
        "sales_transactions": (
            "TransactionID",
            "concat_ws('/', TransactionDate, CustomerId, ProductID, Quantity, TotalPrice)",
        ),
        "dim_date": ("CAST(DateId AS STRING)", "IF(Year IN (2022, 2023) AND Id > 0, '2022-2023', 'other')"),
    }
    tables = [
        spark.table(f"{base}.{name}").selectExpr(f"'{name}' AS destination", f"{key} AS key", f"{content} AS content")
        for name, (key, content) in contents.items()
    ]
    return tables[0].unionByName(tables[1]).unionByName(tables[2]).unionByName(tables[3])


@registry.query(inputs.CALENDAR)
def base_dim_date(spark, sf):
    base = scratch_database(spark, "base")
    write_overwrite(star.calendar_of(table(spark, sf, "orders"), "o_orderdate"), base, "dim_date")
    written = spark.table(f"{base}.dim_date")
    assert written.columns[0] == "Id"
    return written.drop("Id")


@registry.query(
    f"""SELECT row_number() OVER (ORDER BY CustomerID) AS DWID_Customer, *, FirstName || ' ' || LastName AS FullName
          FROM ({inputs.CUSTOMERS})"""
)
def dim_customer(spark, sf):
    return star.dim_customer(inputs.customers(spark, sf))


@registry.query(
    f"""SELECT row_number() OVER (ORDER BY ProductId) AS DWID_Product, ProductId AS ProductsId, Manufacturer, ProductName, Price
          FROM ({inputs.PRODUCTS})"""
)
def dim_product(spark, sf):
    return star.dim_product(inputs.products(spark, sf))


@registry.query(f"SELECT DateId AS DWID_Date, Date, Year, Month, Day FROM ({inputs.CALENDAR})")
def dim_date(spark, sf):
    return star.dim_date(star.calendar_of(table(spark, sf, "orders"), "o_orderdate"))


@registry.query(inputs.FACT)
def fact_sales(spark, sf):
    return star.fact_sales(inputs.transactions(spark, sf))


@registry.query(
    f"""WITH sold AS (SELECT DISTINCT * FROM ({inputs.TRANSACTIONS}))
        SELECT CAST(year(TransactionDate) AS INTEGER) AS Date_Year, CAST(month(TransactionDate) AS INTEGER) AS Date_Month,
               count(*) AS n_sales, CAST(sum(CAST(trunc(Quantity) AS BIGINT)) AS BIGINT) AS quantity,
               CAST(grouping_id(year(TransactionDate), month(TransactionDate)) AS INTEGER) AS level_mask
          FROM sold GROUP BY ROLLUP (year(TransactionDate), month(TransactionDate))"""
)
def sales_rollup(spark, sf):
    """Transactions, cleansed, as a fact, with its calendar, counted by year and month."""
    fact = star.fact_sales(cleanse(inputs.transactions(spark, sf)))
    dates = star.dim_date(star.calendar_of(table(spark, sf, "orders"), "o_orderdate"))
    return star.sales_rollup(fact, dates)


@registry.query(
    f"""WITH sold AS (SELECT DISTINCT * FROM ({inputs.TRANSACTIONS}))
        SELECT Customer_FullName, Date_Year, n_sales, quantity, level_mask FROM (
        SELECT FirstName || ' ' || LastName AS Customer_FullName, CAST(year(TransactionDate) AS INTEGER) AS Date_Year,
               count(*) AS n_sales, CAST(sum(CAST(trunc(Quantity) AS BIGINT)) AS BIGINT) AS quantity,
               CAST(grouping_id(FirstName || ' ' || LastName, year(TransactionDate)) AS INTEGER) AS level_mask
          FROM sold JOIN ({inputs.CUSTOMERS}) c ON c.CustomerID = sold.CustomerId
         GROUP BY ROLLUP (FirstName || ' ' || LastName, year(TransactionDate)))"""
)
def sales_rollup_by_customer(spark, sf):
    fact = star.fact_sales(cleanse(inputs.transactions(spark, sf)))
    dates = star.dim_date(star.calendar_of(table(spark, sf, "orders"), "o_orderdate"))
    customers = star.dim_customer(inputs.customers(spark, sf).withColumn("Id", F.col("CustomerID") + 1))
    return star.sales_rollup(fact, dates, customers, ["Customer_FullName", "Date_Year"])


@registry.query(
    f"""SELECT 'Customer' AS loaded, CustomerID AS key, FirstName || ' ' || LastName AS content, count(*) AS n_rows
          FROM ({LANDED_CUSTOMERS}) GROUP BY ALL
        UNION ALL SELECT 'Product', CAST(ProductId AS VARCHAR), Manufacturer || '/' || ProductName, 1 FROM ({LANDED_PRODUCTS})
        UNION ALL SELECT 'Date', CAST(strftime(d, '%Y%m%d') AS VARCHAR), CAST(day(d) AS VARCHAR), 1
          FROM (SELECT unnest(generate_series(TIMESTAMP '2022-01-01', TIMESTAMP '2023-12-31', INTERVAL 1 DAY)) AS d)
        UNION ALL SELECT 'Transactions', CAST(TransactionID AS VARCHAR), DWID_Date || '/' || DWID_Customer || '/' || DWID_Product
               || '/' || M_Quantity, count(*) FROM (SELECT DISTINCT * FROM ({inputs.FACT})) GROUP BY ALL"""
)
def base_to_curated(spark, sf):
    base, layer = scratch_database(spark, "base"), scratch_database(spark, "curated")
    root, metadata = _land(spark, sf)
    landing.landing_to_base(metadata, base, root, ("2022-01-01", "2023-12-31"))
    waits = '["load_dimension_customer", "load_dimension_product", "load_dimension_date"]'
    rows = [(n, n, 300, 1, 10, None, None, "default", True) for n in ("load_dimension_customer", "load_dimension_product")]
    rows += [("load_dimension_date", "d", 300, 1, 10, None, None, "default", True)]
    rows += [("load_fact_sales", "f", 600, 1, 10, None, waits, "default", True)]
    activities = dag_from_metadata(
        inline_rows(
            spark,
            rows,
            "notebook_name string, notebook_path string, cell_timeout int, retry_count int, retry_interval int,"
            " arguments string, dependencies string, `group` string, is_enabled boolean",
        )
    )
    order = curated.base_to_curated(activities, curated.star_loads(spark, base, layer))
    assert order[-1] == "load_fact_sales"
    contents = {
        "Customer": ("CustomerID", "FullName"),
        "Product": ("CAST(ProductsId AS STRING)", "concat_ws('/', Manufacturer, ProductName)"),
        "Date": ("CAST(DWID_Date AS STRING)", "CAST(Day AS STRING)"),
        "Transactions": ("TransactionID", "concat_ws('/', DWID_Date, DWID_Customer, DWID_Product, M_Quantity)"),
    }
    tables = [
        spark.table(f"{layer}.{name}").selectExpr(f"'{name}' AS loaded", f"{key} AS key", f"{content} AS content")
        for name, (key, content) in contents.items()
    ]
    union = tables[0].unionByName(tables[1]).unionByName(tables[2]).unionByName(tables[3])
    return union.groupBy("loaded", "key", "content").agg(F.count(F.lit(1)).alias("n_rows"))


@registry.query(
    """SELECT 'supplier' AS copied, CAST(s_suppkey AS VARCHAR) AS key, s_name AS name, 2024 AS year, 3 AS month, 9 AS day FROM supplier
       UNION ALL SELECT 'customer', CAST(c_custkey AS VARCHAR), c_name, 2024, 3, 9 FROM customer"""
)
def ingest_all(spark, sf):
    """The ingest with the driver's tables in place of a database; one of three objects is switched off."""
    connections = inline_rows(
        spark, [(1, "c-1", "crm", "sql", True), (2, "c-2", "erp", "sql", True)],
        "id int, connection_id string, connection_name string, connection_type string, is_enabled boolean",
    )
    objects = inline_rows(
        spark,
        [(1, 1, "dbo", "supplier", True), (2, 1, "dbo", "customer", True), (3, 1, "dbo", "part", False), (4, 2, "dbo", "part", True)],
        "id int, connection_id int, schema_name string, table_name string, is_enabled boolean",
    )
    columns = {"supplier": ["s_suppkey AS key", "s_name AS name"], "customer": ["c_custkey AS key", "c_name AS name"]}
    root = scratch_path(spark, "landing")
    folders = ingest.ingest_all(
        connections, objects, "crm", lambda _, name: table(spark, sf, name).selectExpr(*columns[name]), root, RUN_TIME
    )
    assert len(folders) == 2
    copies = [read_landing_text(spark, f"{root}/crm/{name}").withColumn("copied", F.lit(name)) for name in columns]
    return copies[0].unionByName(copies[1])


@registry.query(
    """WITH picked AS (SELECT page_id, lower(url) AS name, CASE WHEN contains(lower(url), '.org') THEN 'Notebook'
              WHEN contains(lower(url), '/en/') THEN 'Lakehouse' WHEN contains(lower(url), 'http:') THEN 'Missing' END AS icon_title FROM pages)
       SELECT page_id, icon_title, CASE WHEN icon_title IN ('Notebook', 'Lakehouse') THEN base64(encode('<svg fill="'
              || CASE WHEN contains(name, 'm.') THEN '#1E90FF' WHEN contains(name, '#top') THEN '#FFA500' ELSE 'none' END
              || '" id="' || icon_title || '"/>')) END AS icon FROM picked"""
)
def assign_icons(spark, sf):
    entries = table(spark, sf, "part").selectExpr("explode(array('Notebook', 'Lakehouse', p_brand)) AS title").distinct()
    payload = text.to_base64(F.concat(F.lit('<svg fill="none" id="'), "title", F.lit('"/>')))
    rules = {".ORG": "Notebook", "/en/": "Lakehouse", "http:": "Missing"}
    colours = {"m.": "#1E90FF", "#top": "#FFA500"}
    named = icons.assign_icons(table(spark, sf, "pages"), "url", rules, entries.withColumn("payload", payload), colours)
    return named.select("page_id", "icon_title", "icon")


def _toc(spark, sf):
    """Regions, nations and pages as a table of contents: a page belongs to a nation by the length of its address."""
    leaves = table(spark, sf, "pages").selectExpr(
        "concat('p', page_id) AS id",
        "concat('n', length(url) % 25) AS parent_id",
        "page_id AS ord",
        "concat('Page ', page_id) AS title",
        "concat('page/', page_id) AS href",
    )
    return inputs.upper_nodes(spark, sf).unionByName(leaves)


DOCS_TABLE = f"""SELECT 'Page ' || page_id AS Title, 'https://docs.example/page/' || page_id AS ArticleUrl,
       SupportUserIdentity, SupportSpnAndMi, r_name AS Service, n_name AS API
  FROM ({IDENTITY_FACTS}) JOIN nation ON n_nationkey = length(url) % 25 JOIN region ON r_regionkey = n_regionkey
 WHERE n_nationkey <> 7
 UNION ALL SELECT n_name, 'https://docs.example/nation/' || n_nationkey, 'N/A', 'N/A', r_name, NULL
  FROM nation JOIN region ON r_regionkey = n_regionkey WHERE n_regionkey <> 0 AND n_nationkey <> 7"""


def _docs_table(spark, sf):
    pages = pages_with_identities(spark, sf).select(
        F.concat(F.lit("https://docs.example/page/"), "page_id").alias("url"), "html"
    )
    return docs.docs_table(_toc(spark, sf), pages, "https://docs.example/", ANCHOR, IDENTITY_NAMES)


@registry.query(DOCS_TABLE)
def docs_table(spark, sf):
    return _docs_table(spark, sf)


@registry.query(
    f"SELECT Service, API, Title, ArticleUrl FROM ({inputs.DOCS}) WHERE SupportSpnAndMi = 'Yes' ORDER BY Service"
)
def docs_report(spark, sf):
    return docs.report_articles(inputs.docs(spark, sf), selected=2)


@registry.query(
    f"""WITH docs AS ({inputs.DOCS}), n AS (SELECT count(*) AS n, count(*) FILTER (WHERE SupportUserIdentity = 'Yes') AS u,
               count(*) FILTER (WHERE SupportSpnAndMi = 'Yes') AS s FROM docs)
        SELECT 'User' AS Identity, '' AS ArticleUrl, CASE WHEN u = n THEN '✅' WHEN u = 0 THEN '❌' ELSE '🟡' END AS Supported FROM n
        UNION ALL SELECT 'Service principal and Managed identities',
               'https://learn.microsoft.com/en-us/entra/identity-platform/app-objects-and-service-principals#service-principal-object',
               CASE WHEN s = n THEN '✅' WHEN s = 0 THEN '❌' ELSE '🟡' END FROM n"""
)
def docs_report_identities(spark, sf):
    return docs.report_identities(inputs.docs(spark, sf), docs.supported_identities(spark))
