"""Sources and sinks. Sinks write to the shared scratch folder and are read back."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from layerwright import sinks, sources
from layerwright.operators.keys import add_dense_id, add_surrogate_id
from layerwright.operators.metadata import METADATA_TABLES
from layerwright.plans import star
from layerwright.session import scratch_path
from layerwright.sources.generated import days_between
from registered import Registry, inputs
from registered.inputs import scratch_database, table

registry = Registry()
RUN_TIME = datetime(2024, 3, 9, 23, 30, tzinfo=timezone.utc)

SEMICOLON_TEXT = """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS o_orderstatus,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_orderpriority FROM orders"""


@registry.query(
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
              l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS l_shipdate FROM lineitem"""
)
def scan_parquet(spark, sf):
    lines = sources.scan_parquet(spark, f"{sf}/lineitem.parquet")
    return lines.withColumn("l_shipdate", F.col("l_shipdate").cast("date"))


def _semicolon_text(spark, sf):
    path = scratch_path(spark, "orders-csv")
    orders = table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        "o_custkey",
        "nullif(o_orderstatus, 'P') AS o_orderstatus",
        "CAST(o_orderdate AS DATE) AS o_orderdate",
        "o_orderpriority",
    )
    orders.write.options(sep=";", header=True).csv(path)
    return path


@registry.query(SEMICOLON_TEXT)
def scan_csv(spark, sf):
    return sources.scan_csv(spark, _semicolon_text(spark, sf))


@registry.query(
    f"""SELECT 'csv' AS source_format, o_orderstatus, count(*) AS n_rows FROM ({SEMICOLON_TEXT}) GROUP BY ALL
        UNION ALL SELECT 'parquet', o_orderstatus, count(*) FROM orders GROUP BY ALL"""
)
def scan_by_format(spark, sf):
    paths = {"csv": _semicolon_text(spark, sf), "parquet": f"{sf}/orders.parquet"}
    counted = [
        sources.scan_by_format(spark, path, name)
        .groupBy("o_orderstatus")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(name).alias("source_format"), "o_orderstatus", "n_rows")
        for name, path in paths.items()
    ]
    return counted[0].unionByName(counted[1])


def _one_file_per_row(texts, key):
    """Write each text to a file of its own; there is one per nation or brand."""
    path = scratch_path(texts.sparkSession, "documents")
    texts.repartition(key).select("text").write.option("maxRecordsPerFile", 1).text(path)
    return path


@registry.query(
    """SELECT c_nationkey AS nation, count(*) AS n_customers, count(*) FILTER (WHERE c_acctbal < 0) AS n_negative,
              min(c_name) AS first_name FROM customer GROUP BY c_nationkey"""
)
def scan_text_document(spark, sf):
    """One JSON document of several lines per nation."""
    counted = table(spark, sf, "customer").groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("c_acctbal") < 0).alias("negative"), F.min("c_name").alias("first")
    )
    texts = counted.withColumn(
        "text",
        F.format_string('{"nation": %d,\n "customers": {"all": %d,\r\n "negative": %d},\n\n "first": "%s"}', *counted.columns),
    )
    schema = "nation int, customers struct<all: bigint, negative: bigint>, first string"
    documents = sources.scan_text_document(spark, _one_file_per_row(texts, "c_nationkey"), schema)
    return documents.select(
        "document.nation",
        F.col("document.customers.all").alias("n_customers"),
        F.col("document.customers.negative").alias("n_negative"),
        F.col("document.first").alias("first_name"),
    )


@registry.query(
    """SELECT 'Files/' || p_brand AS source, 'csv' AS format, p_brand || '_' || count(*) AS destination,
              '["p_name", "p_size"]' AS projected_columns FROM part GROUP BY p_brand
       UNION ALL SELECT DISTINCT 'Files/' || p_brand, 'parquet', p_brand || '_all', NULL FROM part"""
)
def scan_json_metadata(spark, sf):
    """One metadata file with a list of two entries per brand."""
    entries = """[{"source": "Files/%1$s", "format": "csv",
       "destination": "%1$s_%2$d", "projected_columns": ["p_name", "p_size"]},
      {"source": "Files/%1$s", "format": "parquet", "destination": "%1$s_all"}]"""
    brands = table(spark, sf, "part").groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))
    texts = brands.withColumn("text", F.format_string(entries, "p_brand", "n"))
    return sources.scan_json_metadata(spark, _one_file_per_row(texts, "p_brand"))


@registry.query("SELECT p_partkey, p_name, p_brand, p_size FROM part")
def scan_table(spark, sf):
    database = scratch_database(spark, "landing")
    table(spark, sf, "part").write.saveAsTable(f"{database}.parts")
    return sources.scan_table(spark, "parts", database).select("p_partkey", "p_name", "p_brand", "p_size")


@registry.query(
    """SELECT kind, count(*) AS n_events FROM events
         JOIN (VALUES ('click', 'action'), ('purchase', 'action'), ('view', 'passive'), ('error', 'fault')) k(event_type, kind)
        USING (event_type) GROUP BY kind"""
)
def inline_rows(spark, sf):
    kinds = [("click", "action"), ("purchase", "action"), ("view", "passive"), ("error", "fault")]
    listed = sources.inline_rows(spark, kinds, "event_type string, kind string")
    events = table(spark, sf, "events").join(listed, "event_type")
    return events.groupBy("kind").agg(F.count(F.lit(1)).alias("n_events"))


@registry.query(
    """SELECT o_orderstatus, CAST(unnest(generate_series(min(o_orderdate)::DATE::TIMESTAMP,
              max(o_orderdate)::DATE::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS Date FROM orders GROUP BY o_orderstatus"""
)
def generate_dates(spark, sf):
    bounds = table(spark, sf, "orders").groupBy("o_orderstatus").agg(
        F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last")
    )
    return days_between(bounds, F.col("first"), F.col("last"), ["o_orderstatus"])


@registry.query(
    "SELECT c_custkey, NULL ::VARCHAR AS c_name, c_mktsegment FROM customer"
)
def write_overwrite(spark, sf):
    database = scratch_database(spark, "base")
    people = table(spark, sf, "customer")
    sinks.write_overwrite(people, database, "people", ["c_custkey", "c_name"], add_id=False)
    sinks.write_overwrite(people, database, "people", ["c_custkey", "c_mktsegment"], add_id=False)
    return sources.scan_table(spark, "people", database)


@registry.query(
    f"""SELECT row_number() OVER (ORDER BY ProductId) AS DWID_Product, ProductId AS ProductsId, Manufacturer,
               ProductName, Price FROM ({inputs.PRODUCTS})"""
)
def load_dimension(spark, sf):
    database = scratch_database(spark, "curated")
    sinks.load_dimension(star.dim_product(inputs.products(spark, sf)), database, "Product")
    return sources.scan_table(spark, "Product", database)


@registry.query(inputs.FACT)
def load_fact(spark, sf):
    database = scratch_database(spark, "curated")
    sinks.load_fact(star.fact_sales(inputs.transactions(spark, sf)), database, "Transactions")
    return sources.scan_table(spark, "Transactions", database)


@registry.query("SELECT event_id, user_id, event_type, value FROM events")
def write_path_overwrite(spark, sf):
    path = scratch_path(spark, "events")
    events = table(spark, sf, "events")
    sinks.write_path_overwrite(events.select("event_id", "props"), path)
    sinks.write_path_overwrite(events.select("event_id", "user_id", "event_type", "value"), path)
    return sources.scan_parquet(spark, path)


@registry.query(
    """SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, length(text) AS n_chars, md5(text) AS text_md5,
              2024 AS year, 3 AS month, 9 AS day FROM documents"""
)
def write_landing_text(spark, sf):
    root = scratch_path(spark, "landing")
    documents = table(spark, sf, "documents").select("doc_id", "lang", "text")
    sinks.write_landing_text(documents, root, "archive", "documents", RUN_TIME)
    back = sources.read_landing_text(spark, f"{root}/archive/documents")
    return back.selectExpr(
        "doc_id", "lang", "CAST(length(text) AS BIGINT) AS n_chars", "md5(text) AS text_md5", "year", "month", "day"
    )


@registry.query(
    """SELECT conv_id, turn, role, 2024 AS year, 3 AS month, d.day FROM conversations
        CROSS JOIN (VALUES (9), (10)) d(day) WHERE (role = 'user') = (d.day = 9)"""
)
def read_landing_text(spark, sf):
    root = scratch_path(spark, "landing")
    talks = table(spark, sf, "conversations").select("conv_id", "turn", "role")
    sinks.write_landing_text(talks.where("role = 'user'"), root, "chat", "turns", RUN_TIME)
    next_day = RUN_TIME.replace(day=10)
    sinks.write_landing_text(talks.where("role <> 'user'"), root, "chat", "turns", next_day)
    schema = "conv_id bigint, turn bigint, role string, year int, month int, day int"
    return sources.read_landing_text(spark, f"{root}/chat/turns", schema)


@registry.query(
    """SELECT page_id, url, CAST(length(html) AS BIGINT) AS n_chars, md5(html) AS html_md5,
              2024 AS year, 3 AS month, 9 AS day FROM pages"""
)
def read_landing_text_split(spark, sf):
    root = scratch_path(spark, "landing")
    sinks.write_landing_text(table(spark, sf, "pages").select("page_id", "url", "html"), root, "archive", "pages", RUN_TIME)
    schema = "page_id bigint, url string, html string, year int, month int, day int"
    back = sources.read_landing_text(spark, f"{root}/archive/pages", schema, split_files=True)
    return back.selectExpr(
        "page_id", "url", "CAST(length(html) AS BIGINT) AS n_chars", "md5(html) AS html_md5", "year", "month", "day"
    )


@registry.query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def truncate_reload(spark, sf):
    database = scratch_database(spark, "landing")
    name = f"{database}.orders"
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    orders.where("o_orderstatus = 'O'").drop("o_orderstatus").write.saveAsTable(name)
    sinks.truncate_reload(orders.select("o_totalprice", "o_custkey", "o_orderkey"), name)
    return spark.table(name)


@registry.query(
    """SELECT CAST(p_partkey AS INTEGER) AS id, p_name AS notebook_name, p_type AS notebook_path, 90 AS cell_timeout,
              1 AS retry_count, 10 AS retry_interval, '{"useRootDefaultLakehouse": true}' AS arguments,
              'default' AS "group", TRUE AS is_enabled FROM part"""
)
def create_if_absent(spark, sf):
    database = scratch_database(spark, "metadata")
    name = f"{database}.notebook_orchestrator"
    for _ in range(2):
        sinks.create_if_absent(spark, name, METADATA_TABLES["notebook_orchestrator"])
    rows = table(spark, sf, "part").selectExpr("CAST(p_partkey AS INT) AS id", "p_name", "p_type")
    spark.sql(
        f"INSERT INTO {name} (id, notebook_name, notebook_path) SELECT id, p_name, p_type FROM {{rows}}", rows=rows
    )
    return spark.table(name).drop("dependencies")


@registry.query(
    """SELECT layer, n_nationkey, n_name, count(c_custkey) AS n_customers FROM nation
         LEFT JOIN customer ON c_nationkey = n_nationkey
        CROSS JOIN (VALUES ('landing'), ('base'), ('curated')) l(layer) GROUP BY ALL"""
)
def create_layers(spark, sf):
    location = scratch_path(spark, "layers")
    mark = location.rsplit("-", 1)[1][:12]
    layers = {layer: f"{layer}_{mark}" for layer in ("landing", "base", "curated")}
    for _ in range(2):
        sinks.create_layers(spark, layers.values(), location)
    nations = table(spark, sf, "nation").join(
        table(spark, sf, "customer"), F.expr("c_nationkey = n_nationkey"), "left"
    )
    counted = nations.groupBy("n_nationkey", "n_name").agg(F.count("c_custkey").alias("n_customers"))
    parts = []
    for layer, database in layers.items():
        sinks.write_overwrite(counted, database, "nations", add_id=False)
        parts.append(spark.table(f"{database}.nations").withColumn("layer", F.lit(layer)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@registry.query("SELECT lang, count(*) AS n_documents, CAST(sum(n_chars) AS BIGINT) AS n_chars FROM documents GROUP BY lang")
def temp_view(spark, sf):
    sinks.temp_view(table(spark, sf, "documents"), "layerwright_documents")
    return spark.sql(
        "SELECT lang, count(*) AS n_documents, sum(n_chars) AS n_chars FROM layerwright_documents GROUP BY lang"
    )


@registry.query(
    "SELECT count(*) AS n_rows, count(*) AS n_ids, TRUE AS all_positive, TRUE AS id_is_first FROM lineitem",
    name="add_surrogate_id",
)
def surrogate_id(spark, sf):
    keyed = add_surrogate_id(table(spark, sf, "lineitem"))
    return keyed.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("Id").alias("n_ids"),
        (F.min("Id") >= 1).alias("all_positive"),
        F.lit(keyed.columns[0] == "Id").alias("id_is_first"),
    )


@registry.query(
    "SELECT row_number() OVER (ORDER BY o_orderkey) AS Id, o_orderkey, o_custkey, o_orderstatus FROM orders",
    name="add_dense_id",
)
def dense_id(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return add_dense_id(orders, ["o_orderkey"])
