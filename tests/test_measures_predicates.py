import pytest
from pyspark.sql import functions as F

from layerwright.functions import dates, numbers
from layerwright.operators import joins, measures, predicates, projection
from layerwright.plans import docs, star

DOCS_SCHEMA = "Title string, ArticleUrl string, SupportUserIdentity string, SupportSpnAndMi string, Service string, API string"


def _docs(spark, marks):
    rows = [(f"t{i}", f"u{i}", user, service, "S", "A") for i, (user, service) in enumerate(marks)]
    return spark.createDataFrame(rows, DOCS_SCHEMA)


@pytest.mark.parametrize(
    ("marks", "flags"),
    [
        ([("Yes", "No"), ("Yes", "Yes")], ["✅", "🟡"]),
        ([("N/A", "Yes"), (None, "No")], ["❌", "🟡"]),
        ([], [None, None]),
    ],
)
def test_report_identities(spark, marks, flags):
    out = docs.report_identities(_docs(spark, marks), docs.supported_identities(spark)).collect()
    found = {r.Identity: r.Supported for r in out}
    assert [found["User"], found["Service principal and Managed identities"]] == flags
    assert [r.Supported for r in out] == sorted(found.values(), key=lambda f: (f is not None, f))


def test_report_articles(spark):
    table = _docs(spark, [("Yes", "No"), ("No", "Yes"), ("N/A", "N/A")])
    assert [r.Title for r in docs.report_articles(table).orderBy("Title").collect()] == ["t0", "t1", "t2"]
    assert [r.Title for r in docs.report_articles(table, 1).collect()] == ["t0"]
    assert [r.Title for r in docs.report_articles(table, 2).collect()] == ["t1"]


def test_identity_model_is_sorted_and_hides_the_number(spark):
    view = projection.model_view(docs.supported_identities(spark), docs.IDENTITY_MODEL)
    assert view.columns == ["Identity", "Identity Description", "Identity Support Article Url"]
    assert [r.Identity for r in view.collect()] == ["User", "Service principal and Managed identities"]
    assert projection.model_view(docs.supported_identities(spark), docs.IDENTITY_MODEL, True).dtypes[0] == ("IdentityNo", "int")


def test_docs_table(spark):
    nodes = spark.createDataFrame(
        [
            (1, None, 0, "Core", None),
            (2, 1, 0, "Items", None),
            (3, 2, 0, "Create", "core/c"),
            (4, 2, 1, "Gone", "core/g"),
            (5, None, 1, "Start", "start"),
        ],
        "id int, parent_id int, ord int, title string, href string",
    )
    page = f'<h2 id="{docs.IDENTITY_ANCHOR}"></h2><table><tbody><tr><td>User</td><td>Yes</td></tr></tbody></table>'
    pages = spark.createDataFrame([("b/core/c", page), ("b/start", "<p>")], "url string, html string")
    rows = {r.Title: tuple(r)[1:] for r in docs.docs_table(nodes, pages, "b/").collect()}
    assert rows == {
        "Create": ("b/core/c", "Yes", None, "Core", "Items"),
        "Gone": ("b/core/g", "N/A", "N/A", "Core", "Items"),
        "Start": ("b/start", "N/A", "N/A", None, None),
    }


def test_last_value_of_a_key_wins(spark):
    rows = [(1, 0, "User", "a"), (1, 2, "User", None), (1, 1, "User", "b"), (2, 0, "other", "c"), (2, 1, "Spn", "d")]
    df = spark.createDataFrame(rows, "page int, pos int, k string, v string")
    out = measures.kv_rows_to_columns(df, ["page"], "k", "v", "pos", {"u": "User", "s": "Spn"}).orderBy("page").collect()
    assert [tuple(r) for r in out] == [(1, None, None), (2, None, "d")]


def test_rollup_tells_null_from_subtotal(spark):
    df = spark.createDataFrame([("a", None), ("a", "x"), (None, "x")], "s string, p string")
    rows = {(r.s, r.p, r.level_mask): r.n_rows for r in measures.hierarchy_rollup(df, ["s", "p"]).collect()}
    assert rows == {
        ("a", None, 0): 1, ("a", "x", 0): 1, (None, "x", 0): 1,
        ("a", None, 1): 2, (None, None, 1): 1, (None, None, 3): 3,
    }


@pytest.mark.parametrize(
    ("names", "prefix", "expected"),
    [
        ("Orders,Load A", None, ["Load A", "Orders"]),
        (None, "Load", ["Load A", "Load B"]),
        ("Orders", "Load", ["Load A", "Load B", "Orders"]),
        ("", "", ["Load A", "Load B", "Orders"]),
        ("orders", "", []),
    ],
)
def test_list_or_prefix(spark, names, prefix, expected):
    df = spark.createDataFrame([("Orders",), ("Load A",), ("Load B",)], "n string")
    out = df.where(predicates.in_list_or_prefix(F.col("n"), names, prefix)).orderBy("n")
    assert [r.n for r in out.collect()] == expected


def test_must_and_any(spark):
    df = spark.createDataFrame([("*Shop25 DEV",), ("*shop25 x",), ("dev",), (None,)], "n string")
    assert [r.n for r in df.where(predicates.must_and_any(F.col("n"), "*SHOP25", ["Dev", "tst"])).collect()] == ["*Shop25 DEV"]
    assert df.where(predicates.must_and_any(F.col("n"), "", [])).count() == 0


def test_lookup_by_name_takes_the_first(spark):
    df = spark.createDataFrame([(3, "a  b"), (2, " a b "), (1, "ab")], "id int, n string")
    assert predicates.lookup_by_name(df, "n", "a b", "id").collect()[0].id == 2
    assert predicates.lookup_by_name(df, "n", "zz", "id").collect() == []


def test_group_and_enabled(spark):
    df = spark.createDataFrame([("default", True), ("o'ther", True), ("default", None)], "`group` string, is_enabled boolean")
    assert predicates.filter_group(df, "o'ther").count() == 1
    assert predicates.filter_group(df, None).count() == 3
    assert predicates.filter_enabled(df, "is_enabled").count() == 2


def test_ingest_lookup(spark):
    conn = spark.createDataFrame([(1, "g", "x", True), (2, "h", "y", False)], "id int, connection_id string, connection_name string, is_enabled boolean")
    obj = spark.createDataFrame([(1, "s", "a", True), (1, "s", "b", False), (2, "s", "c", True)], "connection_id int, schema_name string, table_name string, is_enabled boolean")
    assert [tuple(r) for r in joins.join_ingest_lookup(conn, obj, "x").collect()] == [("g", "x", "s", "a")]
    assert joins.join_ingest_lookup(conn, obj, "y").count() == 0


def test_map_lookup_leaves_null(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    out = {r.k: r.v for r in joins.map_lookup_join(df, "k", {"a": "1"}, "v").collect()}
    assert out == {"a": "1", "b": None, None: None}


SKEW_SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture
def small_skew(spark):
    """No broadcast, and partitions that count as skewed from a few kilobytes on."""
    for key, value in SKEW_SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key in SKEW_SETTINGS:
        spark.conf.unset(key)


def _final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_split_lookup_keeps_a_hot_key_whole(spark, small_skew):
    hot = F.when(F.col("id") < 60_000, 1).otherwise(F.col("id"))
    df = spark.range(90_000, numPartitions=12).select(hot.alias("k"), F.rand(1).alias("v"))
    lookup = df.groupBy("k").agg(F.count("*").alias("n"))
    out = joins.split_lookup(df, lookup, ["k"])
    rows = out.collect()
    assert len(rows) == 90_000
    assert {r.n for r in rows if r.k == 1} == {60_000}
    assert "skew=true" in _final_plan(out)
    left = joins.split_lookup(df, lookup.where("k <> 1"), ["k"], "left")
    assert left.where("n IS NULL").count() == 60_000


def test_star_join_keeps_facts_without_a_match(spark):
    sales = spark.createDataFrame(
        [("T1", "2022-01-05", "7", "N/A", "3.9", "9"), ("T2", "bad", "N/A", "1", "0", "x")],
        "TransactionID string, TransactionDate string, CustomerId string, ProductID string, Quantity string, TotalPrice string",
    )
    fact = star.fact_sales(sales)
    assert [tuple(r) for r in fact.orderBy("TransactionID").collect()] == [
        (20220105, 7, None, "T1", 3, 9 / 3.9, 9.0),
        (None, None, 1, "T2", 0, None, None),
    ]
    dim = star.dim_customer(spark.createDataFrame([(5, "7", "Ada", "Byron")], "Id bigint, CustomerID string, FirstName string, LastName string"))
    dates_table = star.dim_date(star.base_dim_date(spark, "2022-01-01", "2022-12-31"))
    joined = joins.star_join(fact, dates_table, dim).orderBy("TransactionID").collect()
    assert [(r.Date_Month, r.Customer_FullName) for r in joined] == [(1, "Ada Byron"), (None, None)]


def test_a_hot_key_is_split_by_the_join(spark, small_skew):
    """Two thirds of the facts belong to one customer."""
    customer = F.when(F.col("id") % 3 < 2, 7).otherwise(F.col("id") % 1000).cast("int")
    fact = spark.range(60_000, numPartitions=12).select(customer.alias("DWID_Customer"), F.rand(1).alias("M_TotalPrice"))
    dim = spark.range(1000).selectExpr("id + 1 AS DWID_Customer", "CAST(id AS STRING) AS CustomerID")
    joined = joins.star_join(fact, dim_customer=dim)
    rows = joined.collect()
    assert len(rows) == 60_000
    assert sum(r.Customer_CustomerID == "7" for r in rows) >= 40_000
    assert "skew=true" in _final_plan(joined)


def test_numbers_and_dates(spark):
    df = spark.createDataFrame([(" 12 ",), ("3.7",), ("-4.",), ("1e3",), ("N/A",), ("3000000000",), (None,)], "t string")
    ints = [r[0] for r in df.select(numbers.int_or_null(df, "t")).collect()]
    assert ints == [12, 3, -4, None, None, None, None]
    assert df.select(numbers.int_or_null(df, "t", "bigint")).collect()[5][0] == 3_000_000_000
    days = spark.createDataFrame([("2024-02-29",), ("2024-03-01 23:59:59",), ("no",), (None,)], "d string")
    assert [r[0] for r in days.select(dates.date_key(F.col("d"))).collect()] == [20240229, 20240301, None, None]
    stamp = spark.sql("SELECT timestamp'2024-03-01 01:02:03' AS t").select(dates.utc_stamp(F.col("t")), dates.utc_folder(F.col("t")))
    assert tuple(stamp.first()) == ("2024-03-01 01:02:03 (UTC)", "year=2024/month=03/day=01")
