import datetime
import decimal

import pytest
from pyspark.sql import functions as F

from layerwright.operators import clean, keys, ordering


def test_dedupe_counts_null_and_nan_as_equal(spark):
    rows = [(None, float("nan")), (None, float("nan")), ("a", 1.0), ("a", 1.0), (None, 1.0)]
    df = spark.createDataFrame(rows, "a string, b double")
    once = clean.dedupe_rows(df)
    assert once.count() == 3
    assert clean.dedupe_rows(once).count() == 3


def test_fills_touch_only_their_types(spark):
    schema = "i int, d decimal(9,2), x double, t string, b boolean, day date"
    df = spark.createDataFrame([(None,) * 6, (1, decimal.Decimal("2.50"), float("nan"), "é", True, datetime.date(2024, 1, 1))], schema)
    rows = clean.fill_string_na(clean.fill_numeric_zero(df)).orderBy("i").collect()
    assert tuple(rows[0]) == (0, decimal.Decimal("0.00"), 0.0, "N/A", None, None)
    assert tuple(rows[1]) == (1, decimal.Decimal("2.50"), 0.0, "é", True, datetime.date(2024, 1, 1))


def test_defaults(spark):
    df = spark.createDataFrame([(None, "x"), (5, None)], "cell_timeout int, `group` string")
    out = clean.apply_defaults(df, {"cell_timeout": 90, "group": "default", "retry_count": 1})
    assert {tuple(r) for r in out.collect()} == {(90, "x", 1), (5, "default", 1)}


def test_surrogate_id_is_first_unique_and_kept(spark):
    df = keys.add_surrogate_id(spark.range(100, numPartitions=7).withColumnRenamed("id", "v"))
    assert df.columns == ["Id", "v"]
    assert df.select("Id").distinct().count() == 100
    assert df.agg(F.min("Id")).first()[0] == 1
    assert keys.add_surrogate_id(df) is df


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_dense_id_is_one_to_n_whatever_the_partitions(spark, partitions):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"), F.lit("x").alias("v")).repartition(partitions)
    rows = keys.add_dense_id(df, ["k"]).orderBy("k").collect()
    assert [(r.Id, r.k) for r in rows] == [(i + 1, i) for i in range(1000)]


def test_dense_id_over_several_ordered_files(spark):
    """Many ranges that AQE does not fold into one file."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(5000, numPartitions=6).select(F.format_string("k%05d", F.lit(4999) - F.col("id")).alias("k"))
        rows = keys.add_dense_id(df, ["k"]).orderBy("Id").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [r.k for r in rows] == [f"k{i:05d}" for i in range(5000)]
    assert [r.Id for r in rows] == list(range(1, 5001))


def test_dense_id_spreads_a_hot_key_and_copies(spark):
    """A third of the rows are copies of one row, another third share a key: no range holds a third."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        copies = spark.range(3000, numPartitions=8).select(F.lit(5).alias("k"), F.lit("same").alias("v"))
        shared = spark.range(3000, numPartitions=8).select(F.lit(7).alias("k"), F.col("id").cast("string").alias("v"))
        rest = spark.range(3000, numPartitions=8).select(F.col("id").cast("int").alias("k"), F.lit("r").alias("v"))
        df = keys.add_dense_id(copies.union(shared).union(rest), ["k"])
        ids = df.agg(F.count_distinct("Id"), F.min("Id"), F.max("Id")).first()
        sizes = [r.n for r in df.groupBy(F.col("k") * 0 + F.floor((F.col("Id") - 1) / 9000)).agg(F.count("*").alias("n")).collect()]
        files = df.inputFiles()
        per_file = spark.read.parquet(*files).groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert tuple(ids) == (9000, 1, 9000)
    assert sum(sizes) == 9000
    assert per_file < 3000
    ordered = [r.k for r in df.orderBy("Id").select("k").collect()]
    assert ordered == sorted(ordered)


def test_order_rows_orders_and_keeps_copies(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("b", 1), (None, 3)], "k string, v int")
    rows = [tuple(r) for r in ordering.order_rows(df, "k").collect()]
    assert rows == [(None, 3), ("a", 2), ("b", 1), ("b", 1)]


def test_rank_rule_keeps_input_order_for_ties(spark):
    labels = ["x Lakehouse a", "plain", "Workspace Guids", "SQL Connection Guid", "SQLDatabase Guid", "y Lakehouse b"]
    df = spark.createDataFrame(list(enumerate(labels)), "seq int, label string")
    from layerwright.operators.xref import LABEL_RANKS, OTHER_RANK

    out = ordering.order_by_rank_rule(df, "label", LABEL_RANKS, OTHER_RANK, "seq")
    assert [r.seq for r in out.collect()] == [2, 0, 5, 4, 3, 1]


def test_sort_by_other_column_and_first_row(spark):
    df = spark.createDataFrame([("Mar", 3), ("Jan", 1), ("Feb", 2), ("Jan", 1)], "name string, no int")
    assert [r.name for r in ordering.sort_by_other_column(df, "name", "no").collect()] == ["Jan", "Feb", "Mar"]
    assert ordering.first_row(df, F.desc("no")).collect()[0].name == "Mar"
