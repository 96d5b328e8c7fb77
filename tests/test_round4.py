"""Tests of what tables sixty times sf0.1 showed."""

import json

from pyspark.sql import functions as F

from layerwright.functions import icons
from layerwright.operators import dag
from layerwright.session import MOST_BYTES, apply_runtime_settings
from layerwright.sinks.tables import write_overwrite


def _activities(spark, edges):
    return spark.createDataFrame(list(edges.items()), "name string, dependencies array<string>")


def test_dag_levels_spreads_edges_of_one_dependency(spark, monkeypatch):
    staged = {}

    def keep(df, label="stage", path=None):
        staged[label] = kept = stage(df.withColumn("__task", F.spark_partition_id()) if label == "dag-edges" else df, label, path)
        return kept.drop("__task")

    stage = dag.stage
    monkeypatch.setattr(dag, "stage", keep)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        rows = spark.range(40_000, numPartitions=8).selectExpr("concat('a', id) AS name", "array('root', 'lost', concat('m', id % 500)) AS dependencies")
        middle = spark.range(500).selectExpr("concat('m', id) AS name", "array('root') AS dependencies")
        every = rows.unionByName(rows.limit(10)).unionByName(middle).unionByName(_activities(spark, {"root": None}))
        levels = {tuple(r) for r in dag.dag_levels(every).groupBy("level").count().collect()}
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert levels == {(0, 1), (1, 500), (2, 40_000)}
    a_task = staged["dag-edges"].where("dependency = 'root'").groupBy("__task").count().agg(F.max("count")).first()[0]
    assert a_task < 30_000


def test_icon_library_parses_a_drawing_once(spark, capsys):
    entries = [{"title": f"t{i % 3}", "xml": f'<a><mxCell style="image=data:image/png,P{i}"/></a>'} for i in range(10)] + [None, {"xml": None}]
    library = "<l>" + json.dumps(entries).replace("&", "&amp;").replace("<", "&lt;") + "</l>"
    df = spark.createDataFrame([(1, 2, library)], "title2 int, xml int, x string")
    out = icons.icon_library_extract(df, "x", ["title2", "xml"])
    assert out.columns == ["title2", "xml", "title", "payload"]
    assert {tuple(r) for r in out.collect()} == {
        (1, 2, "t0", "P9"), (1, 2, "t1", "P7"), (1, 2, "t2", "P8"), (1, 2, "No Title", "Invalid XML")
    }
    out.explain()
    # One for the library, one for a drawing, in the text of the plan each.
    assert capsys.readouterr().out.lower().count("from_xml(") <= 2


def test_runtime_settings_bound_the_bytes_of_a_task(spark):
    session = spark.newSession()
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    for asked, used in (("64MB", 16 << 20), ("1g", 16 << 20), ("67108864b", 16 << 20), ("8m", "8m"), ("20000", "20000")):
        session.conf.set(advisory, asked)
        assert apply_runtime_settings(session).conf.get(advisory) == str(used)
    assert MOST_BYTES[advisory] == 16 << 20


def test_tables_are_written_packed(spark, database):
    for n in (5, 7):
        write_overwrite(spark.range(n).toDF("x"), database, "t")
        assert spark.table(f"{database}.t").count() == n
        names = [f.rsplit("/", 1)[1] for f in spark.table(f"{database}.t").inputFiles()]
        assert names and all(name.endswith(".zstd.parquet") for name in names)
