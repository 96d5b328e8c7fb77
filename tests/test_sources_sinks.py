import json
import random
import threading
import time
from datetime import date, datetime, timedelta, timezone
from decimal import Decimal
from functools import partial
from pathlib import Path

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from layerwright import sinks, sources
from layerwright.operators.metadata import METADATA_TABLES, Entity, create_metadata_tables, read_entities
from layerwright.plans import curated, ingest, landing, parallel
from layerwright.session import clear_scratch, hadoop_path, scratch_path, scratch_root, stage, stage_counted
from layerwright.sinks import files, tables
from layerwright.sources import jdbc

RUN_TIME = datetime(2024, 2, 29, 23, 30, tzinfo=timezone(timedelta(hours=-2)))


def test_csv_is_text_and_empty_is_null(spark, tmp_path):
    (tmp_path / "a.csv").write_text("A;B\n1;x\n;\n", encoding="utf-8")
    df = sources.scan_csv(spark, str(tmp_path / "a.csv"))
    assert df.dtypes == [("A", "string"), ("B", "string")]
    assert [tuple(r) for r in df.collect()] == [("1", "x"), (None, None)]
    assert sources.scan_by_format(spark, str(tmp_path / "a.csv"), "csv").collect() == df.collect()


def test_unknown_format_is_an_error(spark):
    with pytest.raises(ValueError, match="orc"):
        sources.scan_by_format(spark, "/nowhere", "orc")


def test_json_metadata(spark, tmp_path):
    entries = [
        {"source": "a", "format": "csv", "destination": "t1", "projected_columns": '["x", "y"]'},
        {"source": "b", "format": "parquet", "destination": "t2", "projected_columns": ["z"]},
        {"source": "c", "format": "parquet", "destination": "t3"},
    ]
    path = tmp_path / "meta.json"
    path.write_text(json.dumps(entries, indent=2))
    found = list(read_entities(sources.scan_json_metadata(spark, str(path))))
    assert found == [
        Entity("a", "csv", "t1", ("x", "y")),
        Entity("b", "parquet", "t2", ("z",)),
        Entity("c", "parquet", "t3", ()),
    ]


@pytest.mark.parametrize("columns", ['["a", 1]', '{"a": 1}', "oops", '["a", null]'])
def test_broken_column_list_stops_the_load(spark, columns):
    df = spark.createDataFrame([("a", "csv", "t", columns)], "source string, format string, destination string, projected_columns string")
    with pytest.raises(Exception, match="not a JSON list"):
        list(read_entities(df))


def test_text_document(spark, tmp_path):
    (tmp_path / "toc.json").write_text('{"items":\n [{"toc_title": "Œuvre",\r\n "href": "a"}]}', encoding="utf-8")
    parsed = sources.scan_text_document(spark, str(tmp_path), "items array<struct<toc_title string, href string>>")
    assert parsed.select(F.col("document.items")[0]["toc_title"]).first()[0] == "Œuvre"
    loose = sources.scan_text_document(spark, str(tmp_path))
    assert loose.select(F.variant_get("document", "$.items[0].href", "string")).first()[0] == "a"


def test_generate_dates(spark):
    days = sources.generate_dates(spark, "2022-01-01", "2023-12-31")
    assert days.count() == 730
    assert days.agg(F.min("Date"), F.max("Date")).first() == (datetime(2022, 1, 1).date(), datetime(2023, 12, 31).date())


def test_landing_folder_is_utc():
    folder = sinks.landing_folder("/root/", "crm", "t", RUN_TIME)
    assert folder == "/root/crm/t/year=2024/month=03/day=01"
    with pytest.raises(ValueError):
        sinks.landing_folder("/root", "crm", "t", datetime(2024, 1, 1))


def test_landing_text_round_trip(spark, tmp_path):
    rows = [
        (1, 'say "hi"'),
        (2, "back\\slash"),
        (3, 'end\\"'),
        (4, "two\nlines, comma"),
        (5, "  blanks  "),
        (6, ""),
        (7, None),
        (8, "naïve 漢字 🟡"),
        (9, "tail\\"),
    ]
    df = spark.createDataFrame(rows, "id int, t string").coalesce(1)
    folder = sinks.write_landing_text(df, str(tmp_path), "crm", "t", RUN_TIME)
    sinks.write_landing_text(df, str(tmp_path), "crm", "t", RUN_TIME)
    files = [p for p in (tmp_path / "crm" / "t").rglob("part-*")]
    assert {p.suffix for p in files} == {".txt"}
    assert str(files[0].parent).endswith(folder[-len("year=2024/month=03/day=01"):])
    text = files[0].read_text(encoding="utf-8")
    assert text.startswith('"id","t"\n"1","say \\"hi\\""\n')
    assert '"6",""\n"7",""\n' in text
    back = sources.read_landing_text(spark, f"{tmp_path}/crm/t").orderBy(F.col("id").cast("int")).collect()
    assert [(int(r.id), r.t or "") for r in back] == [(i, t or "") for i, t in rows]
    assert {(r.year, r.month, r.day) for r in back} == {(2024, 3, 1)}


@pytest.mark.parametrize("block", [150, 100_000])
def test_landing_text_is_read_in_blocks(spark, tmp_path, block):
    rng = random.Random(block)
    bits = ['"', "\\", "\n", ",", "\r", "ab", " ", "\n\n", "漢", '\\"', '",\n"', "x" * 50]
    rows = [(i, "".join(rng.choices(bits, k=rng.randrange(9))), rng.choice(["", "v", "\n"])) for i in range(60)]
    rows.append((60, "\n".join(["long"] * 60), "one record over many blocks"))
    df = spark.createDataFrame(rows, "id int, `a text` string, c string")
    for day, part in ((1, df.filter("id % 3 > 0")), (2, df.filter("id % 3 = 0"))):
        when = datetime(2024, 5, day, 12, tzinfo=timezone.utc)
        sinks.write_landing_text(part.repartition(2, "id"), str(tmp_path), "crm", "t", when)
    path = f"{tmp_path}/crm/t"
    plain = sources.read_landing_text(spark, path)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", block)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)
        cut = sources.read_landing_text(spark, path, split_files=True)
        typed = sources.read_landing_text(spark, path, plain.schema, split_files=True)
        assert cut.schema == typed.schema == plain.schema
        lines = spark.read.option("lineSep", "\n").text(path)
        assert lines.rdd.getNumPartitions() > (4 if block < 1000 else 0)
        found, again = cut.collect(), typed.collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    key = lambda row: int(row.id)
    assert sorted(found, key=key) == sorted(plain.collect(), key=key) == sorted(again, key=key)
    assert len(found) == 61 and {r.day for r in found} == {1, 2}


def test_blocks_of_text_that_ends_early_or_holds_nothing(spark, tmp_path):
    (tmp_path / "day=1").mkdir()
    (tmp_path / "day=1" / "empty.txt").write_text("")
    (tmp_path / "day=1" / "head.txt").write_text('"a","b"\n')
    (tmp_path / "day=1" / "rows.txt").write_bytes(b'"a","b"\r\n"1","x\ny"\r\n\r\n"2"\r\n"3","z","more"')
    schema = "a string, b string, day int"
    plain = sources.read_landing_text(spark, str(tmp_path), schema).collect()
    assert sorted(sources.read_landing_text(spark, str(tmp_path), schema, split_files=True).collect()) == sorted(plain)
    assert [r.a for r in sorted(plain)] == ["1", "2", "3"]


def test_overwrite_keeps_old_columns(spark, database):
    sinks.write_overwrite(spark.createDataFrame([(1, 2)], "a int, b int"), database, "t", add_id=False)
    sinks.write_overwrite(spark.createDataFrame([(3, "x")], "A int, c string"), database, "t", add_id=False)
    out = spark.table(f"{database}.t")
    assert out.columns == ["a", "b", "c"]
    assert [tuple(r) for r in out.collect()] == [(3, None, "x")]
    with pytest.raises(ValueError, match="column a"):
        sinks.write_overwrite(spark.createDataFrame([("s",)], "a string"), database, "t", add_id=False)


def test_failed_overwrite_leaves_the_old_rows(spark, database):
    sinks.write_overwrite(spark.createDataFrame([(1,)], "a int"), database, "t", add_id=False)
    with pytest.raises(Exception, match="broken load"):
        bad = spark.range(3).select(F.raise_error(F.lit("broken load")).cast("int").alias("a"))
        sinks.write_overwrite(bad, database, "t", add_id=False)
    assert [r.a for r in spark.table(f"{database}.t").collect()] == [1]
    sinks.write_overwrite(spark.table(f"{database}.t").withColumn("a", F.col("a") + 1), database, "t", add_id=False)
    assert [r.a for r in spark.table(f"{database}.t").collect()] == [2]


def test_overwrite_adds_id_in_front_and_projects(spark, database):
    df = spark.createDataFrame([("a", 1, True)], "x string, y int, z boolean")
    sinks.write_overwrite(df, database, "t", ["z", "x"])
    assert spark.table(f"{database}.t").columns == ["Id", "z", "x"]
    keyed = spark.createDataFrame([(9, "a")], "Id bigint, x string")
    sinks.write_overwrite(keyed, database, "u", [])
    assert [tuple(r) for r in spark.table(f"{database}.u").collect()] == [(9, "a")]
    sinks.write_overwrite(keyed, database, "v", ["x"], add_id=False)
    assert spark.table(f"{database}.v").columns == ["x"]


def test_metadata_tables_are_made_once_with_defaults(spark, database):
    create_metadata_tables(spark, database)
    spark.sql(f"INSERT INTO {database}.source_ingest_conn (id, connection_id, connection_name, connection_type) VALUES (1, 'c', 'n', 't')")
    create_metadata_tables(spark, database)
    assert spark.table(f"{database}.source_ingest_conn").first().is_enabled is True
    assert {t.name for t in spark.catalog.listTables(database) if not t.isTemporary} == set(METADATA_TABLES)


def test_truncate_reload_matches_by_name(spark, database):
    spark.createDataFrame([(1, "a")], "k int, v string").write.saveAsTable(f"{database}.t")
    sinks.truncate_reload(spark.createDataFrame([("b", 2)], "v string, k int"), f"{database}.t")
    assert [tuple(r) for r in spark.table(f"{database}.t").collect()] == [(2, "b")]


def test_temp_view(spark):
    view = sinks.temp_view(spark.range(3), "three_rows")
    assert view.count() == spark.sql("SELECT * FROM three_rows").count() == 3


def test_jdbc_options_split_the_extract():
    connection = jdbc.JdbcConnection("jdbc:sqlserver://host", {"user": "u"})
    whole = jdbc.table_options(connection, "dbo", "Budgets")
    assert whole == {"url": "jdbc:sqlserver://host", "fetchsize": "10000", "user": "u", "dbtable": "dbo.Budgets"}
    split = jdbc.table_options(connection, "dbo", "Budgets", jdbc.ReadRanges("id", 1, 100, 4))
    assert {k: split[k] for k in ("partitionColumn", "lowerBound", "upperBound", "numPartitions")} == {
        "partitionColumn": "id", "lowerBound": "1", "upperBound": "100", "numPartitions": "4",
    }
    assert jdbc.query_options(connection, "SELECT 1")["query"] == "SELECT 1"
    cut = jdbc.query_options(connection, "SELECT id FROM t", jdbc.ReadRanges("id", 1, 100, 4))
    assert "query" not in cut and cut["dbtable"] == "(SELECT id FROM t) AS extract_query"
    assert (cut["partitionColumn"], cut["numPartitions"]) == ("id", "4")
    with pytest.raises(ValueError):
        jdbc.qualified_name("dbo", "x; DROP TABLE y")


def _keys():
    rng = random.Random(4)
    crowded = [min(int(rng.expovariate(0.001)), 3000) for _ in range(2000)]
    return {
        "k int": crowded + [None] * 50,
        "k string": [f"o'{k % 97}" for k in crowded] + [None, ""],
        "k date": [date(2020, 1, 1) + timedelta(days=k) for k in crowded],
        "k timestamp": [datetime(2020, 1, 1) + timedelta(seconds=k, microseconds=k) for k in crowded],
        "k decimal(9,3)": [Decimal(k) / 8 for k in crowded] + [None],
        "k long": [7] * 300 + [None] * 3,
        "k short": [],
    }


@pytest.mark.parametrize("column", _keys())
def test_ranges_of_equal_depth_share_out_all_rows(spark, database, column):
    """The cuts are found by SQL that any source runs; here Spark's own tables stand for the source."""
    values = _keys()[column]
    spark.createDataFrame([(v,) for v in values], column).write.saveAsTable(f"{database}.Keyed")
    wanted = jdbc.depth_plan(spark.sql, database, "Keyed", jdbc.EqualDepth("k", 8))
    counts = [spark.table(f"{database}.Keyed").filter(condition).count() for condition in wanted]
    assert sum(counts) == len(values) and counts[-1] == values.count(None)
    heaviest = max([values.count(v) for v in set(values) - {None}], default=0)
    assert max(counts[:-1]) <= len(values) / 8 + 1 + heaviest
    assert len(wanted) <= 9 and (heaviest > 250 or len(wanted) > 5 or not values)


def test_ranges_fall_on_the_first_key_column():
    class Answer(list):
        def orderBy(self, name):
            return Answer(sorted(self, key=lambda row: row[name]))

        def first(self):
            return self[0] if self else None

        def collect(self):
            return self

    asked = []

    def source(query):
        asked.append(query)
        if "information_schema" in query:
            return Answer([Row(key_column="line", place=2), Row(key_column="order_id", place=1)])
        return Answer([Row(share=2, cut=50), Row(share=1, cut=1), Row(share=3, cut=90)])

    wanted = jdbc.depth_plan(source, "dbo", "Lines", jdbc.EqualDepth(partitions=3))
    assert wanted == ["order_id < 50", "order_id >= 50 AND order_id < 90", "order_id >= 90", "order_id IS NULL"]
    assert "LOWER(c.table_name) = 'lines'" in asked[0] and "NTILE(3) OVER (ORDER BY order_id)" in asked[1]
    assert jdbc.depth_plan(lambda query: Answer(), "dbo", "Heap", jdbc.EqualDepth()) is None
    for value in (0.5, True, b"x", None):
        with pytest.raises(TypeError):
            jdbc.sql_literal(value)
    with pytest.raises(ValueError):
        jdbc.depth_query("dbo", "t", "k; DROP TABLE y", 4)
    with pytest.raises(ValueError):
        jdbc.depth_query("dbo", "t", "k", 0)
    assert jdbc.depth_options(jdbc.JdbcConnection("jdbc:x", {"user": "u"}), "dbo", "t") == {
        "url": "jdbc:x", "table": "dbo.t", "properties": {"fetchsize": "10000", "user": "u"},
    }


def _lookup_tables(spark):
    conn = spark.createDataFrame(
        [(1, "g1", "crm", "sql", True), (2, "g2", "old", "sql", False)],
        "id int, connection_id string, connection_name string, connection_type string, is_enabled boolean",
    )
    obj = spark.createDataFrame(
        [(1, 1, "dbo", "A", True), (2, 1, "dbo", "B", False), (3, 2, "dbo", "C", True), (4, 1, "dbo", "D", True)],
        "id int, connection_id int, schema_name string, table_name string, is_enabled boolean",
    )
    return conn, obj


def test_ingest_copies_enabled_objects(spark, tmp_path):
    conn, obj = _lookup_tables(spark)
    seen = []

    def read(schema, name):
        seen.append(f"{schema}.{name}")
        return spark.createDataFrame([(name,)], "v string")

    folders = ingest.ingest_all(conn, obj, "crm", read, str(tmp_path), RUN_TIME)
    assert seen == ["dbo.A", "dbo.D"]
    assert len(folders) == 2
    assert sources.read_landing_text(spark, f"{tmp_path}/crm/D").first().v == "D"
    assert ingest.ingest_all(conn, obj, "old", read, str(tmp_path), RUN_TIME) == []


def _activities(spark, fact_waits):
    rows = [(n, []) for n in ("load_dimension_customer", "load_dimension_product", "load_dimension_date")]
    return spark.createDataFrame([*rows, ("load_fact_sales", fact_waits)], "name string, dependencies array<string>")


def test_landing_to_curated(spark, tmp_path):
    base, gold = (f"{layer}_{scratch_path(spark, 'x')[-8:]}" for layer in ("base", "gold"))
    sinks.create_layers(spark, [base, gold], str(tmp_path / "layers"))
    (tmp_path / "Customers.csv").write_text("CustomerID;FirstName;LastName;Mail\n2;Ada;Byron;a\n2;Ada;Byron;a\n1;Bo;;b\n")
    (tmp_path / "Transactions.csv").write_text(
        "TransactionID;TransactionDate;CustomerId;ProductID;Quantity;TotalPrice\n"
        "T1;2022-01-02;2;10;4;10.0\nT1;2022-01-02;2;10;4;10.0\nT2;2022-01-03;1;11;0;5\nT3;2022-01-03;;11;;7.5\n"
    )
    goods = spark.createDataFrame(
        [(10, "M", "Pump", 2.5), (11, None, "Hose", None)], "ProductId int, Manufacturer string, ProductName string, Price double"
    )
    sinks.write_path_overwrite(goods, str(tmp_path / "Products.parquet"))
    metadata = spark.createDataFrame(
        [
            ("Customers.csv", "csv", "sales_customers", '["CustomerID", "FirstName", "LastName"]'),
            ("Products.parquet", "parquet", "sales_products", "[]"),
            ("Transactions.csv", "csv", "sales_transactions", "[]"),
        ],
        "source string, format string, destination string, projected_columns string",
    )

    def load():
        return landing.landing_to_base(metadata, base, str(tmp_path), ("2022-01-01", "2022-01-31"))

    assert load() == ["dim_date", "sales_customers", "sales_products", "sales_transactions"]
    first = {tuple(r)[1:] for r in spark.table(f"{base}.sales_customers").collect()}
    assert first == {("2", "Ada", "Byron"), ("1", "Bo", "N/A")}
    load()
    assert {tuple(r)[1:] for r in spark.table(f"{base}.sales_customers").collect()} == first
    assert spark.table(f"{base}.dim_date").columns == ["Id", "DateId", "Date", "Year", "Month", "Day"]

    waits = ["load_dimension_customer", "load_dimension_product", "load_dimension_date"]
    loads = curated.star_loads(spark, base, gold)
    with pytest.raises(ValueError, match="load_dimension_customerS"):
        curated.base_to_curated(_activities(spark, [waits[0] + "S", *waits[1:]]), loads)
    with pytest.raises(ValueError, match="no load for"):
        curated.base_to_curated(spark.createDataFrame([("other", [])], "name string, dependencies array<string>"), loads)
    assert all(t.isTemporary for t in spark.catalog.listTables(gold))
    order = curated.base_to_curated(_activities(spark, waits), loads)
    assert order == [*sorted(waits), "load_fact_sales"]
    facts = {tuple(r) for r in spark.table(f"{gold}.Transactions").collect()}
    assert facts == {
        (20220102, 2, 10, "T1", 4, 2.5, 10.0),
        (20220103, 1, 11, "T2", 0, None, 5.0),
        (20220103, None, 11, "T3", None, None, 7.5),
    }
    assert spark.table(f"{gold}.Customer").where("CustomerID = '2'").first().FullName == "Ada Byron"
    assert spark.table(f"{gold}.Product").where("ProductsId = 11").first().Manufacturer == "N/A"
    assert spark.table(f"{gold}.Date").columns == ["DWID_Date", "Date", "Year", "Month", "Day"]


def test_loads_start_when_ready(spark):
    """A slow load holds up what waits for it, not the chain beside it."""
    begun, ended, lock = [], [], threading.Lock()

    def load(name, seconds=0.0, error=None):
        with lock:
            begun.append((name, set(ended)))
        time.sleep(seconds)
        if error:
            raise error
        with lock:
            ended.append(name)

    waits = {"slow": [], "a": [], "b": ["a"], "c": ["b"], "d": ["c"], "last": ["slow", "d"], "none": None}
    activities = spark.createDataFrame(list(waits.items()), "name string, dependencies array<string>")
    loads = {name: partial(load, name, 2.0 if name == "slow" else 0.0) for name in waits}
    assert curated.base_to_curated(activities, loads, at_once=2) == ["a", "none", "slow", "b", "c", "d", "last"]
    assert all(set(waits[name] or []) <= before for name, before in begun)
    assert ended[-2:] == ["slow", "last"] and ended.index("d") < ended.index("slow")

    begun.clear()
    loads["b"] = partial(load, "b", 0.0, KeyError("broken"))
    with pytest.raises(KeyError, match="broken"):
        curated.base_to_curated(activities, loads, at_once=2)
    assert not {"c", "d", "last"} & {name for name, _ in begun}
    cycle = spark.createDataFrame([("a", []), ("b", ["c", "a"]), ("c", ["b"])], "name string, dependencies array<string>")
    begun.clear()
    with pytest.raises(ValueError, match="cycle"):
        curated.base_to_curated(cycle, loads)
    assert not begun


def test_loads_side_by_side_stop_at_an_error(spark):
    started = []

    def load(name, error=None):
        started.append(name)
        if error:
            raise error
        return name

    assert parallel.side_by_side(spark, [lambda: load("a"), lambda: load("b")], 2) == ["a", "b"]
    started.clear()
    with pytest.raises(ValueError, match="broken"):
        parallel.side_by_side(spark, [lambda: load("a"), lambda: load("b", ValueError("broken")), *[lambda: time.sleep(1) or load("c")] * 5], 1)
    assert started[:2] == ["a", "b"] and len(started) <= 3


def _sometimes(monkeypatch, name, failing):
    """``tables.name`` with the call number ``failing`` stopped."""
    real, calls = getattr(tables, name), []

    def sometimes(*given):
        calls.append(given)
        if len(calls) == failing:
            raise RuntimeError("stopped")
        return real(*given)

    monkeypatch.setattr(tables, name, sometimes)


def _folders(spark, name):
    """The snapshots on disk beside a table's own folder."""
    location = tables._described(spark, f"TABLE {name}")["Location"]
    return {p.name for p in Path(location.removeprefix("file:")).parent.iterdir()}


@pytest.mark.parametrize("failing", [0, 1])
def test_overwrite_that_fails_leaves_the_old_rows(spark, monkeypatch, database, failing):
    rows = spark.range(5)
    if failing == 0:
        rows = rows.selectExpr("CAST(IF(id = 4, raise_error('stopped'), id) AS BIGINT) AS id")
    tables.write_overwrite(spark.range(3), database, "t", add_id=False)
    before = _folders(spark, f"{database}.t")
    with monkeypatch.context() as patched:
        _sometimes(patched, "_point", failing)
        with pytest.raises(Exception, match="stopped"):
            tables.write_overwrite(rows, database, "t", add_id=False)
    assert spark.table(f"{database}.t").count() == 3 and _folders(spark, f"{database}.t") == before
    with monkeypatch.context() as patched:
        _sometimes(patched, "_point", failing)
        with pytest.raises(Exception, match="stopped"):
            tables.write_overwrite(rows, database, "u", add_id=False)
    assert [t.name for t in spark.catalog.listTables(database) if not t.isTemporary] == ["t"]
    tables.write_overwrite(spark.range(4), database, "u", add_id=False)
    assert spark.table(f"{database}.u").count() == 4


@pytest.mark.parametrize("failing", [0, 1, 2])
@pytest.mark.parametrize("external", [False, True])
def test_swap_that_fails_leaves_the_old_table(spark, monkeypatch, database, tmp_path, failing, external):
    name = f"{database}.t"
    place = f"LOCATION '{tmp_path}/rows'" if external else ""
    spark.sql(f"CREATE TABLE {name} (id BIGINT, p INT) USING parquet PARTITIONED BY (p) {place}")
    tables.write_overwrite(spark.range(3).selectExpr("id", "1 AS p"), database, "t", add_id=False)
    _sometimes(monkeypatch, "_rename", failing)
    wrong = "CAST(IF(id = 4, raise_error('stopped'), id) AS BIGINT) AS id" if failing == 0 else "id"
    with pytest.raises(Exception, match="stopped"):
        tables.write_overwrite(spark.range(5).selectExpr(wrong, "2 AS p"), database, "t", add_id=False)
    assert spark.table(name).count() == 3
    assert [t.name for t in spark.catalog.listTables(database) if not t.isTemporary] == ["t"]
    assert spark.catalog.getTable(name).tableType == ("EXTERNAL" if external else "MANAGED")
    assert len(list(tmp_path.rglob("*.parquet"))) == (3 if external else 0)


def test_readers_never_meet_a_moment_without_rows(spark, database):
    name, stop, seen, errors = f"{database}.t", threading.Event(), set(), []
    tables.write_overwrite(spark.range(1000), database, "t", add_id=False)

    def read():
        while not stop.is_set():
            try:
                seen.add(spark.table(name).count())
            except Exception as error:  # noqa: BLE001
                errors.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(1001, 1007):
        tables.write_overwrite(spark.range(n), database, "t", add_id=False)
    stop.set()
    reader.join()
    assert not errors and seen <= set(range(1000, 1007)) and len(seen) > 1
    assert len(_folders(spark, name)) == 2
    spark.sql(f"DROP TABLE {name}")
    tables.write_overwrite(spark.range(2), database, "t", add_id=False)
    assert spark.table(name).count() == 2


@pytest.mark.parametrize("layout", ["", "PARTITIONED BY (p)"])
def test_overwrite_keeps_an_external_table_external(spark, database, tmp_path, layout):
    name = f"{database}.t"
    spark.sql(f"CREATE TABLE {name} (id BIGINT, p INT) USING parquet {layout} LOCATION '{tmp_path}/rows'")
    spark.sql(f"INSERT INTO {name} VALUES (7, 1)")
    for n in (3, 4, 5):
        tables.write_overwrite(spark.range(n).selectExpr("id", "1 AS p"), database, "t", add_id=False)
        assert spark.catalog.getTable(name).tableType == "EXTERNAL" and spark.table(name).count() == n
        assert tables._described(spark, f"TABLE {name}")["Location"].removeprefix("file:").startswith(str(tmp_path))
    managed = f"{database}.m"
    spark.range(2).write.saveAsTable(managed)
    for n in (3, 4, 5):
        tables.write_overwrite(spark.range(n), database, "m", add_id=False)
        assert spark.catalog.getTable(managed).tableType == "MANAGED" and spark.table(managed).count() == n
    sinks.truncate_reload(spark.range(9), managed)
    assert spark.table(managed).count() == 9


def test_overwrite_keeps_what_the_table_says_of_itself(spark, database):
    name = f"{database}.t"
    spark.sql(
        f"CREATE TABLE {name} (a BIGINT COMMENT 'the \\'a\\'', d INT DEFAULT 7, p STRING) USING parquet PARTITIONED BY (p) "
        "COMMENT 'it\\'s' TBLPROPERTIES ('owner.team' = 'x\\'y')"
    )
    for n in (3, 5):
        rows = spark.range(n).selectExpr("id AS a", "IF(id % 2 = 0, 'even', 'odd') AS p", "id * 2 AS extra")
        tables.write_overwrite(rows, database, "t", add_id=False)
    kept = {r.a: (r.d, r.p, r.extra) for r in spark.table(name).collect()}
    assert kept == {i: (None, "odd" if i % 2 else "even", 2 * i) for i in range(5)}
    assert spark.table(name).where("p = 'odd'").count() == 2
    columns = {c.name: c for c in spark.catalog.listColumns(name)}
    assert columns["p"].isPartition and columns["a"].description == "the 'a'"
    assert spark.catalog.getTable(name).description == "it's"
    assert {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}["owner.team"] == "x'y"
    spark.sql(f"INSERT INTO {name} (a, p) VALUES (9, 'odd')")
    assert spark.table(name).where("a = 9").first().d == 7


@pytest.mark.parametrize("failing", [None, 0, 1, 2])
def test_path_overwrite_swaps_complete_folders(spark, tmp_path, monkeypatch, failing):
    path = str(tmp_path / "rows")
    files.write_path_overwrite(spark.range(3), path)
    move, calls = files._move, []

    def sometimes(*names):
        calls.append(names)
        if len(calls) == failing:
            raise OSError("stopped")
        move(*names)

    monkeypatch.setattr(files, "_move", sometimes)
    if failing is None:
        files.write_path_overwrite(spark.read.parquet(path).union(spark.range(2)), path)
        assert spark.read.parquet(path).count() == 5
    else:
        rows = spark.range(5).selectExpr("IF(id = 4, raise_error('stopped'), id) AS id") if failing == 0 else spark.range(5)
        with pytest.raises(Exception, match="stopped"):
            files.write_path_overwrite(rows, path)
        assert spark.read.parquet(path).count() == 3
    assert [p.name for p in tmp_path.iterdir()] == ["rows"]


def test_scratch_goes_away(spark, monkeypatch, tmp_path):
    monkeypatch.setattr("layerwright.session.scratch_dir", lambda spark: str(tmp_path))
    staged, rows = stage_counted(spark.range(10), "a")
    other = stage(staged.where("id > 100"), "b")
    assert rows == 10 and staged.count() == 10 and other.count() == 0
    assert stage_counted(other, "c")[1] == 0
    assert len(list((tmp_path / "layerwright").rglob("*.parquet"))) >= 2
    clear_scratch(spark)
    files_of, root = hadoop_path(spark, scratch_root(spark))
    assert not files_of.exists(root) and not list(tmp_path.rglob("*.parquet"))
    assert stage(spark.range(4), "d").count() == 4
