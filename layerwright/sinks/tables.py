"""Table sinks: schema-keeping overwrite, dimension and fact loads, metadata tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerwright.operators.keys import ID_COLUMN, add_surrogate_id
from layerwright.operators.projection import project_columns
from layerwright.session import hadoop_path

# Folders of a table's rows stand in one of this name beside the table's own folder; readers of the folder above skip it.
_SNAPSHOTS = "_snapshots_"
# Tables are written once a load and read often: smaller files for a little more work.
SNAPSHOT_CODEC = "zstd"
# The table property that names the folder of the rows before the present ones.
_BEFORE = "layerwright.rows_before"


def keep_columns_of(df: DataFrame, target: T.StructType) -> DataFrame:
    """``df`` in the column order of ``target``: columns it lacks are NULL, new ones come last."""
    incoming = {field.name.lower(): field for field in df.schema}
    known = {field.name.lower() for field in target}
    kept = []
    for field in target:
        match = incoming.get(field.name.lower())
        if match is None:
            kept.append(F.lit(None).cast(field.dataType).alias(field.name))
        elif match.dataType != field.dataType:
            raise ValueError(
                f"column {field.name} is {field.dataType.simpleString()} in the table "
                f"but {match.dataType.simpleString()} in the new rows"
            )
        else:
            kept.append(F.col(f"`{match.name}`").alias(field.name))
    added = [F.col(f"`{name}`") for name in df.columns if name.lower() not in known]
    return df.select(*kept, *added)


def write_overwrite(
    df: DataFrame,
    database: str,
    table: str,
    columns: Sequence[str] | None = None,
    add_id: bool = True,
) -> None:
    """Replace the rows of a table. Columns it already has stay, new ones are added.

    The generated id, if asked for and not there yet, is the first column. The
    rows are written to a folder of their own, a snapshot beside the table's, and then the
    catalog is told of it in one step: readers meet the old rows or the new ones and never
    none, nothing is renamed or copied, a load that fails leaves the old rows, and rows may come
    from the table itself. The snapshot before stays until the next load, for those
    who still read it. A managed table stays managed and an external one external;
    comments, defaults and properties stay. Tables that are partitioned, bucketed or not Parquet, where the
    catalog knows more than a folder, are filled anew beside the old one and swapped by name.
    """
    spark = df.sparkSession
    rows = project_columns(df, columns)
    if add_id and ID_COLUMN not in df.columns:
        rows = add_surrogate_id(rows)
    name = f"{database}.{table}"
    if not spark.catalog.tableExists(name):
        _create(rows, name, f"{_described(spark, f'DATABASE {database}')['Location'].rstrip('/')}/{_SNAPSHOTS}{table.lower()}")
        return
    rows = keep_columns_of(rows, spark.table(name).schema)
    facts = _described(spark, f"TABLE {name}")
    if facts["Provider"].lower() == "parquet" and "# Partition Information" not in facts and "Bucket Columns" not in facts:
        _point_at_new_rows(rows, name, facts)
    else:
        _swap(rows, name, facts)


def _described(spark: SparkSession, what: str) -> dict[str, str]:
    """What the catalog says of a table or database, by name."""
    rows = spark.sql(f"DESCRIBE {what.replace(' ', ' EXTENDED ', 1)}").toLocalIterator()
    return {row[0]: row[1] or "" for row in rows}


def _snapshot_beside(location: str) -> str:
    """A folder nobody has used, in the snapshots' folder of the table that lies at ``location``."""
    above, folder = location.rsplit("/", 1)
    snapshots = above if above.rsplit("/", 1)[-1].startswith(_SNAPSHOTS) else f"{above}/{_SNAPSHOTS}{folder}"
    return f"{snapshots}/{uuid.uuid4().hex}"


def _create(rows: DataFrame, name: str, snapshots: str) -> None:
    spark = rows.sparkSession
    snapshot = f"{snapshots}/{uuid.uuid4().hex}"
    made = False
    try:
        rows.write.parquet(snapshot, compression=SNAPSHOT_CODEC)
        spark.catalog.createTable(name, source="parquet", schema=rows.schema)
        made = True
        _point(spark, name, snapshot)
    except Exception:
        if made:
            spark.sql(f"DROP TABLE {name}")
        _delete(spark, snapshot)
        raise


def _point_at_new_rows(rows: DataFrame, name: str, facts: dict[str, str]) -> None:
    spark, old = rows.sparkSession, facts["Location"].rstrip("/")
    snapshot = _snapshot_beside(old)
    try:
        rows.write.parquet(snapshot, compression=SNAPSHOT_CODEC)
        _add_columns(spark, name, rows.schema)
        _point(spark, name, snapshot)
    except Exception:
        _delete(spark, snapshot)
        raise
    properties = {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {name}").toLocalIterator()}
    before = properties.get(_BEFORE)
    if before and before not in (old, snapshot):
        _delete(spark, before)
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{_BEFORE}' = {_quoted(old)})")


def _point(spark: SparkSession, name: str, folder: str) -> None:
    spark.sql(f"ALTER TABLE {name} SET LOCATION {_quoted(folder)}")


def _delete(spark: SparkSession, folder: str) -> None:
    files, place = hadoop_path(spark, folder)
    files.delete(place, True)


def _swap(rows: DataFrame, name: str, facts: dict[str, str]) -> None:
    """A table like the old one takes its name when it is complete; what fails leaves the old table under its name and nothing else."""
    spark = rows.sparkSession
    mark = uuid.uuid4().hex[:12]
    incoming, old = f"{name}_incoming_{mark}", f"{name}_old_{mark}"
    external = facts["Type"].upper() == "EXTERNAL"
    folder = _snapshot_beside(facts["Location"].rstrip("/")) if external else None
    done = False
    try:
        _create_like(spark, incoming, name, rows.schema, folder)
        rows.select(*[F.col(f"`{column}`") for column in spark.table(incoming).columns]).write.insertInto(incoming)
        _rename(spark, name, old)
        try:
            _rename(spark, incoming, name)
        except Exception:
            _rename(spark, old, name)
            raise
        done = True
        spark.sql(f"DROP TABLE {old}")
        if external:
            _delete(spark, facts["Location"])
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {incoming}")
        if external and not done:
            _delete(spark, folder)


def _add_columns(spark: SparkSession, name: str, schema: T.StructType) -> None:
    """Give a table the columns of ``schema`` it lacks."""
    known = {column.lower() for column in spark.table(name).columns}
    added = [f"`{field.name}` {field.dataType.simpleString()}" for field in schema if field.name.lower() not in known]
    if added:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(added)})")


def _create_like(spark: SparkSession, name: str, model: str, schema: T.StructType, folder: str | None) -> None:
    """An empty table, external in ``folder`` if given, with all ``model`` says of itself and the columns of ``schema`` it lacks."""
    spark.sql(f"CREATE TABLE {name} LIKE {model}{f' LOCATION {_quoted(folder)}' if folder else ''}")
    _add_columns(spark, name, schema)
    for row in spark.sql(f"SHOW TBLPROPERTIES {model}").toLocalIterator():
        # Those of Spark and of the catalog describe the files, not the table.
        if not row.key.startswith(("spark.", "transient_")):
            spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({_quoted(row.key)} = {_quoted(row.value)})")
    comment = spark.catalog.getTable(model).description
    if comment:
        spark.sql(f"COMMENT ON TABLE {name} IS {_quoted(comment)}")


def _quoted(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _rename(spark: SparkSession, name: str, to: str) -> None:
    spark.sql(f"ALTER TABLE {name} RENAME TO {to}")


def load_dimension(df: DataFrame, database: str, table: str) -> None:
    write_overwrite(df, database, table, add_id=False)


def load_fact(df: DataFrame, database: str, table: str) -> None:
    write_overwrite(df, database, table, add_id=False)


def truncate_reload(df: DataFrame, table: str) -> None:
    """Empty ``table`` and insert ``df``, matching columns by name."""
    target = df.sparkSession.table(table).schema
    df.select(*[F.col(field.name).cast(field.dataType) for field in target]).write.insertInto(table, overwrite=True)


def create_if_absent(spark: SparkSession, table: str, columns_ddl: str) -> None:
    """Create a Parquet table unless it is there; ``columns_ddl`` may hold NOT NULL and DEFAULT.

    Spark fills in the defaults but does not check NOT NULL on Parquet tables.
    """
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns_ddl}) USING parquet")


def create_layers(spark: SparkSession, names: Iterable[str], location: str | None = None) -> None:
    """Get or create one database per layer, below ``location`` if given."""
    for name in names:
        place = f" LOCATION '{location.rstrip('/')}/{name}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{place}")


def temp_view(df: DataFrame, name: str) -> DataFrame:
    """Give a query a name for SQL and return it as a table of that name."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
