"""Ingest: the enabled objects of one connection become dated landing text."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame, Row, SparkSession

from layerwright.operators.joins import join_ingest_lookup
from layerwright.plans.parallel import LOADS_AT_ONCE, side_by_side
from layerwright.sinks.files import write_landing_text
from layerwright.sources.jdbc import EqualDepth, JdbcConnection, ReadRanges, scan_jdbc_table

TableReader = Callable[[str, str], DataFrame]


def jdbc_reader(
    spark: SparkSession, connection: JdbcConnection, ranges: dict[str, ReadRanges | EqualDepth | None] | None = None
) -> TableReader:
    """Reads tables in ranges of equal depth of their keys, those named in ``ranges`` (``schema.table``) as it says."""

    def read(schema_name: str, table_name: str) -> DataFrame:
        cuts = (ranges or {}).get(f"{schema_name}.{table_name}", EqualDepth())
        return scan_jdbc_table(spark, connection, schema_name, table_name, cuts)

    return read


def ingest_all(
    connections: DataFrame,
    objects: DataFrame,
    connection_name: str,
    read_table: TableReader,
    root: str,
    run_time: datetime,
    at_once: int = LOADS_AT_ONCE,
) -> list[str]:
    """Copy each enabled object of the connection to its landing folder, up to ``at_once`` side by side; returns the folders."""

    def copy(row: Row, rows: DataFrame) -> str:
        return write_landing_text(rows, root, row.connection_name, row.table_name, run_time)

    # One row per source table: a work list for the driver.
    wanted = join_ingest_lookup(connections, objects, connection_name).orderBy("schema_name", "table_name")
    copies = [partial(copy, row, read_table(row.schema_name, row.table_name)) for row in wanted.toLocalIterator()]
    return side_by_side(objects.sparkSession, copies, at_once)
