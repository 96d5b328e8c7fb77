"""JDBC extracts. A table can be read in ranges of one column, so that the extract
scales with the executors instead of passing through one connection."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_$#]*")


@dataclass(frozen=True)
class JdbcConnection:
    url: str
    properties: dict[str, str] = field(default_factory=dict)
    fetch_size: int = 10_000


@dataclass(frozen=True)
class ReadRanges:
    """Split the extract on ``column`` into ``partitions`` ranges from ``lower`` to ``upper``.

    The bounds only place the cuts; rows outside them are read too.
    """

    column: str
    lower: str | int
    upper: str | int
    partitions: int


@dataclass(frozen=True)
class EqualDepth:
    """Split the extract into ``partitions`` ranges with about as many rows each.

    The source itself ranks the rows by ``column`` and names the cuts, so a key with gaps or a crowded end gives no
    heavy range; what repeats one value stays in one range. Without ``column`` the first column of the primary key
    counts; a table without one is read through one connection.
    """

    column: str | None = None
    partitions: int = 32


def identifier(name: str) -> str:
    """A plain SQL identifier as it is; anything else is refused."""
    if not _IDENTIFIER.fullmatch(name):
        raise ValueError(f"not a plain SQL identifier: {name!r}")
    return name


def qualified_name(schema_name: str, table_name: str) -> str:
    """``schema.table`` of two plain identifiers; anything else is refused."""
    return f"{identifier(schema_name)}.{identifier(table_name)}"


def key_query(schema_name: str, table_name: str) -> str:
    """The columns of a table's primary key, in order, as the information schema of the SQL standard lists them."""
    return (
        "SELECT k.column_name AS key_column, k.ordinal_position AS place "
        "FROM information_schema.table_constraints c JOIN information_schema.key_column_usage k "
        "ON k.constraint_name = c.constraint_name AND k.table_schema = c.table_schema AND k.table_name = c.table_name "
        f"WHERE c.constraint_type = 'PRIMARY KEY' AND LOWER(c.table_schema) = '{identifier(schema_name).lower()}' "
        f"AND LOWER(c.table_name) = '{identifier(table_name).lower()}'"
    )


def depth_query(schema_name: str, table_name: str, column: str, partitions: int) -> str:
    """The smallest key of each of ``partitions`` equal shares of the rows: one row per share."""
    if partitions < 1:
        raise ValueError(f"partitions must be at least 1, not {partitions}")
    table, key = qualified_name(schema_name, table_name), identifier(column)
    return (
        f"SELECT ranked.share AS share, MIN(ranked.cut) AS cut "
        f"FROM (SELECT {key} AS cut, NTILE({partitions}) OVER (ORDER BY {key}) AS share "
        f"FROM {table} WHERE {key} IS NOT NULL) ranked GROUP BY ranked.share"
    )


def sql_literal(value: object) -> str:
    """A key value as the SQL standard writes it. Floats and bytes are refused: text does not keep them exactly everywhere."""
    if isinstance(value, bool) or not isinstance(value, (int, Decimal, str, date)):
        raise TypeError(f"no key to cut by: {value!r}")
    if isinstance(value, datetime):
        return f"'{value.isoformat(sep=' ', timespec='microseconds' if value.microsecond % 1000 else 'milliseconds')}'"
    if isinstance(value, (int, Decimal)):
        return f"{value:f}" if isinstance(value, Decimal) else str(value)
    return "'" + str(value).replace("'", "''") + "'"


def depth_predicates(column: str, cuts: list) -> list[str]:
    """Conditions that share out all rows: below the second cut, between cuts, from the last one on, and null keys.

    ``cuts`` are in the source's order and may repeat (a value that fills whole shares); rows that arrive below the
    first or above the last after the cuts were made are read too.
    """
    key, inner = identifier(column), [sql_literal(cut) for cut in dict.fromkeys(cuts)][1:]
    if not inner:
        return [f"{key} IS NOT NULL", f"{key} IS NULL"]
    between = [f"{key} >= {low} AND {key} < {high}" for low, high in zip(inner, inner[1:])]
    return [f"{key} < {inner[0]}", *between, f"{key} >= {inner[-1]}", f"{key} IS NULL"]


def depth_plan(
    read_query: Callable[[str], DataFrame], schema_name: str, table_name: str, depth: EqualDepth
) -> list[str] | None:
    """The conditions a table is read by, or None where it has neither a named column nor a primary key.

    Two short lists come to the driver: the key's columns and one cut per range. The cuts stay in the source's order.
    """
    column = depth.column
    if column is None:
        first = read_query(key_query(schema_name, table_name)).orderBy("place").first()
        if first is None:
            return None
        column = first.key_column
    cuts = read_query(depth_query(schema_name, table_name, column, depth.partitions)).orderBy("share").collect()
    return depth_predicates(column, [row.cut for row in cuts])


def _range_options(ranges: ReadRanges) -> dict[str, str]:
    return {
        "partitionColumn": ranges.column,
        "lowerBound": str(ranges.lower),
        "upperBound": str(ranges.upper),
        "numPartitions": str(ranges.partitions),
    }


def table_options(
    connection: JdbcConnection, schema_name: str, table_name: str, ranges: ReadRanges | None = None
) -> dict[str, str]:
    options = {
        "url": connection.url,
        "fetchsize": str(connection.fetch_size),
        **connection.properties,
        "dbtable": qualified_name(schema_name, table_name),
    }
    return options if ranges is None else options | _range_options(ranges)


def depth_options(connection: JdbcConnection, schema_name: str, table_name: str) -> dict:
    """What a read by conditions is told beside them."""
    properties = {"fetchsize": str(connection.fetch_size), **connection.properties}
    return {"url": connection.url, "table": qualified_name(schema_name, table_name), "properties": properties}


def query_options(connection: JdbcConnection, query: str, ranges: ReadRanges | None = None) -> dict[str, str]:
    """A query that is read in ranges goes as a derived table, because the source must cut it by a column."""
    options = {
        "url": connection.url,
        "fetchsize": str(connection.fetch_size),
        **connection.properties,
    }
    if ranges is None:
        return options | {"query": query}
    return options | {"dbtable": f"({query}) AS extract_query"} | _range_options(ranges)


def scan_jdbc_table(
    spark: SparkSession,
    connection: JdbcConnection,
    schema_name: str,
    table_name: str,
    ranges: ReadRanges | EqualDepth | None = EqualDepth(),
) -> DataFrame:
    """The whole table, with filters and columns pushed to the source.

    Unless told otherwise it is read in ranges of equal depth of its primary key, which two short queries at the
    source find; ``None`` reads through one connection and asks nothing before.
    """
    if isinstance(ranges, EqualDepth):
        wanted = depth_plan(lambda query: scan_jdbc_query(spark, connection, query), schema_name, table_name, ranges)
        if wanted is not None:
            return spark.read.jdbc(predicates=wanted, **depth_options(connection, schema_name, table_name))
        ranges = None
    options = table_options(connection, schema_name, table_name, ranges)
    return spark.read.format("jdbc").options(**options).load()


def scan_jdbc_query(
    spark: SparkSession, connection: JdbcConnection, query: str, ranges: ReadRanges | None = None
) -> DataFrame:
    """All rows of a query that runs at the source, through one connection unless ``ranges`` of a result column are given."""
    return spark.read.format("jdbc").options(**query_options(connection, query, ranges)).load()
