"""Metadata tables: what to load from where, and in which order."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwright.functions.projections import parse_column_list
from layerwright.operators.predicates import filter_enabled, filter_group
from layerwright.sinks.tables import create_if_absent

# The metadata tables with their column defaults.
METADATA_TABLES = {
    "landing_to_base": """
        id INT NOT NULL,
        source STRING NOT NULL,
        format STRING NOT NULL,
        destination STRING NOT NULL,
        projected_columns STRING""",
    "notebook_orchestrator": """
        id INT NOT NULL,
        notebook_name STRING NOT NULL,
        notebook_path STRING NOT NULL,
        cell_timeout INT NOT NULL DEFAULT 90,
        retry_count INT NOT NULL DEFAULT 1,
        retry_interval INT NOT NULL DEFAULT 10,
        arguments STRING NOT NULL DEFAULT '{"useRootDefaultLakehouse": true}',
        dependencies STRING,
        `group` STRING NOT NULL DEFAULT 'default',
        is_enabled BOOLEAN NOT NULL DEFAULT true""",
    "source_ingest_conn": """
        id INT NOT NULL,
        connection_id STRING NOT NULL,
        connection_name STRING NOT NULL,
        connection_type STRING NOT NULL,
        is_enabled BOOLEAN NOT NULL DEFAULT true""",
    "source_ingest_obj": """
        id INT NOT NULL,
        connection_id INT NOT NULL,
        schema_name STRING NOT NULL,
        table_name STRING NOT NULL,
        is_enabled BOOLEAN NOT NULL DEFAULT true""",
}

ORCHESTRATOR_DEFAULTS = {
    "cell_timeout": 90,
    "retry_count": 1,
    "retry_interval": 10,
    "arguments": '{"useRootDefaultLakehouse": true}',
    "group": "default",
    "is_enabled": True,
}


@dataclass(frozen=True)
class Entity:
    """One table to load: read ``source`` as ``format``, write ``destination``; no columns listed is all."""

    source: str
    format: str
    destination: str
    columns: tuple[str, ...] = ()


def create_metadata_tables(spark: SparkSession, database: str) -> None:
    for table, columns in METADATA_TABLES.items():
        create_if_absent(spark, f"{database}.{table}", columns)


def read_entities(metadata: DataFrame) -> Iterator[Entity]:
    """The entities of landing metadata rows, one per destination; a broken column list is an error.

    One row per table of the solution, read row by row: this is a work list for
    the driver, not data.
    """
    rows = metadata.select(
        "source", "format", "destination", parse_column_list(F.col("projected_columns")).alias("columns")
    )
    entities: dict[str, Entity] = {}
    for row in rows.toLocalIterator():
        if row.destination in entities:
            raise ValueError(f"the metadata names destination {row.destination} twice")
        entities[row.destination] = Entity(row.source, row.format, row.destination, tuple(row.columns or ()))
    return iter(entities.values())


def dag_from_metadata(metadata: DataFrame, group: str | None = None, only_enabled: bool = True) -> DataFrame:
    """Orchestrator rows as activities, with arguments and dependencies parsed; none is empty, broken JSON an error."""
    rows = filter_group(metadata, group)
    if only_enabled:
        rows = filter_enabled(rows, "is_enabled")

    def parsed(column: str, to: str) -> Column:
        return F.from_json(F.nullif(F.col(column), F.lit("")), to, {"mode": "FAILFAST"})

    no_arguments = F.create_map().cast("map<string,string>")
    no_dependencies = F.array().cast("array<string>")
    return rows.select(
        F.col("notebook_name").alias("name"),
        F.col("notebook_path").alias("path"),
        F.col("cell_timeout").alias("timeout_per_cell"),
        F.col("retry_count").alias("retry"),
        F.col("retry_interval").alias("retry_interval"),
        F.coalesce(parsed("arguments", "map<string,string>"), no_arguments).alias("args"),
        F.coalesce(parsed("dependencies", "array<string>"), no_dependencies).alias("dependencies"),
    )
