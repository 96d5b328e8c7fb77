"""Nested environment definitions as rows, and ids of one item side by side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwright.operators.joins import split_lookup
from layerwright.operators.measures import pivot_environments
from layerwright.operators.ordering import order_by_rank_rule

DEFINITION_SCHEMA = (
    "name string, layers map<string, struct<workspace_id string, items map<string, array<struct<"
    "item_name string, connection_name string, id string, sql_endpoint_id string, pbi_connection_id string>>>>>"
)

# How the ids of one item are labelled and the order of the labels.
ID_LABELS = {
    "workspace": "Workspace Guids",
    "sql_endpoint": "SQL Analytics Endpoint Guid",
    "connection": "SQL Connection Guid",
}
LABEL_RANKS = {"Workspace": 1, "Lakehouse": 2, "SQLDatabase": 3, "Connection": 4}
OTHER_RANK = 5


def _layers(df: DataFrame, definition: str, keep: Sequence[str]) -> DataFrame:
    parsed = df.select(*keep, F.from_json(definition, DEFINITION_SCHEMA, {"mode": "FAILFAST"}).alias("d"))
    return parsed.select(*keep, F.explode("d.layers").alias("layer", "l"))


def explode_definition(df: DataFrame, definition: str, keep: Sequence[str]) -> DataFrame:
    """Layers, item types and items of a JSON definition as rows.

    A layer without items and an item type without entries give no row; broken
    JSON is an error.
    """
    types = _layers(df, definition, keep).select(*keep, "layer", F.explode("l.items").alias("item_type", "i"))
    return types.select(*keep, "layer", "item_type", F.posexplode("i").alias("position", "item")).select(
        *keep, "layer", "item_type", "position", "item.*"
    )


def definition_ids(df: DataFrame, definition: str, keep: Sequence[str]) -> DataFrame:
    """``id_kind, id`` rows of JSON definitions.

    One for each layer's workspace and for each item, its endpoint and its
    connection, where there is an id.
    """
    kinds = {"item": "id", "sql_endpoint": "sql_endpoint_id", "connection": "pbi_connection_id"}
    ids = F.array(*[F.struct(F.lit(kind).alias("id_kind"), F.col(c).alias("id")) for kind, c in kinds.items()])
    items = explode_definition(df, definition, keep).select(
        *keep, "layer", "item_type", "item_name", "position", F.inline(ids)
    )
    workspaces = _layers(df, definition, keep).select(
        *keep,
        "layer",
        F.lit("Workspace").alias("item_type"),
        F.col("layer").alias("item_name"),
        F.lit(0).alias("position"),
        F.lit("workspace").alias("id_kind"),
        F.col("l.workspace_id").alias("id"),
    )
    return workspaces.unionByName(items).where(F.col("id").isNotNull())


def id_label(id_kind: Column, layer: Column, item_type: Column, item_name: Column) -> Column:
    """What an id mapping is about, e.g. ``Lakehouse Guid - Base``."""
    labelled = F.concat(item_type, F.lit(" Guid - "), item_name)
    for kind, label in ID_LABELS.items():
        about = layer if kind == "workspace" else item_name
        labelled = F.when(id_kind == kind, F.concat(F.lit(f"{label} - "), about)).otherwise(labelled)
    return labelled


def xref_environments(
    items: DataFrame,
    primary: str,
    others: Sequence[str],
    keys: Sequence[str] = ("layer", "item_type", "item_name", "id_kind"),
    environment: str = "environment",
    value: str = "id",
    position: str = "position",
) -> DataFrame:
    """The ids of the primary environment with the ids of the same item elsewhere.

    One row per primary id that has a match in at least one other environment.
    Of several matches in one environment the last by position is taken. The
    others are folded to one row per item before they meet the primary rows.
    """
    wide = pivot_environments(
        items.where(F.col(environment).isin(list(others))), keys, environment, others, value, position
    )
    ours = items.where((F.col(environment) == primary) & F.col(value).isNotNull()).select(
        *keys, F.col(value).alias("primary_id")
    )
    matched = F.coalesce(*[F.col(f"`{name}`").cast("string") for name in others]).isNotNull()
    return split_lookup(ours, wide, keys).where(matched).select("primary_id", *keys, *[f"`{o}`" for o in others])


def ordered_id_map(xref: DataFrame, order_by: str, ranks: Mapping[str, int] = LABEL_RANKS) -> DataFrame:
    """The cross reference with its label, workspaces first."""
    labelled = xref.withColumn(
        "label", id_label(F.col("id_kind"), F.col("layer"), F.col("item_type"), F.col("item_name"))
    )
    return order_by_rank_rule(labelled, "label", ranks, OTHER_RANK, order_by)
