"""Landing to Base: every table of the metadata is read, cleansed and written."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from layerwright.operators.clean import cleanse
from layerwright.operators.metadata import Entity, read_entities
from layerwright.plans.parallel import LOADS_AT_ONCE, side_by_side
from layerwright.plans.star import base_dim_date
from layerwright.sinks.tables import write_overwrite
from layerwright.sources.files import scan_by_format

DATE_TABLE = "dim_date"


def base_rows(spark: SparkSession, entity: Entity, root: str | None = None) -> DataFrame:
    """The cleansed rows of one entity; a relative source lies below ``root``."""
    source = entity.source if root is None or ":" in entity.source else f"{root.rstrip('/')}/{entity.source}"
    return cleanse(scan_by_format(spark, source, entity.format))


def landing_to_base(
    metadata: DataFrame,
    database: str = "Base",
    root: str | None = None,
    dates: tuple[str, str] | None = None,
    at_once: int = LOADS_AT_ONCE,
) -> list[str]:
    """Load every entity, and the calendar if ``dates`` gives its first and last day. Returns the tables written.

    Rows are de-duplicated over all columns before the projection, as they
    landed. Up to ``at_once`` tables load side by side; after the first error
    no other load starts.
    """
    spark = metadata.sparkSession

    def load(entity: Entity) -> None:
        write_overwrite(base_rows(spark, entity, root), database, entity.destination, entity.columns)

    loads = {}
    if dates is not None:
        loads[DATE_TABLE] = lambda: write_overwrite(base_dim_date(spark, *dates), database, DATE_TABLE)
    # One row per table: a work list for the driver.
    loads |= {entity.destination: partial(load, entity) for entity in read_entities(metadata)}
    side_by_side(spark, loads.values(), at_once)
    return list(loads)
