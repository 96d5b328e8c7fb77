"""Base to Curated: dimensions first, then the fact."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwright.plans import star
from layerwright.plans.parallel import LOADS_AT_ONCE, as_ready, levels_of
from layerwright.sinks.tables import load_dimension, load_fact


def star_loads(spark: SparkSession, base: str = "Base", curated: str = "Curated") -> dict[str, Callable[[], None]]:
    """The four loads of the star schema by activity name."""
    return {
        "load_dimension_customer": lambda: load_dimension(
            star.dim_customer(spark.table(f"{base}.sales_customers")), curated, "Customer"
        ),
        "load_dimension_product": lambda: load_dimension(
            star.dim_product(spark.table(f"{base}.sales_products")), curated, "Product"
        ),
        "load_dimension_date": lambda: load_dimension(
            star.dim_date(spark.table(f"{base}.dim_date")), curated, "Date"
        ),
        "load_fact_sales": lambda: load_fact(
            star.fact_sales(spark.table(f"{base}.sales_transactions")), curated, "Transactions"
        ),
    }


def base_to_curated(
    activities: DataFrame, loads: Mapping[str, Callable[[], None]], at_once: int = LOADS_AT_ONCE
) -> list[str]:
    """Run the load of each activity as soon as all it waits for have ended. Returns the activities by level and name.

    Up to ``at_once`` run side by side; after the first error no other starts. A dependency that is no activity, a
    cycle, or an activity without a load stops everything before the first write.
    """
    # One row per load of the solution: a work list for the driver, brought there by one job.
    listed = activities.select("name", F.coalesce("dependencies", F.array().cast("array<string>")).alias("dependencies"))
    waits: dict[str, set[str]] = {}
    for row in listed.toLocalIterator():
        waits.setdefault(row.name, set()).update(row.dependencies)
    missing = sorted((name, other) for name, others in waits.items() for other in others - waits.keys())
    if missing:
        raise ValueError(f"{missing[0][0]} waits for {missing[0][1]}, which is no activity")
    levels = levels_of(waits)
    order = sorted(waits, key=lambda name: (levels[name], name))
    unknown = [name for name in order if name not in loads]
    if unknown:
        raise ValueError(f"no load for {', '.join(unknown)}")
    as_ready(activities.sparkSession, {name: waits[name] for name in order}, loads, at_once)
    return order
