"""Activities and their dependencies as tables."""

from __future__ import annotations

import sys
from collections import Counter, defaultdict

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from layerwright.operators.joins import split_lookup
from layerwright.session import scratch_path, stage, stage_counted

# Executors get the count-down with the query; they need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Edges between activities that one task may hold: some ten megabytes of names.
EDGES_A_TASK = 200_000
_SETTLED = "name string, level int"
_CYCLE = "the activities wait for each other in a cycle"


def dag_edges(activities: DataFrame) -> DataFrame:
    """``name, dependency``: one row per activity and thing it waits for."""
    return activities.select("name", F.explode("dependencies").alias("dependency"))


def dag_dangling(activities: DataFrame) -> DataFrame:
    """Edges whose dependency is no activity."""
    known = activities.select(F.col("name").alias("dependency"))
    return dag_edges(activities).join(known, "dependency", "left_anti").select("name", "dependency")


def dag_levels(activities: DataFrame) -> DataFrame:
    """``name, level``: 0 for an activity that waits for nothing, else one more than the highest it waits for.

    Only edges between activities others wait for are walked; the levels of all
    others, as of everything, then come from one join of the edges with the
    levels found. Up to ``EDGES_A_TASK`` such edges are settled by one task that
    counts down what each activity still waits for, so it reads an edge once however
    long the chains are. More of them are first settled level by level; a round reads and
    writes the edges still open, until so few are left.
    Dependencies that name no activity are left out; a cycle is an error.
    What is waited for is listed once, so an edge meets one row, and the edges of
    a thing that all others wait for can be split.
    """
    staged = stage(activities.select("name", "dependencies"), "dag")
    names = staged.select("name").distinct()
    known = staged.select(F.col("name").alias("dependency"))
    waited = stage(dag_edges(staged).select("dependency").distinct().join(known, "dependency", "left_semi"), "dag-waited")
    edges = stage(split_lookup(dag_edges(staged).distinct(), waited, ["dependency"]).select("name", "dependency"), "dag-edges")
    inner, walked = stage_counted(split_lookup(edges, waited.select(F.col("dependency").alias("name")), ["name"]), "dag-inner")
    levels = _walk(inner, walked)
    # What is waited for and does not itself wait has level 0 and is not in ``levels``.
    highest = (
        edges.join(levels.withColumnRenamed("name", "dependency"), "dependency", "left")
        .groupBy("name")
        .agg((F.max(F.coalesce("level", F.lit(0))) + 1).alias("level"))
    )
    return names.join(highest, "name", "left").select("name", F.coalesce("level", F.lit(0)).alias("level"))


def _walk(edges: DataFrame, left: int) -> DataFrame:
    """``name, level`` of all ``name`` in the ``left`` edges; a dependency that is no ``name`` has level 0."""
    spark, columns = edges.sparkSession, edges.columns
    rounds, level = scratch_path(spark, "dag-rounds"), 0
    while left > EDGES_A_TASK:
        level += 1
        names = edges.select("name").distinct()
        blocked = split_lookup(edges, names.withColumnRenamed("name", "dependency"), ["dependency"]).select("name").distinct()
        ready, found = stage_counted(names.join(blocked, "name", "left_anti"), path=f"{rounds}/level={level}")
        if not found:
            raise ValueError(_CYCLE)
        edges, left = stage_counted(edges.join(ready, "name", "left_anti").select(*columns), "dag-open")
    settled = spark.read.schema(_SETTLED).parquet(rounds) if level else spark.createDataFrame([], _SETTLED)
    if not left:
        return settled
    reached = settled.withColumnsRenamed({"name": "dependency", "level": "reached"})
    based = edges.join(reached, "dependency", "left") if level else edges.withColumn("reached", F.lit(None).cast("int"))
    rest, unsettled = Observation(), F.count_if(F.col("level").isNull())
    counted = based.withColumn("__all", F.lit(0)).groupBy("__all").applyInPandas(_count_down, _SETTLED).observe(rest, unsettled.alias("unsettled"))
    last = stage(counted, "dag-rest")
    if rest.get["unsettled"]:
        raise ValueError(_CYCLE)
    return settled.unionByName(last) if level else last


def _count_down(edges: pd.DataFrame) -> pd.DataFrame:
    """The level of every ``name``, null for those in or behind a cycle. ``reached``: the level of a dependency that is settled already."""
    waiting, level, followers = Counter(edges.name), dict.fromkeys(edges.name, 0), defaultdict(list)
    ready = []

    def settle(name: str, at: int) -> None:
        level[name] = max(level[name], at + 1)
        waiting[name] -= 1
        if not waiting[name]:
            ready.append(name)

    for name, dependency, reached in zip(edges.name, edges.dependency, edges.reached):
        if dependency in level:
            followers[dependency].append(name)
        else:
            settle(name, 0 if pd.isna(reached) else int(reached))
    while ready:
        done = ready.pop()
        for name in followers[done]:
            settle(name, level[done])
    found = [None if waiting[name] else at for name, at in level.items()]
    return pd.DataFrame({"name": list(level), "level": pd.array(found, dtype="Int32")})
