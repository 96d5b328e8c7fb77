"""Exact dedup by a content sort.

Sampled splitters range-partition the normalised texts, an external sort puts equal texts side by side, and the
run of equal neighbours (compared in full) keeps one identifier. Texts with more rows than a task should hold are
first cut into as many salted runs as their rows need, and the representatives of those runs meet in a second, small
pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from layerwright.llm.common import ascii_lower
from layerwright.session import stage


HEAD = 64


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    run_rows: int = 1_000,
    heavy_texts: int = 65_536,
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical after lower-casing A-Z; null counts as empty. ``keep`` is "smallest"
    or "largest" identifier. Exactly one row of a group is kept; among rows that repeat the kept identifier it is
    any one of them. Null identifiers lose against all others; a group with null identifiers only has a null
    keep_id and still keeps one row. Other columns are not read. An empty table gives an empty result.

    A text with more than ``run_rows`` rows is salted into runs of about that many, by id and task of origin, so rows
    without an id and rows that repeat one spread too. A text must also hold 1/``heavy_texts`` of all rows: so at most
    that many are salted, and their totals (one row each) are broadcast.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), ascii_lower(F.coalesce(F.col(text_col), F.lit(""))).alias("body")
    ).withColumn("h", F.xxhash64("body"))
    counts = stage(rows.groupBy("h").agg(F.count(F.lit(1)).alias("n")), "dedup-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    heavy = counts.filter((F.col("n") > run_rows) & (F.col("n") * heavy_texts >= total)).select(
        "h", F.lit(True).alias("heavy"), F.ceil(F.col("n") / run_rows).alias("salts")
    )
    # The task of origin is the same when a lost task runs again.
    spread = F.pmod(F.xxhash64("doc_id", F.spark_partition_id()), F.col("salts"))
    salted = rows.join(F.broadcast(heavy), "h", "left").select(
        "doc_id", "body", "heavy", F.when(F.col("heavy"), spread).otherwise(0).cast("int").alias("salt")
    )
    best_first = F.col("doc_id").asc_nulls_last() if keep == "smallest" else F.col("doc_id").desc_nulls_last()
    run = Window.partitionBy("head", "h", "body", "salt").orderBy(best_first)
    whole_run = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # Splitters hold the beginning of a text and its hash: what the driver samples stays small, and texts that only
    # begin alike can still be split.
    ranged = salted.withColumn("h", F.xxhash64("body")).withColumn("head", F.substring("body", 1, HEAD))
    runs = ranged.repartitionByRange("head", "h", "salt").select(
        "doc_id",
        "heavy",
        F.sha2(F.col("body").cast("binary"), 256).alias("text_sha256"),
        F.row_number().over(run).alias("place"),
        F.first("doc_id").over(whole_run).alias("run_keep"),
        F.count(F.lit(1)).over(whole_run).alias("run_size"),
        "body",
        "salt",
    )
    # Of the texts only the representatives of salted runs are still needed, for the full comparison between runs.
    runs = stage(
        runs.withColumn("body", F.when(F.col("heavy") & (F.col("place") == 1), F.col("body"))), "dedup-runs"
    )
    # Null identifiers lose; of runs that keep the same identifier one wins.
    if keep == "smallest":
        winner = F.min(F.struct(F.col("run_keep").isNull(), "run_keep", "salt"))
    else:
        winner = F.max(F.struct(F.col("run_keep").isNotNull(), "run_keep", "salt"))
    merged = (
        runs.filter(F.col("heavy") & (F.col("place") == 1))
        .groupBy("body", "text_sha256")
        .agg(winner.alias("winner"), F.sum("run_size").alias("all_size"))
        .select("text_sha256", "all_size", F.col("winner.run_keep").alias("all_keep"), F.col("winner.salt").alias("keep_salt"))
    )
    keep_id = F.when(F.col("heavy"), F.col("all_keep")).otherwise(F.col("run_keep"))
    return (
        runs.drop("body")
        .join(F.broadcast(merged), "text_sha256", "left")
        .select(
            "doc_id",
            keep_id.alias("keep_id"),
            F.when(F.col("heavy"), F.col("all_size")).otherwise(F.col("run_size")).alias("group_size"),
            ((F.col("place") == 1) & (F.col("heavy").isNull() | (F.col("salt") == F.col("keep_salt")))).alias("kept"),
            "text_sha256",
        )
    )
