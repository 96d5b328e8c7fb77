"""Sharding by vector bin packing.

Groups of equal texts are vectors (bytes, tokens, rows). A group goes to the bin whose residual capacity has the
highest dot product with it. One greedy run over all groups would be one task, so they are packed as a tree: each
task packs the groups of one hash bucket into some hundred bins of graded capacity, those bins are the vectors of
the next level, and when few enough are left a last task packs them into the shards, large ones first.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from layerwright.llm.common import row_key, word_count
from layerwright.operators.joins import split_lookup
from layerwright.session import stage

BUCKET_UNITS = 8192
BUCKET_BINS = 256
ROOT_UNITS = 16384
SLOT_BLOCK = 20_000


def pack(vectors: np.ndarray, capacity: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The bin of each vector: in ``order``, each to the bin with the highest dot product with what it has left.

    Every dimension is scaled by its total, so all count alike. ``capacity`` is each bin's share of the total.
    """
    totals = vectors.sum(axis=0)
    scaled = vectors / np.where(totals > 0, totals, 1)
    residual = np.repeat(capacity[:, None], vectors.shape[1], axis=1)
    placed = np.empty(len(vectors), np.int32)
    for i in order:
        chosen = int(np.argmax(residual @ scaled[i]))
        placed[i] = chosen
        residual[chosen] -= scaled[i]
    return placed


def _pack_bucket(frame: pd.DataFrame, capacity: np.ndarray) -> pd.DataFrame:
    vectors = frame[["bytes", "tokens", "rows"]].to_numpy(np.float64)
    largest = (vectors / np.maximum(vectors.sum(axis=0), 1)).max(axis=1)
    order = np.lexsort((frame.unit.to_numpy(), -largest))
    return frame.assign(bin=pack(vectors, capacity, order))[["unit", "bucket", "bin"]]


def _packed(units: DataFrame, capacity: np.ndarray) -> DataFrame:
    return units.groupBy("bucket").applyInPandas(
        lambda frame: _pack_bucket(frame, capacity), "unit string, bucket long, bin int"
    )


def assign_shards(units: DataFrame, shards: int) -> DataFrame:
    """``units``: unit (distinct text), bytes, tokens, rows (longs). Returns unit, shard."""
    maps, current, count = [], units, units.count()
    # Bins of rising capacity: the next level places the large ones first and evens out with the small ones.
    graded = np.arange(1, BUCKET_BINS + 1) / np.arange(1, BUCKET_BINS + 1).sum()
    while count > ROOT_UNITS:
        buckets = -(-count // BUCKET_UNITS)
        dealt = current.withColumn("bucket", F.pmod(F.xxhash64(F.lit(len(maps)), "unit"), F.lit(buckets)))
        packed = _packed(dealt, graded)
        into = F.concat_ws("-", F.lit(len(maps)), "bucket", "bin")
        maps.append(stage(packed.select("unit", into.alias("into")), "shard-level"))
        current = stage(
            current.join(maps[-1], "unit")
            .groupBy(F.col("into").alias("unit"))
            .agg(*[F.sum(c).alias(c) for c in ("bytes", "tokens", "rows")]),
            "shard-units",
        )
        count = current.count()
    # At most ROOT_UNITS rows meet in this one task, whatever the size of the input.
    found = stage(
        _packed(current.withColumn("bucket", F.lit(0).cast("long")), np.full(shards, 1 / shards)).select("unit", F.col("bin").alias("shard")),
        "shard-root",
    )
    for level in reversed(maps):
        found = level.join(found.withColumnRenamed("unit", "into"), "into").select("unit", "shard")
    return found


def shard_documents(
    docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: row_key, doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Size is the UTF-8 bytes of the text (null: none) plus 1. The law is ``bytes``: the shards' sizes come near
    equal, with tokens (words) and rows balanced beside them. Equal texts (null counts as empty) share a shard.
    Only a group that alone outweighs a shard, in bytes or in rows, cannot: it is cut by a hash of the row into
    pieces of a quarter of a shard, and each piece stays whole. There are at most 2 * ``shards`` such groups, so
    they are broadcast. Slots count from 0 without a gap in each shard; grown_shard is null, as the law wants.
    Rows that are equal in id and text may swap slots. Other columns are not read; an empty table gives none.
    """
    body = F.col(text_col)
    rows = stage(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            row_key(F.col(id_col).cast("long"), body).alias("row_key"),
            F.md5(F.coalesce(body, F.lit("")).cast("binary")).alias("text_key"),
            (F.coalesce(F.octet_length(body), F.lit(0)) + 1).cast("long").alias("size"),
            word_count(body).alias("tokens"),
            F.crc32(F.coalesce(body, F.lit("")).cast("binary")).alias("text_crc32"),
        ),
        "shard-rows",
    )
    sums = [F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")]
    groups = stage(rows.groupBy("text_key").agg(*sums), "shard-groups")
    total = groups.agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")).first()
    part = F.greatest(F.col("bytes") / F.lit(total.bytes or 1), F.col("rows") / F.lit(total.rows or 1))
    too_large = groups.filter(part > F.lit(1.0 / shards)).select(
        "text_key", F.ceil(part * F.lit(4 * shards)).alias("pieces")
    )
    keyed = rows.join(F.broadcast(too_large), "text_key", "left").withColumn(
        "unit",
        F.when(
            F.col("pieces").isNotNull(), F.concat_ws("/", "text_key", F.pmod(F.xxhash64("row_key"), F.col("pieces")))
        ).otherwise(F.col("text_key")),
    )
    units = stage(keyed.groupBy("unit").agg(*sums), "shard-units")
    placed = split_lookup(keyed, assign_shards(units, shards), ["unit"])

    # Slots: rows are dealt to blocks by hash, counted by block, and numbered within their block.
    blocks = max(1, -(-(total.rows or 0) // SLOT_BLOCK))
    blocked = stage(
        placed.select(
            "row_key",
            "doc_id",
            "size",
            "text_crc32",
            "shard",
            F.pmod(F.xxhash64("row_key"), F.lit(blocks)).alias("block"),
        ),
        "shard-blocks",
    )
    here = ["shard", "block"]
    earlier = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        blocked.groupBy(*here)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(*here, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    )
    inside = Window.partitionBy(*here).orderBy("doc_id", "row_key")
    return (
        blocked.withColumn("place", F.row_number().over(inside))
        .join(offsets, here)
        .select(
            "row_key",
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("before") + F.col("place") - 1).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )

