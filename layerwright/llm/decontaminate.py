"""Benchmark decontamination: size-partitioned MinHash containment search with exact verification.

Benchmark items are partitioned by the size of their shingle set. The upper size u of a partition and the wanted
containment t fix the length of its sketches: the k = u - ceil(t * u) + 1 smallest hashes of an item. A document
that holds a share t of an item's shingles misses at most k - 1 of them, so it holds at least one of the k
smallest: the search loses nothing, however long the document is. Documents are hashed once, looked up among
those minima, and what they hit is compared shingle by shingle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwright.llm.common import free_name, row_key, word_array
from layerwright.session import stage


def _grams(words: Column, width: int, value) -> Column:
    """``value`` of every run of ``width`` words, as an array."""
    starts = F.sequence(F.lit(0), F.size(words) - F.lit(width))
    empty = F.array()
    made = F.transform(starts, lambda i: value([F.get(words, i + F.lit(k)) for k in range(width)]))
    return F.when(F.size(words) >= width, made).otherwise(empty)


def _hashes(words: Column, width: int) -> Column:
    return _grams(words, width, lambda run: F.xxhash64(F.lit(width), *run))


def _texts(words: Column, width: int) -> Column:
    return _grams(words, width, lambda run: F.concat_ws(" ", *run))


def contaminated_pairs(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = 0.8,
    width: int = 5,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Pairs of a document and an item of whose distinct shingles it holds a share of at least ``threshold``.

    Columns: row_key (names the row by id and text), doc_id, item_id, item_shingles, shared_shingles, containment.
    Words are lower-cased A-Z; a shingle is ``width`` words. An item of fewer words is one shingle of all of
    them, and documents are searched for runs of that length. Items and documents without words match nothing.
    Rows that repeat id and text give one pair; a repeated item id is judged text by text and the best share
    counts. Null identifiers are reported as null. Other columns are not read; empty tables give no pairs.
    """
    items = (
        benchmark.select(F.col(item_col).alias("item_id"), word_array(F.col(item_text_col)).alias("words"))
        .withColumn("n", F.size("words"))
        .filter("n > 0")
        .distinct()
        .withColumn("item", F.xxhash64("item_id", "words"))
    )
    narrow = [r.n for r in items.filter(F.col("n") < width).select("n").distinct().collect()]
    widths = sorted({width, *narrow})

    def by_width(words: Column, n: Column, make) -> Column:
        cases = F.when(n >= width, make(words, width))
        for short in narrow:
            cases = cases.when(n == short, make(words, short))
        return F.array_distinct(cases)

    items = stage(
        items.select(
            "item",
            "item_id",
            by_width(F.col("words"), F.col("n"), _hashes).alias("hashes"),
            by_width(F.col("words"), F.col("n"), _texts).alias("shingles"),
        ),
        "decon-items",
    )
    # Size partitions by powers of two; u is the upper size, and a smaller item takes no more than it has.
    size = F.size("hashes")
    upper = F.pow(F.lit(2.0), F.ceil(F.log2(size.cast("double")))).cast("int")
    needed = (upper - F.ceil(F.lit(threshold) * upper - F.lit(1e-9)) + 1).cast("int")
    minima = stage(
        items.select("item", F.explode(F.slice(F.array_sort("hashes"), F.lit(1), F.least(size, needed))).alias("s")),
        "decon-minima",
    )
    bodies = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("body")
    ).withColumn("row_key", row_key(F.col("doc_id"), F.col("body")))
    words = word_array(F.col("body"))
    looked_up = bodies.select("row_key", words.alias("words")).select(
        "row_key", F.explode(F.concat(*[_hashes(F.col("words"), w) for w in widths])).alias("s")
    )
    candidates = stage(looked_up.join(minima, "s").select("row_key", "item").distinct(), "decon-candidates")
    # Of the documents that were hit, the shingles themselves are compared.
    whole = items.select("item", "item_id", "shingles", F.size("shingles").cast("long").alias("item_shingles"))
    wanted = whole.select("item", "item_id", "item_shingles", F.explode("shingles").alias("shingle"))
    held = (
        bodies.join(candidates, "row_key")
        .select("row_key", "doc_id", "item", word_array(F.col("body")).alias("words"))
        .select(
            "row_key", "doc_id", "item", F.explode(F.concat(*[_texts(F.col("words"), w) for w in widths])).alias("shingle")
        )
    )
    compared = (
        held.join(wanted, ["item", "shingle"])
        .groupBy("row_key", "doc_id", "item", "item_id", "item_shingles")
        .agg(F.count_distinct("shingle").alias("shared_shingles"))
        .withColumn("containment", F.col("shared_shingles") / F.col("item_shingles"))
        .filter(F.col("shared_shingles") >= F.ceil(F.lit(threshold) * F.col("item_shingles") - F.lit(1e-9)))
    )
    best = F.max(F.struct("containment", "shared_shingles", "item_shingles")).alias("best")
    return compared.groupBy("row_key", "doc_id", "item_id").agg(best).select(
        "row_key", "doc_id", "item_id", "best.item_shingles", "best.shared_shingles", "best.containment"
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8, width: int = 5) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns."""
    dirty = stage(contaminated_pairs(docs, benchmark, threshold, width).select("row_key").distinct(), "decon-dirty")
    key = free_name(docs.columns, "__row_key")
    marked = docs.withColumn(key, row_key(F.col("doc_id").cast("long"), F.col("text")))
    return marked.join(dirty.withColumnRenamed("row_key", key), key, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
