"""Trees kept as rows of nodes with their parent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from layerwright.session import scratch_path, stage, stage_counted

# The separator of paths, and the title whose branch is left out.
SEPARATOR = "|"
SKIPPED_TITLE = "Overview"


def tree_flatten(
    nodes: DataFrame, skipped_title: str = SKIPPED_TITLE, separator: str = SEPARATOR
) -> DataFrame:
    """``path, title, href, depth, sort_key`` of every node with an ``href``, from ``id, parent_id, ord, title, href``.

    ``path`` holds the titles above the node, each with the separator before it.
    A node titled ``skipped_title`` is left out with all below it; one without
    ``href`` gives no row but stands in the paths below. ``sort_key`` orders the
    rows depth first.

    Only nodes that have children are walked. Each holds the path from an
    ancestor down to itself and looks that ancestor up, which doubles the path: a
    tree of 1,000 levels takes ten rounds. Nodes whose path is whole are written once and only looked up after that.
    The leaves, which are most of a tree, are read twice in all: to find who their
    parents are, and to meet their parents' paths. An ancestor with very many nodes below it is a skewed
    key of a join, which AQE splits. Nodes whose parent is not there, and nodes on or below a cycle, are an
    error; ``tree_dangling`` lists the former.
    """
    every = stage(
        nodes.select(
            "id",
            "parent_id",
            F.col("ord").cast("bigint").alias("ord"),
            "title",
            "href",
            F.col("title").eqNullSafe(skipped_title).alias("skipped"),
        ),
        "tree",
    )
    parents, n_parents = stage_counted(
        every.where("parent_id IS NOT NULL").select(F.col("parent_id").alias("id")).distinct(), "tree-parents"
    )
    inner, n_inner = stage_counted(
        every.join(parents, "id", "left_semi").select("id", "parent_id", "ord", "title", "skipped"), "tree-inner"
    )
    if n_inner != n_parents:
        raise ValueError(f"{n_parents} parents are named, {n_inner} nodes are there for them: one is missing or there twice")

    # Branches that are skipped are walked too, so that what no root reaches can be told from them.
    walked = _whole_paths(
        inner.select(
            "id",
            F.col("parent_id").alias("up"),
            F.concat(F.lit(separator), "title").alias("path"),
            F.array("ord").alias("sort_key"),
            F.col("skipped").alias("hidden"),
        )
    )
    above = walked.where("NOT hidden").select(F.col("id").alias("parent_id"), "path", "sort_key")
    linked = every.where("href IS NOT NULL AND NOT skipped")
    roots = linked.where("parent_id IS NULL").select(
        F.lit("").alias("path"), "title", "href", F.lit(0).alias("depth"), F.array("ord").alias("sort_key")
    )
    others = linked.join(above, "parent_id").select(
        "path", "title", "href", F.size("sort_key").alias("depth"), F.array_append("sort_key", F.col("ord")).alias("sort_key")
    )
    return roots.unionByName(others)


def _whole_paths(nodes: DataFrame) -> DataFrame:
    """``id, path, sort_key, hidden`` from the root down, of nodes that know them from below ``up`` down.

    A round puts what is known of a node's ``up`` before what is known of the node. A node of a tree that
    is twice as deep as those already whole is whole after the next round, so a round
    that leaves as many open ones as before has met a cycle.
    """
    columns = ["id", "up", "path", "sort_key", "hidden"]
    whole, open_ones = nodes.where("up IS NULL"), nodes.where("up IS NOT NULL")
    n_open = open_ones.count()
    while n_open:
        known = whole.unionByName(open_ones).select(*[F.col(name).alias(f"their_{name}") for name in columns])
        longer = open_ones.join(known, F.col("up") == F.col("their_id")).select(
            "id",
            F.col("their_up").alias("up"),
            F.concat("their_path", "path").alias("path"),
            F.concat("their_sort_key", "sort_key").alias("sort_key"),
            (F.col("their_hidden") | F.col("hidden")).alias("hidden"),
        )
        seen = Observation()
        staged = stage(longer.observe(seen, F.count("up").alias("open")), "tree-paths")
        if seen.get["open"] == n_open:
            raise ValueError(f"{n_open} nodes with children are on a cycle or below one")
        n_open = seen.get["open"]
        whole, open_ones = whole.unionByName(staged.where("up IS NULL")), staged.where("up IS NOT NULL")
    return whole


def tree_dangling(nodes: DataFrame) -> DataFrame:
    """The nodes whose parent is no node."""
    known = nodes.select(F.col("id").alias("parent_id")).distinct()
    return nodes.where("parent_id IS NOT NULL").join(known, "parent_id", "left_anti").select(*nodes.columns)


def _list_at(document: Column, name: str) -> Column:
    """The list a variant holds under ``name``; NULL if there is nothing or null, an error if there is something else."""
    path = f"$.{name}"
    found, something = F.try_variant_get(document, path, "array<variant>"), F.try_variant_get(document, path, "variant")
    wrong = something.isNotNull() & ~F.is_variant_null(something) & found.isNull()
    message = F.lit(f"{name} of a table of contents is no list")
    return F.when(wrong, F.raise_error(message).cast("array<variant>")).otherwise(found)


def toc_nodes(documents: DataFrame, document: str, key: str) -> DataFrame:
    """``id, parent_id, ord, title, href`` of tables of contents kept as JSON, a variant in column ``document``.

    A document holds ``items``, an item its ``toc_title`` and maybe ``href`` and
    ``children``. Ids are the text in column ``key``, one per document, and the
    places on the way down; a document without items has no nodes, an item
    without a title, and items or children that are no list, are errors. The documents are opened level by level, as
    deep as they go; each level is staged with only the children it still has.
    """
    spark = documents.sparkSession
    levels = scratch_path(spark, "toc-levels")
    opened = documents.select(
        F.col(key).cast("string").alias("above"),
        F.lit(None).cast("string").alias("parent_id"),
        _list_at(F.col(document), "items").alias("items"),
    )
    depth = 0
    while True:
        item = F.col("item")
        level = opened.select("above", "parent_id", F.posexplode("items").alias("place", "item")).select(
            F.concat("above", F.lit("/"), "place").alias("id"),
            "parent_id",
            F.col("place").cast("bigint").alias("ord"),
            F.coalesce(
                F.try_variant_get(item, "$.toc_title", "string"),
                F.raise_error(F.lit("an item of a table of contents has no toc_title")).cast("string"),
            ).alias("title"),
            F.try_variant_get(item, "$.href", "string").alias("href"),
            _list_at(item, "children").alias("items"),
        )
        level, found = stage_counted(level, path=f"{levels}/depth={depth}")
        if not found:
            break
        depth += 1
        opened = level.where(F.size("items") > 0).select(
            F.col("id").alias("above"), F.col("id").alias("parent_id"), "items"
        )
    return spark.read.schema(level.schema).parquet(levels).select("id", "parent_id", "ord", "title", "href")
