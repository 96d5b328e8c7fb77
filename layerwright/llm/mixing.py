"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source should come target / source size times, a number with a fraction. The whole part is
taken as it is. The fractions are rounded against each other: two documents meet, size-weighted mass moves from
one to the other at random until one fraction is 0 or 1, and the other goes on. So the words taken do not drift
however many documents there are, and each document keeps its expected number of copies. Documents meet in blocks
of bounded size; each block leaves at most one open fraction, and the open ones of all blocks meet in the next
level of a tree, until one is left for a source.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerwright.llm.common import row_key, uniform, word_count
from layerwright.operators.keys import add_dense_id
from layerwright.session import stage

BLOCK_ROWS = 256
_NEAR = 1e-12


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: float = 3.0) -> DataFrame:
    """``sizes``: source, source_size. Adds target.

    Sources by code point, null last, weigh ``weights`` repeating, and share the sum of all sizes. No target is
    above ``most`` times its source's size; what is cut off is shared again by weight. With the sources ordered by
    size per weight, the cut ones come first, and the level of the others follows from running sums. The windows
    run over one row per source, which is an aggregated list.
    """
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.lit(list(weights)), (F.pmod(F.row_number().over(in_order) - 1, F.lit(len(weights))) + 1))
    limited = sizes.withColumn("weight", weight.cast("double")).withColumn("cap", F.lit(most) * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    left_over = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    shared = limited.withColumn("level", left_over / open_weight)
    # The level that holds is the one at the first source that does not reach its cap; later ones only sink.
    final = F.max(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))).over(everything)
    return shared.withColumn("final", final).select(
        "source",
        "source_size",
        F.least(F.col("cap"), F.coalesce(F.col("final") * F.col("weight"), F.col("cap"))).alias("target"),
    )


def _snap(x: Column) -> Column:
    return F.when(x < _NEAR, F.lit(0.0)).when(x > 1 - _NEAR, F.lit(1.0)).otherwise(x)


def _meet(acc: Column, unit: Column, seed: int) -> Column:
    """One step of the fold: the carried unit and the next one exchange mass; what is whole goes to ``out``."""
    wa, xa, wb, xb = acc["weight"], acc["x"], unit["weight"], unit["x"]
    a_up, a_down, b_up, b_down = (1 - xa) * wa, xa * wa, (1 - xb) * wb, xb * wb
    up, down = F.least(a_up, b_down), F.least(a_down, b_up)
    rises = uniform(F.lit(seed), acc["tie"], unit["tie"]) * (up + down) < down
    new_a = F.when(rises, F.when(a_up <= b_down, F.lit(1.0)).otherwise(xa + up / wa)).otherwise(
        F.when(a_down <= b_up, F.lit(0.0)).otherwise(xa - down / wa)
    )
    new_b = F.when(rises, F.when(b_down <= a_up, F.lit(0.0)).otherwise(xb - up / wb)).otherwise(
        F.when(b_up <= a_down, F.lit(1.0)).otherwise(xb + down / wb)
    )

    def entry(place: Column, x: Column) -> Column:
        return F.struct(place.alias("place"), x.cast("int").alias("more"))

    def settle(pair: Column) -> Column:
        a, b = pair["a"], pair["b"]
        a_open, b_open = (a > 0) & (a < 1), (b > 0) & (b < 1)
        out = F.when(a_open & b_open, acc["out"]).when(
            a_open, F.concat(acc["out"], F.array(entry(unit["place"], b)))
        )
        out = out.when(b_open, F.concat(acc["out"], F.array(entry(acc["place"], a)))).otherwise(
            F.concat(acc["out"], F.array(entry(acc["place"], a), entry(unit["place"], b)))
        )
        keeps_a = a_open
        return F.struct(
            F.when(keeps_a, acc["place"]).when(b_open, unit["place"]).otherwise(F.lit(-1)).alias("place"),
            F.when(keeps_a, acc["tie"]).otherwise(unit["tie"]).alias("tie"),
            F.when(keeps_a, wa).otherwise(wb).alias("weight"),
            F.when(keeps_a, a).otherwise(b).alias("x"),
            out.alias("out"),
        )

    met = F.transform(F.array(F.struct(_snap(new_a).alias("a"), _snap(new_b).alias("b"))), settle)[0]
    first = F.struct(
        unit["place"].alias("place"),
        unit["tie"].alias("tie"),
        wb.alias("weight"),
        xb.alias("x"),
        acc["out"].alias("out"),
    )
    return F.when(acc["place"] < 0, first).otherwise(met)


def _fold(units: Column, seed: int) -> Column:
    numbered = F.transform(
        F.array_sort(units),
        lambda u, i: F.struct(i.alias("place"), u["tie"].alias("tie"), u["weight"].alias("weight"), u["x"].alias("x")),
    )
    start = F.struct(
        F.lit(-1).alias("place"),
        F.lit(0).cast("long").alias("tie"),
        F.lit(0.0).alias("weight"),
        F.lit(0.0).alias("x"),
        F.array().cast("array<struct<place:int,more:int>>").alias("out"),
    )
    return F.aggregate(numbered, start, lambda acc, unit: _meet(acc, unit, seed))


def pivotal_rounding(units: DataFrame, group: str, seed: int = 7, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``units``: key, ``group``, weight (double, above 0), x (double in (0, 1)). Returns key, ``group``, more (0 or 1).

    The sum of weight * more in a group differs from the sum of weight * x by at most half a weight.
    ``key`` is distinct. Blocks hold about ``block_rows`` units, whatever the size of the group.
    """
    settled, level, current = [], 0, units.withColumn("tie", F.xxhash64(F.lit(seed), "key"))
    while True:
        blocks = (
            current.groupBy(group)
            .agg(F.ceil(F.count(F.lit(1)) / F.lit(block_rows)).alias("blocks"))
            .withColumnRenamed(group, "grouped")
        )
        blocks = stage(blocks, "mix-blocks")
        largest = blocks.agg(F.max("blocks")).first()[0] or 0
        dealt = current.join(blocks, F.col(group).eqNullSafe(F.col("grouped"))).withColumn(
            "block", F.pmod(F.xxhash64(F.lit(seed + level), "tie"), F.col("blocks"))
        )
        unit = F.struct("tie", "key", "weight", "x")
        folded = (
            dealt.groupBy(group, "block")
            .agg(F.array_sort(F.collect_list(unit)).alias("units"))
            .withColumn("fold", _fold(F.col("units"), seed + level))
        )
        folded = stage(folded.select(group, "units", "fold.place", "fold.x", "fold.out"), f"mix-level-{level}")
        settled.append(
            folded.select(group, "units", F.explode("out").alias("o")).select(
                F.get("units", F.col("o.place"))["key"].alias("key"), group, F.col("o.more").alias("more")
            )
        )
        left = F.get("units", F.col("place"))
        current = folded.filter("place >= 0").select(
            group, left["tie"].alias("tie"), left["key"].alias("key"), left["weight"].alias("weight"), "x"
        )
        if largest <= 1:
            break
        level += 1
    # What is left is one unit a group: the nearer whole number keeps the group's sum within half of its weight.
    last = current.select("key", group, (F.col("x") >= 0.5).cast("int").alias("more"))
    return reduce(DataFrame.unionByName, [*settled, last])


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = (5, 2, 1),
    most: float = 3.0,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """How often each document is taken: row_key, doc_id, source, size, source_size, target, copies, repeats, more.

    Size is the number of words (null text: 0). A row per distinct (id, text, source); ``repeats`` says how often
    it is there. Each of these rows is taken ``copies`` times and ``more`` of them once more, 0 to ``most`` times in all
    and the same in every run. So only a part of one of them is left to chance, however often it is there. Documents without words weigh nothing: they take the whole part of their share. A null
    source is a source of its own and comes last. Other columns are not read; an empty table gives an empty result.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).alias("source"),
        row_key(F.col(id_col).cast("long"), F.col(text_col)).alias("row_key"),
        word_count(F.col(text_col)).alias("size"),
    )
    units = stage(
        rows.groupBy("row_key", "doc_id", "source", "size").agg(F.count(F.lit(1)).alias("repeats")), "mix-units"
    )
    sizes = units.groupBy("source").agg(F.sum(F.col("size") * F.col("repeats")).alias("source_size"))
    targets = stage(source_targets(sizes, weights, most), "mix-targets").withColumnRenamed("source", "of_source")
    share = F.when(F.col("source_size") > 0, F.least(F.lit(most), F.col("target") / F.col("source_size"))).otherwise(0.0)
    shared = (
        units.join(targets, F.col("source").eqNullSafe(F.col("of_source")))
        .drop("of_source")
        .withColumn("share", share)
        .withColumn("whole", F.floor("share").cast("int"))
        # What all repeats together are due beyond the whole copies, in copies: as many whole ones, and the rest is rounded.
        .withColumn("due", F.when(F.col("size") > 0, (F.col("share") - F.col("whole")) * F.col("repeats")).otherwise(0.0))
        .withColumn("sure", F.floor(F.col("due") + F.lit(_NEAR)))
        .withColumn("x", F.col("due") - F.col("sure"))
    )
    key = F.struct("row_key", "source").alias("key")
    rounded = pivotal_rounding(
        shared.filter(F.col("x") > _NEAR).select(key, "source", F.col("size").cast("double").alias("weight"), "x"),
        "source",
        seed,
    ).select(F.col("key.row_key").alias("row_key"), F.col("key.source").alias("of_source"), "more")
    return shared.alias("s").join(
        rounded.alias("r"),
        (F.col("s.row_key") == F.col("r.row_key")) & F.col("s.source").eqNullSafe(F.col("r.of_source")),
        "left",
    ).select(
        "s.row_key",
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        F.col("whole").alias("copies"),
        "repeats",
        (F.col("sure") + F.coalesce(F.col("r.more"), F.lit(0))).cast("long").alias("more"),
    )


def apply_mix(docs: DataFrame, **settings) -> DataFrame:
    """The mixed documents with all their columns: each row as often as it is taken.

    Of rows with equal id, text and source the first ones, by all columns, are those that are taken once more.
    """
    taken = stage(
        mix_sources(docs, **settings)
        .filter("copies + more > 0")
        .select("row_key", F.col("source").alias("of_source"), "copies", "more", "repeats"),
        "mix-taken",
    )
    # The columns of a document travel in a struct, so that none can clash with those of the mix.
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        row_key(F.col("doc_id").cast("long"), F.col("text")).alias("row_key"),
        "source",
    )

    def with_copies(some: DataFrame) -> DataFrame:
        return keyed.join(some, (keyed["row_key"] == some["row_key"]) & keyed["source"].eqNullSafe(some["of_source"])).select(
            "row", keyed["row_key"], "source", "copies", "more"
        )

    once = with_copies(taken.filter("repeats = 1")).select("row", (F.col("copies") + F.col("more")).alias("copies"))
    # Numbered by a range sort, which cuts rows of one key too, so that a row repeated without end is no single task's.
    numbered = stage(add_dense_id(with_copies(taken.filter("repeats > 1")), ["row_key", "source"], "number"), "mix-repeated")
    firsts = numbered.groupBy(F.col("row_key").alias("of_key"), F.col("source").alias("of_source")).agg(F.min("number").alias("first"))
    ranked = numbered.join(firsts, (F.col("row_key") == F.col("of_key")) & F.col("source").eqNullSafe(F.col("of_source")))
    one_more = (F.col("number") - F.col("first") < F.col("more")).cast("int")
    often = ranked.select("row", (F.col("copies") + one_more).cast("long").alias("copies")).filter("copies > 0")
    return once.unionByName(often).select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")
