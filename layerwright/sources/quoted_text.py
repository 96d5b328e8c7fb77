"""Quoted text with line breaks inside quotes, read in blocks instead of file by file.

A line break ends a record only outside quotes, and a block in the middle of a file does not know whether it starts
inside. So each block first reports whether it holds an odd number of quotes; a prefix scan over the blocks of a file
then says how every block starts. With that a block cuts its own lines into records, and only the pieces at its borders
are put together with those of its neighbours.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What a row of the cut text is: a record, the beginning of one that leaves the block, or a piece of one that came in.
_WHOLE, _OPENS, _CONTINUES = 0, 1, 2


def _odd_quotes(line: Column, quote: str, escape: str) -> Column:
    """Whether a line changes sides: an odd number of quotes that no escape character stands before."""
    bare = F.regexp_replace(line, rf"(?s)\Q{escape}\E.", "")
    return F.length(F.regexp_replace(bare, rf"[^\Q{quote}\E]", "")) % 2 == 1


def read_quoted_text(spark: SparkSession, plain: DataFrame, path: str, options: dict[str, str]) -> DataFrame:
    """The rows of ``plain``, a multi-line CSV scan of ``path`` with ``options``, read in blocks of a file.

    The text is read twice, the first time for the count of quotes. Two things must hold: a field that is not quoted
    holds neither a quote nor an escape character, and records end with a line feed (a carriage return before it is
    dropped). The state of each block, one row per block, is broadcast: it must not cost the lines their order.
    Should Spark cut the files differently the second time (because executors came or went in between), the read
    fails and says so; ``spark.sql.files.minPartitionNum`` fixes the cuts.
    """
    lines = spark.read.options(lineSep="\n", basePath=path).text(path)
    inner = [field for field in plain.schema if field.name in lines.columns[1:]]
    outer = T.StructType([field for field in plain.schema if field.name not in lines.columns[1:]])
    parts = [f"part_{i}" for i in range(len(inner))]
    placed = lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        _odd_quotes(F.col("value"), options["quote"], options["escape"]).alias("odd"),
        "value",
        *[F.col(f"`{field.name}`").cast("string").alias(part) for field, part in zip(inner, parts)],
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("file", "block")
        .agg(F.sum(F.col("odd").cast("long")).alias("odd"))
        .select("file", "block", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("inside"))
    )
    moved = F.raise_error(F.lit("files were cut differently in the second pass; set spark.sql.files.minPartitionNum"))
    known = placed.join(F.broadcast(starts), ["file", "block"], "left").withColumn(
        "inside", F.coalesce("inside", moved.cast("boolean"))
    )
    texts = "".join(f", {part} string" for part in parts)
    pieces = known.mapInPandas(_cutter(parts), f"file string, block long, kind int, first boolean, text string{texts}")
    # At most two pieces a block have neighbours; what opens a record owns the pieces up to the next that does.
    borders = pieces.filter(F.col("kind") != _WHOLE)
    so_far = Window.partitionBy("file").orderBy("block", F.col("kind").desc())
    owner = F.max(F.when(F.col("kind") == _OPENS, F.col("block"))).over(so_far)
    in_order = F.array_sort(F.collect_list(F.struct("block", "text")))
    joined = (
        borders.withColumn("owner", owner)
        .groupBy("file", "owner", *parts)
        .agg(F.max("first").alias("first"), F.array_join(F.transform(in_order, lambda p: p["text"]), "\n").alias("text"))
    )
    records = pieces.filter(F.col("kind") == _WHOLE).select("first", "text", *parts).unionByName(
        joined.select("first", "text", *parts)
    )
    if options.get("header") == "true":
        records = records.filter(~F.col("first"))
    body = F.regexp_replace("text", r"\r$", "")
    schema = ", ".join(f"`{field.name.replace('`', '``')}` {field.dataType.simpleString()}" for field in outer)
    parsed = F.from_csv(body, schema, {**options, "multiLine": "true", "lineSep": "\n"})
    rows = records.filter(body != "").select(parsed.alias("row"), *parts)
    named = {field.name: F.col("row").getField(field.name) for field in outer}
    named |= {field.name: F.col(part).cast(field.dataType) for field, part in zip(inner, parts)}
    return rows.select(*[named[name].alias(name) for name in plain.columns])


def _cutter(parts: list[str]):
    """The function that cuts the lines of a task, block by block, into records and border pieces."""
    whole, opens, continues = _WHOLE, _OPENS, _CONTINUES

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        columns = ["file", "block", "kind", "first", "text", *parts]
        at, inside, held, kind, first = None, False, [], whole, False
        constants = ()

        def row(text_lines, kind, first):
            return (*at, kind, first, "\n".join(text_lines), *constants)

        for batch in batches:
            made = []
            files, blocks = batch["file"].to_numpy(), batch["block"].to_numpy()
            changes = np.flatnonzero((files[1:] != files[:-1]) | (blocks[1:] != blocks[:-1])) + 1
            for a, b in zip([0, *changes], [*changes, len(batch)]):
                if a == b:
                    continue
                if (files[a], int(blocks[a])) != at:
                    if held:
                        made.append(row(held, opens if inside and kind == whole else kind, first))
                    at, inside, held = (files[a], int(blocks[a])), bool(batch["inside"].iloc[a]), []
                    kind, first = continues if inside else whole, at[1] == 0
                    constants = tuple(batch[part].iloc[a] for part in parts)
                lines, odd = batch["value"].iloc[a:b].tolist(), batch["odd"].iloc[a:b].to_numpy(bool)
                after = np.logical_xor.accumulate(np.concatenate(([inside], odd)))
                inside = bool(after[-1])
                begin = 0
                for start in np.flatnonzero(~after[:-1]):
                    # Outside quotes a line begins a record, and ends the one before it.
                    held += lines[begin:start]
                    if held:
                        made.append(row(held, kind, first))
                        first = False
                    held, kind, begin = [], whole, start
                held += lines[begin:]
            if made:
                yield pd.DataFrame(made, columns=columns)
        if held:
            yield pd.DataFrame([row(held, opens if inside and kind == whole else kind, first)], columns=columns)

    return cut
