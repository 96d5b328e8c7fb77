"""Column helpers that several operators of this folder share."""

from __future__ import annotations

import string
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
_BLANKS = " \t\n\x0b\x0c\r"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def word_array(text: Column) -> Column:
    """The words of a text in order, lower-cased A-Z; null and blank texts have none."""
    bare = F.btrim(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(_BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE + "+"))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_key(doc_id: Column, text: Column) -> Column:
    """A digest that names a row by its id and its whole text; it is never null."""
    return F.md5(
        F.concat(
            F.coalesce(doc_id.cast("string"), F.lit("-")),
            F.when(text.isNull(), "n").otherwise("t"),
            F.coalesce(text, F.lit("")),
        ).cast("binary")
    )


def free_name(taken: list[str], name: str) -> str:
    """``name``, with underscores until no column has it in any spelling."""
    used = {column.lower() for column in taken}
    while name.lower() in used:
        name += "_"
    return name


def id_bucket(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def uniform(*values: Column) -> Column:
    """A number in [0, 1) that depends on the values only, so a lost task draws the same one again."""
    return F.shiftrightunsigned(F.xxhash64(*values), 11) / F.lit(float(1 << 53))


def small_batches(spark: SparkSession, rows: int = 256) -> None:
    """Hand Python workers few rows at a time: one text may have a hundred thousand characters."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


@contextmanager
def batch_bytes(spark: SparkSession, size: str) -> Iterator[None]:
    """Within the block, what runs hands Python workers batches of at most ``size`` bytes (or one row); afterwards as before."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        spark.conf.set(key, before)
