"""Replacement of tokens in texts by a table of replacements."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwright.operators.joins import split_lookup
from layerwright.session import stage


def replace_from_table(
    df: DataFrame, text: str, mapping: DataFrame, token_pattern: str, key: str = "key", value: str = "value"
) -> DataFrame:
    """``df`` with the tokens in column ``text`` that ``mapping`` (``key, value``) holds replaced by their value.

    A token is what ``token_pattern`` finds from left to right (an id, say). The
    tokens go to the mapping as rows of a join, so it may be of any size, and a
    token that is in very many texts is split over tasks. Only texts that hold a
    token are staged and joined again; the others stay where they are.

    A token the mapping lacks, or has no value for, stays; what was put in is not
    looked at again. One key with two values is an error.
    """
    if re.search(token_pattern, ""):
        raise ValueError("the token pattern must not match the empty text")
    column, pattern = F.col(text), F.lit(token_pattern)
    holds_token = F.coalesce(column.rlike(token_pattern), F.lit(False))
    hit = stage(df.where(holds_token).withColumn("__row", F.monotonically_increasing_id()), "replace-hit")

    one_value = F.when(F.min(value) == F.max(value), F.min(value)).when(
        F.count(value) > 0, F.raise_error(F.lit("a key has two values")).cast("string")
    )
    values = mapping.groupBy(F.col(key).alias("__token")).agg(one_value.alias("__value"))
    tokens = hit.select("__row", F.posexplode(F.regexp_extract_all(column, pattern, F.lit(0))).alias("__place", "__token"))
    put_in = (
        split_lookup(tokens, values, ["__token"], "left")
        .groupBy("__row")
        .agg(
            F.array_sort(F.collect_list(F.struct("__place", F.coalesce("__value", "__token").alias("put")))).alias("__put"),
            F.count("__value").alias("__found"),
        )
        .where("__found > 0")
        .select("__row", F.col("__put.put").alias("__put"))
    )
    pieces = F.zip_with(
        F.split(column, token_pattern, -1), F.array_append("__put", F.lit("")), lambda before, put: F.concat(before, put)
    )
    changed = hit.join(put_in, "__row", "left").withColumn(
        text, F.when(F.col("__put").isNull(), column).otherwise(F.array_join(pieces, ""))
    )
    return changed.select(*df.columns).unionByName(df.where(~holds_token))
