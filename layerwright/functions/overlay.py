"""Merging a child JSON document over a parent, key by key, in one Arrow function per row and without a shuffle.

A JSON document has no depth known beforehand, and a column expression has to be as deep as the deepest document. So
this is one of the few places for Python: an expression of five levels took five times as long for the same rows.
"""

from __future__ import annotations

import json
import re
import sys
from typing import Any

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Executors get the merge with the query; they need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The directive key and what it may say.
DIRECTIVE = "merge_type"
KEEP_PARENT = 0
REPLACE = 1
COMBINE_LISTS = 2

# Levels of nesting; a document beyond them is refused, not cut.
DEEPEST = 5000
_SURROGATE = re.compile("[\ud800-\udfff]")


class _Number(str):
    """A number as it is spelled."""


def _no_number(text: str) -> None:
    raise ValueError(f"malformed JSON: {text} is no JSON value")


def _parsed(text: str | None) -> Any:
    if text is None:
        return None
    try:
        return json.loads(text, parse_int=_Number, parse_float=_Number, parse_constant=_no_number)
    except json.JSONDecodeError as error:
        raise ValueError(f"malformed JSON: {error.msg} at {error.pos}") from None
    except RecursionError:
        raise ValueError(f"JSON is nested deeper than {DEEPEST} levels") from None


def _string(text: str) -> str:
    return json.dumps(text, ensure_ascii=_SURROGATE.search(text) is not None)


def _text(value: Any, compared: bool = False) -> str:
    """JSON text. ``compared``: equal for equal values, whatever the order of keys and the spelling of fractions."""
    if isinstance(value, _Number):
        return repr(float(value)) if compared and not value.lstrip("-").isdigit() else str(value)
    if isinstance(value, str):
        return _string(value)
    if isinstance(value, list):
        return "[" + ",".join([_text(item, compared) for item in value]) + "]"
    if isinstance(value, dict):
        keys = sorted(value) if compared else value
        return "{" + ",".join([f"{_string(key)}:{_text(value[key], compared)}" for key in keys]) + "}"
    return json.dumps(value)


def _policy(said: Any) -> Any:
    """A directive's value as it compares with a policy: 0.0 is 0."""
    return float(said) if isinstance(said, _Number) else None if isinstance(said, str) else said


def _decided(parent: Any, child: Any, policy: Any) -> Any:
    if isinstance(parent, dict) and isinstance(child, dict):
        return _merged(parent, child, policy)
    if policy == KEEP_PARENT:
        return parent
    if policy == COMBINE_LISTS and isinstance(parent, list) and isinstance(child, list):
        return list({_text(item, compared=True): item for item in parent + child}.values())
    return child


def _merged(parent: dict, child: dict, inherited: Any) -> dict:
    policy = _policy(child[DIRECTIVE]) if DIRECTIVE in child else inherited
    changed = {key: _decided(parent.get(key), value, policy) for key, value in child.items() if key != DIRECTIVE}
    return {**parent, **changed}


def _overlaid(parent: str | None, child: str | None, policy: int) -> str:
    ours, theirs = _parsed(parent), _parsed(child)
    if isinstance(ours, dict) and isinstance(theirs, dict):
        return _text(_merged(ours, theirs, policy))
    return _text(ours if policy == KEEP_PARENT else theirs)


def merge_overlay(df: DataFrame, parent: str, child: str, out: str, policy: int = REPLACE) -> DataFrame:
    """``df`` with ``out``: JSON text in column ``child`` merged over JSON text in column ``parent``.

    Policy 0 keeps the parent's value (a key only the child has becomes null),
    1 takes the child's, 2 is 1 with lists put together and made distinct. The
    child's ``merge_type`` key sets the policy for its object and what lies
    below. Keys stand in the parent's order, then the child's; of a key that an
    object repeats the last value counts. Numbers keep their spelling. A NULL
    document counts as JSON ``null``. Malformed JSON, and more than ``DEEPEST``
    levels, are errors.
    """

    @F.pandas_udf("string")
    def merge(parents: pd.Series, children: pd.Series) -> pd.Series:
        # The merge and the printing go one level down per call.
        before = sys.getrecursionlimit()
        sys.setrecursionlimit(max(before, 10 * DEEPEST))
        try:
            return pd.Series([_overlaid(p, c, policy) for p, c in zip(parents, children)], dtype=object)
        finally:
            sys.setrecursionlimit(before)

    return df.withColumn(out, merge(F.col(f"`{parent}`"), F.col(f"`{child}`")))
