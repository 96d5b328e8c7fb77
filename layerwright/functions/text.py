"""Text functions on columns, all inside the JVM."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Iterable, Mapping
from functools import reduce
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


# Stands around hits while literals are replaced.
_MARK = "\0"
# Literals that are looked through one by one.
_LISTED = 8


def normalize_space(column: Column) -> Column:
    """Strip the ends and make every run of white space one blank."""
    return F.trim(F.regexp_replace(column, r"\s+", " "))


def full_name(first: Column, last: Column) -> Column:
    return F.concat(first, F.lit(" "), last)


def path_item(path: Column, index: int, separator: str = "|") -> Column:
    """Item ``index`` (from 0) of a separated path, NULL when the path is too short."""
    return F.get(F.split(path, re.escape(separator)), F.lit(index))


def replace_in_turn(column: Column, replacements: Mapping[str, str]) -> Column:
    """Replace literals one after the other; a later one sees what earlier ones wrote."""
    return reduce(
        lambda text, pair: F.replace(text, F.lit(pair[0]), F.lit(pair[1])), replacements.items(), column
    )


def fill_template(template: Column, values: Mapping[str, Column]) -> Column:
    """Put ``values`` in place of their ``{name}`` marks."""
    return reduce(
        lambda text, pair: F.replace(text, F.lit("{" + pair[0] + "}"), pair[1]), values.items(), template
    )


def literal_pattern(literals: Iterable[str]) -> str:
    """A regular expression for any of the literals as a tree of their beginnings.

    At one place it finds the first of them in the given order, as an alternation of all would, but a search costs the
    length of what it finds and not the number of literals. One that begins with an earlier one can never be found and is left out.
    """
    ends = object()
    root: dict = {}
    for literal in literals:
        node = root
        for char in literal:
            if ends in node:
                break
            node = node.setdefault(char, {})
        else:
            # What an earlier literal goes on with is tried first, then this one.
            node.setdefault(ends, None)

    def written(node: dict) -> str:
        branches = []
        for char, below in node.items():
            if char is ends:
                continue
            run = [char]
            while len(below) == 1 and ends not in below:
                (char, below), = below.items()
                run.append(char)
            branches.append(re.escape("".join(run)) + written(below))
        if not branches:
            return ""
        if len(branches) == 1 and ends not in node:
            return branches[0]
        return f"(?:{'|'.join(branches)})" + ("?" if ends in node else "")

    return written(root)


def _lookup(mapping: Mapping[str, str]) -> Callable[[Column], Column]:
    """The value of a key of the mapping, found among the few whose checksum falls together with the key's."""
    if len(mapping) <= _LISTED:
        listed = F.create_map(*[F.lit(part) for part in chain.from_iterable(mapping.items())])
        return lambda key: listed[key]
    buckets: list[dict[str, str]] = [{} for _ in range(len(mapping) // _LISTED + 1)]
    for key, value in mapping.items():
        buckets[zlib.crc32(key.encode()) % len(buckets)][key] = value
    tables = F.from_json(F.lit(json.dumps(buckets)), "array<map<string,string>>")
    return lambda key: F.get(tables, (F.crc32(key.cast("binary")) % len(buckets)).cast("int"))[key]


def replace_in_one_pass(column: Column, replacements: Mapping[str, str]) -> Column:
    """Replace many literals in one pass from left to right.

    Where two literals match at one place the first in the mapping wins, and
    text that was put in is not looked at again. A hit costs its length,
    however many literals there are.
    """
    if not replacements:
        return column
    if "" in replacements:
        raise ValueError("cannot replace the empty text")
    pattern = literal_pattern(replacements)
    put_for = _lookup(replacements)

    # One search: every hit is put between marks, so the odd pieces are the hits.
    marked = F.split(F.regexp_replace(column, pattern, f"{_MARK}$0{_MARK}"), _MARK, -1)
    by_marks = F.transform(marked, lambda piece, at: F.when(at % 2 == 1, put_for(piece)).otherwise(piece))

    # Text that holds the mark itself is searched twice instead: for what lies
    # between the hits and for the hits.
    found = F.regexp_extract_all(column, F.lit(pattern), F.lit(0))
    put_in = F.array_append(F.transform(found, put_for), F.lit(""))
    by_search = F.zip_with(
        F.split(column, pattern, -1), put_in, lambda before, literal: F.concat(before, literal)
    )
    return F.array_join(F.when(column.contains(_MARK), by_search).otherwise(by_marks), "")


def to_base64(column: Column) -> Column:
    """The base64 code of UTF-8 text in one line, where ``base64`` alone may break it into lines."""
    return F.translate(F.base64(F.encode(column, "UTF-8")), "\r\n", "")


def _replacement_literal(text: str) -> str:
    return text.replace("\\", "\\\\").replace("$", "\\$")


def recolor_base64(column: Column, colour: str) -> Column:
    """Set every ``fill="..."`` in base64-coded text to ``colour``; NULL when it is no UTF-8 text."""
    text = F.try_validate_utf8(F.try_to_binary(column, F.lit("base64")).cast("string"))
    filled = F.regexp_replace(text, 'fill="[^"]+"', _replacement_literal(f'fill="{colour}"'))
    return to_base64(filled)
