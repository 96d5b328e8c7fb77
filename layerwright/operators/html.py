"""Facts from page HTML."""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Mapping
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Executors get the parser with the query; they need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: elements that have no end tag.
VOID_ELEMENTS = frozenset(
    "area base br col embed hr img input keygen link menuitem meta param source track wbr"
    " basefont bgsound command frame image isindex nextid spacer".split()
)
# Fixed value: elements whose text is not page text.
HIDDEN_TEXT = frozenset({"script", "style", "template"})

NOT_AVAILABLE = "N/A"

PAIRS_TYPE = T.ArrayType(T.StructType().add("key", "string").add("value", "string"))


class _TableAfterAnchor(HTMLParser):
    """Collects the first two cells of each body row in the first table after the element with id ``anchor``."""

    def __init__(self, anchor: str):
        super().__init__(convert_charrefs=True)
        self.anchor = anchor
        self.stage = "anchor"
        self.open: list[tuple[str, list | None]] = []
        self.n_open: Counter[str] = Counter()
        self.rows: list[list[list[str]]] = []
        self.text: list[str] = []

    def _end_text(self) -> None:
        text = "".join(self.text).strip()
        self.text.clear()
        if self.stage != "rows" or not text or (self.open and self.open[-1][0] in HIDDEN_TEXT):
            return
        for tag, cell in self.open:
            if tag == "td" and cell is not None:
                cell.append(text)

    def handle_starttag(self, tag, attrs):
        self._end_text()
        content = None
        if self.stage == "anchor":
            if dict(attrs).get("id") == self.anchor:
                self.stage = "table"
        elif self.stage == "table" and tag == "table":
            self.stage = "body"
            content = []
        elif self.stage == "body" and tag == "tbody":
            self.stage = "rows"
            content = []
        elif self.stage == "rows" and tag == "tr":
            content = []
            self.rows.append(content)
        elif self.stage == "rows" and tag == "td":
            content = []
            for open_tag, row in self.open:
                if open_tag == "tr" and row is not None:
                    row.append(content)
        if tag not in VOID_ELEMENTS:
            self.open.append((tag, content))
            self.n_open[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_ELEMENTS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self._end_text()
        while self.n_open[tag]:
            closed, content = self.open.pop()
            self.n_open[closed] -= 1
            ends_body = self.stage == "rows" and closed == "tbody" and content is not None
            ends_table = self.stage == "body" and closed == "table" and content is not None
            if ends_body or ends_table:
                self.stage = "done"
            if closed == tag:
                return

    def handle_data(self, data):
        self.text.append(data)

    def handle_comment(self, data):
        self._end_text()

    def handle_decl(self, decl):
        self._end_text()

    def handle_pi(self, data):
        self._end_text()

    def unknown_decl(self, data):
        self._end_text()

    def pairs(self) -> list[dict[str, str]]:
        return [{"key": "".join(row[0]), "value": "".join(row[1])} for row in self.rows if len(row) > 1]


def _pairs_after_anchor(page: str | None, anchor: str) -> list[dict[str, str]] | None:
    if page is None:
        return None
    parser = _TableAfterAnchor(anchor)
    parser.feed(page)
    parser.close()
    parser._end_text()
    return None if parser.stage == "anchor" else parser.pairs()


def table_pairs(page: Column, anchor: str) -> Column:
    """Key/value pairs of the table after the element with id ``anchor``; NULL when there is no such element.

    Pages that cannot hold the id stay in the JVM: only those with its text, or
    with a character reference inside an ``id``, are sent to the parser.
    """

    @F.pandas_udf(PAIRS_TYPE)
    def parse(pages: pd.Series) -> pd.Series:
        return pages.map(lambda text: _pairs_after_anchor(text, anchor))

    may_hold_it = page.contains(anchor) | page.rlike(r"(?i)\bid\s*=[^>]*&")
    return parse(F.when(may_hold_it, page))


def last_value(pairs: Column, key: str) -> Column:
    """The value of the last pair with ``key``; NULL when there is none."""
    return F.try_element_at(F.filter(pairs, lambda pair: pair["key"] == key), F.lit(-1))["value"]


def html_table_extract(df: DataFrame, page: str, anchor: str, names: Mapping[str, str]) -> DataFrame:
    """``df`` without its page, with one column for each ``output: key`` of the table after ``anchor``.

    ``N/A`` when the page has no such element, NULL when the table lacks the key.
    """
    parsed = df.withColumn("__pairs", table_pairs(F.col(page), anchor)).drop(page)
    found = {
        name: F.when(F.col("__pairs").isNull(), NOT_AVAILABLE).otherwise(last_value(F.col("__pairs"), key))
        for name, key in names.items()
    }
    return parsed.withColumns(found).drop("__pairs")


def html_table_rows(df: DataFrame, page: str, anchor: str) -> DataFrame:
    """``df`` without its page, one row per pair: ``position, key, value``."""
    kept = [name for name in df.columns if name != page]
    parsed = df.select(*kept, F.posexplode(table_pairs(F.col(page), anchor)).alias("position", "__pair"))
    return parsed.select(*kept, "position", "__pair.key", "__pair.value")


def html_field_extract(df: DataFrame, page: str, anchor: str) -> DataFrame:
    """``df`` without its page, with ``title``, ``n_links``, ``has_anchor`` by pattern."""
    html = F.col(page)
    title = F.regexp_extract(html, "(?is)<title>(.*?)</title>", 1)
    fields = {
        "title": F.when(title == "", NOT_AVAILABLE).otherwise(title),
        "n_links": F.regexp_count(html, F.lit("(?i)<a ")).cast("bigint"),
        "has_anchor": html.contains(f'id="{anchor}"'),
    }
    return df.withColumns(fields).drop(page)
