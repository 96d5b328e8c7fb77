"""Main text of pages by wrapper induction.

The pages of a host that share a layout are aligned with one of them, the seed, by simple tree matching. A place whose
text is the same on nearly all pages is part of the host's template; places whose text varies are slots. Main text is what
the slots hold, but for what its elements say is a menu, an advert, a form or the like.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwright.llm.common import batch_bytes
from layerwright.llm.dom import Matcher, Page, Tree, digest
from layerwright.operators.joins import split_lookup
from layerwright.session import stage

# Pages of different main text that a constant place must be on, beside the seed; more of them inside what a page itself
# declares to be its article, where a passage may be shared for other reasons.
EVIDENCE = 2
EVIDENCE_IN_ARTICLE = 7
# Of the pages that have a constant place, so many in a hundred show the same text.
CONSTANT_PERCENT = 90
_STRUCTURE = ("html", "body", "article", "aside", "div", "footer", "form", "header", "main", "nav", "section", "table")


def host_of(url: str | None) -> str | None:
    """The host of an address in lower case, without port; null where there is none."""
    try:
        return urlsplit((url or "").strip()).hostname or None
    except ValueError:
        return None


def _layout(tree: Tree) -> int:
    """A digest of the kinds of containers a page has, whatever their number and content."""
    paths: list[str] = []
    for label, parent in zip(tree.labels, tree.parents):
        paths.append(f"{paths[parent] if parent >= 0 else ''}/{label}" if label.split(" ")[0] in _STRUCTURE else paths[parent] if parent >= 0 else "")
    return digest("\n".join(sorted(set(paths))))


def _as_rows(batch: pa.RecordBatch) -> Iterator[tuple[str | None, str]]:
    for url, html in zip(batch.column("url"), batch.column("html")):
        yield url.as_py(), html.as_py() or ""


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """host, layout, nodes, main (digest of what may be main text), tree, of pages that have a host."""
    for batch in batches:
        rows = []
        for url, html in _as_rows(batch):
            host = host_of(url)
            if host is None:
                continue
            page = Page(html)
            main = digest("\n".join(r.text for r in page.candidates()))
            rows.append((host, _layout(page.tree), len(page.tree.labels), main, page.tree.dump()))
        columns = list(zip(*rows)) or [[]] * 5
        types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["host", "layout", "nodes", "main", "tree"])


class _Matchers:
    """The matchers of the seeds a task has met, a few at a time."""

    MOST = 32

    def __init__(self):
        self._known: dict[str, Matcher] = {}

    def match(self, seed: str, tree: Tree) -> tuple[list[int], Tree]:
        matcher = self._known.get(seed)
        if matcher is None:
            if len(self._known) == self.MOST:
                self._known.clear()
            matcher = self._known[seed] = Matcher(Tree.load(seed))
        return matcher.match(tree), matcher.seed


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per seed and its runs of text, how many pages have the place and how many the same text."""
    matchers = _Matchers()
    for batch in batches:
        have, same = Counter(), Counter()
        for host, layout, seed, text in zip(*(batch.column(c).to_pylist() for c in ("host", "seed_layout", "seed", "tree"))):
            tree = Tree.load(text)
            places, seed_tree = matchers.match(seed, tree)
            for node, place in enumerate(places):
                if place >= 0 and tree.texts[node]:
                    have[host, layout, place] += 1
                    same[host, layout, place] += tree.texts[node] == seed_tree.texts[place]
        keys = list(have)
        yield pa.RecordBatch.from_pydict(
            {
                "host": pa.array([k[0] for k in keys], pa.string()),
                "seed_layout": pa.array([k[1] for k in keys], pa.int64()),
                "place": pa.array([k[2] for k in keys], pa.int32()),
                "have": pa.array([have[k] for k in keys], pa.int64()),
                "same": pa.array([same[k] for k in keys], pa.int64()),
            }
        )


def induce_wrappers(pages: DataFrame) -> DataFrame:
    """``pages``: url, html. Per host and layout: host, layout, seed (a tree), places and pages (of its constant runs of text).

    Pages of equal main text count once. A layout that too few pages share takes the seed of the host's commonest one.
    """
    spark = pages.sparkSession
    with batch_bytes(spark, "8m"):
        trees = stage(pages.mapInArrow(_trees, "host string, layout long, nodes long, main long, tree string"), "page-trees")
    distinct = trees.dropDuplicates(["host", "layout", "main"])
    distinct = stage(distinct, "page-distinct")
    layouts = distinct.groupBy("host", "layout").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("nodes", "main")).alias("first")
    )
    commonest = layouts.groupBy("host").agg(F.max(F.struct("n", "layout")).alias("commonest"))
    chosen = layouts.join(commonest, "host").select(
        "host",
        "layout",
        F.when(F.col("n") > EVIDENCE, F.col("layout")).otherwise(F.col("commonest.layout")).alias("seed_layout"),
        F.col("first.main").alias("main"),
    )
    chosen = stage(chosen, "page-layouts")
    # One seed per (host, layout): the smallest page, so that long ones are compared with few places.
    first = split_lookup(distinct, chosen.filter("layout = seed_layout").select("host", "layout", "main"), ["host", "layout", "main"])
    seeds = first.select("host", F.col("layout").alias("seed_layout"), F.col("tree").alias("seed"))
    seed_of = stage(chosen.select("host", "layout", "seed_layout").join(seeds, ["host", "seed_layout"]), "page-seeds")
    aligned = split_lookup(distinct, seed_of, ["host", "layout"]).select("host", "seed_layout", "seed", "tree")
    with batch_bytes(spark, "8m"):
        votes = stage(aligned.mapInArrow(_votes, "host string, seed_layout long, place int, have long, same long"), "page-votes")
    counts = votes.groupBy("host", "seed_layout", "place").agg(F.sum("have").alias("have"), F.sum("same").alias("same"))
    # The seed agrees with itself, which is no evidence.
    constant = counts.filter((F.col("have") > EVIDENCE) & (100 * (F.col("same") - 1) >= CONSTANT_PERCENT * (F.col("have") - 1)))
    constant = constant.groupBy("host", "seed_layout").agg(F.collect_list(F.struct("place", (F.col("have") - 1).alias("pages"))).alias("constant"))
    wrappers = seed_of.join(constant, ["host", "seed_layout"]).select(
        "host", "layout", "seed", F.col("constant.place").alias("places"), F.col("constant.pages").alias("pages")
    )
    return stage(wrappers, "page-wrappers")


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The main text of every page: id, url, text, n_chars (code points).

    A null page is empty and has an empty text, as has a page of which nothing is main text. Without an address, or on a host with too
    few different pages, the page alone decides. Null and repeated ids and repeated rows come out as they are, once each;
    copies of a page count once for the template. Blocks are joined by one space, white space inside becomes one, character
    references are decoded once. Further columns are not read.
    """
    spark = pages.sparkSession
    given = pages.select(
        F.col(f"`{id_col}`").alias(id_col), F.col(f"`{url_col}`").cast("string").alias("url"), F.col(f"`{html_col}`").alias("html")
    )
    wrappers = induce_wrappers(given.select("url", "html"))
    id_type = given.schema[id_col].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The parsed page: its tree and the runs that may be main text, packed."""
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            hosts, layouts, packed = [], [], []
            for url, html in _as_rows(batch):
                page = Page(html)
                host = host_of(url)
                runs = page.candidates()
                body = "\x1e".join([page.tree.dump() if host else ""] + [f"{r.node} {int(r.declared)} {r.text}" for r in runs])
                hosts.append(host)
                layouts.append(_layout(page.tree))
                packed.append(packer.compress(body.encode("utf-8", "surrogatepass")))
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), batch.column("url"), pa.array(hosts, pa.string()), pa.array(layouts, pa.int64()), pa.array(packed, pa.binary())],
                names=[id_col, "url", "host", "layout", "packed"],
            )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matchers, unpacker = _Matchers(), zstandard.ZstdDecompressor()
        for batch in batches:
            texts = []
            for packed, seed, places, pages in zip(*(batch.column(c).to_pylist() for c in ("packed", "seed", "places", "pages"))):
                tree, *runs = unpacker.decompress(packed).decode("utf-8", "surrogatepass").split("\x1e")
                runs = [r.split(" ", 2) for r in runs]
                if seed is not None:
                    own = Tree.load(tree)
                    at, seed_tree = matchers.match(seed, own)
                    evidence = dict(zip(places, pages))
                    runs = [
                        (node, declared, text)
                        for node, declared, text in runs
                        if evidence.get(at[int(node)], 0) < (EVIDENCE_IN_ARTICLE if declared == "1" else EVIDENCE)
                        or own.texts[int(node)] != seed_tree.texts[at[int(node)]]
                    ]
                texts.append(" ".join(text for _, _, text in runs))
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[id_col, "url", "text", "n_chars"],
            )

    parsed = given.mapInArrow(read, f"`{id_col}` {id_type}, url string, host string, layout long, packed binary")
    with_wrapper = split_lookup(parsed, wrappers, ["host", "layout"], "left")
    columns = f"`{id_col}` {id_type}, url string, text string, n_chars long"
    with batch_bytes(spark, "8m"):
        out = stage(with_wrapper.select(id_col, "url", "packed", "seed", "places", "pages").mapInArrow(write, columns), "page-texts")
    return out.withColumnRenamed("url", url_col)
