"""Pages as trees of blocks: a lenient parser, marks for what is no main text, and simple tree matching."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field
from html import unescape

import numpy as np

# HTML's own classes of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe xmp noembed noframes".split())
BLOCKS = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table caption thead tbody tfoot tr td"
    " th ul head select option optgroup button object canvas svg video audio".split()
)
ENDS_P = BLOCKS - frozenset("html body head td th tr thead tbody tfoot caption dd dt li option optgroup select button".split())
# An element of the key ends open ones of the value, unless one of the stop elements lies between.
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
# Elements and the words of classes, ids and roles that mark what is not the article.
NOT_ARTICLE = frozenset(
    "head nav aside footer form dialog menu search select option button object canvas svg video audio fieldset".split()
)
MARK_WORDS = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs masthead header footer colophon contentinfo copyright skip"
    " toolbar pagination pager search login signin signup subscribe newsletter cookie cookies consent gdpr notice alert"
    " alertdialog dialog popup modal overlay banner ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo"
    " promotion share sharing social widget complementary sidebar aside rail related recommended recommendations"
    " comment comments commentlist disqus respond reply replies discussion".split()
)
# Marks that hold even for an article inside.
FIRM_WORDS = frozenset(
    "ad ads adv advert adverts advertisement sponsor sponsored promo sidebar aside related recommended recommendations"
    " comment comments commentlist disqus respond reply replies discussion".split()
)
# Beside such a word a class says how the page looks, not what the element is.
STATE_WORDS = frozenset("no not has have with without is hide show open closed allowed enabled disabled".split())
OWN_HEADING = frozenset("post entry article story content page".split())

# Deeper elements count as content of the one at this depth, which loses no text.
DEEPEST = 200
_TOKEN = re.compile(
    r"<(?:!--(?P<comment>)|(?P<decl>[!?])|(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)"
    r"(?P<attrs>[^>=]*+(?:=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?+[^>=]*+)*+)(?:>|\Z))"
)
_ATTR = re.compile(r"([^\s=/>\"']+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|([^\s=/>\"']+)")
_DIGITS = re.compile(r"\d+")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I) for tag in RAW}


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for m in _ATTR.finditer(text):
        name = (m.group(1) or m.group(5)).lower()
        if name in ("class", "id", "role", "itemprop", "hidden", "style", "aria-hidden"):
            found.setdefault(name, unescape(m.group(2) or m.group(3) or m.group(4) or ""))
    return found


def _marks(attrs: dict[str, str]) -> set[str]:
    """The mark words among an element's classes, id and role."""
    out: set[str] = set()
    for name in f"{attrs.get('class', '')} {attrs.get('id', '')} {attrs.get('role', '')}".split():
        words = {w.lower() for w in _WORD.findall(name)}
        found = words & MARK_WORDS
        if found and not words & STATE_WORDS and not (found == {"header"} and words & OWN_HEADING):
            out |= found
    return out


def _hidden(attrs: dict[str, str]) -> bool:
    style = attrs.get("style", "").replace(" ", "").lower()
    return "hidden" in attrs or "display:none" in style or "visibility:hidden" in style or attrs.get("aria-hidden") == "true"


def digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=7).digest(), "little")


@dataclass
class Tree:
    """Blocks in page order. A block's label is its element with class and id; a run of text is a block ``#``."""

    labels: list[str] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    texts: list[int] = field(default_factory=list)  # digest of a run's text, 0 for elements

    def add(self, label: str, parent: int, text: int = 0) -> int:
        self.labels.append(label)
        self.parents.append(parent)
        self.texts.append(text)
        return len(self.labels) - 1

    def dump(self) -> str:
        return "\n".join(f"{p} {t:x} {label}" for label, p, t in zip(self.labels, self.parents, self.texts))

    @staticmethod
    def load(text: str) -> Tree:
        tree = Tree()
        for line in text.split("\n") if text else []:
            parent, text_digest, label = line.split(" ", 2)
            tree.add(label, int(parent), int(text_digest, 16))
        return tree

    def children(self) -> list[list[int]]:
        out: list[list[int]] = [[] for _ in self.labels]
        for i, p in enumerate(self.parents):
            if p >= 0:
                out[p].append(i)
        return out


@dataclass
class Run:
    """A run of text within a block."""

    node: int  # -1 if marked
    text: str
    marked: bool  # by its elements no part of the article
    declared: bool  # inside an element that says it is the article
    main: bool
    linked: int  # characters inside links


@dataclass
class _Open:
    tag: str
    node: int
    marked: bool
    firm: bool
    declared: bool
    main: bool
    link: bool
    block: bool


class Page:
    """The tree of a page and its runs of text. What its elements say is no part of the article is not in the tree."""

    def __init__(self, html: str):
        self.tree = Tree()
        self.runs: list[Run] = []
        self._buffer: list[str] = []
        self._linked = 0
        self._too_deep: list[str] = []
        root = self.tree.add("page", -1)
        self._stack = [_Open("", root, False, False, False, False, False, True)]
        self._parse(html)
        self._flush()

    def _parse(self, html: str) -> None:
        at = 0
        while True:
            m = _TOKEN.search(html, at)
            if m is None:
                self._text(html[at:])
                return
            if m.start() > at:
                self._text(html[at : m.start()])
            at = m.end()
            comment, decl, end, tag, attrs = m.groups()
            if comment is not None:
                stop = html.find("-->", max(m.start() + 2, at - 2))
                at = len(html) if stop < 0 else stop + 3
            elif decl:
                cdata = html.startswith("[CDATA[", at)
                stop = html.find("]]>" if cdata else ">", at)
                at = len(html) if stop < 0 else stop + (3 if cdata else 1)
            elif end:
                self._close(tag.lower())
            else:
                tag = tag.lower()
                if tag in RAW:
                    # Their text is none of the page's.
                    if not attrs.rstrip().endswith("/"):
                        end = _RAW_END[tag].search(html, at)
                        at = len(html) if end is None else end.start()
                    continue
                self._start(tag, attrs)

    def _text(self, text: str) -> None:
        if text:
            if self._stack[-1].tag == "head" and not text.isspace():
                self._pop_to(len(self._stack) - 1)
            text = unescape(text)
            self._buffer.append(text)
            if self._stack[-1].link:
                self._linked += len(text)

    def _flush(self) -> None:
        if not self._buffer:
            return
        text = " ".join("".join(self._buffer).split())
        if text:
            top = self._stack[-1]
            node = -1 if top.marked else self.tree.add("#", top.node, digest(text))
            self.runs.append(Run(node, text, top.marked, top.declared, top.main, min(self._linked, len(text))))
        self._buffer.clear()
        self._linked = 0

    def _pop_to(self, depth: int) -> None:
        if any(x.block for x in self._stack[depth:]):
            self._flush()
        del self._stack[depth:]

    def _start(self, tag: str, text: str) -> None:
        if tag == "br":
            self._buffer.append(" ")
            return
        block = tag in BLOCKS
        if self._stack[-1].tag == "head" and tag not in VOID:
            self._pop_to(len(self._stack) - 1)
        if block:
            self._flush()
            if tag in ENDS_P:
                for depth in range(len(self._stack) - 1, 0, -1):
                    if self._stack[depth].tag == "p":
                        self._pop_to(depth)
                        break
                    if self._stack[depth].tag in ("td", "th", "button", "caption", "object"):
                        break
            ends, stops = IMPLIED_END.get(tag, ((), ()))
            for depth in range(len(self._stack) - 1, 0, -1):
                if self._stack[depth].tag in stops:
                    break
                if self._stack[depth].tag in ends:
                    self._pop_to(depth)
                    if tag not in ("tr", "thead", "tbody", "tfoot"):
                        break
        if tag in VOID:
            return
        if len(self._stack) > DEEPEST:
            self._too_deep.append(tag)
            return
        attrs = _attributes(text) if text and not text.isspace() else {}
        top = self._stack[-1]
        if tag in ("html", "body"):
            attrs.clear()
        marks = _marks(attrs) if attrs and tag != "main" else set()
        article = tag == "article" or attrs.get("itemprop") == "articleBody"
        main = tag == "main" or attrs.get("role") == "main"
        firm = top.firm or tag in NOT_ARTICLE or bool(marks & FIRM_WORDS) or _hidden(attrs)
        marked = top.marked or firm or bool(marks) or (tag == "header" and not (top.declared or top.main))
        if (article or main) and not firm and not marks:
            marked = False
        node = top.node
        if block and not marked:
            label = tag
            if attrs:
                label = " ".join(_DIGITS.sub("0", f"{tag} {attrs.get('class', '')} {attrs.get('id', '')}").split())
            node = self.tree.add(label, top.node)
        self._stack.append(
            _Open(
                tag,
                node,
                marked,
                firm,
                top.declared or (article and not marked),
                top.main or (main and not marked),
                top.link or tag == "a",
                block,
            )
        )

    def _close(self, tag: str) -> None:
        block = tag in BLOCKS
        if block:
            self._flush()
        if self._too_deep:
            if tag in self._too_deep:
                del self._too_deep[len(self._too_deep) - 1 - self._too_deep[::-1].index(tag) :]
            return
        for depth in range(len(self._stack) - 1, 0, -1):
            opened = self._stack[depth]
            if opened.tag == tag:
                self._pop_to(depth)
                return
            # The end of an inline element ends no block, and no end tag leaves a table's cell but those of tables.
            if (opened.block and not block) or (
                opened.tag in ("td", "th", "caption") and tag not in ("table", "tr", "tbody", "thead", "tfoot", "body", "html")
            ):
                return

    def candidates(self) -> list[Run]:
        """The runs that may be main text, as far as the page alone tells.

        Those in an element that says it is the article; else in one that says it is the main part; else all but the
        ones in lists and boxes that are mostly links.
        """
        left = [r for r in self.runs if not r.marked]
        for chosen in ([r for r in left if r.declared], [r for r in left if r.main]):
            if chosen:
                return chosen
        return [r for r, dense in zip(left, self._link_boxes(left)) if not dense]

    def _link_boxes(self, runs: list[Run]) -> list[bool]:
        """Whether a run lies in a block, of two links or more, most of whose text is links."""
        total, linked, links = ([0] * len(self.tree.labels) for _ in range(3))
        for r in runs:
            node = r.node
            while node >= 0:
                total[node] += len(r.text)
                linked[node] += r.linked
                links[node] += r.linked > 0
                node = self.tree.parents[node]
        out = []
        for r in runs:
            node, dense = self.tree.parents[r.node], False
            while node > 0 and not dense:
                dense = links[node] > 1 and 2 * linked[node] > total[node]
                node = self.tree.parents[node]
            out.append(dense)
        return out


class Matcher:
    """Simple tree matching of one tree, the seed, with others.

    Two nodes match if their labels are equal; their children are aligned in order so that most nodes match in all. Equal
    subtrees, texts included, decide between alignments that are as good. Sizes of matches are kept by shape, so a
    thousand rows of a table cost as many comparisons as they have shapes.
    """

    def __init__(self, seed: Tree):
        self._shapes: dict[tuple, int] = {}
        self._parts: list[tuple] = []
        self._sizes: dict[tuple[int, int], int] = {}
        self.seed = seed
        self._seed = self._described(seed)

    def _described(self, tree: Tree):
        children = tree.children()
        shape, whole, size = [0] * len(tree.labels), [0] * len(tree.labels), [1] * len(tree.labels)
        for i in range(len(tree.labels) - 1, -1, -1):
            key = (tree.labels[i], tuple(shape[c] for c in children[i]))
            if key not in self._shapes:
                self._shapes[key] = len(self._parts)
                self._parts.append(key)
            shape[i] = self._shapes[key]
            whole[i] = hash((shape[i], tree.texts[i], tuple(whole[c] for c in children[i])))
            size[i] += sum(size[c] for c in children[i])
        return children, shape, whole, size

    def _size(self, a: int, b: int) -> int:
        """How many nodes of two shapes match."""
        if (a, b) not in self._sizes:
            (label, left), (other, right) = self._parts[a], self._parts[b]
            if label != other:
                return 0
            self._sizes[a, b] = 1 + (int(self._table(self._weights(left, right))[-1, -1]) if left and right else 0)
        return self._sizes[a, b]

    def _weights(self, left: tuple, right: tuple) -> np.ndarray:
        rows = {a: i for i, a in enumerate(dict.fromkeys(left))}
        columns = {b: i for i, b in enumerate(dict.fromkeys(right))}
        grid = np.array([[self._size(a, b) for b in columns] for a in rows], float)
        return grid[[rows[a] for a in left]][:, [columns[b] for b in right]]

    @staticmethod
    def _table(weights: np.ndarray) -> np.ndarray:
        table = np.zeros((weights.shape[0] + 1, weights.shape[1] + 1))
        for i, row in enumerate(weights):
            table[i + 1, 1:] = np.maximum.accumulate(np.maximum(table[i, 1:], table[i, :-1] + row))
        return table

    def match(self, tree: Tree) -> list[int]:
        """For each node of ``tree`` the seed's node it matches, or -1."""
        children, shape, whole, size = self._described(tree)
        seed_children, seed_shape, seed_whole, _ = self._seed
        out = [-1] * len(tree.labels)
        pairs = [(0, 0)] if tree.labels and self.seed.labels and tree.labels[0] == self.seed.labels[0] else []
        while pairs:
            a, b = pairs.pop()
            out[a] = b
            left, right = children[a], seed_children[b]
            while left and right and whole[left[0]] == seed_whole[right[0]]:
                pairs.append((left[0], right[0]))
                left, right = left[1:], right[1:]
            while left and right and whole[left[-1]] == seed_whole[right[-1]]:
                pairs.append((left[-1], right[-1]))
                left, right = left[:-1], right[:-1]
            if not left or not right:
                continue
            if len(left) == 1 and len(right) == 1:
                if self._size(shape[left[0]], seed_shape[right[0]]):
                    pairs.append((left[0], right[0]))
                continue
            weights = self._weights(tuple(shape[c] for c in left), tuple(seed_shape[c] for c in right))
            same = np.array([whole[c] for c in left])[:, None] == np.array([seed_whole[c] for c in right])
            # Less than a node in all, so it only decides between equals.
            weights = weights + same * (0.5 / (1 + min(len(left), len(right))))
            table = self._table(weights)
            i, j = len(left), len(right)
            while i and j:
                if table[i, j] == table[i - 1, j]:
                    i -= 1
                elif table[i, j] == table[i, j - 1]:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    pairs.append((left[i], right[j]))
        return out
