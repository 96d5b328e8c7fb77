"""HTML extraction, phrase mining and whitening: brute-force versions, hand-made pages and odd rows."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from layerwright.llm import counting_filter, dom, html_text, phrases, whitening

SF_DIR = "/root/testdata/sf0.001"


# --- pages -----------------------------------------------------------------------------------------------------------


def main_text(html):
    return " ".join(r.text for r in dom.Page(html).candidates())


@pytest.mark.parametrize(
    "html, text",
    [
        ("", ""),
        ("just text &amp; more\n\t here", "just text & more here"),
        ("<p>a<b>b</b>c<br>d</p><p>&lt;e&gt; &amp;lt; &#x41;&#66;&eacute;&nbsp;f</p>", "abc d <e> &lt; AB\u00e9 f"),
        ("<head><title>t</title><body><p>x<script>var a='<p>no</p>'</script>y</p>", "xy"),
        ("<title>t</title><p>x<!-- <p>no</p> --><style>p{}</style>y<!-- open", "xy"),
        ("<nav>n</nav><article><h1>T</h1><p><b>x.<br><p>y</article><footer>f</footer>", "T x. y"),
        ("<body class='menu-open has-sidebar'><div id=wrap><div class='site-header'>s</div><div>body text</div></div>", "body text"),
        ("<main><p>one</p><section id='comments'><p>c</p></section><aside>a</aside></main><div>out</div>", "one"),
        ("<article><p>one</p><article class='comment'>c</article><div class='share-buttons'>s</div></article>", "one"),
        ("<div class='menu'><main>kept</main></div>", "kept"),
        ("<div><p>text of the page</p><ul><li><a href=x>one link</a><li><a href=y>another</a></ul></div>", "text of the page"),
        ("<ul><li>one<li>two<ul><li>three</ul></ul><table><tr><td>a<td>b<tr><td>c</table>", "one two three a b c"),
        ("<form><input value=x><p>no</p></form><p hidden>no</p><p style='display: none'>no</p><p>yes</p>", "yes"),
        ("<p title=don't>a > b</p><p class=\"x>y\">c</p><p data-x=\"open>d</p>", "a > b c d"),
        ("<article><header><h1>Head</h1></header><p>x</p><footer>f</footer></article><header>site</header>", "Head x"),
        ("<div>" * 3000 + "deep" + "</div>" * 3000 + "<p>after</p>", "deep after"),
        ("a < b <3 & c <", "a < b <3 & c <"),
    ],
)
def test_a_page_alone(html, text):
    assert main_text(html) == text


def brute_tree_match(a, b):
    """Nodes matched by simple tree matching, by the recursion as published. A tree is (label, children)."""
    if a[0] != b[0]:
        return 0
    table = [[0] * (len(b[1]) + 1) for _ in range(len(a[1]) + 1)]
    for i, x in enumerate(a[1]):
        for j, y in enumerate(b[1]):
            table[i + 1][j + 1] = max(table[i][j + 1], table[i + 1][j], table[i][j] + brute_tree_match(x, y))
    return table[-1][-1] + 1


def test_tree_matching_against_recursion():
    rng = random.Random(5)

    def grow(depth):
        return (rng.choice("abc"), [grow(depth - 1) for _ in range(rng.randrange(4))] if depth else [])

    def flat(node, tree, parent):
        at = tree.add(node[0], parent, rng.randrange(1, 4) if not node[1] else 0)
        for child in node[1]:
            flat(child, tree, at)
        return tree

    for _ in range(200):
        a, b = grow(3), grow(3)
        left, right = flat(a, dom.Tree(), -1), flat(b, dom.Tree(), -1)
        places = dom.Matcher(right).match(dom.Tree.load(left.dump()))
        pairs = [(i, p) for i, p in enumerate(places) if p >= 0]
        assert len({p for _, p in pairs}) == len(pairs)
        assert all(left.labels[i] == right.labels[p] for i, p in pairs)
        assert all(left.parents[i] < 0 or places[left.parents[i]] == right.parents[p] for i, p in pairs)
        # Equal subtrees at the ends go together first, which may only cost what another alignment had gained.
        assert len(pairs) <= brute_tree_match(a, b)
        assert len(pairs) >= 0.8 * brute_tree_match(a, b)


def test_wrappers_of_hosts(spark):
    rng = random.Random(1)

    def words(n):
        return " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n))

    pages, expected = [], {}
    for i in range(40):
        body = [words(30) for _ in range(rng.randrange(1, 6))]
        # No element says what it is: the template has to be found.
        html = (
            f"<div class=x1><p>All the news of the town</p><p>Sign up to our list today</p></div><div class=x2><h1>{body[0]}</h1>"
            + "".join(f"<div class=z><p>{b}</p></div>" for b in body[1:])
            + f"<p>Read more in our paper edition</p></div><div class=x3><p>Printed on paper</p><p>{'' if i % 9 else words(3)}</p></div>"
        )
        pages.append((i, f"https://News.example.org:80{i % 2}/{i}", html))
        expected[i] = " ".join(body) + ("" if i % 9 else " " + re.findall("<p>([^<]*)</p></div>$", html)[0])
    # Copies are one page, and two pages are no evidence.
    for i in range(40, 50):
        pages.append((i, "http://copies.example.org/", "<div><p>same text on all copies</p></div>"))
        expected[i] = "same text on all copies"
    # A passage shared by some pages of a host is no template.
    shared = words(60)
    for i in range(50, 70):
        own = words(20)
        pages.append((i, "http://shared.example.org/", f"<article><p>{own}</p>{f'<p>{shared}</p>' if i % 3 else ''}</article>"))
        expected[i] = f"{own} {shared}" if i % 3 else own
    pages += [(70, None, "<p>no address</p>"), (71, "no url", None), (None, "http://[bad", "<p>x</p>"), (70, None, "<p>no address</p>")]
    df = spark.createDataFrame([(*p, "c") for p in pages], "page_id long, url string, html string, text string")
    rows = html_text.extract_main_text(df).collect()
    assert len(rows) == len(pages)
    found = {r.page_id: r.text for r in rows}
    expected |= {70: "no address", 71: "", None: "x"}
    assert found == expected
    assert all(r.n_chars == len(r.text) for r in rows)
    assert html_text.extract_main_text(df.limit(0)).count() == 0


# --- phrases ---------------------------------------------------------------------------------------------------------


def brute_phrases(rows, minimum, top):
    n, f = Counter(), Counter()
    low = {i: i + 32 for i in range(65, 91)}
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(low)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for size in range(1, 5):
                for i in range(len(w) - size + 1):
                    f[lang, tuple(w[i : i + size])] += 1
    candidates = {k: a for k, a in f.items() if a >= minimum and len(k[1]) > 1}
    longer = defaultdict(int)
    for (lang, p), a in candidates.items():
        for size in range(2, len(p)):
            for i in range(len(p) - size + 1):
                longer[lang, p[i : i + size]] = max(longer[lang, p[i : i + size]], a)
    best = defaultdict(list)
    for (lang, p), a in candidates.items():
        if 100 * longer[lang, p] >= 80 * a:
            continue
        score, k = min((2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p)))
        best[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return {
        (lang, i + 1, x[2].decode(), -x[1], x[3], x[4], n[lang], -x[0])
        for lang, found in best.items()
        for i, x in enumerate(sorted(found)[:top])
    }


@pytest.mark.parametrize("minimum, top", [(30, 2000), (5, 50)])
def test_phrases_against_brute_force(spark, minimum, top, monkeypatch):
    monkeypatch.setattr(phrases, "CHUNK_BYTES", 20_000)
    monkeypatch.setattr(phrases, "BLOCK_ENTRIES", 1000)
    monkeypatch.setattr(phrases, "HELD", 3000)
    monkeypatch.setattr(phrases, "SLICE", 700)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [tuple(r) for r in phrases.mine_phrases(docs, minimum=minimum, top=top).collect()]
    assert len(rows) == len(set(rows))
    assert set(rows) == brute_phrases([(r.lang, r.text) for r in docs.collect()], minimum, top)


def test_phrases_odd_rows(spark):
    given = [("en", "A b c d! a B c d")] * 40 + [(None, "x y\tx y")] * 20 + [("und", "x y")] * 5
    given += [("en", None), ("en", ""), ("en", " . \x0b,"), (None, None), ("fr", "lone"), ("fr", "word " * 300_000)]
    given += [("de", "\u00c9 \u00e9\u00a0z \x1c ." * 30)]
    df = spark.createDataFrame([(*g, 1, "r") for g in given], "lang string, text string, rank int, phrase string")
    rows = {tuple(r) for r in phrases.mine_phrases(df).collect()}
    assert rows == brute_phrases(given, 30, 2000)
    assert ("en", 1, "a b c d", 80, 80, 80, 320, 1000000) in rows
    assert phrases.mine_phrases(df.limit(0)).count() == 0


@pytest.mark.parametrize("words, bits", [(2, 1), (2, 7), (2, 32), (3, 5), (3, 16), (3, 31), (4, 1), (4, 16), (4, 17), (4, 32)])
def test_counting_filters_are_lossless(words, bits):
    rng = np.random.default_rng(words * 100 + bits)
    packing = counting_filter.Packing(words, bits)
    ids = [rng.integers(0, min(1 << bits, 9), 4000, dtype=np.uint64) for _ in range(words)]
    for x in ids:
        x[:50] = (1 << bits) - 1
    plain = Counter(zip(*(x.tolist() for x in ids)))
    for block_bits in sorted({0, min(3, packing.half), min(24, packing.half)}):
        filters = defaultdict(list)
        for part in range(4):
            keys = packing.permute(*packing.pack([x[part::4] for x in ids]))
            for block, data in counting_filter.encode(packing, block_bits, *counting_filter.counted(packing.half, *keys)):
                filters[block].append((block, data))
        found = Counter()
        for some in filters.values():
            left, right, counts = counting_filter.merge(packing, some)
            found.update(dict(zip(zip(*(x.tolist() for x in packing.unpack(*packing.restore(left, right)))), counts.tolist())))
        assert found == plain


def test_long_counts_survive_a_filter():
    packing = counting_filter.Packing(2, 8)
    left, right = packing.permute(np.arange(5, dtype=np.uint64), np.arange(5, dtype=np.uint64))
    order = np.lexsort((right, left))
    counts = np.array([1, 254, 255, 256, 10**15])
    (block, data), = counting_filter.encode(packing, 0, left[order], right[order], counts)
    assert counting_filter.decode(packing, block, data)[2].tolist() == counts.tolist()


# --- whitening -------------------------------------------------------------------------------------------------------


def test_refined_eigenvectors_of_clusters():
    rng = np.random.default_rng(0)
    for values in ([5, 5 - 1e-9, 5 - 2e-9, 3, 3, 3, 1], [1, 1 - 1e-13, 0.5, 1e-6, 0], [1e12, 1, 1e-3], [7.0], [0, 0]):
        values = np.array(values, float)
        q = np.linalg.qr(rng.normal(size=(len(values), len(values))))[0]
        matrix = (q * values) @ q.T
        matrix = (matrix + matrix.T) / 2
        got, vectors = whitening.refine_eigenvectors(matrix)
        assert np.allclose(got, values, rtol=0, atol=1e-14 * max(1, values.max()))
        assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-14
        assert np.abs(matrix @ vectors - vectors * got).max() < 1e-14 * max(1, values.max())
    q = np.linalg.qr(rng.normal(size=(3, 3)))[0].astype(np.longdouble)
    near = (q * np.array([1, 1 - 1e-9, 0.5], np.longdouble)) @ q.T
    assert np.abs(np.abs((whitening.refine_eigenvectors(near)[1] * q.astype(float)).sum(axis=0)) - 1).max() < 1e-9


def test_whitening_against_numpy(spark):
    df = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    df = df.unionByName(df.limit(100))
    rows = whitening.whiten(df).collect()
    given = df.collect()
    x = np.floor(np.array([r.embedding for r in given], float) * 256).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    values, vectors = np.linalg.eigh(np.cov(fit.T, bias=True))
    whole = ((x - sums / n) @ vectors[:, ::-1][:, :4]) / np.sqrt(values[::-1][:4])
    by_id = {r.vec_id: i for i, r in enumerate(given)}
    assert len(rows) == 4 * len(given)
    got = np.full(whole.shape, np.nan)
    for r in rows:
        i = by_id[r.vec_id]
        got[i, r.component - 1] = r.whitened
        assert r.n == n and r.deviation == int(((n * x[i] - sums) ** 2).sum())
        assert abs(r.explained / (values[::-1][r.component - 1] / values.sum()) - 1) < 1e-12 and r.identity_error < 1e-9
    seen = ~np.isnan(got).any(axis=1)
    signs = np.sign((got[seen] * whole[seen]).sum(axis=0))
    assert np.abs(got[seen] - whole[seen] * signs).max() < 1e-9


def test_whitening_odd_rows(spark):
    big = 2**53 + 1
    given = [(big, [1.0, 2.0]), (None, [1.0, 2.0]), (None, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0])]
    given += [(4, [3.0, -5.5]), (5, [1.0]), (6, []), (7, [float("-inf"), 0.0]), (8, [-0.0, 0.001])]
    df = spark.createDataFrame([(*g, 1) for g in given], "vec_id long, embedding array<double>, n int")
    rows = whitening.whiten(df).collect()
    assert Counter(r.vec_id for r in rows) == {big: 2, None: 4, 4: 2, 8: 2}
    assert {r.n for r in rows} == {3} and max(r.identity_error for r in rows) < 1e-9
    one = whitening.whiten(df.limit(1)).collect()
    assert [(r.component, r.whitened, r.explained, r.identity_error, r.deviation) for r in one] == [(1, None, None, None, 0), (2, None, None, None, 0)]
    huge = spark.createDataFrame([(1, [1e300, 1.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert {(r.component, r.deviation) for r in whitening.whiten(huge).collect()} == {(1, None), (2, None)}
    assert whitening.whiten(df.limit(0)).count() == 0
