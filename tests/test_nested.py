import base64
import json
import os
import random
import re
import subprocess
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from layerwright.functions import claims, icons, projections, rules, text
from layerwright.functions.overlay import merge_overlay
from layerwright.operators import dag, html, metadata, tree, xref
from layerwright.operators.replace import replace_from_table
from layerwright.plans import docs
from layerwright.plans.icons import assign_icons
from layerwright.session import scratch_root
from layerwright.sources import scan_text_document

ANCHOR = docs.IDENTITY_ANCHOR


def _nodes(spark, rows):
    return spark.createDataFrame(rows, "id int, parent_id int, ord int, title string, href string")


def test_tree_skips_overview_branches_and_walks_depth_first(spark):
    nodes = _nodes(
        spark,
        [
            (1, None, 0, "Core", None),
            (2, 1, 0, "Overview", "core/o"),
            (3, 2, 0, "Hidden", "core/o/h"),
            (4, 1, 1, "Items", "core/items"),
            (5, 4, 1, "Update", "core/items/u"),
            (6, 4, 0, "Create", "core/items/c"),
            (7, None, 1, "Start", "start"),
            (8, 1, 2, "Folders", None),
            (9, 8, 0, "List", "core/folders/l"),
        ],
    )
    rows = tree.tree_flatten(nodes).orderBy("sort_key").collect()
    assert [(r.path, r.title, r.href, r.depth) for r in rows] == [
        ("|Core", "Items", "core/items", 1),
        ("|Core|Items", "Create", "core/items/c", 2),
        ("|Core|Items", "Update", "core/items/u", 2),
        ("|Core|Folders", "List", "core/folders/l", 2),
        ("", "Start", "start", 0),
    ]


def test_tree_of_nothing_and_deep(spark):
    assert tree.tree_flatten(_nodes(spark, [(1, None, 0, "Overview", "x")])).count() == 0
    chain = [(i, i - 1 if i else None, 0, f"t{i}", "h") for i in range(12)]
    assert [r.depth for r in tree.tree_flatten(_nodes(spark, chain)).orderBy("depth").collect()] == list(range(12))


def test_tree_with_a_hot_parent_keeps_every_row(spark):
    hot = [(i, 1, i, f"t{i}", f"h{i}") for i in range(10, 3010)]
    rows = tree.tree_flatten(_nodes(spark, [(1, None, 0, "Hot", None), *hot]))
    assert rows.count() == 3000
    assert [r.title for r in rows.orderBy("sort_key").limit(2).collect()] == ["t10", "t11"]


@pytest.mark.parametrize(
    ("rows", "error"),
    [
        ([(1, None, 0, "a", "h"), (2, 7, 0, "b", "h")], "missing"),
        ([(1, None, 0, "a", "h"), (2, 3, 0, "b", "h"), (3, 2, 0, "c", "h")], "cycle"),
        ([(1, None, 0, "a", "h"), (1, None, 1, "a", "h"), (2, 1, 0, "b", "h")], "twice"),
    ],
)
def test_nodes_no_root_reaches_are_an_error(spark, rows, error):
    with pytest.raises(ValueError, match=error):
        tree.tree_flatten(_nodes(spark, rows))


def test_tree_dangling(spark):
    nodes = _nodes(spark, [(1, None, 0, "a", "h"), (2, 7, 0, "b", "h"), (3, 1, 0, "c", "h")])
    assert [r.id for r in tree.tree_dangling(nodes).collect()] == [2]


def test_tree_150_levels_deep(spark):
    chain = [(i, i - 1 if i else None, 0, f"t{i}", "h") for i in range(150)]
    assert tree.tree_flatten(_nodes(spark, chain)).agg(F.max("depth")).first()[0] == 149


def test_docs_table_from_a_stored_table_of_contents(spark, tmp_path):
    toc = {
        "items": [
            {"toc_title": "Overview", "href": "o", "children": [{"toc_title": "Hidden", "href": "h"}]},
            {"toc_title": "Core", "children": [{"toc_title": "Items", "href": "core/items", "children": []}, {"toc_title": "Overview"}]},
            {"toc_title": "Start", "href": "start"},
        ]
    }
    (tmp_path / "toc.json").write_text(json.dumps(toc, indent=1))
    (tmp_path / "none.json").write_text("{}")
    documents = scan_text_document(spark, str(tmp_path / "*.json"))
    nodes = tree.toc_nodes(documents.withColumn("path", F.regexp_extract("path", r"[^/]+$", 0)), "document", "path")
    assert sorted((r.id, r.parent_id, r.ord, r.title, r.href) for r in nodes.collect())[-2:] == [
        ("toc.json/1/1", "toc.json/1", 1, "Overview", None),
        ("toc.json/2", None, 2, "Start", "start"),
    ]
    page = f'<h2 id="{ANCHOR}"></h2>' + TABLE.format(rows=ROW.format(k="User", v="Yes"))
    pages = spark.createDataFrame([("https://d/core/items", page)], "url string, html string")
    assert sorted(tuple(r) for r in docs.docs_table(nodes, pages, "https://d/").collect()) == [
        ("Items", "https://d/core/items", "Yes", None, "Core", None),
        ("Start", "https://d/start", "N/A", "N/A", None, None),
    ]
    broken = spark.sql("""SELECT 'x' AS path, parse_json('{"items": [{"href": "a"}]}') AS document""")
    with pytest.raises(Exception, match="toc_title"):
        tree.toc_nodes(broken, "document", "path")
    for text_, said in (('{"items": {"toc_title": "x"}}', "items"), ('{"items": [{"toc_title": "x", "children": "y"}]}', "children")):
        wrong = spark.createDataFrame([("d", text_)], "path string, t string").selectExpr("path", "parse_json(t) AS document")
        with pytest.raises(Exception, match=f"{said} of a table of contents is no list"):
            tree.toc_nodes(wrong, "document", "path")
    nothing = [("a", '{"items": null}'), ("b", "{}"), ("c", '{"items": [{"toc_title": "x", "children": null}]}')]
    empty = spark.createDataFrame(nothing, "path string, t string").selectExpr("path", "parse_json(t) AS document")
    assert [r.id for r in tree.toc_nodes(empty, "document", "path").collect()] == ["c/0"]


def test_tree_of_many_levels_takes_few_rounds(spark):
    before = set(os.listdir(scratch_root(spark)))
    chain = _nodes(spark, [(i, i - 1 if i else None, 0, f"t{i}", f"h{i}") for i in range(151)])
    rows = {r.href: (r.path, r.depth, r.sort_key) for r in tree.tree_flatten(chain).collect()}
    assert rows == {f"h{i}": ("".join(f"|t{j}" for j in range(i)), i, [0] * (i + 1)) for i in range(151)}
    rounds = [d for d in os.listdir(scratch_root(spark)) if d.startswith("tree-paths") and d not in before]
    assert 0 < len(rounds) <= 8


TABLE = "<table><tbody>{rows}</tbody></table>"
ROW = "<tr><td>{k}</td><td>{v}</td></tr>"
PAGES = {
    "both": f'<table><tbody><tr><td>User</td><td>before</td></tr></tbody></table><h2 id="{ANCHOR}">x</h2><p>y<br></p>'
    + TABLE.format(
        rows=ROW.format(k="User", v=" Yes\n")
        + "<tr><td><p>Service principal</p> and <a href='x'>Managed identities</a></td><td>No</td></tr>"
    ).replace(" and ", "and")
    + TABLE.format(rows=ROW.format(k="User", v="after")),
    "no anchor": "<h2>x</h2>" + TABLE.format(rows=ROW.format(k="User", v="Yes")),
    "user only": f"<h2 id='{ANCHOR}'></h2>" + TABLE.format(rows=ROW.format(k="User", v="Yes")),
    "split text": f"<h2 id={ANCHOR}></h2>"
    + TABLE.format(rows=ROW.format(k="<b> Service principal </b>\n and <i>Managed identities</i>", v="a<!-- c --> b")),
    "last wins": f'<h2 id="{ANCHOR}"></h2>' + TABLE.format(rows=ROW.format(k="User", v="1") + ROW.format(k="User", v="2")),
    "entities": f'<h2 id="{ANCHOR.replace("-", "&#45;")}"></h2>' + TABLE.format(rows=ROW.format(k="Us&#101;r", v="a &amp; b &lt;c&gt;")),
    "nested": f'<h2 id="{ANCHOR}"></h2>'
    + TABLE.format(rows="<tr><td>User<table><tr><td>in</td></tr></table></td><td>out</td></tr>"),
    "unclosed": f'<div id="{ANCHOR}"><table><thead><tr><td>User</td><td>head</td></tr></thead><tbody><tr><td>User</td><td>Yes</table>'
    "<table><tbody><tr><td>User</td><td>later</td></tr></tbody></table>",
    "no body": f'<h2 id="{ANCHOR}"></h2><table><tr><td>User</td><td>Yes</td></tr></table>',
    "upper case": f'<H2 ID="{ANCHOR}"></H2><TABLE><TBODY><TR><TD>User</TD><TD>Yes<SCRIPT>var a;</SCRIPT></TD></TR></TBODY></TABLE>',
    "nothing": None,
}


def test_html_table_extract(spark):
    df = spark.createDataFrame(list(PAGES.items()), "name string, html string")
    names = {"u": "User", "s": "Service principalandManaged identities"}
    found = {r.name: (r.u, r.s) for r in html.html_table_extract(df, "html", ANCHOR, names).collect()}
    assert found == {
        "both": ("Yes", "No"),
        "no anchor": ("N/A", "N/A"),
        "user only": ("Yes", None),
        "split text": (None, "ab"),
        "last wins": ("2", None),
        "entities": ("a & b <c>", None),
        "nested": (None, None),
        "unclosed": ("Yes", None),
        "no body": (None, None),
        "upper case": ("Yes", None),
        "nothing": ("N/A", "N/A"),
    }


def test_html_table_rows_keep_order(spark):
    df = spark.createDataFrame(list(PAGES.items()), "name string, html string")
    rows = html.html_table_rows(df.where("name IN ('nested', 'last wins')"), "html", ANCHOR).orderBy("name", "position")
    assert [(r.name, r.position, r.key, r.value) for r in rows.collect()] == [
        ("last wins", 0, "User", "1"),
        ("last wins", 1, "User", "2"),
        ("nested", 0, "Userin", "in"),
    ]


def test_replacements(spark):
    df = spark.createDataFrame([("xaaybbz",), ("aabb",), ("a\0aa",), (None,), ("",)], "t string")
    swap = {"aa": "bb", "bb": "2"}
    out = df.select(text.replace_in_one_pass(F.col("t"), swap), text.replace_in_turn(F.col("t"), swap)).collect()
    assert [tuple(r) for r in out] == [("xbby2z", "x2y2z"), ("bb2", "22"), ("a\0bb", "a\0" + "2"), (None, None), ("", "")]
    odd = {"a.b": "$1", "(x": "\\2", "\\Q": "[q]", "ab": "1", "abc": "2", "ö|": "ü"}
    df = spark.createDataFrame([("a.b axb (x \\Q abc ö|",)], "t string")
    assert df.select(text.replace_in_one_pass(F.col("t"), odd)).first()[0] == "$1 axb \\2 [q] 1c ü"
    with_mark = df.select(F.concat("t", F.lit("\0")).alias("t")).select(text.replace_in_one_pass(F.col("t"), odd))
    assert with_mark.first()[0] == "$1 axb \\2 [q] 1c ü\0"
    assert df.select(text.replace_in_one_pass(F.col("t"), {})).first()[0] == "a.b axb (x \\Q abc ö|"
    with pytest.raises(ValueError):
        text.replace_in_one_pass(F.col("t"), {"": "x"})


def test_single_pass_never_reads_what_it_wrote(spark):
    """A mapping between ids of the same form, as in moving references from one environment to another."""
    ids = [f"{i:08d}-aaaa" for i in range(40)]
    ring = dict(zip(ids, ids[1:] + ids[:1]))
    df = spark.createDataFrame([(" ".join(ids),)], "t string")
    assert df.select(text.replace_in_one_pass(F.col("t"), ring)).first()[0] == " ".join(ids[1:] + ids[:1])


def test_single_pass_against_brute_force(spark):
    rng = random.Random(5)
    literals = {"ab": "b", "b": "abc", "bca": "", "c.": "a", "aa": "$0"}
    texts = ["".join(rng.choice("abc.\0") for _ in range(rng.randrange(30))) for _ in range(2000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", text.replace_in_one_pass(F.col("t"), literals).alias("r")).collect()
    pattern = re.compile("|".join(re.escape(literal) for literal in literals))
    assert [r.r for r in rows] == [pattern.sub(lambda hit: literals[hit[0]], r.t) for r in rows]


def test_single_pass_with_ten_thousand_literals(spark):
    rng = random.Random(6)
    literals = {}
    while len(literals) < 10_000:
        literals["".join(rng.choice("abcd.|é") for _ in range(rng.randrange(3, 9)))] = f"<{len(literals)}>"
    order = {literal: i for i, literal in enumerate(literals)}

    def brute(text):
        out, at = [], 0
        while at < len(text):
            hits = [text[at : at + n] for n in range(1, 9) if text[at : at + n] in order]
            best = min(hits, key=order.get, default=text[at])
            out.append(literals.get(best, best))
            at += len(best)
        return "".join(out)

    texts = ["".join(rng.choice("abcd.|é \0" if i % 9 == 0 else "abcd.|é ") for _ in range(200)) for i in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = [r[0] for r in df.select(text.replace_in_one_pass(F.col("t"), literals)).collect()]
    assert found == [brute(t) for t in texts]


@pytest.mark.parametrize("literals", [["ab", "abc"], ["abc", "ab"], ["a", "b", "ab"], ["abcd", "ab", "abc", "x"], ["aab", "aa", "a", "aaa"]])
def test_literal_pattern_finds_the_first_of_the_list(literals):
    plain = re.compile("|".join(map(re.escape, literals)))
    tree = re.compile(text.literal_pattern(literals))
    rng = random.Random(7)
    for _ in range(300):
        sample = "".join(rng.choice("abcdx") for _ in range(12))
        assert tree.findall(sample) == plain.findall(sample)


def test_replacement_by_table_against_brute_force(spark):
    dice = random.Random(5)
    mapping = {f"{{{i}}}": f"<{i}{{0}}>$\\" for i in range(0, 60, 2)}
    texts = ["".join(dice.choice(["{0}", "{4}", f"{{{dice.randrange(70)}}}", "a ", "{", "\n"]) for _ in range(dice.randrange(30))) for _ in range(400)]
    rows = [*enumerate(texts + ["{0}"] * 500), (7, None), (7, "")]
    df = spark.createDataFrame(rows, "id int, t string")
    pairs = spark.createDataFrame([*mapping.items(), ("{0}", mapping["{0}"]), ("{1}", None), (None, "x")], "key string, value string")
    out = replace_from_table(df, "t", pairs, r"\{\d+\}")
    assert out.columns == ["id", "t"]
    expected = [(i, t and re.sub(r"\{\d+\}", lambda m: mapping.get(m[0], m[0]), t)) for i, t in rows]
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, expected))
    assert replace_from_table(df.limit(0), "t", pairs, r"\{\d+\}").count() == 0
    two = pairs.union(spark.createDataFrame([("{0}", "other")], pairs.schema))
    with pytest.raises(Exception, match="two values"):
        replace_from_table(df, "t", two, r"\{\d+\}").collect()
    with pytest.raises(ValueError):
        replace_from_table(df, "t", pairs, r"\d*")


def test_parsers_run_where_the_package_is_missing():
    page = f"<p id='{ANCHOR}'></p>" + TABLE.format(rows=ROW.format(k="User", v="Yes"))
    script = "import sys; from pyspark import cloudpickle; f, a = cloudpickle.loads(sys.stdin.buffer.read()); print(f(*a))"
    for function, arguments, expected in (
        (html._pairs_after_anchor, (page, ANCHOR), "[{'key': 'User', 'value': 'Yes'}]"),
    ):
        sent = cloudpickle.dumps((function, arguments))
        done = subprocess.run([sys.executable, "-c", script], input=sent, capture_output=True, cwd="/", timeout=60)
        assert done.stdout.decode().strip() == expected, done.stderr.decode()


def test_path_items(spark):
    df = spark.createDataFrame([("|a|b",), ("|a",), ("",), (None,)], "p string")
    rows = df.select(text.path_item(F.col("p"), 1), text.path_item(F.col("p"), 2)).collect()
    assert [tuple(r) for r in rows] == [("a", "b"), ("a", None), (None, None), (None, None)]


def _merge(spark, parent, child, policy=1):
    df = spark.createDataFrame([(json.dumps(parent), json.dumps(child))], "p string, c string")
    merged = merge_overlay(df, "p", "c", "m", policy).first().m
    return json.loads(merged)


PARENT = {"a": 1, "l": [1, {"q": 1, "r": 2}, 1], "o": {"x": 1, "y": ["p"]}, "s": "t", "merge_type": "own"}


@pytest.mark.parametrize(
    ("child", "policy", "expected"),
    [
        ({"a": 2, "n": 3, "l": [9], "o": {"x": 5}}, 0, {**PARENT, "n": None}),
        ({"a": 2, "n": {"merge_type": 2, "k": 1}, "l": [9]}, 1, {**PARENT, "a": 2, "n": {"merge_type": 2, "k": 1}, "l": [9]}),
        ({"l": ["1", 1, {"r": 2, "q": 1}]}, 2, {**PARENT, "l": [1, {"q": 1, "r": 2}, "1"]}),
        ({"merge_type": 2, "l": [2], "o": {"y": ["z"]}}, 1, {**PARENT, "l": [1, {"q": 1, "r": 2}, 2], "o": {"x": 1, "y": ["p", "z"]}}),
        ({"merge_type": 0, "a": 9, "o": {"merge_type": 1, "x": 9, "new": 1}}, 1, {**PARENT, "o": {"x": 9, "y": ["p"], "new": 1}}),
        ({"o": 5, "s": {"k": "v"}, "a": None}, 1, {**PARENT, "o": 5, "s": {"k": "v"}, "a": None}),
        ({"o": 5, "s": {"k": "v"}, "l": 1}, 0, PARENT),
        ({}, 1, PARENT),
    ],
)
def test_overlay(spark, child, policy, expected):
    assert _merge(spark, PARENT, child, policy) == expected


def test_overlay_of_non_objects_and_depth(spark):
    assert _merge(spark, [1], {"a": 1}, 0) == [1]
    assert _merge(spark, [1], {"a": 1}, 1) == {"a": 1}
    deep = {"a": {"b": {"c": {"d": 1}}}}
    assert _merge(spark, deep, {"a": {"b": {"c": {"e": 'q"\\é'}}}}) == {"a": {"b": {"c": {"d": 1, "e": 'q"\\é'}}}}
    tricky = '}}{ " {'
    parent, child, both = {"a": 1}, {"b": tricky}, {"a": 1, "b": tricky}
    for _ in range(11):
        parent, child, both = {"k": parent}, {"k": child}, {"k": both}
    assert _merge(spark, parent, child) == both


def test_overlay_of_a_document_over_itself_changes_nothing(spark):
    document = {"a": "x", "b": {"c": None, "d": {"e": 1.5, "f": True}}}
    for policy in (0, 1, 2):
        assert _merge(spark, document, document, policy) == document


def test_overlay_keeps_numbers_and_strings_that_look_like_marks(spark):
    def merged(parent, child, policy):
        df = spark.createDataFrame([(parent, child)], "p string, c string")
        return merge_overlay(df, "p", "c", "m", policy).first().m

    assert merged('{"l": [1]}', '{"l": [1.0, 1]}', 2) == '{"l":[1,1.0]}'
    long = "1" * 50
    assert merged(f'{{"a": {long}, "b": -1.50e+3}}', '{"c": 0.10}', 1) == f'{{"a":{long},"b":-1.50e+3,"c":0.10}}'
    assert merged('{"a": 1}', '{"merge_type": 0.0, "a": 2}', 1) == '{"a":1}'
    odd = ["\x01", "\x01n5", 'a"\x01n5', 'a"\x01s', "\x01s1", "\\\\\"7", 'x\\', "12", 12]
    assert _merge(spark, {"k": odd}, {"\x01n1": odd, 'q"2': 3}) == {"k": odd, "\x01n1": odd, 'q"2': 3}
    assert _merge(spark, {"k": '\\"' * 20_000}, {"j": 1}) == {"k": '\\"' * 20_000, "j": 1}
    assert merged('{"l": [1.50, {"a": 1, "b": 2}]}', '{"l": [1.5, {"b": 2, "a": 1}, 2]}', 2) == '{"l":[1.5,{"b":2,"a":1},2]}'
    for broken in ('{"a": 01}', "{1: 2}", '{"a": NaN}', '{"a": 1 2}', "[1,]", '{"a": "\n"}', "", "{"):
        with pytest.raises(Exception, match="(?i)malformed"):
            merged(broken, "{}", 1)


def test_overlay_directives_and_odd_keys(spark):
    def merged(parent, child, policy=1):
        df = spark.createDataFrame([(parent, child)], "`p.x` string, c string")
        return merge_overlay(df, "p.x", "c", "m", policy).first().m

    assert merged('{"b": 1, "a": 2}', '{"c": 3, "a": 4}') == '{"b":1,"a":4,"c":3}'
    assert merged('{"a": 1, "a": 2}', '{"b": 1, "b": 3}') == '{"a":2,"b":3}'
    assert merged('{"a": 1}', '{"merge_type": false, "a": 2}') == '{"a":1}'
    assert merged('{"a": 1}', '{"merge_type": "0", "a": 2}') == '{"a":2}'
    assert merged('{"a": 1}', '{"merge_type": null, "a": 2}', 0) == '{"a":2}'
    assert merged(None, '{"a": 2}') == '{"a":2}' and merged('{"a": 2}', None) == "null" and merged(None, "1", 0) == "null"
    assert merged('{"a": "\\ud800é\\u001f"}', "{}") == '{"a":"\\ud800\\u00e9\\u001f"}'


@pytest.mark.parametrize("depth", [16, 200, 2000])
def test_overlay_of_deep_documents(spark, depth):
    def nested(inner, wrap="{{\"k\":{}}}"):
        for _ in range(depth):
            inner = wrap.format(inner)
        return inner

    shallow = [('{"a":1}', '{"b":2}')] * 1000
    rows = [*shallow, (nested('{"a":1}'), nested('{"b":2}')), (nested("1", "[{}]"), nested("2", "[{}]")), *shallow]
    df = spark.createDataFrame(rows, "p string, c string")
    found = [r.m for r in merge_overlay(df, "p", "c", "m").collect()]
    assert found == ['{"a":1,"b":2}'] * 1000 + [nested('{"a":1,"b":2}'), nested("2", "[{}]")] + ['{"a":1,"b":2}'] * 1000


def test_overlay_refuses_what_it_cannot_read(spark):
    deep = "[" * 200_000 + "]" * 200_000
    with pytest.raises(Exception, match="nested deeper"):
        merge_overlay(spark.createDataFrame([(deep, "{}")], "p string, c string"), "p", "c", "m").collect()


def test_first_rule_wins(spark):
    df = spark.createDataFrame([("Shop Prepare STORE",), ("store",), ("x",), (None,)], "n string")
    keywords = {"prepare": "Notebook", "Store": "Lakehouse"}
    assert [r[0] for r in df.select(rules.first_match(F.col("n"), keywords)).collect()] == ["Notebook", "Lakehouse", None, None]


def _token(payload):
    body = base64.urlsafe_b64encode(json.dumps(payload).encode()).decode().rstrip("=")
    return f"e30.{body}.sig"


def test_token_claims_with_every_padding(spark):
    tokens = [_token({"idtyp": "User", "p": "x" * n}) for n in range(4)]
    tokens += [_token({"idtyp": "app", "p": "??>>~~"}), _token({"p": 1}), "not a token", None]
    df = spark.createDataFrame([(t,) for t in tokens], "t string")
    rows = df.select(claims.token_claim(F.col("t"), "idtyp"), claims.is_service_identity(F.col("t"))).collect()
    assert [tuple(r) for r in rows] == [("User", False)] * 4 + [("app", True), (None, True), (None, None), (None, None)]
    assert {len(t.split(".")[1]) % 4 for t in tokens[:4]} >= {0, 2, 3}


def test_column_lists(spark):
    texts = ['["a","b"]', "[]", '["a",1]', '{"a":1}', "oops", '["a",null]', None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select(projections.is_column_list(F.col("t")), projections.parse_column_list(F.col("t"), strict=False)).collect()
    assert [tuple(r) for r in rows] == [(True, ["a", "b"]), (True, [])] + [(False, None)] * 4 + [(None, None)]


def test_icon_library(spark):
    def drawing(style):
        return f'<mxGraphModel><root><mxCell id="0"/><g><mxCell style="{style}"/></g></root></mxGraphModel>'

    entries = [
        {"title": "A", "xml": drawing("image=data:image/png,AAAA;x=1")},
        {"xml": drawing("shape=none")},
        {"title": "B", "xml": "<broken"},
        {"title": "A", "xml": drawing("image=data:image/svg+xml,BBBB;image=data:image/png,CCCC")},
        {"title": "D"},
    ]
    library = "<mxlibrary>" + json.dumps(entries).replace("&", "&amp;").replace("<", "&lt;") + "</mxlibrary>"
    df = spark.createDataFrame([(1, library), (2, "<a>"), (3, "<a>no json</a>"), (4, None)], "id int, x string")
    rows = {tuple(r) for r in icons.icon_library_extract(df, "x", ["id"]).collect()}
    assert rows == {(1, "A", "BBBB"), (1, "No Title", "No Base64 found"), (1, "B", "Invalid XML"), (1, "D", "Invalid XML")}


def test_recolor(spark):
    coded = base64.b64encode('<svg fill="red" class="fill"><g fill="none" fill=""/>é</svg>'.encode()).decode()
    df = spark.createDataFrame([(coded,), ("@@@",), (base64.b64encode(b"\xff").decode(),), (None,)], "x string")
    out = [r[0] for r in df.select(text.recolor_base64(F.col("x"), "#1$\\E")).collect()]
    assert base64.b64decode(out[0]).decode() == '<svg fill="#1$\\E" class="fill"><g fill="#1$\\E" fill=""/>é</svg>'
    assert out[1:] == [None, None, None]


def _activities(spark, edges):
    return spark.createDataFrame(list(edges.items()), "name string, dependencies array<string>")


def test_dag_levels(spark):
    edges = {"a": [], "b": [], "c": ["a", "b"], "d": ["c", "a", "c"], "e": ["gone"]}
    levels = {r.name: r.level for r in dag.dag_levels(_activities(spark, edges)).collect()}
    assert levels == {"a": 0, "b": 0, "c": 1, "d": 2, "e": 0}
    dangling = dag.dag_dangling(_activities(spark, edges)).collect()
    assert [tuple(r) for r in dangling] == [("e", "gone")]


@pytest.mark.parametrize("edges", [{"a": ["b"], "b": ["a"]}, {"a": [], "b": ["b", "a"]}])
def test_dag_cycle_is_an_error(spark, edges):
    with pytest.raises(ValueError, match="cycle"):
        dag.dag_levels(_activities(spark, edges))


def _levels(edges):
    """Levels by going over all edges until nothing changes."""
    level = dict.fromkeys(edges, 0)
    for _ in edges:
        for name, waits in edges.items():
            level[name] = max([level[name], *(level[w] + 1 for w in waits if w in level)])
    return level


@pytest.mark.parametrize("edges_a_task", [0, 5, 200_000])
def test_dag_levels_against_relaxation(spark, edges_a_task, monkeypatch):
    monkeypatch.setattr(dag, "EDGES_A_TASK", edges_a_task)
    names = [f"a{i * 7 % 23}" for i in range(23)]
    edges = {n: [names[j] for j in range(i) if (i * j) % 5 == 1 or j == i - 4] + ["gone"] * (i % 3 == 0) for i, n in enumerate(names)}
    edges |= {f"c{i}": [f"c{i - 1}"] if i else [] for i in range(6)}
    assert {r.name: r.level for r in dag.dag_levels(_activities(spark, edges)).collect()} == _levels(edges)
    with pytest.raises(ValueError, match="cycle"):
        dag.dag_levels(_activities(spark, edges | {"x": ["z", "c2"], "y": ["x"], "z": ["y"], "w": ["z"]}))


def test_dag_rounds_write_each_activity_once(spark, monkeypatch):
    monkeypatch.setattr(dag, "EDGES_A_TASK", 0)
    chain = {f"a{i}": [f"a{i - 1}"] if i else [] for i in range(12)}
    before = set(os.listdir(scratch_root(spark)))
    levels = {r.name: r.level for r in dag.dag_levels(_activities(spark, chain)).collect()}
    assert levels == {f"a{i}": i for i in range(12)}
    rounds = [d for d in os.listdir(scratch_root(spark)) if d.startswith("dag-rounds") and d not in before]
    # The first waits for nothing and the last is not waited for.
    assert spark.read.parquet(f"{scratch_root(spark)}/{rounds[0]}").count() == 10


def test_dag_of_long_chains_reads_an_edge_once(spark, monkeypatch):
    chain = {f"a{i}": [f"a{i - 1}"] if i else [] for i in range(2000)}
    before = set(os.listdir(scratch_root(spark)))
    levels = {r.name: r.level for r in dag.dag_levels(_activities(spark, chain)).collect()}
    assert levels == {f"a{i}": i for i in range(2000)}
    new = {d.rsplit("-", 1)[0] for d in os.listdir(scratch_root(spark)) if d not in before}
    assert "dag-rest" in new and not new & {"dag-rounds", "dag-open"}


def test_dag_without_activities(spark):
    assert dag.dag_levels(_activities(spark, {"a": []}).where("name = 'z'")).count() == 0


def test_dag_from_metadata(spark):
    rows = [
        ("n1", "p1", 300, 1, 10, '{"useRootDefaultLakehouse": true}', '["n2"]', "default", True),
        ("n2", "p2", 90, 2, 5, None, None, "default", False),
        ("n3", "p3", 90, 2, 5, "", "", "other", True),
    ]
    df = spark.createDataFrame(
        rows,
        "notebook_name string, notebook_path string, cell_timeout int, retry_count int, retry_interval int,"
        " arguments string, dependencies string, `group` string, is_enabled boolean",
    )
    activities = metadata.dag_from_metadata(df, "default").collect()
    assert [(a.name, a.timeout_per_cell, a.args, a.dependencies) for a in activities] == [
        ("n1", 300, {"useRootDefaultLakehouse": "true"}, ["n2"])
    ]
    every = {a.name: (a.args, a.dependencies) for a in metadata.dag_from_metadata(df, only_enabled=False).collect()}
    assert every["n2"] == every["n3"] == ({}, [])


def test_xref_needs_the_same_item(spark):
    rows = [
        ("dev", "Store", "Lakehouse", "Base", "item", "d1", 0),
        ("dev", "Store", "Lakehouse", "Base", "sql_endpoint", "d1e", 0),
        ("dev", "Store", "Lakehouse", "Gold", "item", "d2", 1),
        ("dev", "Model", "Lakehouse", "Base", "item", "d3", 0),
        ("dev", "Store", "Lakehouse", "Lone", "item", "d4", 2),
        ("tst", "Store", "Lakehouse", "Base", "item", "t1", 0),
        ("tst", "Store", "Lakehouse", "Base", "sql_endpoint", "t1e", 0),
        ("tst", "Store", "Lakehouse", "Other", "sql_endpoint", "t9e", 5),
        ("tst", "Store", "Lakehouse", "Gold", "item", "t2", 1),
        ("tst", "Store", "Lakehouse", "Gold", "item", "t2b", 7),
        ("prd", "Model", "Lakehouse", "Base", "item", "p3", 0),
    ]
    df = spark.createDataFrame(
        rows, "environment string, layer string, item_type string, item_name string, id_kind string, id string, position int"
    )
    out = xref.ordered_id_map(xref.xref_environments(df, "dev", ["tst", "prd"]), "primary_id").collect()
    assert [(r.primary_id, r.tst, r.prd, r.label) for r in out] == [
        ("d1", "t1", None, "Lakehouse Guid - Base"),
        ("d2", "t2b", None, "Lakehouse Guid - Gold"),
        ("d3", None, "p3", "Lakehouse Guid - Base"),
        ("d1e", "t1e", None, "SQL Analytics Endpoint Guid - Base"),
    ]


def test_definition_to_ids(spark):
    definition = {
        "name": "Shop - {layer} [{environment}]",
        "layers": {
            "Ingest": {"workspace_id": "w1"},
            "Store": {"items": {"Lakehouse": [{"item_name": "Base", "id": "i1", "sql_endpoint_id": "e1"}, {"item_name": "Gold"}]}},
        },
    }
    df = spark.createDataFrame([("dev", json.dumps(definition))], "environment string, definition string")
    items = xref.explode_definition(df, "definition", ["environment"])
    assert [(r.layer, r.item_type, r.position, r.item_name) for r in items.collect()] == [
        ("Store", "Lakehouse", 0, "Base"),
        ("Store", "Lakehouse", 1, "Gold"),
    ]
    ids = {(r.item_name, r.id_kind, r.id) for r in xref.definition_ids(df, "definition", ["environment"]).collect()}
    assert ids == {("Base", "item", "i1"), ("Base", "sql_endpoint", "e1"), ("Ingest", "workspace", "w1")}
    tst = json.dumps(definition).replace("i1", "i2").replace("w1", "w2")
    both = df.union(spark.createDataFrame([("tst", tst)], df.schema))
    found = xref.xref_environments(xref.definition_ids(both, "definition", ["environment"]), "dev", ["tst"])
    assert [(r.primary_id, r.tst, r.label) for r in xref.ordered_id_map(found, "primary_id").collect()] == [
        ("w1", "w2", "Workspace Guids - Ingest"),
        ("i1", "i2", "Lakehouse Guid - Base"),
        ("e1", "e1", "SQL Analytics Endpoint Guid - Base"),
    ]
    with pytest.raises(Exception, match="(?i)malformed"):
        xref.explode_definition(spark.createDataFrame([("{oops",)], "definition string"), "definition", []).collect()


def test_assign_icons(spark):
    def coded(colour):
        return base64.b64encode(f'<svg fill="{colour}"/>'.encode()).decode()

    names = spark.createDataFrame([("Shop Prepare [DEV]",), ("Shop Store",), ("Shop Ingest prd",), ("Shop",)], "name string")
    entries = spark.createDataFrame([("Notebook", coded("none")), ("Lakehouse", coded("none"))], "title string, payload string")
    out = assign_icons(names, "name", {"prepare": "Notebook", "store": "Lakehouse", "ingest": "Pipelines"}, entries, {"dev": "#1", "prd": "#2"})
    assert {r.name: (r.icon_title, r.icon) for r in out.collect()} == {
        "Shop Prepare [DEV]": ("Notebook", coded("#1")),
        "Shop Store": ("Lakehouse", coded("none")),
        "Shop Ingest prd": ("Pipelines", None),
        "Shop": (None, None),
    }
    reset = assign_icons(names, "name", {"prepare": "", "store": "Lakehouse"}, entries, {"dev": "#1"})
    assert {r.name: r.icon for r in reset.collect()}["Shop Prepare [DEV]"] == ""
