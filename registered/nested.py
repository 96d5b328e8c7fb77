"""Trees, page HTML, text replacement, overlays, rules, tokens, activities."""

from __future__ import annotations

from pyspark.sql import functions as F

from layerwright.functions import claims, icons, projections, rules, text
from layerwright.functions.overlay import merge_overlay
from layerwright.operators import dag, html, metadata, replace, tree, xref
from registered import Registry, inputs
from registered.inputs import table

registry = Registry()
ANCHOR = "supported-identities"


@registry.query(
    f"""WITH RECURSIVE nodes AS ({inputs.TREE_NODES}), walk AS (
            SELECT id, '' AS path, title, href, 0 AS depth, CAST(ord AS VARCHAR) AS sort_key
              FROM nodes WHERE parent_id IS NULL AND title <> 'Overview'
            UNION ALL
            SELECT n.id, w.path || '|' || w.title, n.title, n.href, w.depth + 1, w.sort_key || ',' || n.ord
              FROM walk w JOIN nodes n ON n.parent_id = w.id WHERE n.title <> 'Overview')
        SELECT path, title, href, CAST(depth AS INTEGER) AS depth, sort_key FROM walk WHERE href IS NOT NULL"""
)
def tree_flatten(spark, sf):
    flat = tree.tree_flatten(inputs.tree_nodes(spark, sf))
    return flat.withColumn("sort_key", F.array_join(F.col("sort_key").cast("array<string>"), ","))


@registry.query(
    """WITH k AS (SELECT c_custkey::VARCHAR AS k, c_name, c_mktsegment, c_acctbal < 0 AS owes FROM customer)
       SELECT k || '/0' AS id, NULL::VARCHAR AS parent_id, 0::BIGINT AS ord, c_name AS title, 'customer/' || k AS href FROM k
       UNION ALL SELECT k || '/1', NULL, 1, 'Overview', NULL FROM k WHERE owes
       UNION ALL SELECT k || '/0/0', k || '/0', 0, c_mktsegment, NULL FROM k
       UNION ALL SELECT k || '/0/0/0', k || '/0/0', 0, 'Balance', 'balance/' || k FROM k
       UNION ALL SELECT k || '/0/1', k || '/0', 1, 'Orders', 'orders/' || k FROM k"""
)
def toc_nodes(spark, sf):
    """A table of contents per customer, three levels deep; those of customers in debt have a second item."""
    leaf = "named_struct('toc_title', 'Balance', 'href', concat('balance/', c_custkey))"
    below = (
        f"array(named_struct('toc_title', c_mktsegment, 'href', CAST(NULL AS STRING), 'children', array({leaf})),"
        " named_struct('toc_title', 'Orders', 'href', concat('orders/', c_custkey), 'children', NULL))"
    )
    first = f"named_struct('toc_title', c_name, 'href', concat('customer/', c_custkey), 'children', {below})"
    second = "named_struct('toc_title', 'Overview', 'href', NULL, 'children', NULL)"
    items = f"IF(c_acctbal < 0, array({first}, {second}), array({first}))"
    tocs = table(spark, sf, "customer").selectExpr("c_custkey", f"parse_json(to_json(named_struct('items', {items}))) AS toc")
    return tree.toc_nodes(tocs, "toc", "c_custkey")


REFERENCES = """SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN text ELSE '[' || doc_id || '] ' || text || ' [' || doc_id * 7 % 3000
       || '][' || n_chars || ']' END AS text FROM documents"""


@registry.query(
    f"""WITH t AS ({REFERENCES}), cut AS (SELECT doc_id, text, regexp_extract_all(text, '\\[[0-9]+\\]') AS tokens,
              string_split_regex(text, '\\[[0-9]+\\]') AS pieces FROM t),
            token AS (SELECT doc_id, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS place, pieces FROM cut),
            put AS (SELECT doc_id, string_agg(pieces[place] || coalesce('<' || c_name || '>', token), '' ORDER BY place)
                      || any_value(pieces[len(pieces)]) AS text
                      FROM token LEFT JOIN customer ON token = '[' || c_custkey || ']' GROUP BY doc_id)
       SELECT doc_id, length(new) AS n_chars, md5(new) AS text_md5
         FROM (SELECT t.doc_id, coalesce(put.text, t.text) AS new FROM t LEFT JOIN put ON put.doc_id = t.doc_id)"""
)
def replace_from_table(spark, sf):
    """Documents that refer to customers by number, four of five of them, get the names."""
    texts = table(spark, sf, "documents").selectExpr(
        "doc_id",
        "IF(doc_id % 5 = 0, text, concat('[', doc_id, '] ', text, ' [', doc_id * 7 % 3000, '][', n_chars, ']')) AS text",
    )
    names = table(spark, sf, "customer").selectExpr(
        "concat('[', c_custkey, ']') AS key", "concat('<', c_name, '>') AS value"
    )
    return replace.replace_from_table(texts, "text", names, r"\[[0-9]+\]").selectExpr(
        "doc_id", "CAST(length(text) AS BIGINT) AS n_chars", "md5(text) AS text_md5"
    )


@registry.query(
    """SELECT page_id, string_split('|' || replace(url, '/', '|'), '|')[2] AS service,
              string_split('|' || replace(url, '/', '|'), '|')[4] AS api,
              string_split('|' || replace(url, '/', '|'), '|')[40] AS beyond FROM pages"""
)
def path_split(spark, sf):
    path = F.concat(F.lit("|"), F.translate("url", "/", "|"))
    return table(spark, sf, "pages").select(
        "page_id",
        text.path_item(path, 1).alias("service"),
        text.path_item(path, 3).alias("api"),
        text.path_item(path, 39).alias("beyond"),
    )


def pages_with_identities(spark, sf):
    """Stored pages with an identity table behind them: secure pages have the anchor, paged ones the second key."""
    decoy = "<table><tbody><tr><td>User</td><td>Wrong</td></tr></tbody></table>"
    user = "<tr><td> <b>User</b>\n</td><td>{answer}</td></tr>"
    service = "<tr><td>Service principal<br> and <a href='/mi'>Managed &amp; identities</a></td><td><p>No &gt; yes</td></tr>"
    answer = F.when(F.col("url").contains("example.com"), "Yes").otherwise("No")
    table_html = F.concat(
        F.lit("<table><thead><tr><th>Identity</th><th>Support</th></tr></thead><tbody>"),
        text.fill_template(F.lit(user), {"answer": answer}),
        F.when(F.col("url").contains("?"), service).otherwise(""),
        F.lit("</tbody></table>"),
    )
    heading = F.when(F.col("url").startswith("https"), f'<h2 id="{ANCHOR}">Identities</h2>').otherwise("<h2>Identities</h2>")
    return table(spark, sf, "pages").select(
        "page_id", "url", F.concat("html", F.lit(decoy), heading, table_html, F.lit(decoy)).alias("html")
    )


IDENTITY_FACTS = """SELECT page_id, url,
       CASE WHEN NOT starts_with(url, 'https') THEN 'N/A' WHEN contains(url, 'example.com') THEN 'Yes' ELSE 'No' END
         AS SupportUserIdentity,
       CASE WHEN NOT starts_with(url, 'https') THEN 'N/A' WHEN contains(url, '?') THEN 'No > yes' END
         AS SupportSpnAndMi FROM pages"""
IDENTITY_NAMES = {"SupportUserIdentity": "User", "SupportSpnAndMi": "Service principalandManaged & identities"}


@registry.query(IDENTITY_FACTS)
def html_table_extract(spark, sf):
    return html.html_table_extract(pages_with_identities(spark, sf), "html", ANCHOR, IDENTITY_NAMES)


@registry.query(
    """SELECT page_id, 0 AS position, 'User' AS key, CASE WHEN contains(url, 'example.com') THEN 'Yes' ELSE 'No' END AS value
         FROM pages WHERE starts_with(url, 'https')
       UNION ALL SELECT page_id, 1, 'Service principalandManaged & identities', 'No > yes'
         FROM pages WHERE starts_with(url, 'https') AND contains(url, '?')"""
)
def html_table_rows(spark, sf):
    return html.html_table_rows(pages_with_identities(spark, sf).drop("url"), "html", ANCHOR)


@registry.query(
    """SELECT page_id, coalesce(nullif(regexp_extract(html, '(?is)<title>(.*?)</title>', 1), ''), 'N/A') AS title,
              CAST(len(regexp_extract_all(html, '(?i)<a ')) AS BIGINT) AS n_links,
              contains(html, 'id="supported-identities"') AS has_anchor FROM pages"""
)
def html_field_extract(spark, sf):
    return html.html_field_extract(table(spark, sf, "pages").select("page_id", "html"), "html", ANCHOR)


SWAPS = {"the": "and", "and": "the", "(": "[", " de ": " von "}


@registry.query(
    """SELECT doc_id, length(t) AS n_chars, md5(t) AS text_md5 FROM (SELECT doc_id,
              replace(replace(replace(replace(replace(replace(replace(replace(text, 'the', chr(1)), 'and', chr(2)),
              '(', chr(3)), ' de ', chr(4)), chr(1), 'and'), chr(2), 'the'), chr(3), '['), chr(4), ' von ') AS t
         FROM documents)"""
)
def multi_replace_single_pass(spark, sf):
    replaced = text.replace_in_one_pass(F.col("text"), SWAPS)
    return table(spark, sf, "documents").select("doc_id", replaced.alias("t")).selectExpr(
        "doc_id", "CAST(length(t) AS BIGINT) AS n_chars", "md5(t) AS text_md5"
    )


@registry.query(
    """SELECT doc_id, length(t) AS n_chars, md5(t) AS text_md5 FROM (SELECT doc_id,
              replace(replace(replace(replace(text, 'the', 'and'), 'and', 'the'), '(', '['), ' de ', ' von ') AS t
         FROM documents)"""
)
def multi_replace_chain(spark, sf):
    replaced = text.replace_in_turn(F.col("text"), SWAPS)
    return table(spark, sf, "documents").select("doc_id", replaced.alias("t")).selectExpr(
        "doc_id", "CAST(length(t) AS BIGINT) AS n_chars", "md5(t) AS text_md5"
    )


@registry.query("SELECT p_partkey, p_name || ' - ' || p_type || ' [' || p_brand || '] ' || p_type AS full_name FROM part")
def template_fill(spark, sf):
    name = text.fill_template(
        F.concat("p_name", F.lit(" - {layer} [{environment}] {layer}")),
        {"layer": F.col("p_type"), "environment": F.col("p_brand")},
    )
    return table(spark, sf, "part").select("p_partkey", name.alias("full_name"))


_POLICIES = """CASE c_mktsegment WHEN 'BUILDING' THEN '0' WHEN 'MACHINERY' THEN '1' WHEN 'HOUSEHOLD' THEN '2' END"""


@registry.query(
    f"""WITH c AS (SELECT c_custkey, c_nationkey AS n, coalesce({_POLICIES}, '1') AS policy FROM customer)
        SELECT c_custkey,
               'customer ' || c_custkey AS name,
               CASE WHEN policy = '0' THEN '5' ELSE CAST(n AS VARCHAR) END AS budget,
               CASE policy WHEN '0' THEN '["base",7]' WHEN '2' THEN
                    CASE WHEN n = 7 THEN '["base",7,"7"]' ELSE '["base",7,"7",' || n || ']' END
                    ELSE '["7",' || n || ',"base"]' END AS tags,
               CASE WHEN policy = '0' THEN NULL ELSE 'fresh' END AS added,
               'old' AS kept, 'child' AS forced FROM c"""
)
def overlay_merge(spark, sf):
    documents = table(spark, sf, "customer").selectExpr(
        "c_custkey",
        """concat('{"name": "customer ', c_custkey, '", "generic": {"budget": 5, "tags": ["base", 7], "kept": "old",',
                  ' "deep": {"forced": "parent"}}}') AS parent""",
        f"""concat('{{"generic": {{', coalesce(concat('"merge_type": ', {_POLICIES}, ', '), ''), '"budget": ', c_nationkey,
                   ', "tags": ["7", ', c_nationkey, ', "base"], "added": "fresh", "deep": {{"merge_type": 1, "forced": "child"}}}}}}')
            AS child""",
    )
    return merge_overlay(documents, "parent", "child", "m").select(
        "c_custkey",
        F.get_json_object("m", "$.name").alias("name"),
        F.get_json_object("m", "$.generic.budget").alias("budget"),
        F.get_json_object("m", "$.generic.tags").alias("tags"),
        F.get_json_object("m", "$.generic.added").alias("added"),
        F.get_json_object("m", "$.generic.kept").alias("kept"),
        F.get_json_object("m", "$.generic.deep.forced").alias("forced"),
    )


@registry.query(
    """SELECT c_custkey, 'Store' AS layer, 'Lakehouse' AS item_type, 0 AS position, c_name AS item_name,
              NULL ::VARCHAR AS connection_name FROM customer
       UNION ALL SELECT c_custkey, 'Store', 'Lakehouse', 1, c_mktsegment, 'conn-' || c_nationkey FROM customer
       UNION ALL SELECT c_custkey, 'Store', 'SQLDatabase', 0, 'Metadata', 'db' FROM customer
       UNION ALL SELECT c_custkey, 'Model', 'Lakehouse', 0, c_name, 'm' FROM customer WHERE c_acctbal < 0"""
)
def explode_definition(spark, sf):
    definitions = table(spark, sf, "customer").selectExpr(
        "c_custkey",
        """concat('{"name": "Shop - {layer}", "layers": {"Ingest": {"icon": "a.png"}, "Store": {"items": {"Lakehouse": [',
                  '{"item_name": "', c_name, '"}, {"item_name": "', c_mktsegment, '", "connection_name": "conn-', c_nationkey,
                  '"}], "SQLDatabase": [{"item_name": "Metadata", "connection_name": "db", "sql_script": "x.sql"}]}}',
                  IF(c_acctbal < 0, concat(', "Model": {"items": {"Lakehouse": [{"item_name": "', c_name,
                     '", "connection_name": "m"}], "Report": []}}'), ''), '}}') AS definition""",
    )
    items = xref.explode_definition(definitions, "definition", ["c_custkey"])
    return items.drop("id", "sql_endpoint_id", "pbi_connection_id")


@registry.query(
    """SELECT p_partkey, CASE WHEN contains(lower(p_name || ' ' || p_type), 'ring') THEN 'Notebook'
              WHEN contains(lower(p_name || ' ' || p_type), 'red') THEN 'Pipelines'
              WHEN contains(lower(p_name || ' ' || p_type), 'economy') THEN 'Lakehouse'
              WHEN contains(lower(p_name || ' ' || p_type), 'bolt') THEN 'Dataset' END AS icon FROM part"""
)
def rule_first_match(spark, sf):
    keywords = {"ring": "Notebook", "RED": "Pipelines", "economy": "Lakehouse", "bolt": "Dataset"}
    name = F.concat_ws(" ", "p_name", "p_type")
    return table(spark, sf, "part").select("p_partkey", rules.first_match(name, keywords).alias("icon"))


@registry.query(
    """SELECT p_partkey, p_name AS title, base64(encode(p_name)) AS payload FROM part WHERE p_type <> 'SMALL'
       UNION ALL SELECT p_partkey, 'No Title', 'No Base64 found' FROM part WHERE p_type <> 'SMALL'
       UNION ALL SELECT p_partkey, 'broken', 'Invalid XML' FROM part WHERE p_type <> 'SMALL'"""
)
def icon_library_extract(spark, sf):
    drawing = '&lt;mxGraphModel>&lt;root>&lt;mxCell id=\\"0\\"/>&lt;mxCell style=\\"shape=image;image=data:image/svg+xml,{payload};x=1\\"/>&lt;/root>&lt;/mxGraphModel>'
    entries = (
        '[{"title": "broken", "xml": "&lt;a/>"}, {"title": "{title}", "xml": "' + drawing + '"},'
        ' {"xml": "&lt;mxCell/>"}, {"title": "broken", "xml": "&lt;a>"}]'
    )
    library = text.fill_template(
        F.lit(entries), {"title": F.col("p_name"), "payload": text.to_base64(F.col("p_name"))}
    )
    root = F.when(F.col("p_type") == "SMALL", "<mxlibrary>").otherwise("</mxlibrary>")
    parts = inputs.spread(table(spark, sf, "part").select("p_partkey", "p_name", "p_type"))
    libraries = parts.select(
        "p_partkey", F.concat(F.lit("<mxlibrary>"), library, root).alias("library")
    )
    return icons.icon_library_extract(libraries, "library", ["p_partkey"])


@registry.query(
    """SELECT p_partkey, base64(encode('<svg><path fill="#1E90FF" id="' || p_name || '"/><g fill="#1E90FF"/></svg>')) AS icon
         FROM part"""
)
def base64_text_recolor(spark, sf):
    svg = F.concat(F.lit('<svg><path fill="'), "p_brand", F.lit('" id="'), "p_name", F.lit('"/><g fill="none"/></svg>'))
    coded = text.to_base64(svg)
    return table(spark, sf, "part").select("p_partkey", text.recolor_base64(coded, "#1E90FF").alias("icon"))


def _base64url(column):
    return F.rtrim(F.translate(text.to_base64(column), "+/", "-_"), F.lit("="))


@registry.query(
    """SELECT event_id, CASE event_type WHEN 'click' THEN 'User' WHEN 'view' THEN 'app' END AS idtyp,
              event_type <> 'click' AS is_service, CAST(user_id AS VARCHAR) AS sub FROM events"""
)
def token_claims(spark, sf):
    payload = F.to_json(
        F.struct(
            F.col("user_id").cast("string").alias("sub"),
            F.expr("CASE event_type WHEN 'click' THEN 'User' WHEN 'view' THEN 'app' END").alias("idtyp"),
            F.concat(F.lit("café?>~"), "props").alias("note"),
        )
    )
    token = F.concat_ws(".", _base64url(F.lit('{"alg":"none"}')), _base64url(payload), F.lit("c2ln"))
    return table(spark, sf, "events").select("event_id", token.alias("token")).select(
        "event_id",
        claims.token_claim(F.col("token"), "idtyp").alias("idtyp"),
        claims.is_service_identity(F.col("token")).alias("is_service"),
        claims.token_claim(F.col("token"), "sub").alias("sub"),
    )


_COLUMN_LISTS = """CASE event_type WHEN 'click' THEN concat('["user_', user_id, '", "ts"]') WHEN 'view' THEN props
    WHEN 'error' THEN concat('["a", ', user_id, ']') WHEN 'purchase' THEN '[]' ELSE concat('oops ', user_id) END"""


@registry.query(
    """SELECT event_id, event_type IN ('click', 'purchase') AS is_list,
              CASE event_type WHEN 'click' THEN 'user_' || user_id || '/ts' WHEN 'purchase' THEN '' END AS columns FROM events"""
)
def parse_projection_json(spark, sf):
    listed = F.expr(_COLUMN_LISTS)
    parsed = projections.parse_column_list(listed, strict=False)
    return table(spark, sf, "events").select(
        "event_id", projections.is_column_list(listed).alias("is_list"), F.array_join(parsed, "/").alias("columns")
    )


@registry.query(
    f"""SELECT name, '/load/' || name AS path, CASE grp WHEN 'fact' THEN 600 ELSE 300 END AS timeout_per_cell, 1 AS retry,
               10 AS retry_interval, CASE grp WHEN 'fact' THEN 'full' END AS mode,
               CASE grp WHEN 'fact' THEN 2 ELSE 0 END AS n_args, array_to_string(deps, ',') AS dependencies
          FROM ({inputs.ACTIVITIES}) WHERE grp = 'dimension' AND name NOT LIKE 'nation/%4'
        UNION ALL
        SELECT name, '/load/' || name, CASE grp WHEN 'fact' THEN 600 ELSE 300 END, 1, 10,
               CASE grp WHEN 'fact' THEN 'full' END, CASE grp WHEN 'fact' THEN 2 ELSE 0 END, array_to_string(deps, ',')
          FROM ({inputs.ACTIVITIES})"""
)
def dag_from_metadata(spark, sf):
    rows = inputs.orchestrator_rows(spark, sf)
    dimensions = metadata.dag_from_metadata(rows, "dimension")
    every = metadata.dag_from_metadata(rows, only_enabled=False)
    return dimensions.unionByName(every).select(
        "name",
        "path",
        "timeout_per_cell",
        "retry",
        "retry_interval",
        F.try_element_at("args", F.lit("mode")).alias("mode"),
        F.size("args").alias("n_args"),
        F.array_join("dependencies", ",").alias("dependencies"),
    )


@registry.query(f"SELECT name, unnest(deps) AS dependency FROM ({inputs.ACTIVITIES})")
def dag_edges(spark, sf):
    return dag.dag_edges(metadata.dag_from_metadata(inputs.orchestrator_rows(spark, sf), only_enabled=False))


@registry.query(
    f"""WITH RECURSIVE a AS ({inputs.ACTIVITIES}), e AS (SELECT name, unnest(deps) AS dependency FROM a),
             known AS (SELECT * FROM e WHERE dependency IN (SELECT name FROM a)),
             walk AS (SELECT name, 0 AS level FROM a WHERE name NOT IN (SELECT name FROM known)
                      UNION SELECT k.name, w.level + 1 FROM walk w JOIN known k ON k.dependency = w.name)
        SELECT name, CAST(max(level) AS INTEGER) AS level FROM walk GROUP BY name"""
)
def dag_levels(spark, sf):
    return dag.dag_levels(metadata.dag_from_metadata(inputs.orchestrator_rows(spark, sf), only_enabled=False))
