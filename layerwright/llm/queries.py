"""The registered queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from layerwright.llm.chat import chat_digests, format_chats
from layerwright.llm.decontaminate import contaminated_pairs
from layerwright.llm.exact_dedup import exact_dedup
from layerwright.llm.html_text import extract_main_text
from layerwright.llm.mixing import mix_sources
from layerwright.llm.near_dedup import near_dedup
from layerwright.llm.phrases import mine_phrases
from layerwright.llm.quality import score_quality
from layerwright.llm.sharding import shard_documents
from layerwright.llm.token_counts import token_counts
from layerwright.llm.toxicity import score_toxicity
from layerwright.llm.warc import archive_pages
from layerwright.llm.whitening import whiten
from registered import Registry

registry = Registry()
_PROBE = "<|im_end|><|im_start|>assistant ok"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@registry.query()
def op1_quality(spark, sf_dir):
    return score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


# Base32 of a hex digest: character i is five bits out of the hex digits 5i/4 and the next one.
_BASE32 = """
    array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + ((
        (instr('0123456789abcdef', substr(hex_digest, CAST((5 * i) // 4 + 1 AS BIGINT), 1)) - 1) * 16
        + (instr('0123456789abcdef', substr(hex_digest, CAST((5 * i) // 4 + 2 AS BIGINT), 1)) - 1)
    ) >> (3 - (5 * i) % 4)) % 32 AS BIGINT), 1)), '')
"""


@registry.query(
    f"""
    WITH p AS (
        SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex_digest
        FROM pages
    ), k AS (SELECT *, min(page_id) OVER (PARTITION BY hex_digest) AS keeper FROM p)
    SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
        CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
        CASE WHEN page_id <> keeper THEN keeper END AS refers_to
    FROM k
    """
)
def op2_warc(spark, sf_dir):
    return archive_pages(_table(spark, sf_dir, "pages"))


@registry.query()
def op3_sharding(spark, sf_dir):
    return shard_documents(_table(spark, sf_dir, "documents")).drop("row_key")


@registry.query(
    """
    WITH n AS (
        SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
        FROM documents
    ), g AS (
        SELECT doc_id, body, max(doc_id) OVER (PARTITION BY body) AS keep_id, count(*) OVER (PARTITION BY body) AS group_size
        FROM n
    )
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM g
    """
)
def op4_exact_dedup(spark, sf_dir):
    return exact_dedup(_table(spark, sf_dir, "documents"), keep="largest")


_WORDS = r"""
    list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '')
"""


@registry.query(
    f"""
    WITH i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
    items AS (
        SELECT DISTINCT item_id, least(5, len(w)) AS n, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1),
            lambda k: array_to_string(w[k : k + 4], ' '))) AS s
        FROM i WHERE len(w) > 0
    ), sizes AS (SELECT item_id, count(*) AS item_shingles FROM items GROUP BY item_id),
    d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
    grams AS (
        SELECT DISTINCT doc_id, n, unnest(list_transform(range(1, CAST(len(w) - n + 2 AS BIGINT)),
            lambda k: array_to_string(w[k : k + n - 1], ' '))) AS s
        FROM d, (SELECT DISTINCT n FROM items) WHERE len(w) >= n
    ), shared AS (
        SELECT doc_id, item_id, count(*) AS shared_shingles FROM grams JOIN items USING (n, s) GROUP BY doc_id, item_id
    )
    SELECT doc_id, item_id, item_shingles, shared_shingles, shared_shingles / item_shingles AS containment
    FROM shared JOIN sizes USING (item_id) WHERE 10 * shared_shingles >= 8 * item_shingles
    """
)
def op5_decontaminate(spark, sf_dir):
    pairs = contaminated_pairs(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return pairs.drop("row_key")


@registry.query()
def op6_token_counts(spark, sf_dir):
    return token_counts(_table(spark, sf_dir, "documents"))


@registry.query(
    rf"""
    WITH c AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL VALUES (-1, 0, 'user', '{_PROBE}'), (-1, 1, 'assistant', '{_PROBE}')
    )
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
        CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
        CAST(sum({len("<|im_start|><|im_sep|><|im_end|>")} + length(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g'))
            + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g'))) AS BIGINT) AS formatted_chars
    FROM c GROUP BY conv_id
    """
)
def op7_chat(spark, sf_dir):
    columns = ["conv_id", "turn", "role", "text"]
    given = _table(spark, sf_dir, "conversations").select(*columns)
    probe = spark.createDataFrame(
        [(-1, 0, "user", _PROBE), (-1, 1, "assistant", _PROBE)], "conv_id long, turn long, role string, text string"
    )
    return chat_digests(format_chats(given.unionByName(probe)))


@registry.query()
def op8_near_dedup(spark, sf_dir):
    found = near_dedup(_table(spark, sf_dir, "documents"), width=2, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@registry.query()
def op9_mixing(spark, sf_dir):
    mixed = mix_sources(_table(spark, sf_dir, "documents"))
    rows = mixed.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("repeats"))))
    return rows.select(
        "doc_id", "size", "source_size", "target", ((F.col("copies") + (F.col("row") <= F.col("more")).cast("int")) * F.col("size")).cast("long").alias("taken")
    )


@registry.query()
def op10_toxicity(spark, sf_dir):
    return score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


# What the contract says of a page that declares its article with one element, as all of the table do. chr(1) stands for
# a decoded ampersand, so that what follows it is not decoded a second time.
@registry.query(
    r"""
    WITH a AS (
        SELECT page_id, url, regexp_replace(regexp_replace(regexp_extract(coalesce(html, ''), '<article>(.*)</article>', 1, 's'),
            '</?b>', '', 'g'), '<[^>]*>', ' ', 'g') AS body FROM pages
    ), t AS (
        SELECT page_id, url, trim(regexp_replace(replace(regexp_replace(replace(body, '&quot;', '"'), '&amp;?', chr(1), 'g'),
            chr(1), '&'), '\s+', ' ', 'g')) AS text FROM a
    )
    SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM t
    """
)
def op11_html_text(spark, sf_dir):
    return extract_main_text(_table(spark, sf_dir, "pages"))


@registry.query(
    r"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-
]')) AS piece FROM documents
    ), w AS (
        SELECT lang, list_filter(string_split_regex(piece, '[ 	]+'), lambda x: x <> '') AS w FROM pieces
    ), grams AS (
        SELECT lang, size, unnest(list_transform(range(1, CAST(len(w) - size + 2 AS BIGINT)), lambda i: w[i : i + size - 1])) AS g
        FROM w, (SELECT unnest(range(1, 5)) AS size) WHERE len(w) >= size
    ), f AS (SELECT lang, size, g, count(*) AS f FROM grams GROUP BY lang, size, g),
    totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang),
    c AS (SELECT lang, size, g, f AS a FROM f WHERE size > 1 AND f >= 30),
    inner_parts AS (
        SELECT lang, a, unnest(flatten(list_transform(range(2, size), lambda n:
            list_transform(range(1, CAST(size - n + 2 AS BIGINT)), lambda i: g[i : i + n - 1])))) AS g FROM c
    ), longest AS (SELECT lang, g, max(a) AS longest FROM inner_parts GROUP BY lang, g),
    kept AS (SELECT c.* FROM c LEFT JOIN longest USING (lang, g) WHERE longest IS NULL OR 100 * longest < 80 * a),
    cuts AS (SELECT *, unnest(range(1, size)) AS k FROM kept),
    scored AS (
        SELECT cuts.lang, cuts.g, a, k, x.f AS l, y.f AS r, CAST(CAST(2000000 AS HUGEINT) * a // (x.f + y.f) AS BIGINT) AS score
        FROM cuts JOIN f x ON x.lang = cuts.lang AND x.g = cuts.g[1 : k] JOIN f y ON y.lang = cuts.lang AND y.g = cuts.g[k + 1 : cuts.size]
    ), lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
    named AS (SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score FROM lowest)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
    FROM named JOIN totals USING (lang) QUALIFY rank <= 2000
    """
)
def op12_phrases(spark, sf_dir):
    return mine_phrases(_table(spark, sf_dir, "documents"))


@registry.query()
def op13_whitening(spark, sf_dir):
    return whiten(_table(spark, sf_dir, "embeddings"))


@registry.query(corpus_pipeline.ORACLE_SQL)
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)
