"""Scalar functions, grouped as the inventory groups them."""

from __future__ import annotations

from pyspark.sql import functions as F

from layerwright.functions import dates, numbers, text
from registered import Registry
from registered.inputs import table

registry = Registry()


@registry.query(
    """SELECT event_id, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_key, CAST(CAST(ts AS DATE) AS VARCHAR) AS day,
              CAST(year(ts) AS INTEGER) AS y, CAST(month(ts) AS INTEGER) AS m, CAST(day(ts) AS INTEGER) AS d,
              strftime(ts, '%Y-%m-%d %H:%M:%S (UTC)') AS stamp, strftime(ts, 'year=%Y/month=%m/day=%d') AS folder FROM events"""
)
def scalar_dates(spark, sf):
    ts = F.col("ts")
    parts = dates.day_parts(ts)
    return table(spark, sf, "events").select(
        "event_id",
        dates.date_key(ts).alias("date_key"),
        F.to_date(ts).cast("string").alias("day"),
        parts["Year"].alias("y"),
        parts["Month"].alias("m"),
        parts["Day"].alias("d"),
        dates.utc_stamp(ts).alias("stamp"),
        dates.utc_folder(ts).alias("folder"),
    )


@registry.query(
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS INTEGER) END AS customer,
              CASE WHEN o_orderstatus <> 'P' THEN CAST(trunc(o_totalprice) AS INTEGER) END AS whole,
              CASE WHEN o_orderstatus = 'P' OR o_custkey = 0 THEN NULL ELSE o_totalprice / o_custkey END AS ratio FROM orders"""
)
def scalar_numbers(spark, sf):
    """Casts and division on text that holds N/A."""
    texts = table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        "IF(o_orderstatus = 'P', 'N/A', CAST(o_custkey AS STRING)) AS c",
        "IF(o_orderstatus = 'P', 'N/A', CAST(o_totalprice AS STRING)) AS p",
    )
    return texts.select(
        "o_orderkey",
        numbers.int_or_null(texts, "c").alias("customer"),
        numbers.int_or_null(texts, "p").alias("whole"),
        numbers.ratio_or_null(F.col("p"), F.col("c")).alias("ratio"),
    )


@registry.query(
    """SELECT p_partkey, p_name || ' ' || p_brand AS full_name, lower(p_type) AS lowered, contains(p_name, 'ring') AS has_ring,
              starts_with(p_name, 'red') AS is_red, length(replace(p_name, 'red', '')) = 0 AS is_empty,
              replace(p_name, 'ring', 'RING') AS replaced, trim('  ' || p_name || ' ') AS stripped,
              p_name || ' ' || p_type AS spaced, regexp_replace(p_name, '[aeiou]+', '_', 'g') AS masked,
              regexp_extract(p_brand, '#([0-9]+)', 1) AS brand_no, string_split(p_name, ' ')[2] AS second_word FROM part"""
)
def scalar_text(spark, sf):
    name = F.col("p_name")
    return table(spark, sf, "part").select(
        "p_partkey",
        text.full_name(name, F.col("p_brand")).alias("full_name"),
        F.lower("p_type").alias("lowered"),
        name.contains("ring").alias("has_ring"),
        name.startswith("red").alias("is_red"),
        (F.length(F.replace(name, F.lit("red"), F.lit(""))) == 0).alias("is_empty"),
        text.replace_in_turn(name, {"ring": "RING"}).alias("replaced"),
        F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("stripped"),
        text.normalize_space(F.concat(F.lit(" "), name, F.lit(" \t\n "), "p_type", F.lit("  "))).alias("spaced"),
        F.regexp_replace(name, "[aeiou]+", "_").alias("masked"),
        F.regexp_extract("p_brand", "#([0-9]+)", 1).alias("brand_no"),
        text.path_item(name, 1, " ").alias("second_word"),
    )


@registry.query(
    """SELECT doc_id, base64(encode(text)) AS coded, md5(text) AS text_md5, list_contains(string_split(text, ' '), 'the') AS has_the,
              len(string_split(text, ' ')) AS n_words FROM documents"""
)
def scalar_binary_arrays(spark, sf):
    words = F.split("text", " ")
    coded = text.to_base64(F.col("text"))
    return table(spark, sf, "documents").select(
        "doc_id",
        coded.alias("coded"),
        F.md5(F.unbase64(coded)).alias("text_md5"),
        F.array_contains(words, "the").alias("has_the"),
        F.size(words).cast("bigint").alias("n_words"),
    )


@registry.query(
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, coalesce(json_extract_string(props, '$.z'), 'none') AS z,
              '{"event_type":"' || event_type || '","k":' || json_extract_string(props, '$.k') || '}' AS printed,
              CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) > 50 THEN 'high' WHEN event_type = 'click' THEN 'click'
                   ELSE 'low' END AS switched FROM events"""
)
def scalar_json_maps(spark, sf):
    parsed = table(spark, sf, "events").withColumn("m", F.from_json("props", "map<string,int>"))
    k = F.try_element_at("m", F.lit("k"))
    return parsed.select(
        "event_id",
        k.alias("k"),
        F.coalesce(F.try_element_at("m", F.lit("z")).cast("string"), F.lit("none")).alias("z"),
        F.to_json(F.struct("event_type", k.alias("k"))).alias("printed"),
        F.when(k > 50, "high").when(F.col("event_type") == "click", "click").otherwise("low").alias("switched"),
    )


@registry.query("SELECT page_id, url AS id, CAST(NULL AS VARCHAR) AS missing FROM pages", name="scalar_xml")
def xml_path(spark, sf):
    """A value picked by name out of XML made from the rows."""
    escaped = text.replace_in_turn(F.col("url"), {"&": "&amp;", "<": "&lt;"})
    xml = F.concat(F.lit("<root><value><name> a  b </name><id>"), escaped, F.lit("</id></value></root>"))
    return table(spark, sf, "pages").select(
        "page_id",
        F.xpath_string(xml, F.lit('/root/value[normalize-space(name)="a b"]/id')).alias("id"),
        F.nullif(F.xpath_string(xml, F.lit('/root/value[normalize-space(name)="c"]/id')), F.lit("")).alias("missing"),
    )
