"""The documentation dataset: articles from a table of contents, facts from their pages, and the report on them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwright.functions.text import path_item
from layerwright.operators.html import NOT_AVAILABLE, html_table_extract
from layerwright.operators.measures import coverage_flag, disconnected_measure_join, row_count, yes_count
from layerwright.operators.ordering import order_rows
from layerwright.operators.projection import ModelColumn
from layerwright.operators.setops import union_distinct
from layerwright.operators.tree import tree_flatten
from layerwright.sources.generated import inline_rows

# Where the supported identities stand in a page. The second key
# is what is left of a cell whose text nodes are stripped and joined.
IDENTITY_ANCHOR = "microsoft-entra-supported-identities"
IDENTITY_KEYS = {
    "SupportUserIdentity": "User",
    "SupportSpnAndMi": "Service principalandManaged identities",
}

# The selectable identities.
IDENTITY_SCHEMA = "IdentityNo int, Identity string, Identity_desc string, IdentitySupportArticle string"
IDENTITIES = [
    (1, "User", "Supports user identity", ""),
    (
        2,
        "Service principal and Managed identities",
        "Supports Service principal and Managed identities",
        "https://learn.microsoft.com/en-us/entra/identity-platform/app-objects-and-service-principals"
        "#service-principal-object",
    ),
]
IDENTITY_MEASURES = {1: "SupportUserIdentity", 2: "SupportSpnAndMi"}

# The model columns.
ARTICLE_MODEL = [
    ModelColumn("Title", "Title"),
    ModelColumn("Service", "Service"),
    ModelColumn("API", "API"),
    ModelColumn("Article Url", "ArticleUrl"),
    ModelColumn("Supports User", "SupportUserIdentity"),
    ModelColumn("Supports Service principal & Managed Identities", "SupportSpnAndMi"),
]
IDENTITY_MODEL = [
    ModelColumn("IdentityNo", "IdentityNo", "integer", hidden=True),
    ModelColumn("Identity", "Identity", sort_by="IdentityNo"),
    ModelColumn("Identity Description", "Identity_desc"),
    ModelColumn("Identity Support Article Url", "IdentitySupportArticle"),
]


def supported_identities(spark: SparkSession) -> DataFrame:
    return union_distinct(*[inline_rows(spark, [row], IDENTITY_SCHEMA) for row in IDENTITIES])


def docs_table(
    nodes: DataFrame,
    pages: DataFrame,
    base_url: str,
    anchor: str = IDENTITY_ANCHOR,
    names: Mapping[str, str] = IDENTITY_KEYS,
) -> DataFrame:
    """``Title, ArticleUrl``, a column per name, ``Service, API`` of every article.

    ``nodes`` is a table of contents as rows, ``pages`` the stored ``url, html``,
    one row per url. An article whose page is not stored or has no identity table
    gets ``N/A``.
    """
    articles = tree_flatten(nodes).withColumn("ArticleUrl", F.concat(F.lit(base_url), "href"))
    facts = html_table_extract(pages.select(F.col("url").alias("ArticleUrl"), "html"), "html", anchor, names)
    facts = facts.withColumn("__stored", F.lit(True))
    found = [F.when(F.col("__stored"), F.col(n)).otherwise(NOT_AVAILABLE).alias(n) for n in names]
    return articles.join(facts, "ArticleUrl", "left").select(
        F.col("title").alias("Title"),
        "ArticleUrl",
        *found,
        path_item(F.col("path"), 1).alias("Service"),
        path_item(F.col("path"), 2).alias("API"),
    )


def report_articles(docs: DataFrame, selected: int | None = None) -> DataFrame:
    """The listed articles with a measure above 0, ordered by service.

    Without a selected identity the measure is the row count, with one it is the
    count of rows that support it.
    """
    measure = yes_count(IDENTITY_MEASURES[selected]) if selected in IDENTITY_MEASURES else row_count()
    counted = docs.groupBy("Service", "API", "Title", "ArticleUrl").agg(measure.alias("measure"))
    return order_rows(counted.where("measure > 0"), "Service").drop("measure")


def report_identities(docs: DataFrame, identities: DataFrame) -> DataFrame:
    """Each identity with its article and whether all, some or no rows support it, ordered by that mark."""
    measured = disconnected_measure_join(docs, identities, "IdentityNo", IDENTITY_MEASURES)
    flagged = measured.withColumn("Supported", coverage_flag(F.col("measure"), F.col("n_rows")))
    listed = flagged.groupBy("Identity", "Supported").agg(F.min("IdentitySupportArticle").alias("ArticleUrl"))
    return order_rows(listed.select("Identity", "ArticleUrl", "Supported"), "Supported")
