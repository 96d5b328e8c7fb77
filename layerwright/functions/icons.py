"""Icon libraries: XML whose root text is a JSON list of titled XML drawings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What stands in for a missing title, broken XML and a missing image.
NO_TITLE = "No Title"
INVALID_XML = "Invalid XML"
NO_PAYLOAD = "No Base64 found"
# Fixed value: where the image stands in a cell's style.
IMAGE_IN_STYLE = r"image=data:image/[^,]+,([^;]+)"


def _is_xml(text: Column) -> Column:
    """Whether a text is well-formed XML. The XPath functions would fail the query on one that is not."""
    parsed = F.from_xml(text, "broken string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken"})
    return F.coalesce(F.trim(text) != "", F.lit(False)) & parsed["broken"].isNull()


def _payload(drawing: Column) -> Column:
    styles = F.xpath(drawing, F.lit("/*//mxCell/@style"))
    images = F.transform(styles, lambda style: F.regexp_extract(style, IMAGE_IN_STYLE, 1))
    first_image = F.get(F.filter(images, lambda image: image != ""), F.lit(0))
    return F.when(_is_xml(drawing), F.coalesce(first_image, F.lit(NO_PAYLOAD))).otherwise(F.lit(INVALID_XML))


def _drawings(library: Column) -> Column:
    """``title, back, xml`` of each drawing by title, the last of a title first. Broken libraries have none."""
    listed = F.when(_is_xml(library), F.try_parse_json(F.xpath_string(library, F.lit("/*/text()[1]"))))
    drawings = F.coalesce(F.try_variant_get(listed, "$", "array<struct<title:string,xml:string>>"), F.array())
    entries = F.transform(
        drawings,
        lambda d, place: F.struct(
            F.coalesce(d["title"], F.lit(NO_TITLE)).alias("title"),
            F.negate(place).alias("back"),
            F.coalesce(d["xml"], F.lit("")).alias("xml"),
        ),
    )
    return F.array_sort(entries)


def icon_library_extract(df: DataFrame, library: str, keep: list[str]) -> DataFrame:
    """One row per title of each library: the ``keep`` columns, ``title``, ``payload``. A repeated title has its last payload.

    A library is parsed once, and of its drawings those that stay are parsed once, each as a row of its own.
    """
    parsed = df.select(*keep, _drawings(F.col(library)).alias("__drawings"))
    sorted_drawings = F.col("__drawings")
    last = F.filter(
        sorted_drawings, lambda d, place: (place == 0) | (F.get(sorted_drawings, place - 1)["title"] != d["title"])
    )
    listed = parsed.select("*", F.explode(last).alias("__drawing")).drop("__drawings")
    return listed.select("*", F.col("__drawing.title").alias("title"), _payload(F.col("__drawing.xml")).alias("payload")).drop("__drawing")
