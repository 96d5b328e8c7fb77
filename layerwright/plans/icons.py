"""Icons for named things: the title by keyword, the image by title, the colour by keyword."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwright.functions.rules import first_match
from layerwright.functions.text import recolor_base64
from layerwright.operators.joins import split_lookup

# Which icon and which colour a keyword in a name stands for.
ICON_RULES = {"prepare": "Notebook", "ingest": "Pipelines", "store": "Lakehouse", "serve": "Dataset"}
COLOUR_RULES = {"dev": "#1E90FF", "tst": "#FFA500", "prd": "#008000"}


def assign_icons(
    df: DataFrame,
    name: str,
    icon_rules: Mapping[str, str],
    entries: DataFrame,
    colour_rules: Mapping[str, str],
) -> DataFrame:
    """``df`` with ``icon_title`` and ``icon``.

    The first icon rule whose keyword stands in ``name`` gives the title,
    ``entries`` (``title, payload``, one row per title) its image, and the first
    colour rule that fits fills it. No rule or no image is NULL, no colour rule
    leaves the image as it is. A rule with an empty title resets the icon: it is empty.
    """
    titled = df.withColumn("icon_title", first_match(F.col(name), icon_rules))
    images = entries.select(F.col("title").alias("icon_title"), F.col("payload").alias("__payload"))
    # A few titles for all rows: hot keys, and the images often come out of an aggregation.
    joined = split_lookup(titled, images, ["icon_title"], "left")
    image = F.col("__payload")
    filled = {keyword: recolor_base64(image, colour) for keyword, colour in colour_rules.items()}
    icon = F.when(F.col("icon_title") == "", "").otherwise(first_match(F.col(name), filled, default=image))
    return joined.withColumn("icon", icon).select(*df.columns, "icon_title", "icon")
