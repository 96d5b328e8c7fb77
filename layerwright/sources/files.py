"""File scans: Parquet, semicolon text, landing text, metadata and whole documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerwright.sources.quoted_text import read_quoted_text

# The formats a metadata row may name, with their reader options.
FORMATS = {
    "parquet": {},
    "csv": {"sep": ";", "header": "true"},
}

# How landing text is written, and so how it is read.
LANDING_TEXT_OPTIONS = {
    "sep": ",",
    "header": "true",
    "quote": '"',
    "escape": "\\",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

LANDING_METADATA_SCHEMA = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("format", T.StringType()),
        T.StructField("destination", T.StringType()),
        T.StructField("projected_columns", T.StringType()),
    ]
)


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def scan_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Semicolon text with a header. Every column is a string, an empty field is NULL.

    ``multi_line`` admits line breaks inside quotes, at the price of files that
    cannot be split.
    """
    return spark.read.options(**FORMATS["csv"], multiLine=multi_line).csv(path)


def scan_by_format(spark: SparkSession, path: str, source_format: str) -> DataFrame:
    """Read ``path`` with the reader a metadata value names."""
    if source_format not in FORMATS:
        raise ValueError(f"unknown source format {source_format!r}, expected one of {sorted(FORMATS)}")
    return spark.read.format(source_format).options(**FORMATS[source_format]).load(path)


def read_landing_text(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    multi_line: bool = True,
    split_files: bool = False,
) -> DataFrame:
    """Read a landing folder with its ``year/month/day`` partition columns.

    Line breaks inside quotes are admitted unless ``multi_line`` is off; the
    folder holds one file per writing task, so the scan stays parallel by file.
    With ``split_files`` it is parallel within a file too, for a few large files;
    the text is then read twice, and every field with a quote in it is quoted.
    """
    reader = spark.read.options(**LANDING_TEXT_OPTIONS, multiLine=multi_line, basePath=path)
    if schema is not None:
        reader = reader.schema(schema)
    rows = reader.csv(path)
    return read_quoted_text(spark, rows, path, LANDING_TEXT_OPTIONS) if split_files and multi_line else rows


def scan_json_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Landing metadata rows from a file that holds one JSON list.

    The column list may stand there as a JSON array or as text with one; both
    arrive as JSON text. Broken JSON is an error, and so is an entry without
    ``source``, ``format`` or ``destination``.
    """
    reader = spark.read.schema(LANDING_METADATA_SCHEMA).options(multiLine=True, mode="FAILFAST")
    rows = reader.json(path).select(*LANDING_METADATA_SCHEMA.names)
    needed = {
        name: F.coalesce(name, F.raise_error(F.lit(f"an entry of the landing metadata has no {name}")).cast("string"))
        for name in ("source", "format", "destination")
    }
    return rows.withColumns(needed)


def scan_text_document(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    """One row per JSON text file: ``path``, ``document``.

    The lines are joined without a separator before parsing. With a ``schema``
    the document is a struct, else a variant. Broken JSON is an error.
    """
    text = F.regexp_replace(F.col("value"), r"\r\n|\r|\n", "")
    document: Column = F.parse_json(text) if schema is None else F.from_json(text, schema, {"mode": "FAILFAST"})
    return (
        spark.read.text(path, wholetext=True)
        .withColumn("path", F.col("_metadata.file_path"))
        .select("path", document.alias("document"))
    )
