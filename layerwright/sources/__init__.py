from layerwright.sources.files import (
    FORMATS,
    read_landing_text,
    scan_by_format,
    scan_csv,
    scan_json_metadata,
    scan_parquet,
    scan_text_document,
)
from layerwright.sources.generated import generate_dates, inline_rows
from layerwright.sources.jdbc import scan_jdbc_query, scan_jdbc_table
from layerwright.sources.tables import scan_table

__all__ = [
    "FORMATS",
    "generate_dates",
    "inline_rows",
    "read_landing_text",
    "scan_by_format",
    "scan_csv",
    "scan_jdbc_query",
    "scan_jdbc_table",
    "scan_json_metadata",
    "scan_parquet",
    "scan_table",
    "scan_text_document",
]
