"""File sinks: Parquet folders and dated landing text."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame

from layerwright.session import hadoop_path
from layerwright.sources.files import LANDING_TEXT_OPTIONS


def write_path_overwrite(df: DataFrame, path: str) -> None:
    """Replace the Parquet folder ``path`` by the rows of ``df``.

    They are written beside it, under a name readers of the folder above skip,
    and take its place when they are complete: what fails leaves the old folder,
    and rows may come from the folder itself.
    """
    above, name = path.rstrip("/").rsplit("/", 1) if "/" in path.rstrip("/") else (".", path)
    mark = uuid.uuid4().hex[:12]
    incoming, old = f"{above}/_incoming_{mark}_{name}", f"{above}/_old_{mark}_{name}"
    files, target = hadoop_path(df.sparkSession, path)
    try:
        df.write.parquet(incoming)
        replaced = files.exists(target)
        if replaced:
            _move(df, path, old)
        try:
            _move(df, incoming, path)
        except Exception:
            if replaced:
                _move(df, old, path)
            raise
        if replaced:
            files.delete(hadoop_path(df.sparkSession, old)[1], True)
    finally:
        files.delete(hadoop_path(df.sparkSession, incoming)[1], True)


def _move(df: DataFrame, path: str, to: str) -> None:
    files, source = hadoop_path(df.sparkSession, path)
    if not files.rename(source, hadoop_path(df.sparkSession, to)[1]):
        raise OSError(f"cannot rename {path} to {to}")


def landing_folder(root: str, connection_name: str, table_name: str, run_time: datetime) -> str:
    """``root/connection/table/year=yyyy/month=MM/day=dd`` of the run time in UTC."""
    if run_time.tzinfo is None:
        raise ValueError("run_time needs a time zone")
    day = run_time.astimezone(timezone.utc)
    return f"{root.rstrip('/')}/{connection_name}/{table_name}/year={day:%Y}/month={day:%m}/day={day:%d}"


def write_landing_text(
    df: DataFrame,
    root: str,
    connection_name: str,
    table_name: str,
    run_time: datetime,
    rows_per_file: int = 5_000_000,
) -> str:
    """Write ``df`` as quoted text into the folder of its day and return that folder.

    A second run on one day replaces the first. NULL and the empty text are
    both written as ``""``. Long outputs are cut into files of ``rows_per_file``
    rows, because text with line breaks inside quotes is read back file by file.
    """
    folder = landing_folder(root, connection_name, table_name, run_time)
    layout = {"quoteAll": True, "extension": "txt", "maxRecordsPerFile": rows_per_file}
    df.write.mode("overwrite").options(**LANDING_TEXT_OPTIONS, **layout).csv(folder)
    return folder
