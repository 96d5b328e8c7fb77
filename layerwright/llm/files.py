"""Files that are not tables, on the storage all executors share."""

from __future__ import annotations

import uuid

from pyarrow import fs


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI and the path on it: local, HDFS, S3, GCS."""
    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    return fs.FileSystem.from_uri(path)


def new_file(folder: str, suffix: str) -> str:
    """A name nobody has used. A lost task that runs again writes another file; only what its last run reported counts."""
    return f"{folder}/{uuid.uuid4().hex}{suffix}"
