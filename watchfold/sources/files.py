"""Access to the shared file system from Python, on the driver and in tasks."""

from __future__ import annotations

import pyarrow.fs as pafs


def open_filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and name within it of a path as Spark writes them."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
