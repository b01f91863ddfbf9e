"""Files as the Python readers of landed data open them."""

from __future__ import annotations

from pyarrow import fs


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))
