"""Files in the shared folder, opened from tasks through Arrow's file systems."""

from __future__ import annotations

import re


def filesystem(path: str):
    """(file system, path in it) of a folder or file named by Spark. A local
    path comes as ``file:/x``, ``file:///x`` or ``/x``; other schemes are
    Arrow's (hdfs, viewfs, s3, gs, abfs)."""
    from pyarrow import fs

    local = re.sub(r"^file:/+", "/", path)
    if local.startswith("/"):
        return fs.LocalFileSystem(), local
    return fs.FileSystem.from_uri(path)
