"""Files that tasks open themselves, through Arrow's file systems."""

from __future__ import annotations

import re


def open_fs(uri: str):
    """(file system, path in it) of a file or folder that Spark names (a path
    as it stands, not percent-encoded). Local ones come as ``file:/x``,
    ``file:///x`` or ``/x``; other schemes are Arrow's (hdfs, viewfs, s3, gs,
    abfs)."""
    from pyarrow import fs

    if re.match(r"^(file:)?/", uri):
        return fs.LocalFileSystem(), re.sub(r"^file:/+", "/", uri)
    return fs.FileSystem.from_uri(uri)
