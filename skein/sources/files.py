"""Files that tasks read and write themselves."""

from __future__ import annotations


def file_system(uri: str):
    """Arrow file system and path of a folder URI."""
    from pyarrow import fs
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)
