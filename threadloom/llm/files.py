"""Binary files in the shared folder, from inside tasks.

A file is written under a name of its own attempt and then moved to its final
name, so a retried or doubled task leaves one whole file.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

import pyarrow.fs as pafs


def locate(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


@contextmanager
def new_file(uri: str):
    """Stream to ``uri``; the file appears when the block ends without an error."""
    system, path = locate(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    attempt = f"{path}.{uuid.uuid4().hex}"
    with system.open_output_stream(attempt, compression=None) as out:
        yield out
    system.move(attempt, path)


def open_file(uri: str):
    system, path = locate(uri)
    return system.open_input_stream(path, compression=None)
