"""Files of an own format in the shared folder, written by tasks and read by tasks.

Paths are URIs of any file system that pyarrow opens (file, hdfs, s3, gs, abfs).  A file appears under its name only when
it is whole: it is written under a temporary name and moved, so a task that is run again, or twice, replaces it by the same content.
"""

from __future__ import annotations

import contextlib
import pathlib
import uuid

import pyarrow.fs as pafs


def resolve(uri: str) -> tuple[pafs.FileSystem, str]:
    scheme, found, rest = uri.partition(":")
    if not found or len(scheme) < 2:
        return pafs.LocalFileSystem(), uri
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    return pafs.FileSystem.from_uri(uri)


@contextlib.contextmanager
def whole_file(uri: str):
    """A stream to write to; the file takes its name after the block has ended well."""
    fs, path = resolve(uri)
    fs.create_dir(str(pathlib.PurePosixPath(path).parent), recursive=True)
    part = f"{path}.{uuid.uuid4().hex}.tmp"
    with fs.open_output_stream(part, compression=None) as out:
        yield out
    fs.move(part, path)


def opened(uri: str):
    fs, path = resolve(uri)
    return fs.open_input_stream(path, compression=None, buffer_size=1 << 20)
