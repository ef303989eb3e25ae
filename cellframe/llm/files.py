"""Files that tasks write to and read from the shared folder, through its own file system.

Every attempt of a task writes names of its own and reports them in the rows it returns.
Spark keeps the rows of one successful attempt only, so files of lost attempts are never
read.
"""

from __future__ import annotations

import re
import uuid

from pyarrow import fs


def _resolved(uri: str) -> tuple[fs.FileSystem, str]:
    if re.match(r"file:/|/", uri):
        return fs.LocalFileSystem(), "/" + re.sub(r"^(file:)?/+", "", uri)
    return fs.FileSystem.from_uri(uri)


def fresh_file(folder: str, suffix: str) -> tuple[str, object]:
    """The path of a new file in a shared folder, and a stream that writes it."""
    path = f"{folder.rstrip('/')}/{uuid.uuid4().hex}.{suffix}"
    system, place = _resolved(path)
    system.create_dir(place.rpartition("/")[0], recursive=True)
    return path, system.open_output_stream(place, compression=None)


def open_file(path: str):
    """A seekable stream that reads a file."""
    system, place = _resolved(path)
    return system.open_input_file(place)
