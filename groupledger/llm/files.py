"""Files that tasks write to and read from a folder all executors reach."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyarrow import fs


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if ":/" in path:
        if path.startswith("file:"):
            path = "file://" + path.removeprefix("file:").removeprefix("//")
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


@contextmanager
def published(path: str) -> Iterator:
    """A new file for writing that gets its name when it is whole, so that a task that is
    run again, or twice at once, leaves one whole file."""
    system, name = located(path)
    system.create_dir(name.rsplit("/", 1)[0], recursive=True)
    hidden = f"{name}.{uuid.uuid4().hex}.tmp"
    with system.open_output_stream(hidden) as out:
        yield out
    system.move(hidden, name)


def mapped(path: str, kind: str) -> np.ndarray:
    """The numbers in a file: memory-mapped on a mounted folder, read elsewhere."""
    system, name = located(path)
    if system.get_file_info(name).size == 0:
        return np.empty(0, kind)
    if isinstance(system, fs.LocalFileSystem):
        return np.memmap(name, kind, "r")
    with system.open_input_file(name) as file:
        return np.frombuffer(file.read(), kind)
