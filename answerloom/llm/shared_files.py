"""Files that tasks write to and read from the shared folder, on any file system that pyarrow.fs knows."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext


def locate(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path in it; a path without a scheme is a local one."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


@contextmanager
def created(path: str) -> Iterator[pa.NativeFile]:
    """A new file that appears under its name once it is whole.

    A task that is tried again, or runs twice at a time, writes under another name first and then puts the same
    bytes in the same place.
    """
    system, place = locate(path)
    context = TaskContext.get()
    draft = f"{place}.draft-{context.taskAttemptId() if context else 0}"
    with system.open_output_stream(draft, compression=None) as out:
        yield out
    system.move(draft, place)


def make_folder(path: str) -> None:
    system, place = locate(path)
    system.create_dir(place, recursive=True)


def opened(path: str) -> pa.NativeFile:
    """Random access to a file; a local one is mapped, so reads from it copy nothing."""
    system, place = locate(path)
    if isinstance(system, fs.LocalFileSystem):
        return pa.memory_map(place)
    return system.open_input_file(place)


def streamed(path: str) -> pa.NativeFile:
    system, place = locate(path)
    return system.open_input_stream(place, compression=None)
