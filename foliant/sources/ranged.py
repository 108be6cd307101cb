"""Files of a shared file system opened inside tasks, to read ranges of them and to write them."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import BinaryIO

import pyarrow.fs
from pyarrow.fs import FileSelector, FileType

_URI = re.compile(r"(?P<scheme>[A-Za-z][A-Za-z0-9+.-]*):(?://(?P<authority>[^/]*))?(?P<path>/.*)", re.DOTALL)
#: Names that Spark's connectors use for file systems that are known here by another.
ALIASES = {"s3a": "s3", "s3n": "s3"}


@lru_cache(maxsize=64)
def _file_system(scheme: str, authority: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(f"{ALIASES.get(scheme, scheme)}://{authority}/")


def _located(path: str) -> tuple[pyarrow.fs.FileSystem | None, str]:
    """The file system of a path as Spark writes it (nothing in it is escaped), and the path there; none: a mounted one."""
    found = _URI.fullmatch(path)
    if found is None:
        return None, path
    if found["scheme"] == "file":
        return None, found["path"]
    system, root = _file_system(found["scheme"], found["authority"] or "")
    return system, root.rstrip("/") + found["path"]


def opened(path: str) -> BinaryIO:
    """A file to read from any place. What is read, and a small buffer, is all that is held."""
    system, place = _located(path)
    return open(place, "rb") if system is None else system.open_input_file(place)


def created(path: str) -> BinaryIO:
    """A new file, or a new content of it: a task that runs again writes the same."""
    system, place = _located(path)
    if system is None:
        os.makedirs(os.path.dirname(place), exist_ok=True)
        return open(place, "wb")
    return system.open_output_stream(place)


def is_folder(path: str) -> bool:
    """Whether a path is a folder that can be listed here; one that only Spark's connectors reach is none."""
    try:
        system, place = _located(path)
        return os.path.isdir(place) if system is None else system.get_file_info(place).type == FileType.Directory
    except (OSError, ValueError, NotImplementedError):
        return False


def listed(path: str) -> Iterator[tuple[str, int | None]]:
    """The names in a folder, with the length of a file and none for a folder."""
    system, place = _located(path)
    if system is not None:
        for found in system.get_file_info(FileSelector(place)):
            yield found.base_name, None if found.type == FileType.Directory else found.size
        return
    with os.scandir(place) as entries:
        for entry in entries:
            try:
                yield entry.name, None if entry.is_dir() else entry.stat().st_size
            except FileNotFoundError:  # gone meanwhile, or a link to nothing
                continue
