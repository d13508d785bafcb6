"""Whole files by path: of a file system that executors mount, or by URI of any store that Arrow opens (hdfs, s3, gs, file)."""

from __future__ import annotations

import json
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache
from typing import BinaryIO

from pyarrow import fs

LOCAL = fs.LocalFileSystem()
#: Object stores show a file only when it is whole; elsewhere it is written aside and moved.
WHOLE_ON_CLOSE = ("s3", "gcs", "abfs")


@lru_cache(maxsize=64)
def _opened(start: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(start)


def located(path: str | os.PathLike) -> tuple[fs.FileSystem, str]:
    """(file system, path there)."""
    path = os.fspath(path)
    if "://" in path:
        scheme, _, rest = path.partition("://")
        host, slash, inner = rest.partition("/")
        found, root = _opened(f"{scheme}://{host}/")
        return found, f"{root.rstrip('/')}{slash}{inner}"
    return (LOCAL, path[5:]) if path.startswith("file:/") else (LOCAL, path)


def read(path: str | os.PathLike) -> bytes:
    """OSError where there is no such file."""
    found, inner = located(path)
    with found.open_input_stream(inner) as f:
        return f.read()


def opened(path: str | os.PathLike):
    """A file to read and seek in, of which only what is read is fetched."""
    found, inner = located(path)
    return found.open_input_file(inner)


def exists(path: str | os.PathLike) -> bool:
    found, inner = located(path)
    return found.get_file_info(inner).type != fs.FileType.NotFound


@contextmanager
def whole(path: str | os.PathLike) -> Iterator[BinaryIO]:
    """A file to write and seek in that takes its place when the block ends, and leaves nothing when it fails."""
    found, inner = located(path)
    folder = inner.rpartition("/")[0]
    local = isinstance(found, fs.LocalFileSystem)
    if folder and found.type_name not in WHOLE_ON_CLOSE:
        found.create_dir(folder, recursive=True)
    fd, aside = tempfile.mkstemp(dir=(folder or ".") if local else None, suffix=".part")
    try:
        with os.fdopen(fd, "w+b") as out:
            yield out
            if not local:
                out.seek(0)
                _send(found, inner, out)
        if local:
            os.replace(aside, inner)
            aside = None
    finally:
        if aside:
            os.unlink(aside)


def _send(found: fs.FileSystem, inner: str, source: BinaryIO) -> None:
    target = inner if found.type_name in WHOLE_ON_CLOSE else f"{inner}.{uuid.uuid4().hex}.part"
    with found.open_output_stream(target) as out:
        while piece := source.read(1 << 22):
            out.write(piece)
    if target != inner:
        found.move(target, inner)


def write(path: str | os.PathLike, data: bytes) -> None:
    with whole(path) as out:
        out.write(data)


def write_json(path: str | os.PathLike, document: dict) -> None:
    """Whole or not at all."""
    write(path, json.dumps(document, indent=1).encode())


def read_json(path: str | os.PathLike) -> dict:
    return json.loads(read(path))


def names(folder: str | os.PathLike) -> list[str]:
    """What lies in a folder, by name; nothing where there is none."""
    found, inner = located(folder)
    return sorted(f.base_name for f in found.get_file_info(fs.FileSelector(inner, allow_not_found=True)))


def move(source: str, target: str) -> None:
    """A file or folder takes a place that is free."""
    found, inner = located(source)
    found.move(inner, located(target)[1])


def drop(folder: str) -> None:
    """A folder and all in it, if it is there."""
    found, inner = located(folder)
    if found.get_file_info(inner).type != fs.FileType.NotFound:
        found.delete_dir(inner)


def create_new(path: str | os.PathLike, data: bytes) -> bool:
    """Writes a file that isn't there yet, whole; False if it is there. Of several writers one succeeds, on file systems that
    link or that refuse to rename onto a file (local ones, hdfs); object stores that do neither take one writer at a time."""
    found, inner = located(path)
    aside = f"{inner}.{uuid.uuid4().hex}.part"
    if isinstance(found, fs.LocalFileSystem):
        os.makedirs(os.path.dirname(inner) or ".", exist_ok=True)
        with open(aside, "xb") as out:
            out.write(data)
        try:
            os.link(aside, inner)
        except FileExistsError:
            return False
        finally:
            os.unlink(aside)
        return True
    if exists(path):
        return False
    with found.open_output_stream(aside) as out:
        out.write(data)
    try:
        found.move(aside, inner)
    except OSError:
        found.delete_file(aside)
        return False
    return True
