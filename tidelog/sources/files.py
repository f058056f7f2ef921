"""Folders and files on whatever file system a path names: local paths and file:, hdfs:, s3: addresses alike."""

from __future__ import annotations

import re
from typing import Any


def place(path: str) -> tuple[Any, str]:
    """(file system, path on it). A path without a scheme is local."""
    from pyarrow import fs

    if re.match(r"[a-zA-Z][a-zA-Z0-9+.-]+:", path):
        return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return fs.LocalFileSystem(), path


def joined(path: str, *names: str) -> str:
    return "/".join([path.rstrip("/"), *names])


def _entries(path: str) -> list[Any]:
    from pyarrow import fs

    system, at = place(path)
    return system.get_file_info(fs.FileSelector(at, allow_not_found=True))


def file_names(path: str) -> list[str]:
    """Names of the files in a folder; none where there is no folder."""
    return [e.base_name for e in _entries(path) if e.is_file]


def folder_names(path: str) -> list[str]:
    return sorted(e.base_name for e in _entries(path) if not e.is_file)


def is_file(path: str) -> bool:
    system, at = place(path)
    return system.get_file_info(at).is_file


def size(path: str) -> int:
    system, at = place(path)
    return system.get_file_info(at).size


def modified(path: str) -> float:
    """Seconds since 1970."""
    system, at = place(path)
    return system.get_file_info(at).mtime_ns / 1e9


def reading(path: str) -> Any:
    """A file opened for reading from any place of it."""
    system, at = place(path)
    return system.open_input_file(at)


def writing(path: str) -> Any:
    """A new file; folders on the way to it are made."""
    system, at = place(path)
    system.create_dir(at.rsplit("/", 1)[0], recursive=True)
    return system.open_output_stream(at)


def moved(path: str, to: str) -> None:
    system, at = place(path)
    system.move(at, place(to)[1])


def removed(path: str) -> None:
    system, at = place(path)
    system.delete_file(at)


def planned(checkpoint: str, source: int = 0) -> dict[str, Any] | None:
    """The offset that a query with this checkpoint folder planned last for its n-th source; None before its first batch.

    A Python source is told by Spark only what to read, not where a query stands when it starts again; its log tells.
    """
    import json

    folder = joined(checkpoint, "offsets")
    batches = [int(n) for n in file_names(folder) if n.isdigit()]
    if not batches:
        return None
    with reading(joined(folder, str(max(batches)))) as f:
        lines = f.read().decode().splitlines()
    offset = lines[2 + source] if len(lines) > 2 + source else "-"
    return None if offset == "-" else json.loads(offset)
