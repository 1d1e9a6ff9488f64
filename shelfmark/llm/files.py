"""Flat binary files in the shared folder, written and mapped by tasks."""

from __future__ import annotations

import os
import uuid
from urllib.parse import unquote, urlparse

import numpy as np


def local_path(uri: str) -> str | None:
    """The path of a folder that is mounted on all machines; None for a store without a mount."""
    parts = urlparse(uri)
    return unquote(parts.path) if parts.scheme in ("", "file") else None


def write_file(folder: str, name: str, parts: list[bytes]) -> None:
    """Write a file whole or not at all: a task that runs twice leaves one file of the same content."""
    path = local_path(folder)
    if path is None:
        from pyarrow import fs

        store, top = fs.FileSystem.from_uri(folder)
        store.create_dir(top, recursive=True)
        with store.open_output_stream(f"{top}/{name}") as out:  # stores show a file when it is complete
            for part in parts:
                out.write(part)
        return
    os.makedirs(path, exist_ok=True)
    draft = f"{path}/.{name}-{uuid.uuid4().hex}"
    with open(draft, "wb") as out:
        for part in parts:
            out.write(part)
    os.replace(draft, f"{path}/{name}")


def map_file(folder: str, name: str, kind: str, offset: int = 0, count: int | None = None) -> np.ndarray:
    """``count`` numbers of a file from byte ``offset`` on: memory-mapped, or read where there is no mount."""
    path = local_path(folder)
    size = np.dtype(kind).itemsize
    if path is not None:
        full = f"{path}/{name}"
        count = (os.path.getsize(full) - offset) // size if count is None else count
        return np.memmap(full, kind, "r", offset, (count,)) if count else np.empty(0, kind)
    from pyarrow import fs

    store, top = fs.FileSystem.from_uri(folder)
    with store.open_input_file(f"{top}/{name}") as source:
        count = (source.size() - offset) // size if count is None else count
        return np.frombuffer(source.read_at(count * size, offset), kind)
