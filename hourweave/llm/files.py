"""Files in the shared folder, written and read by tasks: local paths directly, other stores through their driver."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyarrow import fs


def _split(uri: str) -> tuple[fs.FileSystem, str]:
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(uri)


@contextmanager
def publish(uri: str) -> Iterator:
    """A binary stream whose content appears under `uri` at once when the block ends without an error.

    Every attempt of a task writes a file of its own and renames it, so a repeated or speculative task replaces
    the file by an equal one and readers never see half of it.
    """
    store, path = _split(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    own = f"{path}.{uuid.uuid4().hex}.tmp"
    try:
        with store.open_output_stream(own) as out:
            yield out
        if isinstance(store, fs.LocalFileSystem):
            os.replace(own, path)
        else:
            if store.get_file_info(path).type != fs.FileType.NotFound:
                store.delete_file(path)
            store.move(own, path)
    except BaseException:
        if store.get_file_info(own).type != fs.FileType.NotFound:
            store.delete_file(own)
        raise


def open_array(uri: str, dtype: str) -> np.ndarray:
    """The file as a flat array: memory-mapped where the store is a mounted file system, else read."""
    store, path = _split(uri)
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, dtype=dtype, mode="r") if os.path.getsize(path) else np.empty(0, dtype)
    with store.open_input_file(uri if "://" not in uri else path) as f:
        return np.frombuffer(f.read(), dtype=dtype)



@contextmanager
def open_ranges(uri: str) -> Iterator:
    """A handle for `read_range`."""
    store, path = _split(uri)
    with store.open_input_file(path) as f:
        yield f
