"""Files in a shared folder, opened by URI from tasks (any store that pyarrow.fs knows)."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyarrow import fs


def _where(uri: str) -> tuple[fs.FileSystem, str]:
    if "://" not in uri and uri.startswith("file:"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)


@contextmanager
def create(folder: str, stem: str, suffix: str):
    """Open a new file under a name that no other task attempt uses; yields (uri, stream).

    Only names returned by tasks that committed are read later, so files of
    failed or repeated attempts are never seen.
    """
    uri = f"{folder}/{stem}-{uuid.uuid4().hex}{suffix}"
    store, path = _where(uri)
    store.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with store.open_output_stream(path, compression=None) as out:
        yield uri, out


@contextmanager
def reading(uri: str):
    store, path = _where(uri)
    with store.open_input_file(path) as file:
        yield file
