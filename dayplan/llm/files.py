"""Binary files in the shared folder, written and read by tasks.

A task writes under a name of its own and reports it in the row it returns; only names in the
stored manifest are ever read, so a lost or repeated task leaves at most an unused file.
"""

from __future__ import annotations

import uuid

from pyarrow import fs


def locate(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def new_file(folder: str, partition: int):
    """(name, open output stream) of a new file of ``folder``."""
    store, path = locate(folder)
    store.create_dir(path, recursive=True)
    name = f"part-{partition:06d}-{uuid.uuid4().hex[:12]}.bin"
    return name, store.open_output_stream(f"{path}/{name}")


def open_file(folder: str, name: str):
    store, path = locate(folder)
    return store.open_input_file(f"{path}/{name}")
