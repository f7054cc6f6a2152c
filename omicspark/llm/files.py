"""Token files in the shared folder, written and read inside tasks."""

from __future__ import annotations

import uuid

from pyarrow import fs as pafs


def open_output(uri: str):
    """A stream to a new file of any store that Arrow knows; folders are made."""
    store, path = pafs.FileSystem.from_uri(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    return store.open_output_stream(path)


def open_input(uri: str):
    store, path = pafs.FileSystem.from_uri(uri)
    return store.open_input_file(path)


def attempt_name(folder: str, part: int) -> str:
    """A name that no other attempt of the task takes: only names that a successful attempt returned count."""
    return f"{folder}/tokens-{part:06d}-{uuid.uuid4().hex}"


def publish(data: bytes, uri: str) -> None:
    """A small file that any attempt of a task may write, always the same bytes: it appears whole or not at all."""
    store, path = pafs.FileSystem.from_uri(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    if store.get_file_info(path).type == pafs.FileType.File:
        return
    own = f"{path}.{uuid.uuid4().hex}"
    with store.open_output_stream(own) as f:
        f.write(data)
    store.move(own, path)
