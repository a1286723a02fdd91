"""Files that tasks write and read themselves, in the shared folder.

``pyarrow.fs`` opens the store that the URI names (file, hdfs, s3, gs). A file
is written under a temporary name of its attempt and then renamed, so a lost or
repeated task leaves either the whole file under its final name or none.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyarrow import fs


def _at(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


@contextmanager
def committed(uri: str):
    """A stream whose content gets the final name when the block ends well."""
    store, path = _at(uri)
    folder, _, name = path.rpartition("/")
    store.create_dir(folder, recursive=True)
    temporary = f"{folder}/_tmp-{uuid.uuid4().hex}-{name}"
    stream = store.open_output_stream(temporary, compression=None)
    try:
        yield stream
    except BaseException:
        stream.close()
        store.delete_file(temporary)
        raise
    stream.close()
    store.move(temporary, path)


def read_bytes(uri: str) -> bytes:
    store, path = _at(uri)
    with store.open_input_stream(path, compression=None) as f:
        return f.read()


def open_stream(uri: str):
    store, path = _at(uri)
    return store.open_input_stream(path, compression=None)
