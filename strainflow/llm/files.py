"""Binary files that tasks write to the shared folder.

A task writes under a name of its attempt and renames when the file is whole, so a lost executor
leaves no half file. Names of files hold the attempt too: a second attempt may cut its rows
otherwise, so readers take only() the files that the finished tasks have named.

Folders are local ones (shared by all machines), or of HDFS, S3, Google or Azure, as pyarrow opens
them; other schemes are refused before any work is done.
"""

from __future__ import annotations

import contextlib
import os
import uuid

from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMES = frozenset({"file", "hdfs", "viewfs", "s3", "gs", "gcs", "abfs", "abfss"})


def check_folder(uri: str) -> None:
    scheme = uri.split(":", 1)[0] if ":" in uri else "file"
    if scheme not in SCHEMES:
        raise ValueError(f"binary files can't be written to {scheme}: folders")


def only(files: DataFrame, named: DataFrame | None, most: int) -> DataFrame:
    """Rows of a binaryFile source whose names are in `named` (column file); broadcast up to `most`."""
    if named is None:
        return files
    names = named.select(F.col("file").alias("_file")).distinct()
    few = names.limit(most + 1).count() <= most
    return files.join(F.broadcast(names) if few else names, F.element_at(F.split("path", "/"), -1) == F.col("_file"), "left_semi")


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)


@contextlib.contextmanager
def whole_file(folder: str, name: str):
    """A stream to folder/name, there only once it is complete."""
    store, path = _open(folder)
    store.create_dir(path, recursive=True)
    draft = f"{path}/.{name}.{os.getpid()}.{uuid.uuid4().hex[:8]}"
    with store.open_output_stream(draft) as stream:
        yield stream
    store.move(draft, f"{path}/{name}")
