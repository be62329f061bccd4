"""Files that tasks write and read themselves, in the folder all executors share.

Paths are URIs below ``spark.checkpoint.dir``; ``pyarrow.fs`` opens them
(file, hdfs, s3, ...).  A task writes to a name of its own and reports it with
its result rows, so a retried or speculative task never clashes with another
and only files named by a finished task are ever read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from ..session import ensure_checkpoint_dir


def new_folder(spark: SparkSession, name: str) -> str:
    """URI of a new folder below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base if ':/' in base else 'file://' + base}/{name}-{uuid.uuid4().hex}"


def open_out(folder: str, name: str):
    """(URI, binary output stream) of a new file; ``name`` is made unique."""
    from pyarrow import fs

    stem, dot, ending = name.partition(".")
    uri = f"{folder}/{stem}-{uuid.uuid4().hex[:12]}{dot}{ending}"
    system, path = fs.FileSystem.from_uri(_plain(uri))
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return uri, system.open_output_stream(path, compression=None)


def open_in(uri: str):
    """A random-access binary file (``read_at(nbytes, offset)``)."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(_plain(uri))
    return system.open_input_file(path)


def _plain(uri: str) -> str:
    """``file:/x`` (as Hadoop writes it) as ``file:///x``."""
    return "file:///" + uri[6:].lstrip("/") if uri.startswith("file:/") else uri
