"""Small files that tasks read and write themselves in shared storage.

Paths are URIs or absolute paths of a folder that all executors share;
``pyarrow.fs`` opens them (file, hdfs, s3, ...).
"""

from __future__ import annotations

from pyarrow import fs


def located(uri: str) -> tuple[fs.FileSystem, str]:
    """(file system, path on it); ``file:/x``, as Hadoop writes it, and plain paths are local."""
    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def create(uri: str, data: bytes) -> None:
    """A new file in one go: there whole or not at all once this returns or fails."""
    system, path = located(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(path, compression=None) as out:
        out.write(data)


def names(uri: str) -> list[str]:
    """Names of the files in a folder (none if it isn't there), sorted."""
    system, path = located(uri)
    found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return sorted(f.base_name for f in found if f.type == fs.FileType.File)


def drop_folder(uri: str) -> None:
    system, path = located(uri)
    if system.get_file_info(path).type == fs.FileType.Directory:
        system.delete_dir(path)
