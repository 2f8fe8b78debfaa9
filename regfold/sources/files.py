"""File-system access for executor-side Python (archives, package shipping)."""

from __future__ import annotations

import os


def filesystem_for(path: str):
    """(pyarrow file system, path) for a local path or a Hadoop-style URI.

    Spark reports local files as ``file:/x``; ``s3a://`` is the Hadoop name of ``s3://``.
    """
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), os.path.abspath(path)
    if path.startswith("s3a://"):
        path = "s3://" + path[len("s3a://"):]
    return fs.FileSystem.from_uri(path)


def folder_exists(path: str) -> bool:
    import pyarrow.fs as pafs

    filesystem, p = filesystem_for(path)
    return filesystem.get_file_info(p).type == pafs.FileType.Directory


def delete_folder(path: str) -> None:
    """Remove a folder with all it holds, if it is there."""
    if folder_exists(path):
        filesystem, p = filesystem_for(path)
        filesystem.delete_dir(p)


def delete_file(path: str) -> None:
    """Remove a file; one that is gone already (a retried task) is fine."""
    filesystem, p = filesystem_for(path)
    try:
        filesystem.delete_file(p)
    except FileNotFoundError:
        pass


def copy_file(source: str, target: str) -> None:
    """Stream a file to ``target`` in chunks. It is written under a hidden name of its own and moved at the end."""
    import uuid

    source_fs, src = filesystem_for(source)
    target_fs, dst = filesystem_for(target)
    folder, name = dst.rsplit("/", 1)
    target_fs.create_dir(folder, recursive=True)
    part = f"{folder}/.{name}.{uuid.uuid4().hex[:8]}"
    with source_fs.open_input_stream(src) as data, target_fs.open_output_stream(part) as out:
        while chunk := data.read(4 << 20):
            out.write(chunk)
    target_fs.move(part, dst)
