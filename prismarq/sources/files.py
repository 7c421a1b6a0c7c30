"""Files read and written by tasks, on whatever file system their path names."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame


def locate(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path on it; ``file:`` and plain paths are local, ``s3a:`` is Hadoop's name for ``s3:``."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    path = path.replace("s3a://", "s3://", 1) if path.startswith("s3a://") else path
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def read_bytes(path: str, most: int | None = None, begin: int = 0) -> bytes:
    """A file's bytes from ``begin`` on, at most ``most`` of them; no more is fetched."""
    system, bare = locate(path)
    with system.open_input_file(bare) as f:
        f.seek(begin)
        return f.read(most) if most is not None else f.read()


def exists(path: str) -> bool:
    system, bare = locate(path)
    return system.get_file_info(bare).type != fs.FileType.NotFound


def write_bytes(path: str, data: bytes) -> None:
    """A whole file, by way of a temporary name beside it."""
    system, bare = locate(path)
    system.create_dir(bare.rpartition("/")[0], recursive=True)
    part = f"{bare}.{uuid.uuid4().hex}.part"
    with system.open_output_stream(part) as f:
        f.write(data)
    system.move(part, bare)


def delete(path: str) -> None:
    """Delete a file if it is there."""
    system, bare = locate(path)
    if system.get_file_info(bare).type != fs.FileType.NotFound:
        system.delete_file(bare)


def list_files(folder: str) -> dict[str, int]:
    """Bytes of every file below ``folder`` by its path from there; nothing if there is no folder."""
    system, bare = locate(folder)
    found = system.get_file_info(fs.FileSelector(bare, recursive=True, allow_not_found=True))
    return {i.path[len(bare.rstrip("/")) + 1 :]: i.size for i in sorted(found, key=lambda i: i.path) if i.type == fs.FileType.File}


def files_in(folder: str) -> dict[str, int]:
    """Bytes of the files that lie in ``folder`` itself, by name; nothing if there is no folder."""
    system, bare = locate(folder)
    return {i.base_name: i.size for i in system.get_file_info(fs.FileSelector(bare, allow_not_found=True)) if i.type == fs.FileType.File}


def delete_folder(folder: str) -> None:
    """Delete a folder and what it holds, if it is there."""
    system, bare = locate(folder)
    if system.get_file_info(bare).type != fs.FileType.NotFound:
        system.delete_dir(bare)


def copy(source: str, target: str, piece: int = 8 << 20) -> int:
    """Copy a file piece by piece, from one file system to another if need be, by way of a temporary name; its bytes."""
    system, bare = locate(target)
    system.create_dir(bare.rpartition("/")[0], recursive=True)
    part, total = f"{bare}.{uuid.uuid4().hex}.part", 0
    origin, path = locate(source)
    with origin.open_input_file(path) as f, system.open_output_stream(part, compression=None) as out:
        while data := f.read(piece):
            total += out.write(data)
    system.move(part, bare)
    return total


def link_or_copy(source: str, target: str) -> None:
    """``target`` as another name of a file, where both lie on one disk, else as a copy; one that is there stays."""
    if exists(target):
        return
    (origin, path), (system, bare) = locate(source), locate(target)
    if isinstance(origin, fs.LocalFileSystem) and isinstance(system, fs.LocalFileSystem):
        system.create_dir(bare.rpartition("/")[0], recursive=True)
        try:
            os.link(path, bare)
            return
        except FileExistsError:
            return
        except OSError:
            pass
    copy(source, target)


def with_heads(files: DataFrame, most: int, out: str = "head", path: str = "path") -> DataFrame:
    """``files`` with the first ``most`` bytes of each file as ``out``; null where it cannot be read.

    The tasks open the files, so a scan of headers fetches headers, not files.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads = []
            for p in batch.column(path).to_pylist():
                try:
                    heads.append(read_bytes(p, most))
                except OSError:
                    heads.append(None)
            yield batch.append_column(out, pa.array(heads, pa.binary()))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema.fields)
    return files.mapInArrow(read, f"{kinds}, `{out}` binary")
