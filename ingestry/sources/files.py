"""File access of the tasks: listing, versions and moves through pyarrow's file systems.

Tasks do what a driver would have to do file by file: each lists the prefixes or moves the
files that it was dealt. The functions travel to the workers by value."""

from __future__ import annotations

import posixpath
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LISTED = "path string, length long, modified long"
MOVED = "name string, moved boolean, reason string"
_MOVED_KINDS = (pa.string(), pa.bool_(), pa.string())
CHANGED = "changed since it was listed"


def filesystem(path: str):
    """(file system, path within it) of a URI or an absolute local path."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(path)


def version(files, inner: str) -> str:
    """Size and time of change, to the millisecond: what a listing tells of an object's version."""
    info = files.get_file_info(inner)
    return f"{info.size}-{info.mtime_ns // 1_000_000 * 1000}"


def _hidden(name: str) -> bool:
    return name.startswith(("_", "."))


def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches (prefix, deep) to the files there, empty ones included; hidden ones (of Spark's
    rule) and what lies below hidden folders are left out."""
    from pyarrow import fs

    names, kinds = ("path", "length", "modified"), (pa.string(), pa.int64(), pa.int64())
    for batch in batches:
        for prefix, deep in zip(*(c.to_pylist() for c in batch.columns)):
            files, inner = filesystem(prefix)
            scheme = prefix[: len(prefix) - len(inner)] if prefix.endswith(inner) else "file:"
            rows = []
            for info in files.get_file_info(fs.FileSelector(inner, allow_not_found=True, recursive=deep)):
                below = posixpath.relpath(info.path, inner)
                if info.type == fs.FileType.File and not any(map(_hidden, below.split("/"))):
                    rows.append((scheme + info.path, info.size, info.mtime_ns // 1000))
            for k in range(0, len(rows), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[k : k + 10_000]), kinds)], names=names)


def mover(processed_root: str):
    """Batches (path, name, version) to whether each file was moved. A file that is no longer
    there, but in its new place with the same size, was moved by an attempt before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            rows = []
            for path, name, wanted in zip(*(c.to_pylist() for c in batch.columns)):
                reason = None
                try:
                    files, source = filesystem(path)
                    _, target = filesystem(f"{processed_root.rstrip('/')}/{name}")
                    if files.get_file_info(source).type == fs.FileType.NotFound:
                        there = files.get_file_info(target)
                        if there.type != fs.FileType.File or str(there.size) != wanted.split("-")[0]:
                            reason = "not found"
                    elif version(files, source) != wanted:
                        reason = CHANGED
                    else:
                        files.create_dir(posixpath.dirname(target), recursive=True)
                        files.move(source, target)
                except Exception as failure:  # noqa: BLE001 - reported; the ledger decides what is read again
                    reason = f"{type(failure).__name__}: {failure}"
                rows.append((name, reason is None, reason))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), _MOVED_KINDS)], names=["name", "moved", "reason"]
                )

    return run
