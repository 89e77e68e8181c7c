"""Opening, creating and renaming one file by URI, on whichever machine runs the task."""

from __future__ import annotations

import io
import os
import urllib.request
from typing import BinaryIO

import pyarrow.dataset as pads
import pyarrow.fs as pafs


# Seconds to wait for a size and for a copy over HTTP.
HEAD_TIMEOUT = 20
COPY_TIMEOUT = 300

READ_AHEAD = 8 * 1024 * 1024  # object stores answer few large requests faster than many small ones


def local_path(uri: str) -> str | None:
    """The path when the URI is on the local file system, else None."""
    if uri.startswith("file:"):
        return "/" + uri[len("file:") :].lstrip("/")
    return None if "://" in uri else uri


def _remote(uri: str) -> tuple[pafs.FileSystem, str]:
    scheme, rest = uri.split("://", 1)
    return pafs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{rest}")


def _is_http(uri: str) -> bool:
    return uri.startswith(("http://", "https://"))


def size_text(uri: str) -> str | None:
    """The size a file reports, as text; None when it reports none. Raises when it is not there."""
    if _is_http(uri):
        request = urllib.request.Request(uri, method="HEAD")
        with urllib.request.urlopen(request, timeout=HEAD_TIMEOUT) as answer:
            return answer.headers.get("Content-Length")
    path = local_path(uri)
    if path is not None:
        return str(os.path.getsize(path))
    fs, key = _remote(uri)
    info = fs.get_file_info(key)
    if info.type != pafs.FileType.File:
        raise FileNotFoundError(uri)
    return str(info.size)


def open_input(uri: str) -> BinaryIO:
    """Open for reading; what comes over HTTP can only be read forward."""
    if _is_http(uri):
        return urllib.request.urlopen(uri, timeout=COPY_TIMEOUT)
    path = local_path(uri)
    if path is not None:
        return open(path, "rb", buffering=1024 * 1024)
    fs, key = _remote(uri)
    if fs.get_file_info(key).type == pafs.FileType.NotFound:
        raise FileNotFoundError(uri)
    return io.BufferedReader(fs.open_input_file(key), READ_AHEAD)


def open_output(uri: str) -> BinaryIO:
    path = local_path(uri)
    if path is not None:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        return open(path, "wb")
    fs, key = _remote(uri)
    return fs.open_output_stream(key)


def rename(source: str, target: str) -> None:
    path = local_path(source)
    if path is not None:
        os.replace(path, local_path(target))
    else:
        fs, key = _remote(source)
        fs.move(key, _remote(target)[1])


def discard(uri: str) -> None:
    """Remove a partial file this package wrote; nothing happens when it is not there."""
    path = local_path(uri)
    try:
        if path is not None:
            os.unlink(path)
        else:
            fs, key = _remote(uri)
            fs.delete_file(key)
    except FileNotFoundError:
        pass


def listed_files(table: str) -> list[tuple[str, int]]:
    """(path, bytes) from a Parquet table of these columns, by name."""
    path = local_path(table)
    fs, key = (pafs.LocalFileSystem(), path) if path is not None else _remote(table)
    rows = pads.dataset(key, filesystem=fs, format="parquet").to_table(columns=["path", "length"])
    return sorted(zip(rows["path"].to_pylist(), rows["length"].to_pylist()))


def list_files(uri: str) -> list[tuple[str, int]]:
    """(path, bytes) of a file, or of every file directly in a folder, by name."""
    path = local_path(uri)
    if path is not None:
        fs, key, back = pafs.LocalFileSystem(), path, str
    else:
        fs, key = _remote(uri)
        prefix = uri[: uri.index(key)] if key in uri else uri.split("://", 1)[0] + "://"
        back = prefix.__add__
    info = fs.get_file_info(key)
    if info.type == pafs.FileType.File:
        return [(uri, info.size)]
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(uri)
    found = fs.get_file_info(pafs.FileSelector(key))
    return sorted(
        (back(i.path), i.size)
        for i in found
        if i.type == pafs.FileType.File and not i.base_name.startswith((".", "_"))
    )
