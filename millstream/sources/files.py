"""File access for the Python data sources, on any file system pyarrow knows."""

from __future__ import annotations

import fnmatch
import posixpath
import re
import uuid
from dataclasses import dataclass

from pyarrow import fs as pafs
from pyspark.sql.datasource import WriterCommitMessage


def open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    if re.match(r"^[a-z][a-z0-9+.-]*:", path):
        if path.startswith("file:"):
            return pafs.LocalFileSystem(), re.sub(r"^file:/*", "/", path)
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def list_files(path: str, validate: bool = True) -> list[tuple[str, int]]:
    """``(path, size)`` of the data files of a file, a folder or a glob."""
    fs, place = open_fs(path)
    place = place.rstrip("/")
    if any(ch in place for ch in "*?["):
        base = posixpath.dirname(re.split(r"[*?\[]", place, maxsplit=1)[0] + "x")
        depth_pattern = re.compile(fnmatch.translate(place))
        infos = [
            f for f in fs.get_file_info(
                pafs.FileSelector(base, recursive=True, allow_not_found=True))
            if depth_pattern.match(f.path) and f.path.count("/") == place.count("/")
        ]
    else:
        infos = [fs.get_file_info(place)]
    files: list[tuple[str, int]] = []
    for info in infos:
        if info.type == pafs.FileType.Directory:
            inside = fs.get_file_info(pafs.FileSelector(info.path))
            files += [(f.path, f.size) for f in inside if _is_data(f)]
        elif _is_data(info):
            files.append((info.path, info.size))
    if validate and not files:
        raise FileNotFoundError(f"no files at {path}")
    return sorted(files)


def _is_data(info: pafs.FileInfo) -> bool:
    return info.type == pafs.FileType.File and info.base_name[0] not in "_."


def with_scheme(path: str, place: str) -> str:
    """``place`` on the file system that ``path`` names."""
    match = re.match(r"^([a-z][a-z0-9+.-]*)://([^/]*)", path)
    if not match or match.group(1) == "file":
        return place
    scheme, authority = match.groups()
    inside = place.startswith(f"{authority}/")
    return f"{scheme}://{place}" if inside else f"{scheme}://{authority}{place}"


@dataclass
class WrittenFile(WriterCommitMessage):
    staged: str | None
    final: str | None


def new_part(path: str, suffix: str) -> WrittenFile:
    """Names for one task's file: hidden while it is written, then renamed."""
    name = f"part-{uuid.uuid4().hex}{suffix}"
    return WrittenFile(f"{path}/_staged/{name}", f"{path}/{name}")


def open_output(path: str):
    fs, place = open_fs(path)
    fs.create_dir(posixpath.dirname(place), recursive=True)
    return fs.open_output_stream(place, compression=None)


def publish_parts(path: str, messages: list, overwrite: bool) -> None:
    """Make the files of the finished tasks visible; a lost attempt stays hidden. Old files
    go only when all new ones are in place, so a failure in between loses no row; until
    the mark of success is back, there may be rows of both."""
    fs, place = open_fs(path)
    fs.create_dir(place, recursive=True)
    old = [f for f, _ in list_files(path, validate=False)] if overwrite else []
    if old and fs.get_file_info(f"{place}/_SUCCESS").type == pafs.FileType.File:
        fs.delete_file(f"{place}/_SUCCESS")
    for message in messages:
        if message is not None and message.staged:
            fs.move(open_fs(message.staged)[1], open_fs(message.final)[1])
    for f in old:
        fs.delete_file(f)
    with fs.open_output_stream(f"{place}/_SUCCESS", compression=None):
        pass
