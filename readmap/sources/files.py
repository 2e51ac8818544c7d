"""Files of a path, and byte ranges of files, on any file system Arrow can open."""

import fnmatch
import os
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyarrow import fs as pafs

MEBIBYTE = 1 << 20


@dataclass(frozen=True)
class SourceFile:
    uri: str
    size: int


def open_path(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path inside it for a Hadoop-style path."""
    if "://" not in uri:
        return pafs.LocalFileSystem(), os.path.abspath(uri.removeprefix("file:"))
    scheme, rest = uri.split("://", 1)
    scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    return pafs.FileSystem.from_uri(f"{scheme}://{rest}")


def qualified(spark, path: str) -> str:
    """Path, or list of paths, with the scheme of the session's default file system where it has none."""
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    if str(configuration.get("fs.defaultFS", "file:///")).startswith("file:"):
        return path
    make = spark._jvm.org.apache.hadoop.fs.Path

    def one(item: str) -> str:
        if "://" in item or item.startswith("file:"):
            return item
        place = make(item)
        return place.getFileSystem(configuration).makeQualified(place).toString()

    return ",".join(one(item) for item in filter(None, (part.strip() for part in path.split(","))))


def is_there(spark, path: str) -> bool:
    """Whether a path exists, on the file system that Spark would write it to."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def open_file(uri: str):
    filesystem, path = open_path(uri)
    return filesystem.open_input_file(path)


def list_files(path: str, skip: tuple[str, ...] = ()) -> list[SourceFile]:
    """Files of a path: one file, a directory, a glob in the last step, or a comma-separated list.

    Names starting with ``_`` or ``.`` are hidden, as elsewhere in Spark.
    """
    found: list[SourceFile] = []
    for item in filter(None, (part.strip() for part in path.split(","))):
        found.extend(_list_one(item, skip))
    return found


def _list_one(item: str, skip: tuple[str, ...]) -> list[SourceFile]:
    """Folders are read with all folders inside, as partitioned output has them."""
    filesystem, path = open_path(item)
    item = item.rstrip("/") or item
    path = path.rstrip("/") or path
    prefix = item.removesuffix(path) if item.endswith(path) else ""
    directory, _, pattern = path.rpartition("/")
    if any(c in pattern for c in "*?["):
        infos = filesystem.get_file_info(pafs.FileSelector(directory, recursive=False))
        infos = [i for i in infos if fnmatch.fnmatchcase(i.base_name, pattern) and not i.base_name.startswith(("_", "."))]
    else:
        infos = [filesystem.get_file_info(path)]
        if infos[0].type == pafs.FileType.File:
            return [SourceFile(prefix + infos[0].path, infos[0].size)]
    found = [i for i in infos if i.type == pafs.FileType.File]
    for folder in (i for i in infos if i.type == pafs.FileType.Directory):
        inside = filesystem.get_file_info(pafs.FileSelector(folder.path, recursive=True))
        found += [i for i in inside if i.type == pafs.FileType.File and not _hidden(i.path.removeprefix(folder.path))]
    wanted = [SourceFile(prefix + i.path, i.size) for i in found if not i.base_name.endswith(skip or ("\0",))]
    if not wanted:
        raise FileNotFoundError(f"no file at {item}")
    return sorted(wanted, key=lambda f: f.uri)


def _hidden(path: str) -> bool:
    """Partition folders, ``_name=value``, are not hidden."""
    return any(part.startswith(".") or part.startswith("_") and "=" not in part for part in path.split("/") if part)


def exists(uri: str) -> bool:
    filesystem, path = open_path(uri)
    return filesystem.get_file_info(path).type == pafs.FileType.File


def read_small(uri: str) -> bytes:
    with open_file(uri) as handle:
        return handle.read()


def on_each(files, function) -> list:
    """Small reads on many files at once; for planning on the driver."""
    files = list(files)
    if not files:
        return []
    with ThreadPoolExecutor(min(32, len(files))) as pool:
        return list(pool.map(function, files))


def byte_ranges(size: int, step: int) -> list[tuple[int, int]]:
    return [(start, min(start + step, size)) for start in range(0, size, step)]
