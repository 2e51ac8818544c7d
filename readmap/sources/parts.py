"""Files of a data source writer, published together.

The tasks of a job write into one staging folder, hidden and beside the output. On commit, what belongs to no committed
attempt is deleted, and the folder gets its name in one step: a new output appears whole, and files that are appended to an
output appear whole in a folder of their own inside. An aborted job deletes its staging folder. Where a file system cannot
rename folders (object stores), files are moved one by one.
"""

import uuid
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql.datasource import DataSourceArrowWriter, WriterCommitMessage

from readmap.sources import files


@dataclass
class WrittenPart(WriterCommitMessage):
    names: list[str]


class Staging:
    """The folder that a job's files wait in; made by whoever writes the first file."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")
        parent, _, name = self.path.rpartition("/")
        self.folder = f"{parent}{'/' if parent or self.path.startswith('/') else ''}.{name}-{uuid.uuid4().hex}"

    def create(self, name: str) -> pa.NativeFile:
        filesystem, folder = files.open_path(self.folder)
        inner = f"{folder}/{name}"
        filesystem.create_dir(inner.rpartition("/")[0], recursive=True)
        return filesystem.open_output_stream(inner, compression=None)

    def publish(self, names: list[str]) -> None:
        """Delete what is not among the names, and give the folder its place; no name at all is an empty folder."""
        filesystem, folder = files.open_path(self.folder)
        _, target = files.open_path(self.path)
        filesystem.create_dir(folder, recursive=True)
        wanted = set(names)
        for info in filesystem.get_file_info(pafs.FileSelector(folder, recursive=True)):
            if info.type == pafs.FileType.File and info.path.removeprefix(folder).lstrip("/") not in wanted:
                filesystem.delete_file(info.path)
        if filesystem.get_file_info(target).type != pafs.FileType.NotFound:
            if not wanted:
                filesystem.delete_dir(folder)
                return
            target = f"{target}/job-{uuid.uuid4().hex}"
        else:
            filesystem.create_dir(target.rpartition("/")[0] or "/", recursive=True)
        try:
            filesystem.move(folder, target)
        except (OSError, pa.ArrowNotImplementedError):
            if filesystem.type_name in ("local", "hdfs"):
                raise
            for name in sorted(wanted):  # an index before the file that it lists
                filesystem.create_dir(f"{target}/{name}".rpartition("/")[0], recursive=True)
                filesystem.move(f"{folder}/{name}", f"{target}/{name}")

    def discard(self) -> None:
        filesystem, folder = files.open_path(self.folder)
        if filesystem.get_file_info(folder).type != pafs.FileType.NotFound:
            filesystem.delete_dir(folder)


class PartWriter(DataSourceArrowWriter):
    """Each task attempt writes uniquely named files; only those of committed attempts are ever seen."""

    def __init__(self, path: str):
        self.path = path
        self.staging = Staging(path)

    def _create(self, suffix: str):
        name = f"part-{uuid.uuid4().hex}{suffix}"
        return name, self.staging.create(name)

    def commit(self, messages):
        self.staging.publish([name for message in messages if message for name in message.names])

    def abort(self, messages):
        self.staging.discard()
