"""Table of the blocks of indexed block gzip files, and a writer of such files."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from readmap import schemas
from readmap.sources import files
from readmap.sources.block_gzip import group_blocks, load_index, pack_member
from readmap.sources.parts import PartWriter, WrittenPart


class GzipBlocksDataSource(DataSource):
    """``format('gzip_blocks')``.

    Read options: ``blocksPerRow`` (10), ``payload`` (true: raw compressed bytes; false: the index
    only, one row per block), ``maxSplitBytes`` of payload per task. Writing takes one string column
    of text lines; option ``blockBytes`` is the uncompressed size at which a block is closed.
    """

    @classmethod
    def name(cls) -> str:
        return "gzip_blocks"

    def schema(self):
        return schemas.BLOCK_GROUP if self._payload() else schemas.BLOCK

    def _payload(self) -> bool:
        return self.options.get("payload", "true").lower() == "true"

    def reader(self, schema):
        if not self._payload():
            return BlockIndexReader(self.options["path"])
        return BlockGroupReader(
            self.options["path"],
            int(self.options.get("blocksPerRow", 10)),
            int(self.options.get("maxSplitBytes", 128 * files.MEBIBYTE)),
        )

    def writer(self, schema, overwrite):
        if len(schema.fields) != 1:
            raise ValueError("gzip_blocks writes one string column")
        if overwrite:
            raise ValueError("gzip_blocks appends; write to a new path")
        return BlockWriter(self.options["path"], int(self.options.get("blockBytes", 1 << 18)))


def _indexed_files(path: str) -> list[files.SourceFile]:
    found = [f for f in files.list_files(path, skip=(".idx",)) if f.size]
    indexed = files.on_each(found, lambda f: files.exists(f.uri + ".idx"))
    for file, has_index in zip(found, indexed):
        if not has_index:
            raise FileNotFoundError(f"no index {file.uri}.idx")
    return found


class BlockIndexReader(DataSourceReader):
    """Index rows alone; one task per index file."""

    def __init__(self, path: str):
        self.path = path

    def partitions(self):
        return [InputPartition((f.uri, f.size)) for f in _indexed_files(self.path)]

    def read(self, partition):
        if partition is None:
            return
        uri, size = partition.value
        index = load_index(uri, size)
        yield pa.RecordBatch.from_arrays(
            [
                pa.repeat(pa.scalar(uri), len(index)),
                pa.array(range(len(index)), pa.int32()),
                pa.array(index[:, 0], pa.int64()),
                pa.array(index[:, 1], pa.int64()),
            ],
            names=schemas.BLOCK.names,
        )


class BlockGroupReader(DataSourceReader):
    def __init__(self, path: str, blocks_per_row: int, split_bytes: int):
        if blocks_per_row < 1:
            raise ValueError("blocksPerRow must be positive")
        self.path = path
        self.blocks_per_row = blocks_per_row
        self.split_bytes = split_bytes

    def partitions(self):
        found = _indexed_files(self.path)
        return [InputPartition(split) for splits in files.on_each(found, self._splits) for split in splits]

    def _splits(self, file: files.SourceFile) -> list[tuple[str, list[tuple[int, int, int]]]]:
        """Groups of blocks as (number, start, length), as many to a task as ``maxSplitBytes`` allows."""
        splits, size = [(file.uri, [])], 0
        for group in group_blocks(load_index(file.uri, file.size), max_blocks=self.blocks_per_row):
            if splits[-1][1] and size + group.length > self.split_bytes:
                splits.append((file.uri, []))
                size = 0
            splits[-1][1].append((group.number, group.start, group.length))
            size += group.length
        return splits

    def read(self, partition):
        if partition is None:
            return
        uri, groups = partition.value
        with files.open_file(uri) as handle:
            for number, start, length in groups:
                payload = handle.read_at(length, start)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([uri]),
                        pa.array([number], pa.int32()),
                        pa.array([start], pa.int64()),
                        pa.array([length], pa.int64()),
                        pa.array([payload], pa.binary()),
                    ],
                    names=schemas.BLOCK_GROUP.names,
                )


class BlockWriter(PartWriter):
    def __init__(self, path: str, block_bytes: int):
        super().__init__(path)
        self.block_bytes = block_bytes

    def write(self, batches):
        name, out = self._create(".fq.gz")
        index, offset = ["#block\toffset\tsize\n"], 0
        with out:
            for number, block in enumerate(self._blocks(batches)):
                member = pack_member(block)
                out.write(member)
                index.append(f"{number}\t{offset}\t{len(member)}\n")
                offset += len(member)
        with self.staging.create(name + ".idx") as out:
            out.write("".join(index).encode())
        return WrittenPart([name + ".idx", name])

    def _blocks(self, batches):
        """Text of whole lines, cut from the column's buffers at the first line end beyond ``blockBytes``."""
        rest = b""
        for batch in batches:
            column = batch.column(0).cast(pa.large_string())
            if column.null_count:
                raise ValueError("gzip_blocks cannot write a NULL line")
            lines = pc.binary_join_element_wise(column, pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string()))
            offsets = np.frombuffer(lines.buffers()[1], np.int64)[lines.offset : lines.offset + len(lines) + 1]
            text = memoryview(lines.buffers()[2] or b"")
            start, done = int(offsets[0]), 0
            while True:
                wanted = start + self.block_bytes - len(rest)
                k = int(np.searchsorted(offsets, wanted))
                if k >= len(offsets):
                    break
                k = max(k, done + 1)
                yield rest + bytes(text[start : int(offsets[k])])
                rest, start, done = b"", int(offsets[k]), k
                if done == len(lines):
                    break
            rest += bytes(text[start : int(offsets[-1])])
        if rest:
            yield rest
