"""Token ids in seekable files: independent zstandard frames, a seek table, a checksum for each frame.

A file is a row of zstandard frames, each of which can be decompressed alone, then two skippable frames,
so that any zstandard tool can decompress the whole:

* the directory: number of documents (u32), ids (i64 each), NULL flags (u8 each), tokens (u64 each);
* the seek table of the public seekable format: for each frame its compressed and its decompressed size
  and the low half of the XXH64 of its content (u32 each), then number of frames (u32), a descriptor byte
  with the checksum flag, and a magic number.

Decompressed, a file is the documents' ids one after another, unsigned 32-bit little-endian. A frame ends at
the first document end beyond ``FRAME_BYTES``; longer documents are split after ``LONGEST_FRAME`` bytes.
"""

import struct
import uuid
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readmap.llm.common import map_texts
from readmap.llm.tokens import WordEncoder, encoder, utf8
from readmap.sources.files import open_file, open_path

FRAME_BYTES = 1 << 16
LONGEST_FRAME = 1 << 20
LEVEL = 3
# Fixed values of the seekable format; the directory uses another of the magic numbers for skippable frames.
SKIPPABLE_DIRECTORY = 0x184D2A50
SKIPPABLE_SEEK_TABLE = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80
FOOTER, FOOTER_BYTES = "<IBI", 9


def _checksum(content: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(content) & 0xFFFFFFFF


class TokenFileWriter:
    """Appends documents to a stream; ``close`` writes directory and seek table."""

    def __init__(self, stream, frame_bytes: int = FRAME_BYTES, longest_frame: int = LONGEST_FRAME):
        import zstandard

        self.stream, self.frame_bytes, self.longest = stream, frame_bytes, longest_frame
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
        self.buffer, self.buffered = [], 0
        self.frames: list[tuple[int, int, int]] = []
        self.ids, self.nulls, self.sizes = [], [], []

    def add(self, doc_id: int | None, raw: bytes) -> None:
        self.ids.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.sizes.append(len(raw) // 4)
        self.buffer.append(raw)
        self.buffered += len(raw)
        if self.buffered >= self.frame_bytes:
            self._flush()

    def _flush(self) -> None:
        content = b"".join(self.buffer)
        for start in range(0, len(content), self.longest):
            part = content[start : start + self.longest]
            packed = self.compressor.compress(part)
            self.stream.write(packed)
            self.frames.append((len(packed), len(part), _checksum(part)))
        self.buffer, self.buffered = [], 0

    def close(self) -> None:
        self._flush()
        directory = struct.pack("<I", len(self.ids))
        directory += np.array(self.ids, "<i8").tobytes() + np.array(self.nulls, "u1").tobytes()
        directory += np.array(self.sizes, "<u8").tobytes()
        self.stream.write(struct.pack("<II", SKIPPABLE_DIRECTORY, len(directory)) + directory)
        table = np.array(self.frames, "<u4").tobytes() + struct.pack(FOOTER, len(self.frames), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self.stream.write(struct.pack("<II", SKIPPABLE_SEEK_TABLE, len(table)) + table)


class TokenFileReader:
    """Documents of one file; decompresses no frames but those that hold what is asked for."""

    def __init__(self, handle):
        import zstandard

        self.handle, self.decompressor = handle, zstandard.ZstdDecompressor()
        end = handle.size()
        count, flags, magic = struct.unpack(FOOTER, self._at(end - FOOTER_BYTES, FOOTER_BYTES))
        if magic != SEEKABLE_MAGIC or flags != CHECKSUM_FLAG:
            raise ValueError("no seek table with checksums at the end of the file")
        table = end - FOOTER_BYTES - 12 * count
        self.frames = np.frombuffer(self._at(table, 12 * count), "<u4").reshape(count, 3).astype(np.int64)
        self.places = np.concatenate([[0], np.cumsum(self.frames[:, 0])]).tolist()
        self.starts = np.concatenate([[0], np.cumsum(self.frames[:, 1])]).tolist()
        magic, size = struct.unpack("<II", self._at(self.places[-1], 8))
        if magic != SKIPPABLE_DIRECTORY or self.places[-1] + 8 + size + 8 != table:
            raise ValueError("the seek table does not cover the file")
        directory = self._at(self.places[-1] + 8, size)
        n = struct.unpack_from("<I", directory)[0]
        ids = np.frombuffer(directory, "<i8", n, 4)
        nulls = np.frombuffer(directory, "u1", n, 4 + 8 * n)
        self.tokens = np.frombuffer(directory, "<u8", n, 4 + 9 * n).astype(np.int64)
        self.doc_ids = [None if null else int(i) for i, null in zip(ids, nulls)]
        self.ends = np.cumsum(self.tokens) * 4
        self._frame = (-1, b"")

    def _at(self, offset: int, size: int) -> bytes:
        return self.handle.read_at(size, offset)

    def frame(self, number: int) -> bytes:
        if self._frame[0] != number:
            packed, plain, checksum = self.frames[number].tolist()
            content = self.decompressor.decompress(self._at(self.places[number], packed), max_output_size=plain)
            if len(content) != plain or _checksum(content) != checksum:
                raise ValueError(f"frame {number} is damaged")
            self._frame = (number, content)
        return self._frame[1]

    def document(self, number: int) -> bytes:
        """Id bytes of a document, by its place in the file."""
        end = int(self.ends[number])
        at, parts = end - 4 * int(self.tokens[number]), []
        while at < end:
            k = bisect_right(self.starts, at) - 1
            part = self.frame(k)[at - self.starts[k] : end - self.starts[k]]
            parts.append(part)
            at += len(part)
        return b"".join(parts)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Encode the whole ``text`` of each document, add ``end_id`` and write files in ascending ``doc_id`` order.

    Returns ``part int, file string, documents long, tokens long``, in order of ``part``. A NULL text is
    empty. Rows with a NULL id come first; rows with one id are ordered by text. An empty table gives no
    files. Only ``doc_id`` and ``text`` are read. Files of failed attempts stay, but are in no listing.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, end = encoder(WordEncoder, tokenizer).encode, struct.pack("<I", end_id)
        writer, stream, part = None, None, TaskContext.get().partitionId()
        name, documents, tokens = f"part-{part:06d}-{uuid.uuid4().hex}.tok.zst", 0, 0
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for start in range(0, len(doc_ids), 64):
                texts = encode(utf8(batch.column(1).slice(start, 64)))
                for doc_id, raw in zip(doc_ids[start : start + 64], texts):
                    if writer is None:
                        filesystem, folder = open_path(path)
                        filesystem.create_dir(folder, recursive=True)
                        stream = filesystem.open_output_stream(f"{folder}/{name}", compression=None)
                        writer = TokenFileWriter(stream)
                    writer.add(doc_id, raw + end)
                    documents, tokens = documents + 1, tokens + len(raw) // 4 + 1
        if writer is not None:
            writer.close()
            stream.close()
            columns = [[part], [f"{path}/{name}"], [documents], [tokens]]
            types = [pa.int32(), pa.string(), pa.int64(), pa.int64()]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], ["part", "file", "documents", "tokens"])

    # Collected at once, one row per file: run again, the tasks would write other files.
    listing = "part int, file string, documents long, tokens long"
    return docs.sparkSession.createDataFrame(map_texts(docs, write, listing).collect(), listing)


def read_token_files(spark: SparkSession, listing: DataFrame) -> DataFrame:
    """``doc_id long, start long, n_tokens long, ids binary`` of all documents in a listing's files.

    ``start`` counts the ids of all documents before. The listing has one row per file and is collected.
    """
    files, start = [], 0
    for row in sorted(listing.collect(), key=lambda r: r.part):
        files.append((row.file, start))
        start += row.tokens
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, first in zip(*(c.to_pylist() for c in batch.columns)):
                with open_file(name) as handle:
                    reader = TokenFileReader(handle)
                    rows: list[list] = [[], [], [], []]
                    for number, doc_id in enumerate(reader.doc_ids):
                        n = int(reader.tokens[number])
                        for column, value in zip(rows, (doc_id, first, n, reader.document(number))):
                            column.append(value)
                        first += n
                        if len(rows[0]) == 512:
                            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(rows, schema)], schema=schema)
                            rows = [[], [], [], []]
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(rows, schema)], schema=schema)

    table = spark.createDataFrame(files, "file string, start long").repartition(max(1, len(files)))
    return table.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def find_documents(listing: DataFrame, doc_ids: list[int]) -> dict[int, np.ndarray]:
    """Ids of single documents, by reading only their frames."""
    wanted, found = set(doc_ids), {}
    for row in listing.collect():
        with open_file(row.file) as handle:
            reader = TokenFileReader(handle)
            for number, doc_id in enumerate(reader.doc_ids):
                if doc_id in wanted:
                    found[doc_id] = np.frombuffer(reader.document(number), "<u4")
    return found


