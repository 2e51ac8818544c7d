"""Writer that counts what it writes: placed reads as FASTQ, and the counters of the run, in one pass.

Each task adds up the counters of the rows it gets and sends the sums with its commit message. Spark commits one attempt of
each task, so retries and speculative attempts count once, as their files are seen once.
"""

import json
import uuid
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from readmap.sources.parts import Staging

COUNTERS = ["total", "adapter", "short_reads", "umi_bad", "mapped", "bq", "uq", "rq", "rb"]
LINES_FILE, KEYS, LONE, SUMS = "part-{}{}", "keys/part-{}.parquet", "lone/part-{}.parquet", "counters.json"


class CountedFastqDataSource(DataSource):
    """``format('counted_fastq')``, to write only.

    Columns: ``value``, the record's four lines or NULL; the counters, NULL as 0; ``key``, a hash of the read's name, or NULL;
    ``lone``, a struct, NULL but for records without mate. Options: ``path`` for the lines; ``side``, a new folder for
    ``counters.json``, ``keys`` (key, and whether it is that of a lone record) and ``lone``; ``compression``, ``gzip`` or ``none``.
    """

    @classmethod
    def name(cls) -> str:
        return "counted_fastq"

    def schema(self):
        raise ValueError("counted_fastq is written only")

    def writer(self, schema, overwrite):
        missing = {"value", "key", "lone", *COUNTERS} - set(schema.names)
        if missing or overwrite:
            raise ValueError(f"counted_fastq appends the columns value, key, lone and {COUNTERS}")
        return CountedFastqWriter(self.options["path"], self.options["side"], self.options.get("compression", "none"))


@dataclass
class CountedPart(WriterCommitMessage):
    names: list[str] = field(default_factory=list)
    side_names: list[str] = field(default_factory=list)
    sums: list[int] = field(default_factory=lambda: [0] * len(COUNTERS))


class CountedFastqWriter(DataSourceArrowWriter):
    def __init__(self, path: str, side: str, compression: str):
        if compression not in ("gzip", "none"):
            raise ValueError(f"compression must be gzip or none, not {compression!r}")
        self.lines, self.side, self.gzip = Staging(path), Staging(side), compression == "gzip"

    def write(self, batches):
        attempt = _Attempt(self, uuid.uuid4().hex)
        with attempt:
            for batch in batches:
                attempt.add(batch)
        return attempt.part

    def commit(self, messages):
        parts = [message for message in messages if message]
        sums = [sum(column) for column in zip([0] * len(COUNTERS), *(part.sums for part in parts))]
        with self.side.create(SUMS) as out:
            out.write(json.dumps(dict(zip(COUNTERS, sums))).encode())
        self.side.publish([SUMS, *(name for part in parts for name in part.side_names)])
        self.lines.publish([name for part in parts for name in part.names])

    def abort(self, messages):
        self.side.discard()
        self.lines.discard()


class _Attempt:
    """Files of one task attempt, each made when the first row for it comes."""

    def __init__(self, writer: CountedFastqWriter, number: str):
        self.writer, self.number, self.part = writer, number, CountedPart()
        self.out = self.keys = self.lone = None
        self.deflate = zlib.compressobj(6, zlib.DEFLATED, 31) if writer.gzip else None
        self.open: list = []

    def __enter__(self):
        return self

    def __exit__(self, kind, *rest):
        if kind is None and self.out is not None and self.deflate:
            self.out.write(self.deflate.flush())
        for file in reversed(self.open):
            file.close()

    def add(self, batch: pa.RecordBatch) -> None:
        for k, name in enumerate(COUNTERS):
            self.part.sums[k] += pc.sum(batch.column(name)).as_py() or 0
        self._add_lines(batch.column("value").drop_null())
        lone = batch.column("lone")
        keyed = batch.column("key").is_valid()
        if pc.any(keyed).as_py():
            keys = pa.table({"key": batch.column("key"), "lone": lone.is_valid()}).filter(keyed)
            self.keys = self.keys or self._parquet(KEYS, keys.schema)
            self.keys.write_table(keys)
        if lone.null_count < len(lone):
            rows = pa.Table.from_batches([pa.RecordBatch.from_struct_array(lone.drop_null())])
            self.lone = self.lone or self._parquet(LONE, rows.schema)
            self.lone.write_table(rows)

    def _add_lines(self, values: pa.Array) -> None:
        if not len(values):
            return
        if self.out is None:
            self.part.names.append(LINES_FILE.format(self.number, ".txt.gz" if self.deflate else ".txt"))
            self.out = self.writer.lines.create(self.part.names[-1])
            self.open.append(self.out)
        text = pc.binary_join_element_wise(values.cast(pa.large_string()), *(pa.scalar(t, pa.large_string()) for t in ("", "\n")))
        offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
        raw = memoryview(text.buffers()[2])[int(offsets[0]) : int(offsets[-1])]
        self.out.write(self.deflate.compress(raw) if self.deflate else raw)

    def _parquet(self, pattern: str, schema: pa.Schema) -> pq.ParquetWriter:
        self.part.side_names.append(pattern.format(self.number))
        out = self.writer.side.create(self.part.side_names[-1])
        writer = pq.ParquetWriter(out, schema, compression="zstd")
        self.open += [out, writer]
        return writer
