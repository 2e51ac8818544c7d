"""Chip masks: barcode key to coordinate, in binary or text files."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from readmap import schemas
from readmap.sources import files
from readmap.sources.parts import PartWriter, WrittenPart

# Fixed value: one binary record, little endian, no header.
RECORD = np.dtype([("barcode", "<i8"), ("x", "<i4"), ("y", "<i4")])
BATCH_RECORDS = 1 << 18


class MaskBinDataSource(DataSource):
    """``format('mask_bin')``; option ``maxSplitBytes`` per read task."""

    @classmethod
    def name(cls) -> str:
        return "mask_bin"

    def schema(self):
        return schemas.MASK

    def reader(self, schema):
        return MaskBinReader(
            self.options["path"], int(self.options.get("maxSplitBytes", 64 * files.MEBIBYTE))
        )

    def writer(self, schema, overwrite):
        if schema.names != schemas.MASK.names:
            raise ValueError(f"mask_bin writes the columns {schemas.MASK.names}")
        if overwrite:
            raise ValueError("mask_bin appends; write to a new path")
        return MaskBinWriter(self.options["path"])


class MaskBinReader(DataSourceReader):
    def __init__(self, path: str, split_bytes: int):
        self.path = path
        self.step = max(1, split_bytes // RECORD.itemsize) * RECORD.itemsize

    def partitions(self):
        splits = []
        for file in files.list_files(self.path):
            if file.size % RECORD.itemsize:
                raise ValueError(f"{file.uri}: size {file.size} is not a multiple of {RECORD.itemsize}")
            splits += [InputPartition((file.uri, a, b)) for a, b in files.byte_ranges(file.size, self.step)]
        return splits

    def read(self, partition):
        if partition is None:
            return
        uri, first, end = partition.value
        with files.open_file(uri) as handle:
            for start in range(first, end, BATCH_RECORDS * RECORD.itemsize):
                length = min(BATCH_RECORDS * RECORD.itemsize, end - start)
                records = np.frombuffer(handle.read_at(length, start), RECORD)
                columns = [pa.array(np.ascontiguousarray(records[n])) for n in RECORD.names]
                yield pa.RecordBatch.from_arrays(columns, names=list(RECORD.names))


class MaskBinWriter(PartWriter):
    def write(self, batches):
        name, out = self._create(".bin")
        with out:
            for batch in batches:
                records = np.empty(batch.num_rows, RECORD)
                for field in RECORD.names:
                    if batch.column(field).null_count:
                        raise ValueError(f"mask_bin cannot write a NULL {field}")
                    records[field] = batch.column(field).to_numpy(zero_copy_only=False)
                out.write(records.tobytes())
        return WrittenPart([name])


def read_text_mask(spark: SparkSession, path: str) -> DataFrame:
    """``barcode <tab> x <tab> y`` lines; more fields are ignored, a malformed line fails the query."""
    line = F.regexp_replace("value", r"^[\x00-\x20]+|[\x00-\x20]+$", "")
    fields = F.split(line, "\t")

    def field(k: int, kind: str):
        text = F.get(fields, F.lit(k))
        parsed = F.when(F.rlike(text, F.lit(r"^[+-]?[0-9]+$")), text.try_cast(kind))
        return F.coalesce(parsed, F.raise_error(F.concat(F.lit("malformed mask line: "), "value")).cast(kind))

    return spark.read.text(path).select(
        field(0, "bigint").alias("barcode"), field(1, "int").alias("x"), field(2, "int").alias("y")
    )


def read_mask(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """Mask by the suffix of its path, ``.bin`` or ``.txt``, or by ``fmt``."""
    fmt = fmt or path.rstrip("/").rpartition(".")[2]
    if fmt == "txt":
        return read_text_mask(spark, path)
    if fmt == "bin":
        spark.dataSource.register(MaskBinDataSource)
        return spark.read.format("mask_bin").load(files.qualified(spark, path))
    raise ValueError(f"a mask is a .bin or .txt path, not {path!r}")
