"""Readers of the file formats."""

from pyspark.sql import DataFrame, SparkSession

from readmap.sources.adapters import read_adapters
from readmap.sources.fastq import FastqDataSource
from readmap.sources.files import qualified
from readmap.sources.gzip_blocks import GzipBlocksDataSource
from readmap.sources.mask import MaskBinDataSource, read_mask
from readmap.sources.pairs import FastqPairsDataSource
from readmap.sources.stored_mask import store_mask, stored_mask

__all__ = [
    "read_adapters",
    "read_block_index",
    "read_fastq",
    "read_gzip_blocks",
    "read_mask",
    "register_sources",
    "store_mask",
    "stored_mask",
]


def register_sources(spark: SparkSession) -> None:
    """Make ``fastq``, ``fastq_pairs``, ``mask_bin`` and ``gzip_blocks`` known to a session."""
    for source in (FastqDataSource, FastqPairsDataSource, MaskBinDataSource, GzipBlocksDataSource):
        spark.dataSource.register(source)


def read_fastq(spark: SparkSession, path: str, **options) -> DataFrame:
    spark.dataSource.register(FastqDataSource)
    return spark.read.format("fastq").options(**options).load(qualified(spark, path))


def read_gzip_blocks(spark: SparkSession, path: str, **options) -> DataFrame:
    """Groups of compressed blocks with their bytes: ``file, group_no, start, length, payload``."""
    spark.dataSource.register(GzipBlocksDataSource)
    return spark.read.format("gzip_blocks").options(**options).load(qualified(spark, path))


def read_block_index(spark: SparkSession, path: str) -> DataFrame:
    """Index rows alone: ``file, block_no, start, length``."""
    return read_gzip_blocks(spark, path, payload="false")
