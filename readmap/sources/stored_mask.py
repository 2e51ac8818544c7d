"""Masks stored by barcode, so that a mapping moves reads to the mask and not the mask to the reads.

A stored mask is a bucketed table: its files are dealt out and sorted by barcode when they are written. A join by barcode
then shuffles reads alone, however often the mask is used.
"""

import zlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

COLUMNS = "barcode BIGINT, x INT, y INT, first BOOLEAN"


def _table_name(path: str) -> str:
    return f"readmap_mask_{zlib.crc32(path.rstrip('/').encode()):08x}"


def store_mask(mask: DataFrame, path: str, buckets: int) -> DataFrame:
    """Write a mask to a path, which must be new, in ``buckets`` files by barcode; returns it as ``stored_mask`` does.

    ``first`` marks one row of each barcode. A barcode with a NULL is no barcode and is left out.
    """
    if buckets < 1:
        raise ValueError("a stored mask needs at least one bucket")
    number = F.row_number().over(Window.partitionBy("barcode").orderBy("y", "x"))
    rows = mask.filter("barcode IS NOT NULL").select("barcode", "x", "y", (number == 1).alias("first"))
    spark, name = mask.sparkSession, _table_name(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    writer = rows.repartition(buckets, "barcode").write.bucketBy(buckets, "barcode").sortBy("barcode")
    writer.option("path", path).mode("errorifexists").format("parquet").saveAsTable(name)
    return stored_mask(spark, path, buckets)


def stored_mask(spark: SparkSession, path: str, buckets: int) -> DataFrame:
    """``barcode, x, y, first`` of a mask that ``store_mask`` has written, with as many buckets; known to any session by its path."""
    name = _table_name(path)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({COLUMNS}) USING parquet "
        f"CLUSTERED BY (barcode) SORTED BY (barcode) INTO {int(buckets)} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)
