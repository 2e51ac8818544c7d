"""Pairs of mates that were read in step, and what such a reading cannot see.

Rows of the ``fastq_pairs`` source are part of the join by name: each holds a pair of equal name, or one record alone.
What the join has besides are pairs of records from different rows. Their names occur in more than one row, and
names alone, as hashes of eight bytes, tell which these are. In files of one order there are none.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from readmap.scratch import shared_folder
from readmap.sources.files import qualified
from readmap.sources.pairs import FastqPairsDataSource

PAIR_COLUMNS = ["name", "seq1", "qual1", "seq2", "qual2"]
#: Hashes of names that are sent to all tasks; beyond, the rows of their names are found by a shuffle.
MOST_SENT = 1_000_000


def read_fastq_pairs(spark: SparkSession, path1: str, path2: str, **options) -> DataFrame:
    """``name, has1, seq1, qual1, has2, seq2, qual2, row``: the records of both paths, in step."""
    spark.dataSource.register(FastqPairsDataSource)
    source = spark.read.format("fastq_pairs").options(**options)
    return source.options(path1=qualified(spark, path1), path2=qualified(spark, path2)).load()


def name_key() -> Column:
    return F.xxhash64("name")


def keys_again(keys: DataFrame) -> DataFrame:
    """Of a table ``key`` with a row per name and row, the keys that occur more than once, written to the shared folder."""
    again = keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    path = shared_folder(keys.sparkSession)
    again.write.parquet(path)
    return keys.sparkSession.read.schema("key long").parquet(path)


def pairs_across(rows: DataFrame, again: DataFrame) -> DataFrame:
    """Pairs of records of equal name from different rows, given the keys of all names that several rows have.

    The rows of these names are written to the shared folder when this is called, so that both sides come from one reading.
    """
    path = shared_folder(rows.sparkSession)
    rows.withColumn("key", name_key()).join(_sent(again), "key", "left_semi").drop("key").write.parquet(path)
    some = rows.sparkSession.read.schema(rows.schema).parquet(path)
    first = some.filter("has1").select("name", "seq1", "qual1", F.col("row").alias("_row1"))
    second = some.filter("has2").select("name", "seq2", "qual2", F.col("row").alias("_row2"))
    return first.join(second, "name").filter("_row1 <> _row2").select(*PAIR_COLUMNS)


def _sent(keys: DataFrame) -> DataFrame:
    return F.broadcast(keys) if keys.count() <= MOST_SENT else keys


def pair_files(spark: SparkSession, path1: str, path2: str, **options) -> DataFrame:
    """The rows of ``pair_reads`` on two paths, without a shuffle of sequences if the files are in one order.

    A first scan takes names only and runs at once; it shuffles eight bytes for each read. Records out of order, missing
    records and repeated names then cost a second reading of the files and a join of just those records. Options are those
    of ``fastq_pairs``.
    """
    names = read_fastq_pairs(spark, path1, path2, **options | {"namesOnly": "true"})
    again = keys_again(names.select(name_key().alias("key")))
    rows = read_fastq_pairs(spark, path1, path2, **options)
    pairs = rows.filter("has1 AND has2").select(*PAIR_COLUMNS)
    return pairs if again.isEmpty() else pairs.unionByName(pairs_across(rows, again))
