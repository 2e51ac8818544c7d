"""Reads, masks and adapters made from the tables ``events`` and ``customer``.

One read pair per event: read 1 is a barcode that stands for the user and a UMI, read 2 has 64 bases.
The mask knows two thirds of the customers, every tenth of them at a second position too.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from readmap.functions import barcode_encode

ADAPTERS = ["ACTGAC", "GGGGG"]
HEX = "0123456789abcdef"
HEX_TO_BASE = "ACTGACTGACTGACTG"
HEX_TO_QUALITY = "!+5?@ABCDEFGHI#)"
#: Rows of a table from which one task makes reads.
TASK_ROWS = 50_000


def _digest(prefix: str, number: str, alphabet: str) -> Column:
    return F.translate(F.md5(F.concat(F.lit(prefix), F.col(number).cast("string"))), HEX, alphabet)


def bases(prefix: str, number: str, n: int = 32) -> Column:
    return F.substring(_digest(prefix, number, HEX_TO_BASE), 1, n)


def qualities(prefix: str, number: str) -> Column:
    return _digest(prefix, number, HEX_TO_QUALITY)


def spread(table: DataFrame, *columns: str) -> DataFrame:
    """The columns of a table, a few numbers, over as many tasks as its rows need, in one order whenever it is read.

    A small file becomes few tasks, however much work is made of each of its rows. Two tasks at least: rows
    that are all in one are shuffled by no join, and small tables shall go the way of large ones.
    """
    tasks = -(-table.count() // TASK_ROWS)
    return table.select(*columns).repartition(max(tasks, 2)).sortWithinPartitions(*columns)


def made_once(*columns: Column) -> Column:
    """The columns as one row of ``inline``: Spark would otherwise copy what makes them into each filter on them."""
    return F.inline(F.array(F.struct(*columns)))


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id, name, seq1, qual1, seq2, qual2``."""
    return pairs_of(spread(spark.read.parquet(f"{sf_dir}/events.parquet"), "event_id", "user_id"))


def pairs_of(events: DataFrame, name_suffix: str | None = None) -> DataFrame:
    """The pair of each event; a suffix column tells the names of repeated events apart."""
    number = F.col("event_id")
    umi = (
        F.when(number % 17 == 0, "NACGTACGTA")
        .when(number % 23 == 0, "AAAAAAAAAA")
        .otherwise(bases("u", "event_id", 10))
    )
    name = [F.lit("E"), number.cast("string")]
    if name_suffix:
        name += [F.lit("."), F.col(name_suffix).cast("string")]
    return events.select(
        "event_id",
        F.concat(*name).alias("name"),
        F.concat(bases("b", "user_id", 25), umi).alias("seq1"),
        F.concat(qualities("q", "event_id"), F.lit("III")).alias("qual1"),
        F.concat(bases("r", "event_id"), bases("s", "event_id")).alias("seq2"),
        F.concat(qualities("v", "event_id"), qualities("w", "event_id")).alias("qual2"),
    )


def mate(pairs: DataFrame, number: int) -> DataFrame:
    """One mate as a table of reads."""
    return pairs.select(
        made_once(
            F.col("name"),
            F.lit(number).alias("read_no"),
            F.col(f"seq{number}").alias("sequence"),
            F.col(f"qual{number}").alias("quality"),
        )
    )


def mates(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    made = pairs(spark, sf_dir)
    return mate(made, 1), mate(made, 2)


def mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("c_custkey")
    # One pass over the table: a customer gives no, one or two rows.
    known = F.when(
        number % 3 != 0,
        F.struct((number % 50).cast("int").alias("x"), F.floor(number / 50).cast("int").alias("y")),
    )
    twice = F.when(number % 10 == 1, F.struct(F.lit(900).alias("x"), F.lit(900).alias("y")))
    return (
        spread(spark.read.parquet(f"{sf_dir}/customer.parquet"), "c_custkey")
        .select("c_custkey", made_once(barcode_encode(bases("b", "c_custkey", 25)).alias("barcode")))
        .select("barcode", F.inline(F.array_compact(F.array(known, twice))))
        .select("barcode", "x", "y")
    )


def suffixed(reads: DataFrame) -> DataFrame:
    """Reads named as in a file: with ``/<number>``."""
    return reads.withColumn("name", F.concat("name", F.lit("/"), F.col("read_no").cast("string")))


def with_errors(pairs: DataFrame) -> DataFrame:
    """Every fourth read 1 with one base of its barcode changed."""
    at = (F.col("event_id") % 25).cast("int") + 1
    base = F.substring("seq1", at, F.lit(1))
    changed = F.translate(base, "ACTG", "CTGA")
    altered = F.concat(F.substring("seq1", F.lit(1), at - 1), changed, F.substring("seq1", at + 1, F.lit(99)))
    return pairs.withColumn("seq1", F.when(F.col("event_id") % 4 == 0, altered).otherwise(F.col("seq1")))


def many_adapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One adapter per supplier, six to eight bases long."""
    length = (F.col("s_suppkey") % 3 + 6).cast("int")
    adapter = F.substring(bases("a", "s_suppkey"), F.lit(1), length)
    return spark.read.parquet(f"{sf_dir}/supplier.parquet").select(adapter.alias("adapter"))
