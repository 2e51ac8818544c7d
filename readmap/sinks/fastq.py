"""FASTQ text out of read tables."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readmap.functions import quality_as
from readmap.functions.quality import quality_range
from readmap.operators.order import with_stripe

# Tags after the read name, in this order.
COORDINATE_TAG = "|||CB:Z:"
UMI_TAG = "|||UR:Z:"
UMI_QUALITY_TAG = "|||UY:Z:"


def coordinate(x="x", y="y") -> Column:
    """``x_y``, NULL if either is NULL."""
    return F.concat(F.col(x).cast("string"), F.lit("_"), F.col(y).cast("string"))


def fastq_lines(df: DataFrame, quality: str = "sanger") -> DataFrame:
    """One column ``value`` with the four lines of each read.

    Columns ``x`` and ``y``, ``umi`` and ``umi_qual`` become tags of the name where present and not
    NULL. The last newline is left to the text writer.
    """
    return df.select(record_text(df.columns, quality).alias("value"), *[c for c in df.columns if c == "stripe"])


def record_text(columns: list[str], quality: str = "sanger") -> Column:
    """The four lines of a read, from those of the columns that there are."""
    quality_range(quality)
    header = [F.lit("@"), F.coalesce("name", F.lit(""))]
    if {"x", "y"} <= set(columns):
        header.append(_tag(COORDINATE_TAG, coordinate()))
    for tag, column in ((UMI_TAG, "umi"), (UMI_QUALITY_TAG, "umi_qual")):
        if column in columns:
            header.append(_tag(tag, F.col(column)))
    qualities = F.col("quality") if quality == "sanger" else quality_as("quality", "sanger", quality)
    return F.concat(*header, F.lit("\n"), F.col("sequence"), F.lit("\n+\n"), qualities)


def _tag(tag: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(tag), value), F.lit(""))


def write_tagged_fastq(
    df: DataFrame,
    path: str,
    *,
    compression: str | None = None,
    partitions: int = 0,
    rebalance: bool = False,
    quality: str = "sanger",
) -> None:
    """Part files under ``path``, which must not exist.

    A path that ends in ``.gz`` is compressed. ``partitions`` lowers the number of files without a
    shuffle, and with it the number of tasks of the last join; with ``rebalance`` rows are shuffled
    into exactly that many files instead.
    """
    if compression is None and path.endswith(".gz"):
        compression = "gzip"
    lines = fastq_lines(df, quality)
    if partitions > 0:
        lines = lines.repartition(partitions) if rebalance else lines.coalesce(partitions)
    lines.write.option("compression", compression or "none").mode("errorifexists").text(path)


def write_striped(df: DataFrame, path: str, n: int, axis: str = "x", compression: str | None = None) -> None:
    """FASTQ in one directory per chip stripe, ``stripe=0`` to ``stripe=n-1``.

    Stripes are gathered by a rebalancing shuffle: it splits a large stripe into several files.
    """
    lines = fastq_lines(with_stripe(df, n, axis)).hint("rebalance", "stripe")
    writer = lines.write.partitionBy("stripe").option("compression", compression or "none")
    writer.mode("errorifexists").text(path)


def qseq_lines(reads: DataFrame) -> DataFrame:
    """``read number <tab> sequence <tab> quality`` lines; a missing number is ``null``."""
    number = F.coalesce(F.col("read_no").cast("string"), F.lit("null"))
    return reads.select(F.concat_ws("\t", number, "sequence", "quality").alias("line"))
