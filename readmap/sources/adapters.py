"""Adapter sequences from a FASTA file."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_adapters(spark: SparkSession, path: str) -> DataFrame:
    """Every line that does not start with ``>``, trimmed; blank lines are no adapters."""
    adapter = F.regexp_replace("value", r"^[\x00-\x20]+|[\x00-\x20]+$", "").alias("adapter")
    lines = spark.read.text(path).filter(~F.col("value").startswith(">"))
    return lines.select(adapter).filter("adapter <> ''").distinct()
