"""Order of positions and barcodes, ranks, and layout columns."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Parts of the keys whose quantiles are taken first.
PARTS = 64


def order_positions(df: DataFrame) -> DataFrame:
    """By y, then x."""
    return df.orderBy("y", "x")


def order_barcodes(df: DataFrame) -> DataFrame:
    return df.orderBy("barcode")


def position_ranks(positions: DataFrame) -> DataFrame:
    """Distinct positions with their number of rows and their rank by y, then x."""
    above = F.col("x").cast("bigint") + F.lit(1 << 31)  # x moved to 0 .. 2^32 - 1
    ranks = ranked(positions, F.shiftleft(F.col("y").cast("bigint"), 32).bitwiseOR(above))
    x = F.col("key").bitwiseAND(F.lit((1 << 32) - 1)) - F.lit(1 << 31)
    return ranks.select(
        F.shiftright("key", 32).cast("int").alias("y"), x.cast("int").alias("x"), "n", "rank"
    )


def ranked(df: DataFrame, key: Column, ranges: int | None = None) -> DataFrame:
    """Distinct keys with their number of rows ``n`` and their ``rank`` (1 + rows with a smaller key).

    Equal keys are folded first. Ranks are counted inside ranges of similar size, then moved by what
    the ranges before hold; only these totals, one row per range, meet in one task. There are as many
    ranges as shuffle partitions, unless given. Their bounds are quantiles of the quantiles of some
    parts of the keys, so that no task sees more than one part.
    """
    if ranges is None:
        ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if ranges < 1:
        raise ValueError("there must be a range")
    groups = df.groupBy(key.alias("key")).agg(F.count("*").alias("n"))
    steps = ", ".join(f"{i / ranges}D" for i in range(1, ranges)) or "0.5D"
    quantiles = F.expr(f"percentile_approx(key, array({steps}), 10000)")
    parts = groups.groupBy(F.pmod(F.xxhash64("key"), F.lit(PARTS))).agg(quantiles.alias("_keys"))
    bounds = parts.select(F.explode("_keys").alias("key")).agg(quantiles).scalar()
    groups = groups.withColumn("_bounds", bounds).select("key", "n", _bounds_below("_bounds", "key", ranges).alias("_range"))
    totals = groups.groupBy("_range").agg(F.sum("n").alias("_total"))
    before = F.sum("_total").over(Window.orderBy("_range")) - F.col("_total")
    starts = totals.select("_range", before.alias("_before"))
    inside = F.sum("n").over(Window.partitionBy("_range").orderBy("key")) - F.col("n")
    return (
        groups.withColumn("_inside", inside)
        .join(starts, "_range")
        .select("key", "n", (F.col("_before") + F.col("_inside") + 1).alias("rank"))
    )


def _bounds_below(bounds: str, key: str, ranges: int) -> Column:
    """How many of the sorted bounds are below the key, by halving; never NULL, or a join would test it."""
    steps = ", ".join(str(1 << k) for k in reversed(range(max(1, ranges.bit_length()))))
    below = f"n + s <= size({bounds}) AND {bounds}[least(n + s, size({bounds})) - 1] < {key}"
    return F.expr(f"coalesce(aggregate(array({steps}), 0, (n, s) -> if({below}, n + s, n)), 0)")


def with_stripe(df: DataFrame, n: int, axis: str = "x") -> DataFrame:
    """Layout by coordinate: ``stripe`` = x (or y) modulo n, never negative."""
    if axis not in ("x", "y"):
        raise ValueError(f"axis must be 'x' or 'y', not {axis!r}")
    return df.withColumn("stripe", F.pmod(F.col(axis), F.lit(n)))


def with_barcode_bucket(df: DataFrame, n: int) -> DataFrame:
    """Layout by barcode: ``bucket`` = barcode modulo n, never negative."""
    return df.withColumn("bucket", F.pmod(F.col("barcode"), F.lit(n)).cast("int"))


def distinct_reads(reads: DataFrame) -> DataFrame:
    """Reads with the same number, sequence and quality as one row, whatever their names."""
    return reads.groupBy("read_no", "sequence", "quality").agg(F.count("*").alias("copies"))
