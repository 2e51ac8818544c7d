"""Joins and aggregates on the barcode key."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readmap.functions import neighbour_masks
from readmap.operators.salting import every_salt, salt, salted_join
from readmap.scratch import shared_folder

#: Pairs of a group that are compared without more ado, buckets that groups are counted in, and groups that are broadcast.
HOT_PAIRS, BUCKETS, MOST_SENT = 10_000, 1 << 16, 1_000_000


def unique_mask(mask: DataFrame) -> DataFrame:
    """Mask without the barcodes that occur more than once; none of their rows is kept."""
    grouped = mask.groupBy("barcode").agg(
        F.count("*").alias("_n"), F.min("x").alias("x"), F.min("y").alias("y")
    )
    return grouped.filter("_n = 1").drop("_n")


def unique_barcode_count(mask: DataFrame) -> DataFrame:
    return unique_mask(mask).agg(F.count("*").alias("unique_barcodes"))


def captured_counts(reads: DataFrame) -> DataFrame:
    """Reads per barcode."""
    return reads.filter("barcode IS NOT NULL").groupBy("barcode").agg(F.count("*").alias("reads"))


def captured_barcodes(captured: DataFrame, mask: DataFrame) -> DataFrame:
    """Captured barcodes with their coordinates, NULL for a barcode that the mask lacks.

    Same rows as a left join. In two parts, so that the positions of a barcode which the mask repeats
    without bound are spread over tasks; both parts read the same shuffle of the captured counts.
    """
    known = captured.join(_keys(mask).withColumn("_known", F.lit(True)), "barcode", "left")
    located = salted_join(mask, known.filter("_known"), "barcode", ["x", "y"])
    missing = known.filter("_known IS NULL").selectExpr(
        "barcode", "reads", "cast(NULL AS int) AS x", "cast(NULL AS int) AS y"
    )
    return located.select("barcode", "reads", "x", "y").unionByName(missing)


def mapped_barcodes(captured: DataFrame, mask: DataFrame) -> DataFrame:
    return captured.join(_keys(mask), "barcode", "left_semi")


def unmapped_barcodes(captured: DataFrame, mask: DataFrame) -> DataFrame:
    return captured.join(_keys(mask), "barcode", "left_anti")


def one_mismatch_map(
    captured: DataFrame,
    mask: DataFrame,
    length: int = 25,
    masks: str = "base",
    start: int = 0,
    positions: DataFrame | None = None,
) -> DataFrame:
    """Coordinates for unmapped barcodes that are one mismatch away from exactly one mask barcode.

    What is unmapped, and how many neighbours it has, is decided by the whole mask. Coordinates come
    from ``positions`` where given, a part of the mask: a barcode whose neighbour that lacks has none.

    Two barcodes one base apart agree outside one of their halves: both go under what the two halves leave, and
    those that meet are compared. Where too many would meet, the half is cut again (``one_base_apart``), so work grows with
    the barcodes, never with pairs. With ``masks="base"``, distinct barcodes of both sides are written to the shared folder, and
    their groups are counted, when this is called.
    """
    keys = _keys(mask)
    unmapped = captured.select("barcode").distinct().join(keys, "barcode", "left_anti")
    if masks == "base":
        hits = one_base_apart(_written(unmapped), _written(keys), length, start)
    else:
        steps = ", ".join(f"bigint('{m}')" for m in neighbour_masks(length, masks, start))
        neighbours = unmapped.select("barcode", F.explode(F.expr(f"array({steps})")).alias("_step")).select(
            "barcode", F.col("barcode").bitwiseXOR(F.col("_step")).alias("mask_barcode")
        )
        hits = neighbours.join(keys.withColumnRenamed("barcode", "mask_barcode"), "mask_barcode")
    nearest = hits.groupBy("barcode").agg(
        F.count("*").alias("_n"), F.min("mask_barcode").alias("mask_barcode")
    )
    nearest = nearest.filter("_n = 1").drop("_n")
    # Several barcodes may share a mask barcode, and the mask may repeat it: spread its positions.
    positions = (mask if positions is None else positions).withColumnRenamed("barcode", "mask_barcode").withColumn("_salt", salt(["x", "y"]))
    placed = nearest.withColumn("_salt", every_salt()).join(positions, ["mask_barcode", "_salt"])
    return placed.select("barcode", "mask_barcode", "x", "y")


def one_base_apart(barcodes: DataFrame, keys: DataFrame, length: int, start: int = 0) -> DataFrame:
    """Pairs ``barcode, mask_barcode`` that differ in exactly one base of the window."""
    differ = F.col("barcode").bitwiseXOR(F.col("mask_barcode"))
    base = differ.bitwiseOR(F.shiftrightunsigned(differ, 1)).bitwiseAND(F.lit(0x5555555555555555))
    return meeting(barcodes, keys, length, start).filter(F.bit_count(base) == 1)


def meeting(barcodes: DataFrame, keys: DataFrame, length: int, start: int = 0) -> DataFrame:
    """Pairs of distinct barcodes to compare: those that agree outside a segment of the window.

    The first segments are the two halves. A group, that is one segment and what it leaves of a barcode, in which more than
    ``HOT_PAIRS`` would meet is not joined: its barcodes go under the two parts of the segment, in one of which the one
    base lies. Segments of one base leave groups of four barcodes at most, so this ends, and no pair of one base meets twice.
    """
    bases = [3 << (2 * ((start + i) % 32)) for i in range(length)]
    segments = {2: range(length // 2), 3: range(length // 2, length)}
    left = _under(barcodes.select(F.col("barcode").alias("_b")), segments, bases)
    right = _under(keys.select(F.col("barcode").alias("_b")), segments, bases)
    found = []
    while True:
        hot = _hot_groups(left, right) if any(len(s) > 1 for s in segments.values()) else None
        cold = left if hot is None else left.join(hot, ["_segment", "_rest"], "left_anti")
        met = cold.withColumnRenamed("_b", "barcode").join(right.withColumnRenamed("_b", "mask_barcode"), ["_segment", "_rest"])
        found.append(met.select("barcode", "mask_barcode"))
        if hot is None:
            return reduce(DataFrame.unionByName, found)
        # As in a heap, the parts of segment n are 2 n and 2 n + 1.
        halves = {n: (s[: len(s) // 2], s[len(s) // 2 :]) for n, s in segments.items()}
        segments = {2 * n + k: part for n, parts in halves.items() for k, part in enumerate(parts) if part}
        left, right = (_written(_under(side.join(hot, ["_segment", "_rest"], "left_semi"), segments, bases)) for side in (left, right))


def _under(frame: DataFrame, segments: dict[int, range], bases: list[int]) -> DataFrame:
    """Each barcode under the segments, or under the parts of the segment that it is under."""
    inside = "_segment" in frame.columns
    rests = []
    for n, segment in segments.items():
        rest = F.col("_b").bitwiseAND(F.lit(_signed(~sum({bases[i] for i in segment}))))
        entry = F.struct(F.lit(n).alias("_segment"), rest.alias("_rest"))
        rests.append(F.when(F.col("_segment") == n // 2, entry) if inside else entry)
    return frame.select("_b", F.inline(F.array_compact(F.array(*rests))))


def _hot_groups(left: DataFrame, right: DataFrame) -> DataFrame | None:
    """Groups in which more than ``HOT_PAIRS`` would meet, marked for broadcast if they are few; None if there are none.

    Groups are counted by hash first, into so few buckets that counts fold before they are shuffled. Buckets that
    stand out are counted by group. What is missed here is joined as it is, with the same result.
    """
    bucket = F.xxhash64("_segment", "_rest").bitwiseAND(F.lit(BUCKETS - 1))

    def counts(frame: DataFrame, by: list[str], name: str) -> DataFrame:
        return frame.groupBy(*by).agg(F.count("*").alias(name))

    def pairs(one: DataFrame, two: DataFrame, by: list[str]) -> DataFrame:
        return counts(one, by, "n").join(counts(two, by, "m"), by).withColumn("pairs", F.col("n").cast("double") * F.col("m"))

    left, right = left.withColumn("_bucket", bucket), right.withColumn("_bucket", bucket)
    buckets = _written(pairs(left, right, ["_bucket"]))
    usual = buckets.agg((F.sum("n") / BUCKETS) * (F.sum("m") / BUCKETS)).first()[0] or 0
    hot = buckets.filter(F.col("pairs") > HOT_PAIRS + 4 * usual).select("_bucket")
    if hot.isEmpty():
        return None
    hot = F.broadcast(hot)  # BUCKETS at most
    some = (frame.join(hot, "_bucket", "left_semi") for frame in (left, right))
    groups = _written(pairs(*some, ["_segment", "_rest"]).filter(F.col("pairs") > HOT_PAIRS).select("_segment", "_rest"))
    n = groups.count()
    return None if not n else F.broadcast(groups) if n <= MOST_SENT else groups


def _written(frame: DataFrame) -> DataFrame:
    """The rows, written to the shared folder and read again."""
    path = shared_folder(frame.sparkSession)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _signed(bits: int) -> int:
    bits &= (1 << 64) - 1
    return bits - (1 << 64) if bits >> 63 else bits


def _keys(mask: DataFrame) -> DataFrame:
    return mask.select("barcode").distinct()
