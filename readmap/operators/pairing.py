"""From two read tables to flagged pairs.

Each mate is cut down to what later steps need before any shuffle: read 1 never carries its
sequence. All flags are computed there, one row at a time, and only looked at once mates have met,
since a read counts for nothing without its mate.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readmap.functions import barcode_encode, has_adapter, q30_bases, umi_bad
from readmap.operators.layout import ReadLayout

#: Bases of all adapters that a plan may hold.
MOST_ADAPTER_BASES = 10_000_000


def pair_reads(reads1: DataFrame, reads2: DataFrame) -> DataFrame:
    """Mates by name; a name that occurs more than once gives every combination."""
    first = reads1.select("name", F.col("sequence").alias("seq1"), F.col("quality").alias("qual1"))
    second = reads2.select("name", F.col("sequence").alias("seq2"), F.col("quality").alias("qual2"))
    return first.join(second, "name")


def windows(sequence, quality, layout: ReadLayout, read: int) -> dict[str, Column]:
    """Barcode and UMI columns that a read holds."""
    columns = {}
    if layout.has_barcode(read):
        start, length = layout.barcode_start, layout.barcode_len
        # Never NULL, or the join would test it in a filter of its own and so encode twice.
        columns["barcode"] = F.coalesce(barcode_encode(sequence, start, length, layout.offset), F.lit(0))
        columns["barcode_q30"] = q30_bases(F.substring(quality, start + 1, length))
    if layout.has_umi(read):
        umi = F.substring(sequence, layout.umi_start + 1, layout.umi_len)
        qualities = F.substring(quality, layout.umi_start + 1, layout.umi_len)
        columns["umi"] = umi
        columns["umi_qual"] = qualities
        columns["umi_bad"] = umi_bad(umi, qualities)
        columns["umi_q30"] = q30_bases(qualities)
    return columns


def too_short(layout: ReadLayout, read: int, sequence="sequence", quality="quality") -> Column:
    needed = layout.bases_needed(read)
    return F.least(*[F.coalesce(F.length(c), F.lit(0)) for c in (sequence, quality)]) < needed


def whole_reads(reads: DataFrame) -> DataFrame:
    """Reads without the rows that a PERMISSIVE scan gives for broken records, and without NULL texts."""
    if "_corrupt_reason" in reads.columns:
        reads = reads.filter("_corrupt_reason IS NULL")
    return reads.filter("sequence IS NOT NULL AND quality IS NOT NULL")


def broken_reads(reads1: DataFrame, reads2: DataFrame) -> DataFrame:
    """``read_no, reason, records``: what ``whole_reads`` leaves out, by mate."""
    counts = []
    for number, reads in enumerate((reads1, reads2), 1):
        reason = F.lit("no sequence or quality")
        if "_corrupt_reason" in reads.columns:
            reason = F.coalesce("_corrupt_reason", reason)
            reads = reads.filter("_corrupt_reason IS NOT NULL OR sequence IS NULL OR quality IS NULL")
        else:
            reads = reads.filter("sequence IS NULL OR quality IS NULL")
        grouped = reads.groupBy(reason.alias("reason")).agg(F.count("*").alias("records"))
        counts.append(grouped.select(F.lit(number).alias("read_no"), "reason", "records"))
    return counts[0].unionByName(counts[1])


def mate1(reads1: DataFrame, layout: ReadLayout) -> DataFrame:
    columns = windows("sequence", "quality", layout, 1)
    return whole_reads(reads1).select("name", too_short(layout, 1).alias("short1"), *_named(columns))


def mate2(reads2: DataFrame, layout: ReadLayout, adapters=None) -> DataFrame:
    columns = windows("sequence", "quality", layout, 2)
    return flag_adapters(whole_reads(reads2), adapters).select(
        "name",
        "sequence",
        "quality",
        "adapter",
        too_short(layout, 2).alias("short2"),
        *_named(columns),
        q30_bases("quality").alias("read_q30"),
        F.length("sequence").alias("read_bases"),
    )


def flag_adapters(reads: DataFrame, adapters=None) -> DataFrame:
    """Reads with a flag ``adapter``, never NULL: does the sequence contain one?

    ``adapters`` is a list or a one-column table, which is collected: all adapters are one regular
    expression in the plan, however many there are, and no read is shuffled for them.
    """
    return reads.withColumn("adapter", has_adapter("sequence", adapter_list(adapters)))


def adapter_list(adapters=None) -> list[str]:
    """Adapters as a list, of a list or a one-column table; more than ``MOST_ADAPTER_BASES`` are an error."""
    if isinstance(adapters, DataFrame):
        table = adapters.toDF("adapter").filter("adapter <> ''").distinct()
        bases = table.agg(F.coalesce(F.sum(F.length("adapter")), F.lit(0))).first()[0]
        if bases > MOST_ADAPTER_BASES:
            raise ValueError(f"{bases} bases of adapters, more than {MOST_ADAPTER_BASES}")
        adapters = [row[0] for row in table.collect()]
    return list(adapters or ())


def flagged_pairs(first: DataFrame, second: DataFrame, layout: ReadLayout) -> DataFrame:
    """Prepared mates, joined. In ``FAILFAST`` mode a short pair without adapter fails the query."""
    pairs = first.join(second, "name").withColumn("short", F.col("short1") | F.col("short2"))
    return enforce_length(pairs, layout).drop("short1", "short2")


def enforce_length(pairs: DataFrame, layout: ReadLayout) -> DataFrame:
    """Raise for short pairs; both mates are named, so the check cannot move below their join."""
    if layout.mode == "DROP":
        return pairs
    short = ~F.col("adapter") & (F.col("short1") | F.col("short2"))
    message = F.concat(F.lit("read shorter than its barcode or UMI window: "), "name")
    return pairs.filter(F.when(short, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))


def candidates(pairs: DataFrame) -> DataFrame:
    """Pairs that go on to the mask, as read 2 with barcode and UMI."""
    return pairs.filter("NOT adapter AND NOT short AND NOT umi_bad").select(
        "barcode", "name", "sequence", "quality", "umi", "umi_qual"
    )


def _named(columns: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in columns.items()]
