"""Barcode mapping: read pairs and a mask in, placed reads and counters out."""

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readmap.operators.barcodes import captured_counts, one_mismatch_map, unique_mask
from readmap.operators.counters import run_counters
from readmap.operators.layout import ReadLayout
from readmap.operators.pairing import broken_reads, enforce_length, flagged_pairs, mate1, mate2

TAGGED_COLUMNS = ["name", "sequence", "quality", "umi", "umi_qual", "x", "y"]


@dataclass(frozen=True)
class Mapping:
    """Results of one run, each a lazy table that is planned when first asked for."""

    mask: DataFrame
    reads1: DataFrame
    reads2: DataFrame
    adapters: object
    layout: ReadLayout
    unique: bool
    mismatches: int

    @cached_property
    def _mates(self) -> tuple[DataFrame, DataFrame]:
        return mate1(self.reads1, self.layout), mate2(self.reads2, self.layout, self.adapters)

    @cached_property
    def lookup(self) -> DataFrame:
        """Positions by barcode: the mask, with what the options take away or add."""
        used = unique_mask(self.mask) if self.unique else self.mask
        if not self.mismatches:
            return used
        holder = self._mates[0 if self.layout.has_barcode(1) else 1]
        start = self.layout.barcode_start if self.layout.offset == "read" else 0
        captured = captured_counts(_usable(holder, self.layout))
        rescued = one_mismatch_map(captured, self.mask, self.layout.barcode_len, start=start, positions=used)
        return used.unionByName(rescued.select("barcode", "x", "y"))

    @cached_property
    def pairs(self) -> DataFrame:
        """Flagged pairs."""
        return flagged_pairs(*self._mates, self.layout)

    @cached_property
    def tagged(self) -> DataFrame:
        """Read 2 of each placed pair, once per coordinate of its barcode."""
        return tagged_reads(*self._mates, self.lookup, self.layout)

    @cached_property
    def broken(self) -> DataFrame:
        """Reads that take no part, because their record is broken, counted by mate and reason."""
        return broken_reads(self.reads1, self.reads2)

    @cached_property
    def counters(self) -> DataFrame:
        """One row."""
        return run_counters(self.reads1, self.reads2, self.mask, self.layout, self.adapters, self.lookup)


def map_barcodes(
    mask: DataFrame,
    reads1: DataFrame,
    reads2: DataFrame,
    *,
    adapters=None,
    layout: ReadLayout | None = None,
    unique: bool = False,
    mismatches: int = 0,
    **windows,
) -> Mapping:
    """Place read pairs on the chip.

    ``windows`` are the fields of :class:`ReadLayout`, as another way to give them. ``unique`` drops
    barcodes that the mask has more than once. ``mismatches=1`` also places barcodes that are one base
    away from exactly one mask barcode.
    """
    if layout is not None and windows:
        raise ValueError("give either a layout or its fields")
    if mismatches not in (0, 1):
        raise ValueError("mismatches must be 0 or 1")
    return Mapping(mask, reads1, reads2, adapters, layout or ReadLayout(**windows), unique, mismatches)


def tagged_reads(first: DataFrame, second: DataFrame, lookup: DataFrame, layout: ReadLayout) -> DataFrame:
    """Placed reads, from prepared mates.

    The mate that holds the barcode meets the mask first. If that is read 1, as it mostly is, this
    first join moves no sequences, and what it does not place takes no part in the join by name, so
    sequences and qualities of read 2 are shuffled once. Both joins read straight from their shuffles,
    which lets adaptive execution split a hot barcode or name on either side.
    """
    if layout.mode == "DROP":
        first, second = first.filter("NOT short1"), second.filter("NOT short2")
    first, second = _usable(first, layout), _usable(second, layout)
    if layout.has_barcode(1):
        first = _located(first, lookup, "short1", layout)
    else:
        second = _located(second, lookup, "short2", layout)
    pairs = first.join(second, "name")
    return enforce_length(pairs, layout).select(*TAGGED_COLUMNS)


def _usable(mate: DataFrame, layout: ReadLayout) -> DataFrame:
    """Drop what can no longer be placed. Short reads stay: whether they count depends on the mate."""
    if "adapter" in mate.columns:
        mate = mate.filter("NOT adapter")
    if "umi_bad" in mate.columns:
        short = "short2" if "adapter" in mate.columns else "short1"
        mate = mate.filter(~F.col("umi_bad") | F.col(short))
    return mate


def _located(mate: DataFrame, lookup: DataFrame, short: str, layout: ReadLayout) -> DataFrame:
    if layout.mode == "DROP":
        return mate.join(lookup, "barcode")
    # Short reads have no barcode but must reach the pair join: they meet a row of their own.
    table = lookup.select("barcode", F.lit(False).alias("_short"), "x", "y")
    nowhere = mate.sparkSession.range(0, 1, 1, 1).selectExpr(
        "id AS barcode", "true AS _short", "cast(NULL AS int) AS x", "cast(NULL AS int) AS y"
    )
    keyed = mate.withColumn("_short", F.col(short)).withColumn(
        "barcode", F.when(F.col(short), F.lit(0)).otherwise(F.col("barcode"))
    )
    return keyed.join(table.unionByName(nowhere), ["barcode", "_short"]).drop("_short")
