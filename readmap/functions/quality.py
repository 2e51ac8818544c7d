"""Base qualities: ASCII Phred strings, Sanger (+33) inside, Illumina (+64) at the edges."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Offset of each encoding, and the highest score accepted in either.
OFFSETS = {"sanger": 33, "illumina": 64}
MAX_SCORE = 62


def quality_range(encoding: str) -> tuple[int, int]:
    """Lowest and highest byte allowed by an encoding."""
    if encoding not in OFFSETS:
        raise ValueError(f"unknown base quality encoding {encoding!r}, use 'sanger' or 'illumina'")
    return OFFSETS[encoding], OFFSETS[encoding] + MAX_SCORE


def first_bad_quality(col, encoding: str = "sanger") -> Column:
    """0-based index of the first character out of range, -1 if there is none."""
    low, high = quality_range(encoding)
    return F.regexp_instr(_column(col), F.lit(f"[^\\x{low:02x}-\\x{high:02x}]")) - 1


def quality_as(col, source: str, target: str) -> Column:
    """Quality string moved to another encoding; a character out of range fails the query."""
    if source == target:
        raise ValueError(f"current and target quality encodings are the same ({source})")
    col = _column(col)
    characters = {
        encoding: "".join(chr(c) for c in range(low, high + 1))
        for encoding, (low, high) in ((e, quality_range(e)) for e in (source, target))
    }
    bad = first_bad_quality(col, source)
    message = F.concat(
        F.lit(f"base quality score out of range for {source} at index "), bad.cast("string"), F.lit(": "), col
    )
    moved = F.translate(col, characters[source], characters[target])
    return F.when(bad < 0, moved).when(bad >= 0, F.raise_error(message).cast("string"))


def convert_quality(df: DataFrame, source: str, target: str, column: str = "quality") -> DataFrame:
    return df.withColumn(column, quality_as(column, source, target))


def q30_bases(col) -> Column:
    """Number of characters at or above Q30 (``'?'`` in Sanger encoding)."""
    return F.length(F.regexp_replace(_column(col), "[\\x00->]+", ""))


def _column(col) -> Column:
    return F.col(col) if isinstance(col, str) else col
