"""Read names."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalised_name(col) -> Column:
    """Name without a trailing ``/<digit>``, so both mates share it."""
    return F.regexp_replace(_column(col), "/[0-9]$", "")


def read_number(col) -> Column:
    """The digit of a trailing ``/<digit>``, NULL without one."""
    digit = F.regexp_extract(_column(col), "/([0-9])$", 1)
    return F.when(digit != "", digit.cast("int"))


def _column(col) -> Column:
    return F.col(col) if isinstance(col, str) else col
