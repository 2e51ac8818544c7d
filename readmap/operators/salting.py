"""Equi-join of a table with hot keys and a table with one row per key."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 4  # a power of two


def salt(columns: list[str]) -> Column:
    """Salt of a row; never NULL, so that joins need not test it."""
    return F.xxhash64(*columns).bitwiseAND(F.lit(SALTS - 1))


def every_salt() -> Column:
    return F.explode(F.expr(f"array({', '.join(f'{s}L' for s in range(SALTS))})"))


def salted_join(many: DataFrame, few: DataFrame, key: str, spread: list[str], how: str = "inner") -> DataFrame:
    """Join on ``key``; each row of ``few`` (unique by key) is repeated per salt.

    Rows of ``many`` with the same key go to several tasks by a hash of the ``spread`` columns. The
    salt is a second join key, so both inputs are shuffled for this join alone and adaptive execution
    can split a hot partition further.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"no salted {how!r} join")
    salted = many.withColumn("_salt", salt(spread))
    return salted.join(few.withColumn("_salt", every_salt()), [key, "_salt"], how).drop("_salt")
