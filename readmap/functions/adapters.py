"""Adapter test: one regular expression for any number of adapters."""

import re
from itertools import groupby
from os.path import commonprefix

from pyspark.sql import Column
from pyspark.sql import functions as F


def has_adapter(col, adapters) -> Column:
    """True if the sequence contains one of the adapters, case-sensitively; false for NULL."""
    col = F.col(col) if isinstance(col, str) else col
    pattern = prefix_tree(adapters)
    return F.coalesce(F.rlike(col, F.lit(pattern)), F.lit(False)) if pattern else F.lit(False)


def prefix_tree(words) -> str:
    """Regular expression that finds any of the words; common beginnings are tried once.

    A word that begins with another one is left out, since the other is found there too.
    """
    kept: list[str] = []
    for word in sorted({w for w in words if w}):
        if not kept or not word.startswith(kept[-1]):
            kept.append(word)
    return _branches(kept) if kept else ""


def _branches(words: list[str]) -> str:
    """Words in order, none of them the beginning of another."""
    parts = []
    for _, group in groupby(words, key=lambda w: w[:1]):
        group = list(group)
        start = commonprefix(group)
        rest = [w[len(start) :] for w in group]
        parts.append(re.escape(start) + (_branches(rest) if len(rest) > 1 else ""))
    return parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})"
