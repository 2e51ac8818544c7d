"""Barcodes as 64-bit keys, two bits per base."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The base for each two-bit code, in code order.
BASES = "ACTG"

# A base's code is bits 1 and 2 of its ASCII byte, so case does not matter and N codes as G.
_ASCII = "".join(chr(c) for c in range(32, 127))
_CODES = "".join(str((c >> 1) & 3) for c in range(32, 127))

# conv() goes through a 64-bit integer; 31 bases keep its sign bit clear.
_CHUNK = 31


def barcode_encode(col, start: int = 0, length: int = 25, offset: str = "read") -> Column:
    """Key of the bases ``[start, start + length)`` of a read.

    ``offset='read'`` puts base *i* of the read at bit 2i (modulo 64), ``'window'`` counts from the
    start of the window instead. The two agree for ``start=0``.
    """
    if start < 0 or length < 1:
        raise ValueError("start must not be negative and length must be positive")
    if offset not in ("read", "window"):
        raise ValueError(f"offset must be 'read' or 'window', not {offset!r}")
    col = _column(col)
    base = start if offset == "read" else 0
    key = None
    for done in range(0, length, _CHUNK):
        window = F.substring(col, start + done + 1, min(_CHUNK, length - done))
        digits = F.reverse(F.translate(window, _ASCII, _CODES))
        part = _rotate_left(F.conv(digits, 4, 10).cast("bigint"), 2 * (base + done) % 64)
        key = part if key is None else key.bitwiseOR(part)
    return key


def barcode_decode(col, length: int = 25) -> Column:
    """Bases of a key; inverse of :func:`barcode_encode` for windows that start at 0."""
    digits = F.lpad(F.conv(F.hex(_column(col)), 16, 4), 32, "0")
    bases = F.translate(F.reverse(digits), "0123", BASES)
    if length > 32:  # shifts wrap at 64 bits
        bases = F.repeat(bases, F.lit(-(-length // 32)))
    return F.substring(bases, 1, length)


def neighbour_masks(length: int = 25, masks: str = "base", start: int = 0) -> list[int]:
    """XOR masks that lead from a barcode to its one-mismatch neighbours.

    ``'base'`` changes exactly one base; ``start`` is where the barcode's bits begin, in bases.
    ``'reference'`` is the narrower published table: its values shift by one bit per step instead of
    two, over 25 steps.
    """
    if masks == "base":
        return [_signed(k << (2 * (start + i) % 64)) for i in range(length) for k in (1, 2, 3)]
    if masks == "reference":
        return sorted({k << i for i in range(25) for k in (1, 2, 3)})
    raise ValueError(f"masks must be 'base' or 'reference', not {masks!r}")


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def _rotate_left(value: Column, bits: int) -> Column:
    if bits == 0:
        return value
    return F.shiftleft(value, bits).bitwiseOR(F.shiftrightunsigned(value, 64 - bits))


def _column(col) -> Column:
    return F.col(col) if isinstance(col, str) else col
