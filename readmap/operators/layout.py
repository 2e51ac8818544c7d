"""Where the barcode and the UMI sit in a read pair."""

from dataclasses import dataclass


@dataclass(frozen=True)
class ReadLayout:
    """Windows ``[start, start + len)`` in read 1, or in read 2 for any read number but 1.

    ``offset`` is that of ``barcode_encode``. ``mode`` says what becomes of a pair whose read is too
    short for its windows: ``FAILFAST`` fails the query, ``DROP`` drops and counts the pair.
    """

    barcode_start: int = 0
    barcode_len: int = 25
    barcode_read: int = 1
    umi_start: int = 25
    umi_len: int = 10
    umi_read: int = 1
    offset: str = "read"
    mode: str = "FAILFAST"

    def __post_init__(self):
        if self.barcode_start < 0 or self.umi_start < 0 or self.barcode_len < 1 or self.umi_len < 0:
            raise ValueError("window starts and lengths must not be negative, a barcode has bases")
        if self.mode not in ("FAILFAST", "DROP"):
            raise ValueError(f"mode must be FAILFAST or DROP, not {self.mode!r}")

    def has_barcode(self, read: int) -> bool:
        return (self.barcode_read == 1) == (read == 1)

    def has_umi(self, read: int) -> bool:
        return (self.umi_read == 1) == (read == 1)

    def bases_needed(self, read: int) -> int:
        ends = [0]
        if self.has_barcode(read):
            ends.append(self.barcode_start + self.barcode_len)
        if self.has_umi(read):
            ends.append(self.umi_start + self.umi_len)
        return max(ends)
