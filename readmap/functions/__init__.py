"""Column expressions, all built in: nothing leaves the JVM."""

from readmap.functions.adapters import has_adapter
from readmap.functions.barcode import barcode_decode, barcode_encode, neighbour_masks
from readmap.functions.names import normalised_name, read_number
from readmap.functions.quality import (
    convert_quality,
    first_bad_quality,
    q30_bases,
    quality_as,
)
from readmap.functions.umi import umi_bad

__all__ = [
    "barcode_decode",
    "barcode_encode",
    "convert_quality",
    "first_bad_quality",
    "has_adapter",
    "neighbour_masks",
    "normalised_name",
    "q30_bases",
    "quality_as",
    "read_number",
    "umi_bad",
]
