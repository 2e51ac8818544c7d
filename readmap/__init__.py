"""Spatial read mapping as Spark DataFrame jobs: FASTQ and chip masks in, placed reads out."""

from pyspark import cloudpickle as _cloudpickle
import sys as _sys

# Executors get the data source classes with the job, so no package has to be installed there.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

from readmap.operators.in_step import pair_files, read_fastq_pairs  # noqa: E402
from readmap.operators.layout import ReadLayout  # noqa: E402
from readmap.plans.mapping import Mapping, map_barcodes  # noqa: E402
from readmap.plans.one_pass import place_files  # noqa: E402
from readmap.sources import (  # noqa: E402
    read_adapters,
    read_block_index,
    read_fastq,
    read_gzip_blocks,
    read_mask,
    register_sources,
    store_mask,
    stored_mask,
)

__all__ = [
    "Mapping",
    "ReadLayout",
    "map_barcodes",
    "pair_files",
    "place_files",
    "read_adapters",
    "read_block_index",
    "read_fastq",
    "read_fastq_pairs",
    "read_gzip_blocks",
    "read_mask",
    "register_sources",
    "store_mask",
    "stored_mask",
]
