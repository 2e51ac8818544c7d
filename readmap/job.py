"""Batch job: ``spark-submit readmap/job.py -m mask.bin -r1 a_1.fq.gz -r2 a_2.fq.gz -o out``."""

import argparse
import os
import sys

if __package__ in (None, ""):  # started by spark-submit as a file
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from readmap import ReadLayout, map_barcodes, read_adapters, read_fastq, read_mask, schemas  # noqa: E402
from readmap.operators.counters import stats_report  # noqa: E402
from readmap.plans.one_pass import place_files  # noqa: E402
from readmap.sinks import write_report, write_tagged_fastq  # noqa: E402
from readmap.sources.files import is_there, list_files, qualified  # noqa: E402


def arguments(argv=None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Map reads of a spatial chip to their coordinates.")
    add = parser.add_argument
    add("-m", "--mask", required=True, help="chip mask, .bin or .txt")
    add("-r1", "--read1", required=True, help="FASTQ of read 1: file, directory, glob or list")
    add("-r2", "--read2", required=True, help="FASTQ of read 2")
    add("-o", "--out", required=True, help="output path; .gz compresses")
    add("-stat", "--stat", default="statistic.txt", help="statistics file")
    add("-adapterFile", "--adapterFile", help="FASTA of adapters; pairs with one in read 2 are dropped")
    add("-barcodeStart", "--barcodeStart", type=int, default=0)
    add("-barcodeLen", "--barcodeLen", type=int, default=25)
    add("-barcodeRead", "--barcodeRead", type=int, default=1)
    add("-umiStart", "--umiStart", type=int, default=25)
    add("-umiLen", "--umiLen", type=int, default=10)
    add("-umiRead", "--umiRead", type=int, default=1)
    add("-outPartition", "--outPartition", type=int, default=0, help="number of output files, 0: as they come")
    add("--rebalance", action="store_true", help="reach outPartition by a shuffle")
    add("--pairing", choices=["auto", "in-step", "by-name"], default="auto", help="in-step: files in one order, read once")
    add("--mode", choices=["FAILFAST", "DROP"], default="FAILFAST", help="pairs too short for their windows")
    add("--uniqueMask", action="store_true", help="drop barcodes the mask has more than once")
    add("--mismatches", type=int, choices=[0, 1], default=0)
    add("--inputQuality", choices=["sanger", "illumina"], default="sanger")
    add("--outputQuality", choices=["sanger", "illumina"], default="sanger")
    return parser.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace) -> str:
    """Write the placed reads and the report; returns the report's text.

    In step, files are read once, and the output appears when everything is written; ``auto`` takes that way if both paths
    have equally many files. By name, counting comes first. Either way, a malformed input fails before any output
    exists, and an output path that is there already fails before that.
    """
    if is_there(spark, args.out):
        raise FileExistsError(f"{args.out} exists")
    layout = ReadLayout(
        barcode_start=args.barcodeStart,
        barcode_len=args.barcodeLen,
        barcode_read=args.barcodeRead,
        umi_start=args.umiStart,
        umi_len=args.umiLen,
        umi_read=args.umiRead,
        mode=args.mode,
    )
    mask = read_mask(spark, args.mask)
    adapters = read_adapters(spark, args.adapterFile) if args.adapterFile else None
    mapping = map_barcodes(
        mask,
        read_fastq(spark, args.read1, qualityEncoding=args.inputQuality),
        read_fastq(spark, args.read2, qualityEncoding=args.inputQuality),
        adapters=adapters,
        layout=layout,
        unique=args.uniqueMask,
        mismatches=args.mismatches,
    )
    output = {"partitions": args.outPartition, "rebalance": args.rebalance, "quality": args.outputQuality}
    if not _in_step(spark, args):
        text = write_report(stats_report(mapping.counters, layout), args.stat)
        write_tagged_fastq(mapping.tagged, args.out, **output)
        return text
    counters = place_files(
        spark,
        args.read1,
        args.read2,
        mapping.lookup,
        args.out,
        adapters=adapters,
        layout=layout,
        qualityEncoding=args.inputQuality,
        **output,
    )
    row = counters | {"mask_rows": mask.count()}
    return write_report(stats_report(spark.createDataFrame([row], schemas.COUNTERS), layout), args.stat)


def _in_step(spark: SparkSession, args: argparse.Namespace) -> bool:
    if args.pairing != "auto":
        return args.pairing == "in-step"
    one, two = (list_files(qualified(spark, path), skip=(".idx",)) for path in (args.read1, args.read2))
    return len(one) == len(two)


def main(argv=None) -> None:
    args = arguments(argv)
    spark = SparkSession.builder.appName("readmap").getOrCreate()
    try:
        run(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
