"""Times of the main operators; one JSON line.

Reads are made from the tables in $BENCH_SF_DIR, each event $BENCH_COPIES times, and written once as a
table and as files. Only what follows is timed: best of two runs, results consumed in full.
"""

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from readmap import ReadLayout, map_barcodes, read_fastq, read_mask, register_sources, synth
from readmap.functions import barcode_encode
from readmap.operators import barcodes, order
from readmap.operators.counters import run_counters
from readmap.operators.pairing import flag_adapters, mate1, pair_reads
from readmap.scratch import shared_folder
from readmap.sinks import fastq_lines, write_tagged_fastq

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
COPIES = int(os.environ.get("BENCH_COPIES", "10"))
RUNS = 2


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(2 * int(CPUS)))
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-", dir="/tmp"))
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    register_sources(spark)
    return spark


def prepare(spark: SparkSession) -> dict:
    folder = shared_folder(spark)
    copies = F.explode(F.sequence(F.lit(1), F.lit(COPIES)))
    events = spark.read.parquet(f"{SF_DIR}/events.parquet").repartition(int(CPUS) * 2)
    made = synth.pairs_of(events.withColumn("copy", copies), name_suffix="copy")
    made.write.parquet(f"{folder}/pairs")
    synth.mask(spark, SF_DIR).write.parquet(f"{folder}/mask")
    pairs, mask = spark.read.parquet(f"{folder}/pairs"), spark.read.parquet(f"{folder}/mask")
    for number in (1, 2):
        lines = fastq_lines(synth.suffixed(synth.mate(pairs, number)))
        lines.write.text(f"{folder}/plain{number}")
        if number == 2:
            lines.write.option("compression", "gzip").text(f"{folder}/gzip")
            lines.write.format("gzip_blocks").option("blockBytes", 1 << 20).mode("append").save(f"{folder}/blocks")
    mask.write.format("mask_bin").mode("append").save(f"{folder}/mask.bin")
    # A mask of a million rows: the given one and, in order, barcodes that no read has.
    number = (1 << 49) + F.col("id") * 1_000_003
    rest = spark.range(1_000_000).select(number.alias("barcode"), F.col("id").cast("int").alias("x"), F.lit(0).alias("y"))
    mask.unionByName(rest).write.parquet(f"{folder}/large_mask")
    return {"folder": folder, "pairs": pairs, "mask": mask, "reads": pairs.count()}


def benchmarks(spark: SparkSession, data: dict) -> dict:
    pairs, mask, folder = data["pairs"], data["mask"], data["folder"]
    reads1, reads2 = synth.mate(pairs, 1), synth.mate(pairs, 2)
    captured = barcodes.captured_counts(mate1(synth.mate(synth.with_errors(pairs), 1), ReadLayout()))

    def mapping():
        return map_barcodes(mask, reads1, reads2, adapters=synth.ADAPTERS)

    def from_files():
        return map_barcodes(
            read_mask(spark, f"{folder}/mask.bin"),
            read_fastq(spark, f"{folder}/plain1", maxSplitBytes=1 << 25),
            read_fastq(spark, f"{folder}/plain2", maxSplitBytes=1 << 25),
            adapters=synth.ADAPTERS,
        )

    large = spark.read.parquet(f"{folder}/large_mask")
    adapters = synth.many_adapters(spark, SF_DIR)

    def shuffled(make):
        """Run with joins by shuffle, as a mask needs that is too large to broadcast."""
        before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            make().write.format("noop").mode("overwrite").save()
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)

    def job():
        mapping = from_files()
        mapping.counters.collect()
        write_tagged_fastq(mapping.tagged, shared_folder(spark))

    return {
        "map_barcodes": lambda: mapping().tagged,
        "map_barcodes_large_mask": lambda: shuffled(
            lambda: map_barcodes(large, reads1, reads2, adapters=synth.ADAPTERS).tagged
        ),
        "one_mismatch_large_mask": lambda: shuffled(lambda: barcodes.one_mismatch_map(captured, large)),
        "job_files": job,
        "run_counters": lambda: run_counters(reads1, reads2, mask, adapters=synth.ADAPTERS),
        "map_barcodes_files": lambda: from_files().tagged,
        "run_counters_files": lambda: from_files().counters,
        "write_tagged_fastq": lambda: write_tagged_fastq(mapping().tagged, shared_folder(spark)),
        "read_pairs": lambda: pair_reads(reads1, reads2),
        "barcode_encode": lambda: pairs.select(barcode_encode("seq1").alias("barcode")),
        "adapter_filter": lambda: flag_adapters(reads2, synth.ADAPTERS).filter("NOT adapter"),
        "adapter_filter_many": lambda: flag_adapters(reads2, adapters).filter("NOT adapter"),
        "captured_barcodes": lambda: barcodes.captured_barcodes(captured, mask),
        "one_mismatch_map": lambda: barcodes.one_mismatch_map(captured, mask),
        "unique_mask": lambda: barcodes.unique_mask(mask),
        "mask_position_order": lambda: order.position_ranks(mask),
        "fastq_scan": lambda: read_fastq(spark, f"{folder}/plain2", maxSplitBytes=1 << 25),
        "fastq_gzip_scan": lambda: read_fastq(spark, f"{folder}/gzip"),
        "fastq_block_gzip_scan": lambda: read_fastq(spark, f"{folder}/blocks", blockSplitBytes=1 << 22),
        "mask_bin_scan": lambda: read_mask(spark, f"{folder}/mask.bin"),
    }


def seconds(make) -> float:
    best = float("inf")
    for _ in range(RUNS):
        start = time.perf_counter()
        result = make()
        if result is not None:
            result.write.format("noop").mode("overwrite").save()
        best = min(best, time.perf_counter() - start)
    return round(best, 3)


def main() -> None:
    spark = session()
    data = prepare(spark)
    times = {name: seconds(make) for name, make in benchmarks(spark, data).items()}
    rate = {name: round(data["reads"] / t) for name, t in times.items() if "mask" not in name or "files" in name}
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "pairs": data["reads"],
                "pairs_per_sec": rate,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
