"""Queries over the given tables: one per operator, on reads and masks made from them.

Queries on files first write them with Spark, from the same tables, to a folder all executors share.
"""

import zlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from readmap import (
    map_barcodes,
    read_adapters,
    read_block_index,
    read_fastq,
    read_gzip_blocks,
    read_mask,
    register_sources,
    store_mask,
    synth,
)
from readmap.functions import (
    barcode_decode,
    barcode_encode,
    convert_quality,
    first_bad_quality,
    normalised_name,
    q30_bases,
    read_number,
    umi_bad,
)
from readmap import schemas
from readmap.operators import barcodes, order
from readmap.operators.counters import run_counters, stats_report
from readmap.operators.in_step import pair_files
from readmap.operators.layout import ReadLayout
from readmap.operators.pairing import flag_adapters, mate1, pair_reads
from readmap.operators.pairing import windows as read_windows
from readmap.plans.one_pass import place_files
from readmap.scratch import shared_folder
from readmap.sources import files
from readmap.sinks import fastq_lines, qseq_lines, write_striped, write_tagged_fastq

STRIPES, BUCKETS, FILES = 8, 16, 32


def _mapping(spark, sf, **options):
    reads1, reads2 = synth.mates(spark, sf)
    options.setdefault("adapters", synth.ADAPTERS)
    return map_barcodes(synth.mask(spark, sf), reads1, reads2, **options)


# Whole mapping


def mapped(spark: SparkSession, sf: str) -> DataFrame:
    return _mapping(spark, sf).tagged


def mapped_stored_mask(spark: SparkSession, sf: str) -> DataFrame:
    """Against a mask that is stored by barcode and is not moved."""
    reads1, reads2 = synth.mates(spark, sf)
    mask = store_mask(synth.mask(spark, sf), shared_folder(spark), BUCKETS)
    return map_barcodes(mask, reads1, reads2, adapters=synth.ADAPTERS, mode="DROP").tagged


def mapped_unique(spark: SparkSession, sf: str) -> DataFrame:
    return _mapping(spark, sf, unique=True).tagged


def mapped_with_mismatch(spark: SparkSession, sf: str) -> DataFrame:
    pairs = synth.with_errors(synth.pairs(spark, sf))
    reads1, reads2 = synth.mate(pairs, 1), synth.mate(pairs, 2)
    mapping = map_barcodes(synth.mask(spark, sf), reads1, reads2, adapters=synth.ADAPTERS, mismatches=1)
    return mapping.tagged


def mapped_unique_with_mismatch(spark: SparkSession, sf: str) -> DataFrame:
    """Barcodes of six bases, so short that many are next to several mask barcodes, or to a repeated one."""
    reads1, reads2 = synth.mates(spark, sf)
    mask = synth.mask(spark, sf).withColumn("barcode", F.col("barcode").bitwiseAND(F.lit((1 << 12) - 1)))
    options = {"adapters": synth.ADAPTERS, "barcode_len": 6, "unique": True, "mismatches": 1}
    return map_barcodes(mask, reads1, reads2, **options).tagged


def mapped_damaged(spark: SparkSession, sf: str) -> DataFrame:
    """Reads from files with broken records, which take no part."""
    pairs = synth.pairs(spark, sf)
    sides = [read_fastq(spark, _written(spark, _damaged(pairs, read)), mode="PERMISSIVE") for read in (1, 2)]
    return map_barcodes(synth.mask(spark, sf), *sides, adapters=synth.ADAPTERS).tagged


def mapped_from_read2(spark: SparkSession, sf: str) -> DataFrame:
    """Barcode and UMI in read 2, which is then also the read searched for adapters."""
    reads1, reads2 = synth.mates(spark, sf)
    mask = synth.mask(spark, sf)
    return map_barcodes(mask, reads2, reads1, adapters=synth.ADAPTERS, barcode_read=2, umi_read=2).tagged


def pair_flags(spark: SparkSession, sf: str) -> DataFrame:
    return _mapping(spark, sf).pairs.select("name", "barcode", "umi", "adapter", "umi_bad", "read_bases")


def counters(spark: SparkSession, sf: str) -> DataFrame:
    return _mapping(spark, sf).counters


def counters_repeated_names(spark: SparkSession, sf: str) -> DataFrame:
    reads1, reads2 = _uneven_mates(spark, sf)
    return run_counters(reads1, reads2, synth.mask(spark, sf), ReadLayout(), synth.ADAPTERS)


def report(spark: SparkSession, sf: str) -> DataFrame:
    return stats_report(_mapping(spark, sf).counters)


# Pairs and read columns


def _uneven_mates(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """All mates, of which some are alone with their name and some come twice."""
    pairs, number = synth.pairs(spark, sf), F.col("event_id")

    def uneven(read: int, alone: int, twice: int) -> DataFrame:
        name = F.when(number % alone == 0, F.concat("name", F.lit(f"-{read}"))).otherwise(F.col("name"))
        copies = F.explode(F.sequence(F.lit(1), F.when(number % twice == 0, 2).otherwise(1)))
        return synth.mate(pairs.withColumn("name", name).withColumn("copy", copies), read)

    return uneven(1, 13, 19), uneven(2, 11, 29)


def read_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return pair_reads(*_uneven_mates(spark, sf))


def _mate_files(spark: SparkSession, mates: tuple[DataFrame, DataFrame]) -> list[str]:
    return [_written(spark, fastq_lines(synth.suffixed(mate))) for mate in mates]


def read_pairs_in_step(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of files of one order that lack records and repeat names."""
    return pair_files(spark, *_mate_files(spark, _uneven_mates(spark, sf)))


def _one_pass(spark: SparkSession, sf: str, mates: tuple[DataFrame, DataFrame], out: str) -> dict[str, int]:
    paths = _mate_files(spark, mates)
    return place_files(spark, *paths, synth.mask(spark, sf), out, adapters=synth.ADAPTERS)


def one_pass_counters(spark: SparkSession, sf: str) -> DataFrame:
    """Counters that the writer of the placed reads has added up."""
    counters = _one_pass(spark, sf, _uneven_mates(spark, sf), shared_folder(spark))
    row = counters | {"mask_rows": synth.mask(spark, sf).count()}
    return spark.createDataFrame([row], schemas.COUNTERS)


def one_pass_reads(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_folder(spark) + ".gz"
    _one_pass(spark, sf, synth.mates(spark, sf), path)
    return read_fastq(spark, path).select("name", "sequence", "quality")


def windows(spark: SparkSession, sf: str) -> DataFrame:
    """Windows of two layouts: the usual one, and one with all windows inside read 2."""
    usual, other = ReadLayout(offset="window"), ReadLayout(3, 20, 2, 30, 8, 2, offset="window")
    first, second = read_windows("seq1", "qual1", usual, 1), read_windows("seq2", "qual2", other, 2)
    return synth.pairs(spark, sf).select(
        "name",
        barcode_decode(first["barcode"], usual.barcode_len).alias("barcode_bases"),
        first["umi"].alias("umi"),
        first["umi_qual"].alias("umi_qual"),
        barcode_decode(second["barcode"], other.barcode_len).alias("barcode_bases2"),
        second["umi"].alias("umi2"),
        second["umi_qual"].alias("umi_qual2"),
    )


def encoded(spark: SparkSession, sf: str) -> DataFrame:
    return synth.pairs(spark, sf).select(
        "name",
        barcode_encode("seq1").alias("barcode"),
        barcode_encode("seq2", 20, 25).alias("barcode_at_20"),
        barcode_encode("seq2", 20, 25, offset="window").alias("window_at_20"),
    )


def decoded(spark: SparkSession, sf: str) -> DataFrame:
    return synth.mask(spark, sf).select("x", "y", barcode_decode("barcode").alias("bases"))


def read_names(spark: SparkSession, sf: str) -> DataFrame:
    number = F.col("event_id")
    raw = F.concat(
        F.lit("E"),
        number.cast("string"),
        F.when(number % 4 == 0, "/1").when(number % 4 == 1, "/12").when(number % 4 == 2, "/2 x").otherwise(""),
    )
    names = spark.read.parquet(f"{sf}/events.parquet").select(raw.alias("raw"))
    return names.select("raw", normalised_name("raw").alias("name"), read_number("raw").alias("read_no"))


# Filters and quality


def adapter_filter(spark: SparkSession, sf: str) -> DataFrame:
    flagged = flag_adapters(synth.mates(spark, sf)[1], synth.ADAPTERS)
    return flagged.filter("NOT adapter").select("name", "sequence")


def adapter_filter_many(spark: SparkSession, sf: str) -> DataFrame:
    flagged = flag_adapters(synth.mates(spark, sf)[1], synth.many_adapters(spark, sf))
    return flagged.select("name", "adapter")


def umi_filter(spark: SparkSession, sf: str) -> DataFrame:
    umis = windows(spark, sf)
    return umis.select("name", "umi", umi_bad("umi", "umi_qual").alias("umi_bad"))


def q30_per_read(spark: SparkSession, sf: str) -> DataFrame:
    return synth.pairs(spark, sf).select("name", q30_bases("qual2").alias("q30"))


def quality_verify(spark: SparkSession, sf: str) -> DataFrame:
    odd = F.when(F.col("event_id") % 7 == 0, F.replace("qual2", F.lit("I"), F.lit("~"))).otherwise(F.col("qual2"))
    return synth.pairs(spark, sf).select("name", odd.alias("quality")).select(
        "name",
        first_bad_quality("quality").alias("bad_sanger"),
        first_bad_quality("quality", "illumina").alias("bad_illumina"),
    )


def quality_to_illumina(spark: SparkSession, sf: str) -> DataFrame:
    return convert_quality(synth.mates(spark, sf)[1], "sanger", "illumina").select("name", "quality")


def quality_from_illumina(spark: SparkSession, sf: str) -> DataFrame:
    return convert_quality(quality_to_illumina(spark, sf), "illumina", "sanger")


# Files


def _written(spark: SparkSession, lines: DataFrame, **options) -> str:
    path = shared_folder(spark)
    lines.write.options(**options).text(path)
    return path


def mask_bin_scan(spark: SparkSession, sf: str) -> DataFrame:
    register_sources(spark)
    path = shared_folder(spark) + ".bin"
    synth.mask(spark, sf).write.format("mask_bin").mode("append").save(path)
    return read_mask(spark, path)


def mask_txt_scan(spark: SparkSession, sf: str) -> DataFrame:
    lines = synth.mask(spark, sf).select(F.concat_ws("\t", *(F.col(c).cast("string") for c in ("barcode", "x", "y"))))
    path = _written(spark, lines)
    return read_mask(spark, path, "txt")


def adapter_scan(spark: SparkSession, sf: str) -> DataFrame:
    table = spark.read.parquet(f"{sf}/supplier.parquet")
    record = F.concat(
        F.lit("> supplier "), F.col("s_suppkey").cast("string"), F.lit("\n "), synth.bases("a", "s_nationkey", 12)
    )
    return read_adapters(spark, _written(spark, table.select(record)))


def fastq_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = _written(spark, fastq_lines(synth.suffixed(synth.mates(spark, sf)[0])))
    return read_fastq(spark, path)


def fastq_gzip_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = _written(spark, fastq_lines(synth.suffixed(synth.mates(spark, sf)[1])), compression="gzip")
    return read_fastq(spark, path)


def _block_gzip(spark: SparkSession, sf: str) -> str:
    register_sources(spark)
    path = shared_folder(spark)
    lines = fastq_lines(synth.suffixed(synth.mates(spark, sf)[1]))
    lines.write.format("gzip_blocks").mode("append").save(path)
    return path


def fastq_block_gzip_scan(spark: SparkSession, sf: str) -> DataFrame:
    return read_fastq(spark, _block_gzip(spark, sf))


def fastq_block_gzip_scan_unindexed(spark: SparkSession, sf: str) -> DataFrame:
    """Blocks found in files whose index is not there: the copies have none."""
    path = _block_gzip(spark, sf)
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    copies = shared_folder(spark)
    found.foreachPartition(lambda rows: _copied(rows, copies))
    return read_fastq(spark, copies, blockSplitBytes=10_000)


def _copied(rows, folder: str) -> None:
    filesystem, path = files.open_path(folder)
    filesystem.create_dir(path, recursive=True)
    for row in rows:
        with filesystem.open_output_stream(f"{path}/{zlib.crc32(row.content):08x}.gz", compression=None) as out:
            out.write(row.content)


def gzip_block_index(spark: SparkSession, sf: str) -> DataFrame:
    """Whether the blocks of each file follow each other, and whether they cover it."""
    path = _block_gzip(spark, sf)
    before = F.lag(F.col("start") + F.col("length"), 1, 0).over(Window.partitionBy("file").orderBy("block_no"))
    blocks = read_block_index(spark, path).withColumn("follows", F.col("start") == before)
    name = F.element_at(F.split("file", "/"), -1).alias("name")
    ends = blocks.groupBy(name).agg(F.max(F.col("start") + F.col("length")).alias("end"), F.bool_and("follows").alias("follows"))
    sizes = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    sizes = sizes.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size"))
    both = ends.join(sizes, "name", "full")
    covered = F.coalesce(F.col("end") == F.col("size"), F.lit(False))
    return both.agg(F.bool_and("follows").alias("contiguous"), F.bool_and(covered).alias("covered"))


def gzip_block_payload(spark: SparkSession, sf: str) -> DataFrame:
    """What the blocks hold, from their raw bytes: each ends with the size of its text."""
    blocks = read_gzip_blocks(spark, _block_gzip(spark, sf), blocksPerRow=1)
    size = F.hex(F.substring("payload", -4, 4))  # little endian
    size = F.concat(*[F.substring(size, k, 2) for k in (7, 5, 3, 1)])
    return blocks.agg(
        F.sum(F.conv(size, 16, 10).cast("bigint")).alias("text_bytes"),
        F.bool_and(F.length("payload") == F.col("length")).alias("whole"),
        F.bool_and(F.hex(F.substring("payload", 13, 2)) == F.hex(F.lit("IG"))).alias("marked"),
    )


def _damaged(pairs: DataFrame, read: int) -> DataFrame:
    """Records of which some lack the separator and some have an impossible quality."""
    number = F.col("event_id") + read
    separator = F.when(number % 50 == 9, "x").otherwise("+")
    last = F.length(f"qual{read}") - 1
    bad = F.concat(F.left(f"qual{read}", last), F.lit("~"))
    quality = F.when(number % 50 == 25, bad).otherwise(F.col(f"qual{read}"))
    return pairs.select(F.concat(F.lit("@"), "name", F.lit("\n"), f"seq{read}", F.lit("\n"), separator, F.lit("\n"), quality))


def fastq_validate(spark: SparkSession, sf: str) -> DataFrame:
    """Broken records by reason, with their text, also those that a file breaks off in."""
    pairs = synth.pairs(spark, sf)
    path = _written(spark, _damaged(pairs, 2))
    cut = F.concat(F.lit("@"), "name", F.lit("\n"), F.left("seq2", F.lit(9)))
    cut = pairs.filter("event_id % 1000 = 31").select("event_id", cut)  # a file each
    cut.write.partitionBy("event_id").text(f"{path}/cut")
    reads = read_fastq(spark, path, mode="PERMISSIVE")
    reason = F.coalesce("_corrupt_reason", F.lit("none")).alias("reason")
    return reads.groupBy(reason).agg(F.count("*").alias("records"), F.sum(F.length("_corrupt_record")).alias("characters"))


def fastq_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_folder(spark)
    write_tagged_fastq(mapped(spark, sf), path)
    return read_fastq(spark, path).select("name", "sequence", "quality")


def tagged_fastq(spark: SparkSession, sf: str) -> DataFrame:
    return fastq_lines(mapped(spark, sf))


def tagged_fastq_gzip(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_folder(spark) + ".gz"
    write_tagged_fastq(mapped(spark, sf), path, quality="illumina")
    return read_fastq(spark, path, qualityEncoding="illumina").select("name", "sequence", "quality")


def output_partitions(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_folder(spark)
    write_tagged_fastq(mapped(spark, sf), path, partitions=FILES, rebalance=True)
    merged = shared_folder(spark)
    write_tagged_fastq(mapped(spark, sf).repartition(FILES), merged, partitions=FILES // 4)

    def counts(path: str, files: str, reads: str) -> DataFrame:
        lines = spark.read.text(path).select(F.input_file_name().alias("file"))
        return lines.agg(F.count_distinct("file").alias(files), (F.count("*") / 4).cast("bigint").alias(reads))

    both = counts(path, "files", "reads").withColumn("one", F.lit(1))
    return both.join(counts(merged, "merged_files", "merged_reads").withColumn("one", F.lit(1)), "one").drop("one")


def qseq(spark: SparkSession, sf: str) -> DataFrame:
    reads1, _ = synth.mates(spark, sf)
    unnumbered = F.when(F.length("name") % 2 == 0, F.col("read_no"))
    return qseq_lines(reads1.withColumn("read_no", unnumbered))


# Barcodes


def _captured(spark: SparkSession, sf: str) -> DataFrame:
    return barcodes.captured_counts(mate1(synth.mates(spark, sf)[0], ReadLayout()))


def captured_barcodes(spark: SparkSession, sf: str) -> DataFrame:
    return barcodes.captured_barcodes(_captured(spark, sf), synth.mask(spark, sf))


def mapped_barcodes(spark: SparkSession, sf: str) -> DataFrame:
    return barcodes.mapped_barcodes(_captured(spark, sf), synth.mask(spark, sf))


def unmapped_barcodes(spark: SparkSession, sf: str) -> DataFrame:
    return barcodes.unmapped_barcodes(_captured(spark, sf), synth.mask(spark, sf))


def unique_mask(spark: SparkSession, sf: str) -> DataFrame:
    return barcodes.unique_mask(synth.mask(spark, sf))


def unique_barcode_count(spark: SparkSession, sf: str) -> DataFrame:
    return barcodes.unique_barcode_count(synth.mask(spark, sf))


def _altered(spark: SparkSession, sf: str, bits_per_step: int) -> DataFrame:
    """Captured barcodes, every third of them altered by one XOR mask."""
    step = F.call_function(
        "shiftleft", 1 + F.col("event_id") % 3, (bits_per_step * (F.col("event_id") % 25)).cast("int")
    )
    key = barcode_encode("seq1")
    altered = F.when(F.col("event_id") % 3 == 0, key.bitwiseXOR(step)).otherwise(key)
    return barcodes.captured_counts(synth.pairs(spark, sf).select(altered.alias("barcode")))


def one_mismatch(spark: SparkSession, sf: str) -> DataFrame:
    return barcodes.one_mismatch_map(_altered(spark, sf, 2), synth.mask(spark, sf))


def one_mismatch_reference_masks(spark: SparkSession, sf: str) -> DataFrame:
    return barcodes.one_mismatch_map(_altered(spark, sf, 1), synth.mask(spark, sf), masks="reference")


def distinct_reads(spark: SparkSession, sf: str) -> DataFrame:
    return order.distinct_reads(_uneven_mates(spark, sf)[0])


# Order and layout


def mask_position_order(spark: SparkSession, sf: str) -> DataFrame:
    return order.position_ranks(synth.mask(spark, sf))


def captured_barcode_order(spark: SparkSession, sf: str) -> DataFrame:
    ranks = order.ranked(_captured(spark, sf), F.col("barcode"))
    return ranks.select(F.col("key").alias("barcode"), "rank")


def stripe_counts(spark: SparkSession, sf: str) -> DataFrame:
    stripes = order.with_stripe(synth.mask(spark, sf), STRIPES)
    return stripes.groupBy("stripe").agg(F.count("*").alias("positions"))


def striped_fastq(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_folder(spark)
    write_striped(mapped(spark, sf), path, STRIPES, axis="y")
    lines = spark.read.text(path).groupBy(F.col("stripe").cast("int").alias("stripe"))
    return lines.agg((F.count("*") / 4).cast("bigint").alias("reads"))


def striped_fastq_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_folder(spark)
    write_striped(mapped(spark, sf), path, STRIPES)
    return read_fastq(spark, path).select("name", "sequence", "quality")


def barcode_bucket_counts(spark: SparkSession, sf: str) -> DataFrame:
    buckets = order.with_barcode_bucket(synth.mask(spark, sf), BUCKETS)
    return buckets.groupBy("bucket").agg(F.count("*").alias("rows"))


QUERIES = {
    "map_barcodes": mapped,
    "map_barcodes_stored_mask": mapped_stored_mask,
    "map_barcodes_unique_mask": mapped_unique,
    "map_barcodes_one_mismatch": mapped_with_mismatch,
    "map_barcodes_unique_one_mismatch": mapped_unique_with_mismatch,
    "map_barcodes_damaged": mapped_damaged,
    "map_barcodes_from_read2": mapped_from_read2,
    "pair_flags": pair_flags,
    "run_counters": counters,
    "run_counters_repeated_names": counters_repeated_names,
    "stats_report": report,
    "read_pairs": read_pairs,
    "read_pairs_in_step": read_pairs_in_step,
    "one_pass_counters": one_pass_counters,
    "one_pass_reads": one_pass_reads,
    "barcode_umi_windows": windows,
    "barcode_encode": encoded,
    "barcode_decode": decoded,
    "read_names": read_names,
    "adapter_filter": adapter_filter,
    "adapter_filter_many": adapter_filter_many,
    "umi_filter": umi_filter,
    "q30_per_read": q30_per_read,
    "quality_verify": quality_verify,
    "quality_to_illumina": quality_to_illumina,
    "quality_from_illumina": quality_from_illumina,
    "mask_bin_scan": mask_bin_scan,
    "mask_txt_scan": mask_txt_scan,
    "adapter_scan": adapter_scan,
    "fastq_scan": fastq_scan,
    "fastq_gzip_scan": fastq_gzip_scan,
    "fastq_block_gzip_scan": fastq_block_gzip_scan,
    "fastq_block_gzip_scan_unindexed": fastq_block_gzip_scan_unindexed,
    "gzip_block_index": gzip_block_index,
    "gzip_block_payload": gzip_block_payload,
    "fastq_validate": fastq_validate,
    "fastq_round_trip": fastq_round_trip,
    "tagged_fastq": tagged_fastq,
    "tagged_fastq_gzip": tagged_fastq_gzip,
    "output_partitions": output_partitions,
    "qseq_lines": qseq,
    "captured_barcodes": captured_barcodes,
    "mapped_barcodes": mapped_barcodes,
    "unmapped_barcodes": unmapped_barcodes,
    "unique_mask": unique_mask,
    "unique_barcode_count": unique_barcode_count,
    "one_mismatch_map": one_mismatch,
    "one_mismatch_ref_masks": one_mismatch_reference_masks,
    "distinct_reads": distinct_reads,
    "mask_position_order": mask_position_order,
    "captured_barcode_order": captured_barcode_order,
    "stripe_counts": stripe_counts,
    "striped_fastq": striped_fastq,
    "striped_fastq_round_trip": striped_fastq_round_trip,
    "barcode_bucket_counts": barcode_bucket_counts,
}
