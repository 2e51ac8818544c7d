"""Placing and counting in one pass over the files.

Pairs are read in step, flagged, joined with the mask and handed to a writer that counts them. Each FASTQ file is read
once; only where names turn out to be repeated, or records out of order, a second step adds the pairs that the first could not see.
"""

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readmap import schemas
from readmap.functions import has_adapter, q30_bases
from readmap.operators.in_step import keys_again, name_key, pairs_across, read_fastq_pairs
from readmap.operators.layout import ReadLayout
from readmap.operators.pairing import adapter_list, enforce_length, too_short, windows
from readmap.scratch import shared_folder
from readmap.sinks.counted import COUNTERS, SUMS, CountedFastqDataSource
from readmap.sinks.fastq import record_text
from readmap.sources import files
from readmap.sources.parts import Staging

LONE = ["name", "has1", "seq1", "qual1", "has2", "seq2", "qual2", "row"]


def place_files(
    spark: SparkSession,
    path1: str,
    path2: str,
    lookup: DataFrame,
    out: str,
    *,
    adapters=None,
    layout: ReadLayout = ReadLayout(),
    partitions: int = 0,
    rebalance: bool = False,
    quality: str = "sanger",
    **options,
) -> dict[str, int]:
    """Write the placed reads of two paths as tagged FASTQ to ``out``, which must not exist; returns the run's counters.

    ``lookup`` has the positions by barcode. ``options`` are those of ``fastq_pairs``, the others as in
    ``write_tagged_fastq``. The output appears as a whole, when everything is written; a run that fails leaves none.
    """
    spark.dataSource.register(CountedFastqDataSource)
    adapters, table = adapter_list(adapters), _with_homes(lookup)
    staging = Staging(files.qualified(spark, out))

    def written(rows: DataFrame) -> str:
        placed = _counted(rows, table, adapters, layout, quality)
        if partitions > 0:
            placed = placed.repartition(partitions) if rebalance else placed.coalesce(partitions)
        side = shared_folder(spark)
        compression = "gzip" if out.endswith(".gz") else "none"
        placed.write.format("counted_fastq").options(side=side, compression=compression).mode("append").save(staging.folder)
        return side

    try:
        rows = read_fastq_pairs(spark, path1, path2, **options)
        sides = [written(rows)]
        keys = spark.read.schema("key long, lone boolean").parquet(f"{sides[0]}/keys") if _has(sides[0], "keys") else None
        if keys is not None and not (again := keys_again(keys.select("key"))).isEmpty():
            # Lone records are at hand; those of pairs have to be read again.
            if keys.filter("NOT lone").join(again, "key", "left_semi").isEmpty():
                rows = spark.read.schema(schemas.READ_PAIR).parquet(f"{sides[0]}/lone")
            across = pairs_across(rows, again).withColumns({"has1": F.lit(True), "has2": F.lit(True)})
            sides.append(written(across.withColumn("row", F.lit(None).cast("long"))))
        _flattened(staging)
    except BaseException:
        staging.discard()
        raise
    sums = [json.loads(files.read_small(f"{side}/{SUMS}")) for side in sides]
    return {name: sum(s[name] for s in sums) for name in COUNTERS}


def _has(folder: str, name: str) -> bool:
    filesystem, path = files.open_path(folder)
    return filesystem.get_file_info(f"{path}/{name}").type.name == "Directory"


def _flattened(staging: Staging) -> None:
    """Publish the staging folder, with the files of later jobs beside those of the first."""
    filesystem, folder = files.open_path(staging.folder)
    names = []
    for file in files.list_files(staging.folder) if _any_file(filesystem, folder) else []:
        _, path = files.open_path(file.uri)
        names.append(path.rpartition("/")[2])
        if path != f"{folder}/{names[-1]}":
            filesystem.move(path, f"{folder}/{names[-1]}")
    staging.publish(names)


def _any_file(filesystem, folder: str) -> bool:
    from pyarrow import fs as pafs

    infos = filesystem.get_file_info(pafs.FileSelector(folder, recursive=True, allow_not_found=True))
    return any(info.type == pafs.FileType.File for info in infos)


def _with_homes(lookup: DataFrame) -> DataFrame:
    """Positions by barcode, of which one row for each barcode has ``first``, so that a left join counts each pair once.

    A stored mask has that column. Otherwise it is a row of its own, without position.
    """
    if "first" in lookup.columns:
        return lookup.withColumn("_at", F.lit(True))
    homes = lookup.select("barcode").distinct()
    homes = homes.selectExpr("barcode", "true AS first", "false AS _at", "cast(NULL AS int) AS x", "cast(NULL AS int) AS y")
    return lookup.select("barcode", F.lit(False).alias("first"), F.lit(True).alias("_at"), "x", "y").unionByName(homes)


def _counted(rows: DataFrame, table: DataFrame, adapters: list[str], layout: ReadLayout, quality: str) -> DataFrame:
    """Rows for the counting writer, from rows of the ``fastq_pairs`` source."""
    both = F.col("has1") & F.col("has2")
    held = windows("seq1", "qual1", layout, 1) | windows("seq2", "qual2", layout, 2)
    flagged = rows.select(
        *LONE,
        both.alias("both"),
        F.coalesce(both & has_adapter("seq2", adapters), F.lit(False)).alias("adapter"),
        *[(both & too_short(layout, k, f"seq{k}", f"qual{k}")).alias(f"short{k}") for k in (1, 2)],
        *[column.alias(f"_{name}") for name, column in held.items()],
        q30_bases("qual2").alias("_read_q30"),
        F.length("seq2").alias("_read_bases"),
    )
    flagged = enforce_length(flagged, layout)
    clean = F.col("both") & ~F.col("adapter") & ~F.col("short1") & ~F.col("short2")
    flagged = flagged.withColumn("_clean", clean).withColumn("_usable", F.col("_clean") & ~F.coalesce("_umi_bad", F.lit(False)))

    def among(condition, column=1):
        return F.when(condition, F.col(column) if isinstance(column, str) else F.lit(column)).cast("long")

    usable, lone = F.col("_usable"), ~F.col("both")
    counts = {
        "total": among(F.col("both")),
        "adapter": among(F.col("adapter")),
        "short_reads": among(F.col("both") & ~F.col("adapter") & ~F.col("_clean")),
        "umi_bad": among(F.col("_clean") & F.col("_umi_bad")),
        "bq": among(F.col("_clean"), "_barcode_q30"),
        "uq": among(F.col("_clean"), "_umi_q30"),
        "rq": among(F.col("_clean"), "_read_q30"),
        "rb": among(F.col("_clean"), "_read_bases"),
    }
    # Only what may be placed takes its sequence along; the others are spread by name, not gathered under one barcode.
    reduced = flagged.select(
        "name",
        F.when(usable, F.col("_barcode")).otherwise(name_key()).alias("_barcode"),
        "_usable",
        *[F.when(usable, F.col(old)).alias(new) for old, new in (("seq2", "sequence"), ("qual2", "quality"), ("_umi", "umi"), ("_umi_qual", "umi_qual"))],
        F.when(lone, F.struct(*LONE)).alias("lone"),
        F.when(F.col("row").isNotNull(), name_key()).alias("key"),
        *[column.alias(f"_n_{name}") for name, column in counts.items()],
    )
    joined = reduced.join(table, (F.col("_barcode") == F.col("barcode")) & F.col("_usable"), "left")
    placed, head = F.coalesce("_at", F.lit(False)), F.coalesce("first", F.lit(True))
    return joined.select(
        F.when(placed, record_text(["x", "y", "umi", "umi_qual"], quality)).alias("value"),
        F.when(head, F.col("key")).alias("key"),
        F.when(head, F.col("lone")).alias("lone"),
        *[(placed.cast("long") if n == "mapped" else F.when(head, F.col(f"_n_{n}"))).alias(n) for n in COUNTERS],
    )
