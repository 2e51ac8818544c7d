import gzip
import os
import struct

import pytest
from pyspark.sql import functions as F

import plain
from readmap import job, read_fastq
from readmap.operators.order import (
    distinct_reads,
    order_barcodes,
    order_positions,
    position_ranks,
    ranked,
    with_barcode_bucket,
    with_stripe,
)
from readmap.sinks import fastq_lines, qseq_lines, write_striped, write_tagged_fastq

TAGGED = "name string, sequence string, quality string, umi string, umi_qual string, x int, y int"


def tagged(spark, n=100):
    return spark.createDataFrame([(f"r{i}", "ACGT", "I+!_", "AC", "I?", i % 7, -i) for i in range(n)], TAGGED)


def content(path, opener=open):
    parts = sorted(f for f in os.listdir(path) if f.startswith("part-"))
    return parts, "".join(opener(f"{path}/{f}", "rt").read() for f in parts)


def test_record_text(spark):
    rows = [("r", "AC", "I!", "GG", "??", 3, -4), (None, "AC", "I!", None, "??", None, 1)]
    values = [r.value for r in fastq_lines(spark.createDataFrame(rows, TAGGED)).collect()]
    assert values == ["@r|||CB:Z:3_-4|||UR:Z:GG|||UY:Z:??\nAC\n+\nI!", "@|||UY:Z:??\nAC\n+\nI!"]
    plain_read = spark.createDataFrame(rows, TAGGED).select("name", "sequence", "quality").limit(1)
    assert fastq_lines(plain_read).first().value == "@r\nAC\n+\nI!"
    illumina = fastq_lines(plain_read, "illumina").first().value
    assert illumina == "@r\nAC\n+\nh@"
    with pytest.raises(ValueError):
        fastq_lines(plain_read, "solexa")


def test_files(spark, tmp_path):
    df = tagged(spark).repartition(5)
    write_tagged_fastq(df, str(tmp_path / "plain"))
    assert len(content(tmp_path / "plain")[0]) == 5
    write_tagged_fastq(df, str(tmp_path / "fewer"), partitions=2)
    write_tagged_fastq(df, str(tmp_path / "not_more"), partitions=9)
    write_tagged_fastq(df, str(tmp_path / "more"), partitions=9, rebalance=True)
    write_tagged_fastq(df, str(tmp_path / "out.gz"))
    assert [len(content(tmp_path / p)[0]) for p in ("fewer", "not_more", "more")] == [2, 5, 9]
    names, text = content(tmp_path / "out.gz", gzip.open)
    assert all(n.endswith(".gz") for n in names)
    assert sorted(text.splitlines()) == sorted(content(tmp_path / "plain")[1].splitlines())
    back = read_fastq(spark, str(tmp_path / "out.gz"))
    assert back.count() == 100 and back.filter("name LIKE 'r99|||CB:Z:1_-99|||UR:Z:AC|||UY:Z:I?'").count() == 1
    with pytest.raises(Exception, match="already exists"):
        write_tagged_fastq(df, str(tmp_path / "plain"))


def test_striped_files(spark, tmp_path):
    write_striped(tagged(spark), str(tmp_path / "out"), 3, axis="y")
    lines = spark.read.text(str(tmp_path / "out")).filter("value LIKE '@%'")
    y = F.regexp_extract("value", "CB:Z:[0-9]+_(-?[0-9]+)", 1).cast("int")
    assert lines.count() == 100 and lines.filter(F.pmod(y, F.lit(3)) != F.col("stripe")).count() == 0


def test_qseq(spark):
    df = spark.createDataFrame([(1, "AC", "II"), (None, "", "")], "read_no int, sequence string, quality string")
    assert [r.line for r in qseq_lines(df).collect()] == ["1\tAC\tII", "null\t\t"]


def test_order(spark):
    rows = [(i * 7919 % 1000, i * 31 % 17 - 8, i * 13 % 11 - 5) for i in range(1000)]
    df = spark.createDataFrame(rows, "barcode bigint, x int, y int")
    assert [(r.y, r.x) for r in order_positions(df).collect()] == sorted((y, x) for _, x, y in rows)
    assert [r.barcode for r in order_barcodes(df).collect()] == sorted(r[0] for r in rows)
    keys = sorted((y, x) for _, x, y in rows)
    for row in position_ranks(df).collect():
        assert (row.n, row["rank"]) == (keys.count((row.y, row.x)), keys.index((row.y, row.x)) + 1)


def test_order_at_the_ends_of_int(spark):
    low, high = -(1 << 31), (1 << 31) - 1
    rows = [(x, y) for x in (low, -1, 0, high) for y in (low, -1, 0, high)]
    ranks = position_ranks(spark.createDataFrame(rows, "x int, y int")).collect()
    assert [(r.y, r.x) for r in sorted(ranks, key=lambda r: r["rank"])] == sorted((y, x) for x, y in rows)


@pytest.mark.parametrize("ranges", [2, 7, 64])
def test_ranks_with_hot_key(spark, ranges):
    rows = [(5,)] * 1000 + [(i * 7919 % 2003,) for i in range(2000)]
    got = ranked(spark.createDataFrame(rows, "k bigint"), F.col("k"), ranges).collect()
    keys = sorted(r[0] for r in rows)
    assert {(r.key, r.n, r["rank"]) for r in got} == {(k, keys.count(k), keys.index(k) + 1) for k in set(keys)}


def test_layout_columns(spark):
    df = spark.createDataFrame([(-7, -1, 9), (7, 10, -9)], "barcode bigint, x int, y int")
    assert [r.stripe for r in with_stripe(df, 4).collect()] == [3, 2]
    assert [r.stripe for r in with_stripe(df, 4, "y").collect()] == [1, 3]
    assert [r.bucket for r in with_barcode_bucket(df, 4).collect()] == [1, 3]
    with pytest.raises(ValueError):
        with_stripe(df, 4, "z")


def test_distinct_reads(spark):
    rows = [("a", 1, "A", "I"), ("b", 1, "A", "I"), ("c", None, "A", "I"), ("d", None, "A", "I"), ("e", 2, "A", "I")]
    df = spark.createDataFrame(rows, "name string, read_no int, sequence string, quality string")
    got = {(r.read_no, r.copies) for r in distinct_reads(df).collect()}
    assert got == {(1, 2), (None, 2), (2, 1)}


@pytest.mark.parametrize("mask_kind", ["bin", "txt"])
def test_job(spark, tmp_path, mask_kind):
    barcode = "ACGT" * 6 + "A"
    position = (plain.encode(barcode, 0, 25), 12, 34)
    if mask_kind == "bin":
        (tmp_path / "m.bin").write_bytes(struct.pack("<qii", *position))
    else:
        (tmp_path / "m.txt").write_text("\t".join(map(str, position)) + "\n")
    reads = [("a", barcode, "ACGTACGTAC", "TTT"), ("b", barcode, "AAAAAAAAAA", "TTT"), ("c", barcode, "ACGTACGTAC", "GGG")]
    reads.append(("d", "T" + barcode[1:], "ACGTACGTAC", "TTT"))
    for read in (1, 2):
        with open(tmp_path / f"{read}.fq", "w") as out:
            for name, barcode_bases, umi, rest in reads:
                bases = barcode_bases + umi if read == 1 else rest
                out.write(f"@{name}/{read}\n{bases}\n+\n{'I' * len(bases)}\n")
    (tmp_path / "a.fa").write_text(">adapter\nGG\n")
    common = ["-m", f"{tmp_path}/m.{mask_kind}", "-r1", f"{tmp_path}/1.fq", "-r2", f"{tmp_path}/2.fq"]
    args = job.arguments(
        [*common, "-o", f"{tmp_path}/out", "-stat", f"{tmp_path}/stat.txt", "-adapterFile", f"{tmp_path}/a.fa"]
        + ["-outPartition", "1"]
    )
    text = job.run(spark, args)
    assert (tmp_path / "stat.txt").read_text() == text
    assert text.splitlines()[:5] == [
        "getBarcodePositionMap_uniqBarcodeTypes:\t1",
        "total_reads:\t4",
        "adapter_filtered_reads:\t1\t25.00%",
        "umi_filtered_reads:\t1\t33.33%",
        "mapped_reads:\t1\t50.00%",
    ]
    record = "@{}|||CB:Z:12_34|||UR:Z:ACGTACGTAC|||UY:Z:IIIIIIIIII\nTTT\n+\nIII\n"
    assert content(tmp_path / "out")[1] == record.format("a")
    rescue = [*common, "-o", f"{tmp_path}/near", "--stat", f"{tmp_path}/near.txt", "--mismatches", "1"]
    job.run(spark, job.arguments(rescue))
    assert record.format("d") in content(tmp_path / "near")[1]


def test_job_does_not_start_where_its_output_exists(spark, tmp_path):
    (tmp_path / "out").mkdir()
    common = ["-m", "no.bin", "-r1", "no.fq", "-r2", "no.fq", "-o", f"{tmp_path}/out", "-stat", f"{tmp_path}/stat.txt"]
    with pytest.raises(FileExistsError):
        job.run(spark, job.arguments(common))
    assert not (tmp_path / "stat.txt").exists()


def test_job_needs_its_paths():
    with pytest.raises(SystemExit):
        job.arguments(["-m", "mask.bin"])
