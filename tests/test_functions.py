import random

import pytest

import plain
from readmap.functions import (
    barcode_decode,
    barcode_encode,
    convert_quality,
    first_bad_quality,
    has_adapter,
    neighbour_masks,
    normalised_name,
    q30_bases,
    read_number,
    umi_bad,
)


def column(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


@pytest.mark.parametrize(
    "start,length", [(0, 25), (5, 25), (20, 25), (32, 25), (40, 31), (64, 10), (0, 31), (0, 32), (3, 40), (31, 64)]
)
def test_encode(spark, start, length):
    rng = random.Random(start * 100 + length)
    reads = ["".join(rng.choices("ACGTNacgtn.~!", k=100)) for _ in range(200)]
    got = column(spark, reads, barcode_encode("v", start, length))
    assert got == [plain.encode(r, start, length) for r in reads]


def test_encode_window_offset(spark):
    reads = ["ACGTACGTACGT" * 4]
    assert column(spark, reads, barcode_encode("v", 7, 25, offset="window")) == [plain.encode(reads[0][7:], 0, 25)]


def test_encode_known_value(spark):
    assert column(spark, ["AAAAAAATGC"], barcode_encode("v", 0, 10)) == [491520]
    assert column(spark, ["AAAAAAATGC"], barcode_decode(barcode_encode("v", 0, 10), 10)) == ["AAAAAAATGC"]


def test_encode_n_is_g_and_case_is_ignored(spark):
    keys = column(spark, ["ACGTN", "acgtn", "ACGTG"], barcode_encode("v", 0, 5))
    assert len(set(keys)) == 1


def test_encode_rejects_bad_windows():
    for arguments in ({"start": -1}, {"length": 0}, {"offset": "file"}):
        with pytest.raises(ValueError):
            barcode_encode("v", **arguments)


@pytest.mark.parametrize("length", [1, 25, 32, 40])
def test_decode(spark, length):
    rng = random.Random(length)
    keys = [rng.randrange(-(1 << 63), 1 << 63) for _ in range(100)] + [0, -1, 1, -(1 << 63), (1 << 63) - 1]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    for key, bases in df.select("k", barcode_decode("k", length)).collect():
        assert bases == plain.decode(key, length)


def test_neighbour_masks():
    masks = neighbour_masks(25)
    assert len(set(masks)) == 75
    key = plain.encode("ACGTACGTACGTACGTACGTACGTA", 0, 25)
    for mask in masks:
        one, other = plain.decode(key, 25), plain.decode(key ^ mask, 25)
        assert sum(a != b for a, b in zip(one, other)) == 1
    assert neighbour_masks(25, start=7)[0] == 1 << 14
    assert min(neighbour_masks(2, start=31)) == -(1 << 63)
    reference = neighbour_masks(25, "reference")
    assert len(reference) == 51 and max(reference) == 3 << 24
    with pytest.raises(ValueError):
        neighbour_masks(25, "other")


def test_umi(spark):
    rng = random.Random(1)
    rows = [("", ""), ("aaaa", "IIII"), ("ACnT", "IIII"), ("ACGT", "I*II"), ("ACGT", "*I*I"), ("AAAC", "++++")]
    for _ in range(1000):
        umi = "".join(rng.choices("ACGTacgtN", [9, 5, 5, 5, 2, 2, 2, 2, 0.3], k=6))
        rows.append((umi, "".join(rng.choices("!*+,5?I~", [1, 1, 5, 5, 5, 5, 5, 1], k=6))))
    df = spark.createDataFrame(rows, "u string, q string")
    for umi, quality, bad in df.select("u", "q", umi_bad("u", "q")).collect():
        assert bad == plain.umi_bad(umi, quality), (umi, quality)


def test_names(spark):
    names = ["r/1", "r/12", "r/1 x", "/1", "r", "", "a/b/2", "1", "r/x"]
    assert column(spark, names, normalised_name("v")) == ["r", "r/12", "r/1 x", "", "r", "", "a/b", "1", "r/x"]
    assert column(spark, names, read_number("v")) == [1, None, None, 1, None, None, 2, None, None]


def test_quality(spark):
    values = ["I~II", " III", "III`", "!_", "", "@~", "?>"]
    assert column(spark, values, first_bad_quality("v")) == [1, 0, 3, -1, -1, 1, -1]
    assert column(spark, values, first_bad_quality("v", "illumina")) == [-1, 0, -1, 0, -1, -1, 0]
    assert column(spark, values, q30_bases("v")) == [plain.q30(v) for v in values]


def test_convert_quality(spark):
    every = "".join(chr(c) for c in range(33, 96))
    df = spark.createDataFrame([(every,), ("",)], "quality string")
    moved = convert_quality(df, "sanger", "illumina")
    assert moved.first()[0] == "".join(chr(ord(c) + 31) for c in every)
    assert convert_quality(moved, "illumina", "sanger").collect() == df.collect()
    with pytest.raises(ValueError):
        convert_quality(df, "sanger", "sanger")
    with pytest.raises(ValueError):
        convert_quality(df, "sanger", "solexa")
    with pytest.raises(Exception, match="out of range for illumina"):
        convert_quality(df, "illumina", "sanger").collect()


@pytest.mark.parametrize("count", [0, 1, 3, 100])
def test_has_adapter(spark, count):
    rng = random.Random(count)
    adapters = ["".join(rng.choices("ACGT", k=5)) for _ in range(count)] + [""]
    reads = ["".join(rng.choices("ACGT", k=60)) for _ in range(300)]
    want = [any(a in r for a in adapters if a) for r in reads]
    assert column(spark, reads, has_adapter("v", adapters)) == want
