import struct

import pytest

from readmap import read_adapters, read_mask, register_sources

POSITIONS = [(0, 0, 0), (-5, 3, -4), (1 << 62, -(1 << 31), (1 << 31) - 1), (7, 1, 2), (7, 1, 2)]


def test_binary(spark, tmp_path):
    path = str(tmp_path / "m.bin")
    with open(path, "wb") as out:
        out.write(b"".join(struct.pack("<qii", *p) for p in POSITIONS * 100))
    df = read_mask(spark, path)
    assert sorted(map(tuple, df.collect())) == sorted(POSITIONS * 100)
    small = spark.read.format("mask_bin").option("maxSplitBytes", 100).load(path)  # 6 records per task
    assert small.rdd.getNumPartitions() == 84
    assert sorted(map(tuple, small.collect())) == sorted(POSITIONS * 100)


def test_binary_of_odd_size(spark, tmp_path):
    (tmp_path / "m.bin").write_bytes(b"x" * 17)
    with pytest.raises(Exception, match="not a multiple"):
        read_mask(spark, str(tmp_path / "m.bin")).collect()


def test_binary_round_trip(spark, tmp_path):
    register_sources(spark)
    df = spark.createDataFrame(POSITIONS, "barcode bigint, x int, y int")
    df.write.format("mask_bin").mode("append").save(str(tmp_path / "m.bin"))
    assert sorted(map(tuple, read_mask(spark, str(tmp_path / "m.bin")).collect())) == sorted(POSITIONS)


def test_text(spark, tmp_path):
    (tmp_path / "m.txt").write_text("  0\t0\t0\textra\n-5\t3\t-4 \n7\t1\t2\r\n")
    assert sorted(map(tuple, read_mask(spark, str(tmp_path / "m.txt")).collect())) == [(-5, 3, -4), (0, 0, 0), (7, 1, 2)]


@pytest.mark.parametrize("line", ["", "1\t2", "a\t1\t2", "1\t2\t3000000000", "1 2 3", "1.5\t2\t3"])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_malformed_text(spark, tmp_path, settings, line, ansi):
    settings(spark__sql__ansi__enabled=ansi)
    (tmp_path / "m.txt").write_text(f"1\t2\t3\n{line}\n")
    with pytest.raises(Exception, match="malformed mask line"):
        read_mask(spark, str(tmp_path / "m.txt")).collect()


def test_unknown_suffix(spark):
    with pytest.raises(ValueError):
        read_mask(spark, "/tmp/mask.csv")


def test_adapters(spark, tmp_path):
    path = tmp_path / "a.fa"
    path.write_text(">one\nACGT\n  GGTT\t\n>two\nACGT\n\n   \nTT>A\n")
    assert sorted(r[0] for r in read_adapters(spark, str(path)).collect()) == ["ACGT", "GGTT", "TT>A"]
    with pytest.raises(Exception):
        read_adapters(spark, str(tmp_path / "none.fa")).collect()
