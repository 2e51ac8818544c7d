import bz2
import gzip
import os
import random
import zlib

import pytest
import zstandard
from pyspark.sql import functions as F

from readmap import read_block_index, read_fastq, read_gzip_blocks, register_sources
from readmap.sources import fastq, files
from readmap.sources.block_gzip import find_groups, group_blocks, is_block_gzip, load_index, next_member, pack_member
from readmap.sources.fastq import FastqReader


def reader(path, **changes):
    options = dict(encoding="sanger", permissive=False, split_bytes=1 << 20, block_split_bytes=200)
    return FastqReader(path=str(path), **(options | changes))


def rows(path, **changes):
    source = reader(path, **changes)
    return [tuple(r.values()) for s in source.partitions() for b in source.read(s) for r in b.to_pylist()]


def records(n, seed=0):
    """Reads whose names and qualities are full of characters that look like record starts."""
    rng = random.Random(seed)
    made = []
    for i in range(n):
        length = rng.randrange(1, 12)
        quality = "".join(rng.choices("@+I!", k=length))
        made.append((f"@{i}+@", rng.choice([None, 1, 2]), "".join(rng.choices("ACGTN", k=length)), quality))
    return made


def text(made, newline="\n"):
    lines = []
    for name, number, sequence, quality in made:
        lines += [f"@{name}" + (f"/{number}" if number else ""), sequence, "+" + name, quality]
    return newline.join([*lines, ""]).encode()


@pytest.mark.parametrize("newline", ["\n", "\r\n", "\r"])
def test_every_split_size_gives_the_same_records(tmp_path, newline):
    made = records(25)
    (tmp_path / "r.fq").write_bytes(text(made, newline))
    for size in range(1, 200):
        assert rows(tmp_path / "r.fq", split_bytes=size) == made, size


def test_pieces_of_any_size_parse_the_same(tmp_path, monkeypatch):
    made = records(40)
    (tmp_path / "r.fq").write_bytes(text(made, "\r\n"))
    for size in range(1, 60):
        monkeypatch.setattr("readmap.sources.fastq.READ_BYTES", size)
        assert rows(tmp_path / "r.fq", split_bytes=300) == made, size


def test_names(tmp_path):
    (tmp_path / "r.fq").write_text("@r/1\nA\n+\nI\n@r/12\nA\n+\nI\n@r/1 x\nA\n+\nI\n@/1\nA\n+\nI\n@\nA\n+\nI\n")
    assert [r[:2] for r in rows(tmp_path / "r.fq")] == [("r", 1), ("r/12", None), ("r/1 x", None), ("", 1), ("", None)]


def test_last_newline_may_be_missing(tmp_path):
    made = records(3)
    (tmp_path / "r.fq").write_bytes(text(made)[:-1])
    assert rows(tmp_path / "r.fq") == made


def test_empty_sequence(tmp_path):
    (tmp_path / "r.fq").write_text("@a\n\n+\n\n@b\nA\n+\nI\n")
    assert rows(tmp_path / "r.fq") == [("a", None, "", ""), ("b", None, "A", "I")]


@pytest.mark.parametrize(
    "content,reason",
    [
        ("@a\nACGT\n+\nIIII\n\n", "truncated record"),
        ("@a\nACGT\n+\nIIII\n@b\nAC\n", "truncated record"),
        ("@a\nACGT\n+\n", "truncated record"),
        ("@a\nACGT\nx\nIIII\n@b\nAC\n+\nII\n", "missing separator"),
        ("@a\nACGT\n\nIIII\n", "missing separator"),
        ("@a\nACGT\n+\nI~II\n", "quality out of range"),
        ("@a\nACGT\n+\nI II\n", "quality out of range"),
    ],
)
def test_broken_records(tmp_path, content, reason):
    (tmp_path / "r.fq").write_text(content)
    with pytest.raises(ValueError, match=reason + ".*r.fq:"):
        rows(tmp_path / "r.fq")
    for size in (1, 7, 1000):
        got = rows(tmp_path / "r.fq", permissive=True, split_bytes=size)
        broken = [r for r in got if r[4]]
        assert [r[4] for r in broken] == [reason]
        assert all(r[2] is None for r in broken)
        whole = [r[0] for r in got if not r[4]]
        assert whole == [n for n in "ab" if f"@{n}\nAC\n+\nII\n" in content or f"@{n}\nACGT\n+\nIIII\n" in content]


def test_offsets_of_broken_records(tmp_path):
    good, bad = "@a\nACGT\n+\nIIII\n", "@b\nACGT\nx\nIIII\n"
    (tmp_path / "r.fq").write_text(good + bad + good + bad + good)
    for size in (1, 10, 17, 1000):
        got = sorted(rows(tmp_path / "r.fq", permissive=True, split_bytes=size), key=lambda r: r[6])
        assert [r[6] for r in got] == [0, 15, 30, 45, 60]
        assert [r[4] for r in got] == [None, "missing separator", None, "missing separator", None]


def test_many_broken_records_in_pieces_of_any_size(tmp_path, monkeypatch):
    rng = random.Random(5)
    kinds = [rng.random() < 0.3 for _ in range(300)]
    kinds = [bad and not before for bad, before in zip(kinds, [False, *kinds])]  # never two in a row
    lines = [f"@r{i}\nACGT\n{'x' if bad else '+'}\n@III\n" for i, bad in enumerate(kinds)]
    (tmp_path / "r.fq").write_text("".join(lines))
    starts = [sum(map(len, lines[:i])) for i in range(300)]
    want = [(f"r{i}", "missing separator" if bad else None, starts[i]) for i, bad in enumerate(kinds)]
    for size in (1, 2, 5, 16, 17, 100, 1 << 20):
        monkeypatch.setattr("readmap.sources.fastq.READ_BYTES", size)
        for split in (50, 333, 1 << 20):
            got = rows(tmp_path / "r.fq", permissive=True, split_bytes=split)
            assert sorted(((r[0], r[4], r[6]) for r in got), key=lambda r: r[2]) == want


def test_illumina_input(tmp_path):
    (tmp_path / "r.fq").write_text("@a\nAC\n+\n@~\n@b\nACG\n+\nhhh\n")
    assert [r[3] for r in rows(tmp_path / "r.fq", encoding="illumina")] == ["!_", "III"]
    (tmp_path / "s.fq").write_text("@a\nAC\n+\n?h\n")
    with pytest.raises(ValueError, match="for illumina"):
        rows(tmp_path / "s.fq", encoding="illumina")


def test_lines_are_whole(tmp_path):
    made = [("n", None, "A" * 30_000, "I" * 30_000)]
    (tmp_path / "r.fq").write_bytes(text(made))
    for size in (100, 9_000, 1 << 20):
        assert rows(tmp_path / "r.fq", split_bytes=size) == made


@pytest.mark.parametrize("name", ["r.fq.gz", "r.fq.bz2", "r.fq.zst", "r.gz.without.suffix"])
def test_compressed(tmp_path, name, monkeypatch):
    made, path = records(300), tmp_path / name
    half = text(made[:100]), text(made[100:])
    if "gz" in name:
        path.write_bytes(gzip.compress(half[0]) + gzip.compress(half[1]) + b"\0" * 10)
    elif "bz2" in name:
        path.write_bytes(bz2.compress(half[0]) + bz2.compress(half[1]))
    else:
        path.write_bytes(zstandard.ZstdCompressor().compress(half[0] + half[1]))
    for size in (1, 13, 1 << 20):
        monkeypatch.setattr("readmap.sources.fastq.COMPRESSED_READ_BYTES", size)
        assert rows(path, split_bytes=50) == made
    assert len(reader(path, split_bytes=50).partitions()) == 1


def test_truncated_gzip(tmp_path):
    (tmp_path / "r.fq.gz").write_bytes(gzip.compress(text(records(300)))[:-20])
    with pytest.raises(EOFError):
        rows(tmp_path / "r.fq.gz")


def block_file(path, made, per_block=4, index=True):
    offset, lines = 0, ["# block\toffset\tsize"]
    with open(path, "wb") as out:
        for k in range(0, len(made), per_block):
            member = pack_member(text(made[k : k + per_block]))
            out.write(member)
            lines.append(f"x\t{offset}\t{len(member)}")
            offset += len(member)
    if index:
        with open(f"{path}.idx", "w") as out:
            out.write("\n".join(lines) + "\n")


def test_block_gzip(tmp_path, monkeypatch):
    made, path = records(100), tmp_path / "r.fq.gz"
    block_file(path, made)
    assert gzip.decompress(path.read_bytes()) == text(made)
    assert is_block_gzip(path.read_bytes()) and not is_block_gzip(gzip.compress(b"x"))
    for size in (1, 13, 1 << 20):
        monkeypatch.setattr("readmap.sources.fastq.COMPRESSED_READ_BYTES", size)
        for group in (1, 200, 1 << 20):
            assert rows(path, block_split_bytes=group) == made
    assert len(reader(path, block_split_bytes=1).partitions()) == 25
    assert 1 < len(reader(path, block_split_bytes=300).partitions()) < 25


def test_block_gzip_without_index_has_the_same_splits(tmp_path):
    made, path, other = records(100), tmp_path / "r.fq.gz", tmp_path / "s.fq.gz"
    block_file(path, made)
    block_file(other, made, index=False)
    for group in (1, 100, 200, 301, 1000, 1 << 20):
        splits, found = ([s.value[1:] for s in reader(f, block_split_bytes=group).partitions()] for f in (path, other))
        assert found == splits
        assert rows(other, block_split_bytes=group) == made


def test_heads_inside_blocks_are_no_heads(tmp_path):
    """Text that holds the bytes of a head, and is stored as it is."""
    head = pack_member(b"")[:20]
    members = [pack_member(b"x" * 30 + head * 3 + b"y" * 30, level=0) for _ in range(20)]
    path = tmp_path / "r.fq.gz"
    path.write_bytes(b"".join(members))
    starts, size = [sum(map(len, members[:k])) for k in range(20)], path.stat().st_size
    with files.open_file(str(path)) as handle:
        for offset in range(size + 1):
            assert next_member(handle, offset, size) == min((s for s in starts if s >= offset), default=size)


def test_damaged_block_sizes_raise(tmp_path):
    made, path = records(40), tmp_path / "r.fq.gz"
    block_file(path, made, index=False)
    raw = path.read_bytes()
    with files.open_file(str(path)) as handle:
        starts = [g.start for g in find_groups(handle, len(raw), 1)]
    assert len(starts) == 10
    for at in (starts[0], starts[4], starts[-1]):
        for change in (-1, 1, 9):
            size = int.from_bytes(raw[at + 16 : at + 20], "little") + change
            path.write_bytes(raw[: at + 16] + size.to_bytes(4, "little") + raw[at + 20 :])
            for group in (1, 300, 1 << 20):
                with pytest.raises((ValueError, EOFError)):
                    rows(path, block_split_bytes=group)


def test_skipped_text_is_whole_at_any_buffer_size(tmp_path, monkeypatch):
    """Good and broken rows together have every byte of the file."""
    good = [f"@r{i}\nACGT\n+\nIIII\n" for i in range(6)]
    junk = "".join(f"no record, line {i}\n" for i in range(60))
    for parts in ([junk, *good], [good[0], junk, *good[1:]], [*good, junk], [good[0], junk, good[1], "@broken\nAC\nII\n", junk, good[2]]):
        raw = "".join(parts)
        (tmp_path / "r.fq").write_text(raw)
        for size in (16, 40, 100, 333, 1 << 20):
            for name in ("READ_BYTES", "SKIPPED_BYTES"):
                monkeypatch.setattr(f"readmap.sources.fastq.{name}", size)
            for split in (50, 1 << 20):
                found = rows(tmp_path / "r.fq", permissive=True, split_bytes=split)
                texts = [(r[6], r[7] if r[4] else f"@{r[0]}\n{r[2]}\n+\n{r[3]}\n") for r in found]
                assert "".join(t for _, t in sorted(texts)) == raw, (size, split)
                assert all(len(t) <= 2 * size + 200 for _, t in texts)


def test_groups_close_at_their_limit(tmp_path):
    path = tmp_path / "r.fq.gz"
    block_file(path, records(100))
    index = load_index(str(path), os.path.getsize(path))
    sizes, start, groups = [int(s) for s in index[:, 1]], 0, []
    size = 0
    for n in sizes:  # one after the other
        size += n
        if size >= 300:
            groups.append((start, size))
            start, size = start + size, 0
    if size:
        groups.append((start, size))
    assert [(g.start, g.length) for g in group_blocks(index, max_bytes=300)] == groups
    assert [g.length for g in group_blocks(index, max_blocks=10)] == [
        sum(sizes[k : k + 10]) for k in range(0, len(sizes), 10)
    ]


def test_paths(tmp_path):
    made = records(6)
    (tmp_path / "b").mkdir()
    for k, name in enumerate(["b/1.fq", "b/2.fq", "c.fq", "b/_SUCCESS", "b/.hidden"]):
        (tmp_path / name).write_bytes(text(made[2 * k : 2 * k + 2]))
    (tmp_path / "b" / "empty.fq").write_bytes(b"")
    assert rows(f"{tmp_path}/b,{tmp_path}/c.fq") == made
    assert rows(f"file:{tmp_path}/b/*.fq") == made[:4]
    assert rows(f"file://{tmp_path}/b/") == made[:4]
    for path in (f"{tmp_path}/none", f"{tmp_path}/none*.fq"):
        with pytest.raises(FileNotFoundError):
            rows(path)


def test_byte_ranges():
    assert files.byte_ranges(10, 4) == [(0, 4), (4, 8), (8, 10)]
    assert files.byte_ranges(0, 4) == []


def test_source(spark, tmp_path):
    made = records(200)
    (tmp_path / "r.fq").write_bytes(text(made))
    df = read_fastq(spark, str(tmp_path / "r.fq"), maxSplitBytes=100)
    assert df.rdd.getNumPartitions() > 10
    assert [tuple(r) for r in df.collect()] == made
    assert read_fastq(spark, str(tmp_path)).count() == 200
    strict = read_fastq(spark, str(tmp_path), qualityEncoding="illumina")
    with pytest.raises(Exception, match="quality out of range"):
        strict.collect()
    loose = read_fastq(spark, str(tmp_path), qualityEncoding="illumina", mode="permissive")
    assert loose.filter("_corrupt_reason is null").count() < 200
    for option in ({"mode": "LOOSE"}, {"qualityEncoding": "solexa"}):
        with pytest.raises(Exception, match="mode must be|unknown base quality"):
            read_fastq(spark, str(tmp_path), **option).collect()


def test_empty_folder(spark, tmp_path):
    with pytest.raises(Exception, match="no file"):
        read_fastq(spark, str(tmp_path)).count()
    spark.range(0).selectExpr("string(id) AS value").write.text(str(tmp_path / "none"))
    (tmp_path / "none" / "part").write_bytes(b"")
    assert read_fastq(spark, str(tmp_path / "none")).count() == 0


def test_blocks_table(spark, tmp_path):
    made, path = records(100), tmp_path / "r.fq.gz"
    block_file(path, made)
    index = load_index(str(path), os.path.getsize(path)).tolist()
    rows = read_block_index(spark, str(path)).orderBy("block_no").collect()
    assert [[r.start, r.length] for r in rows] == index and [r.block_no for r in rows] == list(range(25))
    groups = read_gzip_blocks(spark, str(path), maxSplitBytes=500)
    assert groups.rdd.getNumPartitions() > 1
    groups = groups.orderBy("group_no").collect()
    assert len(groups) == 3
    assert b"".join(g.payload for g in groups) == path.read_bytes()
    assert [g.length for g in groups] == [len(g.payload) for g in groups]
    (tmp_path / "s.fq.gz").write_bytes(b"x")
    with pytest.raises(Exception, match="no index"):
        read_gzip_blocks(spark, str(tmp_path)).collect()


def test_block_writer(spark, tmp_path):
    register_sources(spark)
    path = str(tmp_path / "out")
    lines = spark.range(1000).select(F.concat(F.lit("@r"), F.col("id"), F.lit("\nACGT\n+\nIIII")).alias("value"))
    lines.repartition(3).write.format("gzip_blocks").option("blockBytes", 2000).mode("append").save(path)
    df = read_fastq(spark, path, blockSplitBytes=100)
    assert df.rdd.getNumPartitions() > 3
    assert {r.name for r in df.collect()} == {f"r{i}" for i in range(1000)}
    assert df.count() == 1000


def test_index_must_cover_its_file(tmp_path):
    path = tmp_path / "r.fq.gz"
    made = records(40)
    block_file(path, made)
    index = (tmp_path / "r.fq.gz.idx").read_text().splitlines(keepends=True)
    for kept in (index[:-1], index[:2] + index[3:], [], index[:1], index[1:2] + index[1:]):
        (tmp_path / "r.fq.gz.idx").write_text("".join(kept))
        with pytest.raises(ValueError, match="does not cover"):
            rows(path)
    (tmp_path / "r.fq.gz.idx").write_text("".join(index))
    assert sorted(rows(path)) == sorted(made)


@pytest.mark.parametrize("between, good", [(b"", True), (b"junk", False), (b"\0\0\0", False), (b"\x1f\x8bjunk", False)])
def test_bytes_between_gzip_members(tmp_path, between, good):
    made = records(10)
    packed = gzip.compress(text(made[:5])) + between + gzip.compress(text(made[5:]))
    (tmp_path / "r.fq.gz").write_bytes(packed)
    if good:
        assert rows(tmp_path / "r.fq.gz") == made
    else:
        with pytest.raises((ValueError, EOFError, zlib.error)):
            rows(tmp_path / "r.fq.gz")
    (tmp_path / "s.fq.gz").write_bytes(gzip.compress(text(made)) + b"\0" * 3_000_000)
    assert rows(tmp_path / "s.fq.gz") == made


def test_inflated_in_bounded_pieces(tmp_path, monkeypatch):
    monkeypatch.setattr(fastq, "READ_BYTES", 1 << 16)
    line = b"@n\n" + b"A" * 100_000 + b"\n+\n" + b"I" * 100_000 + b"\n"
    data = line * 50
    for name, packed in (("r.fq.gz", gzip.compress(data)), ("r.fq.bz2", bz2.compress(data)), ("r.fq.deflate", zlib.compress(data))):
        (tmp_path / name).write_bytes(packed)
        with files.open_file(str(tmp_path / name)) as handle:
            codec = fastq._codec(name, packed[:20])
            pieces = list(fastq._decompressed(handle, fastq.FastqSplit(name, 0, len(packed), len(packed), codec)))
        assert b"".join(pieces) == data and max(map(len, pieces)) <= 1 << 16


def test_folders_inside_and_missing_files(tmp_path):
    made = records(9)
    for k, folder in enumerate(("x=1", "x=2/y=_3", "_temporary", ".hidden")):
        (tmp_path / "run" / folder).mkdir(parents=True)
        (tmp_path / "run" / folder / "part.txt").write_bytes(text(made[3 * k : 3 * k + 3]))
    assert sorted(rows(tmp_path / "run")) == sorted(made[:6])
    assert sorted(rows(tmp_path / "ru*")) == sorted(made[:6])
    (tmp_path / "empty").mkdir()
    for missing in ("empty", "none", "no*"):
        with pytest.raises(FileNotFoundError):
            rows(tmp_path / missing)


def test_broken_records_keep_their_text(tmp_path):
    good, lost = "@a\nAC\n+\nII\n", "@b\nAC\nx\nII\nmore\n"
    bad = "@c\nAC\n+\nI~\n"
    (tmp_path / "r.fq").write_text(good + lost + good + bad + "@d\nA")
    found = rows(tmp_path / "r.fq", permissive=True)
    assert sorted(r[-1] for r in found if r[4]) == sorted([bad, lost, "@d\nA\n"])


def test_paths_take_the_default_file_system(spark):
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    before = configuration.get("fs.defaultFS")
    assert files.qualified(spark, "/a/b,c") == "/a/b,c"
    try:
        configuration.set("fs.defaultFS", "viewfs://place/")
        configuration.set("fs.viewfs.mounttable.place.link./in", "file:/tmp")
        assert files.qualified(spark, "/in/b*, s3a://x/y,file:/z") == "viewfs://place/in/b*,s3a://x/y,file:/z"
    finally:
        configuration.set("fs.defaultFS", before)
