import gzip
import json
import os
import subprocess
import sys
from collections import Counter
from pathlib import Path

import pyarrow as pa
import pytest

from checks.queries import _uneven_mates
from readmap import ReadLayout, job, map_barcodes, place_files, read_fastq, synth
from readmap.sinks import fastq_lines
from readmap.sinks.counted import COUNTERS, CountedFastqWriter
from readmap.sources.files import list_files
from readmap.sources.mask import MaskBinWriter, RECORD
from readmap.sources.parts import Staging

ROOT = Path(__file__).resolve().parents[1]


def lines(spark, path):
    """Records of all files of a folder."""
    texts = [open(f.uri, "rb").read() for f in list_files(str(path))]
    rows = [(gzip.decompress(t) if t[:2] == b"\x1f\x8b" else t).decode().splitlines() for t in texts]
    return Counter("\n".join(r[i : i + 4]) for r in rows for i in range(0, len(r), 4))


def written(spark, folder, mates, files=3):
    for k, mate in enumerate(mates, 1):
        fastq_lines(synth.suffixed(mate)).repartition(files, "name").sortWithinPartitions("value").write.text(f"{folder}/{k}")
    return [f"{folder}/{k}" for k in (1, 2)]


def compared(spark, sf, paths, out, layout=ReadLayout(), unique=False, **options):
    reads = [read_fastq(spark, path) for path in paths]
    mapping = map_barcodes(synth.mask(spark, sf), *reads, adapters=synth.ADAPTERS, layout=layout, unique=unique)
    got = place_files(spark, *paths, mapping.lookup, out, adapters=synth.ADAPTERS, layout=layout, **options)
    want = mapping.counters.first().asDict()
    assert got == {name: want[name] for name in COUNTERS} and got["mapped"]
    assert lines(spark, out) == Counter(r.value for r in fastq_lines(mapping.tagged).collect())
    assert not [f for f in os.listdir(os.path.dirname(out)) if f.startswith(".")]
    return got


@pytest.mark.parametrize("suffix, size", [("", 50_000), (".gz", 10**8)])
def test_same_as_two_passes(spark, sf, tmp_path, suffix, size):
    paths = written(spark, tmp_path, synth.mates(spark, sf))
    compared(spark, sf, paths, f"{tmp_path}/out{suffix}", maxSplitBytes=size)


def test_repeated_missing_and_unordered_names(spark, sf, tmp_path, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    first, second = _uneven_mates(spark, sf)
    paths = written(spark, tmp_path, (first, second))
    compared(spark, sf, paths, f"{tmp_path}/out", maxSplitBytes=20_000, unique=True)
    fastq_lines(second).orderBy("value").repartition(3).write.text(f"{tmp_path}/3")
    compared(spark, sf, [paths[0], f"{tmp_path}/3"], f"{tmp_path}/mixed", partitions=2, maxSplitBytes=30_000)


def test_windows_in_read_2_and_short_reads(spark, sf, tmp_path):
    reads1, reads2 = synth.mates(spark, sf)
    cut = reads1.selectExpr("name", "read_no", *[f"IF(name LIKE '%7', left({c}, 20), {c}) AS {c}" for c in ("sequence", "quality")])
    paths = written(spark, tmp_path, (reads2, cut))
    layout = ReadLayout(barcode_read=2, umi_read=2, mode="DROP")
    assert compared(spark, sf, paths, f"{tmp_path}/out", layout)["short_reads"]
    with pytest.raises(Exception, match="read shorter than"):
        place_files(spark, *paths, synth.mask(spark, sf), f"{tmp_path}/none", layout=ReadLayout(barcode_read=2, umi_read=2))
    assert sorted(os.listdir(tmp_path)) == ["1", "2", "out"]


def test_nothing_placed(spark, sf, tmp_path):
    paths = written(spark, tmp_path, synth.mates(spark, sf))
    counters = place_files(spark, *paths, synth.mask(spark, sf).limit(0), f"{tmp_path}/out")
    assert counters["total"] == 1000 and counters["mapped"] == 0 and os.listdir(tmp_path / "out") == []


@pytest.mark.parametrize("pairing", ["auto", "by-name"])
def test_job(spark, sf, tmp_path, pairing):
    paths = written(spark, tmp_path, synth.mates(spark, sf))
    synth.mask(spark, sf).selectExpr("concat_ws('\t', barcode, x, y)").write.text(f"{tmp_path}/mask.txt")
    args = ["-m", f"{tmp_path}/mask.txt", "-r1", paths[0], "-r2", paths[1], "-o", f"{tmp_path}/out", "-stat", f"{tmp_path}/stat"]
    text = job.run(spark, job.arguments([*args, "--pairing", pairing, "--mismatches", "1"]))
    assert (tmp_path / "stat").read_text() == text and "total_reads:\t1000\n" in text
    mapped = int(text.split("mapped_reads:\t")[1].split("\t")[0])
    assert sum(lines(spark, tmp_path / "out").values()) == mapped > 0


def batch(values, **counters):
    n = len(values)
    lone = pa.array([None] * n, pa.struct([("name", pa.string())]))
    columns = {"value": pa.array(values, pa.string()), "key": pa.array(range(n), pa.int64()), "lone": lone}
    columns |= {name: pa.array(counters.get(name, [None] * n), pa.int64()) for name in COUNTERS}
    return pa.RecordBatch.from_pydict(columns)


def test_attempts_that_are_not_committed_do_not_count(tmp_path):
    writer = CountedFastqWriter(f"{tmp_path}/out", f"{tmp_path}/side", "none")

    def fails():
        yield batch(["a", None], total=[1, 1])
        raise RuntimeError

    with pytest.raises(RuntimeError):
        writer.write(fails())
    writer.write(iter([batch(["a", None], total=[1, 1])]))  # a speculative attempt that came too late
    messages = [writer.write(iter([batch(["a", None], total=[1, 1]), batch(["b"], total=[1], mapped=[2])])), None]
    assert not os.path.exists(tmp_path / "out")
    writer.commit(messages)
    assert sorted(os.listdir(tmp_path)) == ["out", "side"] and len(os.listdir(tmp_path / "out")) == 1
    assert lines(None, tmp_path / "out") == Counter({"a\nb": 1})
    sums = json.loads((tmp_path / "side" / "counters.json").read_text())
    assert sums == dict.fromkeys(COUNTERS, 0) | {"total": 3, "mapped": 2}
    assert len(os.listdir(tmp_path / "side" / "keys")) == 1


def test_failing_tasks_count_once(tmp_path):
    """The first attempt of each task fails after it has written something; Spark tries again."""
    code = f"""
import os, sys
sys.path.insert(0, {str(ROOT)!r})
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
spark = (SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")
         .config("spark.checkpoint.dir", "{tmp_path}/shared").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
import readmap
from readmap import synth
from readmap.plans import one_pass
from readmap.sinks import fastq_lines
sf = "/root/testdata/sf0.001"
paths = []
for k, mate in enumerate(synth.mates(spark, sf), 1):
    fastq_lines(synth.suffixed(mate)).coalesce(1).write.text(f"{tmp_path}/{{k}}")
    paths.append(f"{tmp_path}/{{k}}")
whole = one_pass._counted

def failing(*args):
    def once(batches):
        from pyspark import TaskContext
        context = TaskContext.get()
        for batch in batches:
            yield batch
        if context.attemptNumber() == 0:
            raise RuntimeError("lost")
    rows = whole(*args)
    return rows.mapInArrow(once, rows.schema)

one_pass._counted = failing
mask = synth.mask(spark, sf)
spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
print("counters", one_pass.place_files(spark, *paths, mask, "{tmp_path}/out", adapters=synth.ADAPTERS, maxSplitBytes=30_000))
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True)
    found = [line for line in done.stdout.splitlines() if line.startswith("counters")]
    assert found, done.stderr[-2000:]
    assert "'total': 1000, 'adapter': 60," in found[0] and "'mapped': 420," in found[0]
    assert sum(lines(None, tmp_path / "out").values()) == 420
    assert not [f for f in os.listdir(tmp_path) if f.startswith(".")]


def mask_batch(n):
    return pa.RecordBatch.from_pydict({name: pa.array(range(n), kind) for name, kind in zip(RECORD.names, (pa.int64(), pa.int32(), pa.int32()))})


def test_parts_appear_together(tmp_path):
    def broken():
        yield mask_batch(3)
        raise RuntimeError

    path = tmp_path / "m.bin"
    first = MaskBinWriter(str(path))
    with pytest.raises(RuntimeError):
        first.write(broken())
    messages = [first.write(iter([mask_batch(4)])) for _ in range(3)]
    assert not path.exists()  # nothing before the commit
    first.commit(messages[:2])
    assert [f.size for f in list_files(str(path))] == [64, 64] and os.listdir(tmp_path) == ["m.bin"]
    second = MaskBinWriter(str(path))
    messages = [second.write(iter([mask_batch(5)])) for _ in range(2)]
    assert len(list_files(str(path))) == 2  # files of a job that goes on are not seen
    second.commit(messages)
    assert sorted(f.size for f in list_files(str(path))) == [64, 64, 80, 80]
    third = MaskBinWriter(str(path))
    third.write(iter([mask_batch(1)]))
    third.abort([])
    assert os.listdir(tmp_path) == ["m.bin"] and len(list_files(str(path))) == 4


@pytest.mark.parametrize("path", ["/a/b", "a", "a/b/", "hdfs://h/a/b", "/a"])
def test_staging_is_a_hidden_neighbour(path):
    folder = Staging(path).folder
    parent, name = path.rstrip("/").rpartition("/")[0], path.rstrip("/").rpartition("/")[2]
    assert folder.startswith(f"{parent}/.{name}-" if "/" in path.rstrip("/") else f".{name}-")
