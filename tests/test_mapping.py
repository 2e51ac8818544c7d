import random
from dataclasses import asdict

import pytest
from pyspark.sql import functions as F

import plain
from readmap import ReadLayout, map_barcodes, synth
from readmap.operators import pairing
from readmap.operators.barcodes import captured_barcodes, captured_counts, one_mismatch_map, unique_mask
from readmap.operators.counters import run_counters, stats_report

READ = "name string, sequence string, quality string"
MASK = "barcode bigint, x int, y int"
GOLDEN = {
    "0.001": dict(mask_rows=115, total=1000, adapter=60, umi_bad=407, mapped=420, bq=16141, uq=7368, rq=41258, rb=60160),
    "0.01": dict(
        mask_rows=1150, total=10000, adapter=573, umi_bad=4339, mapped=3907, bq=161840, uq=73334, rq=414698, rb=603328
    ),
}
REPORT = """getBarcodePositionMap_uniqBarcodeTypes:\t1150
total_reads:\t10000
adapter_filtered_reads:\t573\t5.73%
umi_filtered_reads:\t4339\t46.03%
mapped_reads:\t3907\t76.79%
Q30_bases_in_barcode:\t68.67%
Q30_bases_in_umi:\t77.79%
Q30_bases_in_read:\t68.74%
"""


def lines(report):
    return "".join(r.line + "\n" for r in report.orderBy("line_no").collect())


@pytest.mark.parametrize("scale", GOLDEN)
def test_golden_counters(spark, scale):
    sf = f"/root/testdata/sf{scale}"
    mapping = map_barcodes(synth.mask(spark, sf), *synth.mates(spark, sf), adapters=synth.ADAPTERS)
    assert mapping.counters.first().asDict() == GOLDEN[scale] | {"short_reads": 0}
    assert mapping.tagged.count() == GOLDEN[scale]["mapped"]


def test_golden_report(spark):
    sf = "/root/testdata/sf0.01"
    mapping = map_barcodes(synth.mask(spark, sf), *synth.mates(spark, sf), adapters=synth.ADAPTERS)
    assert lines(stats_report(mapping.counters)) == REPORT


def made(seed, short=False, length=30):
    """Small reads and a mask, with repeated and missing names and with repeated barcodes."""
    rng = random.Random(seed)
    barcodes = ["".join(rng.choices("ACGTN", [3, 3, 3, 3, 0.2], k=length)) for _ in range(5)]

    def reads():
        rows = []
        for _ in range(60):
            sequence = rng.choice(barcodes)
            if rng.random() < 0.4:
                at = rng.randrange(length)
                sequence = sequence[:at] + rng.choice("ACGTn") + sequence[at + 1 :]
            if short and rng.random() < 0.2:
                sequence = sequence[: rng.randrange(length)]
            quality = "".join(rng.choices("!+5?I_", [1.5, 1, 1, 1, 5, 1], k=len(sequence)))
            if short and rng.random() < 0.1:
                quality = quality[:-3]
            rows.append((f"n{rng.randrange(40)}", sequence, quality))
        return rows

    return barcodes, reads(), reads()


@pytest.mark.parametrize("barcode_read", [1, 2])
@pytest.mark.parametrize("umi_read", [1, 2])
@pytest.mark.parametrize("start", [0, 3])
def test_against_plain_python(spark, barcode_read, umi_read, start):
    layout = ReadLayout(start, 12, barcode_read, 18, 6, umi_read, mode="DROP")
    barcodes, reads1, reads2 = made(barcode_read * 10 + umi_read, short=True)
    mask = [(plain.encode(b, start, 12), i, -i) for i, b in enumerate(barcodes[:4])]
    mask += [(mask[0][0], 90, 91), (mask[0][0], 90, 91), (-1, 5, 5)]
    adapters = [barcodes[4][8:14], "TTTTTT"]
    want, placed = plain.map_reads(mask, reads1, reads2, adapters, layout)
    assert want["mapped"] and want["umi_bad"] and want["adapter"] and want["short_reads"]
    tables = [spark.createDataFrame(t, s) for t, s in ((mask, MASK), (reads1, READ), (reads2, READ))]
    mapping = map_barcodes(*tables, adapters=adapters, layout=layout)
    assert mapping.counters.first().asDict() == want
    assert sorted(map(tuple, mapping.tagged.collect())) == placed
    short = F.count_if(F.expr("NOT adapter AND short"))
    pairs = mapping.pairs.agg(F.count("*"), F.count_if("adapter"), short).first()
    assert tuple(pairs) == (want["total"], want["adapter"], want["short_reads"])


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_same_result_by_any_join(spark, settings, threshold):
    settings(spark__sql__autoBroadcastJoinThreshold=threshold, spark__sql__adaptive__autoBroadcastJoinThreshold=threshold)
    layout = ReadLayout(0, 12, 1, 18, 6, 1)
    barcodes, reads1, reads2 = made(7)
    mask = [(plain.encode(b, 0, 12), i, i) for i, b in enumerate(barcodes)] * 2
    want, placed = plain.map_reads(mask, reads1, reads2, [], layout)
    tables = [spark.createDataFrame(t, s) for t, s in ((mask, MASK), (reads1, READ), (reads2, READ))]
    mapping = map_barcodes(*tables, layout=layout)
    assert mapping.counters.first().asDict() == want
    assert sorted(map(tuple, mapping.tagged.collect())) == placed


def one(spark, sequence1="A" * 24 + "CACGTACGTAC", quality1="I" * 35, sequence2="ACGT", name2="r"):
    mask = spark.createDataFrame([(plain.encode("A" * 24 + "C", 0, 25), 1, 2)], MASK)
    reads1 = spark.createDataFrame([("r", sequence1, quality1)], READ)
    reads2 = spark.createDataFrame([(name2, sequence2, "I" * len(sequence2))], READ)
    return mask, reads1, reads2


def test_one_pair(spark):
    mapping = map_barcodes(*one(spark))
    assert [tuple(r) for r in mapping.tagged.collect()] == [("r", "ACGT", "IIII", "ACGTACGTAC", "I" * 10, 1, 2)]


@pytest.mark.parametrize("sequence1,quality1", [("ACGT", "I" * 35), ("A" * 24 + "CACGTACGTAC", "I" * 34), ("", "")])
@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_short_read_fails(spark, settings, sequence1, quality1, threshold):
    settings(spark__sql__autoBroadcastJoinThreshold=threshold, spark__sql__adaptive__autoBroadcastJoinThreshold=threshold)
    tables = one(spark, sequence1, quality1)
    mapping = map_barcodes(*tables)
    for result in (mapping.tagged, mapping.counters, mapping.pairs, mapping.tagged.groupBy().count()):
        with pytest.raises(Exception, match="shorter than"):
            result.collect()
    # not in a pair, or in one that the adapter filter takes
    for harmless in (map_barcodes(*one(spark, sequence1, quality1, name2="s")), map_barcodes(*tables, adapters=["CG"])):
        assert harmless.tagged.count() == 0
        assert harmless.counters.first().mapped == 0
    dropped = map_barcodes(*tables, mode="DROP")
    assert dropped.counters.first().short_reads == 1 and dropped.tagged.count() == 0


def test_short_read2_fails(spark):
    mask, reads1, reads2 = one(spark)
    with pytest.raises(Exception, match="shorter than"):
        map_barcodes(mask, reads2, reads1, barcode_read=2, umi_read=1).tagged.collect()
    with pytest.raises(Exception, match="shorter than"):
        map_barcodes(mask, reads1, reads2, barcode_read=1, umi_read=2).tagged.collect()
    harmless = one(spark, name2="s")
    assert map_barcodes(*harmless, barcode_read=2, umi_read=2).tagged.count() == 0


def test_no_pairs_at_all(spark):
    mask, reads1, reads2 = one(spark, name2="other")
    text = lines(stats_report(map_barcodes(mask, reads1, reads2).counters))
    assert text.splitlines()[1:3] == ["total_reads:\t0", "adapter_filtered_reads:\t0\tNaN%"]
    assert text.endswith("Q30_bases_in_read:\tNaN%\n")


def test_report_rounds_half_up_and_divides_by_zero(spark):
    values = "1 mask_rows, 800 total, 1 adapter, 0 short_reads, 799 umi_bad, 3 mapped, 0 bq, 0 uq, 1 rq, 8 rb"
    counters = spark.range(1).selectExpr(*[f"cast({v.split()[0]} as bigint) as {v.split()[1]}" for v in values.split(", ")])
    text = lines(stats_report(counters)).splitlines()
    assert text[2] == "adapter_filtered_reads:\t1\t0.13%"  # 0.125
    assert text[4] == "mapped_reads:\t3\tInfinity%"
    assert text[7] == "Q30_bases_in_read:\t12.50%"


def test_counters_stay_linear_in_a_repeated_name(spark):
    """A billion pairs of one name, counted from their 60,000 reads."""
    n = 30_000
    reads = spark.range(n).select(
        F.lit("same").alias("name"),
        F.lit("A" * 24 + "CACGTACGTAC").alias("sequence"),
        F.repeat(F.lit("I"), F.lit(35)).alias("quality"),
    )
    mask = spark.createDataFrame([(plain.encode("A" * 24 + "C", 0, 25), 1, 2)] * 2, MASK)
    row = run_counters(reads, reads, mask).first()
    assert (row.total, row.mapped, row.rb) == (n * n, 2 * n * n, 35 * n * n)


@pytest.mark.parametrize("count", [1, 65, 257, 1000])
def test_any_number_of_adapters(spark, count):
    rng = random.Random(count)
    reads = [(f"r{i}", "".join(rng.choices("ACGT", k=rng.randrange(0, 60))), "") for i in range(500)]
    reads += [("r0", "A", ""), ("r1", None, ""), ("r2", "a.c|(x)", "")]
    adapters = ["".join(rng.choices("ACGT", k=rng.randrange(5, 10))) for _ in range(count)] + ["", "A" * 70, "c|("]
    table = spark.createDataFrame([(a,) for a in adapters * 2], "adapter string")
    df = spark.createDataFrame(reads, READ)
    want = sorted(((n, s, any(a in (s or "") for a in adapters if a)) for n, s, _ in reads), key=str)
    for given in (table, adapters):
        flagged = pairing.flag_adapters(df, given).select("name", "sequence", "adapter")
        assert sorted(map(tuple, flagged.collect()), key=str) == want
        plan = flagged._jdf.queryExecution().toString()
        assert "Exchange" not in plan and "Join" not in plan


def test_ambiguous_barcodes_are_not_rescued(spark):
    """With ``unique``, a barcode that the mask has twice is dropped, whatever stands next to it."""
    def code(bases):
        return plain.encode(bases, 0, 25)

    same, near, far = "A" * 25, "A" * 24 + "C", "C" * 25
    mask = [(code(same), 1, 1), (code(same), 2, 2), (code(near), 3, 3), (code(far), 4, 4)]
    barcodes = [same, near, "A" * 24 + "T", "G" + far[1:], "T" + same[1:]]
    reads1 = [(f"r{i}", b + "ACGTACGTAC", "I" * 35) for i, b in enumerate(barcodes)]
    reads2 = [(n, "ACGT", "IIII") for n, _, _ in reads1]
    tables = [spark.createDataFrame(t, s) for t, s in ((mask, MASK), (reads1, READ), (reads2, READ))]
    mapping = map_barcodes(*tables, unique=True, mismatches=1)
    assert sorted((r.name, r.x) for r in mapping.tagged.collect()) == [("r1", 3), ("r3", 4)]
    assert mapping.counters.first().mapped == 2
    usual = map_barcodes(*tables, mismatches=1)
    assert sorted((r.name, r.x) for r in usual.tagged.collect()) == [("r0", 1), ("r0", 2), ("r1", 3), ("r3", 4), ("r4", 1), ("r4", 2)]


@pytest.mark.parametrize("adapters", [[], ["GGGGG"]])
def test_broken_reads_take_no_part(spark, adapters):
    mask, reads1, reads2 = one(spark)
    bad1 = spark.createDataFrame([("r", None, None), ("s", "A" * 35, None)], READ)
    bad2 = spark.createDataFrame([("r", None, "I"), ("s", "ACGT", "IIII")], READ)
    mapping = map_barcodes(mask, reads1.union(bad1), reads2.union(bad2), adapters=adapters)
    assert [r.name for r in mapping.tagged.collect()] == ["r"]
    assert (mapping.counters.first().total, mapping.counters.first().mapped) == (1, 1)
    assert {(r.read_no, r.records) for r in mapping.broken.collect()} == {(1, 2), (2, 1)}


def test_unique_mask(spark):
    mask = spark.createDataFrame([(1, 1, 1), (2, 1, 1), (2, 1, 1), (3, 0, 0), (3, 1, 1), (3, 1, 2), (-4, 9, 9)], MASK)
    assert sorted(map(tuple, unique_mask(mask).collect())) == [(-4, 9, 9), (1, 1, 1)]


def test_captured_barcodes(spark):
    mask = spark.createDataFrame([(1, 1, 1), (2, 5, 5), (2, 6, 6), (2, 6, 6), (9, 0, 0)], MASK)
    captured = captured_counts(spark.createDataFrame([(1,), (2,), (2,), (3,)], "barcode bigint"))
    got = sorted(captured_barcodes(captured, mask).collect(), key=str)
    want = [(1, 1, 1, 1), (2, 2, 5, 5), (2, 2, 6, 6), (2, 2, 6, 6), (3, 1, None, None)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("start", [0, 5])
def test_one_mismatch(spark, start):
    rng = random.Random(start)
    known = ["".join(rng.choices("AC", k=6)) for _ in range(12)]
    seen = ["".join(rng.choices("ACG", k=6)) for _ in range(80)]
    pad = "G" * start
    mask = [(plain.encode(pad + b, start, 6), i, i) for i, b in enumerate(known)]
    captured = [(plain.encode(pad + b, start, 6),) for b in seen]
    got = one_mismatch_map(
        spark.createDataFrame(captured, "barcode bigint"), spark.createDataFrame(mask, MASK), 6, start=start
    )
    want = set()
    for b in set(seen) - set(known):
        near = {k for k in known if sum(x != y for x, y in zip(b, k)) == 1}
        if len(near) == 1:
            key, near = plain.encode(pad + b, start, 6), plain.encode(pad + near.pop(), start, 6)
            want |= {(key, near, x, y) for k, x, y in mask if k == near}
    assert want
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_mismatch_mapping(spark):
    mask, reads1, reads2 = one(spark, sequence1="A" * 23 + "TC" + "ACGTACGTAC")
    assert map_barcodes(mask, reads1, reads2).tagged.count() == 0
    mapping = map_barcodes(mask, reads1, reads2, mismatches=1)
    assert [(r.x, r.y) for r in mapping.tagged.collect()] == [(1, 2)]
    assert mapping.counters.first().mapped == 1 and mapping.counters.first().mask_rows == 1


def test_wrong_arguments(spark):
    tables = one(spark)
    for wrong in ({"mismatches": 2}, {"mode": "OTHER"}, {"barcode_len": 0}, {"layout": ReadLayout(), "umi_len": 3}):
        with pytest.raises(ValueError):
            map_barcodes(*tables, **wrong)
    assert asdict(ReadLayout())["umi_start"] == 25
