import random

import pytest
from pyspark.sql import functions as F

import plain
from readmap.operators import barcodes as ops


def keys(spark, values):
    return spark.createDataFrame([(v,) for v in values], "barcode bigint")


def apart(a, b, length, start):
    """Places in which two encoded barcodes differ; None if they differ outside the window."""
    bases = [2 * ((start + i) % 32) for i in range(length)]
    places = [i for i, at in enumerate(bases) if (a ^ b) >> at & 3]
    inside = sum({3 << at for at in bases})
    return None if (a ^ b) & ~inside else places


def poly(seed, n, length, hot="G" * 13):
    """Barcodes that share a half, and some others."""
    dice = random.Random(seed)
    made = set()
    while len(made) < n:
        half = "".join(dice.choices("ACGT", k=length - len(hot)))
        made.add(plain.encode(half + hot if dice.random() < 0.9 else "".join(dice.choices("ACGT", k=length)), 0, length))
    return sorted(made)


@pytest.mark.parametrize("length, start, most, buckets", [(25, 20, 0, 1 << 16), (7, 0, 3, 4), (7, 0, 10_000, 1 << 16), (1, 0, 0, 1 << 16)])
def test_pairs_equal_all_compared(spark, monkeypatch, length, start, most, buckets):
    monkeypatch.setattr(ops, "HOT_PAIRS", most)
    monkeypatch.setattr(ops, "BUCKETS", buckets)
    dice = random.Random(length)
    window = [2 * ((start + i) % 32) for i in range(length)]

    def one():
        value = sum({dice.choice((0, 3, 3)) << at for at in window})
        if dice.random() < 0.5 and len(window) > 2:
            value ^= 1 << dice.choice(window)
        return value ^ dice.choice((0, 0, 0, 1 << 63))

    def signed(value):
        return value - (1 << 64) if value >> 63 else value

    left, right = ({signed(one() & (1 << 64) - 1) for _ in range(60)} for _ in range(2))
    got = ops.one_base_apart(keys(spark, left), keys(spark, right), length, start).collect()
    want = [(a, b) for a in left for b in right if (found := apart(a, b, length, start)) is not None and len(found) == 1]
    assert sorted((r.barcode, r.mask_barcode) for r in got) == sorted(want)


def test_a_hot_half_is_no_product(spark, monkeypatch):
    monkeypatch.setattr(ops, "HOT_PAIRS", 2000)
    left, right = poly(1, 3000, 25), poly(2, 3000, 25)
    met = ops.meeting(keys(spark, left), keys(spark, right), 25)
    pairs = met.count()
    assert pairs < 60_000  # under halves alone: about 2700 * 2700
    found = ops.one_base_apart(keys(spark, left), keys(spark, right), 25).collect()
    near = set()
    others = set(right)
    for a in left:
        near |= {(a, b) for i in range(25) for step in (1, 2, 3) if (b := a ^ step << 2 * i) in others}
    assert {tuple(r) for r in found} == near and len(found) == len(near) > 0


@pytest.mark.parametrize("sent", [0, 10])
def test_many_hot_groups_are_not_broadcast(spark, monkeypatch, sent):
    monkeypatch.setattr(ops, "HOT_PAIRS", 0)
    monkeypatch.setattr(ops, "MOST_SENT", sent)
    left, right = poly(3, 200, 10, "GGG"), poly(4, 200, 10, "GGG")
    got = {tuple(r) for r in ops.one_base_apart(keys(spark, left), keys(spark, right), 10).collect()}
    assert got == {(a, b) for a in left for b in right if len(apart(a, b, 10, 0) or ()) == 1}


def test_one_mismatch_map_with_a_hot_half(spark, monkeypatch):
    mask = [(b, k, -k) for k, b in enumerate(poly(5, 500, 25))]
    captured = [(b, 1) for b in poly(6, 400, 25)] + [(mask[k][0] ^ 1 << 20, 2) for k in range(0, 500, 7)]
    frames = spark.createDataFrame(captured, "barcode bigint, reads bigint"), spark.createDataFrame(mask, "barcode bigint, x int, y int")
    want = sorted(map(tuple, ops.one_mismatch_map(*frames).collect()))
    monkeypatch.setattr(ops, "HOT_PAIRS", 50)
    assert sorted(map(tuple, ops.one_mismatch_map(*frames).collect())) == want and len(want) > 50
    assert ops.one_mismatch_map(frames[0].limit(0), frames[1]).collect() == []
    assert ops.one_mismatch_map(frames[0], frames[1].limit(0)).agg(F.count("*")).first()[0] == 0
