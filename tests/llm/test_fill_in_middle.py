import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from readmap.llm import fill_in_middle as fim
from readmap.llm.boundary_set import CHUNK, Array, Bitmap, BoundarySet, Runs

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


def masks():
    dice = np.random.default_rng(1)
    yield "empty", np.zeros(0, bool)
    yield "none", np.zeros(CHUNK + 5, bool)
    yield "one", np.ones(1, bool)
    yield "last place of a container", np.arange(CHUNK + 1) == CHUNK - 1
    for share in (0.0005, 0.02, 0.5, 0.98, 1.0):
        yield f"{share}", dice.random(3 * CHUNK + 77) < share
    yield "mixed", np.concatenate([dice.random(CHUNK) < 0.001, np.zeros(CHUNK, bool), dice.random(CHUNK) < 0.5, np.ones(CHUNK, bool)])


@pytest.mark.parametrize("name, mask", list(masks()))
def test_select(name, mask):
    found, members = BoundarySet(mask), np.flatnonzero(mask)
    assert len(found) == len(members)
    for k in {0, 1, 2, len(members) // 3, len(members) // 2, len(members) - 2, len(members) - 1, *range(0, len(members), 997)}:
        if 0 <= k < len(members):
            assert found.select(k) == members[k]
    for k in (-1, len(members)):
        with pytest.raises(IndexError):
            found.select(k)


def test_each_container_has_the_smallest_form():
    mixed = dict(masks())["mixed"]
    assert [type(c) for c in BoundarySet(mixed).containers] == [Array, Array, Bitmap, Runs]


def plain(doc_id, text, seed=1):
    """The contract, word for word."""
    text = text or ""
    units = UNIT.findall(text)
    n, h = len(units), hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    if doc_id is None or not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, n)))
    if h4 % 100 < 20:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_documents(spark):
    dice = random.Random(3)
    texts = ["", None, "a", "one two", "é́ñ😀 x", "a<P>b", "<S", "<<<", "<P", "M>", "P>", "\0\n\t", "word " * 30_000, "x" * 200_000, "日本語" * 30_000]
    texts += ["".join(dice.choices("ab<>PSM é\n1", k=dice.randrange(40))) for _ in range(600)]
    data = [(i, t) for i, t in enumerate(texts)] + [(None, "no id"), (3, "again"), (3, "again"), (-7, "less than nothing"), (2**62, "much")]
    docs = spark.createDataFrame([(*d, "x", 1) for d in data], "doc_id long, text string, form string, n int")
    made = fim.fill_in_middle(docs)
    got = made.withColumn("back", fim.restored()).collect()
    assert sorted(map(repr, (tuple(r)[:6] for r in got))) == sorted(repr(plain(*d)) for d in data)
    assert sorted((r.doc_id or 0, r.back) for r in got) == sorted((d or 0, t or "") for d, t in data)
    assert {"plain", "psm", "spm"} == {r.form for r in got}
    assert fim.fill_in_middle(docs.limit(0)).collect() == []


def test_another_seed_cuts_elsewhere(spark):
    docs = spark.range(50).select(F.col("id").alias("doc_id"), F.lit("some words stand here, and more").alias("text"))
    got = {r.doc_id: tuple(r) for r in fim.fill_in_middle(docs, seed=2).collect()}
    assert got == {d: plain(d, "some words stand here, and more", 2) for d in range(50)}
