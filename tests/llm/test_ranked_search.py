import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from readmap.llm import ranked_search as rs

TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").encode().lower())


def brute(docs, items, k):
    """The contract, one pair at a time: sorted rows."""
    counts = [(d, Counter(terms(t))) for d, t in docs if terms(t)]
    many, length = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(term for _, c in counts for term in c)
    out = []
    for item_id, text in items:
        scores = []
        for d, c in counts:
            n = sum(c.values())
            m = 100 - 50 + (50 * n * many) // length
            score = 0
            for term in set(terms(text)):
                if c[term]:
                    w = math.floor(1000 * math.log((2 * many + 2) / (2 * df[term] + 1)))
                    score += w * ((1_000_000_000 * c[term]) // (1000 * c[term] + 20 * m))
            if score > 0:
                scores.append((-score, d is None, d or 0))
        out += [(item_id, rank, None if gone else d, -s) for rank, (s, gone, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(map(repr, out))


def corpus(seed):
    dice = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["é", "日本", "Ab", "3d"]
    docs = [(i, dice.choice(" .-\n").join(dice.choices(words, k=dice.randrange(1, 40)))) for i in range(150)]
    docs += [(200, ""), (201, None), (202, " .,- "), (None, "w1 w2"), (None, None), (7, "w1 w1 w1"), (7, "w1 w1 w1"), (203, "W5 " * 30_000)]
    items = [(i, " ".join(dice.choices(words, k=dice.randrange(1, 30)))) for i in range(20)]
    items += [(50, None), (51, ""), (52, "nowhere to be found"), (3, "w5 w6"), (None, "w7 AB"), (53, " ".join(words))]
    return docs, items


@pytest.mark.parametrize("k", [1, 7, 500])
def test_ranks_equal_brute_force(spark, k):
    docs, items = corpus(k)
    d = spark.createDataFrame([(*x, 0) for x in docs], "doc_id long, text string, score int").repartition(5)
    i = spark.createDataFrame([(*x, 0) for x in items], "item_id long, text string, rank int")
    got = rs.search(d, i, k).select("item_id", "rank", "doc_id", "score").collect()
    assert sorted(repr(tuple(r)) for r in got) == brute(docs, items, k)


def test_blocks_and_small_batches_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(rs, "BLOCK_BYTES", 300)
    monkeypatch.setattr(rs, "SUM_BYTES", 1)
    monkeypatch.setattr(rs, "MINED", 4)
    docs, items = corpus(5)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    assert len(list(rs.blocks(i))) > 3
    got = rs.search(d, i, 9).select("item_id", "rank", "doc_id", "score").collect()
    assert sorted(repr(tuple(r)) for r in got) == brute(docs, items, 9)


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    i = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert rs.search(d.limit(0), i).collect() == [] and rs.search(d, i.limit(0)).collect() == []
    assert rs.search(d, i.filter("text IS NULL")).columns == ["item_id", "rank", "doc_id", "score"]


def test_shared_sets_are_summed_once():
    common = set(range(10))
    queries = [common | {10 + q} for q in range(8)] + [{0, 1, 2}, {30}, set()]
    shared = rs.share(queries, 40)
    assert shared.additions < sum(max(0, len(q) - 1) for q in queries) / 2

    def leaves(node):
        return [node] if node < 40 else [x for part in shared.pairs[node - 40] for x in leaves(part)]

    assert [sorted(x for r in roots for x in leaves(r)) for roots in shared.roots] == [sorted(q) for q in queries]


@pytest.mark.parametrize("seed", range(5))
def test_sums_equal_a_product(seed):
    dice = np.random.default_rng(seed)
    held = dice.random((30, 50)) < 0.3
    queries = [set(np.flatnonzero(h).tolist()) for h in held]
    value = dice.integers(1, 10**12, (50, 16)) * (dice.random((50, 16)) < 0.4)
    term, doc = np.nonzero(value)
    assert np.array_equal(rs.sums(rs.share(queries, 50), term, doc, value[term, doc], 16), held.astype(np.int64) @ value)


def test_best_keeps_ties_by_id():
    best = rs.Best(2, 2)
    best.add(np.array([[5, 5, 5, 0], [0, 1, 0, 0]]), np.array([9, 4, 7, 1]), np.array([False, False, False, False]))
    query, score, _, doc = best.prune()
    assert list(zip(query.tolist(), score.tolist(), doc.tolist())) == [(0, 5, 4), (0, 5, 7), (1, 1, 4)]
    best.add(np.array([[5], [3]]), np.array([5]), np.array([False]))
    query, score, _, doc = best.prune()
    assert list(zip(query.tolist(), score.tolist(), doc.tolist())) == [(0, 5, 4), (0, 5, 5), (1, 3, 5), (1, 1, 4)]
