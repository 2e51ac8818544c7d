import random

import pytest
from brute_force import near_components, shingles

from readmap.llm import near_duplicates as nd
from readmap.llm.components import components
from readmap.llm.shingles import shingle_set, word_hashes


def text(dice, n, words=400):
    return [f"w{dice.randrange(words)}" for _ in range(n)]


def edited(dice, words, share):
    return [f"u{dice.randrange(10**9)}" if dice.random() < share else w for w in words]


def group(seed, size, with_base):
    """Copies of one text with more or fewer edits, many of them just below the similarity."""
    dice = random.Random(seed)
    base = text(dice, 120)
    docs = [base] if with_base else []
    docs += [edited(dice, base, dice.choice([0.01, 0.03, 0.05, 0.08, 0.12])) for _ in range(size)]
    docs += [text(dice, dice.randint(0, 40)) for _ in range(60)]
    docs += [docs[3]] * 5
    dice.shuffle(docs)
    return {i: " ".join(d) for i, d in enumerate(docs)}


def rows(spark, docs, **options):
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    return {r.doc_id: r for r in nd.near_duplicates(frame, **options).collect()}


@pytest.mark.parametrize("seed, with_base, size", [(1, True, 2), (2, False, 2), (3, True, 5)])
def test_agrees_with_all_pairs_in_a_large_group(spark, seed, with_base, size):
    docs = group(seed, 160, with_base)
    got = rows(spark, docs, shingle_words=size)
    assert {d: r.component_id for d, r in got.items()} == near_components(docs, size, 80)
    assert all(r.n_shingles == len(shingles(docs[d], size)) and r.kept == (d == r.component_id) for d, r in got.items())


def test_chains_are_one_component(spark):
    words = [f"w{i}" for i in range(300)]
    docs = {90 - i: " ".join(words[10 * i : 10 * i + 150]) for i in range(15)}
    got = rows(spark, docs, shingle_words=2)
    assert {d: r.component_id for d, r in got.items()} == near_components(docs, 2, 80)


def test_unusual_rows(spark):
    data = [
        (1, None, 0), (2, "", 0), (3, " \n", 0), (4, "one", 0), (5, "ONE", 0), (6, "one two", 0), (7, "One\vTwo", 0), (8, "É x", 0), (9, "é x", 0),
        (None, "one two", 0), (None, None, 0), (6, "one two", 1), (10, "a b " * 50_000, 0), (11, "b a " * 49_999, 0), (12, "three four", 0), (12, "one two", 0),
    ]
    docs = spark.createDataFrame(data, "doc_id long, text string, label int")
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in nd.near_duplicates(docs, shingle_words=2).collect())
    assert got == sorted([
        (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False), (6, 1, 6, True), (7, 1, 6, False), (8, 1, 8, True), (9, 1, 9, True),
        (0, 1, 0, True), (0, 0, 0, True), (6, 1, 6, True), (10, 2, 10, True), (11, 2, 10, False), (12, 1, 12, True), (12, 1, 6, False),
    ])
    left = nd.without_near_duplicates(docs, shingle_words=2)
    assert left.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in left.collect()) == [0, 0, 1, 2, 3, 4, 6, 8, 9, 10, 12]
    assert nd.near_duplicates(docs.limit(0)).collect() == [] and nd.without_near_duplicates(docs.limit(0)).collect() == []


def test_sketches_estimate_high_similarities():
    dice = random.Random(3)
    for _ in range(30):
        base = text(dice, 300)
        other = edited(dice, base, 0.03)
        a, b = (shingle_set(word_hashes(" ".join(w).encode()), 2) for w in (base, other))
        common = len(set(a.tolist()) & set(b.tolist()))
        similarity = common / (len(a) + len(b) - common)
        ones = sum(int(x).bit_count() for x in (nd.odd_sketch(nd.signature(a)) ^ nd.odd_sketch(nd.signature(b))).view("<u8"))
        assert ones <= nd.most_bits(similarity - nd.MARGIN)
        assert ones >= nd.most_bits(similarity + nd.MARGIN) if similarity + nd.MARGIN < 1 else True


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 7), (200, 201), (202, 201)]
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.label for r in found} == {**{i: 0 for i in range(41)}, 100: 0, 200: 200, 201: 200, 202: 200}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_percent_is_checked(spark):
    with pytest.raises(ValueError, match="percent"):
        nd.near_duplicates(spark.createDataFrame([(1, "a")], "doc_id long, text string"), percent=20)
