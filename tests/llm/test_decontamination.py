import random

import numpy as np
import pytest
from brute_force import edit_distance, nearest_substring

from readmap.llm.decontamination import (
    EDIT_RATE,
    PASSAGE,
    Index,
    contaminated,
    gram_hashes,
    items_left_out,
    normalised,
    passages,
    without_contaminated,
)

WORDS = ["the", "and", "thion", "erly", "ingou", "hetion", "orre", "la", "est", "schkeit", "élan"]


def sentence(dice, n):
    return " ".join(dice.choice(WORDS) for _ in range(n))


def edited(dice, text, edits):
    text = bytearray(text)
    for _ in range(edits):
        kind, at = dice.randrange(3), dice.randrange(len(text))
        if kind == 0:
            text[at] = dice.choice(b"xyzq")
        elif kind == 1:
            text.insert(at, dice.choice(b"xyzq"))
        else:
            del text[at]
    return bytes(text)


def plain(text):
    return normalised(text)[0].tobytes()


def test_normalised():
    assert plain(b"  Ab,  c\n\nD-1 ") == b"ab c d 1"
    assert plain("É x".encode()) == "É x".encode()
    assert plain(b"") == plain(b" .,") == b""


@pytest.mark.parametrize("size", [1, 2, 3, 7, 10, 16])
def test_gram_hash_depends_on_its_bytes_only(size):
    raw = np.frombuffer(random.Random(size).randbytes(60), np.uint8)
    hashes = gram_hashes(raw, size)
    assert len(hashes) == 61 - size
    assert all(hashes[i] == gram_hashes(raw[i : i + size], size)[0] for i in (0, 11, 44))
    assert len(gram_hashes(raw[:size - 1], size)) == 0


def test_agrees_with_full_alignment():
    dice = random.Random(4)
    items = [(i, sentence(dice, dice.randint(5, 30)).encode()) for i in range(10)]
    items += [(None, b"Ab"), (77, b""), (78, b"Hey you there")]
    index = Index(items)
    for _ in range(120):
        _, item = items[dice.randrange(10)]
        passage = edited(dice, item, dice.randint(0, len(item) // 10 + 1))
        text = b" ".join([sentence(dice, dice.randint(0, 20)).encode(), passage, sentence(dice, dice.randint(0, 20)).encode()])
        texts = [text, b"", sentence(dice, 8).encode()]
        best, parts = {}, set()
        for t, k, start, end, edits, share in index.find(texts):
            if share < 1:
                parts.add((t, k))
                continue
            if edit_distance(plain(items[k][1]), plain(texts[t][start:end])) == edits:  # else all passages of it
                best[t, k] = min(edits, best.get((t, k), 99))
            else:
                parts.add((t, k))
        for t, whole in enumerate(texts):
            for k, (_, item) in enumerate(items):
                item = plain(item)
                if item.count(b" ") < 2:
                    assert (t, k) not in best
                    continue
                distance = nearest_substring(item, plain(whole))
                if distance <= index.edits[k]:
                    assert best.get((t, k)) == distance
                elif len(item) > PASSAGE:
                    near = [nearest_substring(item[a : a + PASSAGE], plain(whole)) for a in passages(len(item))]
                    assert ((t, k) in parts or (t, k) in best) == (min(near) <= EDIT_RATE * PASSAGE)
                else:
                    assert (t, k) not in best and (t, k) not in parts


def test_parts_of_items(spark):
    dice = random.Random(2)
    item = sentence(dice, 90)
    half = item[: len(item) * 6 // 10]
    data = [
        (1, f"Before. {half} After."), (2, f"x {item[200:360]} y"), (3, f"x {item[200:270]} y"),
        (4, f"{item[:150]} some other words {sentence(random.Random(3), 30)} {item[-150:]}"), (5, f"a {item} b"),
    ]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    benchmark = spark.createDataFrame([(7, item)], "item_id long, text string")
    rows = contaminated(docs, benchmark).collect()
    shares = {}
    for r in rows:
        shares.setdefault(r.doc_id, []).append(r.share)
        assert dict(data)[r.doc_id][r.start : r.end] == r.passage and r.passage in f" {item} " or r.edits
    assert set(shares) == {1, 2, 4, 5} and shares[5] == [1.0] and len(shares[4]) == 2
    assert 0.45 < shares[1][0] < 0.65
    assert [r.doc_id for r in without_contaminated(docs, benchmark).collect()] == [3]


def test_short_items(spark):
    items = [(1, "a"), (2, "yes"), (3, "the end of it"), (4, None), (5, "two words"), (6, " ,. ")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame([(1, "banana eyes yes a"), (2, "at the end of it all"), (3, "bathe end of items"), (4, "The END, of it")], "doc_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in contaminated(docs, benchmark).collect()) == [(2, 3), (4, 3)]
    assert sorted(r.item_id for r in items_left_out(benchmark).collect()) == [1, 2, 4, 5, 6]
    assert sorted(r.doc_id for r in without_contaminated(docs, benchmark).collect()) == [1, 3]


def test_very_long_item():
    dice = random.Random(6)
    words = ["".join(dice.choices("abcdefghij", k=dice.randint(2, 8))) for _ in range(4000)]
    item, other = " ".join(words).encode(), " ".join(dice.sample(words, 100)).encode()
    found = Index([(1, item)]).find([b"x " + item + b" y", item[5000:5200], other])
    assert [f[:2] for f in found] == [(0, 0), (1, 0)]
    assert found[0][2:] == (2, 2 + len(item), 0, 1.0) and found[1][5] < 0.01


def test_spans_and_unusual_rows(spark):
    item = "That and onesen therblest it hein ti inenan eranenes whou Therouou."
    data = [
        (1, f"Été. {item} Fin.", "a"), (1, f"Été. {item} Fin.", "a"), (None, item.upper(), "b"), (2, None, "c"), (3, "", "d"), (4, "clean text", "e"),
        (5, "x " * 50_000 + item, "f"), (6, f"{item} and {item}", "g"),
    ]
    docs = spark.createDataFrame(data, "doc_id long, text string, item_id string")
    benchmark = spark.createDataFrame([(7, item), (7, item), (8, None), (9, "  "), (None, "unseen item of some length")], "item_id long, text string")
    rows = contaminated(docs, benchmark).collect()
    assert sorted((r.doc_id or 0, r.item_id, r.edits) for r in rows) == [(0, 7, 0), (1, 7, 0), (1, 7, 0), (5, 7, 0), (6, 7, 0), (6, 7, 0)]
    texts = {d: t for d, t, _ in data}
    assert all(texts[r.doc_id][r.start : r.end] == r.passage for r in rows)
    assert {r.passage for r in rows if r.doc_id} == {item[:-1]}
    assert sorted(r.doc_id for r in without_contaminated(docs, benchmark).collect()) == [2, 3, 4]
    assert without_contaminated(docs, benchmark).columns == docs.columns
    assert contaminated(docs.limit(0), benchmark).collect() == []
    assert contaminated(docs, benchmark.limit(0)).collect() == []
    assert without_contaminated(docs, benchmark.limit(0)).count() == len(data)


def test_blocks_of_the_benchmark_give_the_same(spark):
    dice = random.Random(8)
    items = [(i, sentence(dice, 15)) for i in range(20)]
    docs = spark.createDataFrame([(i, sentence(dice, 9) + " " + items[i % 20][1]) for i in range(60)], "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = [sorted(map(tuple, contaminated(docs, benchmark, block_bytes=size).collect())) for size in (300, 1_000_000)]
    assert rows[0] == rows[1] and len(rows[0]) >= 60
