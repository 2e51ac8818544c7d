import zlib

import numpy as np

from readmap.llm import quality
from readmap.llm.common import table


def test_held_out_accuracy(spark, sf):
    sf = sf.replace("sf0.001", "sf0.01")
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = quality.fit(docs, labels)
    rows = quality.scored(docs, model).join(labels, "doc_id").filter(quality.held_out()).select("doc_id", "score", "quality").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows) and len(rows) > 50
    right = np.mean([(r.score >= quality.THRESHOLD) == (r.quality == 1) for r in rows])
    assert right > 0.95


def test_learns_only_from_rows_that_are_not_held_out(spark):
    texts = [(i, "good calm words stand here" if i % 2 else "bad %%% noise %%% here") for i in range(400)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    def judge(i):
        return i % 2 if zlib.crc32(str(i).encode()) % 5 else 1 - i % 2  # wrong where held out

    labels = spark.createDataFrame([(i, judge(i), 0) for i, _ in texts], "doc_id long, quality int, toxic int")
    model = quality.fit(docs, labels)
    assert model.score(b"good calm words") > 0.8 and model.score(b"bad %%% noise") < 0.2


def test_score_is_of_the_whole_text_in_any_cut(monkeypatch):
    model = quality.train([b"good text here"] * 5 + [b"bad bad bad"] * 5, [1] * 5 + [0] * 5)
    text = b"good text here and " * 300
    whole = model.score(text)
    monkeypatch.setattr(quality, "PIECE", 1000)
    assert abs(model.score(text) - whole) < 0.01
    assert len(list(quality._pieces(b"x" * 2500))) == 3
    tail = model.score(text + b"bad bad bad " * 3000)
    assert tail < whole


def test_unusual_texts(spark):
    model = quality.train([b"good text", b"bad text"], [1, 0])
    docs = spark.createDataFrame(
        [(None, None, 1.0), (1, "", 2.0), (1, " \n ", 3.0), (2, "a", 4.0), (2, "é" * 100_000, 5.0)], "doc_id long, text string, score double"
    )
    rows = quality.scored(docs, model).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    assert quality.scored(docs.limit(0), model).collect() == []
    scores = {r.text: r.score for r in rows}
    assert scores[None] == scores[""] == scores[" \n "]


def test_without_labels_every_score_is_even(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    labels = spark.createDataFrame([(None, 1), (1, None), (1, 7)], "doc_id long, quality int")
    assert abs(quality.fit(docs, labels).score(b"a b c") - 0.5) < 1e-6


def plain_features(text):
    """Buckets of a text's features, one by one."""
    every, factor = (1 << 64) - 1, 0x9E3779B97F4A7C15

    def spread(x):
        x = ((x ^ x >> 33) * 0xFF51AFD7ED558CCD) & every
        x = ((x ^ x >> 33) * 0xC4CEB9FE1A85EC53) & every
        return x ^ x >> 33

    words = "".join(" " if ord(c) <= 32 else c for c in text).split(" ")
    words = [w for w in words if w]
    found, hashes = [], []
    for word in words:
        for size in quality.NGRAMS:
            framed = f" {word} "
            for i in range(len(framed) - size + 1):
                gram = 0
                for c in framed[i : i + size]:
                    gram = (gram * factor + ord(c)) & every
                found.append(spread((gram + size) & every))
        hashes.append(sum(spread((ord(c) * factor + ((i + 1) << 20)) & every) for i, c in enumerate(f" {word}")) & every)
    found += [spread(h) for h in hashes]
    found += [1 if a == b else spread((a * factor + b) & every) for a, b in zip(hashes, hashes[1:])]
    return sorted(x % quality.BUCKETS for x in found)


def test_score_is_that_of_features_one_by_one():
    texts = ["", " \t", "a", "é", "Über  die\nBrücke", "слово слово и дело", "一二三四五 六", "x y x y  x y ", "a\U0001f600b a\U0001f600b"]
    model = quality.train([t.encode() for t in texts], [i % 2 for i in range(len(texts))])
    for text in texts:
        want = plain_features(text)
        assert sorted(quality.features(text.encode()).tolist()) == want
        margin = model.bias + sum(float(model.margins[b]) for b in want) / (len(want) + quality.BLANKS)
        assert abs(model.score(text.encode()) - 1 / (1 + np.exp(-margin))) < 1e-9


def test_pieces_keep_code_points_whole(monkeypatch):
    monkeypatch.setattr(quality, "PIECE", 10)
    text = ("слово" * 9 + " 一二三四五 \U0001f600" * 5).encode()
    cuts = list(quality._pieces(text))
    assert cuts[0][0] == 0 and cuts[-1][1] == len(text) and all(a[1] == b[0] for a, b in zip(cuts, cuts[1:]))
    assert all(text[a:b].decode() for a, b in cuts)
