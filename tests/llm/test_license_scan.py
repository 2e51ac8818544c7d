import re

import pytest

from readmap.llm import license_scan
from readmap.llm.license_scan import NOTICES, PHRASES, STRIDE, WIDTH, needed


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places, base, labels, score = [], set(), set(), 0.0
    for phrase, label in PHRASES:
        tokens = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(tokens)] == tokens:
                places.append(i)
                base.add(label)
    for start in range(0, len(words), STRIDE):
        block = set(words[start : start + WIDTH])
        for (notice, label), (must, never) in zip(NOTICES, license_scan.deciding(NOTICES, license_scan.CONTAINMENT)):
            tokens = set(notice.split())
            if not set(must) <= block or set(never) & block:
                continue
            if len(tokens & block) >= needed(len(tokens), license_scan.CONTAINMENT):
                labels.add(label)
                score = max(score, len(tokens & block) / len(tokens))
    edges = (min(places), max(places)) if places else (None, None)
    return (len(words), len(places), *edges, ",".join(sorted(base)), ",".join(sorted(base | labels)), 1.0 if base else score)


def texts():
    fill = "some other words stand around here "
    mit = NOTICES[8][0]
    yield from [None, "", " .,; ", "MIT License", "mit\nlicense. Apache LICENSE", "CC BY-NC 4.0", "GNU General Public Licence"]
    yield "license mit " + fill * 40 + "license"
    yield "the general public, gnu and a license"
    yield from [fill * 20 + notice.upper() + " " + fill * 20 for notice, _ in NOTICES]
    words = mit.split()
    yield " ".join(w for i, w in enumerate(words) if i % 7)
    yield " ".join(w for i, w in enumerate(words) if i % 2)
    for pad in (60, 62, 63, 64, 65, 126, 127, 128):
        yield "x " * pad + "gnu general public license " + "y " * pad + "cc by"
    yield "cc by " * 3000
    yield "été cc by été"


def test_agrees_with_every_block_and_template(spark):
    data = [(i, t) for i, t in enumerate(texts())]
    data += [(None, "apache license"), (3, "MIT License"), (3, "nothing"), (0, None)]
    docs = spark.createDataFrame([(*d, "x", 1) for d in data], "doc_id long, text string, words string, block int")
    got = license_scan.scan_licenses(docs).collect()
    key = lambda row: tuple((v is None, v) for v in row)
    assert sorted((tuple(r) for r in got), key=key) == sorted(((i, *brute(t)) for i, t in data), key=key)


@pytest.mark.parametrize(
    "text, labels",
    [
        ("This work is licensed under a Creative Commons Attribution 4.0 International License", "cc-by"),
        ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "cc-by-sa"),
        ("Licensed under CC BY 4.0.", "cc-by"),
        ("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc"),  # "cc by" is a phrase
        ("This work is licensed under the GNU General Public License version 3", "gpl"),
        ("This work is licensed under the GNU Lesser General Public License version 3", "lgpl"),
        ("You can redistribute it and/or modify it under the terms of the GNU Lesser General Public License", "lgpl"),
        ("licensed under the Apache \u212aicense version 2 0 M\u0130T license", "apache"),
    ],
)
def test_siblings_are_told_apart(spark, text, labels):
    assert license_scan.scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().labels == labels


def test_empty_table(spark):
    assert license_scan.scan_licenses(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_long_templates_are_refused(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(ValueError, match="templates may have"):
        license_scan.scan_licenses(docs, notices=[("w " * (WIDTH - STRIDE + 1), "x")])
