import random
import re

import pytest
from brute_force import edit_distance

from readmap.llm import line_dedup as ld

EDGES = re.compile(r"^[\x00-\x20]+|[\x00-\x20]+$")


def edited(dice, line, edits):
    line = list(line)
    for _ in range(edits):
        kind, at = dice.randrange(3), dice.randrange(len(line) + 1)
        if kind == 1:
            line.insert(at, dice.choice("abé"))
        elif at < len(line):
            line[at : at + 1] = [dice.choice("abé")] if kind == 0 else []
    return "".join(line)


def brute(docs, shortest=ld.LEAST_LENGTH):
    """Removed lines by (id, line), and the numbers of the report by id; lines under 20 repeat as exact copies only."""
    lines = [(d, i, EDGES.sub("", x)) for d, t in sorted(docs.items()) for i, x in enumerate((t or "").split("\n"))]
    lines = [x for x in lines if len(x[2]) >= shortest]
    first = {}
    for d, i, x in lines:
        first.setdefault(x, (d, i))
    long = [x for x in first if len(x) >= ld.LEAST_LENGTH]
    near = dict.fromkeys(first, ())
    near |= {x: [y for y in long if y != x and abs(len(x) - len(y)) <= ld.EDITS and edit_distance(x, y) <= ld.EDITS] for x in long}
    report, removed = {}, set()
    for d, i, x in lines:
        exact, close = (d, i) > first[x], any(first[y] < first[x] for y in near[x])
        counts = report.setdefault(d, [0, 0, 0, 0])
        for k, n in enumerate((exact, close, len(near[x]), exact or close)):
            counts[k] += n
        if exact or close:
            removed.add((d, i))
    return removed, report


def corpus(seed):
    dice = random.Random(seed)
    base = ["".join(dice.choices("ab é", k=dice.randint(17, 40))) for _ in range(40)]
    docs = {}
    for d in range(60):
        lines = [edited(dice, dice.choice(base), dice.choice([0, 0, 1, 2, 3])) for _ in range(dice.randint(0, 6))]
        docs[d] = "\n".join(dice.choice([x, f"  {x}\t", x]) for x in lines)
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_agrees_with_all_pairs(spark, seed):
    docs = corpus(seed)
    frame = spark.createDataFrame([(*d, "x") for d in docs.items()], "doc_id long, text string, line string")
    removed, report = brute(docs)
    got = {r.doc_id: (r.n_exact, r.n_near, r.n_links, r.n_removed) for r in ld.line_report(frame).collect()}
    assert got == {d: tuple(report.get(d, [0] * 4)) for d in docs}
    assert sum(n for *_, n in got.values()) > 50
    left = ld.without_repeated_lines(frame)
    assert left.columns == frame.columns
    want = {d: "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in removed) for d, t in docs.items()}
    assert {r.doc_id: r.text for r in left.collect()} == want


def test_verification_is_the_edit_distance(spark):
    dice, pairs = random.Random(3), []
    for _ in range(800):
        a = "".join(dice.choices("abé", k=dice.randint(0, 12)))
        pairs.append((a, edited(dice, a, dice.randint(0, 4))))
    rows = spark.createDataFrame(pairs, "a string, b string").withColumn("near", ld.within_edits("a", "b")).collect()
    assert all(r.near == (edit_distance(r.a, r.b) <= ld.EDITS) for r in rows)


def test_unusual_rows(spark):
    line = "a line that is long enough"
    data = [(None, line), (1, None), (2, ""), (3, "\n\n"), (4, line), (5, f"{line}\r\n{line}!"), (4, line), (5, "short\nshort"), (6, "x" * 70_000)]
    docs = spark.createDataFrame([(*d, 1) for d in data], "doc_id long, text string, first int")
    left = sorted(((r.doc_id or 0), r.text) for r in ld.without_repeated_lines(docs).collect() if r.text is not None)
    assert left == [(0, ""), (2, ""), (3, "\n\n"), (4, line), (4, line), (5, ""), (5, "short\nshort"), (6, "x" * 70_000)]
    report = ld.line_report(docs).collect()
    assert len(report) == len(data)
    assert sorted((r.doc_id or 0, r.n_lines) for r in report) == [(0, 1), (1, 0), (2, 0), (3, 3), (4, 1), (4, 1), (5, 2), (5, 2), (6, 1)]
    assert ld.line_report(docs.limit(0)).collect() == [] and ld.without_repeated_lines(docs.limit(0)).collect() == []


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame(list(corpus(1).items()), "doc_id long, text string")
    for frame in (ld.edit_links(ld.line_classes(docs)), ld.without_repeated_lines(docs), ld.line_report(docs)):
        plan = frame._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan


def classes(spark, lines):
    rows = [(i, line, len(line)) for i, line in enumerate(sorted(lines))]
    return spark.createDataFrame(rows, "node long, line string, length int")


@pytest.mark.parametrize("hot", [1, 6])
def test_divided_keys_lose_no_link(spark, monkeypatch, hot):
    monkeypatch.setattr(ld, "HOT", hot)
    dice = random.Random(hot)
    templates = ["{} request served from the cache", "узел {} отвечает на запрос", "第{}号の記録はここに保存されました。以上です", "aaaaaaaaaaaaaaaa{}aaaaaaaa"]
    lines = set()
    for n in range(220):
        line = dice.choice(templates).format(str(dice.randrange(10 ** dice.choice([2, 4, 8]))).zfill(4))
        lines.add(edited(dice, line, dice.choice([0, 0, 1, 2])))
    lines = sorted(x for x in lines if len(x) >= ld.LEAST_LENGTH)
    want = {(a, b) for a, x in enumerate(lines) for b, y in enumerate(lines[a + 1 :], a + 1) if abs(len(x) - len(y)) <= 2 and edit_distance(x, y) <= 2}
    got = [tuple(r) for r in ld.edit_links(classes(spark, lines)).collect()]
    assert len(got) == len(set(got)) and {tuple(sorted(pair)) for pair in got} == want and len(want) > 100


def test_lines_of_one_template_do_not_all_meet(spark):
    dice = random.Random(7)
    found = {}
    for n in (500, 2_000):
        lines = {f"{dice.randrange(10**8):08} request served from the cache" for _ in range(n)}
        found[n] = ld.candidate_pairs(classes(spark, lines)).count()
    # All pairs are 124,750 and 1,999,000.
    assert found[500] < 20 * 500 and found[2_000] < 40 * 2_000
