import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from readmap.llm import ordered_packing as op
from readmap.llm.tokens import ByteEncoder, encoder

BYTE = public_tokenizers.path("byte_bpe_50k.json")


def padding(n, capacity):
    return 0 if n & (n - 1) == 0 else capacity - n


def least_cost(cuts, capacity):
    """All windows tried, without a queue: cuts are (place, penalty) by place."""
    cost = {0: 0}
    for place, penalty in cuts:
        ways = [cost[i] + padding(place - i, capacity) for i in cost if place - i <= capacity]
        cost[place] = min(ways) + penalty + op.WINDOW
    return cost[cuts[-1][0]]


@pytest.mark.parametrize("capacity", [1, 2, 7, 16, 48])
@pytest.mark.parametrize("step", [1, 40, 10_000])
def test_windows_cost_the_least(monkeypatch, capacity, step):
    monkeypatch.setattr(op, "STEP", step)
    monkeypatch.setattr(op, "SETTLE", 2)
    dice = random.Random(capacity)
    stream, cuts, rows, at = op.Stream(capacity, 0), [], [], 0
    for doc in range(60):
        n = dice.choice([1, 3, 10, 30, 90])
        ends = np.array(sorted(dice.sample(range(1, n), min(n - 1, dice.randrange(6)))), np.int64)
        places, penalties = op.cuts(ends, n, capacity)
        assert places[-1] == n and max(np.diff([0, *places])) <= capacity
        cuts += [(at + p, c) for p, c in zip(places.tolist(), penalties.tolist())]
        rows += stream.add(doc, b"abcd" * n, ends)
        at += n
    rows += stream.finish()
    assert len(stream.docs) == 0
    penalty, windows, end = dict(cuts), {}, 0
    for _, _, length, _, _, sequence, _ in rows:
        windows[sequence] = windows.get(sequence, 0) + length
    total = 0
    for n in windows.values():
        end += n
        total += padding(n, capacity) + penalty[end] + op.WINDOW
        assert n <= capacity
    assert end == at and total == least_cost(cuts, capacity)


@pytest.mark.parametrize("size", [50, 64, 63])
def test_settled_windows_leave_memory(size):
    stream, rows, most = op.Stream(64, 0), [], 0
    for doc in range(20_000):
        rows += stream.add(doc, b"abcd" * size, np.array([20, 40]))
        most = max(most, size * len(stream.docs))
    assert most <= op.MOST * 64 + 2 * op.STEP and len(stream.cutter.place) <= most / 8
    rows += stream.finish()
    windows = {}
    for r in rows:
        windows[r[5]] = windows.get(r[5], 0) + r[2]
    assert sum(windows.values()) == 20_000 * size and max(windows.values()) <= 64
    assert sum(padding(n, 64) for n in windows.values()) <= 0.3 * 20_000 * size


def test_sentence_ends():
    texts = ["One two. Three four?\nFive!  Six", "3.14 is no end", "\n\nA\n\nB", "他说。她走了", 'He said "no." Then he left.']
    wanted = [["One two.", " Three four?", "\n", "Five!", "  Six"], ["3.14 is no end"], ["\n\n", "A", "\n\n", "B"], ["他说。", "她走了"], ['He said "no."', " Then he left."]]
    tokenizer = Tokenizer.from_file(BYTE)
    find = op.Sentences(BYTE)
    for text, want in zip(texts, wanted):
        ids = np.frombuffer(encoder(ByteEncoder, BYTE).encode([text.encode()])[0], np.uint32)
        edges = [0, *find(ids).tolist(), len(ids)]
        got = [tokenizer.decode(ids[a:b].tolist()) for a, b in zip(edges, edges[1:])]
        assert "".join(got) == text
        # A line may end before or after its line feed, as the ids have it; sentences are never joined.
        assert [x.strip() for x in got if x.strip()] == [x.strip() for x in want if x.strip()]


def check(rows, data, capacity):
    tokenizer = Tokenizer.from_file(BYTE)
    left = sorted((d or 0, tokenizer.encode(t or "", add_special_tokens=False).ids + [1]) for d, t in data)
    sequences, docs = {}, {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        docs.setdefault(r.doc_id or 0, []).append(r)
    for doc_id, pieces in docs.items():
        whole = [ids for d, ids in left if d == doc_id]
        assert sum(r.length for r in pieces) == sum(map(len, whole))
        for r in pieces:
            parts = [zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) for ids in whole if len(ids) == r.doc_tokens]
            assert r.ids_crc32 in parts
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return [sum(length for _, length in places) for places in sequences.values()]


def test_documents(spark):
    data = [(1, "one two"), (2, None), (3, ""), (None, "no id. Two."), (1, "one two"), (4, "many words " * 3000), (5, "é\n\n x"), (6, "<|endoftext|> a. B")]
    docs = spark.createDataFrame([(*d, 0) for d in data], "doc_id long, text string, length int")
    for capacity in (1, 64, 2048):
        check(op.pack_in_order(docs, BYTE, capacity).collect(), data, capacity)
    assert op.pack_in_order(docs.limit(0), BYTE).collect() == []
    with pytest.raises(ValueError):
        op.pack_in_order(docs, BYTE, 0)


def test_order_and_little_padding(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").coalesce(1).sortWithinPartitions("doc_id")
    rows = op.pack_in_order(docs, BYTE).collect()
    sizes = check(rows, [(r.doc_id, r.text) for r in docs.collect()], 2048)
    assert sum(padding(n, 2048) for n in sizes) < 0.01 * sum(sizes)
    stream = sorted((r.sequence_id, r.offset, r.doc_id, r.start) for r in rows)
    assert [x[2:] for x in stream] == sorted(x[2:] for x in stream)
