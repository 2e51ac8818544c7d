"""Passages that stand in several documents, by a sparse suffix array.

The suffixes that are kept begin at content-selected places: in each run of ``WINDOW`` places, where the hash of the next
``SEED`` words is smallest. A passage of ``PASSAGE`` words thus has a kept suffix among its first ``WINDOW`` words, with at least
``SHARED`` of its words to follow, in every document that has the passage. So suffixes are first sorted out by a hash of
their first ``SHARED`` words: what no other document has is no repeat.

Neighbouring suffixes of a document make a run, which covers all but the passage's first and last words. These are
found by sorting: the suffixes that share their first words are put in order of the words that follow, and in order of the
words that come before, read backwards. In such an order, nobody shares more words with a suffix than
its neighbours, so comparing neighbours gives how far the matches at a run's ends extend, to the right and to
the left. (Passages may overlap, so that not only a run's outermost suffix but all within a window of it are asked.)

A run's parts may be shared with different documents. Where a match extends a kept suffix by ``WINDOW`` - 1 words to one side,
one other document has ``PASSAGE`` words of it. In the other runs, each ``PASSAGE`` words in a row are compared by hash:
these belong to the kept suffix at the least hash of their first ``WINDOW`` places, in every document alike.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from readmap.llm.common import bounded, map_texts, parked
from readmap.llm.shingles import mixed, rows_of, word_hashes
from readmap.llm.tokens import each_utf8

PASSAGE, WINDOW, SEED = 50, 12, 4
SHARED = PASSAGE - WINDOW + 1
BROADCAST_ROWS = 1_000_000
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)

SPANS = "doc_id long, first_word long, n_words long, start long, end long, is_first boolean"


def anchors(words: np.ndarray) -> np.ndarray:
    """Places of the kept suffixes, in order."""
    if len(words) < SHARED:
        return np.zeros(0, np.int64)
    seeds = rows_of(words, SEED)
    if len(seeds) <= WINDOW:
        chosen = np.array([int(seeds.argmin())])
    else:
        windows = np.lib.stride_tricks.sliding_window_view(seeds, WINDOW)
        chosen = np.unique(windows.argmin(axis=1) + np.arange(len(windows)))
    return chosen[chosen <= len(words) - SHARED]


def shared_hashes(words: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Hash of the ``SHARED`` words from each place on."""
    return _row_hashes(words, places, SHARED)


def _row_hashes(words: np.ndarray, places: np.ndarray, size: int) -> np.ndarray:
    powers = np.full(len(words), _FACTOR, np.uint64)
    back = np.full(len(words), _INVERSE, np.uint64)
    powers[:1], back[:1] = 1, 1
    np.multiply.accumulate(powers, out=powers)
    np.multiply.accumulate(back, out=back)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * powers)])
    return mixed((sums[places + size] - sums[places]) * back[places])


def thinned(hashes: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Which suffixes are needed where a text goes round in circles, and its suffixes have the same words in a row.

    The first and last of such a row, and between them those that are the first in their ``WINDOW`` places.
    """
    new = np.concatenate([[True], hashes[1:] != hashes[:-1]])
    last = np.concatenate([new[1:], [True]])
    starts = np.maximum.accumulate(np.where(new, np.arange(len(places)), 0))
    step = (places - places[starts]) // WINDOW
    return new | last | np.concatenate([[True], step[1:] != step[:-1]])


def _suffixes(docs: DataFrame) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc = batch.column(0).to_numpy()
            keys, owners, places = [], [], []
            for d, text in zip(doc, each_utf8(batch.column(1))):
                words = word_hashes(text)
                at = anchors(words)
                if len(at):
                    hashes = shared_hashes(words, at)
                    needed = thinned(hashes, at)
                    at = at[needed]
                    keys.append(hashes[needed].view(np.int64))
                    owners.append(np.full(len(at), d))
                    places.append(at.astype(np.int32))
            if keys:
                columns = [pa.array(np.concatenate(c)) for c in (keys, owners, places)]
                yield pa.record_batch(columns, ["key", "doc", "place"])

    return map_texts(docs.select("doc", "text"), find, "key long, doc long, place int")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, first_word, n_words, start, end, is_first``: what other documents have as well.

    Each run of ``PASSAGE`` or more words that another document has is wholly inside a span, and each span has such a run; every
    part of a span belongs to a run of ``SHARED`` or more such words. Spans of a document do not touch, and have ``PASSAGE`` words or more. ``start`` and
    ``end`` are code points of the text. ``is_first``: of all documents with a part of the span, this one has
    the smallest hash, so whoever removes the other spans keeps one of each passage.

    Words stand between ASCII white space, with A-Z in lower case. NULL and empty texts have no spans. Rows that
    are equal in id and text are one document and have each its spans; other rows, NULL ids too, are documents of
    their own. (Documents are told apart by a 64-bit hash of id and text.) Only ``doc_id`` and ``text`` are read.
    """
    docs = docs.select("doc_id", "text").withColumn("doc", F.xxhash64("doc_id", "text"))
    suffixes = parked(_suffixes(docs))
    shared = suffixes.groupBy("key").agg(F.min("doc").alias("least"), F.max("doc").alias("most"))
    shared = parked(shared.filter("least <> most").drop("most"))  # a table, so that a hot key's join can be split
    suffixes = parked(suffixes.join(shared, "key"))

    in_order = Window.partitionBy("doc").orderBy("place")
    starts = F.coalesce((F.col("place") > F.lag("place").over(in_order) + SHARED).cast("int"), F.lit(0))
    numbered = suffixes.withColumn("starts", starts).withColumn("run", F.sum("starts").over(in_order)).drop("starts")
    numbered = parked(numbered.withColumn("is_least", F.col("doc") == F.col("least")).drop("least"))
    runs = numbered.groupBy("doc", "run").agg(
        F.min("place").alias("first"), F.max("place").alias("last"), F.min(F.col("is_least").cast("int")).alias("is_first")
    )
    runs = parked(runs)
    ends = numbered.join(runs.drop("is_first"), ["doc", "run"])
    # How far a suffix is inside its run, from either end.
    ends = ends.withColumn("after", F.col("place") - F.col("first")).withColumn("ahead", F.col("last") - F.col("place"))
    ends = parked(ends.select("key", "doc", "place", "run", "after", "ahead"))

    involved = bounded(runs.select("doc").distinct(), BROADCAST_ROWS)
    texts = parked(docs.join(involved, "doc", "left_semi"))
    spans = runs
    for side in ("left", "right"):
        found = _extended(ends, texts, side).withColumnsRenamed({"words": side, "whole": f"whole_{side}"})
        spans = spans.join(found, ["doc", "run"], "left")
    spans = parked(spans.select(
        "doc", "run", (F.col("first") - F.coalesce("left", F.lit(0))).alias("first"),
        (F.col("last") + SHARED + F.coalesce("right", F.lit(0))).alias("end"), "is_first",
        F.coalesce(F.col("whole_left") | F.col("whole_right"), F.lit(False)).alias("whole"),
    ))
    doubtful = spans.filter(~F.col("whole")).select("doc", "run")
    proven = _with_passages(numbered.select("key", "doc", "place", "run"), doubtful, texts).withColumn("proven", F.lit(True))
    spans = spans.join(proven, ["doc", "run"], "left").withColumn("whole", F.col("whole") | F.coalesce("proven", F.lit(False)))
    spans = spans.groupBy("doc").agg(F.collect_list(F.struct("first", "end", "is_first", "whole")).alias("spans"))
    return map_texts(texts.join(spans, "doc").select("doc_id", "text", "spans"), _located, SPANS)


def _extended(ends: DataFrame, texts: DataFrame, side: str) -> DataFrame:
    """``doc, run, words, whole``: by how many words the run extends to the side, in some other document.

    ``whole``: a kept suffix, with its match on that side, has ``PASSAGE`` words.
    """
    inside = F.col("after" if side == "left" else "ahead")
    keys = bounded(ends.filter(inside < WINDOW).select("key").distinct(), BROADCAST_ROWS)
    asked = ends.join(keys, "key", "left_semi").withColumn("inside", inside)
    asked = asked.groupBy("doc").agg(F.collect_list(F.struct("key", "place", "run", "inside")).alias("asked"))
    schema = "key long, around binary, doc long, run long, inside int"
    around = map_texts(texts.select("doc", "text").join(asked, "doc"), _around(side), schema)
    ordered = parked(around).repartitionByRange("key", "around", "doc").sortWithinPartitions("key", "around", "doc")
    compared = parked(ordered.mapInArrow(_neighbours, f"{schema}, words int, edge boolean"))
    # The outermost rows of each partition, compared once more across partitions: at most the runs of two documents.
    edges = sorted(compared.filter("edge").select("key", "around", "doc", "run", "inside").collect())
    more = []
    if edges:
        found = _shared_words(*(np.array(c) for c in zip(*((e.key, e.doc) for e in edges))), _matrix([bytes(e.around) for e in edges]))
        more = [(e.doc, e.run, e.inside, int(n)) for e, n in zip(edges, found)]
    across = texts.sparkSession.createDataFrame(more, "doc long, run long, inside int, words int")
    both = compared.select("doc", "run", "inside", "words").unionByName(across)
    longest = F.greatest(F.max(F.col("words") - F.col("inside")), F.lit(0))
    return both.groupBy("doc", "run").agg(longest.alias("words"), (F.max("words") >= WINDOW - 1).alias("whole"))


def _with_passages(suffixes: DataFrame, doubtful: DataFrame, texts: DataFrame) -> DataFrame:
    """``doc, run``: those of the doubtful runs of which another document has ``PASSAGE`` words in a row."""
    there = parked(suffixes.join(doubtful, ["doc", "run"]))
    keys = bounded(parked(there.select("key").distinct()), BROADCAST_ROWS)
    asked = suffixes.join(keys, "key", "left_semi").groupBy("doc").agg(F.collect_list(F.struct("place", "run")).alias("asked"))
    found = parked(map_texts(texts.select("doc", "text").join(asked, "doc"), _passages, "passage long, doc long, run long"))
    owners = found.groupBy("passage").agg(F.min("doc").alias("least"), F.max("doc").alias("most"))
    owners = parked(owners.filter("least <> most").select("passage"))  # a table, so that a hot passage's join can be split
    return found.join(owners, "passage").select("doc", "run").distinct()


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of the ``PASSAGE`` words in a row that belong to the suffixes asked for, once for each run."""
    for batch in batches:
        found: list[list] = [[np.zeros(0, np.int64)] for _ in range(3)]
        for doc, text, asked in zip(batch.column(0).to_pylist(), each_utf8(batch.column(1)), batch.column(2).to_pylist()):
            words = word_hashes(text)
            if len(words) < PASSAGE:
                continue
            places, runs = np.array(sorted((a["place"], a["run"]) for a in asked)).T
            at = anchors(words)
            kept = at[thinned(shared_hashes(words, at), at)]
            seeds = rows_of(words, SEED)
            least = np.lib.stride_tricks.sliding_window_view(seeds, WINDOW).argmin(axis=1) + np.arange(len(seeds) - WINDOW + 1)
            # Where the least hash is at a suffix that was thinned out, the one before it stands for it.
            least = least[: len(words) - PASSAGE + 1]
            owner = kept[np.searchsorted(kept, least, "right") - 1]
            which = np.minimum(np.searchsorted(places, owner), len(places) - 1)
            wanted = np.flatnonzero(places[which] == owner)
            hashes = _row_hashes(words, wanted, PASSAGE).view(np.int64)
            passages, run = np.unique(np.stack([hashes, runs[which[wanted]]]), axis=1)
            for column, values in zip(found, (passages, np.full(len(passages), doc, np.int64), run)):
                column.append(values)
        yield pa.record_batch([pa.array(np.concatenate(c), pa.int64()) for c in found], ["passage", "doc", "run"])


def _around(side: str):
    """The ``WINDOW`` - 1 words after, or before and backwards, as bytes that sort like the words' hashes."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reach = WINDOW - 1
        for batch in batches:
            columns: list[list] = [[] for _ in range(5)]
            for doc, text, asked in zip(batch.column(0).to_pylist(), each_utf8(batch.column(1)), batch.column(2).to_pylist()):
                words = word_hashes(text).astype(">u8")
                for a in asked:
                    if side == "left":
                        near = words[max(0, a["place"] - reach) : a["place"]][::-1]
                    else:
                        near = words[a["place"] + SHARED : a["place"] + SHARED + reach]
                    for column, value in zip(columns, (a["key"], near.tobytes(), doc, a["run"], a["inside"])):
                        column.append(value)
            kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32()]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], ["key", "around", "doc", "run", "inside"])

    return find


def _matrix(around: list[bytes]) -> np.ndarray:
    """Words in rows of equal width; 0 stands after the last, and equals nothing."""
    width = 8 * (WINDOW - 1)
    return np.frombuffer(b"".join(a.ljust(width, b"\0") for a in around), ">u8").reshape(-1, WINDOW - 1)


def _shared_words(keys: np.ndarray, docs: np.ndarray, around: np.ndarray) -> np.ndarray:
    """For rows in order: the most words that a row shares with one of the same key in another document."""
    same = (around[1:] == around[:-1]) & (around[1:] != 0)
    common = np.minimum.accumulate(same, axis=1).sum(axis=1)
    common = np.where(keys[1:] == keys[:-1], common, -1).tolist()
    alike = (docs[1:] == docs[:-1]).tolist()
    best = [-1] * len(keys)
    before = -1
    for i, c in enumerate(common, 1):  # the nearest row before that is of another document
        before = min(before, c) if alike[i - 1] else c
        best[i] = max(best[i], before)
    after = -1
    for i in range(len(keys) - 2, -1, -1):
        after = min(after, common[i]) if alike[i] else common[i]
        best[i] = max(best[i], after)
    return np.maximum(best, 0)


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare each row of a sorted partition with its neighbours, and mark its outermost rows."""
    batches = list(batches)
    rows = pa.Table.from_batches(batches) if batches else None
    if rows is None or not rows.num_rows:
        return
    keys, docs = rows["key"].to_numpy(), rows["doc"].to_numpy()
    words = _shared_words(keys, docs, _matrix(rows["around"].to_pylist()))
    inside = np.stack([rows["run"].to_numpy(), rows["inside"].to_numpy()], axis=1)
    edge = np.zeros(len(docs), bool)
    # From either end: the rows before the first of another document or key, and that one. Of rows as far inside the same run,
    # the outermost shares most.
    for order in (slice(None), slice(None, None, -1)):
        other = (docs[order] != docs[order][0]) | (keys[order] != keys[order][0])
        alone = int(other.argmax()) if other.any() else len(docs)
        edge[order][np.unique(inside[order][:alone], axis=0, return_index=True)[1]] = True
        edge[order][alone : alone + 1] = True
    rows = rows.append_column("words", pa.array(words.astype(np.int32))).append_column("edge", pa.array(edge))
    yield from rows.to_batches()


def _located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Join spans that touch, leave out short ones, and find their places in the text."""
    import re

    word = re.compile(rb"[^ \t-\r]+")
    kinds = [pa.int64()] * 5 + [pa.bool_()]
    names = ["doc_id", "first_word", "n_words", "start", "end", "is_first"]
    for batch in batches:
        columns: list[list] = [[] for _ in names]
        for doc_id, text, spans in zip(batch.column(0).to_pylist(), each_utf8(batch.column(1)), batch.column(2).to_pylist()):
            merged: list[list] = []
            for span in sorted((s["first"], s["end"], s["is_first"], s["whole"]) for s in spans):
                if merged and span[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], span[1])
                    merged[-1][2] = min(merged[-1][2], span[2])
                    merged[-1][3] |= span[3]
                else:
                    merged.append(list(span))
            merged = [m for m in merged if m[3]]
            if not merged:
                continue
            at = np.array([m.span() for m in word.finditer(text)])
            for first, end, is_first, _ in merged:
                start = len(text[: at[first][0]].decode())
                size = len(text[at[first][0] : at[end - 1][1]].decode())
                for column, value in zip(columns, (doc_id, first, end - first, start, start + size, bool(is_first))):
                    column.append(value)
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], names)
