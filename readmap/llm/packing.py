"""Best-fit packing of documents into sequences, hierarchically.

Documents become pieces of at most one sequence. Each partition packs its pieces best-fit, longest first, and
emits the bins that are nearly full. What underfull bins hold goes on as items: a tree of rounds brings
the bins of several groups together, where they are packed again, as wholes, until one group is left.
"""

import math
import struct
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readmap.llm.common import map_texts, parked
from readmap.llm.tokens import ByteEncoder, encoder, utf8

#: Pieces that a group packs in the first round, groups that the next round brings together, and the
#: unused places that a bin may have when it is emitted before the last round.
GROUP_ROWS = 50_000
FAN_IN = 8
SPARE = 2

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = f"{PIECE}, sequence_id long, offset long, closed boolean"


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of n ids: only the first may be shorter than a sequence."""
    first = n % capacity or min(n, capacity)
    if n <= capacity:
        return [(0, n)]
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int = 2) -> DataFrame:
    """Pieces of all documents, of their whole texts: ``doc_id, piece, start, length, ids_crc32``."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(ByteEncoder, tokenizer).encode, struct.pack("<I", end_id)
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            columns: list[list] = [[] for _ in names]
            for at in range(0, len(doc_ids), 64):
                for doc_id, raw in zip(doc_ids[at : at + 64], encode(utf8(batch.column(1).slice(at, 64)))):
                    raw = memoryview(raw + end)
                    for piece, (start, length) in enumerate(cut(len(raw) // 4, capacity)):
                        crc = zlib.crc32(raw[4 * start : 4 * (start + length)])
                        for column, value in zip(columns, (doc_id, piece, start, length, crc)):
                            column.append(value)
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    return map_texts(docs.select("doc_id", "text"), pieces, PIECE)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit, longest first: bin and offset of each item, and the bins' fillings."""
    bins = np.empty(len(lengths), np.int64)
    offsets = np.empty(len(lengths), np.int64)
    filled: list[int] = []
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # by free places
    some = 0  # bit f: there are bins with f free places
    for item in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[item])
        fitting = some >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            at = open_bins[free].pop()
            if not open_bins[free]:
                some ^= 1 << free
        else:
            free, at = capacity, len(filled)
            filled.append(0)
        bins[item], offsets[item] = at, filled[at]
        filled[at] += length
        free -= length
        if free:
            open_bins[free].append(at)
            some |= 1 << free
    return bins, offsets, np.array(filled, np.int64)


def pack(pieces: DataFrame, capacity: int = 1024, group_rows: int = GROUP_ROWS, spare: int = SPARE) -> DataFrame:
    """Give each piece a ``sequence_id`` and an ``offset`` there; all other columns of ``PIECE`` stay.

    Sequences have no gaps, begin at 0 and hold at most ``capacity`` ids. Pieces of ``capacity`` ids are a
    sequence each, without a round. Later rounds have fewer groups, but never so few that one would get
    more than ``FAN_IN * group_rows`` pieces; when a round cannot close a hundredth of what is open, all is emitted.
    """
    if capacity >= 1 << 20:
        raise ValueError("capacity must be below 2 ** 20")
    names = [field.split()[0] for field in PIECE.split(", ")]
    pieces = pieces.select(*names)
    whole = pieces.filter(F.col("length") >= capacity)
    # The sign bit keeps ids of whole sequences apart from those of rounds.
    alone = whole.withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    opened = pieces.filter(F.col("length") < capacity)
    rows = opened.count()
    groups, level, closed = max(1, math.ceil(rows / group_rows)), 0, [parked(alone)]
    opened = opened.withColumn("sequence_id", F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    opened = opened.repartition(groups)
    while rows:
        last = groups == 1
        done = parked(opened.mapInArrow(_round(capacity, level, capacity if last else spare), PLACED))
        closed.append(done.filter("closed").drop("closed"))
        if last:
            break
        opened = done.filter("NOT closed").drop("closed")
        before, rows = rows, opened.count()
        level += 1
        stuck = rows > 0.99 * before
        groups = max(1, math.ceil(groups / FAN_IN), math.ceil(rows / (FAN_IN * group_rows)))
        if stuck and groups > 1:
            closed.append(opened)
            break
        opened = opened.repartition(groups, "sequence_id")
    return reduce(DataFrame.unionByName, closed)


def _round(capacity: int, level: int, spare: int):
    """Pack what a partition holds; rows with one ``sequence_id`` are one item."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        batches = list(batches)
        rows = pa.Table.from_batches(batches) if batches else None
        if rows is None or not rows.num_rows:
            return
        group = TaskContext.get().partitionId()
        length, offset = rows["length"].to_numpy(), rows["offset"].to_numpy()
        _, item = np.unique(rows["sequence_id"].to_numpy(), return_inverse=True)
        sizes = np.bincount(item, weights=length).astype(np.int64)
        bins, places, filled = best_fit(sizes, capacity)
        sequence = (level << 56) + (group << 32) + bins[item]
        rows = rows.drop_columns(["sequence_id", "offset"])
        rows = rows.append_column("sequence_id", pa.array(sequence, pa.int64()))
        rows = rows.append_column("offset", pa.array(places[item] + offset, pa.int64()))
        rows = rows.append_column("closed", pa.array(filled[bins[item]] >= capacity - spare))
        yield from rows.to_batches()

    return packed


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """Pieces of all documents with their places in sequences of at most ``capacity`` ids.

    ``docs`` needs ``doc_id`` and ``text``; more columns are ignored. A NULL or empty text is a piece with the
    end id alone. Rows with one id, NULL too, are packed each for itself. An empty table gives no rows.
    """
    return pack(parked(token_pieces(docs, tokenizer, capacity, end_id)), capacity)
