"""Packing in document order: window cuts by dynamic programming.

The documents of a partition, each with its end id, are one stream of ids. Windows of at most ``capacity`` ids
cover it without gaps. A window may end at a document's end for nothing, at a sentence's end for a small
penalty, and in a sentence that is too long for either, at every few ids, for a larger one. What is least is the
sum of padding, penalties and ``WINDOW`` for each window. A window of 2 ** k ids needs no padding.

With ``cost`` the least sum up to a cut, a window from cut i to cut j adds ``capacity - (place[j] - place[i])``, so
the best i is the least ``cost[i] + place[i]`` among the cuts that are near enough: a monotone queue has it in
constant time. Windows of 2 ** k ids are at most a dozen further transitions, found by place.

The stream is decided as it goes: where the best ways to all cuts that a window can still begin at have a
cut in common, everything before it is settled and leaves memory. In streams that repeat themselves, two ways may run
side by side for ever; after ``MOST`` windows, the one to the best place to go on from is taken.
"""

import heapq
import struct
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from readmap.llm.common import map_texts, worker_state
from readmap.llm.tokens import ByteEncoder, encoder, utf8

#: In ids of padding: what a cut at a sentence's end costs, one inside a sentence, and any window.
SENTENCE, INSIDE, WINDOW = 4, 32, 8
#: Ids that are placed at a time, windows after which settled ones are looked for, and windows that may stay open.
STEP, SETTLE, MOST = 100_000, 64, 1024

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
COLUMNS = [field.split()[0] for field in PIECE.split(", ")]


class Sentences:
    """Where sentences end, by what the ids on both sides of a place look like."""

    def __init__(self, path: str):
        file = encoder(ByteEncoder, path)
        vocabulary = {file.plain.encoding.encode_single_token(raw): raw for raw in file.plain.encoding.token_byte_values()}
        size = max(file.tokenizer.get_vocab().values()) + 1  # added tokens are no ends
        self.stop, self.space = np.zeros(size, bool), np.zeros(size, bool)
        self.line, self.full = np.zeros(size, bool), np.zeros(size, bool)
        for token, raw in vocabulary.items():
            text = raw.decode(errors="replace")
            end = text.rstrip("\"')]}”’»")
            self.stop[token] = end.endswith((".", "!", "?", "…"))
            self.full[token] = end.endswith(("。", "！", "？"))
            self.space[token] = text[:1].isspace()
            self.line[token] = "\n" in text

    def __call__(self, ids: np.ndarray) -> np.ndarray:
        """Places after which a sentence or line has ended, without the two ends of the text."""
        left, right = ids[:-1], ids[1:]
        ends = self.stop[left] & self.space[right] | self.full[left] | self.line[left] & ~self.line[right]
        return np.flatnonzero(ends) + 1


def sentences(path: str) -> Sentences:
    state = worker_state()
    if getattr(state, "sentences_path", None) != path:
        state.sentences, state.sentences_path = Sentences(path), path
    return state.sentences


def cuts(ends: np.ndarray, n: int, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where a document of n ids may be cut, its end among them, and their penalties.

    ``ends`` are its sentences' ends. A sentence of more than a sixteenth of a window may be cut inside.
    """
    longest = max(1, capacity // 16)
    step = max(1, longest // 8)
    edges = np.concatenate([[0], ends, [n]])
    gaps = np.diff(edges)
    penalties = np.full(len(ends) + 1, SENTENCE)
    penalties[-1] = 0
    long = np.flatnonzero(gaps > longest)
    if not len(long):
        return edges[1:], penalties
    inside = np.concatenate([np.arange(edges[g] + step, edges[g + 1], step) for g in long])
    places = np.concatenate([edges[1:], inside])
    penalties = np.concatenate([penalties, np.full(len(inside), INSIDE)])
    order = np.argsort(places, kind="stable")
    return places[order], penalties[order]


class Cutter:
    """Least-cost windows over a stream of cuts that grows."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.powers = [1 << k for k in range(capacity.bit_length()) if 1 << k < capacity]
        self.place, self.penalty, self.cost, self.back = [0], [0], [0], [-1]
        self.queue = deque([0])  # cuts by falling use: their cost + place rises

    def extend(self, places: np.ndarray, penalties: np.ndarray) -> None:
        """Add cuts, by rising place; no two neighbours are further apart than a window."""
        if not len(places):
            return
        place, cost, back, queue, capacity = self.place, self.cost, self.back, self.queue, self.capacity
        first, base = len(place), int(places[0]) - capacity
        place.extend(places.tolist())
        self.penalty.extend(penalties.tolist())
        # Which cut lies at a place, for those that are near enough.
        at = np.full(int(places[-1]) - base + 1, -1)
        near = first
        while near and place[near - 1] >= base:
            near -= 1
        at[np.array(place[near:]) - base] = np.arange(near, len(place))
        exact: list[list[int] | None] = [None] * len(places)
        for power in self.powers:
            found = at[places - power - base]
            for j in np.flatnonzero(found >= 0).tolist():
                if exact[j] is None:
                    exact[j] = []
                exact[j].append(int(found[j]))
        for j, (here, penalty, ways) in enumerate(zip(place[first:], self.penalty[first:], exact), first):
            while place[queue[0]] < here - capacity:
                queue.popleft()
            best = queue[0]
            least = cost[best] + place[best] + capacity - here
            if ways:
                for i in ways:
                    if cost[i] < least:
                        least, best = cost[i], i
            least += penalty + WINDOW
            cost.append(least)
            back.append(best)
            while queue and cost[queue[-1]] + place[queue[-1]] > least + here:
                queue.pop()
            queue.append(j)

    def settled(self) -> list[int]:
        """Ends of the windows that no further cut can change; they are forgotten, but for the last."""
        place, back = self.place, self.back
        start = len(place)
        while start and place[start - 1] >= place[-1] - self.capacity:
            start -= 1
        # The ways back from all cuts that a window may begin at, latest first, until they are one.
        ways = [-i for i in range(start, len(place))]
        heapq.heapify(ways)
        while True:
            common = -heapq.heappop(ways)
            while ways and -ways[0] == common:
                heapq.heappop(ways)
            if not ways:
                break
            heapq.heappush(ways, -back[common])
        ends = self._ends(common)
        self._forget(common)
        return ends

    def decide(self) -> list[int]:
        """Ends of the windows to the cut that a full window would go on from; later cuts start there."""
        cut = self.queue[0]
        ends, later = self._ends(cut), slice(cut + 1, None)
        places, penalties = np.array(self.place[later], np.int64), np.array(self.penalty[later], np.int64)
        self.place, self.penalty, self.cost, self.back, self.queue = [self.place[cut]], [0], [0], [-1], deque([0])
        self.extend(places, penalties)
        return ends

    def finish(self) -> list[int]:
        """Ends of the windows that are left."""
        return self._ends(len(self.place) - 1)

    def _ends(self, cut: int) -> list[int]:
        ends = []
        while cut > 0:
            ends.append(self.place[cut])
            cut = self.back[cut]
        return ends[::-1]

    def _forget(self, cut: int) -> None:
        """``cut`` becomes the first one; earlier cuts are on no way to a later end."""
        if not cut:
            return
        less = self.cost[cut]
        self.place, self.penalty = self.place[cut:], self.penalty[cut:]
        self.cost = [c - less for c in self.cost[cut:]]
        self.back = [max(b - cut, -1) for b in self.back[cut:]]
        self.back[0] = -1
        self.queue = deque(i - cut for i in self.queue if i >= cut)


class Stream:
    """Documents of one partition, cut into windows."""

    def __init__(self, capacity: int, first_sequence: int):
        self.cutter, self.capacity = Cutter(capacity), capacity
        self.docs: deque[tuple[int, int | None, bytes]] = deque()  # place, id and ids of those not yet settled
        self.end, self.sequence, self.start = 0, first_sequence, 0
        self.cuts: list[tuple[np.ndarray, np.ndarray]] = []
        self.fresh = 0

    def add(self, doc_id: int | None, ids: bytes, ends: np.ndarray) -> Iterator[tuple]:
        n = len(ids) // 4
        places, penalties = cuts(ends, n, self.capacity)
        self.cuts.append((places + self.end, penalties))
        self.docs.append((self.end, doc_id, ids))
        self.end += n
        self.fresh += n
        if self.fresh >= STEP:
            self._extend()
            if self.end - self.start > SETTLE * self.capacity:
                yield from self._pieces(self.cutter.settled())
            if self.end - self.start > MOST * self.capacity:
                yield from self._pieces(self.cutter.decide())

    def finish(self) -> Iterator[tuple]:
        self._extend()
        yield from self._pieces(self.cutter.finish())

    def _extend(self) -> None:
        if self.cuts:
            self.cutter.extend(np.concatenate([c[0] for c in self.cuts]), np.concatenate([c[1] for c in self.cuts]))
            self.cuts, self.fresh = [], 0

    def _pieces(self, ends: list[int]) -> Iterator[tuple]:
        for end in ends:
            at = self.start
            while at < end:
                place, doc_id, ids = self.docs[0]
                doc_end = place + len(ids) // 4
                stop = min(end, doc_end)
                crc = zlib.crc32(memoryview(ids)[4 * (at - place) : 4 * (stop - place)])
                yield doc_id, at - place, stop - at, crc, len(ids) // 4, self.sequence, at - self.start
                if stop == doc_end:
                    self.docs.popleft()
                at = stop
            self.start = end
            self.sequence += 1


def pack_in_order(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 1) -> DataFrame:
    """Pieces of all documents with their places in sequences of at most ``capacity`` ids.

    ``docs`` needs ``doc_id`` and ``text``; more columns are ignored. Each partition is packed by itself, in the order
    of its rows, while it is scanned; nothing is shuffled. Sequences have no gaps, and no id is left out.
    A NULL or empty text is its end id alone. Rows with one id, NULL too, are documents of their own. An empty table
    gives no rows. A partition's last sequence may be short.
    """
    if not 1 <= capacity < 1 << 30:
        raise ValueError("capacity must be from 1 to 2 ** 30")
    kinds = [pa.int64()] * len(COLUMNS)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, end = encoder(ByteEncoder, tokenizer).encode, struct.pack("<I", end_id)
        sentence_ends = sentences(tokenizer)
        stream = Stream(capacity, TaskContext.get().partitionId() << 40)
        rows: list[tuple] = []
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for at in range(0, len(doc_ids), 64):
                for doc_id, raw in zip(doc_ids[at : at + 64], encode(utf8(batch.column(1).slice(at, 64)))):
                    ends = sentence_ends(np.frombuffer(raw, np.uint32)) if raw else np.zeros(0, np.int64)
                    rows.extend(stream.add(doc_id, raw + end, ends))
                if len(rows) >= 10_000:
                    yield _batch(rows, kinds)
                    rows = []
        rows.extend(stream.finish())
        if rows:
            yield _batch(rows, kinds)

    return map_texts(docs.select("doc_id", "text"), pieces, PIECE)


def _batch(rows: list[tuple], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], COLUMNS)
