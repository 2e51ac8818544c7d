"""Benchmark passages in documents, by q-gram lemma filtering and banded alignment.

Texts are compared as bytes, with A-Z in lower case and every run of other ASCII characters than letters and
digits as one space. A passage of m bytes with at most e edits keeps at least m + 1 - q (e + 1) of the
item's q-grams, on e + 1 neighbouring diagonals (place in the text less place in the item). Diagonals are
dealt into bands of 2 (e + 1) that overlap by half, so one band has all of them. A band with fewer shared
q-grams than that is out; of the others, the region of text is aligned with the item inside the band.

An item is looked for as a whole, unless it is very long, and, if it is long, in overlapping passages of ``PASSAGE`` bytes, each with the same
bands and alignment, so that a part of an item is found as well. Whatever stretch of an item has one and a half times
``PASSAGE`` bytes holds a whole passage.

The benchmark goes to the tasks in blocks of bounded size; each block is a pass over the documents, which are
never shuffled.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readmap.llm.common import map_texts
from readmap.llm.tokens import utf8

Q = 10
#: Edits per byte of an item.
EDIT_RATE = 0.08
#: Bytes of a passage, of which the next one begins half as far on, and words that an item must have to be looked for.
PASSAGE, LEAST_WORDS = 100, 3
#: Bytes of an item beyond which it is looked for by its passages alone: aligning it whole would take memory and time
#: that grow with the square of its length.
LONGEST_WHOLE = 2000
#: Bytes of items whose q-grams are sent to the tasks at a time (16 bytes for each).
BLOCK_BYTES = 2_000_000
#: Places that are hashed at a time, regions that are aligned at a time.
STEP, ALIGNED = 1 << 20, 512

FOUND = "doc_id long, item_id long, start long, end long, edits int, share double, passage string"


def normalised(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Bytes to compare, and the place of each in the text."""
    raw = np.frombuffer(text, np.uint8)
    letter = raw | 0x20
    word = (raw >= 128) | ((raw >= 48) & (raw <= 57)) | ((letter >= 97) & (letter <= 122))
    out = np.where(word, np.where((raw >= 65) & (raw <= 90), letter, raw), np.uint8(32))
    keep = word.copy()
    keep[1:] |= word[:-1]  # the first character of each run of others
    if len(keep):
        keep[0] = word[0]
        last = len(keep) - 1 - int(np.argmax(word[::-1])) if word.any() else -1
        keep[last + 1 :] = False
    places = np.flatnonzero(keep)
    return out[places], places


def gram_hashes(raw: np.ndarray, size: int) -> np.ndarray:
    """Hash of the bytes from each place on; places without so many bytes have none."""
    if len(raw) < size:
        return np.zeros(0, np.uint64)
    # Runs of 1, 2, 4, ... bytes, put together as the size needs them; the first byte weighs least.
    run, width, total, done = raw.astype(np.uint64) + np.uint64(1), 1, None, 0
    while True:
        if size & width:
            if total is None:
                total = run
            else:
                total = total[: len(run) - done] + run[done:] * _power(done)
            done += width
        if done == size:
            return total[: len(raw) - size + 1]
        run = run[:-width] + run[width:] * _power(width)
        width *= 2


def _power(exponent: int) -> np.uint64:
    return np.uint64(pow(0x9E3779B97F4A7C15, exponent, 1 << 64))


@dataclass(frozen=True)
class Grams:
    """q-grams of items, in order of their hash."""

    size: int
    seen: np.ndarray  # by the hash's high bits: is there any?
    hashes: np.ndarray
    firsts: np.ndarray
    items: np.ndarray
    places: np.ndarray

    def hits(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place in the text, item and place in the item, for each shared q-gram."""
        texts, items, places = [], [], []
        for start in range(0, len(raw), STEP):
            found = gram_hashes(raw[start : start + STEP + self.size - 1], self.size)
            some = np.flatnonzero(self.seen[high_bits(found)])
            at = np.searchsorted(self.hashes, found[some])
            at[at == len(self.hashes)] = 0
            same = self.hashes[at] == found[some]
            some, at = some[same], at[same]
            n = self.firsts[at + 1] - self.firsts[at]
            ends = np.cumsum(n)
            spread = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - n, n) + np.repeat(self.firsts[at], n)
            texts.append(np.repeat(some + start, n))
            items.append(self.items[spread])
            places.append(self.places[spread])
        return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (texts, items, places))


def high_bits(hashes: np.ndarray) -> np.ndarray:
    return (hashes * np.uint64(0xC4CEB9FE1A85EC53)) >> np.uint64(42)


def _grams(texts: list[np.ndarray], chosen: list[int], size: int) -> Grams:
    hashes = [gram_hashes(texts[i], size) for i in chosen]
    items = np.repeat(np.array(chosen, np.int64), [len(h) for h in hashes])
    places = np.concatenate([np.arange(len(h)) for h in hashes])
    hashes = np.concatenate(hashes)
    order = np.argsort(hashes, kind="stable")
    unique, firsts = np.unique(hashes[order], return_index=True)
    seen = np.zeros(1 << 22, bool)
    seen[high_bits(unique)] = True
    return Grams(size, seen, unique, np.append(firsts, len(hashes)), items[order], places[order])


def enough_words(form: np.ndarray) -> bool:
    """Is a normalised item long enough to be looked for?"""
    return len(form) > 0 and int((form == 32).sum()) + 1 >= LEAST_WORDS


def passages(size: int) -> list[int]:
    """Where the passages of an item begin; the last one ends with it."""
    return [*range(0, size - PASSAGE, PASSAGE // 2), size - PASSAGE]


def _at_words(raw: np.ndarray, start: int, end: int) -> bool:
    return (start == 0 or raw[start - 1] == 32) and (end == len(raw) or raw[end] == 32)


class Index:
    """Items of one block, as parts to look for: each item whole, then its passages."""

    def __init__(self, items: list[tuple[int | None, bytes]], rate: float = EDIT_RATE, q: int = Q):
        self.ids = [item_id for item_id, _ in items]
        forms = [normalised(text)[0] for _, text in items]
        self.sizes = [len(form) for form in forms]
        # Owner, first and end byte of each part.
        sizes = [n if enough_words(form) else 0 for n, form in zip(self.sizes, forms)]
        self.parts = [(k, 0, n if n <= LONGEST_WHOLE else 0) for k, n in enumerate(sizes)]
        self.parts += [(k, a, a + PASSAGE) for k, n in enumerate(sizes) if n > PASSAGE for a in passages(n)]
        self.texts = [forms[k][a:b] for k, a, b in self.parts]
        self.lengths = np.array([len(t) for t in self.texts], np.int64)
        # So few edits that whole q-grams must be left; an item shorter than one is searched as it is.
        self.edits = np.clip(np.minimum((rate * self.lengths).astype(np.int64), self.lengths // q - 1), 0, None)
        sizes = np.minimum(self.lengths, q)
        self.least = self.lengths + 1 - sizes * (self.edits + 1)
        self.grams = [_grams(self.texts, np.flatnonzero(sizes == s).tolist(), s) for s in sorted({*sizes.tolist()} - {0})]

    def find(self, texts: list[bytes]) -> list[tuple[int, int, int, int, int, float]]:
        """Text, item, first byte, end byte, edits and share of the item for each region that is one, or a part of one.

        Of regions that are whole items and overlap, the one with the fewest edits counts. Passages of one item that
        overlap in the text are one region, with the edits of the worst passage, unless they lie in a whole item. An item
        that may have no edits has to begin and end with a word.
        """
        forms = [normalised(text) for text in texts]
        bounds = np.cumsum([0, *(len(raw) + 1 for raw, _ in forms)])
        joined = np.zeros(bounds[-1], np.uint8)  # a zero, which no item has, ends each text
        for (raw, _), start in zip(forms, bounds):
            joined[start : start + len(raw)] = raw
        regions = [self._regions(joined, bounds, grams) for grams in self.grams]
        regions = np.concatenate(regions) if regions else np.zeros((0, 3), np.int64)
        whole: dict[tuple[int, int], list] = {}
        pieces: dict[tuple[int, int], list] = {}
        for text, part, start, end, edits in self._align(joined, bounds, regions):
            item = self.parts[part][0]
            if part >= len(self.ids):
                pieces.setdefault((text, item), []).append((start, end, edits, part))
            elif self.edits[part] or _at_words(forms[text][0], start, end):
                whole.setdefault((text, item), []).append((edits, start, end))
        found = []
        for key in sorted({*whole, *pieces}):
            kept: list[tuple[int, int, int, float]] = []
            for edits, start, end in sorted(whole.get(key, ())):
                if not any(start < b and a < end for a, b, _, _ in kept):
                    kept.append((start, end, edits, 1.0))
            kept += [r for r in self._merged(pieces.get(key, ()), key[1]) if not any(r[0] < b and a < r[1] for a, b, _, _ in kept)]
            places = forms[key[0]][1]
            found += [(*key, int(places[a]), int(places[b - 1]) + 1, edits, share) for a, b, edits, share in kept]
        return found

    def _merged(self, pieces, item: int) -> list[tuple[int, int, int, float]]:
        """Passages of an item in a text as regions: start, end, edits, share of the item."""
        merged: list[tuple[int, int, int, list]] = []
        for start, end, edits, part in sorted(pieces):
            if merged and start < merged[-1][1]:
                first, last, most, parts = merged.pop()
                merged.append((first, max(last, end), max(most, edits), [*parts, part]))
            else:
                merged.append((start, end, edits, [part]))
        out = []
        for start, end, edits, parts in merged:
            seen = np.zeros(self.sizes[item], bool)
            for part in parts:
                seen[self.parts[part][1] : self.parts[part][2]] = True
            out.append((start, end, edits, float(seen.mean())))
        return out

    def _regions(self, joined: np.ndarray, bounds: np.ndarray, grams: Grams) -> np.ndarray:
        """Text, item and first diagonal of each band with enough shared q-grams."""
        place, item, at = grams.hits(joined)
        text = np.searchsorted(bounds, place, side="right") - 1
        width = self.edits[item] + 1
        diagonal = place - bounds[text] - at + self.lengths[item]  # never negative
        band = diagonal // width
        pair = text * len(self.parts) + item
        # Bands [b, b + 2) widths: a hit is in its own and the one before.
        keys = np.concatenate([pair, pair]), np.concatenate([band, np.maximum(band - 1, 0)])
        order = np.lexsort(keys[::-1])
        pair, band = keys[0][order], keys[1][order]
        new = np.flatnonzero(np.concatenate([[True], (pair[1:] != pair[:-1]) | (band[1:] != band[:-1])])) if len(pair) else order
        counts = np.diff(np.append(new, len(pair)))
        pair, band = pair[new], band[new]
        item = pair % len(self.parts)
        enough = counts >= self.least[item]
        pair, band, item = pair[enough], band[enough], item[enough]
        first = band * (self.edits[item] + 1) - self.lengths[item]
        return np.stack([pair // len(self.parts), item, first], axis=1)

    def _align(self, joined, bounds, regions) -> Iterator[tuple[int, int, int, int, int]]:
        regions = regions[np.argsort(self.lengths[regions[:, 1]], kind="stable")]
        for start in range(0, len(regions), ALIGNED):
            text, item, first = regions[start : start + ALIGNED].T
            edits = self.edits[item]
            # Start and end of the passage may leave the band's diagonals by the edits.
            low, width = first - edits, int(4 * edits.max() + 3)
            places = bounds[text] + low
            ends = bounds[text + 1]
            best, last = self._distances(joined, places, bounds[text], ends, item, width, 1)
            good = np.flatnonzero(best <= edits)
            if not len(good):
                continue
            stop = places[good] + self.lengths[item[good]] + last[good]  # where the passage ends
            back, extra = self._distances(joined, stop, bounds[text[good]], ends[good], item[good], width, -1)
            for i, end, more, distance in zip(good.tolist(), stop.tolist(), extra.tolist(), best[good].tolist()):
                base = int(bounds[text[i]])
                length = int(self.lengths[item[i]]) + more
                yield int(text[i]), int(item[i]), end - length - base, end - base, distance

    def _distances(self, joined, places, starts, ends, item, width, step):
        """Least edits of whole items, and the diagonal they end on.

        Forward, the passage begins on any diagonal from ``places`` on. Backward, it ends at ``places``, the item is
        read from its end, and diagonals count from ``-(width // 2)``, the change in length.
        """
        lengths = self.lengths[item]
        longest = int(lengths.max())
        patterns = np.zeros((len(item), longest), np.uint8)
        for i, k in enumerate(item.tolist()):
            patterns[i, : lengths[i]] = self.texts[k][::step]
        offset = np.arange(width) - (0 if step > 0 else width // 2)
        rank = np.arange(width, dtype=np.int32)
        far = np.int32(1 << 20)
        row = np.zeros((len(item), width), np.int32) if step > 0 else np.tile(np.where(offset >= 0, offset, far).astype(np.int32), (len(item), 1))
        result = np.full((len(item), width), far, np.int32)
        for i in range(longest):
            at = places[:, None] + step * (i + offset) - (step < 0)
            inside = (at >= starts[:, None]) & (at < ends[:, None] - 1)
            seen = joined[np.where(inside, at, 0)]
            now = row + ((seen != patterns[:, i : i + 1]) | ~inside)
            now[:, :-1] = np.minimum(now[:, :-1], row[:, 1:] + 1)
            if step < 0:
                now[:, offset == -(i + 1)] = np.minimum(now[:, offset == -(i + 1)], i + 1)
            row = np.minimum.accumulate(now - rank, axis=1) + rank
            ended = lengths == i + 1
            result[ended] = row[ended]
        if step < 0:
            result = np.where(result < far, result, far)
        last = result.argmin(axis=1)
        return result[np.arange(len(item)), last], offset[last]


def contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = EDIT_RATE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Regions of whole documents that are a benchmark item, or passages of one, within ``rate`` edits per byte.

    ``docs`` needs ``doc_id`` and ``text``, ``benchmark`` needs ``item_id`` and ``text``. Returns ``doc_id,
    item_id, start, end`` (code points of the text), ``edits``, the ``share`` of the item that was found (1 for whole
    items), and the ``passage``; for one document row and item, regions do not overlap. NULL and empty texts match nothing, nor do
    items of fewer than ``LEAST_WORDS`` words, which any text might have (``items_left_out`` lists them). Equal rows
    of ``benchmark`` count once; other rows, NULL ids too, stand for themselves. Empty tables give no rows.
    """
    docs, found = docs.select("doc_id", "text"), None
    for index in _indexes(benchmark, rate, block_bytes):
        one = map_texts(docs, _search(index), FOUND)
        found = one if found is None else found.unionByName(one)
    return found


def items_left_out(benchmark: DataFrame) -> DataFrame:
    """``item_id, text`` of the items that are too short to be looked for; NULL texts among them."""

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([not enough_words(normalised(text)[0]) for text in utf8(batch.column(1))], pa.bool_()))

    items = benchmark.select("item_id", "text")
    return map_texts(items, short, items.schema)


def without_contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = EDIT_RATE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs``, with all columns, without the rows in which ``contaminated`` finds a region."""
    for index in _indexes(benchmark, rate, block_bytes):
        docs = map_texts(docs, _clean(index), docs.schema)
    return docs


def _indexes(benchmark: DataFrame, rate: float, block_bytes: int) -> Iterator[Broadcast]:
    """Broadcast indexes, each of about ``block_bytes`` of items."""
    items = benchmark.select("item_id", "text").filter("text IS NOT NULL").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    for block in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        rows = sorted(((r.item_id, r.text.encode()) for r in part), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        yield benchmark.sparkSession.sparkContext.broadcast(Index(rows, rate))


def _clean(shared):
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            keep = np.ones(len(texts), bool)
            for start in range(0, len(texts), 500):
                keep[[start + found[0] for found in shared.value.find(utf8(texts.slice(start, 500)))]] = False
            yield batch.filter(pa.array(keep))

    return clean


def _search(shared):
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int32()), ("share", pa.float64()), ("passage", pa.string())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for start in range(0, len(doc_ids), 500):
                part, columns = utf8(batch.column(1).slice(start, 500)), [[] for _ in schema]
                for text, item, first, end, edits, share in index.find(part):
                    raw = part[text]
                    # A region begins and ends with whole characters, or takes those it cuts.
                    while first and raw[first] & 0xC0 == 0x80:
                        first -= 1
                    while end < len(raw) and raw[end] & 0xC0 == 0x80:
                        end += 1
                    passage = raw[first:end].decode()
                    before = len(raw[:first].decode())
                    row = (doc_ids[start + text], index.ids[item], before, before + len(passage), edits, share, passage)
                    for column, value in zip(columns, row):
                        column.append(value)
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return search
