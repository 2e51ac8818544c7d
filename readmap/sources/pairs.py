"""Data source of read pairs: the two files of a run, walked in step.

Sequencers write both mates in the same order, so mates meet where they are read and nothing has to be shuffled.
File 1 is cut into splits as the ``fastq`` source cuts it. Where a split begins in file 2 is found by the name of its
first record, looked for around the place that lies as far into file 2 as the split lies in file 1; no file is
read beforehand to count its records, and records that one file lacks do not shift what follows. Whatever the
names, splits of file 2 follow each other and cover it: if the name is not found, the next record start is taken.

Within a split, records of equal name become one row. A record whose mate does not come by in time is a
row of its own, with NULLs for its mate (``readmap.operators.in_step`` looks for it elsewhere).
"""

import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from readmap import schemas
from readmap.sources import files
from readmap.sources.block_gzip import IG_HEADER_BYTES, group_blocks, is_block_gzip, load_index
from readmap.sources.fastq import (
    AT,
    BLOCK_SPLIT_BYTES,
    PLUS,
    READ_BYTES,
    FastqReader,
    FastqSplit,
    RecordParser,
    _codec,
    _decompressed,
    _line_ends,
    _raw,
    align,
)

#: Bytes of file 2 that are searched for a name on either side, and records that a record's mate may be late.
REACH, PATIENCE = 16 * files.MEBIBYTE, 100_000
#: Blocks of file 2 that are searched on either side.
BLOCKS = 32


_NOTHING = pa.table({name: pa.array([], pa.string()) for name in ("name", "sequence", "quality")})


class PairSplit(NamedTuple):
    """Place in file 1, and what is needed to find its place in file 2; ``number`` makes row numbers unique."""

    number: int
    uri1: str
    uri2: str
    size1: int
    size2: int
    kind: str  # "" plain, "blocks" indexed, otherwise both files whole
    start: int
    end: int
    step: int
    near: tuple  # for blocks: those of file 2 around the start, and around the end


class FastqPairsDataSource(DataSource):
    """``spark.read.format('fastq_pairs')``.

    Options: ``path1`` and ``path2``, files or folders with equally many files, which are pairs in the order of
    their names; ``qualityEncoding``, ``maxSplitBytes``, ``blockSplitBytes`` as for ``fastq``; ``namesOnly`` gives NULL
    sequences and qualities. A broken record fails.
    """

    @classmethod
    def name(cls) -> str:
        return "fastq_pairs"

    def schema(self):
        return schemas.READ_PAIR

    def reader(self, schema) -> "FastqPairsReader":
        option = self.options.get
        parser = FastqReader(
            path=option("path1"),
            encoding=option("qualityEncoding", "sanger").lower(),
            permissive=False,
            split_bytes=int(option("maxSplitBytes", 128 * files.MEBIBYTE)),
            block_split_bytes=int(option("blockSplitBytes", BLOCK_SPLIT_BYTES)),
        )
        if not option("path2"):
            raise ValueError("fastq_pairs needs path1 and path2")
        return FastqPairsReader(parser, option("path2"), option("namesOnly", "false").lower() == "true")


def file_pairs(path1: str, path2: str) -> list[tuple[files.SourceFile, files.SourceFile]]:
    """Files of both paths side by side; empty files stay, as the other one may hold records."""
    both = [files.list_files(path, skip=(".idx",)) for path in (path1, path2)]
    if len(both[0]) != len(both[1]):
        raise ValueError(f"{len(both[0])} files at {path1}, but {len(both[1])} at {path2}")
    return list(zip(*both))


class FastqPairsReader(DataSourceReader):
    def __init__(self, parser: FastqReader, path2: str, names_only: bool):
        self.parser, self.path2, self.names_only = parser, path2, names_only

    def partitions(self) -> list[InputPartition]:
        found = files.on_each(file_pairs(self.parser.path, self.path2), lambda pair: self._splits(*pair))
        splits = [split for splits in found for split in splits]
        return [InputPartition(tuple(split._replace(number=n))) for n, split in enumerate(splits)]

    def _splits(self, file1: files.SourceFile, file2: files.SourceFile) -> list[PairSplit]:
        kinds = [_kind(file) for file in (file1, file2)]
        whole = PairSplit(0, file1.uri, file2.uri, file1.size, file2.size, "whole", 0, file1.size, 0, ())
        if kinds == ["", ""] and file1.size and file2.size:
            step = self.parser.split_bytes
            return [whole._replace(kind="", start=a, end=b, step=step) for a, b in files.byte_ranges(file1.size, step)]
        if kinds != ["blocks", "blocks"]:
            return [whole] if file1.size or file2.size else []
        groups = group_blocks(load_index(file1.uri, file1.size), max_bytes=self.parser.block_split_bytes)
        blocks, starts = load_index(file2.uri, file2.size), [g.start for g in groups]
        edges = [*starts, file1.size]
        nears = [_near(blocks, edges, k, file1.size, file2.size) for k in range(len(edges))]
        return [
            whole._replace(kind="blocks", start=a, end=b, near=(nears[k], nears[k + 1]))
            for k, (a, b) in enumerate(zip(edges, edges[1:]))
        ]

    def read(self, partition: InputPartition):
        if partition is None:
            return
        split = PairSplit(*partition.value)
        with files.open_file(split.uri1) as one, files.open_file(split.uri2) as two:
            if split.kind == "":
                starts, ends = (_meet_plain(one, two, split, at) for at in (split.start, split.end))
                texts = _raw(one, starts[0], ends[0], READ_BYTES), _raw(two, starts[1], ends[1], READ_BYTES)
            elif split.kind == "blocks":
                starts, ends = (_meet_blocks(one, two, split, k) for k in (0, 1))
                texts = _text(one, split.uri1, starts[0], ends[0]), _text(two, split.uri2, starts[1], ends[1])
            else:
                starts, texts = ((0, 0), (0, 0)), [_whole(h, u, s) for h, u, s in ((one, split.uri1, split.size1), (two, split.uri2, split.size2))]
            sides = [
                RecordParser(self.parser, uri, _first(start)).batches(text)
                for uri, start, text in zip((split.uri1, split.uri2), starts, texts)
            ]
            walk = _Walk(split.number << 40, self.names_only)
            yield from walk.rows(*sides)


def _first(place) -> int:
    return place if isinstance(place, int) else place[0]


def _kind(file: files.SourceFile) -> str:
    if not file.size:
        return ""
    with files.open_file(file.uri) as handle:
        head = handle.read(IG_HEADER_BYTES)
    codec = _codec(file.uri, head)
    if codec == "gzip" and is_block_gzip(head) and files.exists(file.uri + ".idx"):
        return "blocks"
    return codec or ""


def _whole(handle, uri: str, size: int):
    with files.open_file(uri) as head:
        codec = _codec(uri, head.read(IG_HEADER_BYTES)) if size else None
    if codec is None:
        return _raw(handle, 0, size, READ_BYTES)
    return _decompressed(handle, FastqSplit(uri, 0, size, size, codec))


def _name_at(handle, start: int, size: int) -> bytes:
    """Normalised name of the record that starts there."""
    window = 4096
    while True:
        raw = handle.read_at(min(window, size - start), start)
        if b"\n" in raw or b"\r" in raw or start + window >= size:
            return _normalised(raw.splitlines()[0][1:])
        window *= 16


def _normalised(name: bytes) -> bytes:
    return name[:-2] if len(name) >= 2 and name[-2:-1] == b"/" and name[-1:].isdigit() else name


def _records_named(raw: bytes, name: bytes, at_end: bool, at_start: bool) -> int | None:
    """Where in the bytes the first record of that name starts, by the same rule as ``align``."""
    wanted, at = b"@" + name, raw.find(b"@" + name)
    data = None
    while at >= 0:
        if (at == 0 and at_start) or (at and raw[at - 1 : at] in (b"\n", b"\r")):
            line = raw[at : at + len(wanted) + 3].splitlines()[0]
            if data is None:
                data = np.frombuffer(raw, np.uint8)
            if _normalised(line[1:]) == name and _record_starts(data, at, at_end):
                return at
        at = raw.find(wanted, at + 1)
    return None


def _record_starts(data: np.ndarray, at: int, at_end: bool) -> bool:
    """Does a record start at this line? The second-next line tells; if it is not in the bytes, no."""
    window = 4096
    while True:
        some = data[at : at + window]
        starts = _line_ends(some, at_end and at + window >= len(data)) + 1
        starts = starts[starts < len(some)]
        if len(starts) >= 2:
            return bool(some[0] == AT and some[starts[1]] == PLUS)
        if at + window >= len(data):
            return False
        window *= 16


def _meet_plain(one, two, split: PairSplit, at: int) -> tuple[int, int]:
    """Places in both files of the split edge ``at``: the same for the splits on both sides of it."""
    size1, size2 = split.size1, split.size2
    if at <= 0:
        return 0, 0
    first = align(one, at, size1) if at < size1 else size1
    if at >= size1:
        return size1, size2
    guess = at * size2 // size1
    if first < size1:
        name = _name_at(one, first, size1)
        # Each edge has a part of file 2 to itself, so what edges find there rises with them.
        low = max((2 * at - split.step) * size2 // (2 * size1), 0)
        high = min((2 * at + split.step) * size2 // (2 * size1), size2)
        centre, reach = min(max(first * size2 // size1, low), high), 64 * 1024
        while True:
            begin, end = max(low, centre - reach), min(high, centre + reach)
            # A byte before, to see whether a line starts; some after, to see the record's third line.
            before, after = min(begin, 1), min(end + 64 * 1024, size2)
            raw = two.read_at(after - begin + before, begin - before)
            found = _records_named(raw, name, after == size2, begin == 0)
            if found is not None and begin <= begin - before + found < end:
                return first, begin - before + found
            if reach >= REACH or (begin == low and end == high):
                break
            reach *= 16
    return first, align(two, guess, size2)


def _near(blocks: np.ndarray, edges: list[int], k: int, size1: int, size2: int) -> tuple:
    """Blocks of file 2 that an edge between groups may search: those from half-way to the edge before on."""
    ends = (0, size1)
    if edges[k] in ends:
        place = 0 if edges[k] == 0 and k == 0 else size2
        return ((place, 0),)

    def half(a: int, b: int) -> int:
        return (a + b) * size2 // (2 * size1)

    low, high = half(edges[k - 1], edges[k]), half(edges[k], edges[k + 1])
    centre = int(np.searchsorted(blocks[:, 0], edges[k] * size2 // size1))
    first, last = np.searchsorted(blocks[:, 0], [low, high])
    # The first is where the split starts if the name is not found.
    order = sorted(range(max(first, centre - BLOCKS), min(last, centre + BLOCKS)), key=lambda b: abs(b - centre))
    start = int(blocks[centre, 0]) if centre < len(blocks) else size2
    return ((start, 0), *((int(blocks[b, 0]), int(blocks[b, 1])) for b in order))


def _meet_blocks(one, two, split: PairSplit, side: int) -> tuple[tuple[int, int], tuple[int, int]]:
    """The same for indexed files: start of a block, and bytes of its text before the record."""
    at = (split.start, split.end)[side]
    (place, _), *near = split.near[side]
    if not near:
        return (at, 0), (place, 0)
    with files.open_file(split.uri1) as handle:
        text = next(_decompressed(handle, FastqSplit(split.uri1, at, split.size1, split.size1, "blocks")))
    name = _normalised(text.splitlines()[0][1:])
    for start, length in near:
        raw = zlib.decompress(two.read_at(length, start), 31)
        found = _records_named(raw, name, True, True)
        if found is not None:
            return (at, 0), (start, found)
    return (at, 0), (place, 0)


def _text(handle, uri: str, start: tuple[int, int], end: tuple[int, int]):
    """Inflated text between two places; blocks begin with a record."""
    skip = start[1]
    if start[0] < end[0]:
        for piece in _decompressed(handle, FastqSplit(uri, start[0], end[0], end[0], "blocks")):
            if skip < len(piece):
                yield piece[skip:]
            skip = max(0, skip - len(piece))
    if end[1]:
        raw = zlib.decompressobj(31).decompress(_member(handle, end[0]))
        yield raw[skip : end[1]]


def _member(handle, start: int) -> bytes:
    head = handle.read_at(IG_HEADER_BYTES, start)
    return handle.read_at(int.from_bytes(head[16:20], "little"), start)


class _Walk:
    """Two streams of records, joined as they go by."""

    def __init__(self, first_row: int, names_only: bool):
        self.row, self.names_only = first_row, names_only

    def rows(self, left, right):
        """Rows of both streams; that which has given fewer records is read on.

        Records are compared place by place while the names agree. Where they do not, all at hand are compared by name;
        what finds no mate waits until the other stream is ``PATIENCE`` records past its place.
        """
        streams, done, seen, in_step = [left, right], [False, False], [0, 0], True
        held, places = [_NOTHING, _NOTHING], [np.zeros(0, np.int64)] * 2
        while True:
            for k in [k for k in (0, 1) if not done[k] and (seen[k] <= seen[1 - k] or done[1 - k])]:
                batch = next(streams[k], None)
                if batch is None:
                    done[k] = True
                    continue
                held[k] = pa.concat_tables([held[k], pa.Table.from_batches([batch]).drop_columns(["read_no"])])
                places[k] = np.concatenate([places[k], np.arange(seen[k], seen[k] + batch.num_rows)])
                seen[k] += batch.num_rows
            n = min(map(len, held))
            if not n and all(done) and not any(map(len, held)):
                return
            if in_step and n:
                same = pc.equal(*(t["name"].slice(0, n).combine_chunks() for t in held))
                equal = pc.index(same, False).as_py()
                equal = n if equal < 0 else equal
                if equal:
                    yield from self._paired(*(t.slice(0, equal) for t in held))
                    held, places = [t.slice(equal) for t in held], [p[equal:] for p in places]
                if equal == n:
                    continue
            if in_step and not n and not any(done[k] and not len(held[k]) for k in (0, 1)):
                continue
            mates = _mates(*(t["name"] for t in held))
            if len(mates[0]):
                yield from self._paired(*(t.take(pa.array(m)) for t, m in zip(held, mates)))
            for k in (0, 1):
                alone = np.ones(len(held[k]), bool)
                alone[mates[k]] = False
                late = alone & (done[1 - k] | (places[k] < seen[1 - k] - PATIENCE))
                if late.any():
                    yield from self._alone(k, held[k].filter(pa.array(late)))
                held[k], places[k] = held[k].filter(pa.array(alone & ~late)), places[k][alone & ~late]
            # In step again if only one stream has records left, and these are its last ones.
            ahead = [k for k in (0, 1) if len(held[k])]
            in_step = not ahead or len(ahead) == 1 and places[ahead[0]][0] == seen[ahead[0]] - len(held[ahead[0]])

    def _paired(self, one: pa.Table, two: pa.Table):
        yield from self._batches(one["name"], [one, two])

    def _alone(self, side: int, table: pa.Table):
        yield from self._batches(table["name"], [table, None] if side == 0 else [None, table])

    def _batches(self, names, sides: list[pa.Table | None]):
        n = len(names)
        columns = [names]
        for table in sides:
            columns.append(pa.repeat(pa.scalar(table is not None), n))
            for column in ("sequence", "quality"):
                nothing = table is None or self.names_only
                columns.append(pa.nulls(n, pa.string()) if nothing else table[column])
        columns.append(pa.array(np.arange(self.row, self.row + n)))
        self.row += n
        yield from pa.table(columns, names=schemas.READ_PAIR.names).to_batches()


def _mates(left: pa.ChunkedArray, right: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of records of equal name, each in one pair: the k-th of a name on the left with the k-th on the right."""
    names = pa.chunked_array([*left.chunks, *right.chunks], pa.string()).combine_chunks()
    codes = names.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    turns = [_turns(side) for side in (codes[: len(left)], codes[len(left) :])]
    _, one, two = np.intersect1d(*turns, assume_unique=True, return_indices=True)
    order = np.argsort(one)
    return one[order], two[order]


def _turns(codes: np.ndarray) -> np.ndarray:
    """A number for each record that tells its name, and the how many-th record of the name it is."""
    order = np.argsort(codes, kind="stable")
    ordered, places = codes[order].astype(np.int64), np.arange(len(codes))
    begins = np.ones(len(codes), bool)
    begins[1:] = ordered[1:] != ordered[:-1]
    turns = np.empty(len(codes), np.int64)
    turns[order] = (ordered << 32) + places - np.maximum.accumulate(np.where(begins, places, 0))
    return turns
