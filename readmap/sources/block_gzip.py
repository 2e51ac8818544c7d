"""Block gzip: members that carry their own compressed size, and the text index that lists them.

A member has an extra field ``IG`` of four bytes, the member's size. An index line holds, tab by tab,
a field that is not read, the member's offset and its size; lines that start with ``#`` are comments.
"""

import io
import struct
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd

from readmap.sources import files

# First bytes of a member up to the extra field (deflate, FEXTRA, no time, unknown
# system), then the length of the extra field, its id, and the length of its one entry.
_MEMBER_HEAD = b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff" + struct.pack("<H2sH", 8, b"IG", 4)
IG_HEADER_BYTES = len(_MEMBER_HEAD) + 4


@dataclass(frozen=True)
class BlockGroup:
    number: int
    start: int
    length: int


def is_block_gzip(head: bytes) -> bool:
    return head[:3] == b"\x1f\x8b\x08" and bool(head[3] & 4) and head[12:14] == b"IG"


def pack_member(data: bytes, level: int = 6) -> bytes:
    """One gzip member with its size in the extra field."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    size = IG_HEADER_BYTES + len(body) + 8
    tail = struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    return _MEMBER_HEAD + struct.pack("<I", size) + body + tail


def load_index(uri: str, size: int) -> np.ndarray:
    """Offset and size of each block of ``<uri>.idx``, one row per block.

    The blocks must follow each other and cover the file, which has ``size`` bytes.
    """
    raw = files.read_small(uri + ".idx")
    try:
        table = pd.read_csv(io.BytesIO(raw), sep="\t", comment="#", header=None, usecols=[1, 2], dtype=np.int64)
    except pd.errors.EmptyDataError:
        table = pd.DataFrame({1: [], 2: []}, dtype=np.int64)
    index = table.to_numpy().reshape(-1, 2)
    edges = np.concatenate([[0], np.cumsum(index[:, 1])])
    if not np.array_equal(edges[:-1], index[:, 0]) or edges[-1] != size:
        raise ValueError(f"index {uri}.idx does not cover the {size} bytes of its file block by block")
    return index


def member_size(head: bytes) -> int:
    """Size of the member that begins with these bytes; raises if they are no head of a member."""
    size = int.from_bytes(head[16:20], "little") if len(head) >= IG_HEADER_BYTES and is_block_gzip(head) else 0
    if size < IG_HEADER_BYTES + 8:
        raise ValueError("not an indexed gzip block")
    return size


def next_member(handle, offset: int, size: int) -> int:
    """First member start at or after an offset of a file, ``size`` at its end.

    Heads are looked for by their bytes. Since compressed data may look like one, a head counts if the size it
    states leads to another head, or to the end of the file.
    """
    window = 1 << 20
    while offset < size:
        raw = handle.read_at(min(window, size - offset), offset)
        at = raw.find(_MEMBER_HEAD[:3])
        while at >= 0:
            if _is_member(handle, offset + at, size):
                return offset + at
            at = raw.find(_MEMBER_HEAD[:3], at + 1)
        offset += max(1, len(raw) - 2)  # the last two bytes may begin a head
    return size


def _is_member(handle, offset: int, size: int) -> bool:
    for _ in range(2):
        try:
            offset += member_size(handle.read_at(min(IG_HEADER_BYTES, size - offset), offset))
        except ValueError:
            return False
        if offset >= size:
            break
    return offset <= size


def find_groups(handle, size: int, max_bytes: int) -> list[BlockGroup]:
    """The groups that ``group_blocks`` makes of a file's index, without the index: one search for each group."""
    groups, start = [], 0
    while start < size:
        end = next_member(handle, start + max_bytes, size) if start + max_bytes < size else size
        groups.append(BlockGroup(len(groups), start, end - start))
        start = end
    return groups


def group_blocks(index: np.ndarray, max_bytes: int | None = None, max_blocks: int | None = None):
    """Neighbouring blocks together: a group closes once it has ``max_bytes``, or ``max_blocks``."""
    ends = np.cumsum(index[:, 1])
    groups, first = [], 0
    while first < len(index):
        before = int(ends[first - 1]) if first else 0
        if max_blocks:
            after = min(first + max_blocks, len(index))
        else:
            after = min(int(np.searchsorted(ends, before + max_bytes)) + 1, len(index))
        groups.append(BlockGroup(len(groups), int(index[first, 0]), int(ends[after - 1]) - before))
        first = after
    return groups
