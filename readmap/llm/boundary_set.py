"""A compressed set of positions that answers "which is the k-th": containers as in Roaring bitmaps.

Positions are dealt by their high bits into containers of 65,536. Each container has the smallest of three
forms: the sorted low bits (array), one bit per position (bitmap), or first and length of each stretch (runs).
Cumulative cardinalities say which container has the k-th member; the container then selects among its own.
"""

import numpy as np

CHUNK = 1 << 16


class Array:
    def __init__(self, bits: np.ndarray):
        self.values = np.flatnonzero(bits).astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.values[k])


class Bitmap:
    def __init__(self, bits: np.ndarray):
        padded = np.zeros(CHUNK, bool)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def select(self, k: int) -> int:
        word = int(np.searchsorted(self.before, k, "right")) - 1
        rest = int(self.words[word])
        for _ in range(k - int(self.before[word])):
            rest &= rest - 1
        return 64 * word + (rest & -rest).bit_length() - 1


class Runs:
    def __init__(self, bits: np.ndarray):
        edges = np.diff(np.concatenate([[0], bits.astype(np.int8), [0]]))
        self.firsts = np.flatnonzero(edges == 1)
        self.before = np.concatenate([[0], np.cumsum(np.flatnonzero(edges == -1) - self.firsts)])

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, "right")) - 1
        return int(self.firsts[run] + k - self.before[run])


class BoundarySet:
    """Made from a mask: position p is a member where ``mask[p]``."""

    def __init__(self, mask: np.ndarray):
        self.containers: list[Array | Bitmap | Runs] = []
        sizes = []
        for start in range(0, len(mask), CHUNK):
            bits = mask[start : start + CHUNK]
            members = int(np.count_nonzero(bits))
            runs = int(np.count_nonzero(bits[1:] & ~bits[:-1])) + bool(bits[0])
            # Bytes that each form takes.
            forms = ((2 * members, Array), (CHUNK // 8, Bitmap), (4 * runs, Runs))
            self.containers.append(min(forms, key=lambda form: form[0])[1](bits))
            sizes.append(members)
        self.before = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, k: int) -> int:
        """The k-th member, from 0."""
        if not 0 <= k < len(self):
            raise IndexError(k)
        chunk = int(np.searchsorted(self.before, k, "right")) - 1
        return CHUNK * chunk + self.containers[chunk].select(k - int(self.before[chunk]))
