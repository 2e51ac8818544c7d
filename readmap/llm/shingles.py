"""Words and word shingles of texts as 64-bit hashes."""

import numpy as np

from readmap.llm.common import worker_state

#: Words whose hashes a Python worker remembers; beyond, it starts afresh.
REMEMBERED = 200_000


def word_hashes(text: bytes) -> np.ndarray:
    """Hashes of the words between ASCII white space, with A-Z in lower case."""
    state = worker_state()
    memo = getattr(state, "word_hashes", None)
    if memo is None or len(memo) > REMEMBERED:
        import xxhash

        class Memo(dict):
            def __missing__(self, word):
                self[word] = value = xxhash.xxh64_intdigest(word)
                return value

        memo = state.word_hashes = Memo()
    words = text.lower().split()
    return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads each bit over all."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def rows_of(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words."""
    out = np.zeros(len(words) - size + 1, np.uint64)
    for word in range(size):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + words[word : len(words) - size + 1 + word])
    return out


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Distinct shingles, sorted. A text with fewer words has one, its whole sequence; without words, none."""
    if not len(words):
        return words
    if len(words) < size:
        return rows_of(words, len(words)) ^ np.uint64(len(words))
    return np.unique(rows_of(words, size))
