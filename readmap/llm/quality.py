"""Quality classifier: supervised subword embeddings.

A text's features are its words, the runs of 3 to 4 code points of its words with their borders, and pairs of
neighbouring words, hashed into buckets; a word that stands twice in a row is one and the same feature for all words. Each bucket has a learned vector; a text is the average of its
features' vectors, and a softmax over that average gives the classes. Vectors and output weights are trained
together by stochastic gradient descent in numpy, on a bounded sample of labelled texts.

The average is linear, so that scoring needs one number for each bucket and class, the bucket's vector times the
output weights, and never the vectors themselves.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from readmap.llm.common import map_texts
from readmap.llm.shingles import mixed
from readmap.llm.tokens import each_utf8, utf8

BUCKETS = 1 << 18
DIMENSIONS = 12
EPOCHS = 8
RATE = 0.5
#: Labelled texts that a model is fitted on, at most: those with the smallest hash of the id, equally many of each class if there are.
SAMPLE_ROWS = 2_000
#: Features without meaning that every text has besides its own, so that short texts stay near the average.
BLANKS = 20
NGRAMS = (3, 4)
THRESHOLD = 0.3
#: Bytes that are hashed at a time.
PIECE = 1 << 20


def features(text: bytes) -> np.ndarray:
    """Bucket of each feature of a whole text; a text without words has none."""
    found = [_piece_features(text[a:b]) for a, b in _pieces(text)]
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def _pieces(text: bytes) -> Iterator[tuple[int, int]]:
    """Cuts of a long text at white space; a word beyond ``PIECE`` bytes is cut where it stands."""
    start = 0
    while start < len(text):
        end = len(text)
        if end - start > PIECE:
            space = max(text.rfind(s, start, start + PIECE) for s in (b" ", b"\n"))
            end = space + 1 if space > start else start + PIECE
            while text[end] & 0xC0 == 0x80:  # never inside a code point
                end -= 1
        yield start, end
        start = end


def _piece_features(text: bytes) -> np.ndarray:
    raw = np.frombuffer(f" {text.decode('utf-8', 'replace')} ".encode("utf-32-le"), np.uint32)
    space = (raw <= 32)
    # One border between words, whatever white space there is.
    keep = ~(space[1:] & space[:-1])
    raw = np.where(space, np.uint32(32), raw)[np.concatenate([[True], keep])].astype(np.uint64)
    if len(raw) < 3:
        return np.zeros(0, np.int64)
    space = raw == 32
    borders = np.flatnonzero(space)
    powers = np.uint64(0x9E3779B97F4A7C15)
    grams, out = raw.copy(), []
    inside = np.cumsum(space)
    for size in range(2, max(NGRAMS) + 1):
        grams = grams[:-1] * powers + raw[size - 1 :]
        if size in NGRAMS:
            # A border may stand first or last, but not in between.
            within = inside[size - 2 : len(raw) - 1] == inside[: len(raw) - size + 1]
            out.append(mixed(grams[within] + np.uint64(size)))
    words = np.add.reduceat(mixed(raw * powers + _place(raw, borders))[:-1], borders[:-1]) if len(borders) > 1 else raw[:0]
    out.append(mixed(words))
    if len(words) > 1:
        pairs = mixed(words[:-1] * powers + words[1:])
        out.append(np.where(words[:-1] == words[1:], np.uint64(1), pairs))
    return (np.concatenate(out) % np.uint64(BUCKETS)).astype(np.int64)


def _place(raw: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Place of each code point in its word, spread over 64 bits."""
    starts = np.zeros(len(raw), np.int64)
    starts[borders] = borders
    place = np.arange(len(raw)) - np.maximum.accumulate(starts)
    return (place.astype(np.uint64) + np.uint64(1)) << np.uint64(20)


@dataclass(frozen=True)
class Model:
    """For each bucket, how far it speaks for class 1 against class 0; ``bias`` is that of an empty text."""

    margins: np.ndarray
    bias: float

    def score(self, text: bytes) -> float:
        """Probability of class 1."""
        total, n = 0.0, 0
        for start, end in _pieces(text):
            found = _piece_features(text[start:end])
            total, n = total + float(self.margins[found].sum(dtype=np.float64)), n + len(found)
        margin = self.bias + total / (n + BLANKS)
        return 1 / (1 + float(np.exp(-np.clip(margin, -60, 60))))


def train(texts: list[bytes], labels: list[int], dimensions: int = DIMENSIONS, epochs: int = EPOCHS, rate: float = RATE, seed: int = 1) -> Model:
    """Fit vectors and softmax weights; each class weighs the same. Without texts, every score is 0.5."""
    random = np.random.default_rng(seed)
    vectors = ((random.random((BUCKETS, dimensions)) - 0.5) / dimensions).astype(np.float32)
    weights = np.zeros((2, dimensions), np.float32)
    bias = np.zeros(2, np.float32)
    bags = [_bag(text) for text in texts]
    counts = np.bincount(labels, minlength=2)
    share = len(texts) / np.maximum(counts, 1) / max(1, np.count_nonzero(counts))
    steps, step = epochs * len(bags), 0
    for _ in range(epochs):
        for i in random.permutation(len(bags)).tolist():
            buckets, n = bags[i]
            label, now = labels[i], rate * (1 - step / steps)
            step += 1
            shares = n / np.float32(n.sum() + BLANKS)
            average = shares @ vectors[buckets]
            logits = weights @ average + bias
            chances = np.exp(logits - logits.max())
            chances /= chances.sum()
            chances[label] -= 1
            chances *= now * min(float(share[label]), 10.0)
            if len(n):
                # Each feature's step is scaled up to what a text of a hundred features would give it.
                vectors[buckets] -= np.minimum(100 * shares, 1)[:, None] * (chances @ weights)[None, :]
            weights -= np.outer(chances, average)
            bias -= 0.1 * chances
    margins = vectors @ (weights[1] - weights[0])
    return Model(margins.astype(np.float32), float(bias[1] - bias[0]))


def _bag(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    buckets, n = np.unique(features(text).astype(np.int32), return_counts=True)
    return buckets, np.minimum(n, 65535).astype(np.uint16)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that no label is learned from: those with crc32(id as text) divisible by 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Train on labelled documents that are not held out.

    At most ``sample_rows`` texts reach the driver, by the smallest hashes of their ids, up to half of them of each
    class. Labels other than 0 and 1, NULL ids and NULL texts take no part. A document with several labels gives
    a text for each.
    """
    known = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).filter("quality IN (0, 1) AND doc_id IS NOT NULL")
    known = known.filter(~held_out()).withColumn("_order", F.xxhash64("doc_id"))
    half = sample_rows // 2
    chosen = [known.filter(F.col("quality") == label).orderBy("_order", "doc_id").limit(half) for label in (0, 1)]
    chosen = F.broadcast(chosen[0].unionByName(chosen[1]).drop("_order"))
    texts = docs.select("doc_id", "text").filter("text IS NOT NULL").join(chosen, "doc_id")
    rows = texts.orderBy(F.xxhash64("doc_id"), "doc_id", "quality", F.xxhash64("text")).limit(2 * half).select("text", "quality").toArrow()
    return train(utf8(rows["text"].combine_chunks()), rows["quality"].to_pylist())


def scored(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """``docs`` with the probability of class 1 of each whole text; NULL is scored as empty.

    A column of that name is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 4 bytes for each bucket, whatever the input

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [shared.value.score(text) for text in each_utf8(batch.column("text"))]
            yield batch.append_column(column, pa.array(values, pa.float64()))

    docs = docs.drop(column)
    return map_texts(docs, score, StructType([*docs.schema.fields, StructField(column, DoubleType())]))
