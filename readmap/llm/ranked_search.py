"""Ranked lexical search for many queries at once, by shared partial sums.

Each document's score for a query is the sum of what the query's terms weigh there. Queries have terms in common: sets of
terms that several queries hold are mined beforehand, as pairs of pairs, into a directed graph whose leaves are
terms, whose inner nodes are shared sets, and whose roots are queries. For a batch of documents, each node's sums
(one number per document) are computed once, from those of its two parts, and serve all queries above it.

Queries go to the tasks in blocks of bounded size. For each block, one scan of the documents counts the terms that the
block asks for, and writes them; the corpus' counts come from that table, and a second scan of it scores.
Each task keeps its best documents for each query, and these are merged in two steps.
"""

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from readmap.llm.common import map_texts, parked
from readmap.llm.tokens import each_utf8

#: Bytes of queries in a block, nodes that are paired with each other at a time, bytes of sums in memory.
BLOCK_BYTES, MINED, SUM_BYTES = 2_000_000, 2048, 64_000_000
#: Groups in which the tasks' best documents are merged first.
MERGE_GROUPS = 64
#: Terms in which sums of the largest possible weights stay below 2 ** 63.
MOST_TERMS = 1 << 22

COUNTED = "doc_id long, n long, terms array<int>, counts array<int>"
SCORED = "query long, doc_id long, score long"
RANKED = "item_id long, rank int, doc_id long, score long"

# A-Z in lower case; other ASCII characters than letters and digits part terms.
_SPACED = bytes(b | 0x20 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_SPACED).split()


@dataclass(frozen=True)
class Sharing:
    """Which sums to add: node ``terms + i`` is the sum of the nodes ``pairs[i]``, query q of those in ``roots[q]``."""

    terms: int
    pairs: list[tuple[int, int]]
    roots: list[list[int]]

    @property
    def additions(self) -> int:
        return len(self.pairs) + sum(max(0, len(r) - 1) for r in self.roots)


def share(queries: list[set[int]], terms: int) -> Sharing:
    """Mine the sets that several queries hold.

    In each round, those nodes that are each other's most frequent company, in at least two queries, become a new node that
    replaces both where both are. Nodes are looked at in blocks of ``MINED``, most frequent first, so memory is bounded.
    """
    pairs: list[tuple[int, int]] = []
    roots = [set(q) for q in queries]
    while True:
        often = Counter(node for nodes in roots for node in nodes)
        shared = sorted((node for node, n in often.items() if n > 1), key=lambda node: (-often[node], node))
        before = len(pairs)
        for start in range(0, len(shared), MINED):
            block = shared[start : start + MINED]
            column = {node: i for i, node in enumerate(block)}
            held = np.zeros((len(roots), len(block)), np.float32)
            for q, nodes in enumerate(roots):
                held[q, [column[node] for node in nodes if node in column]] = 1
            together = held.T @ held
            np.fill_diagonal(together, 0)
            best = together.argmax(axis=1)
            number = np.arange(len(block))
            mutual = (best[best] == number) & (number < best) & (together[number, best] > 1)
            for i in np.flatnonzero(mutual).tolist():
                a, b = block[i], block[best[i]]
                new = terms + len(pairs)
                pairs.append((a, b))
                for q in np.flatnonzero((held[:, i] > 0) & (held[:, best[i]] > 0)).tolist():
                    roots[q] -= {a, b}
                    roots[q].add(new)
        if len(pairs) == before:
            return Sharing(terms, pairs, [sorted(r) for r in roots])


def blocks(items: DataFrame) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """Queries with their distinct terms, in blocks of bounded size; they arrive at the driver one partition at a time."""
    block, size = [], 0
    for row in items.select("item_id", "text").toLocalIterator():
        text = (row.text or "").encode()
        terms = sorted(set(terms_of(text)))
        if not terms:
            continue
        if len(terms) > MOST_TERMS:
            raise ValueError(f"item {row.item_id} has more than {MOST_TERMS} distinct terms")
        if block and size + len(text) > BLOCK_BYTES:
            yield block
            block, size = [], 0
        block.append((row.item_id, terms))
        size += len(text)
    if block:
        yield block


def counted(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """For each document with a term: number of its terms with repeats, and how often each of the vocabulary occurs."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {term: i for i, term in enumerate(vocabulary)}
        for batch in batches:
            doc_ids, sizes, found, times, ends = [], [], [], [], [0]
            for doc_id, text in zip(batch.column(0).to_pylist(), each_utf8(batch.column(1))):
                words = terms_of(text)
                if not words:
                    continue
                doc_ids.append(doc_id)
                sizes.append(len(words))
                for word, n in Counter(words).items():
                    if (i := number.get(word)) is not None:
                        found.append(i)
                        times.append(n)
                ends.append(len(found))
            offsets = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32())) for x in (found, times)]
            arrays = [pa.array(doc_ids, pa.int64()), pa.array(sizes, pa.int64()), *lists]
            yield pa.record_batch(arrays, [field.split()[0] for field in COUNTED.split(", ")])

    return map_texts(docs.select("doc_id", "text"), counts, COUNTED)


class Best:
    """The k best documents of each query so far."""

    def __init__(self, queries: int, k: int):
        self.k, self.least = k, np.ones(queries, np.int64)
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.held = 0

    def add(self, scores: np.ndarray, doc_ids: np.ndarray, missing: np.ndarray) -> None:
        """``scores`` has a row for each query; a document whose id is missing comes after others with its score."""
        query, doc = np.nonzero(scores >= self.least[:, None])
        self.parts.append((query, scores[query, doc], missing[doc], doc_ids[doc]))
        self.held += len(query)
        if self.held > 4 * self.k * len(self.least) + 100_000:
            self.prune()

    def prune(self) -> tuple[np.ndarray, ...]:
        """Only the best so far, by query and place: query, score, missing, id."""
        rows = tuple(np.concatenate(column) for column in zip(*self.parts))
        query, score, missing, doc_id = rows
        order = np.lexsort((doc_id, missing, -score, query))
        first = np.searchsorted(query[order], np.arange(len(self.least)))
        place = np.arange(len(order)) - first[query[order]]
        last = order[place == self.k - 1]
        self.least[query[last]] = score[last]
        kept = tuple(column[order[place < self.k]] for column in rows)
        self.parts, self.held = [kept], len(kept[0])
        return kept


def scored(table: DataFrame, sharing: Sharing, weights: list[int], documents: int, length: int, k: int) -> DataFrame:
    """The best documents of each task for each query."""
    weight = np.array(weights, np.int64)
    queries = len(sharing.roots)
    rows = max(16, SUM_BYTES // (8 * (sharing.terms + len(sharing.pairs) + queries + 1)))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Best(queries, k)
        for whole in batches:
            for at in range(0, whole.num_rows, rows):
                batch = whole.slice(at, rows)
                missing = np.asarray(batch.column(0).is_null())
                doc_ids = batch.column(0).fill_null(0).to_numpy()
                terms, counts = (batch.column(c).flatten().to_numpy().astype(np.int64) for c in (2, 3))
                ends = batch.column(2).offsets.to_numpy()
                doc = np.repeat(np.arange(batch.num_rows), np.diff(ends))
                sizes, which = np.unique(batch.column(1).to_numpy(), return_inverse=True)
                norm = np.array([50 + 50 * int(n) * documents // length for n in sizes], np.int64)[which]
                value = weight[terms] * (1_000_000_000 * counts // (1000 * counts + 20 * norm[doc]))
                found.add(sums(sharing, terms, doc, value, batch.num_rows), doc_ids, missing)
        if found.held:
            query, score, missing, doc_id = found.prune()
            arrays = [pa.array(query), pa.array(doc_id, mask=missing), pa.array(score)]
            yield pa.record_batch(arrays, [field.split()[0] for field in SCORED.split(", ")])

    return table.mapInArrow(best, SCORED)


def sums(sharing: Sharing, terms: np.ndarray, docs: np.ndarray, values: np.ndarray, rows: int) -> np.ndarray:
    """Each query's score of each document: along the graph, parts first. A node that no document has costs nothing."""
    node: list[np.ndarray | None] = [None] * (sharing.terms + len(sharing.pairs))
    order = np.argsort(terms, kind="stable")
    terms, docs, values = terms[order], docs[order], values[order]
    present, firsts = np.unique(terms, return_index=True)
    for term, start, end in zip(present.tolist(), firsts.tolist(), [*firsts[1:].tolist(), len(terms)]):
        node[term] = np.zeros(rows, np.int64)
        node[term][docs[start:end]] = values[start:end]
    for i, (a, b) in enumerate(sharing.pairs, sharing.terms):
        node[i] = node[b] if node[a] is None else node[a] if node[b] is None else node[a] + node[b]
    out = np.zeros((len(sharing.roots), rows), np.int64)
    for total, roots in zip(out, sharing.roots):
        for root in roots:
            if node[root] is not None:
                total += node[root]
    return out


def search(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k best documents of each item, those with a score of 0 left out.

    ``docs`` needs ``doc_id`` and ``text``, ``items`` needs ``item_id`` and ``text``; more columns are ignored. Documents and
    items without terms (NULL, empty) take no part. Rows that share an id are documents, or items, of their own. Equal
    scores go by ``doc_id``, NULL last. Either table empty: no rows.
    """
    found = [_searched(docs, block, k) for block in blocks(items)]
    return reduce(DataFrame.unionByName, found) if found else docs.sparkSession.createDataFrame([], RANKED)


def _searched(docs: DataFrame, block: list[tuple[int | None, list[bytes]]], k: int) -> DataFrame:
    vocabulary = sorted({term for _, terms in block for term in terms})
    number = {term: i for i, term in enumerate(vocabulary)}
    sharing = share([{number[t] for t in terms} for _, terms in block], len(vocabulary))
    table = parked(counted(docs, vocabulary))
    documents, length = table.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    # The vocabulary is bounded by the block, and so is what is collected.
    holding = dict(table.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
    weights = [math.floor(1000 * math.log((2 * documents + 2) / (2 * holding.get(i, 0) + 1))) for i in range(len(vocabulary))]
    best = scored(table, sharing, weights, documents, max(length, 1), k)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    best = best.withColumn("_group", F.spark_partition_id() % MERGE_GROUPS)
    by_group = Window.partitionBy("query", "_group").orderBy(*order)
    best = best.withColumn("_place", F.row_number().over(by_group)).filter(F.col("_place") <= k)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).filter(F.col("rank") <= k)
    ids = docs.sparkSession.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(block)], "query long, item_id long")
    return best.join(ids, "query").select("item_id", "rank", "doc_id", "score")


def oracle(k: int = 50) -> str:
    """DuckDB SQL for the query on ``documents`` and ``benchmark``."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    words = rf"regexp_extract_all(translate(text, '{upper}', '{upper.lower()}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return f"""
with d as (select row_number() over () as row, doc_id, {words} as words from documents where text is not null),
o as (select row, doc_id, cast(len(words) as bigint) as n, words from d where len(words) > 0),
c as (select count(*) as nn, cast(sum(n) as bigint) as l from o),
t as (select row, doc_id, n, unnest(words) as term from o),
f as (select row, doc_id, n, term, count(*) as tf from t group by all),
w as (
  select term, cast(floor(1000 * ln(cast(2 * nn + 2 as double) / cast(2 * count(*) + 1 as double))) as bigint) as w
  from f, c group by term, nn
), i as (
  select distinct irow, item_id, term from (
    select row_number() over () as irow, item_id, unnest({words}) as term from benchmark where text is not null
  )
), s as (
  select irow, item_id, row, doc_id,
         cast(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nn) // l)))) as bigint) as score
  from i join f using (term) join w using (term), c group by irow, item_id, row, doc_id
), r as (
  select *, cast(row_number() over (partition by irow order by score desc, doc_id nulls last) as int) as rank from s where score > 0
)
select item_id, rank, doc_id, score from r where rank <= {k}
"""
