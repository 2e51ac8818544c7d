"""Fill-in-middle transformation: a text's middle moves behind its suffix, between sentinels.

Texts are cut at units: runs of Latin letters, and every other character by itself. The units' ends are a
``BoundarySet``; both cuts are its k-th members. Where to cut, and which form a text gets, is decided by a hash of
the document's id, so it is the same in every run and on every retry. One scan, no shuffle.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readmap.llm.boundary_set import BoundarySet
from readmap.llm.common import map_texts

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of a hundred documents, those that stay plain, and those of the others with the suffix first.
PLAIN_PERCENT, SPM_PERCENT = 10, 20

MADE = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
NAMES = [field.split()[0] for field in MADE.split(", ")]
KINDS = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]


def boundaries(text: str) -> BoundarySet:
    """Places of the last character of each unit."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    lower = points | 0x20
    letter = (lower >= 97) & (lower <= 122)
    ends = np.ones(len(points), bool)
    ends[:-1] = ~(letter[:-1] & letter[1:])
    return BoundarySet(ends)


def draws(doc_id: int, seed: int) -> tuple[int, int, int, int]:
    """Four numbers of 32 bits for a document."""
    digest = hashlib.sha256(f"{seed}:{doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[4 * i : 4 * i + 4]) for i in range(4))


def transform(doc_id: int | None, text: str, seed: int) -> tuple:
    """The row of one document: number of units, form, characters of prefix and middle, and the new text."""
    units = boundaries(text)
    n = len(units)
    if doc_id is None or not text or any(sentinel in text for sentinel in (PREFIX, SUFFIX, MIDDLE)):
        return doc_id, n, "plain", None, None, text
    h1, h2, h3, h4 = draws(doc_id, seed)
    if h3 % 100 >= 100 - PLAIN_PERCENT:
        return doc_id, n, "plain", None, None, text
    first, second = (units.select(k - 1) + 1 if k else 0 for k in sorted((h1 % (n + 1), h2 % (n + 1))))
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    if h4 % 100 < SPM_PERCENT:
        form, output = "spm", f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    else:
        form, output = "psm", f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return doc_id, n, form, first, second - first, output


def fill_in_middle(docs: DataFrame, seed: int = 1) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` for each document.

    ``docs`` needs ``doc_id`` and ``text``; more columns are ignored. ``n`` counts the units of the whole text. A NULL
    text is empty. Empty texts, texts that hold a sentinel, and rows without ``doc_id`` stay as they are (``plain``, NULL
    lengths). Rows with one id are cut by the same numbers. An empty table gives no rows.
    """

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                part = batch.slice(at, 100)
                rows = [transform(d, t or "", seed) for d, t in zip(part[0].to_pylist(), part[1].to_pylist())]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), KINDS)], NAMES)

    return map_texts(docs.select("doc_id", "text"), made, MADE)


def restored(output: str = "output", form: str = "form") -> Column:
    """The text as it was, from the new text and its form alone."""
    text, spm = F.col(output), F.col(form) == "spm"
    # In both forms: sentinel, first part, sentinel, second part, sentinel, middle.
    body = F.expr(f"substring({output}, {len(PREFIX) + 1})")
    first = F.when(spm, F.substring_index(body, PREFIX, 1)).otherwise(F.substring_index(body, SUFFIX, 1))
    rest = F.substr(body, F.length(first) + len(PREFIX) + 1)
    second = F.substring_index(rest, MIDDLE, 1)
    middle = F.substr(rest, F.length(second) + len(MIDDLE) + 1)
    moved = F.when(spm, F.concat(second, middle, first)).otherwise(F.concat(first, middle, second))
    return F.when(F.col(form) == "plain", text).otherwise(moved)


def oracle() -> str:
    """DuckDB SQL for the query on ``documents``."""
    return f"""
with d as (
  select doc_id, coalesce(text, '') as t, sha256('1:' || cast(doc_id as varchar)) as h from documents
), u as (
  select doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') as units,
         cast('0x' || substr(h, 1, 8) as bigint) as h1, cast('0x' || substr(h, 9, 8) as bigint) as h2,
         cast('0x' || substr(h, 17, 8) as bigint) as h3, cast('0x' || substr(h, 25, 8) as bigint) as h4
  from d
), c as (
  select *, len(units) as n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) as lo,
         greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) as hi,
         case when t = '' or contains(t, '{PREFIX}') or contains(t, '{SUFFIX}') or contains(t, '{MIDDLE}')
                or h3 is null or h3 % 100 >= {100 - PLAIN_PERCENT} then 'plain'
              when h4 % 100 < {SPM_PERCENT} then 'spm' else 'psm' end as form
  from u
), p as (
  select *, array_to_string(units[1:lo], '') as a, array_to_string(units[lo + 1:hi], '') as m,
         array_to_string(units[hi + 1:], '') as z from c
)
select doc_id, cast(n as bigint) as n, form,
       case when form <> 'plain' then cast(length(a) as bigint) end as prefix_chars,
       case when form <> 'plain' then cast(length(m) as bigint) end as middle_chars,
       sha256(case form when 'plain' then t when 'psm' then '{PREFIX}' || a || '{SUFFIX}' || z || '{MIDDLE}' || m
                        else '{SUFFIX}' || z || '{PREFIX}' || a || '{MIDDLE}' || m end) as output_sha256,
       sha256(t) as restored_sha256
from p
"""
