import io
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from tokenizers import Tokenizer

from readmap.llm import token_file as tf
from readmap.llm import tokens
from readmap.scratch import shared_folder

WORD, BYTE = (public_tokenizers.path(f) for f in ("word_bpe_49k.json", "byte_bpe_50k.json"))
PIECES = [
    "a", "b", "'s", "'", "'ll", " ", "  ", "\n", "\n\n", "\t", ".", ",", "é", "É", "ß", "x.y", "1", "23", "”", "“", "\xa0", "\x0b", "\x1c", "\x01", "…",
    "<|endoftext|>", "á", "́", "Σας", "日本", "😀", "!?", "|", " the", "The", "A.", "b,", "÷", "×", "ÿ", "Ÿ", "İ", "\r\n", "\x00", "﻿", "​",
]


def whole(path):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def memory_file(documents, **options):
    stream = io.BytesIO()
    writer = tf.TokenFileWriter(stream, **options)
    for doc_id, ids in documents:
        writer.add(doc_id, np.array(ids, "<u4").tobytes())
    writer.close()
    return stream.getvalue()


@pytest.mark.parametrize("kind, path", [(tokens.WordEncoder, WORD), (tokens.ByteEncoder, BYTE)])
def test_same_ids_as_the_library(kind, path, spark, sf):
    dice = random.Random(1)
    texts = ["".join(dice.choices(PIECES, k=dice.randint(0, 25))) for _ in range(5000)]
    texts += [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    encode = whole(path)
    got = kind(path).encode([t.encode() for t in texts])
    assert all(np.frombuffer(ids, "<u4").tolist() == encode(t) for t, ids in zip(texts, got))


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 2)
    monkeypatch.setattr(tokens, "SEEN_ONCE", 1)
    texts = [b"one two three", b"one two three four", b""]
    assert tokens.WordEncoder(WORD).encode(texts) == [np.array(whole(WORD)(t.decode()), "<u4").tobytes() for t in texts]


def test_file_round_trip_and_layout():
    dice = random.Random(2)
    documents = [(dice.choice([None, i]), [dice.randrange(1 << 32) for _ in range(dice.choice([0, 1, 50, 900]))]) for i in range(200)]
    raw = memory_file(documents, frame_bytes=1000, longest_frame=1600)
    reader = tf.TokenFileReader(pa.BufferReader(raw))
    assert reader.doc_ids == [d for d, _ in documents] and len(reader.frames) > 50
    order = list(range(200))
    dice.shuffle(order)
    assert all(np.frombuffer(reader.document(i), "<u4").tolist() == documents[i][1] for i in order)
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read()
    assert plain == b"".join(np.array(ids, "<u4").tobytes() for _, ids in documents)


def test_only_asked_frames_are_read_and_checked():
    documents = [(i, [i] * 1000) for i in range(10)]
    raw = bytearray(memory_file(documents, frame_bytes=4000))
    sizes = tf.TokenFileReader(pa.BufferReader(bytes(raw))).frames[:, 0]
    raw[int(sizes[:3].sum()) + int(sizes[3]) // 2] ^= 255  # inside the fourth frame
    reader = tf.TokenFileReader(pa.BufferReader(bytes(raw)))
    assert reader.document(2) == np.array([2] * 1000, "<u4").tobytes() and reader.document(9)
    with pytest.raises((ValueError, zstandard.ZstdError)):
        reader.document(3)
    with pytest.raises(ValueError, match="seek table"):
        tf.TokenFileReader(pa.BufferReader(bytes(raw[:-1])))


def test_documents_round_trip(spark):
    data = [(5, "five words"), (1, None), (3, ""), (None, "no id"), (3, "again"), (2, "long " * 200_000), (-7, "minus"), (9, "é")]
    docs = spark.createDataFrame([(*d, b"x") for d in data], "doc_id long, text string, ids binary").repartition(4)
    listing = tf.write_token_files(docs, shared_folder(spark), WORD)
    rows = sorted(tf.read_token_files(spark, listing).collect(), key=lambda r: r.start)
    encode, start = whole(WORD), 0
    assert [r.doc_id for r in rows] == [None, -7, 1, 2, 3, 3, 5, 9]
    expected = sorted((d is not None, d or 0, encode(t or "") + [2]) for d, t in data)
    assert sorted((r.doc_id is not None, r.doc_id or 0, np.frombuffer(r.ids, "<u4").tolist()) for r in rows) == expected
    for r in rows:
        assert (r.start, r.n_tokens) == (start, len(r.ids) // 4)
        start += r.n_tokens
    found = tf.find_documents(listing, [5, -7, 1000])
    assert {d: ids.tolist() for d, ids in found.items()} == {5: encode("five words") + [2], -7: encode("minus") + [2]}


def test_empty_table(spark):
    listing = tf.write_token_files(spark.createDataFrame([], "doc_id long, text string"), shared_folder(spark), WORD)
    assert tf.read_token_files(spark, listing).collect() == []


class Counted:
    """A tokenizer that keeps what it is given whole."""

    def __init__(self, tokenizer):
        self.tokenizer, self.given = tokenizer, []

    def encode(self, text, **options):
        self.given.append(text)
        return self.tokenizer.encode(text, **options)


def test_new_words_beside_signs_and_capitals_go_to_the_model():
    words = ["xyzzyb%%%", "Éxyzzyb", "(xyzzyb,", "xyzzyb7", "ÀÖØÞ!!", "xyzzyb-xyzzyb…", "xyzzyb'll", "'xyzzyb", "÷xyzzyb", "Σxyzzyb", "9", "%%%", "É́x", "<|x|>"]
    kind = tokens.WordEncoder(WORD)
    kind.tokenizer = counted = Counted(kind.tokenizer)
    got = kind.encode([" ".join(words * k).encode() for k in (1, 2)])
    encode = whole(WORD)
    assert [np.frombuffer(ids, "<u4").tolist() for ids in got] == [encode(" ".join(words * k)) for k in (1, 2)]
    # Of the first five, the signs and digits alone.
    assert not {w.lower() for w in words[:5]} & {t.lower() for t in counted.given}
    assert len(counted.given) == len(set(counted.given))


def test_chunks_of_all_latin_letters_and_signs_have_the_ids_of_the_library():
    dice, signs = random.Random(5), [chr(c) for c in (*range(33, 127), *range(0xA1, 0x100))]
    texts = ["".join(dice.choices(signs, k=dice.randint(1, 9))) for _ in range(20000)]
    encode = whole(WORD)
    got = tokens.WordEncoder(WORD).encode([t.encode() for t in texts])
    assert all(np.frombuffer(ids, "<u4").tolist() == encode(t) for t, ids in zip(texts, got))
