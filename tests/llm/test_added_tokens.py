import random

import numpy as np
import pytest
from test_token_file import BYTE, PIECES, WORD
from tokenizers import Tokenizer

from readmap.llm import packing, token_file, tokens
from readmap.scratch import shared_folder

TEXT = "a <|endoftext|> b"


@pytest.mark.parametrize("kind, path, ids", [(tokens.WordEncoder, WORD, [320, 49407, 321]), (tokens.ByteEncoder, BYTE, [64, 220, 50256, 275])])
def test_added_tokens_inside_texts(kind, path, ids):
    dice, tokenizer = random.Random(5), Tokenizer.from_file(path)
    pieces = [*PIECES, "<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext", "|>"]
    texts = [TEXT, ""] + ["".join(dice.choices(pieces, k=dice.randint(0, 25))) for _ in range(3000)]
    got = [np.frombuffer(x, "<u4").tolist() for x in tokens.encoder(kind, path).encode([t.encode() for t in texts])]
    assert got[0] == ids
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_operators_keep_added_tokens(spark):
    docs = spark.createDataFrame([(1, TEXT), (2, "b")], "doc_id long, text string")
    listing = token_file.write_token_files(docs, shared_folder(spark), WORD)
    rows = sorted(token_file.read_token_files(spark, listing).collect(), key=lambda r: r.start)
    assert [np.frombuffer(r.ids, "<u4").tolist()[:-1] for r in rows] == [[320, 49407, 321], [321]]
    assert {r.doc_id: r.length for r in packing.pack_documents(docs, BYTE, capacity=1024).collect()} == {1: 5, 2: 2}
