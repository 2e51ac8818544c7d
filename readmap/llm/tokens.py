"""Token ids of whole texts, by a tokenizer file of the ``tokenizers`` library.

A tokenizer that drops white space never joins what white space separates, so a text is encoded chunk by chunk and
the ids of each chunk are remembered. In a new chunk of Latin letters, digits and ASCII signs, the tokenizer would part words,
digits and runs of signs; the words go to the tokenizer's model as they are, in lower case. Other new chunks go through the
whole tokenizer.

The two encoders take what looks like an added token for plain text; ``FileEncoder`` gives them only texts without any.
"""

import re
from array import array
from collections.abc import Iterator
from functools import cached_property

from readmap.llm.common import worker_state

#: Chunks that a Python worker remembers, of those it has seen more than once, and of the others; beyond
#: either number, these are forgotten.
REMEMBERED, SEEN_ONCE = 200_000, 50_000


class WordEncoder(dict):
    """For tokenizers that lower-case and drop white space: remembered ids by chunk.

    ``encode(texts)`` gives for each text its ids, unsigned 32-bit little-endian.
    """

    # Letters that stay one letter each; an apostrophe may belong to the letters that follow.
    word = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
    parted = re.compile(rb"(?:[!-&(-~]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
    parts = re.compile(word.pattern + rb"|[0-9]|[!-&(-/:-@\[-`{-~]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        # The model wants each byte as a character, as the byte-level step writes it.
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        letters = map(chr, range(0xC0, 0x100))
        self.written = {ord(c): "".join(part for part, _ in level.pre_tokenize_str(c)) for c in letters}
        self.once: dict[bytes, bytes] = {}
        self.tokenize = self.tokenizer.model.tokenize
        self.is_word, self.is_parted, self.parts_of = self.word.fullmatch, self.parted.fullmatch, self.parts.findall

    def __missing__(self, chunk: bytes) -> bytes:
        ids = self.once.pop(chunk, None)
        if ids is not None:
            self[chunk] = ids
            return ids
        if chunk.isalpha() or self.is_word(chunk):
            ids = self._word(chunk)
        elif self.is_parted(chunk) and len(parts := self.parts_of(chunk)) > 1:
            ids = b"".join([self._part(part) for part in parts])
        else:
            ids = array("I", self.tokenizer.encode(chunk.decode(), add_special_tokens=False).ids).tobytes()
        self.once[chunk] = ids
        return ids

    def _part(self, part: bytes) -> bytes:
        """Ids of a part of a chunk; words are remembered as chunks alone, as most that stand beside signs are rare."""
        if not (part.isalpha() or self.is_word(part)):
            return self[part]
        return self.get(part) or self.once.get(part) or self._word(part)

    def _word(self, word: bytes) -> bytes:
        text = word.decode()
        if not word.isalpha():  # of ASCII letters alone
            text = text.lower().translate(self.written)
        return array("I", [token.id for token in self.tokenize(text)]).tobytes()

    def encode(self, texts: list[bytes]) -> list[bytes]:
        found, ids = [], self.__getitem__
        for text in texts:
            for kept, most in ((self, REMEMBERED), (self.once, SEEN_ONCE)):
                if len(kept) > most:
                    kept.clear()
            found.append(b"".join(map(ids, text.lower().split())))
        return found


class ByteEncoder:
    """For byte-level tokenizers whose ids are the ranks of their merges.

    A text has few chunks twice here, as white space and punctuation stay with the words, so that remembering them
    gains little; instead, the file's vocabulary goes into ``tiktoken``, which gives the same ids in a third of the time.
    """

    # Fixed value: the pattern by which the byte-level step of the format splits texts.
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer, pre_tokenizers

        tokenizer = Tokenizer.from_file(path)
        special = {token.content for token in tokenizer.get_added_tokens_decoder().values()}
        vocabulary = {token: n for token, n in tokenizer.get_vocab(with_added_tokens=False).items() if token not in special}
        # The format writes each byte as a character of its own.
        characters = sorted({c for token in vocabulary for c in token})
        printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
        byte = {chr(b): b for b in printable}
        byte |= {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)).difference(printable)))}
        if set(characters) != set(byte) or not isinstance(tokenizer.pre_tokenizer, pre_tokenizers.ByteLevel):
            raise ValueError(f"not a byte-level tokenizer: {path}")
        ranks = {bytes(byte[c] for c in token): n for token, n in vocabulary.items()}
        self.encoding = tiktoken.Encoding("bytes", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[bytes]) -> list[bytes]:
        ordinary = self.encoding.encode_ordinary
        return [array("I", ordinary(text.decode())).tobytes() for text in texts]


class FileEncoder:
    """The ids that the tokenizer file gives with ``add_special_tokens=False``, added tokens inside texts included.

    Texts that may hold an added token go through the file's tokenizer whole, the others through ``kind``.
    """

    def __init__(self, kind: type, path: str):
        from tokenizers import Tokenizer

        self.plain, self.path = kind(path), path
        tokenizer = Tokenizer.from_file(path)
        added = tokenizer.get_added_tokens_decoder().values()
        # Those that are looked for after normalising may be written in another way; any text may hold one.
        rewritten = tokenizer.normalizer and any(token.normalized for token in added)
        some = b"" if rewritten else b"|".join(re.escape(token.content.encode()) for token in added)
        self.held = re.compile(some).search if added else lambda text: None

    @cached_property
    def tokenizer(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        whole = [self.held(text) is not None for text in texts]
        found = iter(self.plain.encode([text for text, w in zip(texts, whole) if not w]))
        return [self._whole(text) if w else next(found) for text, w in zip(texts, whole)]

    def _whole(self, text: bytes) -> bytes:
        return array("I", self.tokenizer.encode(text.decode(), add_special_tokens=False).ids).tobytes()


def encoder(kind: type, path: str) -> FileEncoder:
    """The worker's encoder for a tokenizer file."""
    state = worker_state()
    key = (kind.__name__, path)
    if getattr(state, "encoder_key", None) != key:
        state.encoder, state.encoder_key = FileEncoder(kind, path), key
    return state.encoder


def utf8(column) -> list[bytes]:
    """Texts of an Arrow string column as bytes, NULL as empty."""
    import pyarrow as pa

    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def each_utf8(column, step: int = 100) -> Iterator[bytes]:
    """The same one by one, with few of them in memory."""
    for start in range(0, len(column), step):
        yield from utf8(column.slice(start, step))
