"""Token ids of a word-splitting BPE tokenizer, worked out once per distinct word.

The tokenizer file drops white space and never joins text across it: its
normalizer and its split pattern look at no character beyond a white-space
character. So the ids of a text are the ids of its white-space separated chunks,
one after the other, and a chunk that was seen before needs no library call.
"""

from __future__ import annotations

import functools
import re

import numpy as np
from tokenizers import Tokenizer

# White space for both the tokenizer and Python; str.split() alone knows more.
BLANKS = re.compile("[\t\n\x0b\x0c\r ]+")
# Texts with any of these are cut at BLANKS only and keep their case: white space the
# two sides may see differently, letters whose lower case depends on context, and the
# start of special tokens, which are matched before lower-casing.
UNUSUAL = re.compile("[\x1c-\x1f\x85\xa0İƀ-\U0010ffff]|<\\|")
# Chunks the model can take without normalizer and pattern: lower-case letters that are
# composed, and at most one mark after them.
PLAIN = re.compile("([a-zß-öø-ÿœ]+)([.,;:!?]?)")
# Distinct chunks kept by a worker; beyond that the memory starts anew.
REMEMBERED = 300_000


class WordEncoder(dict):
    """Maps a chunk to its ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.remembered = remembered
        letters = "".join(map(chr, [*range(0x61, 0x7B), *range(0xDF, 0xF7), *range(0xF8, 0x100), 0x153]))
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.mapped = {ord(c): split(c)[0][0] for c in letters}

    def _plain(self, word: str) -> list[int]:
        return [t.id for t in self.model.tokenize(word if word.isascii() else word.translate(self.mapped))]

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= self.remembered:
            self.clear()
        if (m := PLAIN.fullmatch(chunk)) and len(chunk) < 200:
            ids = self._plain(m[1]) + (self._plain(m[2]) if m[2] else [])
        else:
            ids = self.tokenizer.encode(chunk, add_special_tokens=False).ids
        out = self[chunk] = np.array(ids, "<u4").tobytes()
        return out

    def encode(self, text: str | None) -> bytes:
        """The ids of a whole text, four bytes each."""
        if not text:
            return b""
        if UNUSUAL.search(text):
            chunks = filter(None, BLANKS.split(text))
        else:
            chunks = text.lower().split()
        return b"".join(map(self.__getitem__, chunks))


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One encoder per worker process, kept between tasks."""
    return WordEncoder(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
