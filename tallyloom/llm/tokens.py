"""Token ids of whole texts by a tokenizer file of the ``tokenizers`` library."""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterable
from functools import cache

# Distinct chunks whose ids one Python worker remembers, twice (this and the previous generation).
CHUNKS_KEPT = 250_000
LONGEST_KEPT = 64

# Chunks of Latin-1 letters, digits and ASCII signs other than the apostrophe, and how they fall into words: runs
# of letters, single digits, runs of signs. Fixed values that must agree with the vocabulary's own splitting.
_PLAIN = re.compile("[a-z0-9ß-öø-ÿ!-&(-/:-@\\[-`{-~]+")
_PARTS = re.compile("[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")
# Letters whose lower case does not depend on what stands around them.
_LATIN = re.compile("[\u0021-\u012f\u0131-\u024f]+")


@cache
def _byte_letters() -> list[str]:
    """Byte-level letters: a printable byte is itself, the others follow from U+0100 on in order."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in printable]
    return [chr(b) if b in printable else chr(256 + hidden.index(b)) for b in range(256)]


class WordPieces(dict):
    """Maps a chunk between white space to its ids (little-endian unsigned 32-bit), for a word-level vocabulary.

    Holds for a tokenizer that lower-cases, drops white space and never merges across it, so a text's ids
    are those of its chunks one after another. Chunks seen before cost a dictionary look-up. A chunk of
    plain letters, digits and signs goes straight to the library's merges, any other through the whole library.
    """

    def __init__(self, path: str):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model
        self.older: dict[bytes, bytes] = {}

    def _encode(self, chunk: bytes) -> bytes:
        if chunk.isalpha():
            return self._packed(chunk.lower().decode())
        word = chunk.rstrip(b".,!?;:")
        if word.isalpha():
            return self[word] + self[chunk[len(word) :]]
        text = chunk.decode("utf-8", "replace")
        low = text.lower() if _LATIN.fullmatch(text) else text
        if _PLAIN.fullmatch(low) and "<|" not in text:
            letters = _byte_letters()
            parts = [p if p.isascii() else "".join([letters[b] for b in p.encode()]) for p in _PARTS.findall(low)]
            return b"".join(map(self._packed, parts))
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _packed(self, part: str) -> bytes:
        return array("I", [t.id for t in self.merges.tokenize(part)]).tobytes()

    def __missing__(self, chunk: bytes) -> bytes:
        value = self.older.get(chunk)
        if value is None:
            value = self._encode(chunk)
        if len(chunk) <= LONGEST_KEPT:
            if len(self) >= CHUNKS_KEPT:
                self.older = dict(self)
                self.clear()
            self[chunk] = value
        return value

    def ids(self, text: bytes | None) -> bytes:
        """All ids of a UTF-8 text; null counts as empty."""
        if not text:
            return b""
        # Special tokens are found before lower-casing, so a text that may hold one keeps its case here.
        chunks: Iterable[bytes] = (text if b"<|" in text else text.lower()).split()
        return b"".join(map(self.__getitem__, chunks))


@cache
def word_pieces(path: str) -> WordPieces:
    return WordPieces(path)
