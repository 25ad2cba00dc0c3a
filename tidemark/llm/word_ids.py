"""Token ids of whole texts, chunk by chunk.

The vocabulary's pre-tokenizer never joins characters across a space or a line feed, and
its special strings hold neither, so the ids of a text are those of its space-separated
chunks one after another. Chunks repeat, so their ids are remembered.
"""

from __future__ import annotations

import array
import re

#: Letters whose lower case and normal form are one code point, then marks that are one pre-token.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?*#$%&]*)")
_SPACE = re.compile("[ \n]")


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(rest)) for b in range(256)]


class ChunkIds(dict):
    """Chunk -> its ids as little-endian unsigned 32-bit bytes, at most ``capacity`` at a time.

    A chunk of plain letters and closing marks goes straight to the vocabulary's merge model;
    any other chunk through the whole tokenizer. When full, the memory is emptied: frequent
    chunks are back at once, and rare ones would not have been asked for again.
    """

    def __init__(self, tokenizer, capacity: int = 600_000):
        super().__init__()
        self.tokenizer, self.capacity = tokenizer, capacity
        self.model = tokenizer.model
        self.letters = dict(enumerate(byte_letters()))
        self[""] = b""

    def _pretoken(self, word: str) -> list[int]:
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.letters)
        return [token.id for token in self.model.tokenize(word)]

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= self.capacity:
            self.clear()
            self[""] = b""
        plain = _PLAIN.fullmatch(chunk)
        if plain:
            word, marks = plain.groups()
            ids = self._pretoken(word.lower())
            if marks:
                ids += self._pretoken(marks)
        else:
            ids = self.tokenizer.encode(chunk, add_special_tokens=False).ids
        self[chunk] = found = array.array("I", ids).tobytes()
        return found

    def of(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


_LOADED: dict[str, ChunkIds] = {}


def chunk_ids(name: str) -> ChunkIds:
    """One memory for each vocabulary and Python worker."""
    if name not in _LOADED:
        import os

        import public_tokenizers
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _LOADED[name] = ChunkIds(Tokenizer.from_file(public_tokenizers.path(name)))
    return _LOADED[name]
