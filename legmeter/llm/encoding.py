"""Whole texts to token ids with the tokenizers library, one distinct word at a time.

Both public vocabularies split a text before a single space that stands between two solid characters, so the
ids of a text are the ids of its space-separated pieces in a row. Pieces repeat, so each task keeps the ids of
those it has met in a bounded cache. Texts with two white-space characters in a row are encoded whole where the
vocabulary keeps white space. ``tests/llm/test_encoding.py`` holds this against direct encoding.
"""

from __future__ import annotations

import importlib
import os
import unicodedata
from array import array

import numpy as np

from legmeter.llm.words import kept_by_process

#: Distinct pieces that one worker remembers; the cache starts anew when it is full.
CACHE_PIECES = 400_000
END_ID = 2
#: Punctuation that never joins the letters before it.
_MARKS = ".,;:!?#$%&*"


def vocabulary_path(name: str) -> str:
    """Place of a public vocabulary file on this machine; it is installed with Python on every executor."""
    return importlib.import_module("public_tokenizers").path(name)


class _Irregular(Exception):
    """White space stands next to white space."""


def _byte_letters() -> dict[int, int]:
    """Byte-level vocabularies write a byte as one letter: itself if visible, else the next letter after 255."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {b: 256 + k for k, b in enumerate(hidden)}


_BYTE_LETTERS = _byte_letters()


class _Pieces(dict):
    """Little-endian unsigned 32-bit ids of pieces, filled on demand.

    A piece that ends in punctuation is put together from its stem and the punctuation, one with a line end inside
    from its two sides: the vocabularies split there too. So only distinct stems reach the tokenizer, and those of
    letters alone, which no vocabulary splits further, go to its merge table directly.
    """

    def __init__(self, owner: Encoder, prefix: str = "") -> None:
        super().__init__()
        self._owner, self._prefix = owner, prefix
        self._word_prefix = "".join(chr(_BYTE_LETTERS[b]) for b in prefix.encode())
        self._marks: dict[str, bytes] = {}
        self._line_end = self._direct("\n")

    def _direct(self, text: str) -> bytes:
        return array("I", self._owner.direct(text)).tobytes()

    def _letters(self, word: str) -> bytes:
        if not word.isascii():
            if not self._owner.keeps_space:
                folded = unicodedata.normalize("NFC", word).lower()
                # A sigma is folded by its place in the word, some letters into a letter and a mark.
                if "\u03c3" in folded or "\u03c2" in folded or not folded.isalpha():
                    return self._direct(word)
                word = folded
            word = word.encode().decode("latin-1").translate(_BYTE_LETTERS)
        elif not self._owner.keeps_space:
            word = word.lower()
        return array("I", [t.id for t in self._owner.merges(self._word_prefix + word)]).tobytes()

    def _found(self, piece: str) -> bytes:
        if piece.isalpha():
            return self._letters(piece)
        stem = piece.rstrip(_MARKS)
        if len(stem) < len(piece) and stem[-1:].lower().isalpha():
            marks = piece[len(stem) :]
            tail = self._marks.get(marks)
            if tail is None:
                if len(self._marks) >= CACHE_PIECES:
                    self._marks.clear()
                self._marks[marks] = tail = self._direct(marks)
            return self[stem] + tail
        if not piece:
            return b""
        if self._owner.keeps_space and (piece[0].isspace() or piece[-1].isspace()):
            raise _Irregular
        before, line_end, after = piece.partition("\n")
        if line_end and before and after and not before[-1].isspace() and not after[0].isspace():
            return self[before] + self._line_end + self._owner.first[after]
        return self._direct(self._prefix + piece)

    def __missing__(self, piece: str) -> bytes:
        found = self._found(piece)
        if len(self) >= CACHE_PIECES:
            self.clear()
        self[piece] = found
        return found


class Encoder:
    """``encode(text)`` gives the ids as little-endian unsigned 32-bit integers, without special tokens.

    Strings of special tokens inside a text are ordinary text.
    """

    def __init__(self, name: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary_path(name))
        self.tokenizer.encode_special_tokens = True
        self.merges = self.tokenizer.model.tokenize
        self.size = self.tokenizer.get_vocab_size()
        #: Word vocabularies drop white space, byte vocabularies keep it in front of the word.
        self.keeps_space = self.tokenizer.normalizer is None
        self.first = _Pieces(self)
        self.later = _Pieces(self, " ") if self.keeps_space else self.first

    def direct(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def encode(self, text: str) -> bytes:
        first, *later = text.split(" ")
        try:
            if self.keeps_space and "" in later:
                raise _Irregular
            return self.first[first] + b"".join(map(self.later.__getitem__, later))
        except _Irregular:
            return array("I", self.direct(text)).tobytes()

    def encode_document(self, text: str | None) -> bytes:
        """Ids of a document, the end id last; a null text is empty."""
        return self.encode(text or "") + END_ID.to_bytes(4, "little")

    def decode(self, ids: np.ndarray) -> str:
        return self.tokenizer.decode(ids.tolist(), skip_special_tokens=False)


def encoder(name: str) -> Encoder:
    """The encoder of a vocabulary file, loaded once per Python worker."""
    loaded = kept_by_process("encoders")
    if name not in loaded:
        loaded[name] = Encoder(name)
    return loaded[name]
