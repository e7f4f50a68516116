"""Token ids of whole texts by the tokenizers library, with each distinct piece encoded once.

A pre-token never spans a blank between two other visible characters, so a text may be cut there
and its pieces encoded on their own: the ids of the text are the ids of the pieces in order. Most
pieces repeat, so their ids are kept in bounded dictionaries of the worker process. Texts that the
cut does not suit (runs of white space, special strings) go another way to the same ids.
"""

from __future__ import annotations

import os
import re
import string
import sys
from array import array

import numpy as np
import regex
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Entries of a dictionary of pieces.
MEMO_ENTRIES = 800_000
#: Of that of words after a blank, which most of the time goes into.
WORD_ENTRIES = 1_200_000

# Unicode White_Space, and the pattern of byte-level pre-tokens.
WHITE = "".join(
    map(chr, [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

RUNS = re.compile(f"[{WHITE}]+(?![^{WHITE}])|[{WHITE}]?[^{WHITE}]+")
WHITE_SET = frozenset(WHITE)
PRE_TOKENS = regex.compile(PATTERN)
#: Marks that after a word, at the end of a piece, form one pre-token of their own.
MARKS, LAST_LATIN = string.punctuation, chr(0xFF)


class Uneven(Exception):
    """A text that cannot be cut at its blanks."""


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies.

    Visible Latin-1 characters stand for themselves, the other bytes for characters from 256 on.
    """
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


LETTERS = byte_letters()


def as_letters(piece: str) -> str:
    if piece.isascii() and piece.isalpha():
        return piece
    return piece.encode().decode("latin-1").translate(LETTERS)


class Memo(dict):
    """A bounded dictionary that computes what it lacks.

    It has two generations: a full one becomes the old one, of which what is asked for again comes
    back; the rest goes with the next change.
    """

    def __init__(self, compute, entries: int = MEMO_ENTRIES):
        super().__init__()
        self.compute, self.most, self.old = compute, entries // 2, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def check_even(piece: str) -> str:
    """``piece`` itself if a text may be cut before and after it."""
    if not piece or piece[0] in WHITE_SET or piece[-1] in WHITE_SET:
        raise Uneven
    return piece


class Encoder:
    """Ids of whole texts as the bytes of an array of ``dtype``; no special tokens are added."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        added = self.library.get_added_tokens_decoder().values()
        special = [re.escape(t.content) for t in added]
        self.special = re.compile("|".join(special)) if special else None
        self.dtype = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.model = self.library.model
        #: Pre-tokens by the letters of their bytes, for marks and other short ones.
        self.token = Memo(self.from_letters, MEMO_ENTRIES // 4)

    def from_letters(self, letters: str) -> bytes:
        """The ids of one pre-token, given as its bytes' letters."""
        return array(self.code, [t.id for t in self.model.tokenize(letters)]).tobytes()

    def whole(self, text: str) -> bytes:
        """The library's own ids."""
        return np.array(
            self.library.encode(text, add_special_tokens=False).ids, self.dtype
        ).tobytes()

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if self.special and self.special.search(text):
            return self.whole(text)
        return self._cut(text)

    def _cut(self, text: str) -> bytes:
        raise NotImplementedError


def plain_word(piece: str) -> str:
    """The word in a piece that is a Latin-1 word and perhaps marks after it; else nothing."""
    word = piece.rstrip(MARKS)
    return word if word.isalpha() and (word.isascii() or max(word) <= LAST_LATIN) else ""


class ByteEncoder(Encoder):
    """Byte-level BPE: blanks belong to the piece after them."""

    def __init__(self, path: str):
        super().__init__(path)
        self.plain = Memo(self._run, MEMO_ENTRIES // 4)
        self.after_blank = Memo(self._after_blank, WORD_ENTRIES)

    def _run(self, run: str) -> bytes:
        if word := plain_word(run):
            marks = run[len(word) :]
            return self.from_letters(as_letters(word)) + (self.token[marks] if marks else b"")
        return b"".join([self.token[as_letters(t)] for t in PRE_TOKENS.findall(run)])

    def _after_blank(self, piece: str) -> bytes:
        word = plain_word(piece)
        if not word:
            last, line, first = check_even(piece).partition("\n")
            if line and plain_word(last) and plain_word(first):  # a line ends between two words
                return self.after_blank[last] + self.token[LETTERS[10]] + self.plain[first]
            return self._run(" " + piece)
        if len(word) < len(piece):
            return self.after_blank[word] + self.token[piece[len(word) :]]
        return self.from_letters(LETTERS[32] + as_letters(word))

    def _cut(self, text: str) -> bytes:
        first, *rest = text.split(" ")
        try:
            return self.plain[check_even(first)] + b"".join(map(self.after_blank.__getitem__, rest))
        except Uneven:
            return b"".join(map(self.plain.__getitem__, RUNS.findall(text)))


class WordEncoder(Encoder):
    """BPE with word ends: white space is dropped, so every blank is a cut."""

    def __init__(self, path: str):
        super().__init__(path)
        self.piece = Memo(self._piece)

    def _piece(self, piece: str) -> bytes:
        word = plain_word(piece)
        if not word:
            lines = piece.split("\n")
            return b"".join([self.piece[x] for x in lines]) if len(lines) > 1 else self.whole(piece)
        if len(word) < len(piece):
            return self.piece[word] + self.token[piece[len(word) :]]
        # For these letters the library's normalisation is the lower case.
        return self.from_letters(as_letters(word.lower()))

    def _cut(self, text: str) -> bytes:
        return b"".join(map(self.piece.__getitem__, text.split(" ")))
