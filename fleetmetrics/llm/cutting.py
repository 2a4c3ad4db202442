"""Cutting texts at the boundaries of byte-pair vocabularies' patterns, for whole arrays of characters at once.

The patterns know four kinds of characters (letters, numbers, white space, all others) and the English contractions.
So a boundary depends on the kinds of a few neighbours only, and all boundaries of many texts come from a few
comparisons of shifted arrays.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex

LETTER, NUMBER, SPACE, OTHER = range(4)
#: What may follow an apostrophe as a piece of its own (fixed values).
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
_BLANK, _APOSTROPHE = 32, 39


@functools.cache
def kinds() -> np.ndarray:
    """The kind of every code point."""
    out = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for run in regex.finditer(pattern, every):
            out[ord(run[0][0]) : ord(run[0][-1]) + 1] = kind
    out[0xD800:0xE000] = OTHER
    return out


@dataclass
class Characters:
    """Code points of texts laid end to end; where each character's bytes begin; and where each text does."""

    codes: np.ndarray
    bytes_at: np.ndarray  # one more than there are characters
    texts_at: np.ndarray  # one more than there are texts

    @staticmethod
    def of(data: bytes, byte_offsets: np.ndarray) -> Characters:
        """From UTF-8 and the n+1 offsets of n texts."""
        codes = np.frombuffer(data.decode("utf-8").encode("utf-32-le"), np.int32)
        if len(codes) == len(data):
            return Characters(codes, np.arange(len(codes) + 1), byte_offsets)
        width = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
        bytes_at = np.concatenate([[0], np.cumsum(width)])
        return Characters(codes, bytes_at, np.searchsorted(bytes_at, byte_offsets))

    def begins(self) -> np.ndarray:
        """Whether a character is the first of a text."""
        out = np.zeros(len(self.codes) + 1, bool)
        out[self.texts_at] = True
        return out[:-1]


def _contracted(c: Characters, start: np.ndarray, first: np.ndarray) -> None:
    """Moves the boundary behind an apostrophe that begins a piece to the end of its contraction."""
    at = np.flatnonzero(start & (c.codes == _APOSTROPHE))
    if not len(at):
        return
    codes = np.append(c.codes, [0, 0])
    ends = np.append(first, [True, True])
    one, two = codes[at + 1], codes[at + 2]
    size = np.zeros(len(at), np.int64)
    for letters in CONTRACTIONS:
        hit = (one == ord(letters[0])) & ~ends[at + 1]
        if len(letters) == 2:
            hit &= (two == ord(letters[1])) & ~ends[at + 2]
        size[hit & (size == 0)] = len(letters)
    at, size = at[size > 0], size[size > 0]
    start[at + 1] = False
    after = at + 1 + size
    start[after[after < len(start)]] = True


def byte_level(c: Characters) -> np.ndarray:
    """First characters of the pieces of a byte-level vocabulary: a blank goes with the word, number or signs behind it."""
    kind, first = kinds()[c.codes], c.begins()
    start = first.copy()
    start[1:] |= kind[1:] != kind[:-1]
    blank = c.codes == _BLANK
    space = kind == SPACE
    # What follows a run of white space takes its last character if that is a blank; any other last one stands alone.
    start[1:] &= ~(blank[:-1] & ~space[1:] & ~first[1:])
    start[:-1] |= space[:-1] & ~space[1:] & ~first[1:]
    _contracted(c, start, first)
    return np.flatnonzero(start)


def word_level(c: Characters, space: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """First characters of the pieces of a vocabulary that drops white space (marked in ``space``).

    Numbers are pieces digit by digit. Runs without white space that hold a character marked in ``whole`` are not cut.
    """
    kind, first = kinds()[c.codes], c.begins()
    start = first.copy()
    start[1:] |= (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
    _contracted(c, start, first)
    start &= ~space
    if whole.any():
        run = ~space
        run[1:] &= space[:-1] | first[1:]
        number = np.cumsum(run)
        marked = np.zeros(int(number[-1]) + 1, bool)
        marked[number[whole]] = True
        start &= ~marked[number] | run
    return np.flatnonzero(start)


def spans(data: bytes, at: np.ndarray) -> pa.Array:
    """The spans of ``data`` between consecutive offsets, as a binary array over the same bytes."""
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data)])
