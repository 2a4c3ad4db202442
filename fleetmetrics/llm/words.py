"""Tokens of a lower-casing word-end BPE vocabulary.

White space never survives into a token, so a text's ids are those of its pieces, one after another. Texts are lowered
and cut as arrays; Arrow finds the distinct pieces of a slice; what has not been met before is merged in step; and the
ids are put together by number. Each worker remembers the ids of a bounded number of pieces that it has met. Texts with characters on which libraries differ about white space, or with the names of special tokens,
go to the tokenizers library whole; so do runs with characters beyond Latin letters, on which Unicode versions may differ.
"""

from __future__ import annotations

import functools
import json
import os
import re

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from fleetmetrics.llm.bpe import _byte_letters
from fleetmetrics.llm.cutting import SPACE, Characters, kinds, spans, word_level
from fleetmetrics.llm.merging import LONGEST, Codes, Known, PairTable, merge_all
from fleetmetrics.llm.shared import buffers, release

#: Pieces remembered: about 50 bytes each.
KEPT = 300_000
#: Longer texts are cut before they become arrays, of some 50 bytes a character.
LONG_TEXT = 2_000_000
#: White space to some libraries only (fixed values), and the beginning of a special token's name.
_UNLIKE = "[\x1c-\x1f\u0085᠎]|<\\|"
_WHOLE, _CUT = re.compile(_UNLIKE), re.compile("[ \t\r\n]")


@functools.cache
def _lowered() -> np.ndarray:
    """Lower case of the characters that are cut here."""
    out = np.arange(0x110000, dtype=np.int32)
    for code in [*range(65, 91), *range(0xC0, 0x180)]:
        out[code] = ord(low) if len(low := chr(code).lower()) == 1 else code
    return out


@functools.cache
def _foreign() -> np.ndarray:
    """Characters, other than white space, that are left to the library. One Latin letter is lowered to two characters."""
    out = np.ones(0x110000, bool)
    for a, b in ((0x21, 0x7E), (0xC0, 0xD6), (0xD8, 0xF6), (0xF8, 0x17F)):
        out[a : b + 1] = False
    out[0x130] = True
    return out


def _bytes(codes: np.ndarray, starts: np.ndarray) -> tuple[bytes, np.ndarray]:
    """UTF-8 of characters, and where those at ``starts`` begin in it; its length last."""
    data = codes.tobytes().decode("utf-32-le").encode()
    if len(data) == len(codes):
        return data, np.append(starts, len(data))
    width = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
    return data, np.concatenate([[0], np.cumsum(width)])[np.append(starts, len(codes))]


class WordTokenizer:
    def __init__(self, path: str) -> None:
        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        self.end = model["end_of_word_suffix"]
        vocabulary = model["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        # (left id, right id) as one number -> (rank, merged id) as one number
        self.table = PairTable({vocabulary[u] << 20 | vocabulary[v]: k << 20 | vocabulary[u + v] for k, (u, v) in enumerate(pairs)})
        letter = {b: c for c, b in _byte_letters().items()}
        self.first = [vocabulary[letter[b]] for b in range(256)]
        self.last = [vocabulary[letter[b] + self.end] for b in range(256)]
        self.known = Known(KEPT)

    @staticmethod
    @functools.lru_cache(2)
    def at(path: str) -> WordTokenizer:
        made = WordTokenizer(path)
        release()  # of the parsed file
        return made

    def _library(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)

    @staticmethod
    def _parts(text: str) -> list[str]:
        """A long text cut at white space, which no piece contains; so that arrays are of bounded size. A text for the library stays whole."""
        if _WHOLE.search(text):
            return [text]
        out, at = [], 0
        while len(text) - at > LONG_TEXT and (m := _CUT.search(text, at + LONG_TEXT)):
            out.append(text[at : m.start()])
            at = m.start()
        return [*out, text[at:]]

    def _solved(self, pieces: pa.Array) -> Codes:
        """Ids of distinct pieces."""
        data, at = buffers(pieces)
        c = Characters.of(data.tobytes(), at)
        size = np.diff(at)
        foreign = np.logical_or.reduceat(_foreign()[c.codes], c.texts_at[:-1])
        short = np.flatnonzero((size <= LONGEST) & ~foreign)
        found = merge_all(data, at[short], size[short], self.table, self.first, self.last)
        rest = np.setdiff1d(np.arange(len(size)), short)
        own = Codes.of([self._library(data[at[i] : at[i + 1]].tobytes().decode()) for i in rest.tolist()])
        out_at, out_size = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
        out_at[short], out_size[short] = found.at, found.size
        out_at[rest], out_size[rest] = own.at + len(found.flat), own.size
        return Codes(np.concatenate([found.flat, own.flat]), out_at, out_size)

    def encode_arrays(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole texts (null counts as empty), end to end, and the n+1 offsets of the n texts."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if len(texts) == 1 and pc.binary_length(texts[0]).as_py() > LONG_TEXT and len(parts := self._parts(texts[0].as_py())) > 1:
            ids = np.concatenate([self.encode_arrays(pa.array([p], pa.large_string()))[0] for p in parts])
            return ids, np.array([0, len(ids)])
        odd = np.flatnonzero(pc.match_substring_regex(texts, _UNLIKE).to_numpy(zero_copy_only=False))
        if len(odd):
            apart = [self._library(t) for t in texts.take(pa.array(odd)).to_pylist()]
            mask = np.zeros(len(texts), bool)
            mask[odd] = True
            texts = pc.if_else(pa.array(mask), "", texts)
        data, offsets = buffers(texts)
        c = Characters.of(data.tobytes(), offsets)
        space = kinds()[c.codes] == SPACE
        low = _lowered()[c.codes]
        starts = word_level(Characters(low, c.bytes_at, c.texts_at), space, _foreign()[c.codes] & ~space)
        # Pieces are next to each other once white space is gone.
        kept = low[~space]
        bare = np.cumsum(~space)[starts] - 1
        pieces = spans(*_bytes(kept, bare)).dictionary_encode()
        codes = self.known.of(pieces.dictionary, self._solved)
        ids, at = codes.gather(pieces.indices.to_numpy(zero_copy_only=False))
        text_at = at[np.searchsorted(starts, c.texts_at)]
        if not len(odd):
            return ids, text_at
        parts = [ids[a:b] for a, b in zip(text_at[:-1].tolist(), text_at[1:].tolist(), strict=True)]
        for i, own in zip(odd.tolist(), apart, strict=True):
            parts[i] = own
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of whole texts."""
        ids, at = self.encode_arrays(pa.array(texts, pa.large_string()))
        return [ids[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]

    def forget(self) -> None:
        """Give the memory back, for a worker that goes on to other work."""
        self.known.forget()

    def encode(self, text: str) -> bytes:
        return self.encode_many([text])[0]
