"""Byte-level BPE as a streaming transducer with bounded lookahead, and an incremental decoder.

How far ahead must a reader look before a token is final? Compare the merges of a text s with those of a longer text sz.
Where their tokens first differ, the left one of the tokens at that place, u, was merged in one of them only, by a rule
(u, v); the place u later is then a boundary at which the tokens began to differ earlier, by a rule of higher priority
whose left part begins v (lies on v's left spine); and so on to the end of s. So tokens of s that end further from its
end than the longest such chain of left parts are final, whatever follows. ``Merges.lookahead`` is that length, found by
one pass over the merge list. It holds for proper lists, in which a rule's parts are made by earlier rules.

The transducer reads texts chunk by chunk. Of a text that goes on it emits the tokens of the pieces that end further
from the chunk's end than the lookahead, and reads the rest again with the next chunk; a piece longer than a few
lookaheads, which may have no end, it emits token by token. So its state is bounded however long a text is. It takes a
step for many texts at once, and remembers the tokens of the pieces that it has met.
"""

from __future__ import annotations

import functools
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmetrics.llm.cutting import SPACE, Characters, byte_level, kinds, spans
from fleetmetrics.llm.merging import LONGEST, Codes, Known, PairTable, merge_all
from fleetmetrics.llm.shared import buffers, map_batches, release, slices

SLICE_BYTES = 2_000_000
#: Characters that the transducer reads in a step, and ids that the decoder does.
CHUNK = 1 << 13
#: Pieces remembered: about 50 bytes each.
KEPT = 300_000
#: What continues a long piece of each kind of characters.
_KINDS = (r"\p{L}+", r"\p{N}+", r"\s+", r"[^\s\p{L}\p{N}]+")


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies: itself if printable in Latin-1, else the next from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Bytes of each id."""

    def __init__(self, path: str) -> None:
        self._load(path)

    @staticmethod
    @functools.lru_cache(2)
    def at(path: str) -> Vocabulary:
        return Vocabulary(path)

    def _load(self, path: str) -> dict:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letter = _byte_letters()
        raw = lambda s: bytes(letter[c] for c in s)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.ids = {raw(s): i for s, i in spec["model"]["vocab"].items() if s not in self.special}
        self.bytes_of = {i: b for b, i in self.ids.items()} | {i: s.encode() for s, i in self.special.items()}
        return spec["model"]


class Merges(Vocabulary):
    """A merge list over byte strings: ranks, ids, and the lookahead that makes a token final."""

    def __init__(self, path: str) -> None:
        merges = self._load(path)["merges"]
        letter = _byte_letters()
        raw = lambda s: bytes(letter[c] for c in s)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        self.rules = [(raw(u), raw(v)) for u, v in pairs]
        self.rank = {pair: k for k, pair in enumerate(self.rules)}
        self.made = {u + v: k for k, (u, v) in reversed(list(enumerate(self.rules)))}
        for k, (u, v) in enumerate(self.rules):
            if any(len(x) > 1 and self.made.get(x, k) >= k for x in (u, v)):
                raise ValueError(f"merge {k} has a part that no earlier merge makes")
        self.lookahead = self._lookahead()
        # (left id, right id) as one number -> (rank, merged id) as one number
        self.table = PairTable({self.ids[u] << 20 | self.ids[v]: k << 20 | self.ids[u + v] for k, (u, v) in enumerate(self.rules)})
        self.first = [self.ids[bytes([b])] for b in range(256)]

    def _lookahead(self) -> int:
        longest: dict[bytes, int] = {}  # left part -> longest chain that ends with one of its rules so far
        for u, v in self.rules:
            reach, part = 0, v
            while True:
                reach = max(reach, longest.get(part, 0))
                if len(part) == 1:
                    break
                part = self.rules[self.made[part]][0]
            longest[u] = max(longest.get(u, 0), len(u) + reach)
        return max(longest.values(), default=0)

    def codes(self, tokens: list[bytes]) -> np.ndarray:
        return np.array([self.ids[t] for t in tokens], np.uint32)

    def merge(self, data: bytes) -> list[bytes]:
        """Tokens of a piece of any length, by the same rule; a heap keeps long pieces near-linear."""
        rank = self.rank
        token: list[bytes | None] = [data[i : i + 1] for i in range(len(data))]
        after, before = list(range(1, len(data) + 1)), list(range(-1, len(data) - 1))
        heap = [(rank[p], i) for i in range(len(data) - 1) if (p := (token[i], token[i + 1])) in rank]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i] if token[i] is not None else len(data)
            if j >= len(data) or rank.get((token[i], token[j])) != r:
                continue
            token[i], token[j] = token[i] + token[j], None
            after[i] = after[j]
            if after[i] < len(data):
                before[after[i]] = i
            for a in (before[i], i):
                b = after[a] if a >= 0 else len(data)
                if b < len(data) and (p := (token[a], token[b])) in rank:
                    heapq.heappush(heap, (rank[p], a))
        return [t for t in token if t is not None]


class Stream:
    """What has been read of a text and is not final yet: characters, or the last bytes of a long piece and its kind."""

    def __init__(self) -> None:
        self.tail, self.open, self.kind = "", b"", None


class Transducer:
    """Texts in chunks of any size -> ids, as soon as they are final."""

    def __init__(self, merges: Merges) -> None:
        self.m, self.known = merges, Known(KEPT)
        self.kinds = [regex.compile(k) for k in _KINDS]
        self.hold = max(merges.lookahead, 4)  # the pattern itself looks three characters ahead
        self.window = 4 * merges.lookahead + 64

    @staticmethod
    @functools.lru_cache(2)
    def at(path: str) -> Transducer:
        return Transducer(Merges(path))

    def _long(self, s: Stream, data: bytes, last: bool) -> Iterator[np.ndarray]:
        """Final tokens of a long piece, given its next bytes."""
        s.open += data
        while len(s.open) > self.window or last and s.open:
            head = s.open[: self.window]
            tokens = self.m.merge(head)
            end = len(head) - (0 if last and len(head) == len(s.open) else self.m.lookahead)
            at = kept = 0
            while kept < len(tokens) and at + len(tokens[kept]) <= end:
                at += len(tokens[kept])
                kept += 1
            yield self.m.codes(tokens[:kept])
            s.open = s.open[at:]

    def _inside(self, s: Stream, text: str, last: bool, out: list[np.ndarray]) -> str:
        """Reads on in a long piece; what follows it is returned."""
        run = self.kinds[s.kind].match(text)
        end = run.end() if run else 0
        done = last or end < len(text)
        if s.kind == SPACE and end and not (last and end == len(text)):
            end -= 1  # the last of a run of white space may go with what follows
        out += self._long(s, text[:end].encode(), done)
        if done:
            s.kind = None
            return text[end:]
        s.tail = text[end:]
        return ""

    def _solved(self, pieces: pa.Array) -> Codes:
        """Ids of distinct pieces: short ones merged in step, others one by one."""
        data, at = buffers(pieces)
        size = np.diff(at)
        short, rest = np.flatnonzero(size <= LONGEST), np.flatnonzero(size > LONGEST)
        found = merge_all(data, at[short], size[short], self.m.table, self.m.first)
        own = Codes.of([np.concatenate([*self._long(Stream(), data[at[i] : at[i + 1]].tobytes(), True)]) for i in rest.tolist()])
        out_at, out_size = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
        out_at[short], out_size[short] = found.at, found.size
        out_at[rest], out_size[rest] = own.at + len(found.flat), own.size
        return Codes(np.concatenate([found.flat, own.flat]), out_at, out_size)

    def step(self, streams: list[Stream], chunks: list[str], last: list[bool]) -> list[list[np.ndarray]]:
        """Each stream's next chunk (``last``: its end) -> the ids that are final now."""
        out: list[list[np.ndarray]] = [[] for _ in streams]
        texts = []
        for s, chunk, end, own in zip(streams, chunks, last, out, strict=True):
            text, s.tail = s.tail + chunk, ""
            texts.append(text if s.kind is None else self._inside(s, text, end, own))
        data, offsets = buffers(pa.array(texts, pa.large_string()))
        data = data.tobytes()
        c = Characters.of(data, offsets)
        starts = byte_level(c)
        at = np.append(c.bytes_at[starts], len(data))
        firsts = np.searchsorted(starts, c.texts_at)
        final = np.ones(len(starts), bool)
        for i in np.flatnonzero(~np.array(last, bool)).tolist():
            a, b = int(firsts[i]), int(firsts[i + 1])
            k = a + int(np.searchsorted(at[a + 1 : b + 1], offsets[i + 1] - self.hold, "right"))
            final[k:b] = False
            if k == b:
                continue
            rest, s = data[at[k] : offsets[i + 1]].decode(), streams[i]
            if k == b - 1 and offsets[i + 1] - at[k] > self.window:
                s.kind = int(kinds()[ord(rest[-1])])
                s.tail = rest[-1] if s.kind == SPACE else ""
                held = rest[: len(rest) - len(s.tail)].encode()
            else:
                s.tail, held = rest, b""
            if held:
                out[i] += [*self._long(s, held, False)]
        pieces = spans(data, at)
        pieces = (pieces if final.all() else pieces.filter(pa.array(final))).dictionary_encode()
        ids, id_at = self.known.of(pieces.dictionary, self._solved).gather(pieces.indices.to_numpy(zero_copy_only=False))
        ends = id_at[np.concatenate([[0], np.cumsum(final)])[firsts]].tolist()
        for own, s, a, b in zip(out, streams, ends[:-1], ends[1:], strict=True):
            # What a stream has just begun as a long piece lies behind its other pieces.
            own.insert(len(own) if s.kind is None else 0, ids[a:b])
        return out

    def encode_arrays(self, texts: list[str], chunk: int = CHUNK) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole texts, end to end, and the n+1 offsets of the n texts. The vocabulary's special tokens stand for themselves."""
        (name, special), *others = self.m.special.items()
        if others:
            raise ValueError("a vocabulary with one special token is expected")
        split = [t.split(name) if name in t else [t] for t in texts]
        parts = [p for t in split for p in t]
        found: list[list[np.ndarray]] = [[] for _ in parts]
        streams = [Stream() for _ in parts]
        going, at = [i for i, p in enumerate(parts) if p], 0
        while going:
            last = [at + chunk >= len(parts[i]) for i in going]
            for i, ids in zip(going, self.step([streams[i] for i in going], [parts[i][at : at + chunk] for i in going], last), strict=True):
                found[i] += ids
            going, at = [i for i, end in zip(going, last, strict=True) if not end], at + chunk
        all_, sizes, k, mark = [], [], 0, np.array([special], np.uint32)
        for t in split:
            size = 0
            for j in range(len(t)):
                own = ([mark] if j else []) + found[k]
                all_ += own
                size += sum(map(len, own))
                k += 1
            sizes.append(size)
        return np.concatenate([*all_, np.zeros(0, np.uint32)]), np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])

    def encode_many(self, texts: list[str], chunk: int = CHUNK) -> list[bytes]:
        """Little-endian 32-bit ids of whole texts."""
        ids, at = self.encode_arrays(texts, chunk)
        return [ids[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]


# States of the decoder: between characters; in one, with 1 to 3 bytes to come; in one whose next byte is further
# restricted, as overlong forms, surrogates and numbers beyond Unicode are none; not UTF-8.
_BETWEEN, _ONE, _TWO, _THREE, _E0, _ED, _F0, _F4, _BAD = range(9)
_LEADS = ((0x00, 0x7F, _BETWEEN), (0xC2, 0xDF, _ONE), (0xE0, 0xE0, _E0), (0xE1, 0xEF, _TWO), (0xED, 0xED, _ED), (0xF0, 0xF0, _F0), (0xF1, 0xF3, _THREE), (0xF4, 0xF4, _F4))
_GOES_ON = {_ONE: (0x80, 0xBF, _BETWEEN), _TWO: (0x80, 0xBF, _ONE), _THREE: (0x80, 0xBF, _TWO), _E0: (0xA0, 0xBF, _ONE), _ED: (0x80, 0x9F, _ONE), _F0: (0x90, 0xBF, _TWO), _F4: (0x80, 0x8F, _TWO)}


def _transitions() -> list[list[int]]:
    out = [[_BAD] * 256 for _ in range(9)]
    for a, b, state in _LEADS:
        out[_BETWEEN][a : b + 1] = [state] * (b + 1 - a)
    for state, (a, b, then) in _GOES_ON.items():
        out[state][a : b + 1] = [then] * (b + 1 - a)
    return out


class Decoder:
    """Bytes in runs of any size -> text; holds the bytes of an unfinished character, three at most, from run to run.

    A byte that goes on no character, and a character that breaks off, are U+FFFD.
    """

    _next = _transitions()

    def __init__(self) -> None:
        self.held = b""

    def _unfinished(self, data: bytes) -> int:
        """How many last bytes begin a character that more bytes may finish."""
        for n in range(min(3, len(data)), 0, -1):
            state = _BETWEEN
            for k, byte in enumerate(data[-n:]):
                state = self._next[state][byte]
                if state == _BAD or state == _BETWEEN and k < n - 1:
                    state = _BAD
                    break
            if state not in (_BETWEEN, _BAD):
                return n
        return 0

    def feed(self, data: bytes, last: bool = False) -> str:
        data = self.held + data
        n = 0 if last else self._unfinished(data)
        self.held = data[len(data) - n :]
        return data[: len(data) - n].decode("utf-8", "replace")


class Letters:
    """Bytes of ids as arrays, to be put together for runs of ids."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        each = [vocabulary.bytes_of.get(i, b"") for i in range(max(vocabulary.bytes_of) + 1)]
        self.size = np.array([len(b) for b in each], np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(each), np.uint8)
        self.known = np.array([i in vocabulary.bytes_of for i in range(len(each))])

    @staticmethod
    @functools.lru_cache(2)
    def of(path: str) -> Letters:
        return Letters(Vocabulary.at(path))

    def texts(self, ids: np.ndarray, at: np.ndarray, chunk: int = CHUNK) -> list[str]:
        """Texts of runs of ids between offsets, through a decoder each. Ids that the vocabulary has not raise KeyError."""
        if len(ids) and not (0 <= ids.min() and ids.max() < len(self.size) and self.known[ids].all()):
            raise KeyError("id beyond the vocabulary")
        size = self.size[ids]
        ends = np.concatenate([[0], np.cumsum(size)])
        data = self.flat[np.repeat(self.at[ids] - ends[:-1], size) + np.arange(ends[-1])].tobytes()
        out = []
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            state, parts = Decoder(), []
            for k in range(a, b, chunk):
                end = min(k + chunk, b)
                parts.append(state.feed(data[ends[k] : ends[end]], end == b))
            out.append("".join(parts))
        return out


def _lists(ids: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.view(np.int32)))


def _encoded(vocabulary: str, decoded: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer, letters = Transducer.at(vocabulary), Letters.of(vocabulary) if decoded else None
        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                ids, at = transducer.encode_arrays([text or "" for text in part.column(1).to_pylist()])
                texts = [pa.array(letters.texts(ids, at), pa.string())] if decoded else []
                yield pa.RecordBatch.from_arrays([part.column(0), _lists(ids, at), *texts], ["doc_id", "ids", "decoded"][: 2 + decoded])
        transducer.known.forget()
        release()

    return run


def _decoded(vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = Letters.of(vocabulary)
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                some = batch.slice(k, 512)
                ids = some.column(some.num_columns - 1)
                at = np.concatenate([[0], np.cumsum(pc.fill_null(ids.value_lengths(), 0).to_numpy(zero_copy_only=False))]).astype(np.int64)
                flat = pc.list_flatten(ids).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(letters.texts(flat, at), pa.string())], [*some.schema.names, "decoded"])

    return run


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """doc_id, ids (array of int) of every whole text; null counts as empty, and an empty text has no ids.

    ``decoded`` adds the text that the ids decode to, from the same pass.

    ``vocabulary`` is the path of a byte-level BPE file cut as ``cutting.byte_level`` does; its special token stands for itself
    in a text. Repeated rows, equal and null ids are kept as they are; no rows give none. Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_encoded(vocabulary, decoded), "doc_id long, ids array<int>" + ", decoded string" * decoded)


def decode(encoded: DataFrame, vocabulary: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with the text of its ids as ``decoded``; bytes that are no UTF-8 become U+FFFD, null ids an empty text.

    A column ``decoded`` that is already there is replaced.
    """
    rows = encoded.select(*[F.col(f"`{c}`") for c in encoded.columns if c not in (ids_col, "decoded")], F.col(f"`{ids_col}`").cast("array<int>").alias(ids_col))
    return map_batches(rows, _decoded(vocabulary), T.StructType([*rows.schema.fields, T.StructField("decoded", T.StringType())]))
