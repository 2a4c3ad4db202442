"""Packing of token sequences into windows of a fixed length by the sum-of-squares rule, online.

A window that is partly filled to level h is one of N(h). A document of s tokens goes to the level h (or a new window)
for which the sum of N(h)**2 over all levels grows least: such a choice keeps the levels spread out, so that most later
documents find a level that they fill exactly. It may also be cut, to fill a window up and begin another with the rest,
where that beats all others by more than ``CUT``: so a level never holds many more than ``CUT`` windows, however alike
documents are. Every task packs its own rows; what it leaves open at its end is joined by cutting, so that one window
a task stays padded at most.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmetrics.llm.shared import release, slices
from fleetmetrics.llm.words import WordTokenizer

SLICE_BYTES = 1_000_000
#: What a cut costs, in halves of the sum of squares.
CUT = 16
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Packer:
    """Sum-of-squares placement into windows of ``size`` tokens; keeps the level array and the windows that are open."""

    def __init__(self, size: int, first_id: int) -> None:
        self.size, self.next_id = size, first_id
        self.count = np.zeros(size + 1, np.int64)  # N(h)
        self.at: dict[int, list[list[tuple]]] = {}  # level -> open windows, each a list of pieces
        self.rows: list[tuple] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """Place one document, given as little-endian 32-bit ids. Whole windows are cut off first."""
        total, step = len(ids) // 4, self.size * 4
        whole = total // self.size
        for k in range(whole):
            self._close([(doc_id, k * self.size, ids[k * step : (k + 1) * step], total)])
        if rest := ids[whole * step :]:
            self._place((doc_id, whole * self.size, rest, total), total % self.size)

    def _place(self, piece: tuple, s: int) -> None:
        n, last = self.count, self.size - s
        # Growth of the sum of squares, halved: N(h + s) - N(h) + 1; N(s) + 1/2 for a new window, 1/2 - N(h) for one filled up.
        best, h = float(n[s]) + 0.5, 0
        levels = np.flatnonzero(n[1:last]) + 1
        if len(levels):
            growth = n[levels + s] - n[levels] + 1
            if growth[k := int(growth.argmin())] < best:
                best, h = float(growth[k]), int(levels[k])
        if n[last] and 0.5 - n[last] <= best:
            best, h = 0.5 - n[last], last
        # One filled up, the rest of the piece in a new window: N(h + s - size) - N(h) + 1.
        if best > CUT + 1 - int(n[last + 1 : self.size].max(initial=0)):
            growth = n[1:s] - n[last + 1 : self.size] + 1 + CUT
            if growth[k := int(growth.argmin())] < best:
                doc_id, start, ids, total = piece
                room = s - 1 - k
                window = self._take(last + 1 + k)
                self._close([*window, (doc_id, start, ids[: room * 4], total)])
                self._open([(doc_id, start + room, ids[room * 4 :], total)], k + 1)
                return
        pieces = [*self._take(h), piece]
        if h + s == self.size:
            self._close(pieces)
        else:
            self._open(pieces, h + s)

    def _take(self, h: int) -> list[tuple]:
        if not h:
            return []
        self.count[h] -= 1
        return self.at[h].pop()

    def _open(self, pieces: list[tuple], h: int) -> None:
        self.count[h] += 1
        self.at.setdefault(h, []).append(pieces)

    def _close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, ids, total in pieces:
            self.rows.append((doc_id, start, len(ids) // 4, zlib.crc32(ids), total, self.next_id, offset))
            offset += len(ids) // 4
        self.next_id += 1

    def join_open(self) -> None:
        """Fill the fullest open windows with cuts of the emptiest; one window stays partly filled at most."""
        open_ = [w for h in sorted(self.at, reverse=True) for w in self.at[h]]
        self.at.clear()
        self.count[:] = 0
        low = len(open_) - 1
        for k, window in enumerate(open_):
            if k > low:
                break
            room = self.size - sum(len(p[2]) // 4 for p in window)
            while room and low > k:
                doc_id, start, ids, total = open_[low].pop()
                cut = min(room, len(ids) // 4)
                window.append((doc_id, start, ids[: cut * 4], total))
                room -= cut
                if len(ids) > cut * 4:
                    open_[low].append((doc_id, start + cut, ids[cut * 4 :], total))
                if not open_[low]:
                    low -= 1
            self._close(window)


def _packed(vocabulary: str, size: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        packer = Packer(size, TaskContext.get().partitionId() << 36)
        tokenizer, end = WordTokenizer.at(vocabulary), np.uint32(end_id)

        def out() -> pa.RecordBatch:
            rows, packer.rows = packer.rows, []
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], [f.split()[0] for f in PIECES.split(", ")])

        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                ids, at = tokenizer.encode_arrays(part.column(1))
                data, at = np.insert(ids, at[1:], end).tobytes(), ((at + np.arange(len(at))) * 4).tolist()
                for doc_id, a, b in zip(part.column(0).to_pylist(), at[:-1], at[1:], strict=True):
                    packer.add(doc_id, data[a:b])
                yield out()
        packer.join_open()
        yield out()
        tokenizer.forget()
        release()

    return run


def pack(docs: DataFrame, vocabulary: str, size: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents, packed: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids are those of its text with ``end_id`` after them; null counts as empty, and so has one id. Every id
    lies in one piece. ``offset`` runs on without a gap within a sequence; sequences are at most ``size`` long, and all
    but one a task are full. Repeated rows, equal ids and null ids are packed like any others. No rows give no pieces.
    Memory a task: a slice of documents and the open windows, about ``CUT`` a level at most. Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_packed(vocabulary, size, end_id), PIECES)
