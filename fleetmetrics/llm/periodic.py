r"""Periodic runs of words: maximal stretches in which a block of words comes three times or more on end.

A run of period q and length 3q or more holds two equal windows of words, q apart. Scale after scale, each half as large
again as the one before, takes the periods from Q to 1.5 Q: the minimizer of a window of 1.5 Q places is the place whose
gram of Q / 2 words has the least hash. Windows q apart have the same minimizer, so pairs of equal minimizers between Q
and 1.5 Q apart seed all runs of the scale; each seed is extended both ways. Grams inside a run of less than a sixth of Q
are left out, as their minimizers would pair at that run's distance; a larger run always has others. What is left of equal
grams lies Q / 6 apart at least, so a minimizer has nine partners at most, however repetitive a text is. Periods under 48
are too short for grams of 24 words: their lags are scanned directly, at steps that no run is short enough to pass between.

Extension compares prefix hashes by bisection; runs found are compared word by word before they count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fleetmetrics.llm.shared import buffers, map_batches, mixed, ship, slices

#: A run has this many words, and so many times its period, at least.
LEAST, TIMES = 24, 3
#: The least period that minimizers find; shorter ones are scanned.
FIRST = 2 * LEAST
SLICE_BYTES = 4_000_000
BLANK = r"[\x20\x09-\x0D]+"
U = np.uint64
_R = 0x9E3779B97F4A7C15
_INVERSE = pow(_R, -1, 1 << 64)
_NONE = U(0xFFFFFFFFFFFFFFFF)
_PLACE_BITS = U(31)  # a batch of strings has fewer bytes than that
_IS_BLANK = np.zeros(256, bool)
_IS_BLANK[[32, *range(9, 14)]] = True


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All words of many texts, coded by their bytes, and the n+1 offsets of each text's words."""
    inside = ~_IS_BLANK[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cut = offsets[(offsets > 0) & (offsets < len(data))]
    first[cut], last[cut - 1] = inside[cut], inside[cut - 1]
    starts = np.flatnonzero(first)
    sizes = np.flatnonzero(last) + 1 - starts
    ends = np.concatenate([[0], np.cumsum(sizes)])
    array = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data[inside])])
    return array.dictionary_encode(), np.searchsorted(starts, offsets)


class _Texts:
    """Word numbers of many texts on end, with the bounds of each word's text, and hashes of any stretch."""

    def __init__(self, words: np.ndarray, offsets: np.ndarray) -> None:
        self.words, self.offsets = words, offsets
        self.text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        value = mixed(words.astype(np.uint64) + U(1))
        n = len(words)
        self.power = np.multiply.accumulate(np.concatenate([[U(1)], np.full(n, U(_R))]))
        self.inverse = np.multiply.accumulate(np.concatenate([[U(1)], np.full(n, U(_INVERSE))]))
        self.prefix = np.concatenate([[U(0)], np.cumsum(value * self.power[:-1], dtype=np.uint64)])

    def same(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether stretches at a and at b > a look equal."""
        p = self.prefix
        return (p[a + size] - p[a]) * self.power[b - a] == p[b + size] - p[b]

    def grams(self, k: int, n: int) -> np.ndarray:
        """Hashes of the grams of k words at the places below n - k + 1."""
        p = self.prefix[: n + 1]
        return mixed((p[k:] - p[:-k]) * self.inverse[: n - k + 1])

    def stretches(self, at: np.ndarray, lag: np.ndarray) -> np.ndarray:
        """Of places at which a word equals that ``lag`` words on: rows of start, end, period of the longest stretch of that period, where it is long enough for a run."""
        low, high = self.offsets[self.text[at]], self.offsets[self.text[at] + 1] - lag
        forth = self._reach(at, high - at, lambda some, size: self.same(at[some], at[some] + lag[some], size))
        back = self._reach(at, at - low, lambda some, size: self.same(at[some] - size, at[some] - size + lag[some], size))
        rows = np.stack([at - back, at + forth + lag, lag], axis=1)
        return np.unique(rows[forth + back + lag >= np.maximum(LEAST, TIMES * lag)], axis=0)

    @staticmethod
    def _reach(at: np.ndarray, most: np.ndarray, same) -> np.ndarray:
        """The largest size up to ``most`` for which ``same`` holds: doubled while it does, then bisected."""
        low, high = np.zeros(len(at), np.int64), most.copy()
        some, size = np.flatnonzero(most > 0), 1
        while len(some):
            step = np.minimum(size, most[some])
            ok = same(some, step)
            low[some[ok]] = step[ok]
            high[some[~ok]] = step[~ok] - 1
            some = some[ok & (step < most[some])]
            size *= 2
        some = np.flatnonzero(low < high)
        while len(some):
            middle = (low[some] + high[some] + 1) // 2
            ok = same(some, middle)
            low[some[ok]] = middle[ok]
            high[some[~ok]] = middle[~ok] - 1
            some = some[low[some] < high[some]]
        return low


def _lags(t: _Texts) -> Iterator[np.ndarray]:
    """Stretches of periods under ``FIRST``: a run has more equal words at its lag than the step from one place looked at to the next."""
    n = len(t.words)
    for q in range(1, FIRST):
        at = np.arange(0, n - q, max(LEAST, TIMES * q) - q)
        at = at[(t.words[at] == t.words[at + q]) & (t.text[at] == t.text[at + q])]
        if len(at):
            yield t.stretches(at, np.full(len(at), q))


def _minima(key: np.ndarray, width: int) -> np.ndarray:
    """Least key of every window of so many places."""
    n = len(key)
    rows = -(-n // width)
    padded = np.concatenate([key, np.full(rows * width - n, _NONE)]).reshape(rows, width)
    forth = np.minimum.accumulate(padded, axis=1).ravel()
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], forth[width - 1 : n])


def _scale(t: _Texts, q: int, n: int, known: np.ndarray) -> np.ndarray | None:
    """Stretches of periods from q up to 1.5 q in the first n words, from pairs of equal minimizers; ``known`` has those of all shorter periods."""
    above = -(-3 * q // 2)
    k, width = q // 2, above
    if n < k + width:
        return None
    gram = t.grams(k, n)
    out = np.zeros(len(gram) + 1, np.int32)
    regular = known[(known[:, 2] * 3 <= k) & (known[:, 1] - known[:, 0] >= k) & (known[:, 0] < len(gram))]
    np.add.at(out, regular[:, 0], 1)
    np.add.at(out, np.minimum(regular[:, 1] - k + 1, len(gram)), -1)
    place = np.arange(len(gram), dtype=np.uint64)
    key = (gram >> _PLACE_BITS << _PLACE_BITS) | place
    key[(np.cumsum(out[:-1]) > 0) | (t.text[: len(gram)] != t.text[k - 1 : k - 1 + len(gram)])] = _NONE
    least = _minima(key, width)
    least = least[least != _NONE]
    at = np.unique(least & ((U(1) << _PLACE_BITS) - U(1))).astype(np.int64)
    order = np.lexsort((at, gram[at]))
    at = at[order]
    value = gram[at]
    first, lag = [], []
    for i in range(1, 10):
        d = at[i:] - at[:-i]
        pair = (value[i:] == value[:-i]) & (d >= q) & (d < above) & (t.text[at[i:]] == t.text[at[:-i]])
        first.append(at[:-i][pair])
        lag.append(d[pair])
    at, d = np.concatenate(first), np.concatenate(lag)
    ok = t.words[at] == t.words[at + d]
    return t.stretches(at[ok], d[ok]) if ok.any() else None


def _exact(t: _Texts, rows: np.ndarray) -> np.ndarray:
    """Stretches compared word by word; one that only looks equal is looked for again that way."""
    out = []
    for s, e, q in rows.tolist():
        if np.array_equal(t.words[s : e - q], t.words[s + q : e]):
            out.append((s, e, q))
            continue
        low, high = t.offsets[t.text[s]], t.offsets[t.text[s] + 1]
        w = t.words[low:high]
        bounds = np.flatnonzero(np.concatenate([[True], w[:-q] != w[q:], [True]]))
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):  # equal from a to b - 1
            if b - 1 - a + q >= max(LEAST, TIMES * q):
                out.append((int(low) + a, int(low) + b - 1 + q, q))
    return np.array(sorted(set(out)), np.int64).reshape(-1, 3)


def runs_of(words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of start (in the text), length and period of every run of many texts, by text, start and period; and the text of each."""
    sizes = np.diff(offsets)
    order = np.argsort(-sizes, kind="stable")  # so that the texts that are long enough for a scale are the first words
    ends = np.cumsum(sizes[order])
    moved = np.repeat(offsets[:-1][order] - (ends - sizes[order]), sizes[order]) + np.arange(len(words))
    t = _Texts(words[moved], np.concatenate([[0], ends]))
    found = [np.zeros((0, 3), np.int64), *_lags(t)]
    known, q = _smallest(np.concatenate(found)), FIRST
    while len(sizes) and sizes.max() >= TIMES * q:
        n = int(ends[np.searchsorted(-sizes[order], -TIMES * q, "right") - 1])
        more = _scale(t, q, n, known)
        if more is not None:
            known = _smallest(np.concatenate([known, more]))
        q = -(-3 * q // 2)
    known = _smallest(_exact(t, known))
    text = t.text[known[:, 0]]
    rows = np.stack([known[:, 0] - t.offsets[text], known[:, 1] - known[:, 0], known[:, 2]], axis=1)
    text = order[text]
    by = np.lexsort((rows[:, 2], rows[:, 0], text))
    return rows[by], text[by]


def _smallest(rows: np.ndarray) -> np.ndarray:
    """Of stretches with one start and end that of the smallest period: the others' periods are its multiples."""
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    return rows[np.concatenate([[True], (np.diff(rows[:, :2], axis=0) != 0).any(axis=1)])] if len(rows) else rows


def _kept(offsets: np.ndarray, rows: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Whether each word stays: those of a run after its first period go."""
    change = np.zeros(int(offsets[-1]) + 1, np.int64)
    start = offsets[text] + rows[:, 0]
    np.add.at(change, start + rows[:, 2], 1)
    np.add.at(change, start + rows[:, 1], -1)
    return np.cumsum(change[:-1]) == 0


def find_runs(docs: DataFrame, text_column: str = "text") -> DataFrame:
    r"""Columns n_words, runs (start, length, period, by start then period) and collapsed beside those of ``docs``, which they replace where names clash.

    Words are longest stretches without ``[\x20\x09-\x0D]``. A run is a stretch of words whose smallest period q has words q
    apart identical, of at least ``max(LEAST, TIMES * q)`` words, that no neighbouring word extends. ``collapsed`` is the
    words that stay, joined by blanks: those that no run holds behind its first q words. Null and empty texts have no
    words, no runs and an empty ``collapsed``. Rows are independent of each other, so repeated ones are alike and no rows
    give none. Memory grows with the longest text only, as some 100 bytes a word.
    """
    ship(docs.sparkSession)
    new = {"n_words": "long", "runs": "array<struct<start: long, length: long, period: long>>", "collapsed": "string"}
    kept = [c for c in docs.columns if c not in new]
    source = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text_column}`").alias("runs_text_"))
    schema = StructType([*source.drop("runs_text_").schema, *StructType.fromDDL(", ".join(f"{c} {kind}" for c, kind in new.items()))])
    struct = pa.struct([(x, pa.int64()) for x in ("start", "length", "period")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, batch.num_columns - 1, SLICE_BYTES):
                words, offsets = words_of(*buffers(part.column(part.num_columns - 1)))
                rows, text = runs_of(words.indices.to_numpy(), offsets)
                stays = _kept(offsets, rows, text)
                left = np.concatenate([[0], np.cumsum(stays)])[offsets]
                texts = words.dictionary.take(words.indices.filter(pa.array(stays))).cast(pa.large_string())
                joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(left), texts), pa.scalar(" ", pa.large_string())).cast(pa.string())
                each = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(rows[:, i])) for i in range(3)], fields=list(struct))
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(len(offsets))), pa.int32()), each)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(np.diff(offsets)), lists, joined], schema.names)

    return map_batches(source, run, schema)


def looped(text: Column, key: Column) -> Column:
    """A text whose words from a place on are repeated with a period, for a tenth of all keys: with g = key // 10, where key % 10 = 0, each word i >= a becomes word a + (i - a) % p, a = g % n, p = 1 + (n - a) // (3 + g % 8). Other texts stay as they are."""
    words = F.filter(F.split(text, BLANK), lambda w: w != "")
    n, g = F.size(words).cast("long"), F.floor(key / 10).cast("long")
    a = g % n
    p = F.lit(1).cast("long") + F.floor((n - a) / (F.lit(3) + g % 8)).cast("long")
    parts = F.named_struct(F.lit("w"), words, F.lit("n"), n, F.lit("a"), a, F.lit("p"), p)
    place = lambda x, i: F.when(i < x["a"], i).otherwise(x["a"] + (i - x["a"]) % x["p"])
    again = F.transform(F.array(parts), lambda x: F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), x["n"] - 1), lambda i: F.get(x["w"], place(x, i).cast("int"))), " "))
    return F.when((key % 10 == 0) & text.rlike(r"[^\x20\x09-\x0D]"), F.get(again, F.lit(0))).otherwise(text)
