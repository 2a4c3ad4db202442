"""BPE merges of many short pieces in step."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_NONE = np.int64(1) << 60
_PAD = (1 << 20) - 1
LONGEST = 48


class PairTable:
    """A merge list as a hash table over pairs of ids, looked up for whole arrays."""

    def __init__(self, merges: dict[int, int]) -> None:
        """``merges``: left id << 20 | right id -> rank << 20 | merged id."""
        self.keys = np.array([-1, *merges], np.int64)
        self.values = np.array([_NONE, *merges.values()], np.int64)
        self.first, self.second = np.zeros(1 << 21, np.int32), np.zeros(1 << 16, np.int32)
        at = self._slot(self.keys[1:], 0x9E3779B97F4A7C15, 43)
        _, one = np.unique(at, return_index=True)
        self.first[at[one]] = one + 1
        rest = np.setdiff1d(np.arange(len(at)), one)
        at = self._slot(self.keys[1:][rest], 0xC2B2AE3D27D4EB4F, 48)
        kept, one = np.unique(at, return_index=True)
        self.second[kept] = rest[one] + 1
        #: Those that found no free slot in either; a handful.
        self.third = {int(self.keys[k + 1]): int(self.values[k + 1]) for k in np.delete(rest, one)}

    @staticmethod
    def _slot(keys: np.ndarray, factor: int, shift: int) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(factor)) >> np.uint64(shift)).astype(np.int64)

    def __call__(self, pairs: np.ndarray) -> np.ndarray:
        out = np.full(pairs.shape, _NONE)
        for table, factor, shift in ((self.first, 0x9E3779B97F4A7C15, 43), (self.second, 0xC2B2AE3D27D4EB4F, 48)):
            k = table[self._slot(pairs, factor, shift)]
            hit = self.keys[k] == pairs
            out[hit] = self.values[k[hit]]
        for key, value in self.third.items():
            out[pairs == key] = value
        return out


class Codes:
    """Runs of ids for numbered pieces: where each begins in ``flat``, and its length."""

    def __init__(self, flat: np.ndarray, at: np.ndarray, size: np.ndarray) -> None:
        self.flat, self.at, self.size = flat, at, size

    @staticmethod
    def of(runs: list[np.ndarray]) -> Codes:
        size = np.array([len(r) for r in runs], np.int64)
        return Codes(np.concatenate([*runs, np.zeros(0, np.uint32)]).astype(np.uint32), np.cumsum(size) - size, size)

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces with these numbers, end to end, and the n+1 offsets of the n pieces."""
        size = self.size[numbers]
        at = np.concatenate([[0], np.cumsum(size)])
        return self.flat[np.repeat(self.at[numbers] - at[:-1], size) + np.arange(at[-1])], at


def merge_all(data: np.ndarray, at: np.ndarray, size: np.ndarray, table: PairTable, first: list[int], last: list[int] | None = None) -> Codes:
    """Ids of pieces of 1 to ``LONGEST`` bytes each, which begin at ``at`` in ``data``.

    ``first`` has the id of each byte, ``last`` that of a piece's last byte where it differs. Always the first of a
    piece's pairs of least rank is merged; each round merges one pair in every piece that still has one.
    """
    out, out_at, out_size, low, total = [], np.zeros(len(at), np.int64), np.zeros(len(at), np.int64), 0, 0
    first_ids, last_ids = np.array(first, np.int64), np.array(last if last else first, np.int64)
    for high in (4, 6, 9, 12, 16, 24, LONGEST):
        group = np.flatnonzero((size > low) & (size <= high))
        low = high
        for k in range(0, len(group), 20_000):
            for who, ids in _merge_group(group[k : k + 20_000], data, at, size, high, table, first_ids, last_ids):
                count = (ids != _PAD).sum(axis=1)
                out.append(ids[ids != _PAD].astype(np.uint32))
                out_at[who], out_size[who] = total + np.cumsum(count) - count, count
                total += len(out[-1])
    return Codes(np.concatenate([*out, np.zeros(0, np.uint32)]).astype(np.uint32), out_at, out_size)


def _merge_group(who: np.ndarray, data: np.ndarray, at: np.ndarray, size: np.ndarray, width: int, table: PairTable, first: np.ndarray, last: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pieces and rows of their ids, as they get ready."""
    n = size[who]
    column = np.arange(width + 1)
    inside = column < n[:, None]
    ids = np.full((len(who), width + 1), _PAD, np.int64)
    ids[inside] = first[data[(at[who][:, None] + column)[inside]]]
    ids[np.arange(len(who)), n - 1] = last[data[at[who] + n - 1]]
    found = table(ids[:, :-1] << 20 | ids[:, 1:])
    while True:
        row = np.arange(len(who))
        best = found.argmin(axis=1)
        value = found[row, best]
        done = value == _NONE
        if done.any():
            yield who[done], ids[done]
            open_ = ~done
            who, ids, found, best, value = who[open_], ids[open_], found[open_], best[open_], value[open_]
            if not len(who):
                return
            row = row[: len(who)]
        ids[row, best] = value & 0xFFFFF
        # Close the gap; only the two pairs at the merged place are new.
        move = np.arange(ids.shape[1] - 1)
        move = move + (move > best[:, None])
        ids = np.take_along_axis(ids, move, axis=1)
        ids = np.concatenate([ids, np.full((len(ids), 1), _PAD)], axis=1)
        found = np.take_along_axis(found, np.minimum(move, found.shape[1] - 1), axis=1)
        found[row, best] = table(ids[row, best] << 20 | ids[row, best + 1])
        left = np.flatnonzero(best > 0)
        found[left, best[left] - 1] = table(ids[left, best[left] - 1] << 20 | ids[left, best[left]])


class Known:
    """The ids of pieces met before: at most about ``limit`` of them, those met last."""

    def __init__(self, limit: int) -> None:
        self.limit, self.clock = limit, 0
        self.forget()

    def forget(self) -> None:
        self.pieces, self.met = pa.array([], pa.binary()), np.zeros(0, np.int64)
        self.codes = Codes.of([])

    def of(self, pieces: pa.Array, solve: Callable[[pa.Array], Codes]) -> Codes:
        """Codes of distinct pieces, in their order; ``solve`` makes those of pieces not met before."""
        self.clock += 1
        at = pc.index_in(pieces, value_set=self.pieces)
        unmet = pc.is_null(at)
        new = pieces.filter(unmet)
        at = pc.fill_null(at, 0).to_numpy(zero_copy_only=False).copy()
        if len(new):
            c, made = self.codes, solve(new)
            at[unmet.to_numpy(zero_copy_only=False)] = len(c.at) + np.arange(len(new))
            self.codes = Codes(np.concatenate([c.flat, made.flat]), np.concatenate([c.at, made.at + len(c.flat)]), np.concatenate([c.size, made.size]))
            self.pieces = pa.concat_arrays([self.pieces, new])
            self.met = np.concatenate([self.met, np.zeros(len(new), np.int64)])
        self.met[at] = self.clock
        found = Codes(self.codes.flat, self.codes.at[at], self.codes.size[at])
        if len(self.met) > self.limit:
            kept = np.sort(np.argsort(-self.met, kind="stable")[: self.limit // 2])
            flat, where = self.codes.gather(kept)
            self.codes = Codes(flat, where[:-1], np.diff(where))
            self.pieces, self.met = self.pieces.take(pa.array(kept)), self.met[kept]
        return found
