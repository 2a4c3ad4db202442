"""Line dedup: lines that several documents share stay in the smallest document only.

Two Bloom filters tell which keys of lines may be in two documents: one holds what has been seen once, the other what has
been seen once more. Tasks fill filters of their own, and these are put together by words of 64 bits: what two tasks have
both seen has been seen twice. Only lines that the second filter suspects are shuffled, as digests of 128 bits. They are
confirmed exactly by grouping, which also gives the smallest document. Equal digests count as equal keys.

Filters are as large as the number of keys asks for, up to ``FILTER_BITS``. More keys than that are taken in ranges of
their hashes, one after another: the keys are written sorted by hash, so a range reads only its own part of the files.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmetrics.llm.shared import map_batches, materialise, mixed, ship, tidy

LEAST = 10
#: Bits of a filter for each key, and the most bits of a filter (64 MB).
BITS_A_KEY, FILTER_BITS = 8, 1 << 29
#: Keys with more than this share of all suspected lines meet their first document in a broadcast join: at most 1000 keys.
HEAVY = 1000
_BLANK, _CONTINUATION = b" \t\n\x0b\x0c\r", bytes(range(0x80, 0xC0))
_BLOCK = 1 << 12
U = np.uint64


def line_key(line: bytes) -> bytes | None:
    """The key of a line in UTF-8: without blanks at both ends, A-Z in lower case. None if it has fewer than ``LEAST`` code points."""
    key = line.strip(_BLANK).lower()
    if len(key) < LEAST or (len(key) < 4 * LEAST and len(key.translate(None, _CONTINUATION)) < LEAST):
        return None
    return key


def _digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


class Bloom:
    """A Bloom filter in which a key sets four bits of one word of 64."""

    def __init__(self, words: np.ndarray) -> None:
        self.words = words

    @staticmethod
    def size_for(keys: int) -> int:
        """Words for so many keys: a power of two."""
        return 1 << max(6, (min(FILTER_BITS, max(1, keys) * BITS_A_KEY) - 1).bit_length() - 6)

    @staticmethod
    def places(h: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
        """The word of each 64-bit hash, and its bits there."""
        bits = np.zeros(len(h), np.uint64)
        for i in range(4):
            bits |= U(1) << ((h >> U(6 * i)) & U(63))
        return (h >> U(24)).astype(np.int64) & (words - 1), bits

    def has(self, h: np.ndarray) -> np.ndarray:
        at, bits = self.places(h, len(self.words))
        return (self.words[at] & bits) == bits

    def add(self, h: np.ndarray) -> None:
        np.bitwise_or.at(self.words, *self.places(h, len(self.words)))


def _hash(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).view(np.uint64)


def _twice(keys: DataFrame, words: int, column: str) -> Bloom:
    """The second filter over a column of 64-bit hashes: no key that came twice is missing."""

    @tidy
    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = Bloom(np.zeros(words, np.uint64)), Bloom(np.zeros(words, np.uint64))
        for batch in batches:
            h, n = np.unique(_hash(batch.column(0)), return_counts=True)
            twice.add(h[(n > 1) | once.has(h)])
            once.add(h)
        used = np.flatnonzero(once.words)
        for i in range(0, len(used), 1 << 16):
            at = used[i : i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(at // _BLOCK), pa.array(at), pa.array(once.words[at].view(np.int64)), pa.array(twice.words[at].view(np.int64))], ["block", "word", "once", "twice"])

    @tidy
    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, np.ndarray] = {}
        for batch in batches:
            word, once, twice = batch.column(1).to_numpy(), _hash(batch.column(2)), _hash(batch.column(3))
            for b in np.unique(word // _BLOCK):
                filters = blocks.setdefault(int(b), np.zeros((2, _BLOCK), np.uint64))
                mine = np.flatnonzero(word // _BLOCK == b)
                order = mine[np.argsort(word[mine], kind="stable")]
                at = word[order] % _BLOCK
                np.bitwise_or.at(filters[1], at, twice[order])
                first = np.flatnonzero(np.diff(at, prepend=-1))
                rank = np.arange(len(at)) - np.repeat(first, np.diff(first, append=len(at)))
                for k in range(int(rank.max()) + 1):  # the k-th task that has a word
                    some = rank == k
                    filters[1][at[some]] |= filters[0][at[some]] & once[order[some]]
                    filters[0][at[some]] |= once[order[some]]
        for b, filters in blocks.items():
            yield pa.RecordBatch.from_arrays([pa.array([b]), pa.array([filters[1].tobytes()])], ["block", "bits"])

    pieces = keys.select(column).mapInArrow(local, "block long, word long, once long, twice long").repartition("block").mapInArrow(joined, "block long, bits binary")
    out = np.zeros(max(words, _BLOCK), np.uint64)
    for row in pieces.toArrow().to_pylist():  # FILTER_BITS at most
        out[row["block"] * _BLOCK : (row["block"] + 1) * _BLOCK] = np.frombuffer(row["bits"], np.uint64)
    return Bloom(out[:words])


@tidy
def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found, ids = [], []
        for doc, text in zip(batch.column(0), batch.column(1), strict=True):
            some = {_digest(k) for line in (text.as_py() or b"").split(b"\n") if (k := line_key(line)) is not None}
            found += some
            ids.append(np.full(len(some), doc.as_py(), np.int64))
        h = np.frombuffer(b"".join(found), np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(h[:, 0])), pa.array(np.ascontiguousarray(h[:, 1])), pa.array(np.concatenate([*ids, np.zeros(0, np.int64)]))], ["hash", "rest", "id"])


def repeated_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Columns id, hash (the first half of the key's digest) of lines that a smaller document has as well.

    Rows without an id take no part. Rows with one id are one document.
    """
    ship(docs.sparkSession)
    texts = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text_column}`").cast("binary").alias("text")).where("id is not null")
    keys = materialise(texts.mapInArrow(_keys, "hash long, rest long, id long").sortWithinPartitions("hash"), "line-keys")
    n = keys.count()  # from the files' footers
    ranges = max(1, -(-n * BITS_A_KEY // FILTER_BITS))
    ends = [-(1 << 63) + (r << 64) // ranges for r in range(ranges)] + [(1 << 63) - 1]
    suspects = None
    for low, high in zip(ends[:-1], ends[1:], strict=True):
        h = F.col("hash")
        mine = keys.where((h >= low) & ((h <= high) if high == ends[-1] else (h < high)))
        suspects = _suspected(mine, _twice(mine, Bloom.size_for(n // ranges), "rest"), suspects)
    suspects = materialise(suspects, "line-suspects")
    return _confirmed(suspects)


def _suspected(keys: DataFrame, twice: Bloom, others: DataFrame | None) -> DataFrame:
    sent = keys.sparkSession.sparkContext.broadcast(twice.words)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(Bloom(sent.value).has(_hash(batch.column(1)))))

    found = keys.mapInArrow(run, keys.schema)
    return found if others is None else others.unionByName(found)


def _confirmed(suspects: DataFrame) -> DataFrame:
    """Suspected lines that are in two documents at least, but for those of the smallest. A key that many documents have is added up before the shuffle, and met in a broadcast join."""
    key = ["hash", "rest"]
    groups = suspects.groupBy(*key).agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count("*").alias("n"))
    groups = materialise(groups.where("first < last").drop("last"), "line-groups")
    heavy = F.col("n") * HEAVY > suspects.count()
    marked = suspects.join(F.broadcast(groups.where(heavy).select(*key, "first")), key, "left")
    of_heavy = marked.where("id > first")
    of_others = marked.where("first is null").drop("first").join(groups.where(~heavy).select(*key, "first"), key).where("id > first")
    return of_heavy.select("id", "hash").unionByName(of_others.select("id", "hash"))


def drop_repeated_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    r"""Documents without the lines that a document of a smaller id has too, and n_lines (before), n_dropped (longs).

    Texts are split at ``\n``; a null or empty text is one empty line, and both become the empty text. Lines are alike if
    their keys are (:func:`line_key`); lines with short keys stay. A line that comes twice in one document only stays
    twice. Rows with the same id are one document: none loses a line to another. Rows without an id keep all lines and
    take none away. Columns called n_lines or n_dropped are replaced, all others stay; no documents give none.

    Only documents that lose a line, and the few that a filter of their ids lets pass besides, are shuffled, once.
    """
    drops = repeated_lines(docs, id_column, text_column).groupBy("id").agg(F.collect_set("hash").alias("drop"))
    drops = materialise(drops, "line-drops")
    words = Bloom.size_for(drops.count())
    known = _any(drops.select("id"), words)
    sent = docs.sparkSession.sparkContext.broadcast(known.words)

    @F.pandas_udf("boolean")
    def may_lose(ids: pd.Series) -> pd.Series:
        return pd.Series(Bloom(sent.value).has(mixed(ids.to_numpy(np.int64).view(np.uint64))))

    name, id_ = f"`{text_column}`", F.col(f"`{id_column}`").cast("long")
    rows = docs.drop("n_lines", "n_dropped").withColumn(text_column, F.coalesce(F.col(name), F.lit("")))
    columns = rows.columns
    flagged = rows.withColumn("lines_id_", id_).withColumn("lines_may_", may_lose(F.coalesce("lines_id_", F.lit(0))) & F.col("lines_id_").isNotNull())
    n_lines = (F.octet_length(name) - F.octet_length(F.translate(name, "\n", "")) + 1).cast("long")
    plain = [F.col(f"`{c}`") for c in columns]
    whole = flagged.where("not lines_may_").select(*plain, n_lines.alias("n_lines"), F.lit(0).cast("long").alias("n_dropped"))
    some = flagged.where("lines_may_").join(drops.select(F.col("id").alias("lines_id_"), F.col("drop").alias("lines_drop_")).hint("shuffle_hash"), "lines_id_", "left").select(*plain, "lines_drop_")
    at = columns.index(text_column)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, before, dropped = [], [], []
            for text, drop in zip(batch.column(at), batch.column(batch.num_columns - 1), strict=True):
                lines, drop = text.as_py().encode().split(b"\n"), set(drop.as_py() or ())
                stay = [x for x in lines if (k := line_key(x)) is None or int.from_bytes(_digest(k)[:8], "little", signed=True) not in drop] if drop else lines
                kept.append(b"\n".join(stay).decode())
                before.append(len(lines))
                dropped.append(len(lines) - len(stay))
            arrays = batch.columns[:-1]
            arrays[at] = pa.array(kept, pa.string())
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(before, pa.int64()), pa.array(dropped, pa.int64())], [*columns, "n_lines", "n_dropped"])

    return whole.unionByName(map_batches(some, cut, whole.schema))


def _any(ids: DataFrame, words: int) -> Bloom:
    """A filter of longs, put together by Spark."""

    @tidy
    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = Bloom(np.zeros(words, np.uint64))
        for batch in batches:
            mine.add(mixed(_hash(batch.column(0))))
        used = np.flatnonzero(mine.words)
        for i in range(0, len(used), 1 << 16):
            at = used[i : i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(mine.words[at].view(np.int64))], ["word", "bits"])

    found = ids.mapInArrow(local, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()  # FILTER_BITS at most
    out = np.zeros(words, np.uint64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return Bloom(out)
