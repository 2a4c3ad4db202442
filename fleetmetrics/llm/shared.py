"""Helpers shared by the operators: table access, shared scratch space, Arrow buffers, hashing of words."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

U = np.uint64


_shipped: set[str] = set()
_written: list[str] = []
#: Most bytes of an Arrow batch, where the session sets none: long texts would fill a batch of so many rows.
BATCH_BYTES = "8m"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once an application, as ``--py-files`` would; and bound Arrow batches by bytes."""
    context = spark.sparkContext
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", "1b") == "1b":
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parent.parent
        archive = Path(tempfile.mkdtemp(prefix="spark-")) / f"{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for path in sorted(package.rglob("*.py")):
                z.write(path, path.relative_to(package.parent))
        context.addPyFile(str(archive))
        _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``). Where none is set, a fresh one on a local master, as in tests; elsewhere an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors, and gives joins a known size."""
    path = f"{scratch_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Delete all that :func:`materialise` has written: for the end of an application, or once results have been written; they are read from it until then."""
    while _written:
        path = spark._jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release() -> None:
    """Give what a task has freed back to the system, as its worker may go on to other work."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # only glibc has it
        pass


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's function that gives its memory back at its end."""

    @functools.wraps(run)
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()

    return tidied


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: StructType) -> DataFrame:
    """``mapInArrow`` for columns of any names: where some have dots in them, which Spark would take for fields, tasks see all by number."""
    if not any("." in c for c in [*df.columns, *schema.names]):
        return df.mapInArrow(tidy(run), schema)
    coded = StructType([StructField(f"c{i}", f.dataType) for i, f in enumerate(schema.fields)])

    @tidy
    def renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in run(batches):
            yield pa.RecordBatch.from_arrays(batch.columns, coded.names)

    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]).mapInArrow(renamed, coded).toDF(*schema.names)


class Members:
    """A filter of ids of fixed size: ids that it lacks are surely not among those it was made from; a few others seem to be."""

    #: 8 MB: with 10 million ids, one in fifteen others passes; with many more it passes more, and saves less.
    BITS = 1 << 26

    def __init__(self, words: np.ndarray) -> None:
        self.words = words

    @staticmethod
    def _places(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = mixed(ids.astype(np.int64).view(np.uint64) + U(1))
        return (h >> U(38)).astype(np.int64), (h & U(Members.BITS - 1)).astype(np.int64)

    @staticmethod
    def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(np.concatenate(Members._places(batch.column(0).to_numpy(zero_copy_only=False))))
            word, first = np.unique(at >> 6, return_index=True)
            bits = np.bitwise_or.reduceat(np.int64(1) << (at & 63), first) if len(at) else at
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(bits)], ["word", "bits"])

    @staticmethod
    def of(ids: DataFrame) -> Members:
        """From one column of longs without nulls; put together by Spark, so that the driver gets ``BITS`` bits at most."""
        found = ids.mapInArrow(Members._bits, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
        words = np.zeros(Members.BITS >> 6, np.int64)
        words[found["word"].to_numpy()] = found["bits"].to_numpy()
        return Members(words)

    def may_have(self, ids: pa.Array) -> np.ndarray:
        """Nulls are no members."""
        seen = np.ones(len(ids), bool)
        for at in self._places(pc.fill_null(ids.cast(pa.int64()), 0).to_numpy(zero_copy_only=False)):
            seen &= (self.words[at >> 6] >> (at & 63) & 1).astype(bool)
        return seen & ids.is_valid().to_numpy(zero_copy_only=False)


def slices(batch: pa.RecordBatch, column: int, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the texts in ``column`` hold about ``max_bytes`` a piece (one row at least)."""
    offsets = buffers(batch.column(column))[1]
    start = 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + max_bytes, "right")) - 1)
        yield batch.slice(start, end - start)
        start = end


def buffers(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n+1 offsets of a string or binary array; null counts as empty."""
    wide = pa.large_binary() if pa.types.is_binary(array.type) or pa.types.is_large_binary(array.type) else pa.large_string()
    array = pc.fill_null(array.cast(wide), b"" if wide == pa.large_binary() else "")
    _, offsets, data = array.buffers()
    offsets = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1] if len(array) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


# A random odd multiplier, and a table of byte values from a seeded generator.
_R = 0x9E3779B97F4A7C15
_BYTE_VALUE = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
LONG_TEXT = 4_000_000
_IS_WORD = np.zeros(256, bool)
_IS_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def _powers(n: int) -> np.ndarray:
    """The first ``n`` powers of the multiplier modulo 2**64."""
    power = np.ones(n, np.uint64)
    power[1:] = U(_R)
    return np.multiply.accumulate(power)


def mixed(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64-bit result."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of all words, n+1 offsets of each text's words, and each word's length in bytes.

    A word is a longest run of ASCII letters and digits and of any non-ASCII
    characters, in lower case. The hash is a polynomial over the bytes. A text
    of more than ``LONG_TEXT`` bytes is worked on in parts, cut at blanks.
    """
    data, offsets = buffers(pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), "")))
    if len(offsets) > 2 or len(data) <= LONG_TEXT:
        return _hashed(data, offsets)
    hashes, lengths, at = [], [], 0
    while at < len(data):
        blank = np.flatnonzero(data[at + LONG_TEXT : at + 2 * LONG_TEXT] == 32)
        end = at + LONG_TEXT + int(blank[0]) if len(blank) else len(data)
        some = _hashed(data[at:end], np.array([0, end - at]))
        hashes.append(some[0])
        lengths.append(some[2])
        at = end
    return np.concatenate(hashes), np.array([0, sum(map(len, hashes))]), np.concatenate(lengths)


def _hashed(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), np.zeros(0, np.int64)
    inside = _IS_WORD[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cut = offsets[(offsets > 0) & (offsets < len(data))]
    first[cut] = inside[cut]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[cut - 1] = inside[cut - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), starts
    lengths = ends - starts
    at = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(at, lengths)
    values = _BYTE_VALUE[data[inside]] * _powers(int(lengths.max()))[place]
    return mixed(np.add.reduceat(values, at)), np.searchsorted(starts, offsets), lengths


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the ``len(words) - n + 1`` runs of ``n`` words."""
    if len(words) < n:
        return words[:0]
    h = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        h = h * U(_R) + words[i : len(words) - n + 1 + i]
        h ^= h >> U(32)
    return mixed(h)
