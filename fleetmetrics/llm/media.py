"""Media columns: motion-JPEG in AVI, as binary columns of a DataFrame.

``store_texts`` keeps bytes losslessly as grey frames of 24 by 24 samples. ``read_media`` parses the container, decodes
its intra frames and detects shots; ``clips`` gives a row for each shot, with times.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fleetmetrics.llm import avi, mjpeg
from fleetmetrics.llm.shared import buffers, map_batches, slices, tidy

SLICE_BYTES = 1_500_000
SIDE = 24
HISTOGRAM_BINS = 32
#: A cut: a difference above the floor, above its neighbours, and this many deviations above the mean of those around.
FLOOR, DEVIATIONS, AROUND = 0.05, 3.0, 6
#: What broken media raise.
UNREADABLE = (ValueError, IndexError, KeyError, OverflowError, struct.error)
CLIPS = "array<struct<clip: int, start_frame: int, end_frame: int, start_s: double, end_s: double>>"
_CLIP_TYPE = pa.list_(pa.struct([("clip", pa.int32()), ("start_frame", pa.int32()), ("end_frame", pa.int32()), ("start_s", pa.float64()), ("end_s", pa.float64())]))


@tidy
def _store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unit = SIDE * SIDE
    for batch in batches:
        for part in slices(batch, 1, SLICE_BYTES):
            data, offsets = buffers(part.column(1))
            size = np.diff(offsets)
            frames = np.maximum(1, -(-size // unit))
            first = np.cumsum(frames) - frames
            payload = np.full(int(frames.sum()) * unit, 255, np.uint8)
            payload[np.repeat(first * unit - offsets[:-1], size) + np.arange(len(data))] = data
            coded = mjpeg.encode_lossless(payload.reshape(-1, SIDE, SIDE))
            media = [avi.write(coded[a : a + n], SIDE, SIDE) for a, n in zip(first.tolist(), frames.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(size), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])


def store_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, media: the UTF-8 of each whole text as an AVI of lossless JPEG frames, one sample a byte.

    Bytes of 255 fill up the last of one or more frames; null counts as empty. Equal texts give equal media. Repeated
    rows and null ids are kept; other columns are ignored; no rows give none.
    """
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_store, "doc_id long, n_bytes long, media binary")


def shot_starts(frames: list[np.ndarray]) -> tuple[list[int], np.ndarray]:
    """First frames of the shots, and the histogram difference (0 to 1) of each frame from the one before.

    No frames have no shots; equal frames and a single one are one shot; of equal neighbouring differences the first cuts.
    """
    n = len(frames)
    if n < 2:
        return [0] * n, np.zeros(n)
    size = np.array([f.size for f in frames])
    bins = np.concatenate([f.ravel() for f in frames]).astype(np.int64) * HISTOGRAM_BINS >> 8
    histogram = np.bincount(np.repeat(np.arange(n) * HISTOGRAM_BINS, size) + bins, minlength=n * HISTOGRAM_BINS).reshape(n, -1) / np.maximum(size, 1)[:, None]
    d = np.zeros(n)
    d[1:] = np.abs(np.diff(histogram, axis=0)).sum(1) / 2
    # Mean and deviation of up to AROUND differences on either side, without the frame's own.
    one, two = np.concatenate([[0], np.cumsum(d)]), np.concatenate([[0], np.cumsum(d * d)])
    t = np.arange(1, n)
    a, b = np.maximum(1, t - AROUND), np.minimum(n, t + AROUND + 1)
    k = np.maximum(b - a - 1, 1)
    mean = (one[b] - one[a] - d[t]) / k
    deviation = np.sqrt(np.maximum((two[b] - two[a] - d[t] ** 2) / k - mean**2, 0))
    padded = np.concatenate([d, [0]])
    cut = (d[t] > FLOOR) & (d[t] > mean + DEVIATIONS * deviation) & (d[t] >= padded[t - 1]) & (d[t] > padded[t + 1])
    return [0, *t[cut].tolist()], d


@tidy
def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        k = batch.num_columns - 1
        for part in slices(batch, k, SLICE_BYTES):
            videos: list[avi.Video | None] = []
            for data in part.column(k).to_pylist():
                try:
                    videos.append(avi.read(data) if data else None)
                except UNREADABLE:
                    videos.append(None)
            decoded = _decode([v.frames if v else [] for v in videos])
            payload, rows, feature = [], [], []
            for v, frames in zip(videos, decoded, strict=True):
                if v is None or frames is None:
                    payload.append(None)
                    rows.append(None)
                    feature.append(None)
                    continue
                starts, d = shot_starts(frames)
                ends = [*starts[1:], len(frames)][: len(starts)]
                step = v.seconds_per_frame
                payload.append(b"".join(f.tobytes() for f in frames))
                rows.append([{"clip": i, "start_frame": a, "end_frame": b, "start_s": round(a * step, 6), "end_s": round(b * step, 6)} for i, (a, b) in enumerate(zip(starts, ends, strict=True))])
                feature.append(f"{v.width}x{v.height} frames={len(frames)} clips={','.join(f'{a}-{b}' for a, b in zip(starts, ends, strict=True))} most={d.max(initial=0):.4f}")
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(payload, pa.binary()), pa.array(rows, _CLIP_TYPE), pa.array(feature, pa.string())], [*part.schema.names, "payload", "clips", "feature"])


def _decode(videos: list[list[bytes]]) -> list[list[np.ndarray] | None]:
    """Frames of each video; None where one is not readable. All are tried together, and only a failure sends them one by one."""
    try:
        flat = mjpeg.decode([f for v in videos for f in v])
    except UNREADABLE:
        if len(videos) == 1:
            return [None]
        return [_decode([v])[0] for v in videos]
    at = np.cumsum([0, *map(len, videos)]).tolist()
    return [flat[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


def read_media(media: DataFrame, media_col: str = "media") -> DataFrame:
    """``media`` with payload (all samples read back, frame by frame; of colour frames the luma), clips and feature.

    Takes AVI files of baseline motion-JPEG or lossless grey frames, indexed by idx1, OpenDML or not at all. Null, empty
    and unreadable media give null in all three. Columns of these names that are already there are replaced.
    """
    names = [c for c in media.columns if c not in (media_col, "payload", "clips", "feature")]
    rows = media.select(*[F.col(f"`{c}`") for c in [*names, media_col]])
    return map_batches(rows, _read, StructType([*rows.schema.fields, *StructType.fromDDL(f"payload binary, clips {CLIPS}, feature string")]))


def clips(read: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """A row for each shot of each video: id, clip, start_frame, end_frame (exclusive), start_s, end_s. Unreadable media have none."""
    return read.select(id_col, F.explode("clips").alias("c")).select(id_col, "c.*")
