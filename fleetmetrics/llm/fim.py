"""Fill-in-middle: a text's middle moves behind its suffix, and back.

A batch's texts are one array of bytes. Each part of a text is shifted as a whole, so the shifts of all bytes are the
running sum of an array that is zero but where a part begins: there it holds the difference to the part before. Outputs
are scattered to their places by those shifts, markers put into the gaps; texts are restored by gathering from them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from fleetmetrics.llm.shared import buffers, map_batches, ship, slices

# The markers of prefix, suffix and middle, and the forms.
MARKERS = {"P": b"<P>", "S": b"<S>", "M": b"<M>"}
FORMS = ("plain", "psm", "spm")
PLAIN, PSM, SPM = range(3)
_WIDTH = 3
#: Bytes that are moved in one step; and of the texts that are taken together.
BLOCK, SLICE_BYTES = 1 << 20, 4_000_000


def markers(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of markers in the bytes of many texts, and the text that each is in. None crosses the end of a text."""
    at = np.flatnonzero(data[: max(0, len(data) - 2)] == ord("<"))
    at = at[data[at + 2] == ord(">")]
    at = at[np.isin(data[at + 1], [ord(x) for x in MARKERS])]
    text = np.searchsorted(offsets, at, "right") - 1
    inside = at + _WIDTH <= offsets[text + 1]
    return at[inside], text[inside]


def shifts(starts: np.ndarray, by: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """Where each of ``n`` bytes goes, block by block: running sums over the differences at the starts of parts (ascending; of several at one place the last counts)."""
    change = np.diff(by, prepend=0)
    carry = 0
    for low in range(0, n, BLOCK):
        high = min(n, low + BLOCK)
        mine = slice(*np.searchsorted(starts, [low, high]))
        d = np.zeros(high - low, np.int64)
        np.add.at(d, starts[mine] - low, change[mine])
        d[0] += carry
        d = np.cumsum(d)
        carry = int(d[-1])
        yield low, d + np.arange(low, high)


def _code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions at which code points begin, and the number of those before each offset."""
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    return starts, np.searchsorted(starts, offsets)


def transform(data: np.ndarray, offsets: np.ndarray, h: np.ndarray, plain_from: int = 90, spm_below: int = 20) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """Outputs of many texts (bytes and offsets), and n, form, prefix_chars, middle_chars of each; ``h`` has four numbers a text."""
    n_texts = len(offsets) - 1
    starts, before = _code_points(data, offsets)
    n = np.diff(before)
    with_marker = np.zeros(n_texts, bool)
    with_marker[markers(data, offsets)[1]] = True
    plain = (n == 0) | with_marker | (h[:, 2] % 100 >= plain_from)
    form = np.where(plain, PLAIN, np.where(h[:, 3] % 100 < spm_below, SPM, PSM))
    cuts = np.sort(h[:, :2] % (n + 1)[:, None], axis=1)
    starts = np.append(starts, len(data))
    at = starts[np.minimum(before[:-1, None] + cuts, len(starts) - 1)]  # the byte of each cut
    at = np.where(cuts == n[:, None], offsets[1:, None], at)
    prefix, middle, suffix = at[:, 0] - offsets[:-1], at[:, 1] - at[:, 0], offsets[1:] - at[:, 1]
    sizes = np.diff(offsets) + np.where(plain, 0, 3 * _WIDTH)
    out_offsets = np.concatenate([[0], np.cumsum(sizes)])
    begin = out_offsets[:-1]
    w = _WIDTH
    to_prefix = begin + np.select([form == PSM, form == SPM], [w, 2 * w + suffix], 0)
    to_suffix = begin + np.select([form == PSM, form == SPM], [2 * w + prefix, w], 0)
    to_middle = begin + 3 * w + prefix + suffix
    part = np.stack([offsets[:-1], at[:, 0], at[:, 1]], axis=1)
    to = np.stack([to_prefix, to_middle, to_suffix], axis=1)
    to[plain] = begin[plain, None] + part[plain] - part[plain][:, :1]
    out = np.empty(int(out_offsets[-1]), np.uint8)
    for low, place in shifts(part.ravel(), (to - part).ravel(), len(data)):
        out[place] = data[low : low + len(place)]
    for name, place in (("P", to_prefix), ("S", to_suffix), ("M", to_middle)):
        mark = np.frombuffer(MARKERS[name], np.uint8)
        out[(place[~plain] - w)[:, None] + np.arange(w)] = mark
    return out, out_offsets, {"n": n, "form": form, "prefix_chars": cuts[:, 0], "middle_chars": cuts[:, 1] - cuts[:, 0]}


def restore(out: np.ndarray, out_offsets: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts (bytes and offsets) of outputs and forms: the markers' places alone say where each part was."""
    cut = form != PLAIN
    at, text = markers(out, out_offsets)
    at = at[cut[text]].reshape(-1, 3)  # in the order P S M, or S P M
    sizes = np.diff(out_offsets) - np.where(cut, 3 * _WIDTH, 0)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    source = np.repeat(out_offsets[:-1, None], 3, axis=1)
    dest = np.repeat(offsets[:-1, None], 3, axis=1)
    if len(at):
        ends = np.concatenate([at[:, 1:], out_offsets[1:][cut][:, None]], axis=1)
        size = ends - at - _WIDTH
        swap = form[cut] == SPM
        p, s = np.where(swap, 1, 0), np.where(swap, 0, 1)
        row = np.arange(len(at))
        parts = np.stack([at[row, p], at[:, 2], at[row, s]], axis=1) + _WIDTH  # prefix, middle, suffix
        lengths = np.stack([size[row, p], size[:, 2]], axis=1)
        source[cut] = parts
        dest[cut] = offsets[:-1][cut][:, None] + np.concatenate([np.zeros((len(at), 1), np.int64), np.cumsum(lengths, axis=1)], axis=1)
    data = np.empty(int(offsets[-1]), np.uint8)
    for low, place in shifts(dest.ravel(), (source - dest).ravel(), len(data)):
        data[low : low + len(place)] = out[place]
    return data, offsets


def _strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)).cast(pa.string())


def fill_in_middle(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", seed: str = "1", plain_from: int = 90, spm_below: int = 20) -> DataFrame:
    """Columns n (code points), form, prefix_chars, middle_chars and output beside those of ``docs``, which they replace where names clash.

    The first four groups of eight hexadecimal digits of sha256(seed:id) are numbers h1 to h4: the two cuts are h1 and h2
    modulo n + 1; the text stays plain if it is empty or null, has a marker in it, or h3 % 100 >= ``plain_from``; else it is
    suffix first if h4 % 100 < ``spm_below``, else prefix first. Rows with one id and text get one output; of a null id
    the digits are those of an empty one. Memory grows with the longest text only; no rows give none.
    """
    ship(docs.sparkSession)
    new = {"n": "long", "form": "string", "prefix_chars": "long", "middle_chars": "long", "output": "string"}
    digits = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit(""))), 256)
    numbers = F.array(*[F.conv(F.substring(digits, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)])
    source = docs.select(*[F.col(f"`{c}`") for c in docs.columns], numbers.alias("fim_numbers_"))
    k, kept = docs.columns.index(text_column), [i for i, c in enumerate(docs.columns) if c not in new]
    schema = StructType([*[docs.schema.fields[i] for i in kept], *StructType.fromDDL(", ".join(f"{c} {kind}" for c, kind in new.items()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, k, SLICE_BYTES):
                h = part.column(part.num_columns - 1).flatten().to_numpy().reshape(-1, 4)
                out, offsets, found = transform(*buffers(part.column(k)), h, plain_from, spm_below)
                plain = found["form"] == PLAIN
                numbers = [pa.array(found[c], pa.int64(), mask=plain) for c in ("prefix_chars", "middle_chars")]
                form = pa.array(FORMS).take(pa.array(found["form"]))
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in kept], pa.array(found["n"]), form, *numbers, _strings(out, offsets)], schema.names)

    return map_batches(source, run, schema)


def restored(coded: DataFrame, output_column: str = "output", form_column: str = "form", to: str = "restored") -> DataFrame:
    """``coded`` with the texts rebuilt from outputs and forms alone, as column ``to``. A null output is empty; a row without a form is plain."""
    ship(coded.sparkSession)
    names = [c for c in coded.columns if c != to]
    source = coded.select(*[F.col(f"`{c}`") for c in names])
    k, f = names.index(output_column), names.index(form_column)
    schema = StructType([*source.schema, StructField(to, StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, k, SLICE_BYTES):
                form = np.array([FORMS.index(x or "plain") for x in part.column(f).to_pylist()], np.int64)
                yield pa.RecordBatch.from_arrays([*part.columns, _strings(*restore(*buffers(part.column(k)), form))], schema.names)

    return map_batches(source, run, schema)
