"""JPEG frames: a lossless encoder, and a decoder of baseline and lossless frames that works on many streams in step.

All streams of frames alike (or of restart intervals) advance by one Huffman symbol at a time: a numpy operation over
the streams takes the place of a loop over bits. A baseline block has 64 coefficients, a lossless "block" one sample.
"""

from __future__ import annotations

import struct

import numpy as np

# Fixed values of the JPEG standard (annex K): code lengths and symbols of the tables that motion-JPEG takes for granted.
DC_LENGTHS = (0, 1, 5, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0)
DC_SYMBOLS = bytes(range(12))
DC_CHROMA_LENGTHS = (0, 3, 1, 1, 1, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0)
AC_LENGTHS = (0, 2, 1, 3, 3, 2, 4, 3, 5, 5, 4, 4, 0, 0, 1, 125)
AC_SYMBOLS = bytes.fromhex(
    "01020300041105122131410613516107227114328191a1082342b1c11552d1f02433627282090a161718191a25262728292a3435363738393a43444546"
    "4748494a535455565758595a636465666768696a737475767778797a838485868788898a92939495969798999aa2a3a4a5a6a7a8a9aab2b3b4b5b6b7b8"
    "b9bac2c3c4c5c6c7c8c9cad2d3d4d5d6d7d8d9dae1e2e3e4e5e6e7e8e9eaf1f2f3f4f5f6f7f8f9fa"
)
AC_CHROMA_LENGTHS = (0, 2, 1, 2, 4, 4, 3, 4, 7, 5, 4, 4, 0, 1, 2, 119)
AC_CHROMA_SYMBOLS = bytes.fromhex(
    "0001020311040521310612415107617113223281081442 91a1b1c109233352f0156272d10a162434e125f11718191a262728292a35363738393a434445"
    "464748494a535455565758595a636465666768696a737475767778797a82838485868788898a92939495969798999aa2a3a4a5a6a7a8a9aab2b3b4b5b6"
    "b7b8b9bac2c3c4c5c6c7c8c9cad2d3d4d5d6d7d8d9dae2e3e4e5e6e7e8e9eaf2f3f4f5f6f7f8f9fa"
)


def zigzag() -> np.ndarray:
    """Raster index of the k-th coefficient of a block: along the diagonals, up and down in turn."""
    cells = [(r, c) for r in range(8) for c in range(8)]
    cells.sort(key=lambda x: (x[0] + x[1], x[0] if (x[0] + x[1]) % 2 else x[1]))
    return np.array([r * 8 + c for r, c in cells])


class Huffman:
    """Codes of a table, and a lookup of (length, symbol) by the next 16 bits."""

    def __init__(self, lengths: tuple[int, ...] | bytes, symbols: bytes) -> None:
        self.codes: dict[int, tuple[int, int]] = {}
        self.length, self.symbol = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        code = k = 0
        for n, count in enumerate(lengths, 1):
            for s in symbols[k : k + count]:
                self.codes[s] = (code, n)
                self.length[code << (16 - n) : (code + 1) << (16 - n)] = n
                self.symbol[code << (16 - n) : (code + 1) << (16 - n)] = s
                code += 1
            k, code = k + count, code << 1


STANDARD = {(0, 0): (DC_LENGTHS, DC_SYMBOLS), (0, 1): (DC_CHROMA_LENGTHS, DC_SYMBOLS), (1, 0): (AC_LENGTHS, AC_SYMBOLS), (1, 1): (AC_CHROMA_LENGTHS, AC_CHROMA_SYMBOLS)}
_tables: dict[tuple, Huffman] = {}


def huffman(lengths: tuple[int, ...] | bytes, symbols: bytes) -> Huffman:
    key = (tuple(lengths), bytes(symbols))
    if key not in _tables:
        if len(_tables) >= 32:  # broken media may bring any number
            _tables.clear()
        if len(_tables) > 64:
            _tables.clear()
        _tables[key] = Huffman(*key)
    return _tables[key]


def _segment(marker: int, data: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(data) + 2) + data


def encode_lossless(pixels: np.ndarray) -> list[bytes]:
    """Frames (count, height, width) of 8-bit samples as lossless JPEG: each sample predicted by its left neighbour, the first of a row by the one above."""
    count, height, width = pixels.shape
    if not count:
        return []
    x = pixels.astype(np.int16)
    diff = np.empty_like(x)
    diff[:, :, 1:] = x[:, :, 1:] - x[:, :, :-1]
    diff[:, 1:, 0] = x[:, 1:, 0] - x[:, :-1, 0]
    diff[:, 0, 0] = x[:, 0, 0] - 128
    table = huffman(DC_LENGTHS, DC_SYMBOLS)
    value, length = np.zeros(511, np.uint32), np.zeros(511, np.int64)
    for d in range(-255, 256):
        s = abs(d).bit_length()
        code, n = table.codes[s]
        value[d + 255], length[d + 255] = code << s | (d if d >= 0 else d + (1 << s) - 1), n + s
    k = diff.reshape(count, -1).astype(np.int64) + 255
    n = length[k]
    ends = n.cumsum(axis=1)
    size = (ends[:, -1] + 7) // 8
    first = np.cumsum(size) - size
    at = (ends - n + first[:, None] * 8).ravel()
    window = value[k].ravel() << (24 - (at & 7) - n.ravel()).astype(np.uint32)
    out, at = np.zeros(int(size.sum()) + 3, np.int64), at >> 3
    for b in range(3):
        out[: len(out)] += np.bincount(at + b, (window >> np.uint32(16 - 8 * b)) & np.uint32(255), len(out)).astype(np.int64)
    out = out[:-3].astype(np.uint8)
    out[first + size - 1] |= ((1 << (size * 8 - ends[:, -1])) - 1).astype(np.uint8)  # the rest of the last byte: ones
    repeats = 1 + (out == 255)  # a zero follows each FF
    stuffed = np.repeat(out, repeats)
    end = np.cumsum(repeats)
    stuffed[end[repeats == 2] - 1] = 0
    stuffed, end = stuffed.tobytes(), end[first + size - 1]
    head = b"\xff\xd8" + _segment(0xC3, struct.pack(">BHHBBBB", 8, height, width, 1, 1, 0x11, 0)) + _segment(0xC4, b"\0" + bytes(DC_LENGTHS) + DC_SYMBOLS) + _segment(0xDA, bytes([1, 1, 0, 1, 0, 0]))
    return [head + stuffed[a:b] + b"\xff\xd9" for a, b in zip([0, *end[:-1].tolist()], end.tolist(), strict=True)]


class _Header:
    """What a frame's marker segments say, and where its entropy-coded data begin."""

    def __init__(self, data: bytes) -> None:
        if data[:2] != b"\xff\xd8":
            raise ValueError("not a JPEG frame")
        self.quant, self.tables, self.restart, at = {}, dict(STANDARD), 0, 2
        self.kind, self.parts = None, []
        while True:
            while data[at : at + 2] == b"\xff\xff":
                at += 1
            if data[at : at + 1] != b"\xff" or at + 4 > len(data):
                raise ValueError("broken marker")
            marker, size = data[at + 1], int.from_bytes(data[at + 2 : at + 4], "big")
            part, at = data[at + 4 : at + 2 + size], at + 2 + size
            if marker == 0xDB:
                while part:
                    wide = part[0] >> 4
                    self.quant[part[0] & 15] = np.frombuffer(part[1 : 65 + 64 * wide], ">u2" if wide else np.uint8).astype(np.int32)
                    part = part[65 + 64 * wide :]
            elif marker == 0xC4:
                while part:
                    n = sum(part[1:17])
                    self.tables[part[0] >> 4, part[0] & 15] = (tuple(part[1:17]), part[17 : 17 + n])
                    part = part[17 + n :]
            elif marker in (0xC0, 0xC1, 0xC3):
                self.kind = marker
                self.bits, self.height, self.width = struct.unpack(">BHH", part[:5])
                self.parts = [(part[6 + 3 * i], part[7 + 3 * i] >> 4, part[7 + 3 * i] & 15, part[8 + 3 * i]) for i in range(part[5])]
            elif 0xC2 <= marker <= 0xCF and marker not in (0xC8, 0xCC):
                raise ValueError(f"frames of type {marker:#x} are not read")
            elif marker == 0xDD:
                self.restart = int.from_bytes(part[:2], "big")
            elif marker == 0xDA:
                chosen = {part[1 + 2 * i]: (part[2 + 2 * i] >> 4, part[2 + 2 * i] & 15) for i in range(part[0])}
                self.scan = [chosen[c] for c, _, _, _ in self.parts]
                self.predictor, self.shift = part[1 + 2 * part[0]], part[3 + 2 * part[0]] & 15
                break
        if self.kind is None or self.kind != 0xC3 and self.bits != 8 or self.kind == 0xC3 and (len(self.parts) != 1 or self.predictor != 1 or self.bits > 8):
            raise ValueError("not a baseline frame, nor a lossless grey one with predictor 1")
        self.start = at


class _Bits:
    """Bit positions in many streams at once."""

    def __init__(self, streams: list[bytes]) -> None:
        joined = np.frombuffer(b"".join(s + b"\xff" * 8 for s in streams), np.uint8).astype(np.uint32)
        self.words = np.zeros(len(joined), np.uint32)
        for k in range(4):
            self.words[: len(joined) - k] |= joined[k:] << np.uint32(24 - 8 * k)
        size = np.array([len(s) + 8 for s in streams])
        self.at = (np.cumsum(size) - size) * 8
        self.end = self.at + (size - 4) * 8

    def peek(self, who) -> np.ndarray:
        at = np.minimum(self.at[who], self.end[who])
        return (self.words[at >> 3] >> (16 - (at & 7)).astype(np.uint32)) & np.uint32(0xFFFF)

    def symbol(self, who, table: Huffman) -> np.ndarray:
        bits = self.peek(who)
        self.at[who] += np.maximum(table.length[bits], 1)
        return table.symbol[bits]

    def number(self, who, size: np.ndarray) -> np.ndarray:
        """Signed numbers of ``size`` bits each, below 16."""
        raw = (self.peek(who) >> (16 - size).astype(np.uint32)).astype(np.int64)
        self.at[who] += size
        return np.where(raw < (1 << size >> 1), raw - (1 << size) + 1, raw)


def _cut(data: bytes, start: int) -> list[bytes]:
    """Restart intervals of a frame's entropy-coded data, without stuffed zeros."""
    end = data.rfind(b"\xff\xd9")
    body, parts, a = data[start : end if end >= start else len(data)], [], 0
    at = body.find(b"\xff")
    while at >= 0:
        if at + 1 < len(body) and 0xD0 <= body[at + 1] <= 0xD7:
            parts.append(body[a:at])
            a = at + 2
        at = body.find(b"\xff", at + 2)
    return [p.replace(b"\xff\0", b"\xff") for p in [*parts, body[a:]]]


def _blocks(bits: _Bits, plan: np.ndarray, tables: list[tuple[Huffman, Huffman]], mcus: np.ndarray) -> np.ndarray:
    """Coefficients (stream, block, 64) of baseline streams: ``plan`` has each block's component within an MCU; ``mcus`` each stream's MCUs."""
    streams, per = len(mcus), len(plan)
    out = np.zeros((streams, int(mcus.max()) * per, 64), np.int32)
    last = np.zeros((streams, int(plan.max()) + 1), np.int64)
    block, k, total, order = np.zeros(streams, np.int64), np.zeros(streams, np.int64), mcus * per, zigzag()
    live = np.arange(streams)
    while len(live):
        part = plan[block[live] % per]
        for c in range(last.shape[1]):
            for dc in (True, False):
                who = live[(part == c) & ((k[live] == 0) == dc)]
                if not len(who):
                    continue
                s = bits.symbol(who, tables[c][0 if dc else 1])
                if dc:
                    last[who, c] += bits.number(who, np.minimum(s, 15))
                    out[who, block[who], 0] = last[who, c]
                    k[who] = 1
                    continue
                size, run = s & 15, s >> 4
                value = bits.number(who, size)
                to = k[who] + run
                ok = (size > 0) & (to < 64)
                out[who[ok], block[who[ok]], order[to[ok]]] = value[ok]
                k[who] = np.where(size > 0, to + 1, np.where(run == 15, to + 1, 64))
        done = live[k[live] >= 64]
        block[done] += 1
        k[done] = 0
        live = live[block[live] < total[live]]
    return out


def _cosines() -> np.ndarray:
    u, x = np.arange(8)[:, None], np.arange(8)[None]
    return np.cos((2 * x + 1) * u * np.pi / 16) * np.where(u == 0, np.sqrt(1 / 8), 0.5)


def _baseline(h: _Header, frames: list[bytes]) -> np.ndarray:
    """Luma of alike baseline frames."""
    across, down = max(p[1] for p in h.parts), max(p[2] for p in h.parts)
    if len(h.parts) == 1:
        across = down = 1
        sampling = [(1, 1)]
    else:
        sampling = [(p[1], p[2]) for p in h.parts]
    if not (across and down and h.width and h.height):
        raise ValueError("a frame without samples")
    wide, high = -(-h.width // (8 * across)), -(-h.height // (8 * down))
    if wide * high > 4 * sum(map(len, frames)):
        raise ValueError("more blocks than pairs of bits")
    plan = np.repeat(np.arange(len(sampling)), [a * b for a, b in sampling])
    streams = [s for f in frames for s in _cut(f, h.start)]
    each = h.restart or wide * high
    per_frame = -(-wide * high // each)
    if len(streams) != per_frame * len(frames):
        raise ValueError("restart intervals are missing")
    mcus = np.tile([min(each, wide * high - i * each) for i in range(per_frame)], len(frames))
    if any(n * len(plan) > 4 * len(s) for n, s in zip(mcus.tolist(), streams, strict=True)):
        raise ValueError("more blocks than pairs of bits")
    tables = [(huffman(*h.tables[0, d]), huffman(*h.tables[1, a])) for d, a in h.scan]
    found = _blocks(_Bits(streams), plan, tables, mcus)
    luma = found.reshape(len(streams), -1, len(plan), 64)[:, :, plan == 0]
    luma = np.concatenate([luma[k :: per_frame, : mcus[k]] for k in range(per_frame)], axis=1) if per_frame > 1 else luma
    raster = np.zeros(64, np.int32)
    raster[zigzag()] = h.quant[h.parts[0][3]]
    cosine = _cosines()
    pixels = cosine.T @ (luma * raster).reshape(*luma.shape[:3], 8, 8) @ cosine
    a, b = sampling[0]
    pixels = pixels.reshape(len(frames), high, wide, b, a, 8, 8).transpose(0, 1, 3, 5, 2, 4, 6).reshape(len(frames), high * b * 8, wide * a * 8)
    return np.clip(np.rint(pixels) + 128, 0, 255).astype(np.uint8)[:, : h.height, : h.width]


def _lossless(h: _Header, frames: list[bytes]) -> np.ndarray:
    if h.restart:
        raise ValueError("lossless frames with restart intervals are not read")
    streams = [_cut(f, h.start)[0] for f in frames]
    if h.height * h.width > 8 * min(map(len, streams)):
        raise ValueError("more samples than bits")
    bits, table, everyone = _Bits(streams), huffman(*h.tables[0, h.scan[0][0]]), slice(None)
    diff = np.empty((h.height * h.width, len(frames)), np.int64)
    for k in range(len(diff)):
        diff[k] = bits.number(everyone, np.minimum(bits.symbol(everyone, table), 15))
    diff = diff.T.reshape(len(frames), h.height, h.width)
    diff[:, :, 0] = diff[:, :, 0].cumsum(axis=1) + (1 << (h.bits - h.shift - 1))
    return (diff.cumsum(axis=2) << h.shift).astype(np.uint8)


def decode(frames: list[bytes]) -> list[np.ndarray]:
    """Samples (of colour frames: luma) of each frame. Frames with the same header are decoded in step. Raises ValueError on frames of other kinds."""
    groups: dict[bytes, tuple[_Header, list[int]]] = {}
    known: dict[bytes, bytes] = {}
    for i, f in enumerate(frames):
        scan = f.find(b"\xff\xda")
        head = f[: scan + 2 + int.from_bytes(f[scan + 2 : scan + 4], "big")] if scan >= 0 else f
        if known.setdefault(head, head) not in groups:
            groups[head] = (_Header(f), [])
        groups[head][1].append(i)
    out: list = [None] * len(frames)
    for h, who in groups.values():
        for i, x in zip(who, (_lossless if h.kind == 0xC3 else _baseline)(h, [frames[i] for i in who]), strict=True):
            out[i] = x
    return out
