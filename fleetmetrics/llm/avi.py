"""The AVI container: reading through its indexes, and writing motion-JPEG."""

from __future__ import annotations

import struct
from dataclasses import dataclass

KEY_FRAME = 0x10


@dataclass
class Video:
    width: int
    height: int
    seconds_per_frame: float
    codec: bytes
    frames: list[bytes]


def _chunk(name: bytes, data: bytes) -> bytes:
    return name + struct.pack("<I", len(data)) + data + b"\0" * (len(data) & 1)


def write(frames: list[bytes], width: int, height: int, fps: int = 25) -> bytes:
    """A motion-JPEG AVI file with an ``idx1`` index."""
    most = max(map(len, frames), default=0)
    header = struct.pack("<14I", 1_000_000 // fps, most * fps, 0, KEY_FRAME, len(frames), 0, 1, most, width, height, 0, 0, 0, 0)
    stream = struct.pack("<4s4sIHHIIIIIIiI4H", b"vids", b"MJPG", 0, 0, 0, 0, 1, fps, 0, len(frames), most, -1, 0, 0, 0, width, height)
    form = struct.pack("<IiiHH4sIiiII", 40, width, height, 1, 8, b"MJPG", width * height, 0, 0, 0, 0)
    lists = _chunk(b"LIST", b"hdrl" + _chunk(b"avih", header) + _chunk(b"LIST", b"strl" + _chunk(b"strh", stream) + _chunk(b"strf", form)))
    movi, index, at = [b"movi"], [], 4
    for f in frames:
        movi.append(_chunk(b"00dc", f))
        index.append(struct.pack("<4sIII", b"00dc", KEY_FRAME, at, len(f)))
        at += len(movi[-1])
    return _chunk(b"RIFF", b"AVI " + lists + _chunk(b"LIST", b"".join(movi)) + _chunk(b"idx1", b"".join(index)))


def _chunks(data: bytes, start: int, end: int):
    """(name, start, end) of the chunks in a range; a chunk cut off by the end is dropped."""
    while start + 8 <= end:
        name, size = data[start : start + 4], int.from_bytes(data[start + 4 : start + 8], "little")
        if start + 8 + size > end:
            return
        yield name, start + 8, start + 8 + size
        start += 8 + size + (size & 1)


def _indexed(data: bytes, stream: bytes, movi: int, idx1: tuple[int, int] | None, standard: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(start, length) of the stream's frames: by OpenDML standard indexes if there are any, else by idx1, else none."""
    found = []
    for a, b in standard:
        entries = int.from_bytes(data[a + 4 : a + 8], "little")
        base = int.from_bytes(data[a + 12 : a + 20], "little")
        for k in range(min(entries, (b - a - 24) // 8)):
            offset, length = struct.unpack_from("<II", data, a + 24 + 8 * k)
            found.append((base + offset, length & 0x7FFFFFFF))
    if found or idx1 is None:
        return found
    entries = list(struct.iter_unpack("<4sIII", data[idx1[0] : idx1[0] + (idx1[1] - idx1[0]) // 16 * 16]))
    # Offsets count from the list's name, or in some files from the start of the file.
    absolute = bool(entries) and data[movi + entries[0][2] : movi + entries[0][2] + 4] != entries[0][0]
    return [((0 if absolute else movi) + offset + 8, size) for name, _, offset, size in entries if name[:2] == stream and name[2:] in (b"dc", b"db")]


def read(data: bytes) -> Video:
    """The first video stream of an AVI file. Raises ValueError if there is none; frames that lie beyond the end are dropped."""
    if data[:4] != b"RIFF" or data[8:12] != b"AVI ":
        raise ValueError("not an AVI file")
    width = height = 0
    number, seen, pace, codec, idx1, movis, standard = None, 0, 0.0, b"", None, [], []
    todo = [(12, len(data))]
    for name, a, b in _chunks(data, 0, len(data)):
        if name == b"RIFF" and a > 8:
            todo.append((a + 4, b))
    while todo:
        for name, a, b in _chunks(data, *todo.pop(0)):
            if name == b"LIST" and data[a : a + 4] == b"movi":
                movis.append((a, b))
            elif name == b"LIST":
                todo.append((a + 4, b))
            elif name == b"strh":
                if data[a : a + 4] == b"vids" and number is None:
                    number, codec = b"%02d" % seen, data[a + 4 : a + 8]
                    scale, rate = struct.unpack_from("<II", data, a + 20)
                    pace = scale / rate if rate else 0.0
                seen += 1
            elif name == b"strf" and number == b"%02d" % (seen - 1):
                width, height = struct.unpack_from("<ii", data, a + 4)
            elif name == b"avih" and not pace:
                pace = int.from_bytes(data[a : a + 4], "little") / 1e6
            elif name == b"idx1":
                idx1 = (a, b)
    if number is None or not movis:
        raise ValueError("no video stream")
    for a, b in movis:
        standard += [(x, y) for name, x, y in _chunks(data, a + 4, b) if name == b"ix" + number]
    places = _indexed(data, number, movis[0][0], idx1, standard)
    if not places:  # no index: walk through the frames themselves
        places = [(x, y - x) for a, b in movis for name, x, y in _chunks(data, a + 4, b) if name[:2] == number and name[2:] in (b"dc", b"db")]
    if sum(n for _, n in places) > 2 * len(data):
        raise ValueError("an index that names more bytes than there are")
    return Video(width, abs(height), pace, codec, [data[a : a + n] for a, n in places if n and a + n <= len(data)])
