"""WARC archives and a Merkle audit of replicas.

Each record's bytes are hashed where they lie, compressed ones as they are stored. The digests, in order of offset, are the leaves of a tree: a node covers a
fixed range of record numbers of one file, ``FANOUT`` nodes below it, up to a root for each file. The roots, in order of
file, are the leaves of the archive's tree, whose nodes cover fixed ranges of file numbers. Two replicas are compared
from the archive's root down: only children of nodes that differ are looked at, level by level, down to the records of
ranges that differ; there, records are aligned by what they are, so that one that is gone is not taken for a change of
all behind it.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetmetrics.llm.shared import materialise, tidy

FANOUT = 16
RECORDS_PER_FILE = 1024
#: Pages without an id are dealt into so many files of their own, numbered from -1 down.
NAMELESS_FILES = 1 << 20
#: Every record has a date; pages have none, so it is a fixed one, and equal pages give equal bytes.
DATE = "1970-01-01T00:00:00Z"
_END = b"\r\n\r\n"
#: How every member begins (no name, no time, unknown system), what stands behind it, and the bytes that are read at a time.
_HEAD, _PAD, _PIECE = gzip.compress(b"", 6, mtime=0)[:10], b"\0", 1 << 16
_FAULTS = "record_id long, file long, number long, start long, length long, copies long, expected string, found string, fault string"


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> DataFrame:
    """record_id, file, content: one WARC response record a page, in files of ``RECORDS_PER_FILE`` consecutive ids.

    Null url or body count as empty. A page without an id has a record without one, in a file that a hash of its url and
    body chooses. Of repeated ids each page is a record. Other columns are ignored.
    """
    body = F.coalesce(F.col(body_col), F.lit("")).cast("binary")
    url = F.coalesce(F.col(url_col), F.lit(""))
    key = F.col(id_col).cast("long")
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"), F.coalesce(key.cast("string"), F.lit("")),
        F.lit(f">\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "), url,
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"),
    )
    content = F.concat(head.cast("binary"), body, F.lit(_END.decode()).cast("binary"))
    nameless = -1 - F.pmod(F.xxhash64(url, body), F.lit(NAMELESS_FILES))
    return pages.select(key.alias("record_id"), F.coalesce(F.floor(key / RECORDS_PER_FILE), nameless).cast("long").alias("file"), content.alias("content"))


def write_archive(rows: DataFrame, path: str, compress: bool = True) -> None:
    """Records as WARC files below ``path``, one for each ``file``, in order of id and bytes. Contents may be any bytes.

    Compressed, each record is a gzip member of its own, behind which a zero byte stands, that gzip readers pass over: so
    a record's place on disk is its member's, and one that is damaged costs no other. The place of the file says which
    form it has, not its bytes, as those may rot.
    """
    keyed = rows.select("file", "record_id", F.sha2("content", 256).alias("digest"), "content")
    if compress:  # before the shuffle
        stored, end = keyed.mapInArrow(_members, keyed.schema), _PAD.decode()
    else:
        stored, end = keyed.withColumn("content", F.expr(f"substring(content, 1, octet_length(content) - {len(_END)})")), _END.decode()
    stored = stored.repartition("file").sortWithinPartitions("file", "record_id", "digest")
    # A cast to string keeps bytes as they are, and the text writer writes them so.
    stored.select(F.lit("gzip" if compress else "plain").alias("form"), "file", F.col("content").cast("string").alias("value")).write.partitionBy("form", "file").option("lineSep", end).text(path)


@tidy
def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([gzip.compress(c.as_py(), 6, mtime=0) for c in batch.column(3)], pa.binary())], batch.schema.names)


def members(data: bytes) -> Iterator[tuple[int, int, bytes, bool]]:
    """(start, length, content, sound) of each gzip member of a file as :func:`write_archive` makes it, without a gap.

    A member is sound if its head and the byte behind it are those that are written, and its check sum is right. One that
    is not reaches to the next sound one, and its content is what could be read of it.
    """
    at = 0
    while at < len(data):
        content, size = _member(data, at)
        if size:
            yield at, size, content, True
            at += size
            continue
        following = data.find(_PAD + _HEAD, at + 1)
        while following >= 0 and not _member(data, following + 1)[1]:
            following = data.find(_PAD + _HEAD, following + 1)
        end = following + 1 if following >= 0 else len(data)
        yield at, end - at, _readable(data[at:end]), False
        at = end


def _member(data: bytes, at: int) -> tuple[bytes, int]:
    """Content, and length with the byte behind, of a sound member; length 0 if there is none."""
    if data[at : at + len(_HEAD)] != _HEAD:
        return b"", 0
    reader = zlib.decompressobj(31)
    out, end = [], at
    try:
        while not reader.eof and end < len(data):  # piece by piece, as what follows is not this member's
            out.append(reader.decompress(data[end : end + _PIECE]))
            end += _PIECE
    except zlib.error:
        return b"", 0
    end = min(end, len(data)) - len(reader.unused_data)
    return (b"".join(out), end + 1 - at) if reader.eof and data[end : end + 1] == _PAD else (b"", 0)


def _readable(stored: bytes) -> bytes:
    """What comes out of a damaged member until it breaks; nothing if its head is damaged."""
    reader, out = zlib.decompressobj(-15), []
    try:
        for k in range(len(_HEAD), len(stored)):  # byte by byte, to lose no more than must be
            out.append(reader.decompress(stored[k : k + 1]))
            if reader.eof:
                break
    except zlib.error:
        pass
    return b"".join(out)


def parse(data: bytes) -> Iterator[tuple[int, int, int | None]]:
    """(start, length, id) of each record of a WARC file.

    A record whose head is broken, or whose end is not where its length says, ends where the next head begins; it has no
    id if its head gives none.
    """
    at = 0
    while at < len(data):
        after = data.find(_END, at)
        head = data[at:after] if after >= 0 else b""
        size, name = re.search(rb"\r\nContent-Length: (\d{1,18})(?:\r\n|$)", head), re.search(rb"\r\nWARC-Record-ID: <urn:page:(-?\d{1,18})>", head)
        end = after + len(_END) + int(size[1]) + len(_END) if size and head.startswith(b"WARC/1.") else -1
        if not (0 <= end <= len(data)) or data[end - len(_END) : end] != _END:
            following = data.find(b"WARC/1.", at + 1)
            while following >= 0 and data[following - len(_END) : following] != _END:
                following = data.find(b"WARC/1.", following + 1)
            end = following if following >= 0 else len(data)
        yield at, end - at, int(name[1]) if name else None
        at = end


_ID = re.compile(rb"\r\nWARC-Record-ID: <urn:page:(-?\d{1,18})>")


def _stored(data: bytes, form: str) -> Iterator[tuple[int | None, int, int, bytes, bool]]:
    """(id, start, length, content, sound) of each record of a file, whatever has become of it."""
    if form == "plain":
        yield from ((i, a, n, data[a : a + n], True) for a, n, i in parse(data))
        return
    for a, n, content, sound in members(data):
        name = _ID.search(content[: content.find(_END)] if _END in content else content)
        yield int(name[1]) if name else None, a, n, content, sound


@tidy
def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, stored in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            data, place = stored.as_py(), re.search(r"form=(gzip|plain)/file=(-?\d+)/", path)
            some: list[tuple] = []
            offset = 0
            for i, at, n, content, sound in _stored(data, place[1]):
                some.append((i, int(place[2]), at, n, content, hashlib.sha256(data[at : at + n]).hexdigest(), sound, offset))
                offset += len(content)
                if len(some) == _ROWS or sum(len(r[4]) for r in some) > _BYTES:
                    yield _batch(some)
                    some = []
            if some:
                yield _batch(some)


_ROWS, _BYTES = 64, 4_000_000
_COLUMNS = {"record_id": pa.int64(), "file": pa.int64(), "start": pa.int64(), "length": pa.int64(), "content": pa.binary(), "stored": pa.string(), "sound": pa.bool_(), "offset": pa.int64()}


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), _COLUMNS.values(), strict=True)], list(_COLUMNS))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """record_id, file, start, length (on disk), content, stored (sha256 of the bytes on disk), sound, offset (in the file without compression) of the records of WARC files below ``path`` (see :func:`write_archive`).

    Together the records of a file are all its bytes. Damage raises nothing: of a record that cannot be read whole the
    content is what can, its id is null if that is not among it, and ``sound`` is false. A file is read by one task, which
    holds it; ``RECORDS_PER_FILE`` keeps files small.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(_read, "record_id long, file long, start long, length long, content binary, stored string, sound boolean, offset long")


def leaves(rows: DataFrame, as_stored: bool = True) -> DataFrame:
    """record_id, file, number (in its file, from 0), start, length, copies, digest (sha256) of each record. The content itself is not shuffled.

    ``rows`` with a column ``start`` are stored ones, in that order, with the place and digest of their bytes on disk. With
    ``as_stored=False`` they have those of the records themselves, whatever the compression (of what cannot be read whole,
    still the digest on disk), as replicas need that are compressed in another way. Other rows are laid out in order of id
    and digest; equal records, then side by side, are one leaf of several copies.
    """
    stored = "start" in rows.columns
    size, own = F.octet_length("content").cast("long").alias("length"), F.sha2("content", 256)
    if stored and as_stored:
        columns = ["start", "length", F.col("stored").alias("digest")]
    elif stored:
        columns = [F.col("offset").alias("start"), size, F.when(F.col("sound"), own).otherwise(F.col("stored")).alias("digest")]
    else:
        columns = [size, own.alias("digest")]
    hashed = rows.select("record_id", "file", *columns)
    if stored:
        number = F.row_number().over(Window.partitionBy("file").orderBy("start")) - 1
        return hashed.select("record_id", "file", number.cast("long").alias("number"), "start", "length", F.lit(1).cast("long").alias("copies"), "digest")
    hashed = hashed.groupBy("record_id", "file", "length", "digest").agg(F.count("*").alias("copies"))
    order = Window.partitionBy("file").orderBy("record_id", "digest")
    before = F.sum(F.col("length") * F.col("copies")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    return hashed.select("record_id", "file", (F.row_number().over(order) - 1).cast("long").alias("number"), F.coalesce(before, F.lit(0)).cast("long").alias("start"), "length", "copies", "digest")


def _parents(nodes: DataFrame, *group: Column | str) -> DataFrame:
    """One level up: the digest of the ordered digests and ranges of up to ``FANOUT`` nodes."""
    children = F.sort_array(F.collect_list(F.struct("number", "start", "end", "digest")))
    up = nodes.groupBy(*group).agg(children.alias("c"))
    text = F.array_join(F.transform("c", lambda c: F.concat_ws(":", *[c[k].cast("string") for k in ("number", "start", "end")], c["digest"])), ",")
    return up.select(*[c for c in up.columns if c != "c"], F.array_min("c.start").alias("start"), F.array_max("c.end").alias("end"), F.sha2(text, 256).alias("digest"))


def _up(number: str) -> Column:
    return F.floor(F.col(number) / FANOUT).cast("long")


def tree(leaf_rows: DataFrame, records_a_file: int = RECORDS_PER_FILE) -> list[DataFrame]:
    """Levels of (file, number, start, end, digest), records first, a root for each file last. A node has ``FANOUT`` others below it at most, if no file has more records than said."""
    levels, reach = 1, FANOUT
    while reach < records_a_file:
        levels, reach = levels + 1, reach * FANOUT
    out = [leaf_rows.select("file", "number", "start", (F.col("start") + F.col("length") * F.col("copies")).alias("end"), F.concat_ws("x", "digest", F.col("copies").cast("string")).alias("digest"))]
    for k in range(levels):
        out.append(_parents(out[-1], "file", (F.lit(0).cast("long") if k == levels - 1 else _up("number")).alias("number")))
    return out


def archive_tree(roots: DataFrame, span: int) -> list[DataFrame]:
    """Levels of (number, start, end, digest) over the files' roots, in order of file; the last is one node. ``span`` bounds the distance of file numbers to zero."""
    out = [roots.select(F.col("file").alias("number"), "start", "end", "digest")]
    reach = 1
    while True:
        out.append(_parents(out[-1], _up("number").alias("number")))
        if reach > span:  # two nodes at most, of the numbers below zero and of the others
            break
        reach *= FANOUT
    return [*out, _parents(out[-1], F.lit(0).cast("long").alias("number"))]


def _differing(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    b = b.select(*key, *[F.col(c).alias(f"{c}_") for c in ("start", "end", "digest")])
    same = F.col("digest").eqNullSafe(F.col("digest_")) & F.col("start").eqNullSafe(F.col("start_")) & F.col("end").eqNullSafe(F.col("end_"))
    return a.join(b, key, "full_outer").where(~same).select(*key)


def _below(nodes: DataFrame, above: DataFrame | None, key: list[str], up: Column) -> DataFrame:
    """Nodes whose parent differs."""
    if above is None:
        return nodes
    parents = above.select(*[F.col(k).alias(f"{k}_up") for k in key])
    on = [F.col(k) == F.col(f"{k}_up") for k in key if k != "number"]
    return nodes.withColumn("up", up).join(parents, [*on, F.col("up") == F.col("number_up")], "left_semi").drop("up")


def audit(left: DataFrame, right: DataFrame) -> DataFrame:
    """Records that differ between two replicas: record_id, file, number, start, length, copies, expected, found, fault.

    ``left`` and ``right`` are leaves (see :func:`leaves`) of the trusted and the audited replica. ``fault`` is ``missing``
    or ``extra`` for a record that one replica lacks, ``changed`` for other bytes under the same id in the file, or other
    copies, and ``moved`` for the same bytes at another place, as those behind a missing record are. Of several records of
    an id, equal ones answer each other, then others in order; records without an id are told by their bytes.
    Equal archives give no rows after comparing one root each. Empty replicas are equal.
    """
    left, right = materialise(left, "leaves"), materialise(right, "leaves")
    most = max(int(x.agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]) + 1 for x in (left, right))  # repeated ids make files longer
    one, two = tree(left, most), tree(right, most)
    roots = [materialise(x[-1].drop("number"), "roots") for x in (one, two)]
    span = max(int(r.agg(F.coalesce(F.max(F.abs("file")), F.lit(0))).first()[0]) for r in roots)
    high = [archive_tree(r, span) for r in roots]
    above = None
    for level in range(len(high[0]) - 1, -1, -1):
        up = F.lit(0).cast("long") if level == len(high[0]) - 2 else _up("number")
        a, b = (_below(x[level], above, ["number"], up) for x in high)
        above = materialise(_differing(a, b, ["number"]), "mismatch")
        if level == len(high[0]) - 1 and above.isEmpty():
            return left.sparkSession.createDataFrame([], _FAULTS)
    key = ["file", "number"]
    above = above.select(F.col("number").alias("file"), F.lit(0).cast("long").alias("number"))
    for level in range(len(one) - 2, 0, -1):
        up = F.lit(0).cast("long") if level == len(one) - 2 else _up("number")
        a, b = (_below(x[level], above, key, up) for x in (one, two))
        above = materialise(_differing(a, b, key), "mismatch")
    up = F.lit(0).cast("long") if len(one) == 2 else _up("number")
    a, b = (_below(x, above, key, up) for x in (left, right))
    return _aligned(a, b)


def _aligned(a: DataFrame, b: DataFrame) -> DataFrame:
    """Faults of records of ranges that differ. A record at another number may have left its range: so each side's are told by id and bytes."""
    name = F.coalesce(F.col("record_id").cast("string"), F.col("digest"))
    nth = lambda *by: F.row_number().over(Window.partitionBy("file", "name", *by).orderBy("number"))
    a, b = (x.withColumn("name", name).withColumn("nth", nth("digest")) for x in (a, b))
    equal = ["file", "name", "digest", "nth"]
    theirs = b.select(*equal, F.col("start").alias("start_"), F.col("copies").alias("copies_"))
    both = a.join(theirs, equal).where((F.col("start") != F.col("start_")) | (F.col("copies") != F.col("copies_")))
    same = both.select("record_id", "file", "number", "start", "length", "copies", F.col("digest").alias("expected"), F.col("digest").alias("found"), F.when(F.col("copies") != F.col("copies_"), "changed").otherwise("moved").alias("fault"))
    # What has no equal on the other side: by id, in order.
    lone, other = (x.join(y.select(*equal), equal, "left_anti").withColumn("nth", nth()) for x, y in ((a, b), (b, a)))
    pairs = ["file", "name", "nth"]
    other = other.select(*pairs, *[F.col(c).alias(f"{c}_") for c in ("record_id", "number", "start", "length", "copies", "digest")])
    rest = lone.join(other, pairs, "full_outer")
    pick = lambda c: F.coalesce(c, f"{c}_").alias(c)
    fault = F.when(F.col("digest_").isNull(), "missing").when(F.col("digest").isNull(), "extra").otherwise("changed")
    return same.unionByName(rest.select(pick("record_id"), "file", *[pick(c) for c in ("number", "start", "length", "copies")], F.col("digest").alias("expected"), F.col("digest_").alias("found"), fault.alias("fault")))


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` of a replica with faults: records whose id's md5 begins with 01 are gone; one byte has rotted of those where it begins with 00, which end in a space instead of a line feed."""
    code = F.md5(F.coalesce(F.col("record_id").cast("string"), F.lit("")).cast("binary"))
    rotten = F.concat(F.expr("substring(content, 1, octet_length(content) - 1)"), F.lit(" ").cast("binary"))
    return rows.where(~code.startswith("01")).withColumn("content", F.when(code.startswith("00"), rotten).otherwise(F.col("content")))
