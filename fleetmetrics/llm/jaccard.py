"""Near-duplicate documents: an n-gram Jaccard join by MinHash banding.

1. Each task hashes the n-grams of its documents and takes a MinHash signature, cut into bands.
2. Documents with the same set of n-grams become one class, whose smallest id stands for it.
3. Band hashes are first combined within each task's batch (a batch links what it holds of one band, and sends one
   row a band on), then shuffled; so a band that a third of all documents share costs a row a batch.
4. Connected candidates form clusters. One of more than a block may hold together by chance only, as bands of texts far
   below the threshold meet now and then; so it is taken apart first: the texts of each bucket are compared by sketches,
   a byte a MinHash, and only texts that agree in about as many as the threshold asks stay connected.
5. Clusters are dealt out in pairs of bounded blocks of documents, and every pair of documents within a pair of blocks is
   compared on the full n-gram sets: a matrix product inside the task, from which only counts and a spanning forest of
   links leave.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmetrics.llm.shared import Members, U, buffers, gram_hashes, materialise, mixed, slices, tidy, word_hashes

SLICE_BYTES = 2_000_000
BLOCK_DOCS = 192
BLOCK_GRAMS = 400_000
#: Most texts of a bucket whose sketches are in one part; parts are compared in pairs.
BUCKET_PART = 2048
BROADCAST_ROWS = 20_000


def choose_bands(similarity: float, recall: float = 0.9999, max_hashes: int = 128) -> tuple[int, int]:
    """(bands, rows): the most rows a band, so the fewest false candidates, for which few enough hashes give the recall at ``similarity``."""
    best = (max_hashes, 1)
    for rows in range(1, max_hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows)) if similarity < 1 else 1
        if bands * rows <= max_hashes:
            best = (bands, rows)
    return best


def least_equal(hashes: int, similarity: float, miss: float) -> int:
    """The most of ``hashes`` MinHashes of which a pair right at ``similarity`` has fewer equal ones in at most a share ``miss`` of cases."""
    below, k = 0.0, 0
    while k < hashes:
        below += math.comb(hashes, k) * similarity**k * (1 - similarity) ** (hashes - k)
        if below > miss:
            break
        k += 1
    return k


def _gram_sets(texts: pa.Array, n: int) -> Iterator[np.ndarray]:
    """Sorted distinct n-gram hashes of each text; a text of 1 to n-1 words has one gram, all its words."""
    words, at, _ = word_hashes(texts)
    for a, b in zip(at[:-1], at[1:], strict=True):
        yield np.unique(gram_hashes(words[a:b], min(n, int(b - a)))) if b > a else words[:0]


def _key(content: bytes) -> bytes:
    return hashlib.blake2b(content, digest_size=16).digest()


def _content(grams: np.ndarray, data: np.ndarray, at: np.ndarray, i: int) -> bytes:
    """What texts with the same key have alike: the gram set, or the text where it has no word."""
    return grams.tobytes() if len(grams) else b"\0" + data[at[i] : at[i + 1]].tobytes()


def _permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(7)
    return rng.integers(0, 1 << 31, (count, 1), dtype=np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(0, 1 << 32, (count, 1), dtype=np.uint32)


def _signatures(n: int, bands: int, rows: int):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _permutations(bands * rows)
        salt = mixed(np.arange(bands, dtype=np.uint64) + U(1))
        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                keys, sigs, sketches, sizes = [], [], [], []
                data, at = buffers(part.column(1))
                for i, grams in enumerate(_gram_sets(part.column(1), n)):
                    keys.append(_key(_content(grams, data, at, i)))
                    sizes.append(len(grams))
                    if not len(grams):
                        sigs.append(None)
                        sketches.append(None)
                        continue
                    low = np.full(bands * rows, 0xFFFFFFFF, np.uint32)
                    x = (grams >> U(32)).astype(np.uint32)
                    for k in range(0, len(x), 2048):
                        np.minimum(low, (a * x[k : k + 2048] + b).min(axis=1), out=low)
                    h = salt.copy()
                    for r in range(rows):
                        h = mixed(h + low.reshape(bands, rows)[:, r])
                    sigs.append(h.tobytes())
                    sketches.append((mixed(low.astype(np.uint64)) >> U(56)).astype(np.uint8).tobytes())
                columns = [part.column(0), *[pa.array(x, pa.binary()) for x in (keys, sigs, sketches)], pa.array(sizes, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "key", "bands", "sketch", "grams"])

    return run


def _within_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, doc, least): for each band hash the least document of the batch that has it, with doc null; and each other one with bucket null."""
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        bands = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int64).reshape(len(ids), -1)
        doc, bucket = np.repeat(ids, bands.shape[1]), bands.ravel()
        order = np.lexsort((doc, bucket))
        doc, bucket = doc[order], bucket[order]
        first = np.ones(len(doc), bool)
        first[1:] = bucket[1:] != bucket[:-1]
        least = doc[first][np.cumsum(first) - 1]
        links = np.unique(np.stack([doc[~first], least[~first]]), axis=1)
        none = lambda x: pa.nulls(len(x), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(bucket[first]), none(doc[first]), pa.array(doc[first])], ["bucket", "doc", "least"])
        yield pa.RecordBatch.from_arrays([none(links[0]), pa.array(links[0]), pa.array(links[1])], ["bucket", "doc", "least"])


def _roots(left: np.ndarray, right: np.ndarray, count: int) -> np.ndarray:
    """Smallest member of each one's component among 0..count-1."""
    label = np.arange(count)
    while len(left):
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        label = new[label]
        keep = label[left] != label[right]
        left, right = left[keep], right[keep]
    return label


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A spanning forest of a batch's edges, each member linked to its component's smallest."""
    for batch in batches:
        u, v = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        ids, at = np.unique(np.concatenate([u, v]), return_inverse=True)
        root = _roots(at[: len(u)], at[len(u) :], len(ids))
        own = np.flatnonzero(root != np.arange(len(ids)))
        yield pa.RecordBatch.from_arrays([pa.array(ids[own]), pa.array(ids[root[own]])], ["u", "v"])


def connected_components(edges: DataFrame, name: str = "components", max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v: long): the component's smallest node.

    Edges are first thinned to a forest within each task. Each round, every node takes a parent, the neighbour (or
    itself) of least priority, and every edge is rewritten on parents; from the third round on, priorities are hashes
    anew each round, so that long chains shrink by a constant factor too. The minimum combines before the shuffle, and
    state is written to the shared folder, so that joins on a node with very many neighbours can be split. Edges with a
    null end are ignored; no edges, no rows.
    """
    spark = edges.sparkSession
    edges = edges.select(F.col("u").cast("long").alias("u"), F.col("v").cast("long").alias("v")).where("u is not null and v is not null and u <> v")
    edges = materialise(edges.mapInArrow(_contract, "u long, v long").distinct(), f"{name}-edges")
    hooks = []
    for k in range(max_rounds):
        if edges.isEmpty():
            break
        rank = (lambda c: F.col(c)) if k < 2 else (lambda c, k=k: F.xxhash64(F.lit(k), c))
        ends = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = ends.groupBy("u").agg(F.min_by("v", rank("v")).alias("v"))
        hook = materialise(least.select(F.col("u").alias("node"), F.when(rank("v") < rank("u"), F.col("v")).otherwise(F.col("u")).alias("parent")), f"{name}-hook")
        hooks.append(hook)
        for side in ("u", "v"):
            edges = edges.join(_sized(hook.select(F.col("node").alias(side), F.col("parent").alias("p"))), side).drop(side).withColumnRenamed("p", side)
        edges = materialise(edges.where("u <> v").select("u", "v").mapInArrow(_contract, "u long, v long").distinct(), f"{name}-edges")
    else:
        raise RuntimeError("components did not settle")
    if not hooks:
        return spark.createDataFrame([], "node long, component long")
    labels = hooks[-1]
    for hook in reversed(hooks[:-1]):
        up = _sized(labels.select(F.col("node").alias("at"), F.col("parent").alias("top")))
        labels = materialise(hook.join(up, hook["parent"] == up["at"], "left").select("node", F.coalesce("top", "parent").alias("parent")), f"{name}-labels")
    if len(hooks) <= 2:
        return labels.select("node", F.col("parent").alias("component"))
    least = _sized(materialise(labels.groupBy("parent").agg(F.min("node").alias("component")), f"{name}-least"))
    return labels.join(least, "parent").select("node", "component")


def _sized(df: DataFrame) -> DataFrame:
    """Broadcast a written table only if it has few rows of a few numbers; else Spark shuffles both sides."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket: link each to the one before in its bucket; rows without a bucket are links already."""
    last = None
    for batch in batches:
        bucket, doc, least = batch.columns
        is_link = bucket.is_null().to_numpy(zero_copy_only=False)
        ids = least.to_numpy(zero_copy_only=False)
        u, v = [doc.filter(pa.array(is_link)).to_numpy(zero_copy_only=False)], [ids[is_link]]
        b, ids = bucket.filter(pa.array(~is_link)).to_numpy(zero_copy_only=False), ids[~is_link]
        if len(b):
            if last is not None:
                b, ids = np.concatenate([[last[0]], b]), np.concatenate([[last[1]], ids])
            same = b[1:] == b[:-1]
            u.append(ids[1:][same])
            v.append(ids[:-1][same])
            last = (b[-1], ids[-1])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in (u, v)], ["u", "v"])


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, node, sketch): a row for each band of a text."""
    for batch in batches:
        bands = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int64).reshape(batch.num_rows, -1)
        rows = pa.array(np.repeat(np.arange(batch.num_rows), bands.shape[1]))
        yield pa.RecordBatch.from_arrays([pa.array(bands.ravel()), batch.column(0).take(rows), batch.column(2).take(rows)], ["bucket", "node", "sketch"])


def _reached(sketch: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest that connects what chains of sketches with ``least`` equal bytes connect. One is compared only with those not yet reached, so texts that are all alike take one look each."""
    ends, starts, free = [], [], np.arange(len(sketch))
    while len(free) > 1:
        reached, free = [free[0]], free[1:]
        while reached and len(free):
            at = reached.pop()
            near = np.count_nonzero(sketch[free] == sketch[at], axis=1) >= least
            ends.append(free[near])
            starts.append(np.full(len(ends[-1]), at))
            reached.extend(ends[-1])
            free = free[~near]
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *ends]), np.concatenate([none, *starts])


def _look_alikes(least: int):
    """Rows sorted by part of a bucket: links between its texts whose sketches have ``least`` equal bytes, as a forest."""

    def links(group: np.ndarray, node: np.ndarray, sketch: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(group)
        sizes = np.diff(np.append(starts, len(node)))
        two = starts[sizes == 2]
        two = two[np.count_nonzero(sketch[two] == sketch[two + 1], axis=1) >= least]
        u, v = [node[two + 1]], [node[two]]
        for at, size in zip(starts[sizes > 2], sizes[sizes > 2], strict=True):
            a, b = _reached(sketch[at : at + size], least)
            u.append(node[at + a])
            v.append(node[at + b])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (u, v)], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last part, which may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [np.stack([batch.column(i).to_numpy() for i in range(3)]).T, batch.column(3).to_numpy(), np.frombuffer(b"".join(batch.column(4).to_pylist()), np.uint8).reshape(batch.num_rows, -1)]
            part, node, sketch = rows if held is None else [np.concatenate(x) for x in zip(held, rows, strict=True)]
            group = np.ones(len(node), bool)
            group[1:] = (part[1:] != part[:-1]).any(axis=1)
            last = int(np.flatnonzero(group)[-1])
            held = [part[last:], node[last:], sketch[last:]]
            if last:
                yield links(group[:last], node[:last], sketch[:last])
        if held is not None:
            yield links(np.arange(len(held[1])) == 0, *held[1:])

    return run


def _taken_apart(members: DataFrame, least: int) -> DataFrame:
    """(node, cluster) of the texts of large clusters (node, bands, sketch) that stay connected if texts that share a bucket must have ``least`` equal bytes of sketch."""
    buckets = members.select("node", "bands", "sketch").mapInArrow(_by_bucket, "bucket long, node long, sketch binary")
    parts = materialise(buckets.groupBy("bucket").agg(F.ceil(F.count("*") / BUCKET_PART).alias("parts")).where("parts > 1"), "parts")
    dealt = buckets.join(_sized(parts), "bucket", "left").withColumn("parts", F.coalesce("parts", F.lit(1)).cast("long")).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")))
    dealt = dealt.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("other"))
    dealt = dealt.select("bucket", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"), "node", "sketch")
    edges = dealt.repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi").mapInArrow(_look_alikes(least), "u long, v long")
    return connected_components(edges, "alike").withColumnRenamed("component", "cluster")


def _grams_of(members: Broadcast, n: int):
    """(doc_id, key, grams) of the texts whose id may be a member's; of a text that is there repeatedly, once a slice."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(members.value.may_have(batch.column(0))))
            for part in slices(batch, 1, SLICE_BYTES):
                found = {}
                for i, grams in zip(part.column(0).to_pylist(), _gram_sets(part.column(1), n), strict=True):
                    found[i, _key(grams.tobytes())] = grams.tobytes()
                ids, keys = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.binary()), pa.array(found.values(), pa.binary())], ["doc_id", "key", "grams"])

    return run


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every left set with every right set, by matrix products over shared grams."""
    sets = left + right
    grams, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = times[column] > 1
    row, column = row[shared], (np.cumsum(times > 1) - 1)[column[shared]]
    total = np.zeros((len(left), len(right)), np.float64)
    width = max(256, 4_000_000 // len(sets))
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [at, at + width])
        dense = np.zeros((len(sets), width), np.float32)
        dense[row[a:b], column[a:b] - at] = 1
        total += dense[: len(left)] @ dense[len(left) :].T
    return total


def _verified(similarity: float):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        node, copies, block = (rows.column(c).to_numpy() for c in ("node", "copies", "block"))
        sets = [np.frombuffer(g, np.uint64) for g in rows.column("grams").to_pylist()]
        lo, hi = key[1].as_py(), key[2].as_py()
        a, b = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
        links, left, right = np.zeros(len(node), np.int64), [], []
        if len(a) and len(b):
            size = np.array([len(s) for s in sets], float)
            both = _overlaps([sets[i] for i in a], [sets[i] for i in b])
            near = both * (1 + similarity) >= similarity * (size[a][:, None] + size[b][None]) - 1e-6
            if lo == hi:
                np.fill_diagonal(near, False)
            links[a] += near @ copies[b]
            if lo != hi:
                links[b] += near.T @ copies[a]
            i, j = np.nonzero(near)
            left, right = a[i], b[j]
        order = np.argsort(node, kind="stable")
        place = np.argsort(order)
        root = _roots(place[left], place[right], len(node)) if len(left) else np.arange(len(node))
        return pa.table({"node": node, "root": node[order][root[place]], "links": links, "blocks": rows.column("blocks")})

    return run


def _apart(reps: DataFrame) -> DataFrame | None:
    """Where several texts have the same smallest doc_id, all but one get nodes of their own, below all ids or, if there is no room, above. None if there are none."""
    same = materialise(reps.groupBy("least").agg(F.count("*").alias("texts")).where("texts > 1").select("least"), "several")
    if same.isEmpty():
        return None
    low, high = reps.agg(F.min("least"), F.max("least")).first()
    # Few rows: only the ids that have several texts.
    keys = reps.select("least", "key").join(same, "least")
    others = keys.join(keys.groupBy("least").agg(F.min("key").alias("key")), ["least", "key"], "left_anti")
    numbered = others.rdd.map(tuple).zipWithIndex().map(lambda x: (bytes(x[0][1]), x[1]))
    new = materialise(reps.sparkSession.createDataFrame(numbered, "key binary, number long"), "apart")
    node = F.lit(low) - 1 - F.col("number") if low > -(1 << 62) else F.lit(high) + 1 + F.col("number")
    return materialise(reps.join(new, "key", "left").withColumn("node", F.coalesce(node, "node")).drop("number"), "apart-classes")


def _classes(docs: DataFrame, n: int, similarity: float, recall: float, apart: bool = False) -> tuple[DataFrame, DataFrame]:
    """doc_id, key of the text (of its gram set) of every row with an id; and key, least doc_id, class_id, n_links and head (least doc_id and key of the class) of texts that have others alike.

    ``apart`` keeps different texts of one id apart; class_id is then any number that tells classes from each other.
    """
    bands, rows = choose_bands(similarity, recall)
    signed = materialise(docs.where("doc_id is not null").mapInArrow(_signatures(n, bands, rows), "doc_id long, key binary, bands binary, sketch binary, grams long"), "signatures")
    reps = materialise(signed.groupBy("key").agg(F.min("doc_id").alias("least"), F.min("doc_id").alias("node"), F.count("*").alias("copies"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"), F.first("grams").alias("grams")), "classes")
    own = _apart(reps) if apart else None
    reps = reps if own is None else own
    buckets = reps.where("bands is not null").select("node", "bands").mapInArrow(_within_batch, "bucket long, doc long, least long")
    dealt = buckets.repartition(F.coalesce("bucket", "doc")).sortWithinPartitions("bucket")
    cluster = connected_components(dealt.mapInArrow(_chained, "u long, v long"), "candidates")
    members = materialise(reps.select("node", "least", "key", "copies", "grams", "bands", "sketch").join(cluster.withColumnRenamed("component", "cluster"), "node"), "members")
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK_DOCS), F.ceil(F.sum("grams") / BLOCK_GRAMS)).alias("blocks")
    large = materialise(members.groupBy("cluster").agg(blocks).where("blocks > 1").select("cluster"), "large")
    members, wide = members.join(_sized(large), "cluster", "left_anti"), members.join(_sized(large), "cluster")
    columns = ["node", "least", "key", "copies", "grams", "cluster"]
    if not large.isEmpty():
        alike = _taken_apart(wide, least_equal(bands * rows, similarity, (1 - recall) / 10))
        wide = materialise(wide.drop("cluster").join(alike, "node").select(columns), "alike-members")
    sizes = materialise(wide.groupBy("cluster").agg(blocks).where("blocks > 1"), "sizes")
    members = members.select(columns).unionByName(wide.select(columns)).join(_sized(sizes), "cluster", "left").select(F.col("least").alias("doc_id"), "node", "key", "copies", "cluster", F.coalesce("blocks", F.lit(1)).cast("long").alias("blocks"))
    # Only the gram sets of members are shuffled, and of each one once: a filter of fixed size keeps most other texts back.
    ids = docs.sparkSession.sparkContext.broadcast(Members.of(members.select("doc_id")))
    sets = docs.mapInArrow(_grams_of(ids, n), "doc_id long, key binary, grams binary").groupBy("doc_id", "key").agg(F.first("grams").alias("grams"))
    full = sets.join(members, ["doc_id", "key"]).select("node", "copies", "cluster", "blocks", "grams")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    dealt = full.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks"))).select("*", other).select("node", "copies", "cluster", "blocks", "block", "grams", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))
    checked = materialise(dealt.groupBy("cluster", "lo", "hi").applyInArrow(_verified(similarity), "node long, root long, links long, blocks long"), "verified")
    joined = connected_components(checked.where("blocks > 1").select(F.col("node").alias("u"), F.col("root").alias("v")), "links")
    links = checked.groupBy("node").agg(F.sum("links").alias("links"), F.min(F.when(F.col("blocks") == 1, F.col("root"))).alias("root")).where("links > 0")
    found = links.join(joined, "node", "left").select("node", F.coalesce("component", "root", "node").alias("class_id"), "links")
    verdict = materialise(reps.join(found, "node", "left").where("copies > 1 or links > 0").select("key", "least", F.coalesce("class_id", "node").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "verdict")
    if own is None:  # the node of the smallest id is its text
        return signed, verdict.withColumn("head", F.struct(F.col("class_id").alias("least"), "key"))
    return signed, verdict.join(verdict.groupBy("class_id").agg(F.min(F.struct("least", "key")).alias("head")), "class_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, similarity: float = 0.8, recall: float = 0.9999) -> DataFrame:
    """One row per document: doc_id, class_id (smallest doc_id of its near-duplicate class), n_links (documents it is linked with).

    Two documents are linked if the Jaccard similarity of their sets of ``n``-word grams is at least ``similarity``;
    classes are the connected components of links. ``recall`` is the least chance that a pair right at ``similarity``
    shares a band; every pair of a candidate cluster is then compared on full gram sets. In clusters of more than a block,
    texts that share a band must agree in a sketch too, which a pair right at ``similarity`` fails in a tenth of the
    cases that ``recall`` leaves at most. Words as in ``word_hashes``.
    A text of fewer than ``n`` words has one gram. Texts without a word, null and empty ones among them, are linked with
    equal texts only (null is empty). Repeated rows count as documents of their own, linked with each other; rows of
    one id with different texts share their class and links. Rows without an id are returned with a null class and no links. Other columns are ignored; an empty table gives no rows.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed, verdict = _classes(docs, n, similarity, recall)
    out = signed.select("doc_id", "key").join(verdict.select("key", "class_id", "n_links"), "key", "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))
    return out.unionByName(docs.where("doc_id is null").select("doc_id", F.lit(None).cast("long").alias("class_id"), F.lit(0).cast("long").alias("n_links")))


def _apart_by(members: Broadcast, n: int, touched: bool):
    """The rows whose ``_id`` may be a member's, with the key of their text (the column behind) and once a slice; or all others."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, text = (k := batch.schema.get_field_index("_id")), k + 1
            mine = members.value.may_have(batch.column(ids))
            if not touched:
                yield batch.filter(pa.array(~mine)).select(range(ids))
                continue
            for part in slices(batch.filter(pa.array(mine)), text, SLICE_BYTES):
                data, at = buffers(part.column(text))
                keys = [_key(_content(g, data, at, i)) for i, g in enumerate(_gram_sets(part.column(text), n))]
                first = {pair: i for i, pair in reversed(list(enumerate(zip(part.column(ids).to_pylist(), keys, strict=True))))}
                whole = pa.RecordBatch.from_arrays([*part.columns[:text], pa.array(keys, pa.binary())], [*part.schema.names[:text], "_key"])
                yield whole.take(pa.array(sorted(first.values())))

    return run


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, similarity: float = 0.8, recall: float = 0.9999) -> DataFrame:
    """``docs`` with one document of each near-duplicate class: the one of the smallest doc_id (of several texts of that id in the class, one by a hash).

    Repeated rows of it (same id, same set of grams) go too. Different texts of one id are documents of their own: each
    is judged by its own class. Rows without an id stay.
    """
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed, verdict = _classes(plain, n, similarity, recall, apart=True)
    gone = materialise(signed.select("doc_id", "key").join(verdict.select("key", "head"), "key").where("doc_id <> head.least or key <> head.key").select("doc_id", "key").distinct(), "gone")
    repeated = signed.groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1").select("doc_id")
    # Most ids occur once and stay: their rows are not shuffled.
    ids = docs.sparkSession.sparkContext.broadcast(Members.of(gone.select("doc_id").unionByName(repeated).distinct()))
    names = [f"c{i}_" for i in range(len(docs.columns))]
    rows = docs.select(*[F.col(f"`{c}`").alias(x) for c, x in zip(docs.columns, names, strict=True)], F.col(f"`{id_col}`").cast("long").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    fields = rows.schema.fields[:-1]
    others = rows.drop("_text").mapInArrow(_apart_by(ids, n, False), T.StructType(fields[:-1]))
    own = rows.mapInArrow(_apart_by(ids, n, True), T.StructType([*fields, T.StructField("_key", T.BinaryType())]))
    own = own.join(gone.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key")), ["_id", "_key"], "left_anti").dropDuplicates(["_id", "_key"])
    return others.unionByName(own.select(*names)).toDF(*docs.columns)
