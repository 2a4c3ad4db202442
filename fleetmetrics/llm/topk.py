"""Exact top-k inner-product search by distributed histogram selection.

Every candidate is scored against every query of a block. The tasks count the
scores in one histogram per query; Spark adds the histograms; the bin that
holds each query's k-th score becomes the next, narrower range. When a bin is
one score wide, the k-th value is known exactly, and one last pass keeps what
lies above it and, of the ties, the smallest ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetmetrics.llm.shared import materialise

QUERY_BLOCK = 2048
BINS = 1024
_NONE = np.iinfo(np.int64).min


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int = 1024) -> DataFrame:
    """``vec_id``, ``vec``: each component x becomes floor(scale * x), x as double.

    Rows without an id, and vectors that are null or hold null, NaN or infinite
    components, take no part. Other columns are dropped.
    """
    x = F.col(vector_col)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    return df.where(F.col(id_col).isNotNull() & x.isNotNull() & ~bad).select(
        F.col(id_col).cast("long").alias("vec_id"), F.transform(x, lambda v: F.floor(v.cast("double") * F.lit(scale))).alias("vec")
    )


class _Block:
    """Queries of one block: per vector length their ids and vectors, and the state of the search for each."""

    def __init__(self, rows: list, k: int, longest: float) -> None:
        self.groups = {}
        for d in sorted({len(v) for _, v in rows}):
            ids = np.array([i for i, v in rows if len(v) == d], np.int64)
            vectors = np.array([v for _, v in rows if len(v) == d], np.int64).reshape(len(ids), d)
            reach = np.ceil(np.sqrt((vectors.astype(float) ** 2).sum(1)) * longest * 1.0001).astype(np.int64) + 1
            order = np.argsort(ids)
            width = np.maximum(1, -(-(2 * reach + 1) // BINS))
            self.groups[d] = {"ids": ids[order], "vectors": vectors[order], "lo": -reach[order], "hi": reach[order] + 1, "width": width[order], "need": np.full(len(ids), k), "open": np.ones(len(ids), bool), "all": np.zeros(len(ids), bool)}

    def narrow(self, found: dict[int, tuple[int, int]]) -> bool:
        """Take the bins that hold the k-th scores; True while some bin is wider than one score."""
        going = False
        for g in self.groups.values():
            for j in np.flatnonzero(g["open"]):
                if (hit := found.get(int(g["ids"][j]))) is None:
                    g["all"][j], g["open"][j] = True, False  # fewer than k candidates in all
                    continue
                b, above = hit
                g["lo"][j] += b * g["width"][j]
                g["hi"][j] = min(g["hi"][j], g["lo"][j] + g["width"][j])
                g["need"][j] -= above
                g["open"][j] = g["width"][j] > 1
                g["width"][j] = max(1, -(-int(g["width"][j]) // BINS))
            going |= bool(g["open"].any())
        return going


def _scored(block: _Block, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, np.ndarray, np.ndarray]]:
    """(group of queries, candidate ids, scores of queries by candidates) in pieces of bounded size; a query's own row scores _NONE."""
    for batch in batches:
        ids, vecs = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
        sizes, flat = vecs.value_lengths().to_numpy(zero_copy_only=False), vecs.flatten().to_numpy(zero_copy_only=False)
        starts = np.cumsum(sizes) - sizes
        for d, g in block.groups.items():
            rows = np.flatnonzero(sizes == d)
            step = max(1, 2_000_000 // len(g["ids"]))
            for at in range(0, len(rows), step):
                some = rows[at : at + step]
                x = flat[starts[some][:, None] + np.arange(d)] if d else np.zeros((len(some), 0), np.int64)
                top = float(np.abs(x).max(initial=0)) * float(np.abs(g["vectors"]).max(initial=0)) * d
                s = (g["vectors"].astype(float) @ x.T.astype(float)).astype(np.int64) if top < 2**53 else g["vectors"] @ x.T
                own = np.searchsorted(g["ids"], ids[some])
                same = np.flatnonzero(g["ids"][np.minimum(own, len(g["ids"]) - 1)] == ids[some])
                s[own[same], same] = _NONE
                yield g, ids[some], s


def _histograms(block: _Block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {d: np.zeros((len(g["ids"]), BINS), np.int64) for d, g in block.groups.items()}
        for g, _, s in _scored(block, batches):
            h = counts[g["vectors"].shape[1]]
            b = (s - g["lo"][:, None]) // g["width"][:, None]
            ok = (s >= g["lo"][:, None]) & (s < g["hi"][:, None]) & g["open"][:, None]
            h += np.bincount((np.arange(len(h))[:, None] * BINS + b)[ok], minlength=h.size).reshape(h.shape)
        for d, h in counts.items():
            q, b = np.nonzero(h)
            g = block.groups[d]
            yield pa.RecordBatch.from_arrays([pa.array(g["ids"][q]), pa.array(b), pa.array(h[q, b]), pa.array(g["need"][q])], ["query_id", "bin", "n", "need"])

    return run


def _smallest(q: np.ndarray, ids: np.ndarray, need: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of (query, id) the ``need[query]`` smallest ids of each query."""
    order = np.lexsort((ids, q))
    q, ids = q[order], ids[order]
    rank = np.arange(len(q)) - np.searchsorted(q, q)
    return q[rank < need[q]], ids[rank < need[q]]


def _winners(block: _Block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ties: dict[int, list] = {d: [np.zeros(0, np.int64), np.zeros(0, np.int64)] for d in block.groups}

        def out(g: dict, q: np.ndarray, ids: np.ndarray, s: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(g["ids"][q]), pa.array(ids), pa.array(s)], ["query_id", "vec_id", "score"])

        for g, ids, s in _scored(block, batches):
            q, c = np.nonzero((s > np.where(g["all"], _NONE, g["lo"])[:, None]) & (s != _NONE))
            yield out(g, q, ids[c], s[q, c])
            q, c = np.nonzero((s == g["lo"][:, None]) & ~g["all"][:, None] & (s != _NONE))
            d = g["vectors"].shape[1]
            ties[d] = list(_smallest(np.concatenate([ties[d][0], q]), np.concatenate([ties[d][1], ids[c]]), g["need"]))
        for d, (q, ids) in ties.items():
            yield out(block.groups[d], q, ids, block.groups[d]["lo"][q])

    return run


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 10, query_block: int = QUERY_BLOCK) -> DataFrame:
    """Each query's ``k`` highest inner products: query_id, rank (from 1), vec_id, score; ties go to the smaller vec_id.

    ``candidates`` and ``queries`` hold ``vec_id`` and ``vec`` (array of long), as :func:`integer_vectors` gives them.
    Queries are worked on in blocks of at most ``query_block``, whose size is checked before a block goes to the tasks;
    more queries mean more blocks, never a larger one. A row with the query's own id is no candidate. Repeated candidate
    rows each count; of repeated query ids the smallest vector is searched. Vectors of another length than the query's
    take no part. Fewer than ``k`` candidates: all are returned. No queries or no candidates: no rows.
    """
    queries = queries.groupBy("vec_id").agg(F.min("vec").alias("vec"))
    longest = candidates.agg(F.max(F.aggregate("vec", F.lit(0.0), lambda a, v: a + v.cast("double") * v))).first()[0]
    blocks, n = 1, queries.count()
    if longest is None or not n:
        return candidates.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    chunk = lambda m: F.pmod(F.xxhash64("vec_id"), F.lit(m))
    blocks = max(1, -(-n * 5 // (query_block * 4))) if n > query_block else 1
    while queries.groupBy(chunk(blocks).alias("b")).count().agg(F.max("count")).first()[0] > query_block:
        blocks *= 2
    if blocks > 1:  # read once a pass and block
        candidates, queries = materialise(candidates, "candidates"), materialise(queries, "queries")
    found = None
    for b in range(blocks):
        block = _Block([tuple(r) for r in queries.where(chunk(blocks) == b).select("vec_id", "vec").collect()], k, float(longest) ** 0.5)
        going = True
        while going:
            counts = candidates.mapInArrow(_histograms(block), "query_id long, bin long, n long, need long").groupBy("query_id", "bin").agg(F.sum("n").alias("n"), F.max("need").alias("need"))
            down = Window.partitionBy("query_id").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
            kth = counts.withColumn("upto", F.sum("n").over(down)).where("upto >= need and upto - n < need")
            going = block.narrow({r[0]: (r[1], r[2]) for r in kth.select("query_id", "bin", F.expr("upto - n")).collect()})
        part = candidates.mapInArrow(_winners(block), "query_id long, vec_id long, score long")
        part = materialise(part, "winners") if blocks > 1 else part
        found = part if found is None else found.unionByName(part)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
