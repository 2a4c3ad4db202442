"""Document quality by a sparse rule ensemble.

Statistics of the texts are computed in one pass. A forest of shallow trees is grown on labelled documents; every path
from a root to a node is a rule, a conjunction of bounds on statistics. A logistic regression with a lasso penalty
weighs the rules and leaves most at zero. What is left is compiled into one Spark column expression.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from fleetmetrics.llm.shared import buffers, gram_hashes, map_batches, materialise, slices, tidy, word_hashes

SLICE_BYTES = 2_000_000
TREES, DEPTH, LASSO = 12, 3, 0.002
#: Most labelled documents to fit on; if there are more, those of least hash are taken, in expectation this many.
FIT_ROWS = 60_000
STATISTICS = (
    "log_bytes", "log_words", "word_length", "upper_share", "digit_share", "mark_share", "symbol_share", "space_share", "wide_share",
    "distinct_words", "top_word", "repeated_next", "distinct_pairs", "distinct_lines", "line_words", "bang_share", "bar_share", "end_marks",
)
_SYMBOLS = b"#$%&*+/<=>@\\^_`{|}~[]"
_MARKS = b".,;:!?'\"()-"


def _class(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_CLASSES = {"upper": _class(bytes(range(65, 91))), "digit": _class(b"0123456789"), "mark": _class(_MARKS), "symbol": _class(_SYMBOLS), "space": _class(b" \t\r\n"), "wide": np.arange(256) >= 128, "bang": _class(b"!"), "bar": _class(b"|"), "end": _class(b".?!")}


def _distinct(hashes: np.ndarray, doc: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of distinct hashes of each document, and how often its commonest occurs. Hashes count by their upper 40 bits."""
    if not len(hashes):
        return np.zeros(docs), np.zeros(docs)
    key = np.sort(doc.astype(np.uint64) << np.uint64(40) | hashes >> np.uint64(24))
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    owner = (key[first] >> np.uint64(40)).astype(np.int64)
    most = np.zeros(docs)
    np.maximum.at(most, owner, np.diff(np.append(first, len(key))))
    return np.bincount(owner, minlength=docs).astype(float), most


def _measures(texts: pa.Array) -> np.ndarray:
    """Statistics (text, statistic) of a slice of texts."""
    data, offsets = buffers(texts)
    n, size = len(texts), np.diff(offsets).astype(float)
    total = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[offsets]).astype(float)
    count = {k: total(c[data]) for k, c in _CLASSES.items()}
    words, at, length = word_hashes(texts)
    words_of = np.diff(at)
    doc = np.repeat(np.arange(n), words_of)
    kinds, top = _distinct(words, doc, n)
    pairs = gram_hashes(words, 2)
    inside = doc[1:] == doc[:-1]
    pair_kinds, _ = _distinct(pairs[inside], doc[1:][inside], n)
    again = np.bincount(doc[1:][inside & (words[1:] == words[:-1])], minlength=n)
    lines = pc.split_pattern(pc.fill_null(texts.cast(pa.large_string()), ""), "\n")
    line_doc = np.repeat(np.arange(n), pc.list_value_length(lines).to_numpy(zero_copy_only=False))
    line_code = pc.list_flatten(lines).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.uint64) << np.uint64(24)
    line_kinds, _ = _distinct(line_code, line_doc, n)
    line_count = np.bincount(line_doc, minlength=n)
    w, b = np.maximum(words_of, 1), np.maximum(size, 1)
    letters = np.bincount(doc, weights=length, minlength=n) if len(doc) else np.zeros(n)
    columns = [
        np.log1p(size), np.log1p(words_of), letters / w, count["upper"] / b, count["digit"] / b, count["mark"] / b, count["symbol"] / b, count["space"] / b, count["wide"] / b,
        kinds / w, top / w, again / w, pair_kinds / w, line_kinds / np.maximum(line_count, 1), words_of / np.maximum(line_count, 1), count["bang"] / w, count["bar"] / w, count["end"] / w,
    ]
    return np.round(np.stack(columns, axis=1), 9)


def _run(kept: int):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, batch.num_columns - 1, SLICE_BYTES):
                x = _measures(part.column(part.num_columns - 1))
                yield pa.RecordBatch.from_arrays([*part.columns[:kept], *(pa.array(c) for c in x.T)], [*part.schema.names[:kept], *STATISTICS])

    return run


def statistics(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` (the text may be the last of them) and the statistics of each whole text (null counts as empty; all of an empty text's are 0). Other columns are dropped."""
    kept = [F.col(f"`{c}`") for c in keep]
    rows = docs.select(*kept) if keep[-1] == text_col else docs.select(*kept, F.col(f"`{text_col}`").alias("text_"))
    return map_batches(rows, _run(len(keep)), StructType([*rows.schema.fields[: len(keep)], *(StructField(s, DoubleType()) for s in STATISTICS)]))


def held_out(id_col: str = "doc_id") -> Column:
    """Documents never to be learned from: crc32 of the id as text leaves 2 modulo 4. A null id does not."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


@dataclass
class Rules:
    """Conjunctions of (statistic, is upper bound, bound), each with its weight; and the intercept."""

    rules: list[tuple[tuple[tuple[str, bool, float], ...], float]]
    intercept: float

    def score(self) -> Column:
        """The chance of good quality, as one expression over the statistics."""
        z = F.lit(self.intercept)
        for rule, weight in self.rules:
            z = z + F.when(_holds(rule), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-z))


def _holds(rule: tuple[tuple[str, bool, float], ...]) -> Column:
    out = F.lit(True)
    for name, upper, bound in rule:
        out = out & ((F.col(name) <= bound) if upper else (F.col(name) > bound))
    return out


def _paths(node, bounds: tuple = ()) -> Iterator[tuple]:
    """Every path from the root of a fitted tree to one of its nodes."""
    if bounds:
        yield bounds
    if node.subtreeDepth() > 0:
        split = node.split()
        name, at = STATISTICS[split.featureIndex()], float(split.threshold())
        yield from _paths(node.leftChild(), (*bounds, (name, True, at)))
        yield from _paths(node.rightChild(), (*bounds, (name, False, at)))


def _simple(path: tuple) -> tuple:
    """A path with one bound a side of each statistic, in a fixed order."""
    tightest: dict[tuple[str, bool], float] = {}
    for name, upper, at in path:
        old = tightest.get((name, upper), at)
        tightest[name, upper] = min(old, at) if upper else max(old, at)
    return tuple((name, upper, at) for (name, upper), at in sorted(tightest.items()))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", fit_rows: int = FIT_ROWS, trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO) -> Rules:
    """Learn rules from labelled documents that are not held out.

    Only the text's statistics are inputs. Labels other than 0 and 1 are ignored; of an id's labels the smallest counts,
    and of its documents each. With one kind of label only, or none, there are no rules and every score is that share
    (0.5 with none).
    """
    marks = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & ~held_out(id_col)).groupBy(F.col(id_col).alias("id_")).agg(F.min(label_col).cast("double").alias("label"))
    many = marks.count()
    if many > fit_rows:
        marks = marks.where(F.pmod(F.xxhash64("id_"), F.lit(1_000_000)) < int(1e6 * fit_rows / many))
    rows = docs.select(F.col(id_col).alias("id_"), F.col(text_col).alias("text_")).join(F.broadcast(marks), "id_")  # fit_rows bounds the labels
    parts = max(2, min(many, fit_rows) // 8000)
    seen = materialise(statistics(rows.select("id_", "label", "text_"), ["id_", "label"], "text_").repartition(parts, "id_").sortWithinPartitions("id_", *STATISTICS), "quality-fit")
    share = {r["label"]: r["count"] for r in seen.groupBy("label").count().collect()}
    if len(share) < 2:
        known = sum(share.values())
        p = (share.get(1.0, 0) + 0.5) / (known + 1)
        return Rules([], float(np.log(p / (1 - p))))
    vector = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(seen).select("label", "features").cache()
    # Trees of alike weight for both labels find rules for the rarer one too.
    weighed = vector.withColumn("w", F.when(F.col("label") == 1.0, 1.0 / share[1.0]).otherwise(1.0 / share[0.0]) * (sum(share.values()) / 2))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, maxBins=48, featureSubsetStrategy="onethird", bootstrap=False, seed=11, minInstancesPerNode=max(3, sum(share.values()) // 2000), weightCol="w", cacheNodeIds=False).fit(weighed)
    rules = sorted({_simple(p) for t in forest.trees for p in _paths(t._java_obj.rootNode())})
    vector.unpersist()
    if not rules:
        p = share[1.0] / sum(share.values())
        return Rules([], float(np.log(p / (1 - p))))
    hits = seen.select("label", *[_holds(r).cast("double").alias(f"r{i}") for i, r in enumerate(rules)])
    hits = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="features").transform(hits).select("label", "features").cache()
    model = LogisticRegression(regParam=lasso, elasticNetParam=1.0, standardization=True, maxIter=60, tol=1e-5).fit(hits)
    hits.unpersist()
    weights = model.coefficients.toArray()
    return Rules([(r, float(w)) for r, w in zip(rules, weights, strict=True) if abs(w) > 1e-6], float(model.intercept))


def score(docs: DataFrame, rules: Rules, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (1 if the score reaches ``threshold``): a row a row of ``docs``, null and empty texts too."""
    measured = statistics(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), ["doc_id"])
    scored = measured.select("doc_id", held_out().alias("held_out"), rules.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, rules: Rules, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """``docs`` without those that score below ``threshold``; all columns stay."""
    names = docs.columns
    inner = docs.select(*[F.col(f"`{c}`").alias(f"c{i}_") for i, c in enumerate(names)])
    at = f"c{names.index(text_col)}_"
    good = statistics(inner, [*(c for c in inner.columns if c != at), at], at).where(rules.score() >= threshold)
    return good.select(*[F.col(f"c{i}_").alias(c) for i, c in enumerate(names)])
