"""Language-model scores of documents by stupid backoff, from counts over the whole corpus.

A document's own occurrences do not count for it, as every n-gram has been seen if they did: with c(g) the corpus count
of a gram less its count in the document, S(w | h) = c(hw) / c(h) if c(hw) > 0, else 0.4 * S(w | shorter h), and
S(w) = (c(w) + 1) / (N + V). Where c(hw) > 0, so is c(h). Hence a document's score is that of its words backed off all
the way, and what each gram adds that other documents have too:

    sum of log S(w) + (order - 1) log 0.4 over its words    +    sum over its distinct seen grams g = hw, m times, of
    m * (log c(hw) / c(h) - log c(w) / c(shorter h) [or log S(w)] - log 0.4)

So documents are exploded into distinct grams, these are joined to the counts of the gram and of its parts, and the
differences are added up by document; nothing else has to come together again.

Bigrams are what costs. Two things keep their shuffle small, at any size of the corpus: words that several documents
have are numbered by a dictionary of the ``WORDS`` commonest, so that a bigram of two of them is one number from which
the counts of its parts can be told; and the ``BIGRAMS`` commonest bigrams are scored where they are, from a broadcast
table. One is left out of it only if no slice of 2 MB has it three times, or a million others are commoner. So a gram in
the shuffle has two rows a slice at most, where a slice has some hundred thousand (a phrase that comes once in each of
many long documents has a row a document, of as many as the document has different bigrams), or is rare; a task's
share of rows is not set by a single gram. A window over each one's rows counts it and joins the count at once.
Bigrams with a rarer word go by hash and meet the table of word counts in a join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetmetrics.llm.shared import Members, U, gram_hashes, materialise, slices, tidy, word_hashes

BACKOFF = 0.4
#: Entries of the broadcast tables of words and of bigrams, of 16 bytes each. Words are numbered in ``WORD_BITS`` bits.
WORDS, BIGRAMS, WORD_BITS = 1 << 20, 1 << 20, 20
#: Counts are told apart by so many leading bits where the commonest are chosen: 2 ** LEADING counts for each further bit at most.
LEADING = 11
#: A bigram is a candidate for the table if a slice of ``SLICE_BYTES`` has it so often.
OFTEN = 3
SLICE_BYTES = 2_000_000


def _numbered(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values in order of appearance: a number for each element, the value's first place, and how often it comes."""
    numbers, _ = pd.factorize(x)
    highest = np.maximum.accumulate(numbers) if len(x) else numbers
    first = np.flatnonzero(np.diff(highest, prepend=-1) > 0)
    return numbers, first, np.bincount(numbers, minlength=len(first))


class _Slice:
    """Words of a slice of documents by position, its distinct words and bigrams, and those of each document."""

    def __init__(self, texts: pa.Array) -> None:
        self.words, at, _ = word_hashes(texts)
        self.docs, self.sizes = len(at) - 1, np.diff(at)
        self.doc = np.repeat(np.arange(self.docs), self.sizes)
        #: Distinct words, which of them each position has, and how often they come.
        self.kind, first, self.kind_counts = _numbered(self.words.view(np.int64))
        self.kinds = self.words[first]
        #: Positions of second words, and their distinct bigrams.
        self.second = np.flatnonzero(self.doc[1:] == self.doc[:-1]) + 1
        self.pair_kind, first, self.pair_counts = _numbered(self.kind[self.second - 1] * (len(self.kinds) + 1) + self.kind[self.second])
        ends = self.second[first]
        self.pair_hashes = gram_hashes(np.stack([self.words[ends - 1], self.words[ends]], axis=1).ravel(), 2)[::2] + U(1)

    def by_document(self) -> None:
        """Distinct (document, word): first position, number of occurrences, and which of them each position is; and bigrams likewise."""
        self.word_of, self.word_at, self.word_times = _numbered(self.doc * (len(self.kinds) + 1) + self.kind)
        _, first, self.pair_times = _numbered(self.doc[self.second] * (len(self.pair_hashes) + 1) + self.pair_kind)
        self.pair_at, self.pair_of = self.second[first], self.pair_kind[first]


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))


def _documents(s: _Slice) -> np.ndarray:
    _, first, _ = _numbered(s.doc * (len(s.kinds) + 1) + s.kind)
    return np.bincount(s.kind[first], minlength=len(s.kinds))


@tidy
def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, level, n, docs) of the words of a slice, and of the bigrams that it has often."""
    for batch in batches:
        for part in slices(batch, 0, SLICE_BYTES):
            s = _Slice(part.column(0))
            often = s.pair_counts >= OFTEN
            grams = np.concatenate([s.kinds, s.pair_hashes[often]])
            level = np.repeat([1, 2], [len(s.kinds), int(often.sum())])
            n = np.concatenate([s.kind_counts, s.pair_counts[often]])
            docs = np.concatenate([_documents(s), np.zeros(int(often.sum()), np.int64)])
            yield pa.RecordBatch.from_arrays([_long(grams), pa.array(level, pa.int8()), _long(n), _long(docs)], ["gram", "level", "n", "docs"])


class _Table:
    """A sorted table of hashes, with their counts."""

    def __init__(self, keys: np.ndarray, n: np.ndarray) -> None:
        order = np.argsort(keys)
        self.keys, self.n = keys[order], n[order]

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Places in the table, -1 for what is not there."""
        if not len(self.keys):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, at, -1)


def _largest(grams: DataFrame, level: int, most: int) -> tuple[_Table, int]:
    """The ``most`` commonest grams, or a few less, and the highest count that others may have; so what goes to the driver has a fixed bound, and nothing is sorted.

    Counts are cut to their leading ``LEADING`` bits, of which there are few, and grams are cut at such a count; of those
    that share it, as many as there is room for are taken, by hash.
    """
    shift = f"cast(greatest(length(bin(n)) - {LEADING}, 0) as int)"
    of = grams.where(F.col("level") == level).withColumn("low", F.expr(f"shiftleft(shiftright(n, {shift}), {shift})"))
    numbers = {r["low"]: (r["count"], r["high"]) for r in of.groupBy("low").agg(F.count("*").alias("count"), F.max("n").alias("high")).collect()}
    room, limit = most, 0
    for low in sorted(numbers, reverse=True):
        count, high = numbers[low]
        if count > room:
            room = max(0, room - 4 * int(room**0.5))
            below = -(1 << 63) + int((1 << 64) * room / count)
            of, limit = of.where((F.col("low") > low) | (F.col("low") == low) & (F.col("gram") < below)), high
            break
        room -= count
    top = of.select("gram", "n").toArrow()
    if len(top) > most:  # hashes fell together against all odds: what is cut may be as common as the commonest
        limit = max(numbers[low][1] for low in numbers)
    return _Table(top["gram"].to_numpy().view(np.uint64)[:most], top["n"].to_numpy()[:most]), limit


def _counted(common: Broadcast):
    """(place, n) of the bigrams of a table, once a task."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = common.value
        n = np.zeros(len(table.keys), np.int64)
        for batch in batches:
            for part in slices(batch, 0, SLICE_BYTES):
                s = _Slice(part.column(0))
                at = table.find(s.pair_hashes)
                np.add.at(n, at[at >= 0], s.pair_counts[at >= 0])
        met = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([_long(met), _long(n[met])], ["place", "n"])

    return run


def _packed(*times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Up to four numbers below 2**32 in two: their low halves, and their high halves, which are nearly always zero."""
    low, high = (sum((t >> s & 0xFFFF) << (16 * i) for i, t in enumerate(times)) for s in (0, 16))
    return low, high


def _times(i: int) -> Column:
    part = lambda c: F.shiftrightunsigned(F.col(c), 16 * i).bitwiseAND(F.lit(0xFFFF).cast("long"))
    return part("own") + part("more") * 65536


_SIDE = "row long, doc_id long, base double, n_words long, seen long, pairs long, gram long, h long, w long, ch long, cw long, own long, more long"


def _exploded(words: Broadcast, common: Broadcast, several: Broadcast, log_size: float, main: bool):
    """Main: (key, row, own, more) of the bigrams of two numbered words that the table lacks. Side: a row a document with
    what needs no shuffle; and words and bigrams with a word that has no number, but that several documents may have."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbered, pairs = words.value, common.value
        for batch in batches:
            for part in slices(batch, 2, SLICE_BYTES):
                s, row = _Slice(part.column(2)), part.column(0).to_numpy()
                s.by_document()
                number = numbered.find(s.kinds)
                shared = (number >= 0) | several.value.may_have(_long(s.kinds))
                h, w = s.kind[s.pair_at - 1], s.kind[s.pair_at]
                known = (number[h] >= 0) & (number[w] >= 0)
                place = np.where(known, pairs.find(s.pair_hashes)[s.pair_of], -1)
                doc, m, own_h, own_w = s.doc[s.pair_at], s.pair_times, s.word_times[s.word_of[s.pair_at - 1]], s.word_times[s.word_of[s.pair_at]]
                if main:
                    rest = known & (place < 0)
                    own, more = _packed(m[rest], own_h[rest], own_w[rest])
                    yield pa.RecordBatch.from_arrays([_long(number[h[rest]] << WORD_BITS | number[w[rest]]), _long(row[doc[rest]]), _long(own), _long(more)], ["key", "row", "own", "more"])
                    continue
                own_doc, own_kind = s.doc[s.word_at], s.kind[s.word_at]
                other = np.where(number[own_kind] >= 0, (numbered.n[number[own_kind]] if len(numbered.n) else 0) - s.word_times, 0)
                base = np.bincount(own_doc, s.word_times * np.log(other + 1.0), s.docs) - s.sizes * log_size + np.maximum(s.sizes - 1, 0) * np.log(BACKOFF)
                hit = place >= 0
                hit[hit] = pairs.n[place[hit]] > m[hit]
                c = (pairs.n[place[hit]] - m[hit], numbered.n[number[h[hit]]] - own_h[hit], numbered.n[number[w[hit]]] - own_w[hit] + 1)
                base += np.bincount(doc[hit], m[hit] * (np.log(c[0]) - np.log(c[1]) - np.log(c[2]) + log_size - np.log(BACKOFF)), s.docs)
                seen = np.bincount(doc[hit], m[hit], s.docs).astype(np.int64)
                # Words and bigrams that meet the counts of rarer words in a join.
                lone = (number[own_kind] < 0) & shared[own_kind]
                rest = ~known & shared[h] & shared[w]
                own, more = _packed(m[rest], own_h[rest], own_w[rest])
                count = lambda k: np.where(number[k] >= 0, (numbered.n[number[k]] if len(numbered.n) else 0), -1)
                none = lambda n, t=pa.int64(): pa.nulls(n, t)
                gone = lambda x, at: pa.array(x.view(np.int64) if x.dtype == np.uint64 else x, mask=at)
                a, b, d = int(lone.sum()), int(rest.sum()), s.docs
                hash_of = lambda k: s.kinds[k].view(np.int64)
                columns = {
                    "row": [_long(row), _long(row[own_doc[lone]]), _long(row[doc[rest]])],
                    "doc_id": [part.column(1), none(a), none(b)],
                    "base": [pa.array(base.astype(float)), none(a, pa.float64()), none(b, pa.float64())],
                    "n_words": [_long(s.sizes), none(a), none(b)],
                    "seen": [_long(seen), none(a), none(b)],
                    "pairs": [_long(np.maximum(s.sizes - 1, 0)), none(a), none(b)],
                    "gram": [none(d), none(a), _long(s.pair_hashes[s.pair_of[rest]])],
                    "h": [none(d), none(a), gone(hash_of(h[rest]), number[h[rest]] >= 0)],
                    "w": [none(d), _long(hash_of(own_kind[lone])), gone(hash_of(w[rest]), number[w[rest]] >= 0)],
                    "ch": [none(d), none(a), gone(count(h[rest]), number[h[rest]] < 0)],
                    "cw": [none(d), none(a), gone(count(w[rest]), number[w[rest]] < 0)],
                    "own": [none(d), _long(s.word_times[lone]), _long(own)],
                    "more": [none(d), none(a), _long(more)],
                }
                yield pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in columns.values()], list(columns))

    return run


def _others(rows: DataFrame, key: str) -> DataFrame:
    """Rows of bigrams that other documents have too, and how often those do (``c``), from a window over all rows of each."""
    m = _times(0)
    return rows.withColumn("c", F.sum(m).over(Window.partitionBy(key)) - m).where("c > 0")


def _added(of: DataFrame, size: int) -> DataFrame:
    """(row, added, seen): what bigrams add, by their count and the counts ``ch`` and ``cw`` of their words."""
    m, own_h, own_w = _times(0), _times(1), _times(2)
    value = F.log("c") - F.log(F.col("ch") - own_h) - F.log(F.col("cw") - own_w + 1) + F.log(F.lit(float(size))) - F.log(F.lit(BACKOFF))
    return of.select("row", (m * value).alias("added"), m.alias("seen"))


def _added_by_number(words: Broadcast, log_size: float):
    """As :func:`_added`, for bigrams of two numbered words: their counts are looked up in the broadcast table."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = words.value.n
        for batch in batches:
            key, row, own, more, c = (x.to_numpy() for x in batch.columns)
            m, own_h, own_w = ((own >> (16 * i) & 0xFFFF) + ((more >> (16 * i) & 0xFFFF) << 16) for i in range(3))
            value = np.log(c) - np.log(n[key >> WORD_BITS] - own_h) - np.log(n[key & (1 << WORD_BITS) - 1] - own_w + 1) + log_size - np.log(BACKOFF)
            numbers, rows = pd.factorize(row)
            yield pa.RecordBatch.from_arrays([_long(rows), pa.array(np.bincount(numbers, m * value, len(rows))), _long(np.bincount(numbers, m, len(rows)))], ["row", "added", "seen"])

    return run


def _bigram_scores(rows: DataFrame) -> DataFrame:
    """Scores of (row, doc_id, text) at order 2."""
    share = rows.sparkSession.sparkContext.broadcast
    texts = rows.select("text")
    met = texts.mapInArrow(_met, "gram long, level byte, n long, docs long").groupBy("gram", "level").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    met = materialise(met, "backoff-counts")
    words = met.where("level = 1")
    total, kinds = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    size = max(1, total + kinds)
    (numbered, limit), (common, _) = _largest(met.where("docs > 1"), 1, WORDS), _largest(met, 2, BIGRAMS)
    exact = texts.mapInArrow(_counted(share(common)), "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    common.n = np.zeros(len(common.keys), np.int64)
    common.n[exact["place"].to_numpy()] = exact["n"].to_numpy()
    rarer = words.where((F.col("docs") > 1) & (F.col("n") <= limit)).select(F.col("gram").alias("id"), F.col("n").alias("times"))
    shared = share(numbered), share(common), share(Members.of(rarer.select("id"))), float(np.log(size))
    side = materialise(rows.mapInArrow(_exploded(*shared, False), _SIDE), "backoff-side")

    main = rows.mapInArrow(_exploded(*shared, True), "key long, row long, own long, more long")
    main = _others(main.repartition("key"), "key").select("key", "row", "own", "more", "c").mapInArrow(_added_by_number(shared[0], shared[3]), "row long, added double, seen long")

    odd = side.where("gram is not null").drop("doc_id", "base", "n_words", "seen", "pairs")
    rare = lambda name, at: rarer.select(F.col("id").alias(at), F.col("times").alias(name))
    first = odd.where("h is not null and w is null").drop("ch").join(rare("ch", "h"), "h")
    second = odd.where("h is null and w is not null").drop("cw").join(rare("cw", "w"), "w")
    both = odd.where("h is not null and w is not null").drop("ch", "cw").join(rare("ch", "h"), "h").join(rare("cw", "w"), "w")
    odd = _added(_others(first.unionByName(second).unionByName(both), "gram"), size)
    lone = side.where("gram is null and w is not null").select("row", "w", "own").join(rare("cw", "w"), "w")
    lone = lone.select("row", (F.col("own") * F.log(F.col("cw") - F.col("own") + 1)).alias("added"), F.lit(0).cast("long").alias("seen"))

    headers = side.where("n_words is not null").select("row", F.col("base").alias("added"), "seen", "doc_id", "n_words", "pairs")
    every = headers.unionByName(main.unionByName(odd).unionByName(lone), allowMissingColumns=True)
    out = every.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.sum("added").alias("score"), (F.max("pairs") - F.sum("seen")).alias("n_backed_off"))
    return out.select("doc_id", "n_words", F.round("score", 6).alias("log_score"), "n_backed_off")


def _grams(order: int):
    """(row, doc_id, level, gram, h, g, gh, m, own_h, own_g, own_gh) of a document's distinct grams: h is the gram without its
    last word, g without its first, gh without both; a row of level 0 a document."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row", "doc_id", "level", "gram", "h", "g", "gh", "m", "own_h", "own_g", "own_gh"]
        for batch in batches:
            for part in slices(batch, 2, SLICE_BYTES):
                words, at, _ = word_hashes(part.column(2))
                row, n = part.column(0).to_numpy(), np.diff(at)
                doc = np.repeat(np.arange(len(n)), n)
                place = np.arange(len(words)) - np.repeat(at[:-1], n)
                none = pa.nulls(len(row), pa.int64())
                yield pa.RecordBatch.from_arrays([_long(row), part.column(1), pa.array(np.zeros(len(row)), pa.int8()), none, none, none, none, _long(n), none, none, none], names)
                hashes, own = [words], []
                for level in range(1, order + 1):
                    if level > 1:
                        h = np.zeros(len(words), np.uint64)
                        if len(words) >= level:
                            h[level - 1 :] = gram_hashes(words, level) + U(level - 1)
                        hashes.append(h)
                    ends = np.flatnonzero(place >= level - 1)
                    kinds, kind = np.unique(hashes[-1][ends], return_inverse=True)
                    _, first, which, times = np.unique(doc[ends] * (len(kinds) + 1) + kind, return_index=True, return_inverse=True, return_counts=True)
                    mine = np.zeros(len(words), np.int64)
                    mine[ends] = times[which]
                    own.append(mine)
                    e = ends[first]
                    before = lambda k, back, x, e=e: _long(x[k - 1][e - back]) if k >= 1 else pa.nulls(len(e), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [_long(row[doc[e]]), pa.nulls(len(e), pa.int64()), pa.array(np.full(len(e), level), pa.int8()), _long(hashes[-1][e]), before(level - 1, 1, hashes), before(level - 1, 0, hashes), before(level - 2, 1, hashes), _long(times), before(level - 1, 1, own), before(level - 1, 0, own), before(level - 2, 1, own)], names
                    )

    return run


def _any_order_scores(rows: DataFrame, order: int) -> DataFrame:
    """Scores at any order: exploded grams, written, joined to the table of the counts of those that several documents have."""
    columns = "row long, doc_id long, level byte, gram long, h long, g long, gh long, m long, own_h long, own_g long, own_gh long"
    exploded = materialise(rows.mapInArrow(_grams(order), columns), "backoff-grams")
    grams = exploded.where("level > 0")
    counts = materialise(grams.groupBy("level", "gram").agg(F.sum("m").alias("n"), F.count("*").alias("docs"), F.first("h").alias("h"), F.first("g").alias("g"), F.first("gh").alias("gh")), "backoff-counts")
    total, kinds = counts.where("level = 1").agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    size, table = F.log(F.lit(float(max(1, total + kinds)))), counts.where("docs > 1")
    part = lambda name, less: table.select((F.col("level") + less).alias("level"), F.col("gram").alias(name), F.col("n").alias(f"n_{name}"))
    # Counts of a gram's parts are joined once a gram, not once a document.
    whole = table.select("level", "gram", "n", "h", "g", "gh").join(part("h", 1), ["level", "h"], "left").join(part("g", 1), ["level", "g"], "left").join(part("gh", 2), ["level", "gh"], "left")
    seen = grams.select("row", "level", "gram", "m", "own_h", "own_g", "own_gh").join(whole.select("level", "gram", "n", "n_h", "n_g", "n_gh"), ["level", "gram"]).where("n > m")
    log = lambda total, own: F.log(F.col(total) - F.col(own))
    shorter = F.when(F.col("level") == 2, F.log(F.col("n_g") - F.col("own_g") + 1) - size).otherwise(log("n_g", "own_g") - log("n_gh", "own_gh"))
    value = F.when(F.col("level") == 1, F.log(F.col("n") - F.col("m") + 1)).otherwise(log("n", "m") - log("n_h", "own_h") - shorter - F.log(F.lit(BACKOFF)))
    lost = sum((F.greatest(F.col("m") - k, F.lit(0)) for k in range(1, order)), F.lit(0).cast("long"))
    headers = exploded.where("level = 0").select("row", "doc_id", F.col("m").alias("n_words"), (lost * F.log(F.lit(BACKOFF)) - F.col("m") * size).alias("added"), lost.alias("lost"))
    every = headers.unionByName(seen.select("row", (F.col("m") * value).alias("added"), F.when(F.col("level") > 1, -F.col("m")).otherwise(0).alias("lost")), allowMissingColumns=True)
    out = every.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.sum("added").alias("score"), F.sum("lost").alias("n_backed_off"))
    return out.select("doc_id", "n_words", F.round("score", 6).alias("log_score"), "n_backed_off")


def backoff_scores(docs: DataFrame, order: int = 2, id_col: str = "doc_id", text_col: str = "text", stable: bool = False) -> DataFrame:
    """doc_id, n_words, log_score (natural log, summed over the words), n_backed_off, mean_log_score of each whole text.

    Counts are over all of ``docs`` but the document itself; a copy of it counts as another document. Texts without a
    word (null, empty) score 0 with a null mean. Repeated rows and null ids are documents of their own; other columns
    are ignored; an empty table gives no rows. A gram is known by a 64-bit hash of its words (see ``word_hashes``).

    ``docs`` is read several times, and its rows are numbered: ``stable`` says that it gives the same rows in the same
    order each time, as files do; others are written to the shared folder first. Order 2 takes the way of the module's
    last paragraph; other orders join all grams as they are.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    docs = docs if stable else materialise(docs, "backoff-docs")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    found = _bigram_scores(rows) if order == 2 else _any_order_scores(rows, order)
    return found.withColumn("mean_log_score", F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")))
