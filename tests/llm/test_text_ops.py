"""Periodic runs, fill-in-middle and line dedup against brute force, and their results for odd rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from fleetmetrics.llm import fim, linededup, periodic
from fleetmetrics.llm import queries as registered

SF = "/root/testdata/sf0.001"
ODD = [None, "", " ", "x", "\n", "\n\n  \n", "a b " * 50, "\t".join(["w"] * 30), "<P", "a<M>b", "é𝄞" * 3000, "ab " * 40000, "Same line as others\nmine", " same LINE as others \nyours", "\0\x01|||", "日本語 テキスト"]


@pytest.fixture(scope="module")
def documents():
    return pq.read_table(f"{SF}/documents.parquet").to_pylist()


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, a repeated row and a repeated id, and columns that clash with those that come."""
    rows = [(i if i != 3 else None, t, "en", 1, "x") for i, t in enumerate(ODD)] + [(12, ODD[12], "en", 1, "x"), (12, ODD[13], "de", 1, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n int, `a.b` string")


def run(spark, name):
    return {r.doc_id: r for r in registered.queries()[name](spark, SF).collect()}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# 11


def brute_runs(words):
    """Every lag compared over the whole text; of the stretches with one start and end the least period."""
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    w, out = np.array([number[x] for x in words]), {}
    for q in range(1, len(w) // 3 + 1):
        at = np.flatnonzero(np.diff(np.concatenate([[0], w[:-q] == w[q:], [0]])))
        for a, b in zip(at[::2].tolist(), at[1::2].tolist(), strict=True):
            if b + q - a >= max(24, 3 * q):
                out.setdefault((a, b + q), q)
    return sorted((s, e - s, q) for (s, e), q in out.items())


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_runs_of_the_table(spark, documents):
    got, looped = run(spark, "op11_periodic_runs"), 0
    assert len(got) == len(documents)
    for d in documents:
        words = words_of(d["text"])
        h = zlib.crc32(str(d["doc_id"]).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [*words[:a], *[words[a + (i - a) % p] for i in range(a, n)]]
            looped += 1
        runs, r = brute_runs(words), got[d["doc_id"]]
        assert r.n_runs == len(runs)
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2])) if runs else (None,) * 3
        assert (r.start, r.length, r.period) == best and r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == sha("".join(f"{s},{n},{q}\n" for s, n, q in runs))
        assert r.collapsed_sha256 == sha(collapsed(words, runs))
    assert looped and any(r.n_runs for r in got.values())


def made(rng):
    """Random, constant, Fibonacci and Thue-Morse words, and blocks of blocks that repeat."""
    letters, n = rng.choice([1, 2, 3, 5, 50, 1000]), rng.randint(0, 900)
    some = lambda k: [rng.randrange(letters) for _ in range(k)]
    kind = rng.randrange(8)
    if kind == 0:
        return some(n)
    if kind == 1:
        return some(rng.randint(0, 50)) + (some(rng.randint(1, 300)) * rng.randint(2, 6))[:n] + some(rng.randint(0, 50))
    if kind == 2:
        block = some(rng.randint(1, 4)) * rng.randint(5, 30) + some(rng.randint(1, 30))
        return (block * rng.randint(2, 5) + some(rng.randint(0, 5))) * rng.randint(2, 4)
    if kind in (3, 4):
        x, y = [0], [0, 1] if kind == 3 else [0]
        while len(y) < n:
            x, y = y, y + (x if kind == 3 else [1 - v for v in y])
        return (y * 3)[:2500]
    if kind == 5:
        return ((a := some(rng.randint(5, 60))) + a + some(rng.randint(5, 60))) * rng.randint(3, 5)
    return (([0] * rng.randint(20, 200) + [1]) * rng.randint(3, 5))[:2000]


def test_runs_of_made_texts():
    rng, total = random.Random(11), 0
    for _ in range(60):
        docs = [made(rng) for _ in range(rng.randint(0, 8))]
        offsets = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int64)
        rows, text = periodic.runs_of(np.array(sum(docs, []), np.int64), offsets)
        for k, d in enumerate(docs):
            assert sorted(map(tuple, rows[text == k].tolist())) == brute_runs(d)
        total += len(rows)
    assert total > 500


def test_seeds_are_few():
    """Pairs of minimizers stay below nine a word, however repetitive a text is."""
    words = np.array(([0] * 5000 + [1, 2, 3]) * 3)
    t = periodic._Texts(words, np.array([0, len(words)]))
    seeds = []
    whole, t.stretches = t.stretches, lambda at, lag: seeds.append(len(at)) or whole(at, lag)
    known = periodic._smallest(np.concatenate(list(periodic._lags(t))))
    for q in (48, 480, 4800):
        periodic._scale(t, q, len(words), known)
    assert sum(seeds[periodic.FIRST :]) < len(words)


def test_runs_where_hashes_collide(monkeypatch):
    """Stretches that only look equal are compared by word and found again."""
    words = np.array([5, 6] + [1, 2, 3] * 20 + [7, 8, 9] * 12)
    monkeypatch.setattr(periodic._Texts, "same", lambda self, a, b, size: np.ones(len(a), bool))
    rows, _ = periodic.runs_of(words, np.array([0, len(words)]))
    assert set(brute_runs(words.tolist())) >= set(map(tuple, rows.tolist())) and (2, 60, 3) in map(tuple, rows.tolist())


def test_runs_of_odd_rows(spark, odd):
    got = periodic.find_runs(odd).collect()
    assert sorted(map(repr, [r.text for r in got])) == sorted(map(repr, [*ODD, ODD[12], ODD[13]]))
    for r in got:
        words = words_of(r.text)
        assert r.n_words == len(words) and r["a.b"] == "x"
        runs = brute_runs(words) if len(words) < 5000 else [(0, 40000, 1)]
        assert [tuple(x) for x in r.runs] == runs and r.collapsed == collapsed(words, runs)
    assert periodic.find_runs(odd.where("false")).count() == 0
    assert periodic.find_runs(odd.withColumnRenamed("n", "runs")).columns.count("runs") == 1


# 12


def brute_fim(doc, text):
    text = text or ""
    digits = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h, n = [int(digits[8 * k : 8 * k + 8], 16) for k in range(4)], len(text)
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    return (n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 20 else (n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}")


def test_fill_in_middle_of_the_table(spark, documents):
    got = run(spark, "op12_fill_in_middle")
    assert len(got) == len(documents)
    for d in documents:
        *rest, out = brute_fim(d["doc_id"], d["text"])
        r = got[d["doc_id"]]
        assert [r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256, r.restored_sha256] == [*rest, sha(out), sha(d["text"] or "")]
    assert {r.form for r in got.values()} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("block", [1 << 20, 7])
def test_fill_in_middle_byte_by_byte(monkeypatch, block):
    """Parts of markers at every cut, characters of one to four bytes, and blocks that cut parts."""
    monkeypatch.setattr(fim, "BLOCK", block)
    rng = random.Random(12)
    texts = ["", "<P>", "<", "<P", "P>", "é"] + ["".join(rng.choices("<PSM>aé日𝄞\n", k=rng.randint(0, 40))) for _ in range(3000)]
    raw = [t.encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum(list(map(len, raw)))])
    h = np.array([[int(hashlib.sha256(f"1:{i}".encode()).hexdigest()[8 * k : 8 * k + 8], 16) for k in range(4)] for i in range(len(texts))])
    out, ends, found = fim.transform(data, offsets, h)
    for i, t in enumerate(texts):
        n, form, *cuts, want = brute_fim(i, t)
        assert (found["n"][i], fim.FORMS[found["form"][i]], out[ends[i] : ends[i + 1]].tobytes().decode()) == (n, form, want)
        assert form == "plain" or [found["prefix_chars"][i], found["middle_chars"][i]] == cuts
    back, at = fim.restore(out, ends, found["form"])
    assert (back == data).all() and (at == offsets).all()


def test_fill_in_middle_of_odd_rows(spark, odd):
    got = fim.restored(fim.fill_in_middle(odd)).collect()
    assert len(got) == len(ODD) + 2
    for r in got:
        *_, out = brute_fim(r.doc_id, r.text)
        assert (r.output, r.restored, r["a.b"], r.n) == (out, r.text or "", "x", len(r.text or ""))
    assert fim.restored(fim.fill_in_middle(odd.where("false"))).count() == 0
    assert {r.form for r in fim.fill_in_middle(odd, plain_from=0).collect()} == {"plain"}


# 13


def brute_dedup(docs):
    """doc_id -> list of (lines before, kept text), in the order of the rows."""
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\v\f\r"))
    holders = {}
    for i, t in docs:
        for line in (t or "").split("\n"):
            if i is not None and len(key(line)) >= 10:
                holders.setdefault(key(line), set()).add(i)
    out = {}
    for i, t in docs:
        lines = (t or "").split("\n")
        gone = lambda line: i is not None and len(key(line)) >= 10 and len(holders[key(line)]) > 1 and min(holders[key(line)]) != i  # noqa: E731, B023
        kept = [x for x in lines if not gone(x)]
        out.setdefault(i, []).append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def same_dedup(rows, docs):
    want, got = brute_dedup(docs), {}
    for r in rows:
        got.setdefault(r.doc_id, []).append((r.n_lines, r.n_dropped, r.text))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_line_dedup_of_the_table(spark, documents):
    got, want = run(spark, "op13_line_dedup"), brute_dedup([(d["doc_id"], d["text"]) for d in documents])
    assert {k: [(r.n_lines, r.n_dropped, r.kept_sha256)] for k, r in got.items()} == {k: [(n, m, sha(t)) for n, m, t in v] for k, v in want.items()}
    assert any(r.n_dropped for r in got.values())


def made_documents(rng, n):
    lines = ["shared line %d" % k for k in range(60)] + ["KEEP ME short", "ünïcödé %s", "   spaced line here\t", "SPACED LINE HERE", "123456789", "日本語日本語日本語日", "日本語日本語日本語"]
    return [(rng.randrange(-n, n), "\n".join([rng.choice(lines) for _ in range(rng.randint(0, 12))] + ["the line of all documents"] * rng.randint(0, 2))) for _ in range(n)]


@pytest.mark.parametrize("bits", [1 << 29, 1 << 12])
def test_line_dedup_in_ranges(spark, monkeypatch, bits):
    """A hot line, repeated ids, negative ids; with small filters the keys are taken in several ranges."""
    monkeypatch.setattr(linededup, "FILTER_BITS", bits)
    rng = random.Random(13)
    docs = [*made_documents(rng, 400), *[(i + 1000, f"own line number {i}\nanother own {i}") for i in range(700)], (None, "the line of all documents"), (None, None)]
    rng.shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    same_dedup(linededup.drop_repeated_lines(df).collect(), docs)


def test_filters_lose_nothing(spark):
    """Keys that two tasks, two batches or one batch have twice are all in the second filter; few others are."""
    rng = np.random.default_rng(14)
    once, twice = rng.integers(-(1 << 62), 1 << 62, 20000), rng.integers(-(1 << 62), 1 << 62, 5000)
    df = spark.createDataFrame([(int(x),) for x in [*once, *twice, *twice]], "rest long").repartition(7)
    found = linededup._twice(df, linededup.Bloom.size_for(25000), "rest")
    assert found.has(twice.view(np.uint64)).all() and found.has(once.view(np.uint64)).mean() < 0.1


def test_line_dedup_of_odd_rows(spark, odd):
    got = linededup.drop_repeated_lines(odd.withColumnRenamed("n", "n_dropped")).collect()
    same_dedup(got, [(r.doc_id, r.text) for r in odd.collect()])
    assert all(r["a.b"] == "x" for r in got) and {r.lang for r in got if r.doc_id == 12} == {"en", "de"}
    assert linededup.drop_repeated_lines(odd.where("false")).count() == 0


def test_only_suspects_are_shuffled(spark, documents):
    """Exchanges carry digests and documents that lose lines; the others' texts go straight through."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    plan = linededup.drop_repeated_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2 and "Sort" not in plan, plan


# Columns whose names clash with those that come, and the pipeline on odd rows

NAMES = ["spans", "ids", "length", "row", "class_id", "n_links", "score", "predicted", "held_out", "sequence_id", "key", "a.b"]


@pytest.fixture(scope="module")
def clashing(spark):
    rows = [(i, t, *[f"{n}!" for n in NAMES]) for i, t in enumerate(ODD)]
    return spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in NAMES))


def test_clashing_names_do_no_harm(spark, clashing):
    """The same results as without the other columns."""
    from fleetmetrics.llm import backoff, jaccard, packing, pii, secrets, topk, warc

    words = registered.public_tokenizers.path("word_bpe_49k.json")
    plain = clashing.select("doc_id", "text")
    for f in (pii.find_pii, secrets.find_secrets, jaccard.near_duplicates, backoff.backoff_scores, lambda d: packing.pack(d, words)):
        assert sorted(map(str, f(clashing).collect())) == sorted(map(str, f(plain).collect()))
    pages = clashing.withColumnsRenamed({"doc_id": "page_id", "text": "html", "key": "url", "row": "start", "ids": "content"})
    a, b = (warc.records(p).collect() for p in (pages, pages.select("page_id", "url", "html")))
    assert sorted(map(str, a)) == sorted(map(str, b))
    v = spark.createDataFrame([(k, [float(k), 1.0], "x", "y") for k in range(5)], "vec_id long, embedding array<double>, rank string, score string")
    got = [topk.top_k(w, w.where("vec_id = 0"), 3).collect() for w in (topk.integer_vectors(x, "vec_id", "embedding") for x in (v, v.select("vec_id", "embedding")))]
    assert got[0] == got[1] and len(got[0]) == 3


def test_the_pipeline_on_odd_rows(spark, clashing):
    """Nulls, empty and long texts, repeats, rows without an id and clashing names, through all four stages in turn."""
    import corpus_pipeline

    docs = clashing.unionByName(clashing.where("doc_id in (7, 10)")).unionByName(clashing.where("doc_id = 9").withColumn("doc_id", clashing.doc_id * None)).withColumn("n_chars", clashing.doc_id * 0)
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        after = corpus_pipeline.materialise(stage(spark, docs, SF), f"odd-{name}")
        assert after.columns == docs.columns, name
        docs = after
    kept = {r.doc_id: r for r in docs.collect()}
    assert 8 in kept and kept[8].text == "<P" and None in kept and kept[8]["a.b"] == "a.b!"
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in packed} == set(kept) and max(r.offset + r.length for r in packed) <= 2048
    every = corpus_pipeline.STAGES[0][1](spark, clashing, SF)
    assert every.columns == clashing.columns and {r.doc_id for r in every.collect()} <= set(range(len(ODD)))
