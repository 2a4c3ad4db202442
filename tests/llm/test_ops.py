"""Each operator against a brute-force version, and its results for nulls, empty and long texts, ties, repeats and empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from fleetmetrics.llm import avi, backoff, bpe, jaccard, media, mjpeg, packing, pii, quality, secrets, topk, warc
from fleetmetrics.llm import queries as registered
from fleetmetrics.llm.words import WordTokenizer

SF = "/root/testdata/sf0.001"
BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
TEXT = "one fine day the quick brown fox jumps over the lazy dog and runs home to its den by the river"
ODD = [None, "", " ", "x", TEXT, TEXT, TEXT + " again", "é" * 3000, "ab " * 40000, "a" * 9000, "\0\x01|||", "日本語 テキスト"]


@pytest.fixture(scope="module")
def documents():
    return pq.read_table(f"{SF}/documents.parquet").to_pylist()


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i if i != 3 else None, t, "en", 1) for i, t in enumerate(ODD)] + [(4, TEXT, "en", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, spans int")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def run(spark, name):
    return registered.queries()[name](spark, SF).collect()


def words(text):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", (text or "").lower())


# 1


def brute_top(vectors, k):
    ids, v = np.array([i for i, _ in vectors]), np.array([x for _, x in vectors])
    out = set()
    for q in np.flatnonzero(ids % 100 == 0):
        s = v @ v[q]
        best = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[q]][:k]
        out |= {(int(ids[q]), r, int(ids[j]), int(s[j])) for r, j in enumerate(best, 1)}
    return out


def test_top_k_on_the_table(spark):
    t = pq.read_table(f"{SF}/embeddings.parquet").to_pylist()
    v = [(r["vec_id"], np.floor(1024 * np.array(r["embedding"], np.float32).astype(float)).astype(np.int64)) for r in t]
    assert {tuple(r) for r in run(spark, "op1_topk")} == brute_top(v, 10)


def test_top_k_ties_nulls_and_blocks(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 4)]) for i in range(700)] + [(i, [1.0, 1.0, 1.0, 1.0]) for i in range(700, 900)]
    bad = [(901, None), (902, [None, 1.0, 1.0, 1.0]), (903, [float("nan")] * 4), (904, [float("inf")] * 4), (None, [1.0] * 4), (1000, [1.0, 2.0])]
    df = spark.createDataFrame(rows + bad, "id long, e array<double>").repartition(3)
    v = topk.integer_vectors(df, "id", "e", 1)
    expected = brute_top([(i, np.array(x, np.int64)) for i, x in rows], 10)
    for block in (2048, 2):
        assert {tuple(r) for r in topk.top_k(v, v.where("vec_id % 100 = 0"), 10, block).collect()} == expected
    few = v.where("vec_id < 4")
    assert topk.top_k(few, few.where("vec_id = 0")).count() == 3
    assert topk.top_k(few.where("false"), few).count() == 0 and topk.top_k(few, few.where("false")).count() == 0


# 2


def test_media_round_trip(spark, documents):
    got = {r.doc_id: r for r in run(spark, "op2_media")}
    for d in documents:
        b = (d["text"] or "").encode()
        p = b + b"\xff" * (576 * max(1, -(-len(b) // 576)) - len(b))
        r = got[d["doc_id"]]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(b), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]))


def test_media_edges(spark, odd, none):
    read = media.read_media(media.store_texts(odd)).collect()
    for r in read:
        assert len(r.payload) % 576 == 0 and len(r.payload) > 0 and bytes(r.payload[r.n_bytes :]) == b"\xff" * (len(r.payload) - r.n_bytes)
    assert len({r.feature for r in read if r.doc_id in (4, 5)}) == 1
    assert media.read_media(media.store_texts(none)).count() == 0
    broken = spark.createDataFrame([(1, None), (2, bytearray(b"RIFFxxxxAVI ")), (3, bytearray(b"junk"))], "doc_id long, media binary")
    assert [r.feature for r in media.read_media(broken).collect()] == [None] * 3


def test_broken_media_never_raise(spark, documents):
    """Bytes flipped, cut and moved in the containers and the frames: each file is read or null, soon."""
    import time

    import pyarrow as pa

    rng = np.random.default_rng(13)
    stored = media.store_texts(spark.createDataFrame([(i, d["text"][:3000]) for i, d in enumerate(documents[:40])], "doc_id long, text string"))
    whole = [bytes(r.media) for r in stored.collect()]
    image = np.add.outer(np.arange(32) * 3, np.arange(40) * 4).astype(np.uint8)
    whole += [avi.write([baseline(image, 1, restart)] * 3, 40, 32) for restart in (0, 3)] * 5
    broken = []
    for k in range(1500):
        data = bytearray(whole[k % len(whole)])
        for _ in range(int(rng.integers(1, 6))):
            at = int(rng.integers(0, min(len(data), 700 if rng.random() < 0.7 else len(data))))
            data[at] = int(rng.integers(0, 256))
        if rng.random() < 0.3:
            data = data[: int(rng.integers(0, len(data)))]
        broken.append(bytes(data))
    began = time.time()
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(broken))), pa.array(broken, pa.binary())], ["id", "media"])
    out = [row for b in media._read(iter([batch])) for row in b.column(2).to_pylist()]
    assert len(out) == len(broken) and time.time() - began < 120
    assert any(x is None for x in out) and any(x is not None for x in out)


def test_shots_and_clips(spark):
    rng = np.random.default_rng(1)
    scenes = [np.clip(rng.normal(m, 5, (n, 24, 24)), 0, 255).astype(np.uint8) for m, n in ((40, 12), (200, 9), (90, 15))]
    frames = np.concatenate(scenes)
    file = avi.write(mjpeg.encode_lossless(frames), 24, 24, fps=10)
    got = media.clips(media.read_media(spark.createDataFrame([(7, bytearray(file))], "doc_id long, media binary"))).collect()
    assert [(r.start_frame, r.end_frame, r.start_s, r.end_s) for r in got] == [(0, 12, 0.0, 1.2), (12, 21, 1.2, 2.1), (21, 36, 2.1, 3.6)]


def test_clips_of_many_videos(spark):
    """Times follow each video's own pace; clips cover it without gaps; unreadable ones and null have none."""
    rng = np.random.default_rng(9)
    rows, lengths = [], {}
    for i in range(12):
        parts = [np.clip(rng.normal(rng.integers(20, 230), 4, (int(rng.integers(3, 9)), 24, 24)), 0, 255).astype(np.uint8) for _ in range(int(rng.integers(1, 5)))]
        fps = int(rng.integers(1, 50))
        frames = np.concatenate(parts)
        lengths[i] = (len(frames), fps)
        rows.append((i, bytearray(avi.write(mjpeg.encode_lossless(frames), 24, 24, fps=fps))))
    df = spark.createDataFrame([*rows, (90, bytearray(b"RIFF")), (91, None)], "doc_id long, media binary")
    by = {}
    for r in media.clips(media.read_media(df)).collect():
        by.setdefault(r.doc_id, []).append(r)
    assert set(by) == set(lengths)
    for i, found in by.items():
        found.sort(key=lambda r: r.clip)
        n, fps = lengths[i]
        edges = [r.start_frame for r in found] + [n]
        assert edges[0] == 0 and edges == sorted(set(edges)) and [r.end_frame for r in found] == edges[1:]
        assert all(abs(r.start_s - r.start_frame / fps) < 1e-3 * (r.start_frame + 1) and abs(r.end_s - r.end_frame / fps) < 1e-3 * (r.end_frame + 1) for r in found)


def baseline(pixels, q, restart=0):
    """A plain baseline encoder, block by block."""
    dc, ac = mjpeg.huffman(mjpeg.DC_LENGTHS, mjpeg.DC_SYMBOLS).codes, mjpeg.huffman(mjpeg.AC_LENGTHS, mjpeg.AC_SYMBOLS).codes
    order, cosine, (h, w) = mjpeg.zigzag(), mjpeg._cosines(), pixels.shape
    out, bits, last, n, k = b"", "", 0, 0, 0

    def code(table, symbol, v, s):
        c, size = table[symbol]
        return format(c, f"0{size}b") + (format(v if v >= 0 else v + (1 << s) - 1, f"0{s}b") if s else "")

    def flush(b):
        b += "1" * (-len(b) % 8)
        return bytes(int(b[i : i + 8], 2) for i in range(0, len(b), 8)).replace(b"\xff", b"\xff\0")

    for y in range(0, h, 8):
        for x in range(0, w, 8):
            if restart and n and n % restart == 0:
                out, bits, last, k = out + flush(bits) + bytes([0xFF, 0xD0 + k % 8]), "", 0, k + 1
            n += 1
            c = np.rint(cosine @ (pixels[y : y + 8, x : x + 8].astype(float) - 128) @ cosine.T / q).astype(int).ravel()[order].tolist()
            s = abs(c[0] - last).bit_length()
            bits, last, zeros = bits + code(dc, s, c[0] - last, s), c[0], 0
            for v in c[1:]:
                if not v:
                    zeros += 1
                    continue
                while zeros > 15:
                    bits, zeros = bits + code(ac, 0xF0, 0, 0), zeros - 16
                s = abs(v).bit_length()
                bits, zeros = bits + code(ac, zeros << 4 | s, v, s), 0
            if zeros:
                bits += code(ac, 0, 0, 0)
    part = lambda m, b: bytes([0xFF, m]) + (len(b) + 2).to_bytes(2, "big") + b
    head = part(0xDB, b"\0" + bytes([q] * 64)) + part(0xC0, bytes([8, h >> 8, h & 255, w >> 8, w & 255, 1, 1, 0x11, 0])) + (part(0xDD, restart.to_bytes(2, "big")) if restart else b"")
    return b"\xff\xd8" + head + part(0xDA, bytes([1, 1, 0, 0, 63, 0])) + out + flush(bits) + b"\xff\xd9"


@pytest.mark.parametrize("restart", [0, 3])
def test_baseline_frames(restart):
    rng = np.random.default_rng(2)
    images = [np.add.outer(np.arange(32) * 3, np.arange(40) * 4).astype(np.uint8), rng.integers(0, 256, (32, 40), dtype=np.uint8)]
    for got, image in zip(mjpeg.decode([baseline(i, 1, restart) for i in images]), images, strict=True):
        assert np.abs(got.astype(int) - image).max() <= 2


# 3


def test_bpe_equals_the_library(spark, documents):
    t, got = Tokenizer.from_file(BYTES), {r.doc_id: r for r in run(spark, "op3_bpe")}
    for d in documents:
        ids = t.encode(d["text"] or "", add_special_tokens=False).ids
        r = got[d["doc_id"]]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def bpe_texts():
    rng = np.random.default_rng(3)
    parts = ["a", "b", " ", "  ", "\n", " \n", "\t", "'s", "'ll", "'", "l", "r", "e", "1", "23", "!", "?", "é", "<|endoftext|>", "the", "ing", "日本", "\xa0", "\u2003", "½", "😀", "ٱ"]
    texts = ["".join(rng.choice(parts, rng.integers(0, 50))) for _ in range(400)]
    return texts + ["a" * 5000, "ab" * 3000 + " x", " " * 4000 + "x", "\n" * 3000 + "y", "1!" * 2500, "é" * 2500, "x " + "=" * 4000 + "'s" + "b" * 3000 + " " * 1500]


def test_bpe_streams_in_any_chunks():
    t, e = Tokenizer.from_file(BYTES), bpe.Transducer.at(BYTES)
    texts = bpe_texts()
    expected = [x.ids for x in t.encode_batch(texts, add_special_tokens=False)]
    for chunk in (1, 3, 17, 1000):
        k = 1 if chunk > 3 else 5
        assert [np.frombuffer(x, np.uint32).tolist() for x in e.encode_many(texts[::k], chunk)] == expected[::k]
    assert [np.frombuffer(x, np.uint32).tolist() for x in e.encode_many(texts)] == expected


def test_bpe_ids_come_from_the_lookahead(documents, monkeypatch):
    """Every id of real texts leaves a step; texts of several chunks leave what ends within the lookahead to the next one."""
    t, e = Tokenizer.from_file(BYTES), bpe.Transducer.at(BYTES)
    texts = [d["text"] or "" for d in documents][:300]
    texts.append(" ".join(texts)[:60_000])
    made, held, step = [0], [], bpe.Transducer.step

    def counted(self, streams, chunks, last):
        out = step(self, streams, chunks, last)
        made[0] += sum(len(ids) for own in out for ids in own)
        held.extend(len(s.tail.encode()) + len(s.open) for s, end in zip(streams, last, strict=True) if not end)
        return out

    monkeypatch.setattr(bpe.Transducer, "step", counted)
    ids, at = e.encode_arrays(texts)
    expected = [x.ids for x in t.encode_batch(texts, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == expected
    assert made[0] == len(ids) and len(held) > 6
    assert e.m.lookahead == 320 and all(e.m.lookahead <= n <= e.m.lookahead + 64 for n in held)


@pytest.mark.parametrize("unit", ["the cat's 12 ", "ab", "=", " ", "é!"])
def test_bpe_state_is_bounded(unit):
    """100 MB in chunks, given by a generator: state stays below a window and a chunk."""
    e, s = bpe.Transducer.at(BYTES), bpe.Stream()
    size = 100_000_000 if unit == "the cat's 12 " else 2_000_000
    chunk, total = unit * (65_536 // len(unit)), 0
    for _ in range(size // len(chunk)):
        total += sum(map(len, e.step([s], [chunk], [False])[0]))
        assert len(s.tail.encode()) + len(s.open) <= e.window + e.hold
    assert total > 0 and len(e.known.pieces) <= bpe.KEPT


def test_decoder_in_any_runs():
    rng = np.random.default_rng(5)
    for _ in range(3000):
        data = b"".join(rng.choice([b"a", b"\xc3", b"\xa9", b"\xe2\x82", b"\xac", b"\xf0\x9f", b"\x98\x80", b"\xed\xa0", b"\xff", b"\xf4\x90", b"\xe0\x80", b"\xc0"], rng.integers(0, 12)).tolist())
        d, out, at = bpe.Decoder(), [], 0
        while at < len(data):
            n = int(rng.integers(1, 4))
            out.append(d.feed(data[at : at + n]))
            assert len(d.held) <= 3
            at += n
        assert "".join([*out, d.feed(b"", True)]) == data.decode("utf-8", "replace")


def test_bpe_edges(spark, odd, none):
    back = bpe.decode(bpe.encode(odd, BYTES), BYTES).collect()
    assert sorted(r.decoded for r in back) == sorted([t or "" for t in ODD] + [TEXT])
    assert bpe.decode(bpe.encode(none, BYTES), BYTES).count() == 0
    both = bpe.encode(odd, BYTES, decoded=True).collect()
    assert sorted((r.ids, r.decoded) for r in both) == sorted((r.ids, r.decoded) for r in back)
    loose = spark.createDataFrame([(1, [164]), (2, None), (3, [])], "doc_id long, ids array<int>")
    assert [r.decoded for r in bpe.decode(loose, BYTES).orderBy("doc_id").collect()] == [bytes(bpe.Vocabulary.at(BYTES).bytes_of[164]).decode("utf-8", "replace"), "", ""]


# 4


def brute_near(docs):
    sets = {d: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set()) for d, t in docs if (w := words(t)) is not None}
    same = Counter(t or "" for _, t in docs if not words(t))
    links, root = Counter(), {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    owners = {}
    for d, s in sets.items():
        for g in s:
            owners.setdefault(g, []).append(d)
    shared = Counter((min(a, b), max(a, b)) for o in owners.values() for i, a in enumerate(o) for b in o[:i])
    empty = [(d, t or "") for d, t in docs if not sets[d]]
    near = [(a, b) for (a, b), n in shared.items() if n / (len(sets[a]) + len(sets[b]) - n) >= 0.8]
    near += [(a, b) for i, (a, x) in enumerate(empty) for b, y in empty[:i] if x == y]
    assert sum(n * (n - 1) // 2 for n in same.values()) <= len(near)
    for a, b in near:
        links[a] += 1
        links[b] += 1
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {d: (find(d), links[d]) for d in sets}


def test_near_duplicates_on_the_table(spark, documents):
    assert {r.doc_id: (r.class_id, r.n_links) for r in run(spark, "op4_ngram_jaccard_join")} == brute_near([(d["doc_id"], d["text"]) for d in documents])


def test_near_duplicates_in_large_groups(spark, monkeypatch):
    """Clusters of several blocks, chains, short texts and copies."""
    monkeypatch.setattr(jaccard, "BLOCK_DOCS", 7)
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in rng.integers(0, 10**6, 120)]
    docs = []
    for i in range(60):
        w = list(base)
        for p in rng.integers(0, 120, i % 5):
            w[p] = f"x{i}_{p}"
        docs.append(" ".join(w))
    docs += [docs[0]] * 5 + ["a b c"] * 2 + ["A, b: c!", "a b d", "", "", "...", "..."] + [" ".join(base[k:] + [f"t{j}" for j in range(k)]) for k in range(0, 60, 6)]
    rows = list(enumerate(docs))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: (r.class_id, r.n_links) for r in jaccard.near_duplicates(df).collect()} == brute_near(rows)


def test_pairs_just_at_the_threshold_are_found(spark):
    """600 planted pairs of similarity 0.8 to 0.83: all of them, and none of the 200 below 0.8."""
    rng = np.random.default_rng(17)
    grams = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    alike = lambda a, b: len(grams(a) & grams(b)) / len(grams(a) | grams(b))
    rows, linked = [], set()
    near = below = 0
    while near < 600 or below < 200:
        n = int(rng.integers(60, 200))
        one = [f"w{x}" for x in rng.integers(0, 10**9, n)]
        two = list(one)
        cut = int(n * rng.uniform(0.08, 0.14))
        two[-cut:] = [f"v{x}" for x in rng.integers(0, 10**9, cut)]
        s = alike(one, two)
        if 0.8 <= s <= 0.83 and near < 600:
            near += 1
            linked |= {len(rows), len(rows) + 1}
        elif 0.77 <= s < 0.8 and below < 200:
            below += 1
        else:
            continue
        rows += [(len(rows), " ".join(one)), (len(rows) + 1, " ".join(two))]
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).where("n_links > 0").collect()
    assert {r.doc_id for r in got} == linked and all(r.n_links == 1 and r.class_id == r.doc_id - r.doc_id % 2 for r in got)


@pytest.mark.parametrize("part", [2048, 16])
def test_clusters_held_together_by_chance_are_taken_apart(spark, monkeypatch, part):
    """400 texts with two fifths of their grams in common, 15 of them with a near copy: one connected cluster of candidates, whose sets are not all compared."""
    monkeypatch.setattr(jaccard, "BLOCK_DOCS", 8)
    monkeypatch.setattr(jaccard, "BUCKET_PART", part)
    written = {}

    def noted(df, name, plain=jaccard.materialise):
        written[name] = plain(df, name)
        return written[name]

    monkeypatch.setattr(jaccard, "materialise", noted)
    rng = np.random.default_rng(23)
    template = [f"w{i}" for i in range(104)]
    docs = [[*template, *(f"v{x}" for x in rng.integers(0, 10**9, 75))] for _ in range(400)]
    docs += [[*docs[i][:-3], "x", "y", f"z{i}"] for i in range(0, 150, 10)]
    rows = [(i, " ".join(w)) for i, w in enumerate(docs)]
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == brute_near(rows) and sum(r.n_links for r in got) == 30
    assert written["large"].count() == 1 and written["members"].count() > 300  # without sketches each set would be copied for some 40 blocks
    assert 30 <= written["verified"].count() < 100


def test_sketches_miss_hardly_a_pair():
    k = jaccard.least_equal(120, 0.8, 1e-5)
    rng = np.random.default_rng(3)
    assert (rng.binomial(120, 0.8, 1_000_000) < k).sum() <= 25 and (rng.binomial(120, 0.8, 1_000_000) < k + 3).sum() > 25
    assert jaccard.least_equal(120, 1.0, 1e-5) == 120 and jaccard.least_equal(8, 0.8, 0.0) == 0


def test_near_duplicate_edges(spark, odd, none):
    got = jaccard.near_duplicates(odd).collect()
    assert len(got) == len(ODD) + 1
    by = {r.doc_id: r for r in got}
    assert by[None].class_id is None and by[5].class_id == 4 and by[1].class_id == 0 and by[4].n_links == by[5].n_links == by[6].n_links == 3
    assert jaccard.near_duplicates(none).count() == 0
    kept = jaccard.one_of_each(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted({r.class_id for r in got if r.doc_id is not None})


def test_one_of_each_where_an_id_has_several_texts(spark):
    text = lambda k: " ".join(f"w{k}_{i}" for i in range(40))
    near = lambda k: text(k) + " more"
    rows = [(5, text(1)), (5, text(2)), (5, text(2)), (3, near(2)), (9, near(1)), (7, text(3)), (8, near(4)), (8, text(4)), (8, text(5)), (9, near(5)), (9, text(6)), (None, text(1)), (2, text(7)), (2, text(7)), (6, ""), (6, text(8))]
    kept = [tuple(r) for r in jaccard.one_of_each(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()]
    fours = [r for r in kept if r in ((8, near(4)), (8, text(4)))]
    assert len(fours) == 1
    want = [(5, text(1)), (3, near(2)), (7, text(3)), (8, text(5)), (9, text(6)), (None, text(1)), (2, text(7)), (6, ""), (6, text(8))]
    assert sorted(map(str, kept)) == sorted(map(str, want + fours))


def test_bands():
    b, r = jaccard.choose_bands(0.8, 0.9999)
    assert 1 - (1 - 0.8**r) ** b >= 0.9999 and b * r <= 128


def test_components(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, k) for k in range(1001, 1300)] + [(5, 5), (None, 3)]
    got = {r.node: r.component for r in jaccard.connected_components(spark.createDataFrame(edges, "u long, v long").repartition(6)).collect()}
    assert got == {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(300)}


# 5


def sample_pages(spark, extra=()):
    rows = [(i, f"http://h/{i}", f"<p>{i}</p>" * (i % 7)) for i in range(3000)]
    return spark.createDataFrame([*rows, *extra], "page_id long, url string, html string")


def test_audit(spark):
    odd = [(3, None, None), (None, "u", "h"), (None, "u", "h"), (None, None, None)]
    archive = warc.records(sample_pages(spark, odd))
    a = warc.leaves(archive)
    assert a.count() == 3003 and a.agg({"copies": "sum"}).first()[0] == 3004 and warc.audit(a, a).count() == 0
    name = lambda i: hashlib.md5(str(i).encode()).hexdigest()[:2]
    found = warc.audit(a, warc.leaves(warc.damaged(archive))).collect()
    assert {r.record_id for r in found if r.fault == "changed"} == {i for i in range(3000) if name(i) == "00"}
    assert {r.record_id for r in found if r.fault == "missing"} == {i for i in range(3000) if name(i) == "01"}
    assert all(r.fault in ("changed", "missing") or r.expected == r.found for r in found)
    one = archive.where("record_id is null").limit(1)
    fewer = warc.audit(a, warc.leaves(archive.where("record_id is not null").unionByName(one))).collect()
    assert len(fewer) == 2 and all(r.record_id is None for r in fewer)
    nothing = warc.leaves(archive.where("false"))
    assert warc.audit(nothing, nothing).count() == 0 and {r.fault for r in warc.audit(a, nothing).collect()} == {"missing"}
    assert {r.fault for r in warc.audit(nothing, a).collect()} == {"extra"}


def test_audit_in_the_middle_of_a_file(spark):
    """One of 50 records gone, added or changed: the others have only moved, and other files are not looked at."""
    rows = sample_pages(spark).where("page_id < 50 or page_id >= 2048 and page_id < 2060")
    archive = warc.records(rows)
    a = warc.leaves(archive)
    faults = lambda b: Counter(r.fault for r in warc.audit(a, warc.leaves(b)).collect())
    assert faults(archive.where("record_id <> 5")) == {"missing": 1, "moved": 44}
    assert faults(archive.where("record_id <> 49")) == {"missing": 1}
    more = warc.records(spark.createDataFrame([(5, "http://x", "new")], "page_id long, url string, html string"))
    assert faults(archive.unionByName(more)) in ({"extra": 1, "moved": 44}, {"extra": 1, "moved": 45})
    longer = F.when(F.col("page_id") == 7, "longer").otherwise(F.col("html"))
    changed = warc.audit(a, warc.leaves(warc.records(rows.withColumn("html", longer)))).collect()
    assert [(r.record_id, r.fault) for r in changed if r.fault != "moved"] == [(7, "changed")] and {r.file for r in changed} == {0}
    twice = warc.audit(a, warc.leaves(archive.unionByName(archive.where("record_id = 48")))).collect()
    assert sorted((r.record_id, r.fault) for r in twice) == [(48, "changed"), (49, "moved")]


def test_stored_archives(spark, tmp_path):
    """Files that are written, damaged on disk and read back: ranges are those of the stored bytes."""
    rows = warc.records(sample_pages(spark, [(7, "u", "bytes that look like one:\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n")]))
    whole, broken = str(tmp_path / "whole"), str(tmp_path / "broken")
    warc.write_archive(rows, whole, compress=False)
    warc.write_archive(rows, broken, compress=False)
    a = warc.leaves(warc.read_archive(spark, whole))
    laid_out = warc.leaves(rows)
    assert a.count() == laid_out.count() == 3001 and warc.audit(laid_out, a).count() == 0
    (path,) = (tmp_path / "broken" / "form=plain" / "file=1").glob("*.txt")
    data = bytearray(path.read_bytes())
    spans = [*warc.parse(bytes(data))]
    assert len(spans) == 1024 and all(bytes(data[s : s + n]).startswith(b"WARC/1.1") for s, n, _ in spans)
    (s, n, i), (t, m, j) = spans[10], spans[500]
    data[s + n - 6] ^= 1  # a byte of a body
    data[t] ^= 1  # a head
    path.write_bytes(data)
    (path.parent / f".{path.name}.crc").unlink()
    found = {r.record_id: r for r in warc.audit(a, warc.leaves(warc.read_archive(spark, broken))).collect()}
    assert set(found) == {i, j} and {r.fault for r in found.values()} == {"changed"} and found[i].start == s
    for cut in (1, 100, 5000, len(data) - 1):
        assert sum(k for _, k, _ in warc.parse(bytes(data[:cut]))) == cut


def binary_records(spark, n, file=0):
    """Records with bytes of any value in them, some empty."""
    rng = np.random.default_rng(abs(file))
    bodies = [rng.integers(0, 256, int(rng.integers(0, 300)), dtype=np.uint8).tobytes() if k % 5 else b"" for k in range(n)]
    head = "WARC/1.1\r\nWARC-Record-ID: <urn:page:%d>\r\nContent-Length: %d\r\n\r\n"
    return spark.createDataFrame([(k, file, bytearray((head % (k, len(b))).encode() + b + b"\r\n\r\n")) for k, b in enumerate(bodies)], "record_id long, file long, content binary")


def test_members_of_any_bytes(spark, tmp_path):
    """Binary payloads come back as they were, each from a gzip member of its own; any gzip reader reads the file."""
    import gzip

    rows = binary_records(spark, 200).unionByName(binary_records(spark, 30, -4))
    for compress in (True, False):
        path = str(tmp_path / str(compress))
        warc.write_archive(rows, path, compress)
        back = warc.read_archive(spark, path)
        assert sorted((r.file, r.record_id, bytes(r.content)) for r in back.collect()) == sorted((r.file, r.record_id, bytes(r.content)) for r in rows.collect())
        assert back.where("not sound").count() == 0 and warc.audit(warc.leaves(back), warc.leaves(back)).count() == 0
    (stored,) = (tmp_path / "True" / "form=gzip" / "file=0").glob("*.txt")
    with gzip.open(stored) as f:
        assert f.read() == b"".join(bytes(r.content) for r in rows.where("file = 0").orderBy("record_id", F.sha2("content", 256)).collect())


def test_a_thousand_bit_flips(spark, tmp_path):
    """Each of 1,000 seeded flips of one bit in a stored file is located, costs one record at most two, and raises nothing."""
    warc.write_archive(binary_records(spark, 60), str(tmp_path / "a"))
    (path,) = (tmp_path / "a" / "form=gzip" / "file=0").glob("*.txt")
    data = path.read_bytes()
    sound = [*warc._stored(data, "gzip")]
    place = {(a, n): data[a : a + n] for _, a, n, _, _ in sound}
    assert len(sound) == 60 and all(x[4] for x in sound) and sum(n for _, n in place) == len(data)
    rng = random.Random(6)
    for at in [*range(12), *(rng.randrange(len(data)) for _ in range(988))]:
        bad = bytearray(data)
        bad[at] ^= 1 << rng.randrange(8)
        found = [*warc._stored(bytes(bad), "gzip")]
        assert sum(n for _, _, n, _, _ in found) == len(data)
        changed = [(a, n) for _, a, n, _, _ in found if place.get((a, n)) != bytes(bad[a : a + n])]
        assert len(changed) == 1 and changed[0][0] <= at < sum(changed[0]) and len(found) >= 59, at
    for cut in range(0, len(data), 97):
        assert sum(n for _, _, n, _, _ in warc._stored(data[:cut], "gzip")) == cut


def test_audit_of_rotten_members(spark, tmp_path):
    """Two flips in a stored replica: the audit names the two records, and no other."""
    rows = binary_records(spark, 300).unionByName(binary_records(spark, 300, 1))
    for name in ("whole", "broken"):
        warc.write_archive(rows, str(tmp_path / name))
    (path,) = (tmp_path / "broken" / "form=gzip" / "file=1").glob("*.txt")
    data = bytearray(path.read_bytes())
    records = [*warc._stored(bytes(data), "gzip")]
    for k in (17, 200):
        data[records[k][1] + records[k][2] // 2] ^= 8
    path.write_bytes(data)
    (path.parent / f".{path.name}.crc").unlink()
    a, b = (warc.leaves(warc.read_archive(spark, str(tmp_path / name))) for name in ("whole", "broken"))
    found = warc.audit(a, b).collect()
    assert {(r.file, r.start) for r in found if r.expected} == {(1, records[17][1]), (1, records[200][1])}
    assert all(r.fault == "changed" for r in found) or {r.fault for r in found} <= {"changed", "missing", "extra"}


def test_files_longer_than_the_tree(spark):
    """Repeated ids make a file of 5,000 records: no node has more than FANOUT others below it."""
    rows = spark.range(5000).select(F.lit(1).cast("long").alias("record_id"), F.lit(0).cast("long").alias("file"), F.col("id").cast("string").cast("binary").alias("content"))
    a = warc.leaves(rows)
    levels = warc.tree(a, 5000)
    assert [x.count() for x in levels] == [5000, 313, 20, 2, 1]
    assert warc.audit(a, warc.leaves(rows.where("content <> cast('77' as binary)"))).where("fault = 'missing'").count() == 1


# 6, 7

EMAIL, IP = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD, PHONE = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ASSIGN = re.compile(r"""(?a:(?i:(password|passwd|secret|token|api_?key)))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_pii(t):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    ok = lambda d: 13 <= len(d) <= 19 and sum(int(c) if i % 2 == 0 else (2 * int(c) - 9 * (int(c) > 4)) for i, c in enumerate(reversed(d))) % 10 == 0
    out = [("email", *m.span()) for m in EMAIL.finditer(t)] + [("ip", *m.span()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m.group().split("."))]
    return out + [("card", *m.span()) for m in CARD.finditer(t) if ok(digits(m))] + [("phone", *m.span()) for m in PHONE.finditer(t) if 9 <= len(digits(m)) <= 15]


def base_secrets(t):
    out = [("assign", *m.span()) for m in ASSIGN.finditer(t) if len(m.group(2)) >= 6] + [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m.group()) >= 20]
    return sorted(out + [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", t) if len(m.group()) >= 24], key=lambda s: (s[1], secrets.KINDS.index(s[0])))


@pytest.mark.parametrize(("name", "base", "kinds"), [("op6_pii", base_pii, pii.KINDS), ("op7_secrets", base_secrets, secrets.KINDS)])
def test_base_spans(spark, documents, name, base, kinds):
    got = {r.doc_id: r for r in run(spark, name)}
    for d in documents:
        spans, r = base(d["text"] or ""), got[d["doc_id"]]
        assert [r[f"n_{k}"] for k in kinds] == [sum(s[0] == k for s in spans) for k in kinds]
        joined = [":".join(map(str, s)) for s in spans]
        assert r.base_sha256 == hashlib.sha256(",".join(joined).encode()).hexdigest() and set(joined) <= set(r.spans.split(",") if r.spans else [])


def test_base_spans_of_random_texts():
    rng = np.random.default_rng(6)
    parts = [*"19.+- ()@a_%=:'\"/", "token", "API_KEY", "255", "300", "AKIA", "ABCDEFGHIJ0123456789", "@x.com", "deadbeef0123456789abcdef01", "4111 1111 1111 1111", "+1 555 010 9999"]
    for _ in range(4000):
        t = "".join(rng.choice(parts, rng.integers(1, 25)))
        assert pii.plain(t) == base_pii(t) and secrets.plain(t) == base_secrets(t)


@pytest.mark.parametrize(
    ("text", "kind", "part"),
    [
        ("mail john (at) example [dot] com ok", "email", "john (at) example [dot] com"),
        ("write doe at mail dot example dot org now", "email", "doe at mail dot example dot org"),
        ("to jоhn@example.com", "email", "jоhn@example.com"),
        ("to jo​hn@exam​ple.com.", "email", "jo​hn@exam​ple.com"),
        ("call plus one five five five zero one two three four five six now", "phone", "plus one five five five zero one two three four five six"),
        ("card four" + " one" * 15 + ".", "card", "four" + " one" * 15),
        ("no ４１１１ １１１１ １１１１ １１１１", "card", "４１１１ １１１１ １１１１ １１１１"),
        ("at 192 dot 168 dot 0 dot 1!", "ip", "192 dot 168 dot 0 dot 1"),
        ("at one nine two dot one six eight dot zero dot one", "ip", "one nine two dot one six eight dot zero dot one"),
    ],
)
def test_disguised(text, kind, part):
    assert (kind, text.index(part), text.index(part) + len(part), False) in pii.spans(text)


@pytest.mark.parametrize("space", ["\n", "\t", "\u00a0", "\u2003", " \n"])
@pytest.mark.parametrize(
    ("part", "kind"),
    [
        ("jane at example dot com", "email"),
        ("jane@example dot com", "email"),
        ("jane at mail.example punto org", "email"),
        ("jane (at) example [dot] com", "email"),
        ("jane ( at ) exa\u043cple { dot } com", "email"),
        ("192 dot 168 dot 0 dot 1", "ip"),
        ("one nine two dot one six eight dot zero dot one", "ip"),
        ("plus 49 151 1234 5678", "phone"),
        ("plus one five five five zero one two three four five six", "phone"),
        ("four" + " one" * 15, "card"),
        ("4111 1111 uno uno uno uno 1111", "card"),
    ],
)
def test_disguised_with_other_spaces(part, kind, space):
    for before, after in (("to ", ", please"), ("(", ")"), ("", "")):
        text = before + part.replace(" ", space) + after
        assert (kind, len(before), len(text) - len(after), False) in pii.spans(text)
        assert pii._masked(text) == f"{before}[{kind.upper()}]{after}"
    text = "some words " + part + " some more"
    assert (kind, 11, len(text) - 10, False) in pii.spans(text)


def test_lower_case_lookalikes():
    for c, n in (("\u043a", "k"), ("\u043c", "m"), ("\u0442", "t"), ("\u0432", "b"), ("\u043d", "h")):
        text = f"to jane@xx{c}xx.com"
        assert pii.spans(text)[-1] == ("email", 3, len(text), False) and pii.LOOKALIKES[c] == n


@pytest.mark.parametrize(
    ("text", "kind", "part"),
    [
        ("card four, one, one, one, one, one, one, one, one, one, one, one, one, one, one, one now", "card", "four, one, one, one, one, one, one, one, one, one, one, one, one, one, one, one"),
        ("karte ٤١١١ ١١١١ ١١١١ ١١١١ ok", "card", "٤١١١ ١١١١ ١١١١ ١١١١"),
        ("ring +४४ २०१२३४५६७८९ now", "phone", "+४४ २०१२३४५६७८९"),
        ("to jane_at_example_dot_com please", "email", "jane_at_example_dot_com"),
        ("to jane&#64;example&#46;com please", "email", "jane&#64;example&#46;com"),
        ("to jane&commat;example&period;com please", "email", "jane&commat;example&period;com"),
        ("card 4lll 1111 llll 1111 now", None, None),
        ("card 4l11 1111 11l1 1111 now", "card", "4l11 1111 11l1 1111"),
        ("host I92.168.O.10 up", "ip", "I92.168.O.10"),
    ],
)
def test_more_disguises(text, kind, part):
    got = [(s[0], text[s[1] : s[2]]) for s in pii.spans(text)]
    assert got == ([(kind, part)] if kind else [])


def test_span_checks_are_linear():
    """A text of many identifiers, plain and disguised, and one of many secrets take seconds, and lose none."""
    text = " ".join(f"u{i}@example.com v{i} at example dot org" for i in range(20_000))
    found = pii.spans(text)
    assert sum(s[3] for s in found) == 20_000 and sum(not s[3] for s in found) == 20_000
    keys = " ".join(f"key{i} " + hashlib.sha256(str(i).encode()).hexdigest() for i in range(20_000))
    assert len(secrets.spans(keys)) == 20_000


def test_prefilter_passes_all_that_transducers_change():
    rng = np.random.default_rng(6)
    parts = ["jane", "example", "com", "at", "dot", "Punto", "plus", "uno", "oh", "five", "S\u0130ETE", "192", "1", "@", ".", "(", ")"]
    changed = 0
    for _ in range(10000):
        size = rng.integers(3, 12)
        text = "".join(map("".join, zip(rng.choice(parts, size), rng.choice([*" \n\t\u00a0,", "  ", ""], size), strict=True)))
        n = pii.Normalised(text)
        for step in (pii._look, pii._signs, pii._spoken, pii._spoken_dots, pii._digit_words):
            n.rewrite(step(n))
        changed += n.text != text
        assert n.text == text or pii._maybe(text), text
        assert len(n.text) == len(n.starts) == len(n.ends) and n.starts == sorted(n.starts)
    assert changed > 300


def test_plain_prose_has_no_spans():
    for text in ("look at example.com please", "he met one of the two at noon", TEXT, "Straße, über 3.5 m² – ok"):
        assert pii.spans(text) == [] and secrets.spans(text) == []


def test_random_tokens():
    key = "q7Xv2LmR9tZb4KsW8nYc3HdP6fGj1QaE5uVo"
    assert secrets.spans(f"use {key} here") == [("random", 4, 4 + len(key), False)]
    assert secrets.spans("see internationalization_of_everything and OzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzW and 12345678901234567890123") == []


@pytest.mark.parametrize("text", ["DB_PASS={}", "export STRIPE_KEY={}\n", "see https://x.org/?sig={}&x=1", "a=1&sig={}==&x=1", "A_RATHER_LONG_VARIABLE_NAME={}", "{}=value"])
def test_random_tokens_beside_an_equals_sign(text):
    key = "q7Xv2LmR9tZb4KsW8nYc3HdP6fGj1QaE5uVo"
    at = text.index("{")
    assert [s[:2] for s in secrets.spans(text.format(key))] == [("random", at)]
    assert secrets.spans(text.format(key))[0][2] == at + len(key) + 2 * ("{}==" in text)


NATURAL = """see_also_the_following_section /usr/local/lib/python3/site-packages getElementsByTagNameNS MAX_CONNECTIONS_PER_HOST_DEFAULT 2023-11-28-12-30-45-000
20231128T123045-000123Z AbstractSingletonProxyFactoryBean /2024/01/15/how-to-make-bread-at-home VeryLongClassNameForTestingPurposes22 isbn-978-3-16-148410-0-2nd-edition
donaudampfschifffahrtsgesellschaft-kapitaen2 /wp-content/uploads/2019/07/DSC00123-1024x768 X1-Carbon-ThinkPad-Gen9-20XW TRANSACTION_ID_0000000012345 DE89370400440532013000
ABCDEFGHIJKLMNOPQRSTUVWXYZ234567 przedsiebiorstwo-wielobranzowe-nr-12 pneumonoultramicroscopicsilicovolcanoconiosis1 /questions/11227809/why-is-it-faster""".split()


@pytest.mark.parametrize("encoding", secrets.ALPHABETS)
def test_random_keys_of_every_length(encoding):
    assert not secrets.random_tokens(" ".join(NATURAL)) and not any(map(secrets.random_tokens, NATURAL))
    rng = np.random.default_rng(7)
    for size in (20, 24, 32, 40, 64):
        for many in (0, 4, 19):
            found = 0
            for _ in range(60):
                text = " ".join([*rng.choice(NATURAL, many), "".join(rng.choice([*secrets.ALPHABETS[encoding]], size))])
                found += (len(text) - size, len(text)) in secrets.random_tokens(text)
            assert found >= 55, (size, many)


def test_false_discoveries_on_prose(documents):
    """Prose of four languages: words joined to long tokens by signs are no secrets."""
    rng = np.random.default_rng(11)
    by = {}
    for d in documents:
        by.setdefault(d["lang"], []).extend(w for w in re.findall(r"[a-zà-ÿ]+", (d["text"] or "").lower()) if w.isascii() and 2 < len(w) < 14)
    assert len(by) >= 4
    for lang, some in by.items():
        tokens, some = [], np.array(some)
        for _ in range(2000):
            parts = [*map(str, some[rng.integers(0, len(some), 4)]), str(rng.integers(0, 3000))]
            tokens.append([*"-_/"][int(rng.integers(3))].join(p.title() if rng.random() < 0.3 else p for p in parts))
        assert sum(bool(secrets.random_tokens(t)) for t in tokens) <= 4, lang


def test_span_edges(spark, odd, none):
    for find in (pii.find_pii, secrets.find_secrets):
        assert find(odd).count() == len(ODD) + 1 and find(none).count() == 0
    rows = spark.createDataFrame([(1, "a@b.com and a@b.com", 9), (2, None, 0)], "doc_id long, text string, spans int")
    assert [r.text for r in pii.redact(rows).orderBy("doc_id").collect()] == ["[EMAIL] and [EMAIL]", None]


def disguises(rng):
    """(kind of disguise, kind of identifier, text) without end, from seeded random identifiers."""
    letters, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    word = lambda a, b: "".join(rng.choices(letters, k=rng.randint(a, b)))
    blank = lambda least: "".join(rng.choices(" \t\n\u00a0", [8, 1, 1, 1], k=rng.randint(least, 6)))
    number = lambda n: [*map(int, rng.choices(digits, k=n))]
    names = {"en": "zero one two three four five six seven eight nine".split(), "de": "null eins zwei drei vier fünf sechs sieben acht neun".split(), "es": "cero uno dos tres cuatro cinco seis siete ocho nueve".split()}
    other = {c: k for k, c in pii.LOOKALIKES.items() if c.isalpha() and c.islower()}
    while True:
        user, host, top = word(3, 8) + rng.choice(["", str(rng.randint(0, 99))]), word(4, 9), rng.choice(["com", "org", "net", "de", "io"])
        q = rng.choice("-*_~|=")
        o, c = rng.choice(["()", "[]", "{}", "<>"])
        yield "at and dot words", "email", f"{user}{blank(1)}{rng.choice(['at', 'AT', 'At'])}{blank(1)}{host}{blank(1)}dot{blank(1)}{top}"
        yield "brackets", "email", f"{user}{blank(0)}{o}{blank(0)}at{blank(0)}{c}{blank(0)}{host}{blank(0)}{o}dot{c}{blank(0)}{top}"
        yield "marks", "email", f"{user}{q}at{q}{host}{q}dot{q}{top}"
        yield "marks and blanks", "email", f"{user} {q}at{q} {host} {q}dot{q} {top}"
        yield "spaced signs", "email", f"{user}{blank(1)}@{blank(1)}{host}{blank(1)}.{blank(1)}{top}"
        yield "escapes", "email", f"{user}{rng.choice(['%40', '&#64;', '&#x40;', '&commat;'])}{host}{rng.choice(['.', '%2E', '&#46;', '&period;'])}{top}"
        yield "other letters", "email", "".join(other.get(x, x) if rng.random() < 0.5 else x for x in f"{user}@{host}.{top}")
        yield "hidden characters", "email", "".join(x + rng.choice(["", "", "\u200b", "\u00ad"]) for x in f"{user}@{host}.{top}")
        yield "dotted user", "email", f"{word(3, 6)} dot {word(3, 6)} at {host} dot {top}"
        n, lang = number(rng.randint(10, 13)), rng.choice(list(names))
        yield "digits as words", "phone", f"plus{blank(1)}" + rng.choice([" ", ", ", "-", "  "]).join(names[lang][d] for d in n)
        yield "some digits as words", "phone", f"+{n[0]} ({' '.join(names[lang][d] for d in n[1:4])}) {''.join(map(str, n[4:7]))}-{''.join(map(str, n[7:]))}"
        yield "digits of other scripts", "phone", "+" + "".join(chr(rng.choice([0x660, 0x966, 0xFF10]) + d) for d in n)
        parts = [rng.randint(0, 255) for _ in range(4)]
        yield "dot words", "ip", f"{blank(1)}dot{blank(1)}".join(map(str, parts))
        yield "bracketed dots", "ip", f"{o}{rng.choice(['dot', '.'])}{c}".join(map(str, parts))
        card = number(15)
        card.append(next(d for d in range(10) if pii.luhn("".join(map(str, [*card, d])))))
        yield "words of a card", "card", " ".join(names[lang][d] for d in card)


def test_recall_by_kind_of_disguise():
    """300 seeded cases a kind in a sentence: 95 in 100 at least are found, over all of the identifier and little more."""
    rng, hit, seen = random.Random(66), Counter(), Counter()
    for name, kind, hidden in disguises(rng):
        text = f"Please write to: {hidden} ; thank you"
        a = text.index(hidden)
        hit[name] += any(k == kind and x <= a + 1 and y >= a + len(hidden) - 1 and x >= a - 2 and y <= a + len(hidden) + 2 for k, x, y, _ in pii.spans(text))
        seen[name] += 1
        if seen[name] == 300 and len(set(seen.values())) == 1:
            break
    assert not {k: hit[k] / n for k, n in seen.items() if hit[k] < 0.95 * n}, hit


def test_no_span_in_prose():
    """10,000 seeded sentences with at, dot, point, plus and digit words where prose has them."""
    rng = random.Random(67)
    who = "we they she he you people students nobody everyone".split()
    did = "looked arrived stayed laughed worked met waited stopped aimed smiled".split()
    where = "the station|school|this point in time|one point during the talk|the end|home|least two of them|a dot on the map|noon|every dot of ink|six or seven places|the plus sign|ten to eleven|first sight|that point|the dot above the letter|five, six, or maybe seven".split("|")
    rest = "and then one by one left.|while two plus two is four.|because at times nobody knows.|with three to five others.|before the dot com boom began.|as a matter of fact.|on page 12 - 14 of the book.|until 10:30.|, at which point it rained.|for one, two, three days.".split("|")
    for _ in range(10_000):
        text = f"{rng.choice(who)} {rng.choice(did)} at {rng.choice(where)} {rng.choice(rest)}".capitalize()
        assert pii.spans(text) == [], text


# 8


def check_pieces(docs, rows, size=2048):
    t, by, sequences = Tokenizer.from_file(WORDS), {}, {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    for doc_id, text in docs:
        ids, at = np.array([*t.encode(text or "", add_special_tokens=False).ids, 1], "<u4"), 0
        for r in sorted(by[doc_id], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids[at : at + r.length].tobytes()))
            at += r.length
        assert at == len(ids)
    sizes = []
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        sizes.append(at)
    assert max(sizes) <= size
    return sizes


def test_packing(spark, documents):
    sizes = check_pieces([(d["doc_id"], d["text"]) for d in documents], run(spark, "op8_packing"))
    assert sum(s != 2048 for s in sizes) <= 4


def test_packing_edges(spark, odd, none):
    rows = [(i, t) for i, t in enumerate(ODD)]
    check_pieces(rows, packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), WORDS).collect())
    assert packing.pack(none, WORDS).count() == 0 and packing.pack(odd, WORDS).count() > len(ODD)


def test_least_sum_of_squares():
    """Each placement is the best of all levels, by trying them."""
    rng, p = np.random.default_rng(7), packing.Packer(32, 0)
    for i in range(400):
        s, before = int(rng.integers(1, 32)), p.count.copy()
        p.add(i, b"\0" * 4 * s)
        costs = []
        for h in [0, *np.flatnonzero(before)]:
            if h + s <= 32:
                n = before.copy()
                n[h] -= h > 0
                if h + s < 32:
                    n[h + s] += 1
                costs.append(int((n**2).sum()))
        assert int((p.count**2).sum()) == min(costs)


def test_alike_documents_are_cut():
    """Where no two documents fit into a window, cuts keep the open windows few, and no id is lost."""
    for sizes in ([1500], [1200, 1500, 1800], [2047], [1]):
        rng, p = np.random.default_rng(7), packing.Packer(2048, 0)
        given = rng.choice(sizes, 3000)
        for i, s in enumerate(given.tolist()):
            p.add(i, b"\0" * 4 * s)
            assert p.count.max() <= packing.CUT + 1
        p.join_open()
        assert sum(r[2] for r in p.rows) == given.sum() and p.next_id == -(-given.sum() // 2048)


def test_word_tokens_equal_the_library():
    t, w = Tokenizer.from_file(WORDS), WordTokenizer.at(WORDS)
    texts = ["".join(chr(c) for c in range(a, a + 40)) for a in range(0, 0x3000, 40)] + [t or "" for t in ODD] + ["It's we'll I'M <|endoftext|> É́ Σας"]
    assert [np.frombuffer(x, np.uint32).tolist() for x in w.encode_many(texts)] == [x.ids for x in t.encode_batch(texts, add_special_tokens=False)]


def test_word_tokens_of_long_texts(monkeypatch):
    """Texts cut at white space before they become arrays have the same ids."""
    from fleetmetrics.llm import words as module

    w = WordTokenizer.at(WORDS)
    texts = ["It's  we'll\n\tI'M 12 É ß日本 x-y " * 40, "a" * 3000, "one two <|endoftext|> three " * 50, " " * 900]
    whole = [w.encode(t) for t in texts]
    monkeypatch.setattr(module, "LONG_TEXT", 100)
    assert [w.encode(t) for t in texts] == whole


def test_word_hashes_of_long_texts(monkeypatch):
    import pyarrow as pa

    from fleetmetrics.llm import shared

    texts = ["one, Two é日本 three  " * 60, "x" * 500, " " * 300, "ab " * 100]
    whole = [shared.word_hashes(pa.array([t])) for t in texts]
    monkeypatch.setattr(shared, "LONG_TEXT", 50)
    for t, w in zip(texts, whole, strict=True):
        assert all(np.array_equal(a, b) for a, b in zip(shared.word_hashes(pa.array([t])), w, strict=True))


# 9


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{sf}/labels.parquet").to_pylist()}
    rows = registered.queries()["op9_quality"](spark, sf).collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    seen = [r for r in rows if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in seen) / len(seen) > 0.9


def measured(text):
    """The statistics of a text, one by one."""
    data, w, lines = text.encode(), words(text), text.split("\n")
    pairs, b, n = list(zip(w, w[1:])), max(len(data), 1), max(len(w), 1)  # noqa: B905
    of = lambda chars: sum(c in chars for c in data)
    top = Counter(w).most_common(1)[0][1] if w else 0
    return [
        np.log1p(len(data)), np.log1p(len(w)), sum(len(x.encode()) for x in w) / n, of(range(65, 91)) / b, of(b"0123456789") / b, of(b".,;:!?'\"()-") / b,
        of(b"#$%&*+/<=>@\\^_`{|}~[]") / b, of(b" \t\r\n") / b, of(range(128, 256)) / b, len(set(w)) / n, top / n, sum(x == y for x, y in pairs) / n,
        len(set(pairs)) / n, len(set(lines)) / len(lines), len(w) / len(lines), of(b"!") / n, of(b"|") / n, of(b".?!") / n,
    ]


def test_statistics_one_by_one(spark, documents):
    texts = [d["text"] for d in documents[:120]] + [t or "" for t in ODD] + ["a a a\n\na", "!!!", "é É"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in quality.statistics(df, ["doc_id"]).collect()}
    for i, text in enumerate(texts):
        assert np.allclose(got[i], measured(text), atol=1e-8), (i, text[:50])


def test_compiled_rules(spark, documents):
    """Scores of the Spark expression against the rules, evaluated one by one."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rules = quality.fit(docs, labels)
    got = {r.doc_id: r for r in quality.score(docs, rules).collect()}
    assert rules.rules
    for d in documents[:200]:
        x = dict(zip(quality.STATISTICS, np.round(measured(d["text"] or ""), 9), strict=True))
        z = rules.intercept + sum(w for rule, w in rules.rules if all((x[n] <= at) == upper for n, upper, at in rule))
        r = got[d["doc_id"]]
        assert abs(r.score - 1 / (1 + np.exp(-z))) < 1e-6 and r.predicted == (r.score >= 0.7)
        assert r.held_out == (zlib.crc32(str(d["doc_id"]).encode()) % 4 == 2)


def test_quality_edges(spark, odd, none):
    labels = spark.createDataFrame([(4, 1), (5, 1), (2, None)], "doc_id long, quality int")
    rules = quality.fit(odd, labels)
    assert rules.rules == [] and quality.score(odd, rules).count() == len(ODD) + 1
    assert quality.score(none, rules).count() == 0
    kept = quality.keep_good(odd, rules)
    assert kept.columns == odd.columns and kept.count() == len(ODD) + 1
    assert quality.score(odd, quality.fit(none, labels)).first().score == 0.5


# 10


def brute_backoff(split, order):
    """(words, score, levels backed off) of each document, word by word."""
    grams = lambda x, k: list(zip(*[x[i:] for i in range(k)]))  # noqa: E731, B905
    counts = [Counter(g for x in split.values() for g in grams(x, k)) for k in range(1, order + 1)]
    total, kinds, out = sum(counts[0].values()), len(counts[0]), {}
    for d, x in split.items():
        own, score, lost = [Counter(grams(x, k)) for k in range(1, order + 1)], 0.0, 0
        other = lambda g: counts[len(g) - 1][g] - own[len(g) - 1][g]  # noqa: B023, E731
        for i in range(len(x)):
            p = (other((x[i],)) + 1) / (total + kinds)
            for k in range(2, min(order, i + 1) + 1):
                g = tuple(x[i - k + 1 : i + 1])
                p, lost = (other(g) / other(g[:-1]), lost) if other(g) else (0.4 * p, lost + 1)
            score += np.log(p)
        out[d] = (len(x), score, lost)
    return out


def same_scores(rows, expected):
    assert sorted(r.doc_id for r in rows) == sorted(expected)
    for r in rows:
        n, score, lost = expected[r.doc_id]
        assert (r.n_words, r.n_backed_off) == (n, lost) and abs(r.log_score - score) <= 2e-6 + 1e-12 * abs(score)


def test_backoff(spark, documents):
    same_scores(run(spark, "op10_backoff"), brute_backoff({d["doc_id"]: words(d["text"]) for d in documents}, 2))


@pytest.mark.parametrize("entries", [0, 1, 20, 1000])
def test_backoff_with_small_tables(spark, documents, monkeypatch, entries):
    """Words and bigrams that the broadcast tables lack are counted as exactly."""
    monkeypatch.setattr(backoff, "WORDS", entries)
    monkeypatch.setattr(backoff, "BIGRAMS", entries)
    few = documents[:150] + [{"doc_id": 10_000 + i, "text": t} for i, t in enumerate(["a b a b a b " * 50, "a b", "zz yy zz", "zz yy", "q q q", "q"])]
    df = spark.createDataFrame([(d["doc_id"], d["text"]) for d in few], "doc_id long, text string").repartition(3)
    same_scores(backoff.backoff_scores(df).collect(), brute_backoff({d["doc_id"]: words(d["text"]) for d in few}, 2))


def test_largest_counts_are_cut_in_a_bounded_number_of_rows(spark):
    """None that is left out is commoner than the limit; only leading bits of counts are told apart."""
    rng = np.random.default_rng(9)
    n = [*range(1, 3000), *map(int, rng.integers(3000, 10**12, 2000)), *[7] * 4000]
    grams = spark.createDataFrame([(int(g), 1, c) for g, c in zip(rng.integers(-(1 << 63), 1 << 63, len(n)), n, strict=True)], "gram long, level int, n long")
    for most in (0, 1, 500, 4000, 6000, 20_000):
        table, limit = backoff._largest(grams, 1, most)
        inside = sorted(map(int, table.n))
        left = Counter(n) - Counter(inside)
        assert len(inside) <= most and len(inside) >= min(len(n), most) * 0.9 - 130 and max(left, default=0) <= limit, (most, len(inside), limit)
        assert not inside or max(left, default=0) <= inside[0] * (1 + 2 / (1 << backoff.LEADING - 1)), most


def test_phrases_of_long_documents_have_few_rows_a_slice(spark, monkeypatch):
    """A bigram that no slice has three times is not in the table; its rows are as many as slices, of as many as these have bigrams."""
    monkeypatch.setattr(backoff, "SLICE_BYTES", 2_000)
    rng = np.random.default_rng(31)
    texts = [" ".join([*(f"w{x}" for x in rng.integers(0, 200, 600)), "so", "it", "goes"]) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    seen = []

    def noted(rows, key, plain=backoff._others):
        seen.append(rows.groupBy(key).count().selectExpr("max(count) most", "sum(count) total").first() if key == "key" else None)
        return plain(rows, key)

    monkeypatch.setattr(backoff, "_others", noted)
    same_scores(backoff.backoff_scores(df).collect(), brute_backoff({i: words(t) for i, t in enumerate(texts)}, 2))
    assert seen[0].most <= 2 * 60 and seen[0].total > 100 * seen[0].most


def test_backoff_joins_counts_by_hash(spark, documents):
    df = spark.createDataFrame([(d["doc_id"], d["text"]) for d in documents[:50]], "doc_id long, text string")
    plan = backoff.backoff_scores(df)._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "Join" in plan and "cogroup" not in plan.lower()


def test_numbers_beyond_sixteen_bits(spark):
    low, high = backoff._packed(np.array([70_000, 1]), np.array([3, 1 << 31]), np.array([5, 0]))
    df = spark.createDataFrame([(int(a), int(b)) for a, b in zip(low, high, strict=True)], "own long, more long")
    assert [tuple(r) for r in df.select(*[backoff._times(i).alias(str(i)) for i in range(3)]).collect()] == [(70_000, 3, 5), (1, 1 << 31, 0)]


def test_backoff_edges(spark, odd, none):
    for order in (1, 2, 3):
        rows = backoff.backoff_scores(odd, order=order).collect()
        assert len(rows) == len(ODD) + 1 and {r.doc_id: r.mean_log_score for r in rows}[0] is None
        assert backoff.backoff_scores(none, order=order).count() == 0


def test_backoff_trigrams(spark, documents):
    same_scores(run(spark, "op10_backoff_trigrams"), brute_backoff({d["doc_id"]: words(d["text"]) for d in documents}, 3))


# The pipeline


def test_pipeline_stages(spark, documents):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = [(n, f) for n, f in corpus_pipeline.STAGES]
    for name, stage in kept[:-1]:
        before = docs
        docs = corpus_pipeline.materialise(stage(spark, docs, SF), name)
        assert docs.columns == before.columns
        if name == "near_duplicates":
            near = brute_near([(r.doc_id, r.text) for r in before.collect()])
            assert {r.doc_id for r in docs.collect()} == {c for c, _ in near.values()}
    assert all(not pii.spans(r.text) and r.n_chars == len(r.text) for r in docs.collect())
    pieces = kept[-1][1](spark, docs, SF)
    check_pieces([(r.doc_id, r.text) for r in docs.collect()], pieces.collect())


def test_pipeline_of_nothing(spark, none):
    docs = none
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


def test_clear(spark):
    from fleetmetrics.llm import shared

    kept = list(shared._written)
    shared._written.clear()
    df = shared.materialise(spark.range(3), "x")
    (path,) = shared._written
    assert df.count() == 3
    shared.clear(spark)
    assert not shared._written and not __import__("os").path.exists(path)
    shared._written.extend(kept)


def test_top_k_of_many_blocks(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [int(x) for x in rng.integers(-50, 50, 6)]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, vec array<long>")
    one, many = (sorted(map(tuple, topk.top_k(df, df.where("vec_id % 2 = 0"), 5, block).collect())) for block in (1000, 32))
    assert one == many and len(one) == 1000


def test_columns_with_clashing_names(spark):
    names = ["ids", "spans", "grams", "cluster", "block", "node", "key", "bands", "label", "id_", "text_", "score", "w", "clips"]
    df = spark.createDataFrame([(1, TEXT), (2, TEXT)], "doc_id long, text string").withColumns({n: F.lit(1) for n in names})
    assert bpe.encode(df, BYTES).count() == media.store_texts(df).count() == pii.find_pii(df).count() == backoff.backoff_scores(df).count() == 2
    assert jaccard.one_of_each(df).columns == df.columns and jaccard.one_of_each(df).count() == 1
    assert pii.redact(df).columns == df.columns
    rules = quality.fit(df, spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, quality int"))
    assert quality.keep_good(df, rules).columns == df.columns
