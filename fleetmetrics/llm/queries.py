"""Registered queries of the operators in this subpackage, and the SQL for those that SQL can express."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmetrics.llm import backoff, bpe, fim, jaccard, linededup, media, packing, periodic, pii, quality, secrets, topk, warc
from fleetmetrics.llm.shared import scratch_dir, table


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.integer_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return topk.top_k(vectors, vectors.where("vec_id % 100 = 0"), 10)


def op2_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = media.read_media(media.store_texts(table(spark, sf_dir, "documents")))
    return read.select(
        "doc_id",
        "n_bytes",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.expr("substring(payload, -32, 32)")).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        "feature",
        F.size("clips").alias("n_clips"),
        F.array_join(F.transform("clips", lambda c: F.concat_ws("-", c["start_s"].cast("string"), c["end_s"].cast("string"))), ",").alias("clip_seconds"),
    )


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), decoded=True)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op5_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audited replica is stored as compressed files, with its faults, and read back; the trusted side are the records as they should be."""
    archive = warc.records(table(spark, sf_dir, "pages"))
    replica = f"{scratch_dir(spark)}/replica-{uuid.uuid4().hex}"
    warc.write_archive(warc.damaged(archive), replica)
    return warc.audit(warc.leaves(archive), warc.leaves(warc.read_archive(spark, replica), as_stored=False))


def _digest(found: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in kinds], F.sha2(pii.joined(base), 256).alias("base_sha256"), pii.joined(F.col("spans")).alias("spans"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digest(pii.find_pii(table(spark, sf_dir, "documents")), pii.KINDS)


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digest(secrets.find_secrets(table(spark, sf_dir, "documents")), secrets.KINDS)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op10_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff.backoff_scores(table(spark, sf_dir, "documents"), stable=True)


def op10_backoff_trigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff.backoff_scores(table(spark, sf_dir, "documents"), order=3, stable=True)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    looped = docs.select("doc_id", periodic.looped(F.col("text"), F.crc32(F.col("doc_id").cast("string"))).alias("text"))
    found = periodic.find_runs(looped)
    # Runs are ordered by start, so of equal exponents the first stays; exponents are compared as fractions.
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda b, r: F.when(r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b))
    line = lambda r: F.concat(F.concat_ws(",", *[r[x].cast("string") for x in ("start", "length", "period")]), F.lit("\n"))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = fim.restored(fim.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text"))
    return coded.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = linededup.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}


def _backoff_sql(order: int) -> str:
    """Scores of order 2 or 3: each position's words, then the distinct grams of a document beside the counts of all."""
    words = ["w1", "w2", "w3"][:order]
    levels = ["w1", "w1, w2", "w1, w2, w3"][:order]
    counts = "".join(f"o{k} AS (SELECT nr, {g}, count(*) AS m FROM t WHERE w{k} IS NOT NULL GROUP BY nr, {g}), c{k} AS (SELECT {g}, sum(m) AS n FROM o{k} GROUP BY {g}), e{k} AS (SELECT o{k}.*, n, n - m AS c FROM o{k} JOIN c{k} USING ({g})), " for k, g in enumerate(levels, 1))
    one = "SELECT nr, m * ln((c + 1) / size) AS s, 0 AS seen FROM e1, z"
    two = """SELECT a.nr, a.m * (ln(a.c) - ln(h.c) - ln((g.c + 1) / size) - ln(0.4)), a.m FROM z, e2 a
      JOIN e1 h ON h.nr = a.nr AND h.w1 = a.w1 JOIN e1 g ON g.nr = a.nr AND g.w1 = a.w2 WHERE a.c > 0"""
    three = """SELECT a.nr, a.m * (ln(a.c) - ln(h.c) - (ln(g.c) - ln(x.c)) - ln(0.4)), a.m FROM e3 a
      JOIN e2 h ON h.nr = a.nr AND h.w1 = a.w1 AND h.w2 = a.w2 JOIN e2 g ON g.nr = a.nr AND g.w1 = a.w2 AND g.w2 = a.w3
      JOIN e1 x ON x.nr = a.nr AND x.w1 = a.w2 WHERE a.c > 0"""
    lost = " + ".join(f"greatest(n_words - {k}, 0)" for k in range(1, order))
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS nr, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9\x{{80}}-\x{{10FFFF}}]+') AS w FROM documents),
p AS (SELECT nr, generate_subscripts(w, 1) AS i, unnest(w) AS w1 FROM d),
t AS (SELECT nr, {", ".join(["w1", *(f"lead(w1, {k}) OVER (PARTITION BY nr ORDER BY i) AS w{k + 1}" for k in range(1, len(words)))])} FROM p),
{counts}z AS (SELECT greatest(1, coalesce(sum(n), 0) + count(*)) AS size FROM c1),
a AS (SELECT nr, sum(s) AS s, sum(seen) AS seen FROM ({" UNION ALL ".join([one, two, three][:order])}) GROUP BY nr),
f AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(s, 0) AS s, coalesce(seen, 0) AS seen FROM d LEFT JOIN a USING (nr))
SELECT doc_id, n_words, round(s + ({lost}) * ln(0.4), 6) AS log_score, CAST({lost} - seen AS BIGINT) AS n_backed_off,
  CASE WHEN n_words > 0 THEN round(s + ({lost}) * ln(0.4), 6) / n_words END AS mean_log_score FROM f"""


ORACLE = {
    "op10_backoff": _backoff_sql(2),
    "op10_backoff_trigrams": _backoff_sql(3),
    "op1_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT)) AS vec
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.vec, c.vec) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS "rank" FROM s)
SELECT query_id, "rank", vec_id, score FROM r WHERE "rank" <= 10""",
    "op4_ngram_jaccard_join": r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS nr, doc_id, coalesce(text, '') AS text, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9\x{80}-\x{10FFFF}]+') AS w FROM documents),
g AS (
  SELECT DISTINCT nr, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS gram FROM d),
n AS (SELECT nr, count(*) AS n FROM g GROUP BY nr),
shared AS (SELECT a.nr AS a, b.nr AS b, count(*) AS k FROM g a JOIN g b ON a.gram = b.gram AND a.nr <> b.nr GROUP BY a.nr, b.nr),
links AS (
  SELECT a, b FROM shared JOIN n x ON x.nr = a JOIN n y ON y.nr = b WHERE k >= 0.8 * (x.n + y.n - k) - 1e-6
  UNION ALL SELECT x.nr, y.nr FROM d x JOIN d y ON x.text = y.text AND x.nr <> y.nr WHERE len(x.w) = 0),
reach AS (SELECT nr, nr AS other FROM d UNION SELECT r.nr, l.b FROM reach r JOIN links l ON l.a = r.other),
class AS (SELECT reach.nr AS nr, min(d.doc_id) AS class_id FROM reach JOIN d ON d.nr = other GROUP BY reach.nr)
SELECT d.doc_id, class_id, coalesce(k, 0) AS n_links FROM d JOIN class USING (nr) LEFT JOIN (SELECT a AS nr, count(*) AS k FROM links GROUP BY a) USING (nr)""",
    "op5_warc_fixity": r"""
WITH c AS (
  SELECT page_id AS record_id, CAST(floor(page_id / 1024) AS BIGINT) AS file, md5(CAST(page_id AS VARCHAR)) AS code,
    'WARC/1.1' || e || 'WARC-Type: response' || e || 'WARC-Record-ID: <urn:page:' || page_id || '>' || e
    || 'WARC-Date: 1970-01-01T00:00:00Z' || e || 'WARC-Target-URI: ' || coalesce(url, '') || e || 'Content-Type: text/html' || e || 'Content-Length: '
    || strlen(coalesce(html, '')) || e || e || coalesce(html, '') || e || chr(13) AS most
  FROM pages, (SELECT chr(13) || chr(10) AS e) WHERE page_id IS NOT NULL),
a AS (
  SELECT record_id, file, code, strlen(most) + 1 AS size, sha256(most || chr(10)) AS expected,
    CASE WHEN code LIKE '00%' THEN sha256(most || ' ') ELSE sha256(most || chr(10)) END AS found FROM c),
l AS (
  SELECT *, row_number() OVER w - 1 AS number, coalesce(sum(size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM a WINDOW w AS (PARTITION BY file ORDER BY record_id)),
r AS (
  SELECT record_id, coalesce(sum(size) OVER (PARTITION BY file ORDER BY record_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM a WHERE code NOT LIKE '01%'),
f AS (
  SELECT l.*, CASE WHEN r.record_id IS NULL THEN 'missing' WHEN expected <> found THEN 'changed' WHEN l.start <> r.start THEN 'moved' END AS fault
  FROM l LEFT JOIN r ON l.record_id = r.record_id)
SELECT record_id, file, CAST(number AS BIGINT) AS number, CAST(start AS BIGINT) AS start, CAST(size AS BIGINT) AS length, CAST(1 AS BIGINT) AS copies,
  expected, CASE WHEN fault <> 'missing' THEN found END AS found, fault
FROM f WHERE fault IS NOT NULL""",
    "op12_fill_in_middle": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || doc_id) AS x FROM documents),
h AS (
  SELECT *, length(t) AS n, CAST('0x' || x[1:8] AS BIGINT) AS h1, CAST('0x' || x[9:16] AS BIGINT) AS h2, CAST('0x' || x[17:24] AS BIGINT) AS h3, CAST('0x' || x[25:32] AS BIGINT) AS h4 FROM d),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN n = 0 OR regexp_matches(t, '<[PSM]>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, '<P>' || substring(t, 1, a) AS pre, '<M>' || substring(t, a + 1, b - a) AS mid, '<S>' || substring(t, b + 1) AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN pre || suf || mid ELSE suf || pre || mid END) AS output_sha256, sha256(t) AS restored_sha256 FROM p""",
    "op13_line_dedup": r"""
WITH d AS (SELECT row_number() OVER () AS nr, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT nr, doc_id, generate_subscripts(ls, 1) AS i, unnest(ls) AS line FROM d),
k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
m AS (SELECT k.*, f.key IS NOT NULL AND k.doc_id <> f.first AS gone FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256 FROM m GROUP BY nr, doc_id""",
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
