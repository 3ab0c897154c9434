"""The queries of this subpackage: each applies one operator, with
production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm import (conversations, decontaminate, licenses, packing, pii, resample, sharding,
                         simhash, spelling, topk, toxicity, urlfilter, warc)
from rivulet.sources.tables import table


def vocabulary() -> tuple[str, str]:
    """Path and pre-tokenising pattern of the byte-level BPE vocabulary."""
    import public_tokenizers as P
    return P.path("byte_bpe_50k.tiktoken"), P.PATTERN


def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


URL_RULES = [urlfilter.rule(*r) for r in (
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
    ("allow", "com/fr/"), ("block", "com/de/"))]


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), 40).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), *vocabulary())


def op7_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "fingerprint", "component_id")


def op9_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    # a fifth of the labels is held out to measure by
    known = labels.where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    return resample.resample(table(spark, sf_dir, "documents"), known, keep=resample.good_share(labels))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(table(spark, sf_dir, "conversations"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_exact_top_k, op2_toxicity, op3_warc, op4_url_filter, op5_sharding, op6_best_fit_packing,
    op7_pii_pseudonyms, op8_simhash_near_dedup, op9_importance_resampling, op10_decontamination,
    op11_conversation_repair, op12_license_scan, op13_spelling_variants)}

_TEMPLATES = ", ".join(f"({n}, '{t.label}', {t.base}, {list(t.words)}, {t.must})"
                       for n, t in enumerate(licenses.TEMPLATES))

# What SQL can express, by plain search over all rows; the rest is held
# against brute force, exact round trips or held-out labels in tests/llm.
ORACLE_SQL: dict[str, str] = {
    "op1_exact_top_k": """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""",
    "op3_warc": """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS body, sha1(coalesce(html, '')) AS digest FROM pages),
m AS (
  SELECT digest, max(page_id) AS kept FROM p WHERE octet_length(body) >= 1000
  GROUP BY digest HAVING count(*) > 1)
SELECT page_id, octet_length(body)::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN kept IS NULL OR kept = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN kept <> page_id THEN kept END AS refers_to
FROM p LEFT JOIN m USING (digest)
""",
    "op10_decontamination": r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
d AS (SELECT row_number() OVER () AS r, * FROM w),
i AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
iw AS (
  SELECT DISTINCT item_id, n, array_to_string(ws[k:k + n - 1], ' ') AS win
  FROM (SELECT item_id, ws, least(13, len(ws)) AS n,
               unnest(generate_series(1, len(ws) - least(13, len(ws)) + 1)) AS k FROM i WHERE len(ws) > 0)),
dw AS (
  SELECT r, n, k, array_to_string(ws[k:k + n - 1], ' ') AS win
  FROM (SELECT r, ws, n, unnest(generate_series(1, len(ws) - n + 1)) AS k
        FROM d, (SELECT DISTINCT n FROM iw) WHERE len(ws) >= n)),
o AS (SELECT r, k, dw.n, item_id FROM dw JOIN iw ON dw.n = iw.n AND dw.win = iw.win),
h AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(generate_series(k, k + n - 1)) AS p FROM o) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM o) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN t USING (r)
""",
    "op11_conversation_repair": r"""
WITH RECURSIVE crc AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c
    FROM range(256) r(i))),
src AS (
  SELECT row_number() OVER () AS r, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))) AS hx
  FROM conversations),
kinds AS (
  SELECT src.*, xor(list_reduce(list_transform(range(len(hx) // 2),
           lambda k: ('0x' || hx[2 * k + 1:2 * k + 2])::BIGINT),
         lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295) % 20 AS kind
  FROM src, crc),
hurt AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM kinds WHERE kind <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(len(role) || ':' || role || text), copy) AS i FROM hurt),
rows AS (
  SELECT conv_id, turn, i, role, text, left(role, 1) AS init,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN '' ELSE 'truncated' END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair
  FROM placed),
moves(a, ins, b) AS (VALUES ('-', '', '-'), ('-', 'I', 'u'), ('-', 'II', 'a'), ('s', '', 's'), ('s', 'I', 'u'),
  ('s', 'II', 'a'), ('u', '', 'u'), ('u', 'I', 'a'), ('a', '', 'a'), ('a', 'I', 'u')),
keeps(b, init) AS (VALUES ('-', 's'), ('-', 'u'), ('s', 'u'), ('u', 'a'), ('a', 'u')),
steps AS (
  SELECT conv_id, i, a, 3 * len(ins) + 4 AS cost, ins || 'D' AS letters, b AS z FROM rows, moves
  UNION ALL
  SELECT conv_id, i, a, 3 * len(ins) + 3 + CASE fault WHEN 'truncated' THEN 3 ELSE 0 END, ins || 'R',
         CASE b WHEN 'u' THEN 'a' ELSE 'u' END FROM rows, moves WHERE fault IN ('', 'truncated')
  UNION ALL
  SELECT conv_id, i, a, 3 * len(ins) + CASE fault WHEN 'truncated' THEN 3 ELSE 0 END, ins || 'K', init
  FROM rows JOIN keeps USING (init) JOIN moves USING (b) WHERE fault IN ('', 'truncated')),
dp AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, '-' AS z, {'c': 0, 'a': ''} AS w FROM rows
  UNION ALL
  SELECT d.conv_id, s.i, s.z, min({'c': d.w.c + s.cost, 'a': d.w.a || s.letters})
  FROM dp d JOIN steps s ON s.conv_id IS NOT DISTINCT FROM d.conv_id AND s.i = d.i + 1 AND s.a = d.z
  GROUP BY d.conv_id, s.i, s.z),
done AS (
  SELECT conv_id, min({'c': w.c + CASE z WHEN 's' THEN 6 WHEN 'u' THEN 3 ELSE 0 END,
                       'a': w.a || CASE z WHEN 's' THEN 'II' WHEN 'u' THEN 'I' ELSE '' END}) AS w
  FROM dp JOIN (SELECT conv_id AS cid, max(i) AS last FROM rows GROUP BY 1) ON cid IS NOT DISTINCT FROM conv_id AND last = i
  GROUP BY conv_id),
letters AS (
  SELECT conv_id, k, letter, sum((letter <> 'I')::INT) OVER (PARTITION BY conv_id ORDER BY k) AS i,
         sum((letter <> 'D')::INT) OVER (PARTITION BY conv_id ORDER BY k) AS j
  FROM (SELECT conv_id, unnest(string_split(w.a, '')) AS letter, unnest(range(len(w.a))) AS k FROM done WHERE w.a <> '')),
kept AS (
  SELECT l.*, r.role, r.text,
         max((letter = 'K' AND j = 1 AND init = 's')::INT) OVER (PARTITION BY l.conv_id) AS sys
  FROM letters l LEFT JOIN rows r ON l.conv_id IS NOT DISTINCT FROM r.conv_id AND l.i = r.i AND letter <> 'I'
  WHERE letter <> 'D'),
shas AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN letter = 'K' THEN role WHEN (j - sys) % 2 = 1 THEN 'user'
           ELSE 'assistant' END || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY k)) AS sha
  FROM kept GROUP BY conv_id),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(w.c, 0)::BIGINT AS cost, coalesce(w.a, '') AS audit,
       coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN shas s ON s.conv_id IS NOT DISTINCT FROM o.conv_id
""",
    "op13_spelling_variants": r"""
WITH RECURSIVE crc AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c
    FROM range(256) r(i))),
runs AS (
  SELECT doc_id, run, count(*) AS c, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS hx
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
          'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{00C0}-\x{00FF}]+')) AS run FROM documents)
  WHERE len(run) >= 6 GROUP BY ALL),
hashed AS (
  SELECT run, c, xor(list_reduce(list_transform(range(len(hx) // 2),
           lambda k: ('0x' || hx[2 * k + 1:2 * k + 2])::BIGINT),
         lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295) AS h
  FROM runs, crc),
v AS (
  SELECT word, sum(c)::BIGINT AS n FROM (
    SELECT c, CASE WHEN h % 199 = 0 THEN left(run, (h % len(run))::INT) || substr(run, (h % len(run))::INT + 2) ELSE run END AS word
    FROM hashed)
  WHERE len(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
cut AS (
  SELECT word, n, k, left(word, k) || substr(word, k + 2) AS rest
  FROM (SELECT word, n, unnest(range(len(word)))::INT AS k FROM v)),
one AS (
  SELECT DISTINCT a.word AS x, b.word AS y FROM cut a JOIN cut b USING (k, rest) WHERE a.word <> b.word
  UNION
  SELECT cut.word, v.word FROM cut JOIN v ON rest = v.word
  UNION
  SELECT v.word, cut.word FROM cut JOIN v ON rest = v.word),
near AS (
  SELECT x, count(*) AS n_near, min({'less': -v.n, 'word': y}) AS best FROM one JOIN v ON v.word = y GROUP BY x),
formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.less >= 5 * n THEN best.word END AS form,
         CASE WHEN -best.less >= 5 * n THEN -best.less END AS form_n
  FROM v LEFT JOIN near ON x = word),
walk AS (
  SELECT word, word AS at FROM formed
  UNION ALL
  SELECT w.word, f.form FROM walk w JOIN formed f ON f.word = w.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, w.at AS root, f.n, f.n_near::BIGINT AS n_near, f.form_n::BIGINT AS form_n
FROM formed f JOIN walk w ON w.word = f.word JOIN formed e ON e.word = w.at WHERE e.form IS NULL
""",
    # every template at every place where its first mandatory word stands
    "op12_license_scan": r"""
WITH t(id, label, base, tw, must) AS (VALUES """ + _TEMPLATES + r"""),
d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents),
c AS (
  SELECT r, id, k - must[1] AS start
  FROM (SELECT r, unnest(ws) AS w, unnest(range(len(ws))) AS k FROM d) p JOIN t ON p.w = tw[must[1] + 1]),
m AS (
  SELECT c.r, start, label, base, must, len(tw) AS n, list_filter(range(len(tw)), lambda j:
         start + j >= 0 AND start + j < len(ws) AND ws[greatest(start + j, 0) + 1] = tw[j + 1]) AS hit
  FROM c JOIN d USING (r) JOIN t USING (id)),
f AS (
  SELECT r, start, label, base, len(hit) / n AS share FROM m
  WHERE list_has_all(hit, must) AND len(hit) / n >= 0.75),
g AS (
  SELECT r, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM f GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0)::DOUBLE AS score
FROM d LEFT JOIN g USING (r)
""",
}
