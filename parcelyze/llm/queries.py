"""The registered queries: each operator on its whole driver table.

A query applies its operator with production parameters and derives the
contract's columns from the operator's result. ``ORACLE`` holds DuckDB SQL
where SQL can express the rows; the others are tested in ``tests/llm`` against
brute force, exact round trips or held-out accuracy.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from . import (alignment, collocations, files, fingerprints, language_id, minhash, mixing, packing, substrings,
               token_counts, token_file, topk, toxicity, warc)
from .common import table

QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


@query("op8_language_id")
def op8(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.fit(docs, train=language_id.train_fold())
    out = language_id.predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score", "rejected")


@query("op9_mixing", r"""
WITH d AS (SELECT doc_id, source,
                  CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
           FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             [3.0, 1.0, 2.0][CAST((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 AS INTEGER) + 1]
               ::DOUBLE AS w
      FROM d GROUP BY source),
r AS (SELECT *, source_size * 2.0::DOUBLE AS cap, sum(source_size) OVER () * 1.5::DOUBLE AS t,
             row_number() OVER (ORDER BY source_size * 2.0::DOUBLE / w, encode(source) NULLS LAST) AS i FROM s),
lv AS (SELECT min_by((a.t - coalesce((SELECT sum(b.cap) FROM r b WHERE b.i < a.i), 0))
                     / (SELECT sum(b.w) FROM r b WHERE b.i >= a.i), a.i) AS level
       FROM r a WHERE a.cap / a.w > (a.t - coalesce((SELECT sum(b.cap) FROM r b WHERE b.i < a.i), 0))
                                    / (SELECT sum(b.w) FROM r b WHERE b.i >= a.i)),
g AS (SELECT source, source_size,
             CAST(CASE WHEN level IS NULL THEN cap ELSE least(cap, level * w) END AS DOUBLE) AS target
      FROM r, lv),
j AS (SELECT d.doc_id, d.size, g.source_size, g.target,
             CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0 END AS rate
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN CAST('0x' || substr(md5('0:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12)
                                                AS BIGINT)::DOUBLE / 281474976710656.0::DOUBLE < rate - floor(rate)
                                       THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM j""")
def op9(spark, sf_dir):
    p = mixing.plan(table(spark, sf_dir, "documents"))
    return p.select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                    (F.col("size") * F.col("copies")).cast("long").alias("taken"))


@query("op5_token_binary")
def op5(spark, sf_dir):
    folder = files.new_folder(spark, "token-files")
    token_file.write(table(spark, sf_dir, "documents"), folder)
    return token_file.read(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op6_packing")
def op6(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op1_minhash_near_dedup", r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS t
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(t) = 1 THEN t[1] ELSE t[i] || ' ' || t[i + 1] END AS g
  FROM (SELECT doc_id, t, unnest(range(1, greatest(len(t), 2))) AS i FROM w WHERE len(t) > 0)),
n AS (SELECT doc_id, count(*) AS c FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY ALL),
e AS (
  SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
  WHERE 100 * p.c >= 80 * (nx.c + ny.c - p.c)),
r AS (SELECT doc_id, doc_id AS seen FROM w UNION SELECT r.doc_id, e.y FROM r JOIN e ON e.x = r.seen),
k AS (SELECT doc_id, min(seen) AS component_id FROM r GROUP BY doc_id)
SELECT k.doc_id, CAST(coalesce(n.c, 0) AS BIGINT) AS n_shingles, component_id,
       k.doc_id = component_id AS kept
FROM k LEFT JOIN n ON n.doc_id = k.doc_id""")
def op1(spark, sf_dir):
    out = minhash.near_duplicates(table(spark, sf_dir, "documents"), words=2)
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(True))       # a NULL id is linked with nothing
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", kept.alias("kept"))


@query("op2_toxicity")
def op2(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), train=toxicity.train_fold())
    return toxicity.predict(docs, model).select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


@query("op3_exact_topk", r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(list_sum(list_transform(
           list_zip(q.v, d.v), lambda z: coalesce(z[1], 0) * coalesce(z[2], 0))) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id % 100 = 0 AND q.vec_id <> d.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 10""")
def op3(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op4_token_counts")
def op4(spark, sf_dir):
    out = token_counts.count_tokens(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_pretokens", "n_tokens")


@query("op10_warc", r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest FROM p),
g AS (SELECT payload_digest, max(page_id) AS m FROM d WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT d.*, CASE WHEN page_id < m THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < m THEN m END AS refers_to
FROM d LEFT JOIN g ON d.payload_digest = g.payload_digest AND d.payload_bytes >= 1000""")
def op10(spark, sf_dir):
    folder = files.new_folder(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), folder)
    return warc.read(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op7_fingerprints")
def op7(spark, sf_dir):
    out = fingerprints.compare(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                      "near_edited", "near_next")


@query("op11_substring_dedup", r"""
WITH w AS (
  SELECT doc_id, t, unnest(range(1, len(t) + 1)) AS i
  FROM (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS t FROM documents)),
x AS (
  SELECT doc_id, i, t[i] AS word, len(t) AS n FROM w),
s AS (
  SELECT doc_id, i, word, n,
         string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) AS win
  FROM x),
r AS (
  SELECT doc_id, i, word,
         i + 19 <= n AND row_number() OVER (PARTITION BY win, i + 19 <= n ORDER BY doc_id, i) > 1 AS again
  FROM s),
c AS (
  SELECT doc_id, i, word,
         bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone
  FROM r),
k AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed,
         string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept
  FROM c GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN k ON k.doc_id = d.doc_id""")
def op11(spark, sf_dir):
    out = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_removed",
                      F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query("op12_collocations", r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                  'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS s FROM d),
w AS (SELECT lang, regexp_extract_all(s, '[^\x20\x09]+') AS ws FROM p),
g AS (
  SELECT lang, 1 AS size, unnest(ws) AS x, '' AS y, '' AS z FROM w
  UNION ALL SELECT lang, 2, ws[i], ws[i + 1], '' FROM (SELECT lang, ws, unnest(range(1, len(ws))) AS i FROM w)
  UNION ALL SELECT lang, 3, ws[i], ws[i + 1], ws[i + 2] FROM (SELECT lang, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
f AS (SELECT lang, size, x, y, z, count(*) AS a FROM g GROUP BY ALL),
t AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE size > 1 AND a >= 10),
cut AS (
  SELECT c.lang, c.size, c.x, c.y, c.z, c.a, 1 AS k, l.a AS l, r.a AS r
  FROM c JOIN f l ON l.lang = c.lang AND l.size = 1 AND l.x = c.x
         JOIN f r ON r.lang = c.lang AND r.size = c.size - 1 AND r.x = c.y AND r.y = c.z AND r.z = ''
  UNION ALL
  SELECT c.lang, c.size, c.x, c.y, c.z, c.a, 2, l.a, r.a
  FROM c JOIN f l ON c.size = 3 AND l.lang = c.lang AND l.size = 2 AND l.x = c.x AND l.y = c.y
         JOIN f r ON r.lang = c.lang AND r.size = 1 AND r.x = c.z),
s AS (
  SELECT *, CAST((1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS BIGINT) AS score,
         row_number() OVER (PARTITION BY lang, size, x, y, z
                            ORDER BY (1000000::HUGEINT * a * a) // (l::HUGEINT * r), k) AS nth
  FROM cut),
longer AS (
  SELECT lang, x, y, max(a) AS b FROM (SELECT lang, x, y, a FROM c WHERE size = 3
                                       UNION ALL SELECT lang, y, z, a FROM c WHERE size = 3) GROUP BY lang, x, y),
o AS (
  SELECT s.lang, s.x || ' ' || s.y || CASE WHEN s.size = 3 THEN ' ' || s.z ELSE '' END AS phrase, s.a, s.l, s.r, s.score
  FROM s LEFT JOIN longer ON s.size = 2 AND longer.lang = s.lang AND longer.x = s.x AND longer.y = s.y
  WHERE nth = 1 AND NOT coalesce(100 * longer.b >= 50 * s.a, false)),
q AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM o)
SELECT q.lang, rank, phrase, a, l, r, n, score FROM q JOIN t ON t.lang = q.lang WHERE rank <= 2000""")
def op12(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query("op13_alignment")
def op13(spark, sf_dir):
    out = alignment.align(table(spark, sf_dir, "documents"))
    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    return out.select(F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                      digest.alias("groups_sha256"))
