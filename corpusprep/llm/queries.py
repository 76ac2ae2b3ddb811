"""One query for each operator, over its whole table, with production parameters; SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.llm import (bpe_transducer, conversation_repair, ego_join, lemp_negatives, line_runs, mil_quality, ordinal_toxicity,
                            pii_scan, rans_tokens, simhash_gray, source_mix, syncmers, warc_sharded)
from corpusprep.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_gray.simhash_components(table(spark, sf_dir, "documents"))


@query
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri, manifest = warc_sharded.write_archives(table(spark, sf_dir, "pages"))
    return warc_sharded.read_archives(uri, manifest, payloads=False) \
        .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op2_warc"] = """
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
                  sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100
      GROUP BY payload_digest HAVING count(*) > 1)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN f.first IS NULL OR f.first IS NOT DISTINCT FROM p.page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN f.first IS DISTINCT FROM p.page_id THEN f.first END AS refers_to
FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest
"""


@query
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.mix(table(spark, sf_dir, "documents"))


ORACLE["op3_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, md5('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT source, source_size, 3 * source_size AS cap,
             CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
      FROM s),
l AS (SELECT *, CAST(sum(source_size) OVER () AS BIGINT) - CAST(coalesce(sum(cap) OVER before, 0) AS BIGINT) AS rest_words,
             CAST(sum(weight) OVER () AS BIGINT) - CAST(coalesce(sum(weight) OVER before, 0) AS BIGINT) AS rest_weight
      FROM w WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, cap * rest_weight <= rest_words * weight AS capped FROM l),
f AS (SELECT rest_words AS w0, rest_weight AS g0 FROM c WHERE NOT capped ORDER BY cap / weight, source NULLS LAST LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN capped THEN CAST(cap AS DOUBLE)
             ELSE CAST(weight * w0 AS DOUBLE) / CAST(g0 AS DOUBLE) END AS target
      FROM c LEFT JOIN f ON true),
p AS (SELECT *, CAST(floor(target) AS BIGINT) AS budget FROM t),
r AS (SELECT source, source_size, target,
             CASE WHEN source_size = 0 THEN 0 ELSE budget // source_size END AS passes,
             CASE WHEN source_size = 0 THEN budget ELSE budget % source_size END AS rest FROM p),
b AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY k, doc_id, size
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS upto FROM d)
SELECT b.doc_id, b.size, r.source_size, r.target,
       CAST(r.passes * b.size + greatest(0, least(b.size, r.rest - b.upto)) AS BIGINT) AS taken
FROM b JOIN r ON b.source IS NOT DISTINCT FROM r.source
"""


@query
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_scan.find_pii(table(spark, sf_dir, "documents"))


@query
def op5_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.edited_likeness(table(spark, sf_dir, "documents"))


#: Fixed value: the id that ends each document in op6.
END_ID = 1


@query
def op6_rans(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri, manifest = rans_tokens.write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), END_ID)
    return rans_tokens.read_tokens(uri, manifest)


@query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mil_quality.score_quality(docs, mil_quality.train(docs, table(spark, sf_dir, "labels")))


@query
def op8_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ego_join.near_vectors(table(spark, sf_dir, "embeddings"))


ORACLE["op8_embeddings"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * x)) AS q
  FROM embeddings),
ok AS (SELECT vec_id, e FROM v WHERE q > 0 AND NOT isinf(q) AND NOT isnan(q)
       AND len(list_filter(e, lambda x: x IS NULL)) = 0),
links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
          WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
n AS (SELECT x, count(*) AS n FROM links GROUP BY x),
c AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT e.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, least(e.vec_id, coalesce(c.y, e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce(c.y, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN n ON n.x = e.vec_id LEFT JOIN c ON c.x = e.vec_id
"""


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordinal_toxicity.grade_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_transducer.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return conversation_repair.repair_report(conversation_repair.damage(conversations), conversations)


#: crc32 bit by bit: each byte is followed by eight shifts (-1).
_CRC = """(xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(
  string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
  lambda ch: [CAST(ascii(ch) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END), 4294967295))"""

ORACLE["op11_conversations"] = rf"""
WITH RECURSIVE x AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_CRC} % 20 AS fault FROM conversations),
y AS (SELECT conv_id, turn, CASE fault WHEN 4 THEN 'user' ELSE role END AS role,
             CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
             unnest(range(CASE fault WHEN 3 THEN 2 ELSE 1 END)) AS copy
      FROM x WHERE fault <> 0),
w AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM y),
z AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen,
             rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS core FROM w),
r AS (SELECT conv_id, turn, role, text, i, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
             CASE WHEN core = '' THEN 'blank' WHEN seen THEN 'duplicate'
                  WHEN right(core, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM z),
-- paths to each state: cost, audit and repaired turns; an insertion relaxes 0, 1, 3 to 2, then 2 to 3
dp AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i,
         [{{'c': CAST(0 AS BIGINT), 'a': '', 't': CAST([] AS VARCHAR[])}},
          NULL,
          {{'c': 3, 'a': 'I', 't': ['user:']}},
          {{'c': 6, 'a': 'II', 't': ['user:', 'assistant:']}}] AS f
  FROM (SELECT DISTINCT conv_id FROM r)
  UNION ALL
  SELECT conv_id, i, [g[1], g[2], m, list_min(list_filter([g[4], CASE WHEN m IS NULL THEN NULL ELSE
           {{'c': m.c + 3, 'a': m.a || 'I', 't': list_append(m.t, 'assistant:')}} END], lambda v: v IS NOT NULL))] AS f
  FROM (SELECT conv_id, i, g, list_min(list_filter(list_concat([g[3]], list_transform([g[1], g[2], g[4]], lambda v:
             CASE WHEN v IS NULL THEN NULL ELSE {{'c': v.c + 3, 'a': v.a || 'I', 't': list_append(v.t, 'user:')}} END)),
             lambda v: v IS NOT NULL)) AS m
        FROM (SELECT dp.conv_id, r.i, list_transform([0, 1, 2, 3], lambda q: list_min(list_filter(list_concat(
                 [CASE WHEN dp.f[q + 1] IS NULL THEN NULL ELSE
                   {{'c': dp.f[q + 1].c + 4, 'a': dp.f[q + 1].a || 'D', 't': dp.f[q + 1].t}} END],
                 list_transform([0, 1, 2, 3], lambda o: CASE WHEN dp.f[o + 1] IS NULL OR r.fault IN ('blank', 'duplicate')
                     OR NOT list_contains(['s01', 'u02', 'u12', 'a23', 'u32'], r.initial || o || q) THEN NULL ELSE
                   {{'c': dp.f[o + 1].c + CASE r.fault WHEN 'truncated' THEN 3 ELSE 0 END, 'a': dp.f[o + 1].a || 'K',
                     't': list_append(dp.f[o + 1].t, r.role || ':' || r.text)}} END),
                 list_transform([0, 1, 2, 3], lambda o: CASE WHEN dp.f[o + 1] IS NULL OR r.fault IN ('blank', 'duplicate')
                     OR NOT list_contains(['02', '12', '23', '32'], o || '' || q) THEN NULL ELSE
                   {{'c': dp.f[o + 1].c + CASE r.fault WHEN 'truncated' THEN 6 ELSE 3 END, 'a': dp.f[o + 1].a || 'R',
                     't': list_append(dp.f[o + 1].t, CASE o WHEN 2 THEN 'assistant:' ELSE 'user:' END || r.text)}} END)),
                 lambda v: v IS NOT NULL))) AS g
              FROM dp JOIN r ON r.conv_id IS NOT DISTINCT FROM dp.conv_id AND r.i = dp.i + 1) AS s) AS t),
last AS (SELECT conv_id, list_min(list_filter([f[1], f[4]], lambda v: v IS NOT NULL)) AS b FROM dp
         QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
n AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
             count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
             count(*) FILTER (WHERE fault = 'truncated') AS truncated,
             count(*) FILTER (WHERE i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
      FROM r GROUP BY conv_id)
SELECT c.conv_id, CAST(coalesce(n.gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(n.blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(n.duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(n.truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(n.illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(last.b.c, 0) AS BIGINT) AS cost,
       coalesce(last.b.a, '') AS audit, sha256(coalesce(array_to_string(last.b.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN last ON last.conv_id IS NOT DISTINCT FROM c.conv_id
"""


@query
def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_runs.drop_frequent_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLE["op12_line_dedup"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM d),
k AS (SELECT r, i, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10),
g AS (SELECT k.r, count(*) AS n_lines, count(f.key) AS n_dropped,
             coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE f.key IS NULL), '') AS kept
      FROM k LEFT JOIN f ON k.key = f.key GROUP BY k.r)
SELECT d.doc_id, CAST(g.n_lines AS BIGINT) AS n_lines, CAST(g.n_dropped AS BIGINT) AS n_dropped, sha256(g.kept) AS kept_sha256
FROM d JOIN g ON d.r = g.r
"""


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lemp_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


ORACLE["op13_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
a AS (SELECT * FROM v WHERE vec_id % 100 = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
             CAST(list_sum(list_transform(list_zip(a.e, b.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
n AS (SELECT p.*, s.other_id AS negative_id, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS rank
      FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
        AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""
