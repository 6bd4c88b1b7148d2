"""Registered queries of this package, with SQL where SQL can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stallmetrics.llm import (
    bpe, conversations, exact_topk, fixity, hard_negatives, hashing_index, hosts, jaccard_join, licenses, mixing, quality,
    secrets, token_counts)
from stallmetrics.llm.common import table, written

PIECES = "piece_bpe_32k.model"
WORDS = "word_bpe_49k.json"
#: Token shares aimed at; all other values have theirs from the measured shares (``mixing.aims_of``).
MIX = {"source": {"src0": 0.3}, "lang": {"en": 0.55, "de": 0.17, "fr": 0.17, "es": 0.11},
       "topic": {str(k): 0.02 for k in range(10)}}
MIX_COLUMNS = {"source": "source", "lang": "lang", "topic": "topic"}


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digests(table(spark, sf_dir, "documents"))


def archive(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Leaves of the pages as archive records, and of a replica in which some are altered in place or lost."""
    record = fixity.warc_record(F.col("url"), F.col("html"))
    file = F.floor(F.col("page_id") / fixity.FILE_RECORDS).cast("long")
    flipped = F.concat(F.substring(record, 1, 20), F.lit("X").cast("binary"), F.substring(record, 22, 1 << 30))
    altered = F.when(F.col("page_id") % 97 == 13, flipped).otherwise(record)
    first = fixity.records(pages, "page_id", file, record, altered)
    lost = first.filter((F.col("key") % 331 != 7) | F.col("key").isNull())
    return first, lost.withColumn("digest", F.col("altered"))


def op2_warc_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = archive(table(spark, sf_dir, "pages"))
    return fixity.audit(left, right).select("file", F.col("key").alias("page_id"), "offset", "finding")


OP2_SQL = """
SELECT CAST(page_id // 512 AS BIGINT) AS file, page_id, "offset",
       CASE WHEN page_id % 331 = 7 THEN 'missing' ELSE 'changed' END AS finding
FROM (SELECT page_id, CAST(coalesce(sum(n) OVER (PARTITION BY page_id // 512 ORDER BY page_id
                                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset"
      FROM (SELECT page_id, 74 + strlen(coalesce(url, '')) + strlen(CAST(strlen(coalesce(html, '')) AS VARCHAR))
                            + strlen(coalesce(html, '')) AS n FROM pages))
WHERE page_id % 331 = 7 OR page_id % 97 = 13
"""


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    outcomes = pages.select(hosts.host_of(F.col("url")).alias("host"), hosts.page_is_good(F.col("html")).alias("good"))
    return hosts.judge_urls(pages, outcomes)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.fit_rules(docs, table(spark, sf_dir, "labels")))


def op6_hashing_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hashing_index.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def topics_of(embeddings: DataFrame) -> DataFrame:
    """topic_id and topic: the least label of the vectors with an id."""
    return embeddings.groupBy(F.col("vec_id").alias("topic_id")).agg(F.min("label").cast("string").alias("topic"))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its cell's probability and whether it is drawn."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", "lang", mixing.word_tokens().alias("n_tokens"), mixing.draw().alias("drawn_at"))
    topics = topics_of(table(spark, sf_dir, "embeddings"))
    docs = written(docs.join(topics, docs["doc_id"] == topics["topic_id"], "left").drop("topic_id"), "mix")
    docs = mixing.with_chance(docs, mixing.cell_chances(docs, MIX, MIX_COLUMNS, "n_tokens"), MIX_COLUMNS)
    return docs.select("doc_id", "source", "lang", "topic", "n_tokens", F.round("__chance", 9).alias("probability"),
                       (F.col("drawn_at") < F.col("__chance")).alias("drawn"))


def op8_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op9_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(WORDS))


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link_texts(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with faults: rows dropped, emptied, cut, repeated or given the role user, by a hash of
    conv_id and turn. ``copies`` is how often a row is there."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(said("text"), ".!?", "")).otherwise(said("text"))
    return rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(said("role")).alias("role"), text.alias("text"),
                       F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_digests(damaged(table(spark, sf_dir, "conversations")), F.col("copies"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), vec_id % 50 == 0,
                               F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label))


def op13_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.top_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


OP10_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words),
sizes AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM sets),
tokens AS (SELECT doc_id, unnest(s) AS t FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM tokens a JOIN tokens b ON a.t = b.t AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
reach(a, b) AS (SELECT doc_id, doc_id FROM sizes UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT doc_id, n AS n_shingles, least_id AS component_id FROM sizes
JOIN (SELECT a, min(b) AS least_id FROM reach GROUP BY a) ON a = doc_id
"""

OP4_SQL = r"""
WITH named AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
         replace(regexp_replace(regexp_replace(coalesce(html, ''), '<(?:script|style)[^>]*>.*?</(?:script|style)>', ' ', 'gs'),
           '<[^>]*>', ' ', 'g'), '&amp;', '&') AS body FROM pages),
good AS (
  SELECT *, array_to_string(string_split(host, '.')[greatest(1, len(string_split(host, '.')) - 1):], '.') AS domain,
    string_split(host, '.')[-1] AS suffix, len(regexp_extract_all(body, '[^\s]+')) AS words,
    len(regexp_extract_all(body, '[*#$%!&|]{2,}|(?:^|\s)\|(?:\s|$)')) AS marked FROM named),
hosts AS (SELECT host, domain, suffix, count(CASE WHEN words > 0 THEN 1 END) AS n,
  count(CASE WHEN words > 0 AND 5 * marked < words THEN 1 END) AS k FROM good GROUP BY ALL),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY ALL),
suffixes AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM domains GROUP BY ALL),
t1 AS (SELECT *, (SELECT coalesce(sum(k) / sum(n), 0.5) FROM suffixes) AS m FROM suffixes),
w1 AS ({w1}), s1 AS (SELECT suffix, (k + w * m) / (n + w) AS mean FROM t1, w1),
t2 AS (SELECT d.*, mean AS m FROM domains d JOIN s1 USING (suffix)),
w2 AS ({w2}), s2 AS (SELECT domain, (k + w * m) / (n + w) AS mean FROM t2, w2),
t3 AS (SELECT h.*, mean AS m FROM hosts h JOIN s2 USING (domain)),
w3 AS ({w3}), s3 AS (SELECT host, (k + w * m) / (n + w) AS mean, n + w AS size FROM t3, w3),
bound AS (SELECT host, round(mean - 1.645 * sqrt(mean * (1 - mean) / (size + 1)), 6) AS lower FROM s3),
ruled AS (SELECT *, CASE
  WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
  WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
  WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
  WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM good)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
  WHEN lower >= 0.7 THEN 'allow' ELSE 'block' END AS verdict FROM ruled LEFT JOIN bound USING (host)
"""
_WEIGHT = """SELECT CASE WHEN nv - v > 0 AND s - v > 0
    THEN greatest(least(1 / least((s - v) / (nv - v), 0.5) - 1, 10000.0), 1.0) ELSE 10000.0 END AS w
  FROM (SELECT sum(n * (k / n - m) * (k / n - m)) AS s, sum(m * (1 - m)) AS v, sum(n * m * (1 - m)) AS nv FROM {t} WHERE n > 0)"""
for _k in "123":
    OP4_SQL = OP4_SQL.replace("{w" + _k + "}", _WEIGHT.replace("{t}", "t" + _k))

OP11_SQL = r"""
WITH RECURSIVE named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
hashed AS (SELECT *, xor(list_reduce(list_prepend(4294967295, list_transform(range(8 * length(k)),
    lambda i: (ascii(substr(k, CAST(i // 8 + 1 AS BIGINT), 1)) >> CAST(i % 8 AS INTEGER)) & 1)),
    lambda c, b: xor(c >> 1, CASE WHEN xor(c & 1, b) = 1 THEN 3988292384 ELSE 0 END)), 4294967295) % 20 AS kind FROM named),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM hashed),
placed AS (SELECT *, left(role, 1) AS r, row_number() OVER (PARTITION BY conv_id
             ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i FROM damaged),
faulty AS (
  SELECT *, lag(r) OVER (PARTITION BY conv_id ORDER BY i) AS before,
    CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'b'
         WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
         WHEN NOT regexp_matches(text, '[.!?][ 	-
]*$') THEN 't' ELSE 'k' END AS fault FROM placed),
-- 0 nothing, 1 s, 2 u, 3 su, 4 complete, 5 complete and u
reads(p, c, q) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 3), (2, 'a', 4), (3, 'a', 4), (4, 'u', 5), (5, 'a', 4)),
inserts(p, q, n) AS (VALUES (0, 0, 0), (1, 1, 0), (2, 2, 0), (3, 3, 0), (4, 4, 0), (5, 5, 0), (0, 2, 1), (0, 4, 2), (0, 5, 3),
  (1, 3, 1), (1, 4, 2), (1, 5, 3), (2, 4, 1), (2, 5, 2), (3, 4, 1), (3, 5, 2), (4, 5, 1), (5, 4, 1)),
steps AS (
  SELECT j.p, e.q, e.c AS initial, 5 * n AS cost, repeat('I', n) || 'K' AS audit FROM inserts j JOIN reads e ON e.p = j.q
  UNION ALL SELECT j.p, e.q, NULL, 5 * n + 1, repeat('I', n) || 'R' FROM inserts j JOIN reads e ON e.p = j.q AND e.c <> 's'
  UNION ALL SELECT p, p, 'D', 2, 'D' FROM inserts WHERE n = 0),
tops(conv_id, i, p, v) AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT), 0, {'cost': 0, 'audit': ''} FROM conversations
  UNION ALL
  SELECT t.conv_id, f.i, s.q, min({'cost': t.v.cost + s.cost + CASE WHEN fault = 't' AND s.audit <> 'D' THEN 5 ELSE 0 END,
                                   'audit': t.v.audit || s.audit})
  FROM tops t JOIN faulty f ON f.conv_id = t.conv_id AND f.i = t.i + 1
  JOIN steps s ON s.p = t.p AND (s.initial IS NULL OR s.initial = 'D' OR s.initial = f.r)
  WHERE s.audit = 'D' OR fault IN ('k', 't') GROUP BY t.conv_id, f.i, s.q),
sizes AS (
  SELECT c.conv_id, coalesce(max(i), 0) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(CASE WHEN fault = 'b' THEN 1 END) AS blank, count(CASE WHEN fault = 'd' THEN 1 END) AS duplicate,
    count(CASE WHEN fault = 't' THEN 1 END) AS truncated,
    count(CASE WHEN before IS NOT NULL AND before || r NOT IN ('su', 'ua', 'au') THEN 1 END) AS illegal
  FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN faulty f ON f.conv_id = c.conv_id GROUP BY c.conv_id),
best AS (
  SELECT z.conv_id, min({'cost': t.v.cost + 5 * n_.n, 'audit': t.v.audit || repeat('I', n_.n)}) AS v
  FROM sizes z JOIN tops t ON t.conv_id = z.conv_id AND t.i = z.n JOIN inserts n_ ON n_.p = t.p AND n_.q IN (0, 4) GROUP BY z.conv_id),
edits AS (SELECT conv_id, j, v.audit[j] AS e, length(replace(v.audit[1:j], 'I', '')) AS i, length(replace(v.audit[1:j], 'D', '')) AS place
          FROM (SELECT conv_id, v, unnest(range(1, length(v.audit) + 1)) AS j FROM best)),
lines AS (
  SELECT e.conv_id, e.place, CASE WHEN e = 'I' THEN '' ELSE f.text END AS text, f.role, e.e,
         max(CASE WHEN place = 1 AND e = 'K' AND f.r = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY e.conv_id) AS system
  FROM edits e LEFT JOIN faulty f ON f.conv_id = e.conv_id AND f.i = e.i WHERE e <> 'D'),
repaired AS (
  SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN (place - system) % 2 = 1 THEN 'user' ELSE 'assistant' END
                             || ':' || text, chr(10) ORDER BY place) AS whole FROM lines GROUP BY conv_id)
SELECT conv_id, CAST(gaps AS BIGINT) AS gaps, blank, duplicate, truncated, illegal, CAST(v.cost AS BIGINT) AS cost,
       v.audit AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM sizes JOIN best USING (conv_id) LEFT JOIN repaired USING (conv_id)
"""

_WHOLE = "list_transform(embedding, lambda x: floor({n} * CAST(x AS DOUBLE)))"
_SOUND = """vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""

OP12_SQL = f"""
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, {_WHOLE.format(n=256)} AS v
  FROM embeddings WHERE label IS NOT NULL AND {_SOUND}),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER)
         AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 3
"""

OP13_SQL = f"""
WITH rows AS (SELECT vec_id, {_WHOLE.format(n=1024)} AS v FROM embeddings WHERE {_SOUND}),
scores AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
           FROM rows a JOIN rows b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

QUERIES = {f.__name__: f for f in (
    op1_secret_scans, op2_warc_merkle, op3_token_counts, op4_url_filters, op5_quality_rules, op6_hashing_neighbours,
    op7_source_mixing, op8_license_scans, op9_trie_bpe, op10_ngram_jaccard_join, op11_conversation_repair,
    op12_hard_negatives, op13_exact_topk)}
ORACLES = {"op2_warc_merkle": OP2_SQL, "op4_url_filters": OP4_SQL, "op10_ngram_jaccard_join": OP10_SQL,
           "op11_conversation_repair": OP11_SQL, "op12_hard_negatives": OP12_SQL, "op13_exact_topk": OP13_SQL}
