"""Queries of the operators that choose rows by what they are near to."""

from __future__ import annotations

from pyspark.sql import functions as F

from .importance import resample
from .registry import query
from .vector_search import nearest_vectors


@query("op12_importance_resampling", r"""
WITH RECURSIVE entry(b, k, c) AS (
  SELECT b::BIGINT, 0, b::BIGINT FROM range(256) r(b)
  UNION ALL
  SELECT b, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM entry WHERE k < 8),
checksums AS (SELECT list(c ORDER BY b) AS of_byte FROM entry WHERE k = 8),
doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
target_words AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
counted AS (
  SELECT word, sum(s)::BIGINT AS s, sum(t)::BIGINT AS t FROM (
    SELECT unnest(words) AS word, 1 AS s, 0 AS t FROM doc_words
    UNION ALL SELECT unnest(words), 0, 1 FROM target_words) GROUP BY word),
hexed AS (SELECT word, s, t, hex(encode(word)) AS h FROM counted),
bytes AS (
  SELECT word, s, t, list_transform(range(length(h) // 2), lambda i:
         (strpos('0123456789ABCDEF', substr(h, 2 * i + 1, 1)) - 1) * 16
         + strpos('0123456789ABCDEF', substr(h, 2 * i + 2, 1)) - 1) AS own FROM hexed),
hashed AS (
  SELECT word, s, t, xor(list_reduce(list_prepend(4294967295::BIGINT, own::BIGINT[]),
         lambda c, b: xor(c >> 8, of_byte[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM bytes, checksums),
sums AS (SELECT bucket, sum(s) AS s, sum(t) AS t FROM hashed GROUP BY bucket),
whole AS (SELECT sum(s)::DOUBLE AS s_all, sum(t)::DOUBLE AS t_all FROM sums),
gain AS (
  SELECT bucket, floor(1000 * ln((t::DOUBLE + 1) * (s_all + 10000) / ((s::DOUBLE + 1) * (t_all + 10000))))::BIGINT AS gain
  FROM sums, whole),
of_word AS (SELECT word, gain FROM hashed JOIN gain USING (bucket)),
weights AS (
  SELECT doc_id, len(any_value(words))::BIGINT AS n_features,
         coalesce(floor(sum(gain)::DOUBLE / len(any_value(words)))::BIGINT, 0) AS weight
  FROM (SELECT doc_id, words, unnest(CASE WHEN len(words) > 0 THEN words ELSE [NULL] END) AS word FROM doc_words)
  LEFT JOIN of_word USING (word) GROUP BY doc_id),
drawn AS (
  SELECT *, (weight + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5)
                                           / 4294967296.0::DOUBLE))))::BIGINT AS score FROM weights),
placed AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place,
         (10 * count(*) OVER ()) // 100 AS wanted FROM drawn WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= wanted THEN place END AS rank
FROM drawn LEFT JOIN placed USING (doc_id)
""")
def op12_importance_resampling(spark, sf_dir):
    return resample(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                    spark.read.parquet(f"{sf_dir}/benchmark.parquet"),
                    most=1, buckets=10_000, percent=10, min_words=20, seed=2024)


@query("op13_nearest_vectors")
def op13_nearest_vectors(spark, sf_dir):
    return nearest_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)
