"""Query and SQL of benchmark decontamination."""

from pyspark.sql import DataFrame, SparkSession

from .decontaminate import contamination
from .registry import register, table

_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',"
    " 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)

SQL = f"""
WITH d AS (SELECT row_number() OVER () AS row_id, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
need AS (SELECT item_id, w, least(10, len(w)) AS k FROM b WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i + 1:i + k], ' ') AS t
  FROM (SELECT item_id, w, k, unnest(range(0, len(w) - k + 1)) AS i FROM need)),
runs AS (
  SELECT row_id, i, k, array_to_string(w[i + 1:i + k], ' ') AS t
  FROM (SELECT d.row_id, d.w, s.k, unnest(range(0, len(d.w) - s.k + 1)) AS i
        FROM d, (SELECT DISTINCT k FROM need) s WHERE len(d.w) >= s.k)),
hits AS (SELECT r.row_id, r.i, r.k, x.item_id FROM runs r JOIN windows x ON r.k = x.k AND r.t = x.t),
marks AS (
  SELECT row_id, count(DISTINCT p) AS n_hit
  FROM (SELECT DISTINCT row_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY row_id),
listed AS (
  SELECT row_id, count(*) AS n_items, string_agg(v, ',' ORDER BY v) AS ids
  FROM (SELECT DISTINCT row_id, CAST(item_id AS VARCHAR) AS v FROM hits) GROUP BY row_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(m.n_hit, 0) AS n_hit,
  coalesce(l.n_items, 0) AS n_items, sha256(coalesce(l.ids, '')) AS items_sha256,
  coalesce(m.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN marks m ON d.row_id = m.row_id LEFT JOIN listed l ON d.row_id = l.row_id
"""


@register("op2_decontaminate", SQL)
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return contamination(docs, items, ["doc_id"])
