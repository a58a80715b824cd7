"""Query and SQL of centroid clustering."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .clustering import inertia, lloyd
from .registry import register, table


def _round(i: int) -> str:
    """Nearest centroids of round ``i`` (``a``), and the centroids after it (``c``)."""
    return f"""
d{i} AS (SELECT x.r, c.k, sum((x.v - c.v) * (x.v - c.v))::BIGINT AS d
  FROM x JOIN c{i} c ON x.j = c.j GROUP BY x.r, c.k),
a{i} AS MATERIALIZED (SELECT r, k, d FROM d{i}
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, k) = 1),
m{i} AS (SELECT a.k, x.j, sum(x.v)::HUGEINT AS s, count(*) AS n
  FROM a{i} a JOIN x ON a.r = x.r GROUP BY a.k, x.j),
c{i + 1} AS MATERIALIZED (SELECT c.k, c.j,
  coalesce((s - ((s % n) + n) % n) // n, c.v)::BIGINT AS v
  FROM c{i} c LEFT JOIN m{i} m ON c.k = m.k AND c.j = m.j)"""


SQL = f"""
WITH e AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
    list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS c
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
x AS MATERIALIZED (SELECT r, unnest(range(64)) AS j, unnest(c) AS v FROM e),
s AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id::VARCHAR) NULLS LAST, c) - 1 AS k, c FROM e),
c0 AS MATERIALIZED (SELECT k, unnest(range(64)) AS j, unnest(c) AS v FROM s WHERE k < 16),
{_round(0)}, {_round(1)}, {_round(2)}, {_round(3)},
h AS (SELECT k, sha256(string_agg(v::VARCHAR, ',' ORDER BY j)) AS centroid_sha256 FROM c3 GROUP BY k),
i AS (SELECT k, sum(d)::BIGINT AS cluster_inertia FROM a3 GROUP BY k)
SELECT e.vec_id, a.k::INTEGER AS cluster, a.d AS distance, i.cluster_inertia,
  (SELECT sum(d)::BIGINT FROM a3) AS inertia, h.centroid_sha256
FROM a3 a JOIN e ON a.r = e.r JOIN h ON a.k = h.k JOIN i ON a.k = i.k
"""


@register("op12_centroid_clustering", SQL)
def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    found = lloyd(vectors, ["vec_id"], F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256))
    digest = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256)
    return inertia(found).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest.alias("centroid_sha256")
    )
