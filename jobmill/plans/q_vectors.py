"""Queries over the embedding queue and vector search."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.similarity import cosine_similarity, grade
from ..operators import embedding as em
from ..operators import quantized
from ..operators import rescore as rescoring
from ..operators import vectors as vec
from . import oracle as o
from . import workload as w
from .q_tables import _JOBS
from .registry import query

#: dimensions of the test table's vectors
DIM = 64

_INPUT = f"trim({o.squash('title')} || ' ' || substr({o.squash('description')}, 1, 500))"


@query("e1_embedding_input", f"WITH {o.TEXTS} SELECT id, {_INPUT} AS input FROM texts")
def embedding_input(spark, d):
    rows = w.text_postings(spark, d)
    return rows.select("id", em.embedding_input(F.col("title"), F.col("description")).alias("input"))


def _waiting(spark, d):
    """Classified postings; every fourth one already has a vector."""
    rows = w.classified_postings(spark, d).filter("experience_level IS NOT NULL")
    done = F.when(F.col("ingest_seq") % 4 == 0, F.array(F.lit(1.0)).cast("array<float>"))
    blank = F.col("ingest_seq") % 9 == 1
    return rows.select(
        F.col("source_id").alias("id"),
        F.when(blank, " ").otherwise(F.col("title")).alias("title"),
        F.when(blank, "").otherwise(F.col("description")).alias("description"),
        "location",
        "experience_level",
        (F.col("ingest_seq") % 10 != 0).alias("is_active"),
        done.alias("embedding"),
    )


_QUEUE = f"""{o.CLASSIFIED}, waiting AS (SELECT source_id AS id, CASE WHEN ingest_seq % 9 = 1 THEN '' ELSE {_INPUT} END AS input,
  CASE WHEN ingest_seq % 10 <> 0 AND {o.us_like('location')} AND experience_level = 'new_grad' THEN 1
       WHEN ingest_seq % 10 <> 0 AND {o.us_like('location')} AND experience_level = 'entry_level' THEN 2 ELSE 3 END AS priority
  FROM classified WHERE experience_level IS NOT NULL AND ingest_seq % 4 <> 0),
queue AS (SELECT *, row_number() OVER (ORDER BY priority, id) AS rank FROM waiting)"""


@query("e2_embedding_queue", f"WITH {_QUEUE} SELECT id, input, CAST(priority AS INTEGER) AS priority, rank FROM queue")
def embedding_queue(spark, d):
    return em.embedding_queue(_waiting(spark, d)).select("id", "input", "priority", "rank")


@query(
    "e3_embedding_batches",
    f"""WITH {_QUEUE}, b AS (SELECT *, (rank - 1) // 100 + 1 AS batch_no FROM queue WHERE input <> '')
    SELECT id, CAST(batch_no AS BIGINT) AS batch_no, CAST(row_number() OVER (PARTITION BY batch_no ORDER BY rank) - 1 AS INTEGER) AS position FROM b""",
)
def embedding_batches(spark, d):
    return em.embedding_batches(em.embedding_queue(_waiting(spark, d))).select("id", "batch_no", "position")


@query(
    "e4_embedding_budget",
    f"""WITH {_QUEUE} SELECT count(*) AS waiting, count(*) * 300 AS tokens, round(count(*) * 300 / 1000000.0 * 0.02, 6) AS usd,
    count(*) * 300 <= 30000000 AS allowed FROM queue""",
)
def embedding_budget(spark, d):
    return em.embedding_budget(_waiting(spark, d)).withColumn("usd", F.round("usd", 6))


@query(
    "e5_attach_embeddings",
    f"""WITH {_QUEUE}, b AS (SELECT id, (rank - 1) // 100 + 1 AS batch_no FROM queue WHERE input <> ''),
    last AS (SELECT max(batch_no) AS m FROM b)
    SELECT id, CAST(8 AS BIGINT) AS dim FROM b, last WHERE batch_no % 5 <> 2 AND batch_no % 7 <> 3""",
)
def attach_embeddings(spark, d):
    """Vectors of some batches come back broken: one missing, or one too short."""
    batches = em.embedding_batches(em.embedding_queue(_waiting(spark, d)))
    returned = em.embed(batches, em.hashing_embedder(8))
    first = F.col("position") == 0
    broken = returned.filter(~(first & (F.col("batch_no") % 5 == 2))).withColumn(
        "embedding",
        F.when(first & (F.col("batch_no") % 7 == 3), F.slice("embedding", 1, 7)).otherwise(F.col("embedding")),
    )
    out = em.attach_embeddings(batches, broken, 8)
    return out.select("id", F.size("embedding").cast("bigint").alias("dim"))


@query(
    "e6_embed",
    f"""WITH {_QUEUE}, b AS (SELECT *, (rank - 1) // 100 + 1 AS batch_no FROM queue WHERE input <> ''),
    p AS (SELECT batch_no, row_number() OVER (PARTITION BY batch_no ORDER BY rank) - 1 AS position, list_transform(list_filter(
      string_split_regex(lower(input), '\\s+'), lambda x: x <> ''), lambda x: md5(x)) AS codes FROM b),
    v AS (SELECT batch_no, position, list_transform(range(16), lambda i: coalesce(list_sum(list_transform(codes, lambda c:
      CASE WHEN ('0x' || substr(c, 1, 4))::INT % 16 = i THEN 1 - 2 * (('0x' || substr(c, 5, 1))::INT % 2) ELSE 0 END)), 0)) AS sums FROM p),
    n AS (SELECT *, sqrt(list_sum(list_transform(sums, lambda x: x * x))::DOUBLE) AS length FROM v)
    SELECT CAST(batch_no AS BIGINT) AS batch_no, CAST(position AS INTEGER) AS position, array_to_string(list_transform(sums, lambda x:
      CAST(round(CASE WHEN length > 0 THEN x / length ELSE 0 END * 100) AS INTEGER)), ',') AS hundredths FROM n""",
)
def embed(spark, d):
    batches = em.embedding_batches(em.embedding_queue(_waiting(spark, d)))
    found = em.embed(batches, em.hashing_embedder(16))
    whole = F.transform("embedding", lambda v: F.round(v.cast("double") * 100).cast("int").cast("string"))
    return found.select("batch_no", "position", F.array_join(whole, ",").alias("hundredths"))


@query(
    "e7_cosine_similarity",
    """WITH c AS (SELECT label, list_transform(range(1, 65), lambda i: i) AS idx FROM embeddings GROUP BY label),
    m AS (SELECT label, CAST(min(vec_id) AS BIGINT) AS first_id FROM embeddings GROUP BY label)
    SELECT e.vec_id, round(list_cosine_similarity(e.embedding, f.embedding)::DOUBLE, 4) AS similarity
    FROM embeddings e JOIN m ON m.label = e.label JOIN embeddings f ON f.vec_id = m.first_id""",
)
def cosine(spark, d):
    """Each vector against the first one of its label."""
    rows = w.table(spark, d, "embeddings")
    first = rows.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("other"))
    return rows.join(first, "label").select(
        "vec_id", F.round(cosine_similarity(F.col("embedding"), F.col("other")), 4).alias("similarity")
    )


@query(
    "e8_grade",
    f"WITH {o.USERS} SELECT user_id, job_id, grade FROM graded",
)
def grades(spark, d):
    return w.scores(spark, d).select("user_id", "job_id", grade(F.col("similarity")).alias("grade"))


#: unit vectors as doubles, all pairs
_PAIRS = """unit AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
pairs AS (SELECT a.vec_id AS query_id, b.vec_id AS item_id, round(list_cosine_similarity(a.v, b.v), 9) AS similarity FROM unit a, unit b)"""


def _score_sql(least: str) -> str:
    return (
        f"WITH {_PAIRS} SELECT query_id AS user_id, item_id AS job_id, round(similarity, 6) AS similarity, CASE WHEN similarity > 0.85 THEN 'A' "
        "WHEN similarity > 0.75 THEN 'B' WHEN similarity > 0.65 THEN 'C' WHEN similarity > 0.55 THEN 'D' ELSE 'F' END AS grade FROM "
        "(SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, item_id) AS rank FROM pairs) "
        f"WHERE rank <= 200 AND similarity > {least}"
    )


def _score(spark, d, lowest):
    """Every vector as a profile against every vector as a job."""
    rows = w.table(spark, d, "embeddings")
    people = rows.select(F.col("vec_id").alias("id"), F.col("embedding").alias("resume_embedding"))
    jobs = rows.select(F.col("vec_id").alias("id"), "embedding")
    found = vec.score_matches(people, jobs, DIM, lowest_grade=lowest)
    return found.withColumn("similarity", F.round("similarity", 6))


@query("e9_score_matches", _score_sql("0.55"))
def score_matches(spark, d):
    return _score(spark, d, "D")


@query("e9_score_all_grades", f"SELECT user_id, job_id, grade FROM ({_score_sql('-2')})")
def score_all_grades(spark, d):
    return _score(spark, d, "F").select("user_id", "job_id", "grade")


@query(
    "e9_rescore",
    "SELECT vec_id AS id FROM embeddings WHERE label % 2 = 0",
)
def rescore(spark, d):
    """Profiles with an odd label kept their vector; the others changed it."""
    rows = w.table(spark, d, "embeddings")
    people = rows.select(F.col("vec_id").alias("id"), F.col("embedding").alias("resume_embedding"))
    old = F.when(F.col("label") % 2 == 0, F.reverse("embedding")).otherwise(F.col("embedding"))
    scored = rows.select(F.col("vec_id").alias("user_id"), vec.vector_hash(old).alias("resume_hash"))
    return vec.profiles_to_rescore(people, scored).select("id")


def _rescored(spark, d):
    """Scores of all vectors against all, reached in three steps: postings come and go, and
    in the last step every profile with an even label gets its present resume."""
    rows = w.table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label")
    old = F.when(F.col("label") % 2 == 0, F.reverse("embedding")).otherwise(F.col("embedding"))
    before, after = (rows.select("id", c.alias("resume_embedding")) for c in (old, F.col("embedding")))
    late, again = F.col("id") % 10 == 3, F.col("id") % 17 == 0
    first, second = rows.filter(~late), rows.filter(~again & (~late | (F.col("id") % 20 == 3)))
    scores = spark.createDataFrame([], "user_id bigint, job_id bigint, similarity double, grade string")
    resumes, nothing = spark.createDataFrame([], "user_id bigint, resume_hash bigint"), rows.limit(0)
    done = rescoring.rescore(before, first, scores, resumes, first, nothing, DIM)
    steps = [(before, first, second), (after, second, rows)]
    for people, have, jobs in steps:
        added, removed = jobs.join(have, "id", "left_anti"), have.join(jobs, "id", "left_anti")
        done = rescoring.rescore(people, jobs, done.scores, done.resumes, added, removed, DIM)
    return done


@query("e9_incremental_rescore", _score_sql("0.55"))
def incremental_rescore(spark, d):
    return _rescored(spark, d).scores.withColumn("similarity", F.round("similarity", 6))


@query(
    "e10_vector_topk",
    f"""WITH {_PAIRS} SELECT query_id, item_id, round(similarity, 6) AS similarity, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER
      (PARTITION BY query_id ORDER BY similarity DESC, item_id) AS rank FROM pairs WHERE query_id <> item_id) WHERE rank <= 10""",
)
def vector_topk(spark, d):
    rows = w.table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    return vec.vector_topk(rows, rows, 10, DIM, skip_self=True).withColumn("similarity", F.round("similarity", 6))


@query(
    "e10_best_match",
    f"""WITH {_JOBS}, {o.USERS}, r AS (SELECT g.user_id, g.job_id, g.grade, j.title, row_number() OVER (PARTITION BY g.user_id
      ORDER BY g.similarity DESC, j.posted_at DESC, g.job_id) AS rank FROM graded g JOIN jobs j ON j.id = g.job_id WHERE j.is_active AND j.is_usa)
    SELECT user_id, job_id, grade, title, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 10""",
)
def best_match(spark, d):
    found = vec.best_match(w.scores(spark, d), w.digest_jobs(spark, d))
    return found.select("user_id", "job_id", "grade", "title", "rank")


def _quality(spark, d):
    """All vectors as queries, by the defaults of the approximate search."""
    rows = w.table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    exact = vec.vector_topk(rows, rows, 10, DIM, skip_self=True)
    approx = vec.vector_topk_approx(rows, rows, 10, DIM, skip_self=True)
    return quantized.search_quality(exact, approx, rows.count(), 10)


@query(
    "e11_approx_recall",
    """SELECT count(*) * least(10, count(*) - 1) AS expected, true AS enough, 10 AS k,
      least(1.0::DOUBLE, 100::DOUBLE / count(*)) AS share_read, least(1.0::DOUBLE, 100::DOUBLE / count(*)) <= 0.25 AS little FROM embeddings""",
)
def approx_recall(spark, d):
    """At least nine tenths of the exact results are found; a query reads 100 vectors."""
    found = _quality(spark, d)
    return found.select(
        "expected", (F.col("recall") >= 0.9).alias("enough"), "k", "share_read", (F.col("share_read") <= 0.25).alias("little")
    )


@query("e11_recall_report")
def recall_report(spark, d):
    """The measured recall, with what it took."""
    return _quality(spark, d)
