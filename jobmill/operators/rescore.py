"""Match scores kept up to date: only what can have changed is searched again.

Every profile has a list of its best ``k`` postings above the lowest grade. When postings
come and go,

* a profile whose resume changed, or that has no list, is searched over all postings;
* so is one whose full list lost a posting, since the next one is not stored;
* for all others the list's last similarity (or the lowest grade, if the list is not full)
  is the threshold that a new posting must reach: they are searched over the new postings
  only, and the threshold rules out cells before any pair is compared.

The result equals a full recomputation. A list that is not full holds all matches, so
losing some of them needs no search.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import GRADE_BOUNDS, grade
from ..session import durable
from .vectors import TOP_JOBS, _search, _usable, profiles_to_rescore, vector_hash


class Rescored(NamedTuple):
    """The new scores, the resume each list is for, and what was compared."""

    scores: DataFrame  # user_id, job_id, similarity, grade
    resumes: DataFrame  # user_id, resume_hash
    report: dict[str, int]


def _resumes(profiles: DataFrame) -> DataFrame:
    known = profiles.filter(F.col("resume_embedding").isNotNull())
    return known.select(F.col("id").alias("user_id"), vector_hash(F.col("resume_embedding")).alias("resume_hash"))


def rescore(
    profiles: DataFrame,
    jobs: DataFrame,
    scores: DataFrame,
    resumes: DataFrame,
    added: DataFrame,
    removed: DataFrame,
    dim: int,
    lowest_grade: str = "D",
    k: int = TOP_JOBS,
    pivots: int = 64,
) -> Rescored:
    """Scores after postings were added and removed and resumes changed.

    ``profiles(id, resume_embedding)`` and ``jobs(id, embedding)`` are as of now,
    ``scores`` and ``resumes`` as the last call returned them (empty ones at first).
    ``added(id)`` and ``removed(id)`` list postings since then; one with a new vector is in
    both. Rows of ``scores`` must not have been cut.
    """
    floor = -2.0 if lowest_grade == "F" else dict(GRADE_BOUNDS)[lowest_grade]
    people = durable(profiles.select("id", "resume_embedding").filter("resume_embedding IS NOT NULL"))
    changed = profiles_to_rescore(people, resumes).select(F.col("id").alias("user_id"))
    still = people.select(F.col("id").alias("user_id")).join(changed, "user_id", "left_anti")
    held = scores.select("user_id", "job_id", "similarity").join(still, "user_id", "left_semi")
    away = removed.select(F.col("id").alias("job_id")).distinct().withColumn("_gone", F.lit(True))
    marked = durable(held.join(away, "job_id", "left"))
    lists = marked.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.count("_gone").alias("lost"),
        F.min(F.when(F.col("_gone").isNull(), F.col("similarity"))).alias("last"),
    )
    lists = still.join(lists, "user_id", "left")
    short = (F.coalesce("n", F.lit(0)) >= k) & (F.col("lost") > 0)
    full = F.coalesce(F.col("n") >= k, F.lit(False))
    state = durable(lists.select(
        "user_id", F.coalesce(short, F.lit(False)).alias("anew"),
        F.when(full, F.col("last")).otherwise(F.lit(floor)).alias("least"),
    ))

    anew = state.filter("anew").select("user_id").unionByName(changed)
    anew = durable(people.join(anew.withColumnRenamed("user_id", "id"), "id", "left_semi"))
    rest = people.join(state.filter("NOT anew").select(F.col("user_id").alias("id"), "least"), "id")
    new_jobs = jobs.join(added.select("id").distinct(), "id", "left_semi")
    whole, some = {"compared": 0}, {"compared": 0}
    queries = _usable(anew, "id", "resume_embedding", dim)
    options = {"k": k, "floor": floor, "pivots": pivots}
    found = _search(queries, _usable(jobs, "id", "embedding", dim), dim, **options, tally=whole)
    queries = _usable(rest, "id", "resume_embedding", dim, "least")
    more = _search(queries, _usable(new_jobs, "id", "embedding", dim), dim, **options, tally=some)
    kept = marked.filter("_gone IS NULL").join(state.filter("NOT anew").select("user_id"), "user_id", "left_semi")
    names = [F.col("query_id").alias("user_id"), F.col("item_id").alias("job_id"), "similarity"]
    candidates = kept.select("user_id", "job_id", "similarity")
    candidates = candidates.unionByName(found.select(*names)).unionByName(more.select(*names))
    order = Window.partitionBy("user_id").orderBy(F.col("similarity").desc(), "job_id")
    best = candidates.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= k)
    report = {
        "profiles": people.count(), "searched_anew": anew.count(),
        "compared_anew": whole["compared"], "compared_new": some["compared"],
    }
    return Rescored(durable(best.drop("_rank").withColumn("grade", grade(F.col("similarity")))), _resumes(people), report)
