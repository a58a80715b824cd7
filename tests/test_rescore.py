"""Incremental match scores against a full recomputation."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_vectors import clustered, frame, similarities

from jobmill.operators.rescore import rescore


def full(people, jobs, k, floor):
    """The best ``k`` of the jobs above the floor for every profile."""
    ids = sorted(jobs)
    out = set()
    for user, vector in people.items():
        sims = similarities(vector[None, :], np.stack([jobs[j] for j in ids]))[0] if ids else []
        ranked = sorted((-s, j) for s, j in zip(sims, ids, strict=True) if s > floor)[:k]
        out |= {(user, j, round(-s, 9)) for s, j in ranked}
    return out


def tables(spark, people, jobs):
    make = lambda rows, name: spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in rows.items()], f"id bigint, {name} array<float>"
    )
    return make(people, "resume_embedding"), make(jobs, "embedding")


def ids(spark, values):
    return spark.createDataFrame([(int(v),) for v in values], "id bigint")


@pytest.mark.parametrize("lowest, floor, k", [("F", -2.0, 4), ("B", 0.75, 6)])
def test_changes_equal_a_full_recomputation(spark, lowest, floor, k):
    vectors = clustered(140, 8, 11, 0.1)
    vectors[60:64] = vectors[20]  # ties with older postings, of a larger id
    draw = random.Random(1)
    people = {i: vectors[100 + i] for i in range(20)}
    jobs = {i: vectors[i] for i in range(60)}
    scores = spark.createDataFrame([], "user_id bigint, job_id bigint, similarity double, grade string")
    resumes = spark.createDataFrame([], "user_id bigint, resume_hash bigint")
    have: dict = {}
    for step in range(4):
        gone = [j for j in have if j not in jobs or have[j] is not jobs[j]]
        new = [j for j in jobs if j not in have or have[j] is not jobs[j]]
        p, j = tables(spark, people, jobs)
        done = rescore(p, j, scores, resumes, ids(spark, new), ids(spark, gone), 8, lowest, k, pivots=6)
        got = {(r["user_id"], r["job_id"], round(r["similarity"], 9)) for r in done.scores.collect()}
        assert got == full(people, jobs, k, floor), step
        if step:
            assert done.report["compared_anew"] == 0 or done.report["searched_anew"] > 0
            assert done.report["searched_anew"] < len(people)
            assert done.report["compared_new"] <= len(people) * len(new)
        scores, resumes, have = done.scores, done.resumes, dict(jobs)
        if step == 0:
            jobs |= {i: vectors[i] for i in range(60, 75)}  # postings come
        elif step == 1:
            for i in draw.sample(sorted(jobs), 2):  # postings go, one gets a new vector
                del jobs[i]
            jobs[70] = vectors[99]
            people[3] = vectors[125]  # a new resume, a new profile, one that has gone
            people[30] = vectors[130]
            del people[5]
        else:
            jobs |= {i: vectors[i] for i in range(75, 78)}


def test_nothing_changed_compares_nothing(spark):
    vectors = clustered(60, 8, 2, 0.0)
    people, jobs = {i: vectors[i] for i in range(10)}, {i: vectors[i] for i in range(60)}
    p, j = tables(spark, people, jobs)
    none = ids(spark, [])
    empty = spark.createDataFrame([], "user_id bigint, job_id bigint, similarity double, grade string")
    first = rescore(p, j, empty, spark.createDataFrame([], "user_id bigint, resume_hash bigint"), j, none, 8, "F", 5)
    again = rescore(p, j, first.scores, first.resumes, none, none, 8, "F", 5)
    assert again.report == {"profiles": 10, "searched_anew": 0, "compared_anew": 0, "compared_new": 0}
    assert again.scores.exceptAll(first.scores).isEmpty() and again.scores.count() == 50
    assert again.scores.select(F.count_distinct("user_id")).first()[0] == 10
    assert rescore(p.limit(0), j, first.scores, first.resumes, none, none, 8, "F", 5).scores.collect() == []
    assert frame(spark, vectors).count() == 60
