"""Per-user alert digests: top matches of the narrowest time window that has any."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.classify import map_profile_levels
from ..functions.keys import match_keys
from ..functions.text import or_label, squash_ws
from ..session import durable
from .dedup import first_rows, greedy_dedupe
from .merge import exclude_seen, score_jobs

# Fixed values of the digest.
WINDOW_DAYS = (3, 7, 14)
MATCHES = 10
SEND_CAP = 95
RECENT_GRADE = "C"
#: newest postings of a (role, level) cell that a user looks at first; each further pass,
#: for the users who need it, looks at ``CELL_GROWTH`` times as many
CELL_PREFIX = 200
CELL_GROWTH = 10
BROADCAST_ROWS = 100_000
#: pairs of users and postings that a task holds at a time, on average
PAIRS_PER_TASK = 1_000_000


def eligible_users(profiles: DataFrame) -> DataFrame:
    """Users who opted in and have an address, with cleaned preferences."""
    email = squash_ws(F.coalesce("email", F.lit("")))
    empty = F.array().cast("array<string>")

    def cleaned(name: str) -> Column:
        values = F.transform(F.array_compact(F.coalesce(name, empty)), squash_ws)
        return F.filter(values, lambda v: v != "")

    return profiles.filter("job_alerts_enabled").filter(email != "").select(
        F.col("id").alias("user_id"),
        email.alias("email"),
        F.lower(or_label(F.col("tier"), "free")).alias("tier"),
        F.array_distinct(F.transform(cleaned("target_roles"), F.lower)).alias("wanted_roles"),
        map_profile_levels(cleaned("target_levels")).alias("wanted_levels"),
        F.col("resume_embedding").isNotNull().alias("has_vector"),
    )


def tiered_window_topk(
    matches: DataFrame,
    as_of: Column,
    order_by: Sequence[Column],
    windows: Sequence[int] = WINDOW_DAYS,
    k: int = MATCHES,
    details: DataFrame | None = None,
    on: str | None = None,
) -> DataFrame:
    """Per user the top ``k`` distinct matches of the first window with any match.

    The first row of a greedy scan is always kept, so a window has a match exactly when
    it has a row. The newest row of a user therefore decides the window, and one scan is
    enough. Needs ``user_id``, ``posted_at`` and ``keys``; with ``details`` (one row per
    ``on``) the matches stay narrow and the keys come from there.
    """
    matches = durable(matches)
    newest = matches.groupBy("user_id").agg(F.max("posted_at").alias("_newest"))
    days = F.coalesce(
        *[
            F.when(F.col("_newest") > as_of - F.make_interval(days=F.lit(w)), F.lit(w))
            for w in sorted(windows)
        ]
    )
    chosen = newest.withColumn("window_days", days).filter("window_days IS NOT NULL")
    inside = matches.join(chosen.drop("_newest"), "user_id").filter(
        F.col("posted_at") > as_of - F.make_interval(days=F.col("window_days"))
    )
    return greedy_dedupe(inside, ["user_id"], order_by, "keys", k, details=details, on=on)


def _shown(jobs: DataFrame) -> DataFrame:
    """Display fields and match keys; postings without a URL are left out."""
    url = squash_ws(F.col("url"))
    title = or_label(F.col("title"), "Untitled role")
    company = or_label(F.col("company"), "Unknown company")
    text = squash_ws(F.coalesce("description", F.lit("")))
    return jobs.filter(F.coalesce(url, F.lit("")) != "").select(
        "job_id",
        title.alias("title"),
        company.alias("company"),
        or_label(F.col("location"), "Location unavailable").alias("location"),
        url.alias("url"),
        "posted_at",
        "experience_level",
        "roles",
        match_keys(F.col("job_id"), url, title, company, text).alias("keys"),
    )


def _wanted() -> Column:
    """Level and role preferences; an empty list asks for nothing."""
    level = (F.size("wanted_levels") == 0) | F.array_contains("wanted_levels", F.col("experience_level"))
    role = (F.size("wanted_roles") == 0) | F.arrays_overlap("wanted_roles", "roles")
    return level & role


_OUT = ["user_id", "job_id", "grade", "similarity", "title", "company", "location", "url", "posted_at"]


def scored_digest(
    users: DataFrame, jobs: DataFrame, scores: DataFrame, applied: DataFrame, sent: DataFrame,
    as_of: Column,
) -> DataFrame:
    """Digest of users with a resume vector: best similarity first."""
    oldest = as_of - F.make_interval(days=F.lit(max(WINDOW_DAYS)))
    recent = jobs.filter(F.col("posted_at") > oldest)
    shown = _shown(recent.withColumnRenamed("id", "job_id"))
    with_vector = users.filter("has_vector").select("user_id", "wanted_levels", "wanted_roles")
    matches = score_jobs(scores, recent).filter(F.coalesce(squash_ws(F.col("url")), F.lit("")) != "")
    matches = exclude_seen(matches.join(with_vector, "user_id").filter(_wanted()), applied, sent)
    pairs = matches.select("user_id", "job_id", "posted_at", "grade", "similarity")
    order = [F.col("similarity").desc(), F.col("job_id")]
    top = tiered_window_topk(pairs, as_of, order, details=shown.drop("posted_at"), on="job_id")
    return top.select(*_OUT, "window_days", "keep_rank")


def _user_cells(users: DataFrame) -> DataFrame:
    """One row per (role, level) a user asks for; ``*`` asks for any."""
    any_one = F.array(F.lit("*"))
    roles = F.when(F.size("wanted_roles") == 0, any_one).otherwise(F.col("wanted_roles"))
    levels = F.when(F.size("wanted_levels") == 0, any_one).otherwise(F.col("wanted_levels"))
    return users.select("user_id", F.explode(roles).alias("cell_role"), levels.alias("_l")).select(
        "user_id", "cell_role", F.explode("_l").alias("cell_level")
    )


def _job_cells(jobs: DataFrame) -> DataFrame:
    star = F.lit("*")
    roles = F.array_union(F.coalesce("roles", F.array().cast("array<string>")), F.array(star))
    return jobs.withColumn("cell_role", F.explode(roles)).withColumn(
        "cell_level", F.explode(F.array_compact(F.array(F.col("experience_level"), star)))
    )


def _recent_pairs(
    waiting: DataFrame, newest: DataFrame, bounds: DataFrame, place: Column
) -> DataFrame:
    """Distinct pairs of users and the postings of their cells, up to the user's bound.

    The table of users is small and may be one file, while its pairs are many. Tasks are
    made after the number of pairs, and none collects pairs before they are spread.
    """
    key = ["cell_role", "cell_level"]
    held = newest.groupBy(*key).agg(F.count("*").alias("_held"))
    total = waiting.join(F.broadcast(held), key).agg(F.sum("_held")).first()[0] or 0
    cores = waiting.sparkSession.sparkContext.defaultParallelism
    tasks = max(cores, -(-total // PAIRS_PER_TASK))
    small = newest.count() <= BROADCAST_ROWS
    bounded = waiting.join(bounds, "user_id", "left").repartition(tasks, "user_id", *key)
    pairs = bounded.join(F.broadcast(newest) if small else newest, key)
    pairs = pairs.filter(F.col("_bound").isNull() | (place <= F.col("_bound"))).drop(*key, "_bound")
    return pairs.repartition(tasks, "user_id", "job_id").dropDuplicates(["user_id", "job_id"])


def recent_digest(
    users: DataFrame, jobs: DataFrame, applied: DataFrame, sent: DataFrame, as_of: Column
) -> DataFrame:
    """Digest of users without a resume vector: newest postings first, grade ``C``.

    Users meet postings through (role, level) cells, and a pass looks at the newest
    ``CELL_PREFIX`` postings of each. Of a user's cells that go on after that, the one
    whose prefix ends first bounds what the user has seen completely; only rows up to
    there count. A digest that is full from them is done, and so is a user none of whose
    cells was cut. The others look at ``CELL_GROWTH`` times as many in the next pass.
    Pairs stay narrow; what a digest shows is joined to the rows it looks at.
    """
    oldest = as_of - F.make_interval(days=F.lit(max(WINDOW_DAYS)))
    open_jobs = jobs.filter("is_active AND is_usa").filter(F.col("posted_at") > oldest)
    shown = durable(_shown(open_jobs.withColumnRenamed("id", "job_id")))
    key = ["cell_role", "cell_level"]
    cells = _job_cells(shown.select("job_id", "posted_at", "roles", "experience_level"))
    cells = cells.select(*key, "job_id", "posted_at")
    newest_first = [F.col("posted_at").desc(), F.col("job_id")]
    place = F.struct((-F.unix_micros("posted_at")).alias("age"), F.col("job_id").alias("job"))
    sizes = cells.groupBy(*key).agg(F.count("*").alias("size"))
    waiting = _user_cells(users.filter("NOT has_vector"))
    details = shown.drop("posted_at")
    done: list[DataFrame] = []
    prefix = CELL_PREFIX
    while True:
        newest = durable(first_rows(cells, key, newest_first, prefix))
        ends = newest.withColumn("_place", place).groupBy(*key).agg(F.max("_place").alias("_end"))
        ends = ends.join(sizes.filter(F.col("size") > prefix), key).drop("size")
        bounds = durable(waiting.join(ends, key).groupBy("user_id").agg(F.min("_end").alias("_bound")))
        pairs = exclude_seen(_recent_pairs(waiting, newest, bounds, place), applied, sent)
        top = tiered_window_topk(pairs, as_of, newest_first, details=details, on="job_id")
        full = top.groupBy("user_id").agg(F.count("*").alias("n")).filter(F.col("n") == MATCHES)
        again = durable(bounds.select("user_id").join(full, "user_id", "left_anti"))
        if again.isEmpty():
            done.append(top)
            break
        done.append(top.join(again, "user_id", "left_anti"))
        waiting = waiting.join(again, "user_id", "left_semi")
        prefix *= CELL_GROWTH
    return (
        reduce(DataFrame.unionByName, done)
        .withColumn("grade", F.lit(RECENT_GRADE))
        .withColumn("similarity", F.lit(None).cast("double"))
        .select(*_OUT, "window_days", "keep_rank")
    )


def alert_digest(
    profiles: DataFrame, jobs: DataFrame, scores: DataFrame, applied: DataFrame,
    sent: DataFrame, as_of: Column,
) -> DataFrame:
    """All digests of a day, one row per user and match."""
    users = eligible_users(profiles)
    return scored_digest(users, jobs, scores, applied, sent, as_of).unionByName(
        recent_digest(users, jobs, applied, sent, as_of)
    )


def send_cap(digest: DataFrame, cap: int = SEND_CAP) -> DataFrame:
    """The digests of the first ``cap`` users that have any."""
    chosen = digest.select("user_id").distinct().orderBy("user_id").limit(cap)
    return digest.join(F.broadcast(chosen), "user_id", "left_semi")
