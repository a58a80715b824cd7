"""Queries over the feed, search, digests and the tracker."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.keys import match_keys
from ..operators import digest as dg
from ..operators import feed
from . import oracle as o
from . import workload as w
from .q_tables import _JOBS, GROUP
from .registry import query

QUERY = "the software data"
_FEED_WHERE = f"""is_active AND list_has_any(string_split(roles, ','), ['swe', 'ds']) AND source IN ({GROUP}, 'lever')
  AND posted_at > TIMESTAMP '1997-01-01' AND is_usa"""


def _feed(spark, d):
    return feed.job_feed(
        w.digest_jobs(spark, d),
        roles=["swe", "ds"],
        sources=["github_repos", "lever"],
        posted_after=F.lit("1997-01-01").cast("timestamp"),
        place="usa",
    )


@query("f1_job_feed", f"WITH {_JOBS} SELECT id, source, title, experience_level FROM jobs WHERE {_FEED_WHERE}")
def job_feed(spark, d):
    return _feed(spark, d).select("id", "source", "title", "experience_level")


@query(
    "f2_page",
    f"WITH {_JOBS} SELECT id, title FROM jobs WHERE {_FEED_WHERE} ORDER BY posted_at DESC, id LIMIT 50 OFFSET 50",
)
def page(spark, d):
    order = [F.col("posted_at").desc(), F.col("id")]
    return feed.page(_feed(spark, d), order, "pro", 2).select("id", "title")


def _hits(field: str) -> str:
    return f"list_filter(string_split_regex(lower({field}), '[^a-z0-9]+'), lambda x: x IN ('the', 'software', 'data'))"


@query(
    "f3_search_ranked",
    f"""WITH {o.TEXTS}, h AS (SELECT id, {_hits('title')} AS a, {_hits('company')} AS b, {_hits('description')} AS c FROM texts)
    SELECT id, round(len(a) * 1.0::DOUBLE + len(b) * 0.4::DOUBLE + len(c) * 0.2::DOUBLE, 6) AS rank FROM h
    WHERE len(list_distinct(list_concat(a, b, c))) = 2 AND NOT list_contains(list_concat(a, b, c), 'data')""",
)
def search_ranked(spark, d):
    both = feed.search_ranked(w.text_postings(spark, d), "The software")
    data = feed.search_ranked(w.text_postings(spark, d), "the SOFTWARE data")
    return both.join(data, "id", "left_anti").select("id", F.round("rank", 6).alias("rank"))


_CAND = f"""cand0 AS (SELECT CAST(o_custkey AS VARCHAR) AS user_id, source_id, ordered_at, ingest_seq, title, company, url, description FROM raw)"""


@query(
    "f4_tiered_topk",
    f"""WITH RECURSIVE {o.RAW}, newest AS (SELECT nation, max(ordered_at) AS newest FROM raw GROUP BY 1),
    win AS (SELECT nation, CASE WHEN newest > TIMESTAMP '{w.AS_OF}' - INTERVAL 3 DAY THEN 3 WHEN newest > TIMESTAMP '{w.AS_OF}' - INTERVAL 7 DAY THEN 7
      WHEN newest > TIMESTAMP '{w.AS_OF}' - INTERVAL 14 DAY THEN 14 END AS days FROM newest),
    cand AS (SELECT r.nation AS grp, r.source_id, days, row_number() OVER (PARTITION BY r.nation ORDER BY title, source_id) AS rn,
      {o.match_keys('source_id', 'url', 'title', 'company', 'description')} AS keys FROM raw r JOIN win USING (nation)
      WHERE ordered_at > TIMESTAMP '{w.AS_OF}' - days * INTERVAL 1 DAY),
    {o.greedy('cand', 10)}
    SELECT CAST(s.grp AS VARCHAR) AS user_id, c.source_id, CAST(days AS INTEGER) AS window_days, s.n AS keep_rank FROM scan s JOIN cand c ON c.grp = s.grp AND c.rn = s.rn WHERE s.kept""",
)
def tiered_topk(spark, d):
    cols = [F.col(x) for x in ("source_id", "url", "title", "company", "description")]
    rows = w.raw_postings(spark, d).select(
        F.col("nation").cast("string").alias("user_id"),
        "source_id",
        "title",
        F.col("ordered_at").alias("posted_at"),
        match_keys(*cols).alias("keys"),
    )
    top = dg.tiered_window_topk(rows, w.as_of(), [F.col("title"), F.col("source_id")])
    return top.select("user_id", "source_id", "window_days", "keep_rank")


_MATCHES = f"""all_matches AS (
  SELECT u.user_id, j.id AS job_id, g.grade, g.similarity, j.posted_at, j.title, j.company, j.url, j.description FROM users u
    JOIN graded g USING (user_id) JOIN jobs j ON j.id = g.job_id
    WHERE u.has_vector AND g.grade IN ('A', 'B', 'C') AND j.is_active AND j.is_usa AND trim(j.url) <> ''
      AND (len(wanted_levels) = 0 OR list_contains(wanted_levels, experience_level))
      AND (len(wanted_roles) = 0 OR list_has_any(wanted_roles, string_split(roles, ',')))
  UNION ALL
  SELECT u.user_id, j.id, 'C', NULL, j.posted_at, j.title, j.company, j.url, j.description FROM users u
    JOIN jobs j ON (len(wanted_levels) = 0 OR list_contains(wanted_levels, experience_level))
      AND (len(wanted_roles) = 0 OR list_has_any(wanted_roles, string_split(roles, ',')))
    WHERE NOT u.has_vector AND j.is_active AND j.is_usa AND trim(j.url) <> ''),
open_matches AS (SELECT m.* FROM all_matches m LEFT JOIN seen s ON s.user_id = m.user_id AND s.job_id = m.job_id WHERE s.job_id IS NULL),
newest AS (SELECT user_id, max(posted_at) AS newest FROM open_matches GROUP BY 1),
win AS (SELECT user_id, CASE WHEN newest > TIMESTAMP '{w.AS_OF}' - INTERVAL 3 DAY THEN 3 WHEN newest > TIMESTAMP '{w.AS_OF}' - INTERVAL 7 DAY THEN 7
  WHEN newest > TIMESTAMP '{w.AS_OF}' - INTERVAL 14 DAY THEN 14 END AS days FROM newest),
cand AS (SELECT m.user_id AS grp, m.job_id, m.grade, days, row_number() OVER (PARTITION BY m.user_id ORDER BY similarity DESC NULLS LAST,
    CASE WHEN similarity IS NULL THEN posted_at END DESC, m.job_id) AS rn,
  {o.match_keys('job_id', 'url', 'title', 'company', 'description')} AS keys FROM open_matches m JOIN win USING (user_id)
  WHERE posted_at > TIMESTAMP '{w.AS_OF}' - days * INTERVAL 1 DAY),
{o.greedy('cand', 10)},
digest AS (SELECT s.grp AS user_id, c.job_id, c.grade, CAST(days AS INTEGER) AS window_days, s.n AS keep_rank
  FROM scan s JOIN cand c ON c.grp = s.grp AND c.rn = s.rn WHERE s.kept)"""
_DIGEST = f"WITH RECURSIVE {_JOBS}, {o.USERS}, {_MATCHES}"


def _digest(spark, d):
    return dg.alert_digest(
        w.profiles(spark, d), w.digest_jobs(spark, d), w.scores(spark, d),
        w.applications(spark, d), w.sent(spark, d), w.as_of(),
    )


@query("f5_alert_digest", f"{_DIGEST} SELECT user_id, job_id, grade, window_days, keep_rank FROM digest")
def alert_digest(spark, d):
    return _digest(spark, d).select("user_id", "job_id", "grade", "window_days", "keep_rank")


#: postings moved into five days, so that cells hold more rows than one pass looks at
_CONDENSED = _DIGEST.replace(
    "jobs AS (SELECT *,",
    f"jobs AS (SELECT * REPLACE (TIMESTAMP '{w.AS_OF}' - INTERVAL 1 HOUR - CAST(ingest_seq % 5 AS INTEGER) * INTERVAL 1 DAY AS posted_at),",
)


@query(
    "f5_recent_digest",
    f"{_CONDENSED} SELECT d.user_id, job_id, window_days, keep_rank FROM digest d JOIN users u ON u.user_id = d.user_id WHERE NOT u.has_vector",
)
def recent_digest(spark, d):
    age = F.make_interval(days=(F.col("ingest_seq") % 5).cast("int"), hours=F.lit(1))
    jobs = w.digest_jobs(spark, d).withColumn("posted_at", w.as_of() - age)
    users = dg.eligible_users(w.profiles(spark, d))
    found = dg.recent_digest(users, jobs, w.applications(spark, d), w.sent(spark, d), w.as_of())
    return found.select("user_id", "job_id", "window_days", "keep_rank")


@query(
    "f6_send_cap",
    f"{_DIGEST} SELECT user_id, count(*) AS matches FROM digest WHERE user_id IN (SELECT DISTINCT user_id FROM digest ORDER BY user_id LIMIT 95) GROUP BY 1",
)
def send_cap(spark, d):
    return dg.send_cap(_digest(spark, d)).groupBy("user_id").agg(F.count("*").alias("matches"))


@query(
    "f7_sample_rows",
    f"""WITH {o.RAW}, t AS (SELECT source_id, title, ingest_seq, CASE WHEN title LIKE 'Nothing%' THEN 0 WHEN lower(title) LIKE '%data%' AND location = 'Denver' THEN 1
      WHEN lower(title) LIKE '%engineer%' THEN 2 END AS tier FROM raw)
    SELECT source_id, title FROM t WHERE tier = (SELECT min(tier) FROM t) ORDER BY ingest_seq LIMIT 5""",
)
def sample_rows(spark, d):
    title = F.lower("title")
    wanted = [
        F.col("title").startswith("Nothing"),
        title.contains("data") & (F.col("location") == "Denver"),
        title.contains("engineer"),
    ]
    return feed.sample_rows(w.raw_postings(spark, d), wanted, 5, ["ingest_seq"]).select("source_id", "title")


@query(
    "u1_eligible_users",
    f"WITH {o.USERS} SELECT user_id, email, tier, array_to_string(wanted_roles, ',') AS roles, array_to_string(wanted_levels, ',') AS levels, has_vector FROM users",
)
def eligible_users(spark, d):
    return dg.eligible_users(w.profiles(spark, d)).select(
        "user_id", "email", "tier",
        F.array_join("wanted_roles", ",").alias("roles"),
        F.array_join("wanted_levels", ",").alias("levels"),
        "has_vector",
    )


@query(
    "u2_application_stats",
    f"WITH {o.USERS} SELECT user_id, count(*) AS applications, CAST(sum(interview_count) AS BIGINT) AS interviews, "
    + ", ".join(f"count(*) FILTER (status = '{s}') AS {s}" for s in feed.APPLICATION_STATUSES)
    + " FROM applied GROUP BY 1",
)
def application_stats(spark, d):
    return feed.application_stats(w.applications(spark, d))


@query(
    "u3_tracker_cap",
    f"""WITH {o.USERS}, t AS (SELECT a.user_id, a.job_id, p.tier, row_number() OVER (PARTITION BY a.user_id ORDER BY applied_at, a.job_id) AS rn
      FROM applied a JOIN profiles p ON p.id = a.user_id) SELECT user_id, job_id FROM t WHERE tier = 'pro' OR rn <= 100""",
)
def tracker_cap(spark, d):
    return feed.tracker_cap(w.applications(spark, d), w.profiles(spark, d)).select("user_id", "job_id")
