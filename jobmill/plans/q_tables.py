"""Queries over keys, dedup, merge, audit and repair."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.keys import match_keys
from ..functions.text import canonical_url
from ..operators import audit, dedup, merge, repair
from ..session import durable
from . import oracle as o
from . import workload as w
from .q_rules import GATE_CTE, SPELLED, gated_postings, spelled_roles
from .registry import query

GROUP = ", ".join(map(o.lit, dedup.CURATED_SOURCES))
URL = o.canonical_url("url")


@query("d1_posting_hash", f"WITH {o.HASHED} SELECT source_id, dedup_hash FROM hashed")
def posting_hash(spark, d):
    return w.hashed_postings(spark, d).select("source_id", "dedup_hash")


@query(
    "d2_dedupe_first",
    f"WITH {o.RAW} SELECT {URL} AS url_key, source_id FROM raw WHERE {URL} <> '' QUALIFY row_number() OVER (PARTITION BY {URL} ORDER BY ingest_seq) = 1",
)
def dedupe_first(spark, d):
    rows = w.raw_postings(spark, d).withColumn("url_key", canonical_url(F.col("url"))).filter("url_key <> ''")
    return dedup.dedupe_by(rows, ["url_key"], ["ingest_seq"]).select("url_key", "source_id")


@query(
    "d2_dedupe_last",
    f"WITH {o.HASHED} SELECT dedup_hash, max(ingest_seq) AS ingest_seq FROM hashed GROUP BY 1",
)
def dedupe_last(spark, d):
    rows = w.hashed_postings(spark, d)
    return dedup.dedupe_by(rows, ["dedup_hash"], ["ingest_seq"], keep="last").select("dedup_hash", "ingest_seq")


CROSS = f"""numbered AS (SELECT *, source IN ({GROUP}) AND {URL} <> '' AS shared,
  row_number() OVER (PARTITION BY source IN ({GROUP}) AND {URL} <> '', {URL} ORDER BY source_rank, ingest_seq) AS rn FROM hashed),
crossed AS (SELECT * FROM numbered WHERE NOT shared OR rn = 1)"""


@query("d3_dedupe_across_sources", f"WITH {o.HASHED}, {CROSS} SELECT source, source_id, url FROM crossed")
def across_sources(spark, d):
    return dedup.dedupe_across_sources(w.raw_postings(spark, d)).select("source", "source_id", "url")


@query("d4_dedupe_in_source", f"WITH {o.HASHED} SELECT source, dedup_hash, max(ingest_seq) AS ingest_seq FROM hashed GROUP BY ALL")
def in_source(spark, d):
    return dedup.dedupe_in_source(w.hashed_postings(spark, d)).select("source", "dedup_hash", "ingest_seq")


@query(
    "d5_match_keys",
    f"WITH {o.TEXTS} SELECT id, array_to_string({o.match_keys('id', 'url', 'title', 'company', 'description')}, ' ; ') AS keys FROM texts",
)
def keys(spark, d):
    cols = [F.col(x) for x in ("id", "url", "title", "company", "description")]
    return w.text_postings(spark, d).select("id", F.array_join(match_keys(*cols), " ; ").alias("keys"))


_GREEDY = f"""WITH RECURSIVE {o.RAW}, cand AS (SELECT nation AS grp, source_id, row_number() OVER (PARTITION BY nation ORDER BY ordered_at DESC, ingest_seq) AS rn,
      {o.match_keys('source_id', 'url', 'title', 'company', 'description')} AS keys FROM raw),
    {o.greedy('cand', 10)}
    SELECT s.grp AS nation, c.source_id, s.n AS keep_rank FROM scan s JOIN cand c ON c.grp = s.grp AND c.rn = s.rn WHERE s.kept"""


def _greedy(spark, d, batch):
    cols = [F.col(x) for x in ("source_id", "url", "title", "company", "description")]
    rows = w.raw_postings(spark, d).select("nation", "source_id", "ordered_at", "ingest_seq", match_keys(*cols).alias("keys"))
    order = [F.col("ordered_at").desc(), F.col("ingest_seq")]
    found = dedup.greedy_dedupe(rows, ["nation"], order, "keys", 10, batch=batch)
    return found.select("nation", "source_id", "keep_rank")


@query("d6_greedy_dedupe", _GREEDY)
def greedy(spark, d):
    return _greedy(spark, d, 200)


@query("d6_greedy_small_batch", _GREEDY)
def greedy_small_batch(spark, d):
    """Several rounds per partition."""
    return _greedy(spark, d, 4)


@query(
    "d7_set_operations",
    """SELECT n_nationkey AS key, EXISTS (SELECT 1 FROM supplier WHERE s_nationkey = n_nationkey) AS known,
      (SELECT count(*) FROM (SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier) WHERE k = n_nationkey) AS rows_in_union
      FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer)""",
)
def set_operations(spark, d):
    customers = w.table(spark, d, "customer").select(F.col("c_nationkey").alias("key"))
    suppliers = w.table(spark, d, "supplier").select(F.col("s_nationkey").alias("key"))
    both = dedup.overlap(customers, suppliers, ["key"]).withColumn("known", F.lit(True))
    new = dedup.except_known(customers.distinct(), suppliers, ["key"]).withColumn("known", F.lit(False))
    counts = dedup.union_all([customers, suppliers]).groupBy("key").agg(F.count("*").alias("rows_in_union"))
    return dedup.union_all([both, new]).join(counts, "key")


@query(
    "d8_duplicate_report",
    f"""WITH {o.HASHED}, {CROSS}, t AS (SELECT source, count(*) AS n_rows FROM hashed GROUP BY 1),
    k AS (SELECT source, count(*) AS kept FROM crossed GROUP BY 1),
    s AS (SELECT source, count(DISTINCT dedup_hash) AS shared FROM hashed WHERE dedup_hash IN
      (SELECT dedup_hash FROM hashed GROUP BY 1 HAVING count(DISTINCT source) > 1) GROUP BY 1)
    SELECT t.source, n_rows, n_rows - coalesce(kept, 0) AS removed, coalesce(shared, 0) AS shared_hashes
    FROM t LEFT JOIN k USING (source) LEFT JOIN s USING (source)""",
)
def duplicate_report(spark, d):
    return dedup.duplicate_report(w.hashed_postings(spark, d))


OUT = ["id", "source", "source_id", "title", "location", "dedup_hash", "is_active"]
_STAMP = "strftime(posted_at, '%Y-%m-%d') AS posted"


def _merged(spark, d):
    return merge.merge_snapshot(w.snapshot(spark, d), w.batch(spark, d), w.as_of())


@query("m1_merge_snapshot", f"WITH {o.MERGE} SELECT {', '.join(OUT)}, {_STAMP} FROM merged")
def merge_snapshot(spark, d):
    return _merged(spark, d).select(*OUT, F.date_format("posted_at", "yyyy-MM-dd").alias("posted"))


@query(
    "m2_merge_stats",
    f"""WITH {o.MERGE}, j AS (SELECT p.n, p.first_source, s.source AS owner FROM per_hash p LEFT JOIN snapshot s USING (dedup_hash))
    SELECT CAST(sum(n) AS BIGINT) AS attempted, count(*) FILTER (owner IS NULL) AS inserted,
      CAST(sum(CASE WHEN owner IS NULL THEN n - 1 ELSE n END) AS BIGINT) AS updated, CAST(sum(n) AS BIGINT) AS upserted,
      CAST(sum(CASE WHEN owner IS NULL THEN n - 1 WHEN owner = first_source THEN n - 1 ELSE n END) AS BIGINT) AS conflicts FROM j""",
)
def merge_stats(spark, d):
    return merge.merge_stats(w.snapshot(spark, d), w.batch(spark, d))


@query("m3_stale_candidates", f"WITH {o.MERGE} SELECT source, dedup_hash FROM stale")
def stale_candidates(spark, d):
    return merge.stale_candidates(_merged(spark, d), w.batch(spark, d)).select("source", "dedup_hash")


@query("m4_retirement_guards", f"WITH {o.GUARDS} SELECT * FROM decided")
def retirement_guards(spark, d):
    return merge.retirement_guards(durable(_merged(spark, d)), w.batch(spark, d), w.run_status(spark, d))


@query(
    "m5_retire",
    f"""WITH {o.GUARDS}, gone AS (SELECT s.source, s.dedup_hash FROM stale s JOIN decided USING (source) WHERE decision = 'retire')
    SELECT m.id, m.source, m.is_active AND g.dedup_hash IS NULL AS is_active FROM merged m
    LEFT JOIN gone g ON g.source = m.source AND g.dedup_hash = m.dedup_hash""",
)
def retire(spark, d):
    merged, batch = durable(_merged(spark, d)), w.batch(spark, d)
    decisions = merge.retirement_guards(merged, batch, w.run_status(spark, d))
    return merge.retire(merged, batch, decisions).select("id", "source", "is_active")


@query(
    "m6_insert_ignore",
    f"""WITH {o.USERS} SELECT user_id, job_id FROM sent UNION SELECT user_id, job_id FROM applied""",
)
def insert_ignore(spark, d):
    new = w.applications(spark, d).select("user_id", "job_id")
    return merge.insert_ignore(w.sent(spark, d), new.unionByName(new), ["user_id", "job_id"])


_PROBE = """state AS (SELECT p_brand AS company, min(p_size) % 4 AS zero_count, min(p_partkey) % 2 = 0 AS has_target FROM part GROUP BY 1),
runs AS (SELECT company, r.* FROM (SELECT 'Brand#' || (l_suppkey % 29) AS company, count(*) FILTER (l_quantity > 49.5) % 3 AS jobs,
  count(*) FILTER (l_quantity > 49) % 2 AS raw_jobs, min(l_orderkey) % 4 = 0 AS had_timeout, min(l_orderkey) % 3 = 0 AS had_success,
  min(l_orderkey) % 5 <> 0 AS had_error, min(l_orderkey) % 2 = 0 AS found FROM lineitem GROUP BY 1) r),"""


def _probe_tables(spark, d):
    target = F.create_map(F.lit("careers"), F.struct(F.lit("wd1").alias("wd_version"), F.lit("careers").alias("slug")))
    empty = F.create_map().cast("map<string,struct<wd_version:string,slug:string>>")
    state = w.table(spark, d, "part").groupBy(F.col("p_brand").alias("company")).agg(
        (F.min("p_size") % 4).alias("zero_count"),
        F.when(F.min("p_partkey") % 2 == 0, target).otherwise(empty).alias("known_targets"),
    ).withColumns(
        {"last_attempt": F.lit("2001-01-01").cast("date"), "wd_version": F.lit(None).cast("string"), "slug": F.lit(None).cast("string")}
    )
    first = F.min("l_orderkey")
    runs = w.table(spark, d, "lineitem").groupBy(
        F.concat(F.lit("Brand#"), F.col("l_suppkey") % 29).alias("company")
    ).agg(
        (F.count_if(F.col("l_quantity") > 49.5) % 3).alias("jobs"),
        (F.count_if(F.col("l_quantity") > 49) % 2).alias("raw_jobs"),
        (first % 4 == 0).alias("had_timeout"),
        (first % 3 == 0).alias("had_success"),
        (first % 5 != 0).alias("had_error"),
        F.when(first % 2 == 0, F.create_map(F.lit("jobs"), F.struct(F.lit("wd5").alias("wd_version"), F.lit("jobs").alias("slug")))).otherwise(empty).alias("known_targets"),
    ).withColumns({"wd_version": F.lit(None).cast("string"), "slug": F.lit(None).cast("string")})
    # Companies that are being skipped are not tried.
    skipped = merge.split_probe_run(state).filter("skipped").select("company")
    return state, runs.join(skipped, "company", "left_anti")


@query(
    "m7_probe_state",
    f"""WITH {_PROBE} tried AS (SELECT * FROM runs WHERE company NOT IN (SELECT company FROM state WHERE zero_count > 0)),
    j AS (SELECT coalesce(s.company, t.company) AS company, t.company IS NOT NULL AS tried,
      CASE WHEN t.company IS NULL THEN greatest(coalesce(s.zero_count, 0) - CASE WHEN s.zero_count > 0 THEN 1 ELSE 0 END, 0)
        WHEN t.jobs = 0 AND NOT had_timeout AND raw_jobs = 0 AND had_error AND NOT had_success THEN 3 ELSE 0 END AS zero_count,
      coalesce(has_target, false) AS old_target, coalesce(found, false) AS new_target
      FROM state s FULL JOIN tried t ON s.company = t.company)
    SELECT company, CAST(zero_count AS INTEGER) AS zero_count, CASE WHEN tried THEN '2001-08-02' WHEN company IN (SELECT company FROM state) THEN '2001-01-01' END AS last_attempt,
      CASE WHEN old_target AND new_target THEN 'careers,jobs' WHEN old_target THEN 'careers' WHEN new_target THEN 'jobs' ELSE '' END AS targets
    FROM j WHERE zero_count > 0 OR old_target OR new_target""",
)
def probe_state(spark, d):
    state, runs = _probe_tables(spark, d)
    out = merge.update_probe_state(state, runs, F.lit("2001-08-02").cast("date"))
    return out.select(
        "company",
        F.col("zero_count").cast("int").alias("zero_count"),
        F.col("last_attempt").cast("string").alias("last_attempt"),
        F.array_join(F.array_sort(F.map_keys("known_targets")), ",").alias("targets"),
    )


_JOBS = f"""{o.CLASSIFIED}, jobs AS (SELECT *, source_id AS id, ingest_seq % 10 <> 0 AS is_active FROM classified WHERE experience_level IS NOT NULL)"""


@query(
    "m8_score_jobs",
    f"""WITH {_JOBS}, {o.USERS} SELECT g.user_id, g.job_id, round(g.similarity, 6) AS similarity, g.grade, j.title FROM graded g
    JOIN jobs j ON j.id = g.job_id WHERE g.grade IN ('A', 'B', 'C') AND j.is_active AND j.is_usa""",
)
def score_jobs(spark, d):
    return merge.score_jobs(w.scores(spark, d), w.digest_jobs(spark, d)).select(
        "user_id", "job_id", F.round("similarity", 6).alias("similarity"), "grade", "title"
    )


@query(
    "m9_exclude_seen",
    f"WITH {o.USERS} SELECT g.user_id, g.job_id, g.grade FROM graded g ANTI JOIN seen s ON s.user_id = g.user_id AND s.job_id = g.job_id",
)
def exclude_seen(spark, d):
    return merge.exclude_seen(w.scores(spark, d), w.applications(spark, d), w.sent(spark, d)).select("user_id", "job_id", "grade")


@query(
    "a1_run_summary",
    f"WITH {o.RAW} SELECT source, count(*) AS postings FROM raw GROUP BY source UNION ALL SELECT '(total)', count(*) FROM raw",
)
def run_summary(spark, d):
    return audit.run_summary(w.raw_postings(spark, d))


@query("a2_active_counts", f"WITH {o.MERGE} SELECT source, count(*) AS active FROM snapshot WHERE is_active GROUP BY 1")
def active_counts(spark, d):
    return audit.active_counts(w.snapshot(spark, d))


_RULES = """rules AS (SELECT 'src' || n_nationkey AS source, CAST(n_nationkey * 4 AS INTEGER) AS baseline, CAST(n_nationkey * 3 AS INTEGER) AS threshold,
  CASE WHEN n_nationkey % 9 = 4 THEN 'skip' ELSE 'run' END AS mode FROM nation),
counts AS (SELECT source, count(*) AS postings, bool_or(doc_id = 7) AS failed FROM documents GROUP BY 1),
audited AS (SELECT r.source, coalesce(c.postings, 0) AS postings, baseline, threshold, CASE WHEN mode = 'skip' THEN 'SKIP'
  WHEN coalesce(failed, false) OR coalesce(c.postings, 0) = 0 THEN 'FAIL' WHEN c.postings > threshold THEN 'PASS' ELSE 'WARN' END AS status
  FROM rules r LEFT JOIN counts c USING (source))"""


def _audited(spark, d):
    key = F.col("n_nationkey")
    rules = w.table(spark, d, "nation").select(
        F.concat(F.lit("src"), key).alias("source"),
        (key * 4).cast("int").alias("baseline"),
        (key * 3).cast("int").alias("threshold"),
        F.when(key % 9 == 4, "skip").otherwise("run").alias("mode"),
    )
    counts = w.table(spark, d, "documents").groupBy("source").agg(
        F.count("*").alias("postings"), F.bool_or(F.col("doc_id") == 7).alias("failed")
    )
    return audit.audit_counts(counts, rules)


@query("a3_audit_counts", f"WITH {_RULES} SELECT * FROM audited")
def audit_counts(spark, d):
    return _audited(spark, d)


@query(
    "a3_audit_summary",
    f"WITH {_RULES} SELECT " + ", ".join(f"count(*) FILTER (status = '{s}') AS {s.lower()}" for s in audit.STATUSES) + " FROM audited",
)
def audit_summary(spark, d):
    return audit.audit_summary(_audited(spark, d))


@query(
    "a4_count_drift",
    """WITH a AS (SELECT event_type AS source, count(*) AS n FROM events GROUP BY 1),
    b AS (SELECT event_type AS source, count(DISTINCT user_id) AS n FROM events GROUP BY 1),
    c AS (SELECT l_returnflag AS source, count(*) AS n FROM lineitem GROUP BY 1)
    SELECT source, coalesce(a.n, 0) AS phase1, coalesce(b.n, 0) AS phase2, coalesce(c.n, 0) AS baseline,
      coalesce(b.n, 0) - coalesce(a.n, 0) AS upload_drift, coalesce(a.n, 0) - coalesce(c.n, 0) AS baseline_drift
    FROM a FULL JOIN b USING (source) FULL JOIN c USING (source)""",
)
def count_drift(spark, d):
    events = w.table(spark, d, "events").withColumnRenamed("event_type", "source")
    lines = w.table(spark, d, "lineitem").withColumnRenamed("l_returnflag", "source")
    one = events.groupBy("source").agg(F.count("*").alias("postings"))
    two = events.groupBy("source").agg(F.count_distinct("user_id").alias("postings"))
    base = lines.groupBy("source").agg(F.count("*").alias("postings"))
    return audit.count_drift(one, two, base)


_GATES = ("level", "senior_title", "non_us", "non_latin", "non_tech", "bad_url")


@query(
    "a5_gate_stats",
    f"WITH {o.HASHED}, {GATE_CTE}, f AS (SELECT * FROM gated QUALIFY row_number() OVER (PARTITION BY dedup_hash ORDER BY ingest_seq) = 1) "
    "SELECT count(*) AS unique_fetched, "
    + ", ".join(f"count(*) FILTER (reason = '{g}') AS dropped_{g}" for g in _GATES)
    + ", count(*) FILTER (reason IS NULL) AS kept FROM f",
)
def gate_stats(spark, d):
    return audit.gate_stats(gated_postings(spark, d), "dedup_hash", ["ingest_seq"], "reason")


@query(
    "a6_fill_rate",
    f"""WITH {o.RAW} SELECT source, count(*) FILTER (description <> '') AS with_description, count(*) AS postings,
    round(avg(CASE WHEN description <> '' THEN 1.0 ELSE 0.0 END), 6) AS fill_rate FROM raw GROUP BY 1""",
)
def fill_rate(spark, d):
    return audit.fill_rate(w.raw_postings(spark, d)).withColumn("fill_rate", F.round("fill_rate", 6))


@query(
    "a7_raw_vs_kept",
    f"""WITH {o.CLASSIFIED}, k AS (SELECT source, count(*) AS kept FROM classified WHERE experience_level IS NOT NULL AND is_usa GROUP BY 1)
    SELECT source, count(*) AS raw, count(*) FILTER (ingest_seq % 7 <> 0) AS visible, coalesce(any_value(kept), 0) AS kept
    FROM classified LEFT JOIN k USING (source) GROUP BY 1""",
)
def raw_vs_kept(spark, d):
    rows = w.classified_postings(spark, d)
    raw = rows.withColumn("is_visible", F.when(F.col("ingest_seq") % 7 == 0, False))
    return audit.raw_vs_kept(raw, rows.filter("experience_level IS NOT NULL AND is_usa"))


@query("a8_companies_with_rows", f"WITH {o.RAW} SELECT source, count(DISTINCT company) AS companies FROM raw GROUP BY 1")
def companies(spark, d):
    return audit.companies_with_rows(w.raw_postings(spark, d))


@query(
    "r1_reclassify_roles",
    f"""WITH {o.CLASSIFIED}, s AS (SELECT *, CASE WHEN ingest_seq % 5 = 0 THEN NULL WHEN ingest_seq % 5 = 1 THEN 'swe' ELSE roles END AS stored FROM classified)
    SELECT source_id AS id, roles AS new_roles FROM s WHERE stored IS DISTINCT FROM roles""",
)
def reclassify_roles(spark, d):
    rows = w.classified_postings(spark, d)
    seq = F.col("ingest_seq")
    stored = F.when(seq % 5 == 1, F.array(F.lit("swe"))).when(seq % 5 != 0, F.col("roles"))
    jobs = rows.select(F.col("source_id").alias("id"), "title", stored.alias("roles"))
    return repair.reclassify_roles(jobs).select("id", F.array_join("new_roles", ",").alias("new_roles"))


@query("r2_reclassify_experience", f"WITH {o.MERGE} SELECT id, source, title FROM snapshot WHERE is_active AND ({o.level('title')}) IS NULL")
def reclassify_experience(spark, d):
    return repair.reclassify_experience(w.snapshot(spark, d))


@query(
    "r3_cleanup_senior",
    f"WITH {o.MERGE} SELECT id, source, title FROM snapshot WHERE is_active AND source IN ({', '.join(map(o.lit, repair.TEXT_SOURCES))}) AND ({o.level('title', 'description')}) IS NULL",
)
def cleanup_senior(spark, d):
    return repair.cleanup_senior(w.snapshot(spark, d))


@query(
    "r4_canonicalize_roles",
    f"""WITH {o.HASHED}, {SPELLED}, s AS (SELECT source_id AS id, CASE WHEN NOT list_contains(spelled, 'wizard') THEN array_to_string(u, ',') END AS new_roles,
      {o.pick(w.ROLE_SPELLINGS, 'ingest_seq % 7')} || ',' || {o.pick(w.ROLE_SPELLINGS, 'o_custkey % 7')} || ',swe' AS roles FROM uniq WHERE ingest_seq % 6 <> 0)
    SELECT id, new_roles, CASE WHEN new_roles IS NULL THEN 'skipped_unknown' WHEN new_roles = roles THEN 'unchanged' ELSE 'updated' END AS outcome FROM s""",
)
def canonicalize_roles(spark, d):
    jobs = w.raw_postings(spark, d).select(
        F.col("source_id").alias("id"), F.when(F.col("ingest_seq") % 6 != 0, spelled_roles()).alias("roles")
    )
    return repair.canonicalize_roles(jobs).select("id", F.array_join("new_roles", ",").alias("new_roles"), "outcome")
