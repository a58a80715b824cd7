"""Queries over board discovery."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import slugify
from ..operators import discovery as disc
from . import oracle as o
from . import workload as w
from .registry import query

_VALID = "length(s) BETWEEN 2 AND 100 AND NOT regexp_matches(s, '^[0-9]+$') AND regexp_matches(s, '^[a-z0-9][a-z0-9._-]*$')"


@query(
    "b1_extract_board_slugs",
    f"""WITH f AS (SELECT page_id, unnest(regexp_extract_all(url || ' ' || html, '(?i)([a-z0-9-]+)\\.example\\.com(?:[^A-Za-z0-9_-]|$)', 1)) AS s0 FROM pages),
    v AS (SELECT DISTINCT page_id, lower(s0) AS s FROM f) SELECT page_id, s AS slug FROM v WHERE {_VALID}""",
)
def board_slugs(spark, d):
    text = F.concat_ws(" ", "url", "html")
    return w.table(spark, d, "pages").select(
        "page_id", F.explode(disc.extract_board_slugs(text, "example.com", "host")).alias("slug")
    )


_RAW_SLUG = "CASE WHEN c_custkey % 5 = 0 THEN ' ' || c_custkey || ' ' WHEN c_custkey % 5 = 1 THEN c_mktsegment || '%2E' || c_custkey ELSE c_name END"


@query(
    "b2_valid_slug",
    f"""WITH r AS (SELECT c_custkey, lower(trim(replace({_RAW_SLUG}, '%2E', '.'))) AS s FROM customer)
    SELECT c_custkey, CASE WHEN {_VALID} THEN s END AS slug FROM r""",
)
def valid_slug(spark, d):
    key = F.col("c_custkey")
    raw = (
        F.when(key % 5 == 0, F.concat(F.lit(" "), key, F.lit(" ")))
        .when(key % 5 == 1, F.concat("c_mktsegment", F.lit("%2E"), key))
        .otherwise(F.col("c_name"))
    )
    return w.table(spark, d, "customer").select("c_custkey", disc.valid_slug(raw).alias("slug"))


_SLUG = o.sub(o.sub("lower(p_name)", "[^a-z0-9]+", "-"), "^-+|-+$", "")


@query(
    "b3_slug_variants",
    f"""WITH s AS (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN {_SLUG} || '-ai' WHEN 1 THEN {_SLUG} || '.io' ELSE {_SLUG} END AS s FROM part)
    SELECT p_partkey, v.s AS variant FROM (SELECT DISTINCT p_partkey, unnest([s, replace(s, '-', ''), replace(s, '.', '-'), replace(s, '.', ''),
      CASE WHEN strpos(s, '.') > 0 THEN split_part(s, '.', 1) END, CASE WHEN s LIKE '%-ai' THEN s[:-4] || 'ai' END]) AS s FROM s) v WHERE v.s IS NOT NULL""",
)
def slug_variants(spark, d):
    key = F.col("p_partkey") % 3
    slug = slugify(F.col("p_name"))
    full = F.concat(slug, F.when(key == 0, "-ai").when(key == 1, ".io").otherwise(""))
    return w.table(spark, d, "part").select("p_partkey", F.explode(disc.slug_variants(full)).alias("variant"))


@query(
    "b3_name_variants",
    """WITH b AS (SELECT s_suppkey, 'supplier-' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') || '-inc' AS base,
      'supplier-' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS first FROM supplier)
    SELECT s_suppkey, unnest([base, replace(base, '-', ''), first, replace(first, '-', ''), 'inc']) AS variant FROM b""",
)
def name_variants(spark, d):
    name = F.concat(F.regexp_replace("s_name", "#", " "), F.lit(", Inc"))
    return w.table(spark, d, "supplier").select("s_suppkey", F.explode(disc.name_variants(name)).alias("variant"))


@query(
    "b3_hostname_variants",
    r"""WITH h AS (SELECT page_id, regexp_replace(lower(regexp_extract(url, '^https?://([^/?#]+)', 1)), '^www\d*\.', '') AS host FROM pages)
    SELECT page_id, unnest([host, 'example']) AS variant FROM h""",
)
def hostname_variants(spark, d):
    host = F.parse_url("url", F.lit("HOST"))
    return w.table(spark, d, "pages").select("page_id", F.explode(disc.hostname_variants(host)).alias("variant"))


def _buckets(spark, d):
    part = w.table(spark, d, "part").select(slugify(F.col("p_name")).alias("slug")).distinct()
    brand = w.table(spark, d, "part").select(slugify(F.col("p_type")).alias("slug")).distinct()
    words = w.table(spark, d, "pages").select(
        F.lower(F.element_at(F.split(F.parse_url("url", F.lit("HOST")), "\\."), 1)).alias("slug")
    ).distinct()
    return {"cache": part, "github": brand.unionByName(part), "crawl": words}


_BUCKETS = f"""cache AS (SELECT DISTINCT {_SLUG} AS slug FROM part), types AS (SELECT DISTINCT {_SLUG.replace('p_name', 'p_type')} AS slug FROM part),
words AS (SELECT DISTINCT lower(split_part(regexp_extract(url, '^https?://([^/?#]+)', 1), '.', 1)) AS slug FROM pages),
cand AS (SELECT slug, 'cache' AS bucket, 0 AS r FROM cache UNION ALL SELECT slug, 'github', 1 FROM types WHERE slug NOT IN (SELECT slug FROM cache)
  UNION ALL SELECT slug, 'crawl', 3 FROM words WHERE slug NOT IN (SELECT slug FROM cache) AND slug NOT IN (SELECT slug FROM types))"""


@query("b4_slug_candidates", f"WITH {_BUCKETS} SELECT slug, bucket, CAST(r AS INTEGER) AS bucket_rank FROM cand")
def slug_candidates(spark, d):
    return disc.slug_candidates(_buckets(spark, d))


@query(
    "b5_bucket_coverage",
    f"WITH {_BUCKETS} SELECT bucket, count(*) AS slugs, count(*) FILTER (slug NOT IN (SELECT slug FROM cache)) AS new FROM cand GROUP BY 1",
)
def bucket_coverage(spark, d):
    buckets = _buckets(spark, d)
    return disc.bucket_coverage(disc.slug_candidates(buckets), buckets["cache"])


def _validated(spark, d):
    part = w.table(spark, d, "part").groupBy(slugify(F.concat_ws(" ", "p_brand", "p_name")).alias("slug"))
    cached = part.agg(F.min("p_partkey").alias("k")).filter("k % 2 = 0").select(
        "slug", F.when(F.col("k") % 4 == 0, F.concat(F.lit("Cached "), "k")).alias("company_name")
    )
    probes = part.agg(F.min("p_partkey").alias("k"), F.count("*").alias("n")).select(
        "slug",
        F.when(F.col("k") % 3 != 0, F.col("n")).otherwise(0).alias("job_count"),
        F.when(F.col("k") % 5 == 0, F.concat(F.lit("Fetched "), "k")).alias("fetched_name"),
    )
    return disc.apply_validation(cached, probes)


_BRAND_SLUG = o.sub(o.sub("lower(p_brand || ' ' || p_name)", "[^a-z0-9]+", "-"), "^-+|-+$", "")
_CHANGES = f"""p AS (SELECT {_BRAND_SLUG} AS slug, min(p_partkey) AS k, count(*) AS n FROM part GROUP BY 1),
changes AS (SELECT slug, coalesce(CASE WHEN k % 2 = 0 AND k % 4 = 0 THEN 'Cached ' || k END, CASE WHEN k % 3 <> 0 AND k % 5 = 0 THEN 'Fetched ' || k END,
    array_to_string(list_transform(string_split(slug, '-'), lambda x: upper(x[1]) || x[2:]), ' ')) AS company_name,
  CASE WHEN k % 3 <> 0 THEN n ELSE 0 END AS job_count,
  CASE WHEN k % 3 = 0 THEN 'removed' WHEN k % 2 <> 0 THEN 'added' ELSE 'kept' END AS change FROM p WHERE k % 2 = 0 OR k % 3 <> 0)"""


@query("b6_apply_validation", f"WITH {_CHANGES} SELECT * FROM changes")
def apply_validation(spark, d):
    return _validated(spark, d)


@query("f8_top_additions", f"WITH {_CHANGES} SELECT * FROM changes WHERE change = 'added' ORDER BY job_count DESC, slug LIMIT 30")
def top_additions(spark, d):
    return disc.top_additions(_validated(spark, d))


@query(
    "b7_probe_status",
    """WITH a AS (SELECT CAST(l_suppkey AS VARCHAR) AS company, l_returnflag AS site, l_linenumber AS v, l_orderkey AS n, l_quantity AS q FROM lineitem)
    SELECT company, site, CASE WHEN bool_or(q >= 50) THEN 'verified' WHEN bool_or(q <= 1) THEN 'timeout' ELSE 'dead' END AS status,
      arg_min('wd' || v, n * 10 + v) FILTER (q >= 50) AS version FROM a GROUP BY 1, 2""",
)
def probe_status(spark, d):
    q = F.col("l_quantity")
    attempts = w.table(spark, d, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("company"),
        F.col("l_returnflag").alias("site"),
        F.concat(F.lit("wd"), "l_linenumber").alias("version"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("attempt_order"),
        F.when(q >= 50, "verified").when(q <= 1, "timeout").otherwise("failed").alias("status"),
    )
    return disc.probe_status(attempts)


@query(
    "b8_crawl_index_rows",
    "SELECT event_type AS request_key, 'https://x.example/' || event_id AS url FROM events WHERE event_id % 7 <> 3",
)
def crawl_index_rows(spark, d):
    """JSON-lines bodies of a bounded number of events of one kind, with some broken lines."""
    key = F.col("event_id")
    line = F.when(key % 7 == 3, F.concat(F.lit('{"url": "https://x.example/'), key)).otherwise(
        F.concat(F.lit('{"url":"https://x.example/'), key, F.lit('","k":1}'))
    )
    bodies = (
        w.table(spark, d, "events")
        .groupBy(F.col("event_type").alias("request_key"), F.floor(key / 1000).alias("part"))
        .agg(F.array_join(F.collect_list(line), "\n").alias("body"))
    )
    return disc.crawl_index_rows(bodies)
