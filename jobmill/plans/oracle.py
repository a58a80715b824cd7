"""The same rules and views as plain SQL, for the side-by-side check in DuckDB.

Written apart from the Spark code: packs become flat alternations, keys are tested one by
one, and order-dependent scans are recursive queries.
"""

from __future__ import annotations

import re

from ..functions import packs_levels, packs_places, packs_roles
from ..functions import classify as rules
from ..functions import location as places
from ..functions.text import BUSINESS_SUFFIXES
from . import workload as w

WS = "[\\t\\n\\x0B\\f\\r \\x{00a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}\\x{feff}]"


def lit(text: str | None) -> str:
    return "NULL" if text is None else "'" + text.replace("'", "''") + "'"


def lits(values) -> str:
    return "[" + ", ".join(lit(v) for v in values) + "]"


def sub(expr: str, pattern: str, by: str, flags: str = "g") -> str:
    return f"regexp_replace({expr}, {lit(pattern)}, {lit(by)}, {lit(flags)})"


def trim(expr: str) -> str:
    return sub(expr, f"^{WS}+|{WS}+$", "")


def squash(expr: str) -> str:
    return f"trim({sub(expr, WS + '+', ' ')})"


def words(expr: str, pack) -> str:
    """``expr`` contains a word of the pack or matches one of its patterns."""
    parts = [p if "\\b" in p else re.escape(p) for p in pack]
    return f"regexp_matches({expr}, {lit('|'.join(parts))})"


def patterns(expr: str, pack) -> str:
    joined = "|".join(f"(?:{p})" for p in pack)
    joined = joined.replace("(?=", "(?:")
    return f"regexp_matches({expr}, {lit('(?i)' + joined)})"


def padded(title: str) -> str:
    return f"(' ' || lower({title}) || ' ')"


def level(title: str, content: str | None = None) -> str:
    t, p = f"lower({title})", padded(title)
    c = f"lower(coalesce({content}, ''))" if content else "''"
    return (
        f"CASE WHEN {words(p, packs_levels.EXCLUSION)} THEN CASE WHEN {words(c, packs_levels.RESCUE)} THEN 'entry_level' END "
        f"WHEN {words(t, packs_levels.INTERNSHIP)} THEN 'internship' "
        f"WHEN {words(p, packs_levels.NEW_GRAD)} OR {words(c, packs_levels.NEW_GRAD_TEXT)} THEN 'new_grad' "
        "ELSE 'entry_level' END"
    )


def level_stage(title: str, content: str) -> str:
    t, p, c = f"lower({title})", padded(title), f"lower(coalesce({content}, ''))"
    return (
        f"CASE WHEN {words(p, packs_levels.EXCLUSION)} THEN CASE WHEN {words(c, packs_levels.RESCUE)} THEN 'excluded_rescued' ELSE 'excluded' END "
        f"WHEN {words(t, packs_levels.INTERNSHIP)} THEN 'internship_title' "
        f"WHEN {words(p, packs_levels.NEW_GRAD)} THEN 'new_grad_title' "
        f"WHEN {words(c, packs_levels.NEW_GRAD_TEXT)} THEN 'new_grad_text' "
        f"WHEN {words(t, packs_levels.ENTRY_LEVEL)} OR {words(c, packs_levels.ENTRY_LEVEL)} THEN 'entry_signal' "
        "ELSE 'default' END"
    )


def early_career(title: str, content: str) -> str:
    c = f"coalesce({content}, '')"
    return (
        f"({patterns(title, packs_levels.EARLY_CAREER)} OR {patterns(c, packs_levels.EARLY_CAREER)} OR NOT "
        f"({patterns(title, packs_levels.STRICT_TITLE)} OR {patterns(c, packs_levels.TOO_EXPERIENCED)}))"
    )


def tech_signal(title: str) -> str:
    return patterns(title, packs_roles.TECH_SIGNAL)


def roles(title: str) -> str:
    """The role list as a joined string."""
    physical = (
        f"({patterns(title, packs_roles.NOT_SOFTWARE)} AND NOT {patterns(title, packs_roles.SOFTWARE_AFTER_ALL)})"
    )
    hits = []
    for role in rules.ROLES:
        test = words(f"lower({title})", rules.ROLE_PACKS[role])
        if role == "swe":
            test = f"({test} AND NOT {physical})"
        hits.append(f"CASE WHEN {test} THEN {lit(role)} END")
    tags = f"coalesce(array_to_string([{', '.join(hits)}], ','), '')"
    return f"CASE WHEN {tags} = '' AND {tech_signal(title)} AND NOT {physical} THEN 'swe' ELSE {tags} END"


def target_roles(text: str) -> str:
    hits = [
        f"CASE WHEN {words(f'lower({text})', pack)} THEN {lit(role)} END"
        for role, pack in rules.TARGET_PACKS.items()
    ]
    return f"coalesce(array_to_string([{', '.join(hits)}], ','), '')"


def remote(location: str) -> str:
    return f"coalesce({words(f'lower({location})', places.REMOTE_SIGNALS)}, false)"


def usa(location: str, is_remote: str = "false") -> str:
    p = trim(location)
    low = f"lower({p})"
    names = [c.lower() for c in packs_places.US_CITIES] + places.US_SPECIAL
    return (
        f"CASE WHEN {is_remote} THEN true WHEN coalesce({p}, '') = '' THEN true "
        f"WHEN {patterns(p, [r'\bperth,\s*wa\b'])} THEN false "
        f"WHEN {low} IN ({', '.join(map(lit, places.US_BARE))}) THEN true "
        f"ELSE {patterns(p, places.US_PATTERNS)} OR {words(low, names)} END"
    )


def non_us(location: str) -> str:
    low = f"lower(coalesce({location}, ''))"
    province = f"(?:^|,\\s)(?:{places.CANADIAN_PROVINCES})(?:, |$)"
    names = "|".join(map(re.escape, packs_places.NON_US_SIGNALS))
    both = lit(f"{names}|{province}")
    tail = f"substr({low}, strpos({low}, ' - ') + 3)"
    return (
        f"(regexp_matches({low}, {both}) OR "
        f"(strpos({low}, ' - ') > 0 AND regexp_matches({trim(tail)}, {both})))"
    )


def us_like(location: str) -> str:
    return f"(coalesce({location}, '') = '' OR {words(f'lower({location})', places.US_LIKE_MARKERS)})"


def posting_hash(company: str, title: str, location: str) -> str:
    parts = [trim(f"lower(coalesce({x}, ''))") for x in (company, title, location)]
    return f"md5({' || chr(124) || '.join(parts)})"


def dedupe_text(expr: str) -> str:
    return f"trim({sub(sub(f'lower({squash(expr)})', '&amp;', '&'), '[^a-z0-9]+', ' ')})"


def company_root(expr: str) -> str:
    suffixes = ", ".join(map(lit, BUSINESS_SUFFIXES))
    kept = f"list_filter(string_split({dedupe_text(expr)}, ' '), lambda x: x <> '' AND x NOT IN ({suffixes}))"
    return f"array_to_string({kept}[1:2], ' ')"


def dedupe_url(expr: str) -> str:
    return f"lower({sub(sub(squash(expr), '#.*$', ''), '/+$', '')})"


def match_keys(id: str, url: str, title: str, company: str, description: str) -> str:
    t, c, r = dedupe_text(title), dedupe_text(company), company_root(company)
    d = f"substr({dedupe_text(description)}, 1, 500)"
    return (
        f"list_filter(['id:' || {id}, 'url:' || {dedupe_url(url)}, "
        f"CASE WHEN {t} <> '' AND {c} <> '' THEN 'title-company:' || {t} || '|' || {c} END, "
        f"CASE WHEN {t} <> '' AND {r} <> '' THEN 'title-company-root:' || {t} || '|' || {r} END, "
        f"CASE WHEN {t} <> '' AND {d} <> '' THEN 'title-description:' || {t} || '|' || {d} END], lambda x: x IS NOT NULL)"
    )


def canonical_url(expr: str) -> str:
    return sub(trim(expr), "/+$", "")


def pick(values, index: str) -> str:
    return f"({lits(values)})[1 + {index}]"


def title_of(order: str, company: str) -> str:
    n = len(w.TITLES)
    return (
        f"({pick(w.PREFIXES, f'{company} % {len(w.PREFIXES)}')} || "
        f"{pick(w.TITLES, f'({company} * 7 + {order} % 6) % {n}')} || "
        f"{pick(w.SUFFIXES, f'{order} % {len(w.SUFFIXES)}')})"
    )


RAW = f"""raw AS (SELECT
  CASE WHEN o_orderkey % 3 = 0 THEN {lit(w.BIG_SOURCE)} ELSE {pick(w.SOURCES, f'o_orderkey % {len(w.SOURCES)}')} END AS source,
  CAST(o_orderkey AS VARCHAR) AS source_id,
  {title_of('o_orderkey', 'o_custkey')} AS title,
  c_name || {pick(w.COMPANY_SUFFIXES, 'o_custkey % 5')} AS company,
  {pick(w.LOCATIONS, f'o_custkey % {len(w.LOCATIONS)}')} AS location,
  CASE WHEN o_orderkey % 97 = 0 THEN '' ELSE 'https://jobs.example.com/' || o_custkey || '/' || (o_orderkey % 4)
    || CASE WHEN o_orderkey % 5 = 0 THEN '/' ELSE '' END END AS url,
  {pick(w.BLURBS, f'(o_orderkey + o_custkey) % {len(w.BLURBS)}')} AS description,
  CASE WHEN o_orderkey % 13 <> 0 THEN o_orderdate END AS posted_at,
  o_orderdate AS ordered_at, o_orderkey AS ingest_seq, o_custkey, c_nationkey AS nation
  FROM orders JOIN customer ON o_custkey = c_custkey),
ranked AS (SELECT *, list_position({lits(w.RUN_ORDER)}, source) AS source_rank FROM raw)"""

HASHED = RAW + f""",
hashed AS (SELECT *, {posting_hash('company', 'title', 'location')} AS dedup_hash FROM ranked)"""

CLASSIFIED = HASHED + f""",
flagged AS (SELECT *, {remote('location')} AS remote FROM hashed),
classified AS (SELECT *, {level('title', 'description')} AS experience_level, {roles('title')} AS roles,
  {usa('location', 'remote')} AS is_usa FROM flagged)"""

MERGE = HASHED + f""",
snapshot AS (SELECT *, md5(dedup_hash) AS id, ordered_at AS scraped_at, ingest_seq % 10 <> 0 AS is_active
  FROM hashed WHERE ordered_at < TIMESTAMP '{w.SNAPSHOT_END}'
  QUALIFY row_number() OVER (PARTITION BY dedup_hash ORDER BY ingest_seq DESC) = 1),
batch AS (SELECT * FROM hashed WHERE ordered_at >= TIMESTAMP '{w.BATCH_START}'),
writes AS (SELECT * FROM batch
  QUALIFY row_number() OVER (PARTITION BY source, dedup_hash ORDER BY ingest_seq DESC) = 1),
per_hash AS (SELECT dedup_hash, count(*) AS n, arg_min(source, source_rank) AS first_source,
  max(posted_at) AS newest, max(source_rank) AS last_rank FROM writes GROUP BY dedup_hash),
last_write AS (SELECT writes.* FROM writes JOIN per_hash p USING (dedup_hash) WHERE source_rank = p.last_rank),
merged AS (
  SELECT s.source, s.source_id, s.title, s.company, s.location, s.url, s.description, s.posted_at, s.dedup_hash,
    s.id, s.is_active FROM snapshot s WHERE s.dedup_hash NOT IN (SELECT dedup_hash FROM per_hash)
  UNION ALL
  SELECT l.source, l.source_id, l.title, l.company, l.location, l.url, l.description,
    CASE WHEN s.source = p.first_source THEN p.newest
         WHEN s.posted_at IS NULL THEN p.newest WHEN p.newest IS NULL THEN s.posted_at
         ELSE greatest(s.posted_at, p.newest) END,
    l.dedup_hash, coalesce(s.id, md5(l.dedup_hash)), true
  FROM last_write l JOIN per_hash p USING (dedup_hash) LEFT JOIN snapshot s USING (dedup_hash)),
run_status AS (SELECT DISTINCT source, source <> 'lever' AS success FROM hashed),
fresh AS (SELECT DISTINCT source, dedup_hash FROM batch),
stale AS (SELECT m.* FROM merged m LEFT JOIN fresh f ON m.source = f.source AND m.dedup_hash = f.dedup_hash
  WHERE m.is_active AND f.source IS NULL)"""

GUARDS = MERGE + """,
counted AS (SELECT r.source, r.success,
  (SELECT count(*) FROM merged m WHERE m.is_active AND m.source = r.source) AS active,
  (SELECT count(*) FROM fresh f WHERE f.source = r.source) AS fresh,
  (SELECT count(DISTINCT dedup_hash) FROM stale s WHERE s.source = r.source) AS stale
  FROM run_status r),
decided AS (SELECT source, active, fresh, stale, CASE
  WHEN NOT success OR source = 'jobspy' THEN 'not_considered'
  WHEN fresh = 0 THEN 'skip_empty'
  WHEN active > 100 AND fresh < active * 0.5 THEN 'skip_low_fresh'
  WHEN active > 0 AND stale > active * 0.8 THEN 'skip_high_stale'
  WHEN stale = 0 AND active > fresh THEN 'skip_inconsistent'
  WHEN stale = 0 THEN 'nothing_stale' ELSE 'retire' END AS decision FROM counted)"""

TEXTS = f"""texts AS (SELECT CAST(doc_id AS VARCHAR) AS id, source, {title_of('doc_id', 'doc_id')} AS title,
  'Firm ' || (doc_id % 211) || {pick(w.COMPANY_SUFFIXES, 'doc_id % 5')} AS company,
  {pick(w.LOCATIONS, f'doc_id % {len(w.LOCATIONS)}')} AS location,
  'https://docs.example.com/' || (doc_id % 400) AS url, text AS description, lang, doc_id FROM documents)"""

USERS = """profiles AS (SELECT CAST(s_suppkey AS VARCHAR) AS id,
  CASE WHEN s_suppkey % 11 = 0 THEN '  ' ELSE ' u' || s_suppkey || '@example.com ' END AS email,
  CASE WHEN s_suppkey % 3 = 0 THEN 'pro' ELSE 'free' END AS tier, s_suppkey % 7 <> 0 AS job_alerts_enabled,
  CASE WHEN s_suppkey % 4 <> 0 THEN [(['swe', 'ds', 'analyst', 'SWE ', 'finance'])[1 + s_suppkey % 5], 'consulting'] END AS target_roles,
  CASE WHEN s_suppkey % 3 <> 0 THEN ['entry_level', 'new_grad'] ELSE [] END AS wanted_levels,
  s_suppkey % 2 = 0 AS has_vector, s_suppkey FROM supplier),
users AS (SELECT id AS user_id, trim(email) AS email, tier, has_vector, wanted_levels,
  CASE WHEN target_roles IS NULL THEN [] ELSE list_transform(target_roles, lambda r: lower(trim(r))) END AS wanted_roles
  FROM profiles WHERE job_alerts_enabled AND trim(email) <> ''),
scores AS (SELECT CAST(l_suppkey AS VARCHAR) AS user_id, CAST(l_orderkey AS VARCHAR) AS job_id,
  0.5::DOUBLE + max(l_quantity) / 100 AS similarity FROM lineitem GROUP BY 1, 2),
graded AS (SELECT *, CASE WHEN similarity > 0.85 THEN 'A' WHEN similarity > 0.75 THEN 'B' WHEN similarity > 0.65 THEN 'C'
  WHEN similarity > 0.55 THEN 'D' ELSE 'F' END AS grade FROM scores),
applied AS (SELECT CAST(l_suppkey AS VARCHAR) AS user_id, CAST(l_orderkey AS VARCHAR) AS job_id,
  (['applied', 'phone_screen', 'oa', 'interview', 'offer', 'rejected', 'withdrawn'])[1 + max(l_linenumber) % 7] AS status,
  max(l_shipdate) AS applied_at, max(l_linenumber) % 3 AS interview_count
  FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2),
sent AS (SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS user_id, CAST(l_orderkey AS VARCHAR) AS job_id
  FROM lineitem WHERE l_returnflag = 'A' AND l_tax < 0.03),
seen AS (SELECT user_id, job_id FROM applied UNION SELECT user_id, job_id FROM sent)"""


def greedy(candidates: str, limit: int) -> str:
    """Recursive scan over ``candidates(grp, rn, keys)``: which positions are kept."""
    return f"""scan AS (
  SELECT grp, 0::BIGINT AS rn, []::VARCHAR[] AS seen, 0 AS n, false AS kept FROM {candidates} WHERE rn = 1
  UNION ALL
  SELECT s.grp, c.rn, CASE WHEN list_has_any(s.seen, c.keys) THEN s.seen ELSE list_concat(s.seen, c.keys) END,
    s.n + CASE WHEN list_has_any(s.seen, c.keys) THEN 0 ELSE 1 END, NOT list_has_any(s.seen, c.keys)
  FROM scan s JOIN {candidates} c ON c.grp = s.grp AND c.rn = s.rn + 1 WHERE s.n < {limit})"""
