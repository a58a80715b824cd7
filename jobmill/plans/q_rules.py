"""Queries over classification and location rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import classify as c
from ..functions import location as loc
from ..functions.packs_levels import RESCUE
from ..functions.regex import has_word
from ..sources.canonical import normalize_posting
from . import oracle as o
from . import workload as w
from .registry import query


def _joined(col):
    return F.array_join(col, ",")


@query("c1_match_any", f"SELECT doc_id, {o.words('lower(text)', RESCUE)} AS hit FROM documents")
def match_any(spark, d):
    return w.table(spark, d, "documents").select("doc_id", has_word(F.lower("text"), RESCUE).alias("hit"))


@query("c2_infer_roles", f"WITH {o.RAW} SELECT source_id, title, {o.roles('title')} AS roles FROM raw")
def infer_roles(spark, d):
    return w.raw_postings(spark, d).select(
        "source_id", "title", _joined(c.infer_roles(F.col("title"))).alias("roles")
    )


@query("c3_target_roles", f"WITH {o.TEXTS}, b AS (SELECT id, title || chr(10) || description AS t FROM texts) SELECT id, {o.target_roles('t')} AS roles FROM b")
def target_roles(spark, d):
    both = F.concat_ws("\n", "title", "description")
    return w.text_postings(spark, d).select("id", _joined(c.infer_target_roles(both)).alias("roles"))


@query("c4_tech_signal", f"SELECT doc_id, {o.tech_signal('text')} AS signal FROM documents")
def tech_signal(spark, d):
    return w.table(spark, d, "documents").select("doc_id", c.has_tech_signal(F.col("text")).alias("signal"))


@query("c5_classify_experience", f"WITH {o.TEXTS} SELECT id, {o.level('title', 'description')} AS level FROM texts")
def classify_experience(spark, d):
    level = c.classify_experience(F.col("title"), F.col("description"))
    return w.text_postings(spark, d).select("id", level.alias("level"))


@query("c5b_explain_experience", f"WITH {o.TEXTS} SELECT id, {o.level_stage('title', 'description')} AS stage FROM texts")
def explain_experience(spark, d):
    stage = c.explain_experience(F.col("title"), F.col("description"))
    return w.text_postings(spark, d).select("id", stage.alias("stage"))


@query("c6_early_career", f"WITH {o.TEXTS} SELECT id, {o.early_career('title', 'description')} AS passes FROM texts")
def early_career(spark, d):
    passes = c.passes_early_career(F.col("title"), F.col("description"))
    return w.text_postings(spark, d).select("id", passes.alias("passes"))


_EXPERIENCE = ["entry_level", "student_college", "mid_level", "executive", " Entry_Level", None, "other"]
_EMPLOYMENT = ["fulltime", None, "internship", "parttime"]
_BOARD_IDS = ["associate", "entry_level", "mid_senior_level", "internship", None, "director"]
_LEVEL_BASE = (
    f"base AS (SELECT source_id, title, description, {o.level('title')} AS plain, {o.level('title', 'description')} AS full_level, "
    f"lower(trim({o.pick(_EXPERIENCE, 'ingest_seq % 7')})) AS exp, {o.pick(_EMPLOYMENT, 'o_custkey % 4')} AS emp, "
    f"{o.pick(_BOARD_IDS, 'ingest_seq % 6')} AS bid, CAST(ingest_seq % 15 AS INTEGER) AS grade FROM raw)"
)


@query(
    "c7_structured_level",
    f"""WITH {o.RAW}, {_LEVEL_BASE}
    SELECT source_id, CASE WHEN emp = 'internship' OR exp IN ('student_college', 'student_school') THEN 'internship'
      WHEN exp IN ('experienced', 'mid_level', 'manager', 'senior_manager', 'executive') THEN 'reject'
      WHEN exp = 'entry_level' THEN CASE WHEN regexp_matches(title, '(?i)\\bintern(ship)?\\b') THEN 'internship' ELSE 'entry_level' END END AS by_codes,
    CASE WHEN bid IN ('mid_senior_level', 'director', 'executive') OR plain IS NULL THEN NULL WHEN bid = 'internship' THEN 'internship'
      WHEN bid IN ('associate', 'entry_level') AND plain NOT IN ('internship', 'new_grad') THEN 'entry_level' ELSE plain END AS by_board,
    CASE WHEN full_level IS NULL OR grade >= 12 THEN NULL WHEN grade = 0 THEN full_level WHEN grade <= 7 THEN 'entry_level'
      WHEN grade <= 9 THEN 'new_grad' ELSE 'entry_level' END AS by_grade FROM base""",
)
def structured_level(spark, d):
    seq, title = F.col("ingest_seq"), F.col("title")
    return w.raw_postings(spark, d).select(
        "source_id",
        c.level_from_codes(w.pick(_EXPERIENCE, seq % 7), w.pick(_EMPLOYMENT, F.col("o_custkey") % 4), title).alias("by_codes"),
        c.level_from_board_id(w.pick(_BOARD_IDS, seq % 6), title).alias("by_board"),
        c.level_from_grade((seq % 15).cast("string"), title, F.col("description")).alias("by_grade"),
    )


_GATE_URL = (
    "CASE ingest_seq % 4 WHEN 0 THEN 'https://a.wd1.myworkdayjobs.com/Site/job/x_1' WHEN 1 THEN 'https://a.wd1.myworkdayjobs.com/en-US/Site' "
    "WHEN 2 THEN 'https://a.wd1.myworkdayjobs.com/Site/job/invalid-url' ELSE 'https://b.wd5.myworkdayjobs.com/S/job/y_2' END"
)
_GATE_COMPANIES = ["nvidia", "acme", "Cisco", "kohls"]


def _gate_sql() -> str:
    from ..functions import packs_gates as g

    t, p = "lower(title)", o.padded("title")
    protected = o.patterns(t, g.PROTECTED_TECH)
    software = o.words(p, g.SOFTWARE_CONTEXT)
    companies = ", ".join(map(o.lit, g.TECH_COMPANIES))
    non_tech = (
        f"(NOT {protected} AND (({t} LIKE '%process engineer%' AND NOT regexp_matches({t}, '\\b(?:software|data)\\s+process engineer\\b')) "
        f"OR ({t} LIKE '%quality assurance%' AND NOT {software}) OR ({t} LIKE '%field engineer%' AND NOT {software}) "
        f"OR ({t} LIKE '%financial analyst%' AND lower(gate_company) NOT IN ({companies})) OR {o.words(t, g.NON_TECH_TITLES)}))"
    )
    senior = (
        f"({o.words(p, g.SENIOR_SALES_TITLES)} OR ({p} LIKE '%consultant%' AND {p} NOT LIKE '%associate consultant%' "
        f"AND {p} NOT LIKE '%junior consultant%'))"
    )
    return (
        f"CASE WHEN {o.level('title')} IS NULL THEN 'level' WHEN {senior} THEN 'senior_title' WHEN {o.non_us('location')} THEN 'non_us' "
        f"WHEN {non_tech} THEN 'non_tech' WHEN gate_url LIKE '%invalid-url%' OR gate_url NOT LIKE '%/job/%' THEN 'bad_url' END"
    )


GATE_CTE = (
    f"gate_in AS (SELECT *, {_GATE_URL} AS gate_url, {o.pick(_GATE_COMPANIES, 'o_custkey % 4')} AS gate_company FROM hashed), "
    f"gated AS (SELECT *, {_gate_sql()} AS reason FROM gate_in)"
)


def gated_postings(spark, d):
    seq = F.col("ingest_seq")
    urls = [
        "https://a.wd1.myworkdayjobs.com/Site/job/x_1", "https://a.wd1.myworkdayjobs.com/en-US/Site",
        "https://a.wd1.myworkdayjobs.com/Site/job/invalid-url", "https://b.wd5.myworkdayjobs.com/S/job/y_2",
    ]
    reason = c.staged_reject_reason(
        F.col("title"), w.pick(_GATE_COMPANIES, F.col("o_custkey") % 4), F.col("location"), w.pick(urls, seq % 4)
    )
    return w.hashed_postings(spark, d).withColumn("reason", reason)


@query("c8_staged_filter", f"WITH {o.HASHED}, {GATE_CTE} SELECT source_id, reason FROM gated")
def staged_filter(spark, d):
    return gated_postings(spark, d).select("source_id", "reason")


@query(
    "c9_tech_prefilter",
    f"""WITH {o.RAW} SELECT source_id, {o.words('lower(title)', c.BOARD_TECH_WORDS)} AS board,
    {o.words('lower(title)', c.REMOTE_BOARD_TECH_WORDS)} AS remote_board,
    {o.words('lower(title)', c.TAG_WORDS + c.TAGGED_TITLE_WORDS)} OR ingest_seq % 9 = 0 AS tagged,
    {o.tech_signal('title')} OR {o.roles('title')} <> '' AS signal FROM raw""",
)
def tech_prefilter(spark, d):
    title = F.col("title")
    tags = F.array(F.when(F.col("ingest_seq") % 9 == 0, "Python").otherwise("sales"), F.lit("office"))
    return w.raw_postings(spark, d).select(
        "source_id",
        c.tech_prefilter(title).alias("board"),
        c.tech_prefilter(title, kind="remote_board").alias("remote_board"),
        c.tech_prefilter(title, tags, kind="tagged").alias("tagged"),
        c.tech_prefilter(title, kind="signal").alias("signal"),
    )


@query("c10_infer_remote", f"WITH {o.RAW} SELECT source_id, {o.remote('location')} AS remote FROM raw")
def infer_remote(spark, d):
    return w.raw_postings(spark, d).select("source_id", loc.infer_remote(F.col("location")).alias("remote"))


def spelled_roles():
    seq, cust = F.col("ingest_seq"), F.col("o_custkey")
    return F.array(w.pick(w.ROLE_SPELLINGS, seq % 7), w.pick(w.ROLE_SPELLINGS, cust % 7), F.lit("swe"))


SPELLED = (
    f"spelled AS (SELECT *, list_transform([{o.pick(w.ROLE_SPELLINGS, 'ingest_seq % 7')}, {o.pick(w.ROLE_SPELLINGS, 'o_custkey % 7')}, 'swe'], "
    "lambda r: lower(trim(r))) AS spelled FROM hashed), "
    "known AS (SELECT *, list_filter(spelled, lambda r: r <> 'wizard') AS k FROM spelled), "
    "uniq AS (SELECT *, list_filter([CASE WHEN len(k) >= 1 THEN k[1] END, CASE WHEN len(k) >= 2 AND k[2] <> k[1] THEN k[2] END, "
    "CASE WHEN len(k) >= 3 AND k[3] <> k[1] AND k[3] <> k[2] THEN k[3] END], lambda r: r IS NOT NULL) AS u FROM known)"
)


@query(
    "c11_normalize_roles",
    f"WITH {o.HASHED}, {SPELLED} SELECT source_id, array_to_string(u, ',') AS loose, "
    "CASE WHEN NOT list_contains(spelled, 'wizard') THEN array_to_string(u, ',') END AS strict FROM uniq",
)
def normalize_roles(spark, d):
    spelled = spelled_roles()
    return w.raw_postings(spark, d).select(
        "source_id",
        _joined(c.normalize_roles(spelled)).alias("loose"),
        _joined(c.normalize_roles(spelled, strict=True)).alias("strict"),
    )


@query(
    "c12_normalize_posting",
    f"""WITH {o.TEXTS}, g AS (SELECT *, {o.remote('location')} AS remote, nullif({o.trim('location')}, '') AS place,
      nullif({o.trim('description')}, '') AS body FROM texts),
    k AS (SELECT *, {o.usa('place', 'remote')} AS is_usa, {o.level('title', 'body')} AS level FROM g
      WHERE NOT (place IS NOT NULL AND {o.non_us('place')} AND NOT ({o.usa('place', 'remote')})) AND {o.early_career('title', 'body')})
    SELECT id AS source_id, title, company, place AS location, remote, is_usa, level AS experience_level, {o.roles('title')} AS roles,
      {o.posting_hash('company', 'title', 'place')} AS dedup_hash FROM k WHERE level IS NOT NULL""",
)
def normalize(spark, d):
    rows = w.text_postings(spark, d).withColumn("source_id", F.col("id")).withColumn("ingest_seq", F.col("doc_id"))
    return normalize_posting(rows, "detail_board").select(
        "source_id", "title", "company", "location", "remote", "is_usa", "experience_level",
        _joined(F.col("roles")).alias("roles"), "dedup_hash",
    )


@query(
    "c13_profile_levels",
    """SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'entry_level,new_grad' WHEN 1 THEN 'internship' ELSE '' END AS levels FROM supplier""",
)
def profile_levels(spark, d):
    key = F.col("s_suppkey") % 3
    labels = (
        F.when(key == 0, F.array(F.lit("Entry Level"), F.lit("Boss"), F.lit("New Grad"), F.lit("entry_level")))
        .when(key == 1, F.array(F.lit("Internship"), F.lit("internship")))
        .otherwise(F.array(F.lit("entry level")))
    )
    return w.table(spark, d, "supplier").select("s_suppkey", _joined(c.map_profile_levels(labels)).alias("levels"))


@query("l1_is_usa", f"WITH {o.RAW} SELECT source_id, {o.usa('location')} AS is_usa, {o.usa('location', o.remote('location'))} AS with_remote FROM raw")
def is_usa(spark, d):
    place = F.col("location")
    return w.raw_postings(spark, d).select(
        "source_id",
        loc.is_usa(place).alias("is_usa"),
        loc.is_usa(place, loc.infer_remote(place)).alias("with_remote"),
    )


@query("l2_is_non_us", f"WITH {o.RAW} SELECT source_id, {o.non_us('location')} AS non_us FROM raw")
def is_non_us(spark, d):
    return w.raw_postings(spark, d).select("source_id", loc.is_non_us(F.col("location")).alias("non_us"))


@query("l3_us_like", f"WITH {o.RAW} SELECT source_id, {o.us_like('location')} AS us_like FROM raw")
def us_like(spark, d):
    return w.raw_postings(spark, d).select("source_id", loc.us_like(F.col("location")).alias("us_like"))


def _office_sql(place: str) -> str:
    states, names = loc._STATES, loc._STATE_NAMES
    us = o.patterns(place, [
        r"\b(?:united states|united states of america|usa|u\.s\.|us-only|us remote|remote us)\b", r"^\d+\s+locations?$",
        rf"(?:^|,\s)(?:{states})(?:\b|,|\s|$)", rf"\b(?:{names})\b",
    ])
    return f"({us} OR {o.words(f'lower({place})', loc.OFFICE_CITIES)})"


@query(
    "l4_keep_office",
    f"""WITH {o.RAW} SELECT source_id, coalesce(location, '') = '' OR lower(location) LIKE '%remote%' OR lower(description) LIKE '%remote%'
    OR ingest_seq % 8 = 0 OR {_office_sql('location')} AS keep FROM raw""",
)
def keep_office(spark, d):
    more = F.array(F.lit("Second office"), F.when(F.col("ingest_seq") % 8 == 0, "Fully REMOTE"))
    keep = loc.keep_office(F.col("location"), F.col("description"), more)
    return w.raw_postings(spark, d).select("source_id", keep.alias("keep"))


@query("l5_usa_or_other", f"WITH {o.CLASSIFIED} SELECT source_id, location FROM classified WHERE NOT is_usa")
def usa_or_other(spark, d):
    from ..operators.feed import usa_or_other as filter_place

    return filter_place(w.classified_postings(spark, d), "other").select("source_id", "location")


@query(
    "classified_postings",
    f"WITH {o.CLASSIFIED} SELECT coalesce(experience_level, 'rejected') AS level, roles, is_usa, remote, count(*) AS postings FROM classified GROUP BY ALL",
)
def classified(spark, d):
    level = F.coalesce("experience_level", F.lit("rejected"))
    return (
        w.classified_postings(spark, d)
        .groupBy(level.alias("level"), _joined(F.col("roles")).alias("roles"), "is_usa", "remote")
        .agg(F.count("*").alias("postings"))
    )
