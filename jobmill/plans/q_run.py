"""A whole run over all postings: each is landed in the form of its own source."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import run
from ..functions.classify import BOARD_TECH_WORDS, REMOTE_BOARD_TECH_WORDS, TAG_WORDS, TAGGED_TITLE_WORDS
from ..operators import dedup
from ..schema import RAW_PAYLOAD
from ..session import shared_folder
from . import oracle as o
from . import workload as w
from .q_sources import (
    _CURATED,
    BLANK,
    _cell,
    _day,
    _epoch,
    _iso,
    _item,
    _listing,
    _name,
    _row,
    as_json,
    expect,
    first_by,
    lines,
    payloads,
)
from .registry import query

#: This source's fetch fails in the run.
FAILED = "workday"
OUT = ("dedup_hash", "source", "title", "company", "url", "is_active")


def _greenhouse(rows):
    item = _item(
        id=F.col("source_id"), title=F.col("title"), location=_name("location", "name"),
        content=F.col("description"), absolute_url=F.col("url"), updated_at=_iso(),
    )
    body = payloads(rows, item, as_json("jobs"))
    owner = F.concat(F.lit('{"company":{"name":"Board '), "fetch_seq", F.lit('"},'))
    return body.withColumn("body", F.concat(owner, F.expr("substring(body, 2)")))


def _table(head, *cells):
    return lambda rows: payloads(rows, _row(*cells), lines(head))


def _json(path, key=None, **fields):
    return lambda rows: payloads(rows, _item(**fields), as_json(path), key)


def _forms():
    """How the postings of each source land."""
    seq, title, company, url = F.col("ingest_seq"), F.col("title"), F.col("company"), F.col("url")
    description, place, own = F.col("description"), F.col("location"), F.col("source_id")
    jobright = "| Company | Job Title | Location | Work Model | Date Posted |\n| ----- | --------- | --------- | ---- | ------- |\n"
    zapply = "| Company | Role | Location(s) | Posted | Level | Apply |\n|:---|---|---|---|---|---|\n"
    return {
        "pittcsc": lambda rows: payloads(rows, _listing("is_visible"), as_json()),
        "simplify_internships": lambda rows: payloads(rows, _listing("is_visible"), as_json()),
        "jobright_swe": _table(
            jobright, F.concat(F.lit("**"), _cell("company"), F.lit("**")),
            F.concat(F.lit("**["), _cell("title"), F.lit("]("), "url", F.lit(")**")), _cell("location"),
            F.when(seq % 6 == 0, "Remote").otherwise("On Site"), _day(),
        ),
        "zapplyjobs": _table(
            zapply, F.concat(F.lit("\U0001f3e2 **"), _cell("company"), F.lit("**")), _cell("title"), _cell("location"),
            _day(), F.lit("mid"), F.concat(F.lit("[Apply]("), "url", F.lit(")")),
        ),
        "adzuna": _json(
            "results", id=own, title=title, company=_name("company", "display_name"),
            location=_name("location", "display_name"), redirect_url=url, description=description, created=_iso(),
        ),
        "remoteok": _json("", slug=own, id=own, position=title, company=company, url=url, description=description, epoch=_epoch()),
        "arbeitnow": _json(
            "data", slug=own, title=title, company_name=company, location=place, remote=seq % 4 == 0, url=url,
            description=description, tags=F.array(F.when(seq % 9 == 0, "Python").otherwise("Office")), created_at=_epoch(),
        ),
        "jobspy": _json(
            "jobs", site=F.col("source"), title=title, company=company, location=place, jobUrl=url,
            description=description, datePosted=_iso(),
        ),
        "greenhouse": _greenhouse,
        "lever": _json(
            "", F.lit("o3-world"), id=own, text=title, categories=_name("location", "location"), hostedUrl=url,
            descriptionPlain=description, createdAt=_epoch() * 1000,
        ),
        FAILED: lambda rows: payloads(rows, F.lit("down"), lines()),
        "ashby": _json(
            "jobs", F.lit("acme-labs"), id=own, title=title, location=place, jobUrl=url, isListed=seq % 12 != 0,
            employmentType=F.when(seq % 12 == 6, "Contract").otherwise("FullTime"), isRemote=seq % 4 == 0,
            descriptionPlain=description, publishedAt=_iso(),
        ),
    }


_EXPECTED = {
    "pittcsc": dict(location=BLANK, level="'new_grad'", where="ingest_seq % 7 <> 0"),
    "simplify_internships": dict(location=BLANK, level="'internship'", where="ingest_seq % 7 <> 0"),
    "jobright_swe": dict(_CURATED, remote=f"ingest_seq % 6 = 0 OR {o.remote('location')}"),
    "zapplyjobs": _CURATED,
    "adzuna": dict(location=BLANK),
    "remoteok": dict(location="'Remote'", remote="true", where=o.words("lower(title)", REMOTE_BOARD_TECH_WORDS)),
    "arbeitnow": dict(
        location=BLANK, remote="ingest_seq % 4 = 0",
        where=f"{o.words('lower(title)', TAG_WORDS + TAGGED_TITLE_WORDS)} OR ingest_seq % 9 = 0",
    ),
    "jobspy": dict(source_id="url", location=BLANK, keep=first_by("dedup_hash")),
    "greenhouse": dict(company="'Board ' || (ingest_seq // 50)", location=BLANK, where=o.words("lower(title)", BOARD_TECH_WORDS)),
    "lever": dict(company="'O3 World'", location=BLANK, where=o.words("lower(title)", BOARD_TECH_WORDS)),
    "ashby": dict(
        company="'Acme Labs'", location=f"coalesce(nullif({o.trim('location')}, ''), 'Remote')",
        where=f"url <> '' AND ingest_seq % 6 <> 0 AND NOT {o.non_us('location')}",
        remote=f"ingest_seq % 4 = 0 OR {o.remote('location')}",
    ),
}


def _source_sql(name: str) -> str:
    """Postings of one source, with what later steps need."""
    shown = "'jobspy_' || lower(source)" if name == "jobspy" else o.lit(name)
    sql = expect(shown, **_EXPECTED[name])
    sql = sql.replace(" FROM ranked WHERE ", f" FROM (SELECT * FROM ranked WHERE source = {o.lit(name)}) ranked WHERE ")
    return sql.replace("dedup_hash FROM kept", "dedup_hash, description, posted AS posted_at, ingest_seq FROM kept")


_NAMES = ", ".join(map(o.lit, w.RUN_ORDER))
_FETCHED = " UNION ALL ".join(
    f"SELECT {o.lit(name)} AS run_source, {w.RUN_ORDER.index(name)} AS source_rank, * FROM ({_source_sql(name)})"
    for name in _EXPECTED
)
_SHARED = f"source IN ({', '.join(map(o.lit, dedup.CURATED_SOURCES))}) AND {o.canonical_url('url')} <> ''"
_BATCH = f"""fetched AS MATERIALIZED ({_FETCHED}),
placed AS (SELECT *, {_SHARED} AS shared, row_number() OVER (PARTITION BY {_SHARED}, {o.canonical_url('url')}
  ORDER BY source_rank, ingest_seq) AS place FROM fetched),
batch AS MATERIALIZED (SELECT * FROM placed WHERE NOT shared OR place = 1)"""
_RUN = (
    o.GUARDS.replace(f"batch AS (SELECT * FROM hashed WHERE ordered_at >= TIMESTAMP '{w.BATCH_START}')", _BATCH)
    .replace("snapshot AS (", "snapshot AS MATERIALIZED (")
    .replace(
        "SELECT DISTINCT source, source <> 'lever' AS success FROM hashed",
        f"SELECT unnest([{_NAMES}]) AS source, unnest([{_NAMES}]) <> {o.lit(FAILED)} AS success",
    )
)


def _landed(spark, d) -> DataFrame:
    """All postings as payloads of their sources, in a landing table."""
    path = f"{shared_folder(spark)}/landing-{uuid.uuid4()}"
    rows, parts = w.raw_postings(spark, d), []
    for name, render in _forms().items():
        own = render(rows.filter(F.col("source") == name))
        status = F.lit(503 if name == FAILED else 200)
        parts.append(own.select(
            F.lit(name).alias("source"), "run_id", "fetch_seq", "request_key", status.alias("status"),
            F.lit("text/plain").alias("content_type"), "body",
        ))
    run.land(dedup.union_all(parts), path)
    return run.landed_run(spark, path, "run1").select(*[f.split(" ")[0] for f in RAW_PAYLOAD.split(", ")])


def _run(spark, d) -> run.Run:
    names = spark.range(1).select(F.lit("acme-labs").alias("request_key"), F.lit("Acme Labs").alias("company_name"))
    out = f"{shared_folder(spark)}/run-{uuid.uuid4()}"
    return run.run_all_sources(
        _landed(spark, d), w.snapshot(spark, d), out, w.as_of(), names=w.RUN_ORDER, tables={"ashby": names}
    )


@query(
    "run_all_sources",
    f"""WITH {_RUN}, gone AS (SELECT s.source, s.dedup_hash FROM stale s JOIN decided USING (source) WHERE decision = 'retire')
    SELECT m.dedup_hash, m.source, m.title, m.company, m.url, m.is_active AND g.dedup_hash IS NULL AS is_active,
      strftime(m.posted_at, '%Y-%m-%d') AS posted
    FROM merged m LEFT JOIN gone g ON g.source = m.source AND g.dedup_hash = m.dedup_hash""",
)
def run_all_sources(spark, d):
    return _run(spark, d).jobs.select(*OUT, F.date_format("posted_at", "yyyy-MM-dd").alias("posted"))


@query(
    "run_report",
    f"""WITH {_RUN}, n AS (SELECT source, list_position([{_NAMES}], source) - 1 AS source_rank,
      count(DISTINCT ingest_seq // 50) AS payloads FROM ranked GROUP BY source),
    f AS (SELECT run_source AS source, count(*) AS fetched, count(*) FILTER (trim(coalesce(description, '')) <> '') AS with_description
      FROM fetched GROUP BY 1),
    k AS (SELECT run_source AS source, count(*) AS kept FROM batch GROUP BY 1)
    SELECT n.source, CAST(n.source_rank AS INTEGER) AS source_rank, n.source <> {o.lit(FAILED)} AS success, n.payloads,
      CASE WHEN n.source = {o.lit(FAILED)} THEN n.payloads ELSE 0 END AS failed_payloads, coalesce(f.fetched, 0) AS fetched,
      coalesce(k.kept, 0) AS kept, d.fresh, d.active, d.stale, d.decision,
      CASE WHEN d.decision = 'retire' THEN d.stale ELSE 0 END AS retired
    FROM n LEFT JOIN f USING (source) LEFT JOIN k USING (source) JOIN decided d USING (source)""",
)
def run_report(spark, d):
    return _run(spark, d).report.drop("with_description")
