"""Round trips through the adapters.

Payload texts (JSON bodies, Markdown tables, XML, HTML) are rendered from the posting view
in Spark and parsed back; the SQL selects the same fields straight from the view. A payload
holds at most ``PER_PAYLOAD`` entries, so no payload grows with the data.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.classify import BOARD_TECH_WORDS, REMOTE_BOARD_TECH_WORDS, TAG_WORDS, TAGGED_TITLE_WORDS
from ..operators import dedup
from ..session import shared_folder
from ..sources import boards, lists, pages, readers, store, thread
from . import oracle as o
from . import workload as w
from .q_rules import GATE_CTE, _office_sql
from .registry import query

PER_PAYLOAD = 50
STAMP = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def payloads(rows: DataFrame, item: Column, render: Callable[[Column], Column], key: Column | None = None) -> DataFrame:
    """One payload per ``PER_PAYLOAD`` consecutive postings (and key).

    Spread by number alone: a constant key is no grouping key to the optimizer, so spread
    by it as well the rows would be shuffled again and land in few tasks, half as many as
    there are cores where two forms of payloads form a union.
    """
    request_key = F.lit("acme") if key is None else key
    tasks = 2 * rows.sparkSession.sparkContext.defaultParallelism
    keyed = rows.withColumns(
        {"fetch_seq": F.floor(F.col("ingest_seq") / PER_PAYLOAD), "request_key": request_key}
    ).repartition(tasks, "fetch_seq")
    grouped = keyed.groupBy("fetch_seq", "request_key").agg(
        F.sort_array(F.collect_list(F.struct("ingest_seq", item.alias("item")))).alias("rows")
    )
    items = F.transform("rows", lambda r: r["item"])
    return grouped.select(
        F.lit("run1").alias("run_id"), "request_key", "fetch_seq", render(items).alias("body")
    )


def as_json(path: str = "") -> Callable[[Column], Column]:
    """The items as a JSON array, at the root or inside objects."""

    def render(items: Column) -> Column:
        text = F.to_json(items)
        for name in reversed(path.split(".")) if path else ():
            text = F.concat(F.lit(f'{{"{name}":'), text, F.lit("}"))
        return text

    return render


def lines(head: str = "", tail: str = "", between: str = "\n") -> Callable[[Column], Column]:
    return lambda items: F.concat(F.lit(head), F.array_join(items, between), F.lit(tail))


def escaped(col: Column) -> Column:
    text = F.regexp_replace(F.coalesce(col, F.lit("")), "&", "&amp;")
    return F.regexp_replace(text, "<", "&lt;")


def shown(df: DataFrame) -> DataFrame:
    return df.select(
        "source", "source_id", "title", "company", "location", "remote", "is_usa", "url",
        "experience_level", F.array_join("roles", ",").alias("roles"),
        F.date_format("posted_at", "yyyy-MM-dd").alias("posted"), "dedup_hash",
    )


def expect(
    source: str,
    source_id: str = "source_id",
    title: str = "title",
    company: str = "company",
    location: str = "location",
    url: str = "url",
    level: str | None = None,
    remote: str | None = None,
    posted: str = "posted_at",
    where: str = "true",
    keep: str = "",
    roles: str | None = None,
    hash_company: str | None = None,
    frm: str = "ranked",
    ctes: str = "",
    after: str = "true",
) -> str:
    """SQL for an adapter: mapped fields, filters, level, and ``keep`` as the dedup clause."""
    level = level or o.level("title", "description")
    remote = remote or o.remote("location")
    return f"""WITH {o.RAW}{', ' + ctes if ctes else ''},
    mapped AS (SELECT {source} AS source, {source_id} AS source_id, {title} AS title, {company} AS company, {location} AS location,
      {url} AS url, {posted} AS posted, {hash_company or company} AS hash_company, description, ingest_seq, o_custkey, nation
      FROM {frm} WHERE {where}),
    rated AS (SELECT *, {level} AS experience_level, {remote} AS remote, {o.posting_hash('hash_company', 'title', 'location')} AS dedup_hash FROM mapped),
    kept AS (SELECT * FROM rated WHERE {after} {keep})
    SELECT source, source_id, title, company, location, remote, {o.usa('location', 'remote')} AS is_usa, url, experience_level,
      {roles or o.roles('title')} AS roles, strftime(posted, '%Y-%m-%d') AS posted, dedup_hash FROM kept WHERE experience_level IS NOT NULL"""


def first_by(key: str) -> str:
    return f"QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY ingest_seq) = 1"


def last_by(key: str) -> str:
    return f"QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY ingest_seq DESC) = 1"


BLANK = "coalesce(location, '')"
LOC = "nullif(location, '')"
_iso = lambda: F.date_format("posted_at", STAMP)
_epoch = lambda: F.unix_timestamp("posted_at")


def _item(**fields: Column) -> Column:
    return F.struct(*[v.alias(k) for k, v in fields.items()])


def _raw(spark, d):
    return w.raw_postings(spark, d)


def _name(col: str, *path: str) -> Column:
    """The column wrapped in single-field objects."""
    out = F.col(col)
    for step in reversed(path):
        out = F.struct(out.alias(step))
    return out


# -- JSON boards --------------------------------------------------------------------------


@query(
    "s1_json_items",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""",
)
def json_items(spark, d):
    """Event properties as array elements, under a nested path."""
    key = F.col("event_id")
    body = F.concat(
        F.lit('{"data":{"jobs":['),
        F.array_join(
            F.collect_list(F.concat(F.lit('{"event":'), key, F.lit(',"props":'), "props", F.lit("}"))), ","
        ),
        F.lit("]}}"),
    )
    landed = (
        w.table(spark, d, "events")
        .groupBy(F.floor(key / 100).alias("fetch_seq"))
        .agg(body.alias("body"))
        .withColumns({"run_id": F.lit("run1"), "request_key": F.lit("events")})
    )
    item = "event: bigint, props: struct<k: bigint>"
    return readers.json_items(landed, item, ["jobs", "data.jobs"]).select(
        F.col("event").alias("event_id"), F.col("props.k").alias("k")
    )


@query(
    "s1_greenhouse",
    expect(
        "'greenhouse'", company="'Board ' || (ingest_seq // 50)", location=BLANK,
        where=o.words("lower(title)", BOARD_TECH_WORDS),
    ),
)
def greenhouse(spark, d):
    item = _item(
        id=F.col("source_id"), title=F.col("title"), location=_name("location", "name"),
        content=F.col("description"), absolute_url=F.col("url"), updated_at=_iso(),
    )
    body = payloads(_raw(spark, d), item, as_json("jobs"))
    owner = F.concat(F.lit('{"company":{"name":"Board '), "fetch_seq", F.lit('"},'))
    return shown(boards.greenhouse(body.withColumn("body", F.concat(owner, F.substring("body", 2, 1 << 30)))))


@query(
    "s1_lever",
    expect(
        "'lever'", company="'O3 World'", location=BLANK, where=o.words("lower(title)", BOARD_TECH_WORDS)
    ),
)
def lever(spark, d):
    item = _item(
        id=F.col("source_id"), text=F.col("title"), categories=_name("location", "location"),
        hostedUrl=F.col("url"), descriptionPlain=F.col("description"), createdAt=_epoch() * 1000,
    )
    return shown(boards.lever(payloads(_raw(spark, d), item, as_json(), F.lit("o3-world"))))


@query(
    "s1_ashby",
    expect(
        "'ashby'", company="'Acme Labs'", location=f"coalesce(nullif({o.trim('location')}, ''), 'Remote')",
        where=f"url <> '' AND ingest_seq % 6 <> 0 AND NOT {o.non_us('location')}",
        remote=f"ingest_seq % 4 = 0 OR {o.remote('location')}",
    ),
)
def ashby(spark, d):
    seq = F.col("ingest_seq")
    item = _item(
        id=F.col("source_id"), title=F.col("title"), location=F.col("location"), jobUrl=F.col("url"),
        isListed=seq % 12 != 0, employmentType=F.when(seq % 12 == 6, "Contract").otherwise("FullTime"),
        isRemote=seq % 4 == 0, descriptionPlain=F.col("description"), publishedAt=_iso(),
    )
    names = spark.range(1).select(F.lit("acme-labs").alias("request_key"), F.lit("Acme Labs").alias("company_name"))
    return shown(boards.ashby(payloads(_raw(spark, d), item, as_json("jobs"), F.lit("acme-labs")), names))


@query(
    "s1_adzuna",
    expect("'adzuna'", company="company", location=BLANK, url="url || '&utm_source=feed'"),
)
def adzuna(spark, d):
    item = _item(
        id=F.col("source_id"), title=F.col("title"), company=_name("company", "display_name"),
        location=_name("location", "display_name"), redirect_url=F.col("url"),
        description=F.col("description"), created=_iso(),
    )
    return shown(boards.adzuna(payloads(_raw(spark, d), item, as_json("results")), "&utm_source=feed"))


@query(
    "s1_remoteok",
    expect("'remoteok'", location="'Remote'", remote="true", where=o.words("lower(title)", REMOTE_BOARD_TECH_WORDS)),
)
def remoteok(spark, d):
    item = _item(
        slug=F.col("source_id"), id=F.col("source_id"), position=F.col("title"), company=F.col("company"),
        url=F.col("url"), description=F.col("description"), epoch=_epoch(),
    )
    return shown(boards.remoteok(payloads(_raw(spark, d), item, as_json())))


@query(
    "s1_arbeitnow",
    expect(
        "'arbeitnow'", location=BLANK, remote="ingest_seq % 4 = 0",
        where=f"{o.words('lower(title)', TAG_WORDS + TAGGED_TITLE_WORDS)} OR ingest_seq % 9 = 0",
    ),
)
def arbeitnow(spark, d):
    seq = F.col("ingest_seq")
    item = _item(
        slug=F.col("source_id"), title=F.col("title"), company_name=F.col("company"), location=F.col("location"),
        remote=seq % 4 == 0, url=F.col("url"), description=F.col("description"),
        tags=F.array(F.when(seq % 9 == 0, "Python").otherwise("Office")), created_at=_epoch(),
    )
    return shown(boards.arbeitnow(payloads(_raw(spark, d), item, as_json("data"))))


@query(
    "s1_jobspy",
    expect("'jobspy_' || lower(source)", source_id="url", location=BLANK, keep=first_by("dedup_hash")),
)
def jobspy(spark, d):
    item = _item(
        site=F.lower("source"), title=F.col("title"), company=F.col("company"), location=F.col("location"),
        jobUrl=F.col("url"), description=F.col("description"), datePosted=_iso(),
    )
    return shown(boards.jobspy(payloads(_raw(spark, d), item, as_json())))


@query(
    "s1_record_export",
    expect("'glassdoor'", source_id="url", location=LOC, where="url <> ''", keep=first_by("source_id"),
           remote=f"ingest_seq % 5 = 0 OR {o.remote('location')}"),
)
def record_export(spark, d):
    item = _item(
        job_url=F.col("url"), title=F.col("title"), company=F.col("company"), location=F.col("location"),
        is_remote=F.when(F.col("ingest_seq") % 5 == 0, "True").otherwise("False"),
        description=F.col("description"), date_posted=_iso(),
    )
    return shown(boards.record_export(payloads(_raw(spark, d), item, as_json()), "glassdoor"))


@query(
    "s1_recruitee",
    expect(
        "'recruitee'", location=f"CASE WHEN nation % 2 = 0 THEN 'City ' || nation || ', Land' ELSE {LOC} END",
        url="'https://acme-ai.recruitee.com/o/job-' || source_id",
        level="CASE WHEN ingest_seq % 5 = 0 THEN 'internship' WHEN ingest_seq % 5 = 1 THEN CASE WHEN regexp_matches(title, '(?i)\\bintern(ship)?\\b') "
        f"THEN 'internship' ELSE 'entry_level' END ELSE {o.level('title', 'description')} END",
        where="ingest_seq % 5 <> 2", keep=last_by("dedup_hash"), after="experience_level IS NOT NULL",
        company="CASE WHEN ingest_seq % 2 = 0 THEN company ELSE 'Acme AI' END",
    ),
)
def recruitee(spark, d):
    seq = F.col("ingest_seq")
    city = F.col("nation") % 2 == 0
    item = _item(
        id=seq, title=F.col("title"), slug=F.concat(F.lit("job-"), "source_id"), location=F.col("location"),
        city=F.when(city, F.concat(F.lit("City "), "nation")), country=F.when(city, "Land"),
        description=F.concat(F.lit("<p>"), "description", F.lit("</p>")), status=F.lit("published"),
        company_name=F.when(seq % 2 == 0, F.col("company")),
        experience_code=F.when(seq % 5 == 0, "student_college").when(seq % 5 == 1, "entry_level").when(seq % 5 == 2, "mid_level"),
        created_at=_iso(),
    )
    return shown(boards.recruitee(payloads(_raw(spark, d), item, as_json("offers"), F.lit("acme-ai"))))


@query(
    "s1_careerjet",
    expect("'careerjet'", source_id="url", location=LOC, where="url <> ''", keep=first_by("url"), posted="CAST(NULL AS TIMESTAMP)",
           remote=f"{o.remote('location')} OR {o.remote('title')}"),
)
def careerjet(spark, d):
    item = _item(
        url=F.col("url"), title=F.col("title"), description=F.col("description"), locations=F.col("location"),
        company=F.col("company"),
    )
    return shown(boards.careerjet(payloads(_raw(spark, d), item, as_json("jobs"))))


@query(
    "s1_handshake",
    expect(
        "'handshake'", location=BLANK, url="'https://app.joinhandshake.com/jobs/' || source_id",
        remote=f"ingest_seq % 8 = 0 OR {o.remote('location')}",
        level=f"CASE WHEN ingest_seq % 10 = 0 OR lower(title) LIKE '%intern%' THEN 'internship' ELSE {o.level('title', 'description')} END",
    ),
)
def handshake(spark, d):
    seq = F.col("ingest_seq")
    item = _item(
        id=F.col("source_id"), title=F.col("title"), employer_name=F.col("company"), location=F.col("location"),
        remote_work_type=F.when(seq % 8 == 0, "Remote only"), description=F.col("description"),
        url=F.concat(F.lit("/jobs/"), "source_id"), created_at=_iso(),
        employment_type=F.when(seq % 10 == 0, "Internship").otherwise("Full-Time"),
    )
    return shown(boards.handshake(payloads(_raw(spark, d), item, as_json("postings"))))


@query(
    "s1_usajobs",
    expect(
        "'usajobs'", location=LOC, where="url <> ''", after="ingest_seq % 15 < 12 AND experience_level IS NOT NULL",
        level=f"CASE WHEN ({o.level('title', 'description')}) IS NULL THEN NULL WHEN ingest_seq % 15 = 0 THEN {o.level('title', 'description')} "
        "WHEN ingest_seq % 15 IN (8, 9) THEN 'new_grad' ELSE 'entry_level' END",
    ),
)
def usajobs(spark, d):
    grade = F.struct(F.struct((F.col("ingest_seq") % 15).cast("string").alias("LowGrade")).alias("Details"))
    descriptor = _item(
        PositionTitle=F.col("title"), OrganizationName=F.col("company"), PositionLocationDisplay=F.col("location"),
        ApplyURI=F.array("url"), PublicationStartDate=_iso(), QualificationSummary=F.col("description"), UserArea=grade,
    )
    item = _item(MatchedObjectId=F.col("source_id"), MatchedObjectDescriptor=descriptor)
    return shown(boards.usajobs(payloads(_raw(spark, d), item, as_json("SearchResult.SearchResultItems"))))


@query(
    "s1_builtin_api",
    expect("'builtin'", location="'Town, ST'", remote="ingest_seq % 4 = 0", url="'https://builtin.com/job/' || source_id"),
)
def builtin_api(spark, d):
    item = _item(
        id=F.col("ingest_seq"), title=F.col("title"), companyDetails=_name("company", "name"), city=F.lit("Town"),
        state=F.lit("ST"), description=F.col("description"), remote=F.col("ingest_seq") % 4 == 0,
        datePosted=F.date_format("posted_at", "yyyy-MM-dd'T'HH:mm:ss"),
    )
    return shown(boards.builtin_api(payloads(_raw(spark, d), item, as_json("data.jobs"))))


@query("s1_dice_api", expect("'dice'", location=BLANK, where="url <> ''", after="experience_level IS NOT NULL", keep=first_by("url")))
def dice_api(spark, d):
    item = _item(
        id=F.col("source_id"), title=F.col("title"), summary=F.col("description"), companyName=F.col("company"),
        jobLocation=_name("location", "displayName"), detailsPageUrl=F.col("url"), postedDate=_iso(),
    )
    return shown(boards.dice_api(payloads(_raw(spark, d), item, as_json("data")), w.as_of()))


# -- Curated lists ------------------------------------------------------------------------


def _listing(flag: str) -> Column:
    visible = F.col("ingest_seq") % 7 != 0
    return _item(
        id=F.col("source_id"), title=F.col("title"), company_name=F.col("company"), locations=F.array("location"),
        url=F.col("url"), notes=F.col("description"), date_posted=_epoch(), **{flag: visible},
    )


@query(
    "s1_visible_list",
    expect("'pittcsc'", location=BLANK, level="'new_grad'", where="ingest_seq % 7 <> 0"),
)
def visible_list(spark, d):
    return shown(lists.visible_list(payloads(_raw(spark, d), _listing("is_visible"), as_json()), "pittcsc", "new_grad"))


@query(
    "s1_active_list",
    expect(
        "'vanshb03_newgrad'", location="coalesce(location, 'Remote')", where="ingest_seq % 7 <> 0",
        level=f"CASE WHEN ({o.level('title')}) = 'internship' THEN 'internship' ELSE 'new_grad' END",
        remote="lower(location) LIKE '%remote%' AND has_place", posted=f"coalesce(posted_at, TIMESTAMP '{w.AS_OF}')",
    ).replace("description, ingest_seq", "location IS NOT NULL AS has_place, description, ingest_seq"),
)
def active_list(spark, d):
    rows = payloads(_raw(spark, d), _listing("active"), as_json())
    return shown(lists.active_list(rows, "vanshb03_newgrad", w.as_of()))


CURATED_LEVEL = f"coalesce({o.level('title')}, 'new_grad')"
PER_DOC_URL = f"ingest_seq // {PER_PAYLOAD}, {o.canonical_url('url')}"
_CURATED = dict(
    source_id="url", location=BLANK, level=CURATED_LEVEL, keep=first_by(PER_DOC_URL),
    where=f"url <> '' AND NOT {o.non_us('location')}",
)


@query("s1_curated_json", expect("'zapplyjobs'", **{**_CURATED, "source_id": "source_id", "remote": f"ingest_seq % 6 = 0 OR {o.remote('location')}"}))
def curated_json(spark, d):
    seq = F.col("ingest_seq")
    item = _item(
        job_id=F.col("source_id"), job_title=F.col("title"), employer_name=F.col("company"), job_city=F.col("location"),
        job_apply_link=F.col("url"), job_is_remote=seq % 6 == 0, job_posted_at_datetime_utc=_iso(),
    )
    return shown(lists.curated_json(payloads(_raw(spark, d), item, as_json("jobs")), "zapplyjobs"))


def _cell(col: str) -> Column:
    return F.regexp_replace(F.coalesce(col, F.lit("")), "&", "&amp;")


def _day(col: str = "posted_at") -> Column:
    return F.coalesce(F.date_format(col, "yyyy-MM-dd"), F.lit(""))


def _row(*cells: Column) -> Column:
    return F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))


@query(
    "s2_repeated_company_table",
    expect("'jobright_swe'", **{**_CURATED, "company": "first_company", "remote": f"ingest_seq % 6 = 0 OR {o.remote('location')}", "frm": "carried",
        "ctes": "carried AS (SELECT *, first_value(company) OVER (PARTITION BY ingest_seq // 50, (ingest_seq % 50) // 3 ORDER BY ingest_seq) AS first_company FROM ranked)"}),
)
def repeated_company_table(spark, d):
    """The arrow repeats a company on two of three rows."""
    seq = F.col("ingest_seq")
    company = F.when((seq % PER_PAYLOAD) % 3 == 0, F.concat(F.lit("**"), _cell("company"), F.lit("**"))).otherwise("↳")
    title = F.concat(F.lit("**["), _cell("title"), F.lit("]("), "url", F.lit(")**"))
    row = _row(company, title, _cell("location"), F.when(seq % 6 == 0, "Remote").otherwise("On Site"), _day())
    head = "# Jobs\n\n| Company | Job Title | Location | Work Model | Date Posted |\n| ----- | --------- | --------- | ---- | ------- |\n"
    return shown(lists.repeated_company_table(payloads(_raw(spark, d), row, lines(head)), "jobright_swe", w.as_of()))


@query("s2_apply_cell_table", expect("'speedyapply_ai_newgrad'", **_CURATED))
def apply_cell_table(spark, d):
    link = F.concat(F.lit('<a href="'), "url", F.lit('"><img src="x" alt="Apply"></a>'))
    company = F.concat(F.lit('<a href="https://c"><strong>'), _cell("company"), F.lit("</strong></a>"))
    row = _row(company, _cell("title"), _cell("location"), F.lit("$90k"), link, _day())
    head = "| Company | Position | Location | Salary | Posting | Age |\n|---|---|---|---|---|---|\n"
    return shown(lists.apply_cell_table(payloads(_raw(spark, d), row, lines(head)), "speedyapply_ai_newgrad", w.as_of()))


@query(
    "s2_lock_table",
    expect("'ambicuity'", **{**_CURATED, "keep": "", "where": _CURATED["where"] + " AND ingest_seq % 8 <> 0"}),
)
def lock_table(spark, d):
    lock = F.when(F.col("ingest_seq") % 8 == 0, " \U0001f512").otherwise("")
    row = _row(F.concat(F.lit("\U0001f525 "), "company"), F.concat("title", lock), F.coalesce("location", F.lit("")), _day(), F.concat(F.lit("[Apply]("), "url", F.lit(")")))
    head = "| Company | Role | Location | Posted | Apply |\n| --- | --- | --- | --- | --- |\n"
    return shown(lists.lock_table(payloads(_raw(spark, d), row, lines(head)), as_of=w.as_of()))


@query(
    "s2_headed_table",
    expect(
        "'speedyapply_swe_newgrad'", **{**_CURATED, "level": o.level("title"), "where": _CURATED["where"] + " AND coalesce(location, '') <> ''",
        "after": "experience_level IN ('new_grad', 'entry_level')"},
    ),
)
def headed_table(spark, d):
    """A README: the table before the new-grad heading and after the next one do not count."""
    link = F.concat(F.lit('<a href="'), "url", F.lit('">Apply</a>'))
    row = _row(_cell("location"), _cell("company"), link, _cell("title"), _day())
    decoy = "| Location | Company | Posting | Role | Age |\n|---|---|---|---|---|\n| Austin, TX | Decoy | <a href=\"https://d/1\">A</a> | Software Engineer | 1d |\n"
    head = f"# Lists\n## Internships\n{decoy}\n## New Grad 2026\n" + decoy.split("| Austin")[0]
    tail = f"\n\n## Archive\n{decoy}"
    return shown(lists.headed_table(payloads(_raw(spark, d), row, lines(head, tail)), w.as_of(), readme=True))


@query("s2_last_link_table", expect("'zapplyjobs'", **_CURATED))
def last_link_table(spark, d):
    link = F.concat(F.lit("[Apply]("), "url", F.lit(")"))
    row = _row(F.concat(F.lit("\U0001f3e2 **"), _cell("company"), F.lit("**")), _cell("title"), _cell("location"), _day(), F.lit("mid"), link)
    head = "| Company | Role | Location(s) | Posted | Level | Apply |\n|:---|---|---|---|---|---|\n"
    return shown(lists.last_link_table(payloads(_raw(spark, d), row, lines(head)), w.as_of()))


# -- XML and HTML --------------------------------------------------------------------------


def _el(name: str, value: Column, cdata: bool = False) -> Column:
    inner = F.concat(F.lit("<![CDATA["), F.coalesce(value, F.lit("")), F.lit("]]>")) if cdata else escaped(value)
    return F.concat(F.lit(f"<{name}>"), inner, F.lit(f"</{name}>"))


@query(
    "s3_personio",
    expect(
        "'personio'", source_id="source_id", company="'Acme Gmbh'", location=LOC,
        url="'https://acme-gmbh.jobs.personio.de/job/' || source_id || '?language=en'", posted="CAST(NULL AS TIMESTAMP)",
        where=f"coalesce(location, '') = '' OR lower(location) LIKE '%remote%' OR ingest_seq % 8 = 0 OR {_office_sql('location')}",
        remote="coalesce(lower(location) LIKE '%remote%', false) OR ingest_seq % 8 = 0",
        roles=f"CASE WHEN {o.roles('title')} = '' AND nullif(description, '') IS NOT NULL THEN {o.roles('description')} ELSE {o.roles('title')} END",
        keep=last_by("dedup_hash"), after="experience_level IS NOT NULL",
    ),
)
def personio(spark, d):
    more = F.when(F.col("ingest_seq") % 8 == 0, "<additionalOffices><office>Remote</office></additionalOffices>").otherwise("")
    item = F.concat(
        F.lit("<position>"), _el("id", F.col("source_id")), _el("office", F.col("location")), more,
        _el("name", F.col("title")), F.lit("<jobDescriptions><jobDescription>"),
        _el("value", F.col("description"), cdata=True), F.lit("</jobDescription></jobDescriptions></position>"),
    )
    body = payloads(_raw(spark, d), item, lines("<workzag-jobs>", "</workzag-jobs>"), F.lit("acme-gmbh"))
    return shown(pages.personio(body))


@query(
    "s3_dice_rss",
    expect("'dice_rss'", source_id="source_id", location=LOC, url="'https://www.dice.com/job-detail/' || source_id",
           keep=first_by("source_id")),
)
def dice_rss(spark, d):
    date = F.coalesce(F.date_format("posted_at", "EEE, dd MMM yyyy HH:mm:ss 'GMT'"), F.lit(""))
    item = F.concat(
        F.lit("<item>"), _el("title", F.col("title"), cdata=True),
        F.lit("<link>https://www.dice.com/job-detail/"), "source_id", F.lit("</link>"),
        _el("description", F.col("description"), cdata=True), F.lit("<pubDate>"), date, F.lit("</pubDate>"),
        _el("source", F.col("company"), cdata=True), F.lit("<location>"), F.coalesce("location", F.lit("")), F.lit("</location></item>"),
    )
    return shown(pages.dice_rss(payloads(_raw(spark, d), item, lines("<rss><channel><title>Feed</title>", "</channel></rss>"))))


@query(
    "s4_html_cards",
    """WITH c AS (SELECT page_id, unnest(string_split(html, '<li>')[2:]) AS block, unnest(range(len(string_split(html, '<li>')) - 1)) AS pos FROM pages),
    f AS (SELECT page_id, pos, string_split(block, '</li>')[1] AS card FROM c)
    SELECT page_id, pos, nullif(regexp_extract(card, 'href="([^"]+)"', 1), '') AS href,
      CASE WHEN card LIKE '%<a %' THEN regexp_extract(card, '<a [^>]*>([^<]*)</a>', 1) END AS label FROM f""",
)
def html_cards(spark, d):
    """List items of web pages as cards."""
    landed = w.table(spark, d, "pages").select(
        F.lit("run1").alias("run_id"), F.lit("site").alias("request_key"), F.col("page_id").alias("fetch_seq"), F.col("html").alias("body")
    )
    block = F.col("block")
    href = F.regexp_extract(block, 'href="([^"]+)"', 1)
    label = F.when(block.contains("<a "), F.regexp_extract(block, "<a [^>]*>([^<]*)</a>", 1))
    return readers.cards(landed, "<li>", "</li>").select(
        F.col("fetch_seq").alias("page_id"), F.col("pos").cast("bigint").alias("pos"),
        F.nullif(href, F.lit("")).alias("href"), label.alias("label"),
    )


@query(
    "s4_builtin_pages",
    expect("'builtin'", location=LOC, url="'https://builtin.com/job/x/' || source_id", level=o.level("title"),
           remote="coalesce(regexp_matches(location, '(?i)\\bremote\\b'), false) OR ingest_seq % 4 = 0"),
)
def builtin_pages(spark, d):
    icon = lambda name, value: F.concat(
        F.lit(f'<i class="fa-regular {name}"></i></div><div><span class="font-barlow text-gray-04">'), value, F.lit("</span></div>")
    )
    item = F.concat(
        F.lit('<div id="job-card-'), "source_id", F.lit('"><span data-id="company-title"><span>'), escaped(F.col("company")),
        F.lit('</span></span><a href="/job/x/'), "source_id", F.lit('" data-id="job-card-title">'), escaped(F.col("title")), F.lit("</a>"),
        icon("fa-house-building", F.when(F.col("ingest_seq") % 4 == 0, "Remote").otherwise("Office")),
        icon("fa-location-dot", escaped(F.col("location"))), F.lit("</div>"),
        F.when(F.col("posted_at").isNotNull(), F.concat(F.lit("<script>x={'id':"), "source_id", F.lit(",'published_date':'"), F.date_format("posted_at", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("'}</script>"))).otherwise(""),
    )
    return shown(pages.builtin_pages(payloads(_raw(spark, d), item, lines("<html>", "</html>"))))


_TARGET = o.target_roles("title")
_STRICT = dict(
    level=f"CASE WHEN {o.early_career('title', 'description')} AND NOT ({BLANK} <> '' AND {o.non_us('location')} AND NOT ({o.usa('location', o.remote('location'))})) THEN {o.level('title', 'description')} END",
    roles=o.target_roles("title || chr(10) || description"),
    where=f"{_TARGET} <> ''",
    after="experience_level <> 'internship'",
    location=LOC,
)


def _strict(spark, d):
    """Postings with a detail page of their own."""
    return _raw(spark, d).withColumn("url", F.concat(F.lit("https://jobs.example.com/jobs/"), "source_id", F.lit("/x/job?mode=view")))


STRICT_URL = "'https://jobs.example.com/jobs/' || source_id || '/x/job?mode=view'"


def _names(spark, key="acme"):
    return spark.range(1).select(F.lit(key).alias("request_key"), F.lit("Acme").alias("company_name"))


def _ld_page(description: Column, place: Column) -> Column:
    """A detail page: a broken script, then a graph with the posting."""
    posting = F.to_json(
        F.struct(
            F.lit("JobPosting").alias("@type"), F.col("title").alias("title"), description.alias("description"),
            _iso().alias("datePosted"), F.struct(F.col("company").alias("name")).alias("hiringOrganization"),
            F.when(place.isNotNull(), F.struct(F.struct(place.alias("addressLocality"), F.lit("US").alias("addressCountry")).alias("address"))).alias("jobLocation"),
        )
    )
    return F.concat(
        F.lit('<html><script type="application/ld+json">{broken</script><script type="application/ld+json">{"@graph":[{"@type":"WebSite"},'),
        posting, F.lit("]}</script></html>"),
    )


def _landed_twice(key: Column, body: Column, rows: DataFrame) -> DataFrame:
    """Every detail in two runs and, in the newer one, two fetches; the last one counts."""
    stale = F.struct(F.lit("run0").alias("run_id"), F.lit(9).cast("long").alias("fetch_seq"), F.lit("{}").alias("body"))
    early = F.struct(F.lit("run1").alias("run_id"), F.lit(0).cast("long").alias("fetch_seq"), F.lit("<html/>").alias("body"))
    last = F.struct(F.lit("run1").alias("run_id"), F.lit(1).cast("long").alias("fetch_seq"), body.alias("body"))
    return rows.select(key.alias("request_key"), F.explode(F.array(last, stale, early)).alias("p")).select("request_key", "p.*")


def _details(rows: DataFrame, page: Column) -> DataFrame:
    return _landed_twice(F.col("url"), page, rows)


@query("s5_breezy", expect("'breezy'", url=STRICT_URL, **_STRICT))
def breezy(spark, d):
    rows = _strict(spark, d)
    item = _item(id=F.col("source_id"), name=F.col("title"), url=F.col("url"), location=F.struct(F.lit("Listed place").alias("name")))
    detail = _details(rows, _ld_page(F.col("description"), F.coalesce(F.nullif("location", F.lit("")), F.lit(None))))
    # Without a place in the detail page the listing's place would stand in.
    listed = payloads(rows.filter("coalesce(location, '') <> ''"), item, as_json())
    plain = _item(id=F.col("source_id"), name=F.col("title"), url=F.col("url"))
    other = payloads(rows.filter("coalesce(location, '') = ''"), plain, as_json())
    return shown(pages.breezy(listed.unionByName(other), _names(spark), detail))


@query("s5_icims", expect("'icims'", url=STRICT_URL, **{**_STRICT, "remote": "lower(coalesce(location, '') || chr(10) || description) LIKE '%remote%' OR " + o.remote("location"),
       "level": _STRICT["level"].replace(o.remote("location"), "lower(coalesce(location, '')) LIKE '%remote%' OR " + o.remote("location"))}))
def icims(spark, d):
    rows = _strict(spark, d)
    item = F.concat(
        F.lit('<li class="iCIMS_JobCardItem"><a href="'), "url", F.lit('"><h3>'), escaped(F.col("title")),
        F.lit('</h3></a><div class="iCIMS_JobHeaderTag"><dt>Job Location</dt><dd>Nowhere</dd></div></li>'),
    )
    place = F.coalesce(F.nullif("location", F.lit("")), F.lit(None))
    with_place = rows.filter("coalesce(location, '') <> ''")
    without = rows.filter("coalesce(location, '') = ''")
    bare = F.concat(F.lit('<li class="iCIMS_JobCardItem"><a href="'), "url", F.lit('"><h3>'), escaped(F.col("title")), F.lit("</h3></a></li>"))
    body = payloads(with_place, item, lines("<ul>", "</ul>")).unionByName(payloads(without, bare, lines("<ul>", "</ul>")))
    return shown(pages.icims(body, _names(spark), _details(rows, _ld_page(F.col("description"), place))))


@query(
    "s5_jobvite",
    expect("'jobvite'", **{**_STRICT, "url": "'https://jobs.jobvite.com/acme/job/' || source_id",
           "remote": f"lower(coalesce(location, '')) LIKE '%remote%' OR {o.remote('location')}"}),
)
def jobvite(spark, d):
    rows = _raw(spark, d).withColumn("url", F.concat(F.lit("https://jobs.jobvite.com/acme/job/"), "source_id"))
    item = F.concat(
        F.lit('<tr> <td class="jv-job-list-name"> <a href="/acme/job/'), "source_id", F.lit('">'), escaped(F.col("title")),
        F.lit('</a> </td> <td class="jv-job-list-location">'), escaped(F.col("location")), F.lit("</td> </tr>"),
    )
    place = F.coalesce(F.nullif("location", F.lit("")), F.lit(None))
    return shown(pages.jobvite(payloads(rows, item, lines("<table>", "</table>")), _names(spark), _details(rows, _ld_page(F.col("description"), place))))


@query(
    "s5_jazzhr",
    expect("'jazzhr'", **{**_STRICT, "url": "'https://acme.applytojob.com/apply/' || source_id || '/x'",
           "remote": f"lower(coalesce(location, '')) LIKE '%remote%' OR {o.remote('location')}"}),
)
def jazzhr(spark, d):
    rows = _raw(spark, d).withColumn("url", F.concat(F.lit("https://acme.applytojob.com/apply/"), "source_id", F.lit("/x")))
    place = F.nullif("location", F.lit(""))
    fact = F.when(place.isNotNull(), F.concat(F.lit("<li><i class='fa fa-map-marker'></i>"), escaped(place), F.lit("</li>"))).otherwise("")
    item = F.concat(
        F.lit('<li class="list-group-item"><h3 class="t"><a href="'), "url", F.lit('">'), escaped(F.col("title")),
        F.lit("</a></h3><ul>"), fact, F.lit("</ul></li>"),
    )
    return shown(pages.jazzhr(payloads(rows, item, lines("<ul>", "</ul>")), _names(spark), _details(rows, _ld_page(F.col("description"), F.lit(None).cast("string")))))


@query(
    "s5_oraclecloud",
    expect("'oraclecloud'", **{**_STRICT, "company": "'Acme'", "url": "'https://acme.example/hcmUI/CandidateExperience/en/sites/CX/job/' || source_id",
           "remote": f"ingest_seq % 6 = 0 OR {o.remote('location')}",
           "level": _STRICT["level"].replace(o.remote("location"), f"(ingest_seq % 6 = 0 OR {o.remote('location')})")}),
)
def oraclecloud(spark, d):
    rows = _raw(spark, d)
    item = _item(Id=F.col("source_id"), Title=F.col("title"), PostedDate=_iso(), WorkplaceType=F.when(F.col("ingest_seq") % 6 == 0, "Remote"))
    body = payloads(rows, item, lambda items: F.concat(F.lit('{"items":[{"requisitionList":'), F.to_json(items), F.lit("}]}")))
    sites = _names(spark).withColumns({"base_url": F.lit("https://acme.example"), "site_number": F.lit("CX")})
    place = F.array(F.struct(F.col("location").alias("TownOrCity"), F.lit("US").alias("Country")))
    post = F.struct(F.col("description").alias("ExternalDescriptionStr"), place.alias("workLocation"))
    detail = _landed_twice(F.concat(F.lit("acme/"), "source_id"), F.to_json(post), rows)
    return shown(pages.oraclecloud(body, sites, detail))


_WORKABLE_PLACE = f"CASE WHEN lower({o.trim('location')}) = 'remote' THEN 'Remote' ELSE nullif(regexp_replace({o.trim('location')}, '(?i),\\s*United States$', ''), '') END"


@query(
    "s6_workable",
    expect("'workable'", location=_WORKABLE_PLACE, where=f"url <> '' AND ingest_seq % 9 <> 0 AND NOT {o.non_us('location')}"),
)
def workable(spark, d):
    """The jobs sit in a script, behind a marker; strings hold braces."""
    item = _item(
        id=F.col("source_id"), title=F.col("title"), url=F.col("url"), description=F.concat("description", F.lit(" {")),
        state=F.when(F.col("ingest_seq") % 9 == 0, "draft").otherwise("published"), created=_iso(),
        locations=F.array("location"), company=_name("company", "title"),
    )
    page = lambda items: F.concat(
        F.lit('<script>window.x = {"a":"}","api/v1/jobs":{"status":200,"data":{"totalSize":1,"jobs":'), F.to_json(items), F.lit("}}};</script>")
    )
    return shown(boards.workable(payloads(_raw(spark, d), item, page)))


_SOFT = f"{o.tech_signal('title')} AND NOT {o.non_us('location')}"


@query(
    "s6_workatastartup",
    expect("'workatastartup'", location=f"nullif({o.trim(BLANK)}, '')", url="'https://www.workatastartup.com/jobs/' || source_id", where=_SOFT,
           level=o.level("title", "description"), posted="CASE WHEN ingest_seq % 2 = 0 THEN posted_at END",
           remote="coalesce(lower(location) LIKE '%remote%', false)", keep=""),
)
def workatastartup(spark, d):
    rows = _raw(spark, d)
    even = F.col("ingest_seq") % 2 == 0
    hit = _item(
        objectID=F.col("source_id"), title=F.col("title"), company_name=F.col("company"), locations=F.array("location"),
        description=F.col("description"), created_at=_epoch(),
    )
    job = _item(id=F.col("source_id"), title=F.col("title"), companyName=F.col("company"), location=F.col("location"), companyOneLiner=F.col("description"))
    page = lambda items: F.concat(
        F.lit('<div data-page="'), F.regexp_replace(F.regexp_replace(F.concat(F.lit('{"props":{"jobs":'), F.to_json(items), F.lit("}}")), "&", "&amp;"), '"', "&quot;"), F.lit('"></div>')
    )
    inner = F.struct(F.struct(F.struct(F.col("description").alias("descriptionHtml")).alias("job")).alias("props"))
    escaped = F.regexp_replace(F.regexp_replace(F.to_json(inner), "&", "&amp;"), '"', "&quot;")
    detail = _landed_twice(F.col("source_id"), F.concat(F.lit('<div data-page="'), escaped, F.lit('"></div>')), rows)
    return shown(boards.workatastartup(payloads(rows.filter(even), hit, as_json("hits")), payloads(rows.filter(~even), job, page), detail))


@query(
    "s6_rippling",
    expect("'rippling'", source_id="'acme-co:' || source_id", company="'Acme Co'", location=f"nullif({o.trim(BLANK)}, '')",
           url="coalesce(nullif(url, 'x'), '')", where=f"{o.tech_signal('title')} AND ({o.level('title')}) IS NOT NULL"),
)
def rippling(spark, d):
    rows = _raw(spark, d)
    item = _item(id=F.col("source_id"), name=F.col("title"), url=F.col("url"), locations=F.array(_name("location", "name")))
    page = lambda items: F.concat(
        F.lit('<script id="__NEXT_DATA__" type="application/json">{"props":{"pageProps":{"jobBoard":{"title":"Acme Co"},"dehydratedState":{"queries":[{"queryKey":["a","b","job-posts"],"state":{"data":{"items":'),
        F.to_json(items), F.lit("}}}]}}}}</script>"),
    )
    post = F.struct(
        F.struct(F.struct(F.struct(_iso().alias("createdOn"), F.struct(F.col("description").alias("role")).alias("description")).alias("jobPost")).alias("apiData")).alias("pageProps")
    )
    details = _landed_twice(F.concat(F.lit("acme-co/"), "source_id"), F.to_json(post), rows)
    return shown(boards.rippling(payloads(rows, item, page, F.lit("acme-co")), details))


_COMMENT = (
    "(company || ' | ' || title || coalesce(' | ' || nullif(location, ''), '') || chr(10) || coalesce(nullif(description, '') || chr(10), '') "
    "|| 'Apply: link')"
)
_REMOTE_COMMENT = f"regexp_matches({_COMMENT}, '(?i)\\bremote\\b')"


@query(
    "s7_comment_thread",
    expect(
        "'hackernews'", where=o.tech_signal("title"), company="company", url="'https://apply.example.com/' || source_id",
        location=f"CASE WHEN coalesce(location, '') = '' OR {o.tech_signal('location')} THEN CASE WHEN {_REMOTE_COMMENT} THEN 'Remote' END ELSE location END",
        level=f"coalesce({o.level('title', 'body')}, CASE WHEN regexp_matches(body, '(?i){thread.EARLY_CAREER}') THEN 'entry_level' END)",
        remote="is_remote", keep=f"AND (is_remote OR NOT {o.non_us('location')}) " + last_by("dedup_hash"),
        after="experience_level IS NOT NULL",
    ).replace("description, ingest_seq", f"{_COMMENT} AS body, {_REMOTE_COMMENT} AS is_remote, ingest_seq"),
)
def comment_thread(spark, d):
    """``Company | Title | Location`` headers with markup, links and dead comments."""
    rows = _raw(spark, d)
    header = F.concat_ws(" | ", escaped(F.col("company")), escaped(F.col("title")), F.nullif("location", F.lit("")))
    text = F.concat(header, F.lit("<p>"), escaped(F.col("description")), F.lit('<p>Apply: <a href="https:&#x2F;&#x2F;apply.example.com&#x2F;'), "source_id", F.lit('">link</a>'))
    item = _item(id=F.col("ingest_seq") + 0, text=text, time=_epoch(), dead=F.lit(False))
    gone = _item(id=F.col("ingest_seq"), text=text, dead=F.lit(True))
    body = payloads(rows, item, as_json()).unionByName(payloads(rows, gone, as_json()))
    return shown(thread.comment_thread(body))


# -- Details, fallbacks, storage -----------------------------------------------------------


@query(
    "s8_themuse",
    expect("'themuse'", location=BLANK, level="'entry_level'", where="ingest_seq % 10 <> 0"),
)
def themuse(spark, d):
    rows = _raw(spark, d)
    item = _item(
        id=F.when(F.col("ingest_seq") % 10 != 0, F.col("source_id")).otherwise("x"), name=F.col("title"), company=_name("company", "name"),
        locations=F.array(_name("location", "name")), refs=_name("url", "landing_page"), publication_date=_iso(),
    )
    details = _landed_twice(F.col("source_id"), F.to_json(F.struct(F.col("description").alias("contents"))), rows)
    return shown(boards.themuse(payloads(rows, item, as_json("results")), details))


@query(
    "s8_smartrecruiters",
    expect(
        "'smartrecruiters'", location=f"nullif({o.trim(BLANK)}, '')",
        url=f"'https://jobs.smartrecruiters.com/acme/' || source_id || '-' || {o.sub(o.sub('lower(title)', '[^a-z0-9]+', '-'), '^-+|-+$', '')}",
        where=f"({o.tech_signal('title')} OR {o.roles('title')} <> '') AND ({o.remote('location')} OR ({BLANK} <> '' AND NOT {o.non_us('location')}))",
        level=f"CASE ingest_seq % 4 WHEN 0 THEN NULL WHEN 1 THEN CASE WHEN ({o.level('title')}) IS NULL THEN NULL WHEN ({o.level('title')}) IN ('internship', 'new_grad') "
        f"THEN {o.level('title')} ELSE 'entry_level' END ELSE {o.level('title')} END",
    ),
)
def smartrecruiters(spark, d):
    rows = _raw(spark, d)
    seq = F.col("ingest_seq")
    item = _item(
        id=F.col("source_id"), name=F.col("title"), releasedDate=_iso(), company=_name("company", "name"),
        experienceLevel=F.struct(F.when(seq % 4 == 0, "director").when(seq % 4 == 1, "associate").alias("id")),
        location=_name("location", "fullLocation"),
    )
    ad = F.struct(F.struct(F.struct(_name("description", "text").alias("jobDescription")).alias("sections")).alias("jobAd"))
    details = _landed_twice(F.col("source_id"), F.to_json(ad), rows)
    return shown(boards.smartrecruiters(payloads(rows, item, as_json("content")), details))


@query(
    "s8_workday",
    f"""WITH {o.HASHED}, {GATE_CTE.replace("ingest_seq % 4", "ingest_seq % 1").replace("o_custkey % 4", "o_custkey % 1")},
    k AS (SELECT *, {o.posting_hash("'nvidia'", 'title', 'location')} AS h FROM gated WHERE reason IS NULL),
    f AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY h ORDER BY ingest_seq) = 1)
    SELECT title, coalesce(location, '') AS location, 'https://nvidia.wd1.myworkdayjobs.com/Site/job/x_R' || source_id AS url, 'R' || source_id AS source_id,
      h AS dedup_hash, {o.level('title')} AS experience_level, description FROM f""",
)
def workday(spark, d):
    rows = _raw(spark, d)
    item = _item(title=F.col("title"), locationsText=F.col("location"), externalPath=F.concat(F.lit("/job/x_R"), "source_id"), postedOn=F.lit("Posted Today"))
    key = "nvidia/wd1/Site"
    detail = F.struct(F.struct(F.col("description").alias("jobDescription")).alias("jobPostingInfo"))
    details = _landed_twice(F.concat(F.lit(f"{key}|/job/x_R"), "source_id"), F.to_json(detail), rows)
    out = pages.workday(payloads(rows, item, as_json("jobPostings"), F.lit(key)), details, w.as_of())
    return out.select("title", "location", "url", "source_id", "dedup_hash", "experience_level", "description")


@query(
    "s9_first_nonempty",
    """WITH c AS (SELECT o_custkey, o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 ELSE 2 END AS priority FROM orders)
    SELECT o_custkey, o_orderkey FROM c QUALIFY dense_rank() OVER (PARTITION BY o_custkey ORDER BY priority) = 1""",
)
def first_nonempty(spark, d):
    rank = F.when(F.col("o_orderpriority") == "1-URGENT", 0).when(F.col("o_orderpriority") == "2-HIGH", 1).otherwise(2)
    rows = w.table(spark, d, "orders").withColumn("priority", rank)
    return readers.first_nonempty_payload(rows, ["o_custkey"]).select("o_custkey", "o_orderkey")


@query(
    "s9_bamboohr",
    expect(
        "'bamboohr'", company="'Firm-' || (ingest_seq // 50)", location=o.trim(BLANK), level=o.level("title"),
        url="CASE WHEN (ingest_seq // 50) % 2 = 0 THEN 'https://firm-' || (ingest_seq // 50) || '.bamboohr.com/jobs/' || source_id ELSE "
        "'https://firm-' || (ingest_seq // 50) || '.bamboohr.com/careers/' || source_id END", posted="CAST(NULL AS TIMESTAMP)",
        where=f"NOT {o.non_us('location')}",
    ).replace("'Firm-' ||", "'Firm ' ||"),
)
def bamboohr(spark, d):
    """Every second board has no embedded rows, so its JSON list counts."""
    rows = _raw(spark, d)
    board = F.floor(F.col("ingest_seq") / PER_PAYLOAD)
    key = F.concat(F.lit("firm-"), board)
    item = F.concat(
        F.lit('<li id="bhrPositionID_'), "source_id", F.lit('"><a href="/jobs/'), "source_id", F.lit('">'), escaped(F.col("title")),
        F.lit('</a><span class="BambooHR-ATS-Location">'), escaped(F.col("location")), F.lit("</span></li>"),
    )
    embeds = payloads(rows.filter(board % 2 == 0), item, lines('<div class="BambooHR-ATS-board">', "</div>"), key)
    empty = payloads(rows.filter(board % 2 == 1), F.lit(""), lines('<div class="BambooHR-ATS-board">', "</div>"), key)
    job = _item(id=F.col("source_id"), jobOpeningName=F.col("title"), location=_name("location", "city"))
    careers = payloads(rows, job, as_json("result"), key)
    return shown(pages.bamboohr(embeds.unionByName(empty), careers))


def _result_card() -> Column:
    return F.concat(
        F.lit('<li><div data-jobkey="'), "source_id", F.lit('" data-testid="searchSerpJob"><h2 data-testid="searchSerpJobTitle"><a href="'),
        "url", F.lit('">'), escaped(F.col("title")), F.lit('</a></h2><span data-testid="companyName">'), escaped(F.col("company")),
        F.lit('</span><span data-testid="searchSerpJobLocation">'), escaped(F.col("location")),
        F.lit('</span><span data-testid="jobTypeChip-0">'), F.when(F.col("ingest_seq") % 5 == 0, "Hybrid").otherwise("On-site"),
        F.lit('</span><p data-testid="searchSerpJobDateStamp">'), _day(), F.lit("</p></div></li>"),
    )


_RESULTS = dict(
    location=BLANK, where="url <> ''", after="experience_level IS NOT NULL", keep=first_by("url"), level=o.level("title"),
    remote=f"{o.remote('location')} OR ingest_seq % 5 = 0",
)


@query("s4_dice_pages", expect("'dice'", **_RESULTS))
def dice_pages(spark, d):
    rows = _raw(spark, d)
    return shown(pages.dice_pages(payloads(rows, _result_card(), lines("<ul>", "</ul>")), w.as_of()))


@query("s6_simplyhired", expect("'simplyhired'", **{**_RESULTS, "where": f"url <> '' AND {o.tech_signal('title')}",
       "remote": "coalesce(regexp_matches(location, '(?i)\\bremote\\b'), false) OR " + o.remote("location"),
       "level": o.level("title", "description")}))
def simplyhired(spark, d):
    """Jobs deep inside a state object."""
    rows = _raw(spark, d)
    item = _item(
        id=F.col("source_id"), title=F.col("title"), company=F.col("company"), link=F.col("url"), formattedLocation=F.coalesce("location", F.lit("")),
        snippet=F.col("description"), postedDate=_day(),
    )
    page = lambda items: F.concat(
        F.lit('<script>window.__PRELOADED_STATE__ = {"a":{"b":[{"list":'), F.to_json(items), F.lit('}],"c":"}"}};</script>')
    )
    return shown(pages.simplyhired(payloads(rows, item, page), w.as_of()))


@query(
    "s10_snapshot_store",
    f"WITH {o.MERGE} SELECT source, count(*) AS jobs FROM snapshot WHERE source IN ('lever', 'ashby') GROUP BY 1",
)
def snapshot_store(spark, d):
    """Write all sources, read two of them back."""
    path = f"{shared_folder(spark)}/snapshot-{uuid.uuid4()}"
    store.write_snapshot(w.snapshot(spark, d), path, salt=4)
    return store.read_snapshot(spark, path, ["lever", "ashby"]).groupBy("source").agg(F.count("*").alias("jobs"))


@query(
    "d3_full_run",
    f"""WITH {o.HASHED}, g AS (SELECT *, row_number() OVER (PARTITION BY source IN ({', '.join(map(o.lit, dedup.CURATED_SOURCES))}) AND {o.canonical_url('url')} <> '', {o.canonical_url('url')}
      ORDER BY source_rank, ingest_seq) AS rn, source IN ({', '.join(map(o.lit, dedup.CURATED_SOURCES))}) AND {o.canonical_url('url')} <> '' AS shared FROM hashed)
    SELECT source, dedup_hash, max(ingest_seq) AS ingest_seq FROM g WHERE NOT shared OR rn = 1 GROUP BY ALL""",
)
def full_run(spark, d):
    """Cross-source, then in-source dedup: what a run hands to the merge."""
    rows = dedup.dedupe_across_sources(w.hashed_postings(spark, d))
    return dedup.dedupe_in_source(rows).select("source", "dedup_hash", "ingest_seq")


_STREAMED = ("pittcsc", "simplify_internships", "vanshb03_internships")
_STREAM_ROWS = " UNION ALL ".join(
    f"SELECT {i + 1} AS rank, '{name}' AS src, CASE WHEN {i} = 2 AND ingest_seq % 2 = 0 THEN url || '/c' ELSE url END AS link, * FROM hashed WHERE ingest_seq % 7 <> 0 AND ingest_seq % 3 <> {i}"
    for i, name in enumerate(_STREAMED)
)


@query(
    "st1_incremental_merge",
    f"""WITH {o.HASHED}, l AS ({_STREAM_ROWS}),
    h AS (SELECT *, {o.posting_hash('company', 'title', BLANK)} AS h, {o.canonical_url('link')} AS c FROM l),
    d3 AS (SELECT * FROM h QUALIFY coalesce(c, '') = '' OR row_number() OVER (PARTITION BY c ORDER BY rank, ingest_seq) = 1),
    d4 AS (SELECT * FROM d3 QUALIFY row_number() OVER (PARTITION BY src, h ORDER BY ingest_seq DESC) = 1)
    SELECT h AS dedup_hash, arg_max(src, rank) AS source, arg_max(link, rank) AS url, strftime(max(posted_at), '%Y-%m-%d') AS posted, true AS is_active FROM d4 GROUP BY h""",
)
def incremental_merge(spark, d):
    """Three curated lists that copy each other, in several files and micro-batches."""
    from ..streaming import incremental as inc

    root = f"{shared_folder(spark)}/stream-{uuid.uuid4()}"
    rows = _raw(spark, d)
    for i, name in enumerate(_STREAMED):
        own = rows.filter(F.col("ingest_seq") % 3 != i)
        if i == 2:
            other = F.col("ingest_seq") % 2 == 0
            own = own.withColumn("url", F.when(other, F.concat("url", F.lit("/c"))).otherwise(F.col("url")))
        landed = payloads(own, _listing("is_visible"), as_json(), F.lit(name)).select(
            F.lit(name).alias("source"), "run_id", "fetch_seq", "request_key", F.lit(200).alias("status"),
            F.lit("application/json").alias("content_type"), "body",
        )
        landed.write.mode("append").parquet(f"{root}/landing")
    inc.run_end(spark, "run1").write.mode("append").parquet(f"{root}/landing")

    def adapter(batch: DataFrame) -> DataFrame:
        parts = [
            lists.visible_list(batch.filter(F.col("source") == name), name, "new_grad").withColumn("source_rank", F.lit(i))
            for i, name in enumerate(_STREAMED)
        ]
        return dedup.union_all(parts)

    stream = inc.incremental_merge(
        spark, f"{root}/landing", f"{root}/store", adapter, f"{root}/checkpoint", w.as_of(), files_per_batch=2
    )
    stream.awaitTermination()
    found = inc.read_snapshot(spark, f"{root}/store")
    return found.select("dedup_hash", "source", "url", F.date_format("posted_at", "yyyy-MM-dd").alias("posted"), "is_active")
