"""JSON boards and aggregators: each adapter maps its payload fields and drop rules.

All take landed payloads and return canonical postings. ``request_key`` is the board slug
where a payload does not name its company.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.classify import (
    classify_experience,
    has_tech_signal,
    level_from_board_id,
    level_from_codes,
    level_from_grade,
    tech_prefilter,
)
from ..functions.dates import parse_datetime, parse_posted, parse_zoneless
from ..functions.keys import posting_hash
from ..functions.location import infer_remote, is_non_us
from ..functions.places import (
    city_country,
    country_name,
    distinct_joined,
    first_named,
    joined,
    listed_place,
    short_country,
)
from ..functions.salary import parse_annual, parse_salary
from ..functions.text import (
    SLUG_NAMES,
    blank_to_null,
    clean_unicode,
    decode_entities,
    humanize_slug,
    js_trim,
    slugify,
    strip_html,
)
from ..operators.dedup import dedupe_by
from ..settle import settle
from .canonical import finalize
from .readers import (
    absolute_url,
    detail_enrich,
    newest_payload,
    embedded_object,
    json_items,
    next_data,
    page_attribute,
)


def _c(name: str, default: str = "") -> Column:
    """The field, or the default when it is missing."""
    return F.coalesce(F.col(name), F.lit(default))


def _or_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def _rounded(name: str) -> Column:
    """Whole amount, half up; zero and text count as missing."""
    amount = F.col(name).try_cast("double")
    return F.nullif(F.floor(amount + 0.5).try_cast("int"), F.lit(0))


def adzuna(payloads: DataFrame, link_suffix: str = "") -> DataFrame:
    """``link_suffix`` is the tracking part a site appends to the target links."""
    item = (
        "id: string, title: string, description: string, company: struct<display_name: string>, "
        "location: struct<display_name: string>, redirect_url: string, salary_min: double, "
        "salary_max: double, created: string"
    )
    rows = dedupe_by(json_items(payloads, item, ["results"]), ["id"], ["ingest_seq"])
    name = F.col("company.display_name")
    rows = rows.transform(settle, 
        {
            "source_id": F.col("id"),
            "_hash_company": F.coalesce(name, F.lit("")),
            "location": F.coalesce("location.display_name", F.lit("")),
            "url": F.concat("redirect_url", F.lit(link_suffix)),
            "experience_level": classify_experience(_c("title"), _c("description")),
            "salary_min": _rounded("salary_min"),
            "salary_max": _rounded("salary_max"),
            "posted_at": parse_datetime(F.col("created")),
            "company": F.coalesce(name, F.lit("Unknown")),
        }
    )
    rows = rows.transform(settle, 
        {
            "remote": infer_remote(F.col("location")),
            "dedup_hash": posting_hash(F.col("_hash_company"), F.col("title"), F.col("location")),
        }
    )
    return finalize(rows, "adzuna")


def remoteok(payloads: DataFrame) -> DataFrame:
    item = (
        "slug: string, id: string, position: string, company: string, url: string, "
        "description: string, salary_min: double, salary_max: double, epoch: bigint"
    )
    rows = json_items(payloads, item, [""]).filter(_c("slug") != "")
    rows = rows.filter(tech_prefilter(F.col("position"), kind="remote_board"))
    rows = rows.transform(settle, 
        {
            "source_id": F.col("id"),
            "title": _c("position"),
            "location": F.lit("Remote"),
            "remote": F.lit(True),
            "experience_level": classify_experience(_c("position"), _c("description")),
            "salary_min": F.nullif(F.col("salary_min").try_cast("int"), F.lit(0)),
            "salary_max": F.nullif(F.col("salary_max").try_cast("int"), F.lit(0)),
            "posted_at": F.timestamp_seconds("epoch"),
        }
    )
    return finalize(rows, "remoteok")


def arbeitnow(payloads: DataFrame) -> DataFrame:
    item = (
        "slug: string, title: string, company_name: string, location: string, remote: boolean, "
        "url: string, description: string, tags: array<string>, created_at: bigint"
    )
    rows = json_items(payloads, item, ["data"])
    rows = rows.filter(tech_prefilter(F.col("title"), F.col("tags"), kind="tagged"))
    rows = rows.transform(settle, 
        {
            "source_id": F.col("slug"),
            "company": F.col("company_name"),
            "location": _c("location"),
            "experience_level": classify_experience(_c("title"), _c("description")),
            "posted_at": F.timestamp_seconds("created_at"),
        }
    )
    return finalize(rows, "arbeitnow")


def themuse(payloads: DataFrame, details: DataFrame) -> DataFrame:
    """Detail bodies are keyed by the numeric id."""
    item = (
        "id: string, name: string, company: struct<name: string>, publication_date: string, "
        "locations: array<struct<name: string>>, refs: struct<landing_page: string>"
    )
    rows = json_items(payloads, item, ["results"]).filter(F.col("id").try_cast("bigint").isNotNull())
    name = F.col("company.name")
    rows = rows.transform(settle, 
        {
            "source_id": F.col("id"),
            "title": _c("name"),
            "_hash_company": F.coalesce(name, F.lit("")),
            "location": F.coalesce(F.try_element_at("locations", F.lit(1))["name"], F.lit("")),
            "url": F.coalesce("refs.landing_page", F.lit("")),
            "experience_level": F.lit("entry_level"),
            "posted_at": parse_datetime(F.col("publication_date")),
            "company": F.coalesce(name, F.lit("Unknown")),
        }
    )
    rows = rows.transform(settle, 
        {
            "remote": infer_remote(F.col("location")),
            "dedup_hash": posting_hash(F.col("_hash_company"), F.col("title"), F.col("location")),
        }
    )
    text = F.from_json("body", "struct<contents: string>")["contents"]
    pages = newest_payload(details).select(F.col("request_key").alias("source_id"), clean_unicode(text).alias("detail_text"))
    return finalize(detail_enrich(rows, pages, ["source_id"]), "themuse")


_FLAT = (
    "id: string, site: string, title: string, company: string, location: string, jobUrl: string, "
    "job_url: string, description: string, isRemote: boolean, is_remote: string, minAmount: double, "
    "maxAmount: double, min_amount: string, max_amount: string, datePosted: string, date_posted: string"
)


def jobspy(payloads: DataFrame) -> DataFrame:
    """Flat records; the source name carries the site. One row per hash."""
    rows = json_items(payloads, _FLAT, ["", "jobs"]).filter((_c("title") != "") & (_c("company") != ""))
    rows = rows.transform(settle, 
        {
            "source_id": F.col("jobUrl"),
            "location": _c("location"),
            "remote": F.coalesce("isRemote", infer_remote(F.col("location"))),
            "url": _c("jobUrl"),
            "experience_level": classify_experience(F.col("title"), _c("description")),
            "salary_min": _rounded("minAmount"),
            "salary_max": _rounded("maxAmount"),
            "posted_at": parse_datetime(F.col("datePosted")),
            "dedup_hash": posting_hash(F.col("company"), F.col("title"), F.col("location")),
        }
    )
    rows = dedupe_by(rows, ["dedup_hash"], ["ingest_seq"])
    return finalize(rows, F.concat(F.lit("jobspy_"), _c("site", "indeed")))


def record_export(payloads: DataFrame, source: str) -> DataFrame:
    """``glassdoor`` and ``ziprecruiter``: exported records, flags may be text."""
    rows = json_items(payloads, _FLAT, ["", "jobs"]).withColumn("source_id", F.coalesce("id", "job_url"))
    rows = dedupe_by(rows.filter(_c("source_id") != ""), ["source_id"], ["ingest_seq"])
    flagged = F.lower(_c("is_remote")) == "true"
    rows = rows.transform(settle, 
        {
            "title": _c("title"),
            "company": _c("company"),
            "location": _or_null(_c("location")),
            "remote": flagged | infer_remote(F.col("location")),
            "url": _c("job_url"),
            "experience_level": classify_experience(_c("title"), _c("description")),
            "description": _or_null(F.substring(_c("description"), 1, 5000)),
            "salary_min": _rounded("min_amount"),
            "salary_max": _rounded("max_amount"),
            "posted_at": parse_datetime(F.col("date_posted")),
        }
    )
    return finalize(rows, source)


def greenhouse(payloads: DataFrame, boards: DataFrame | None = None) -> DataFrame:
    """``boards(request_key, board_name)`` names boards whose response has no company."""
    item = (
        "id: string, title: string, location: struct<name: string>, content: string, "
        "absolute_url: string, updated_at: string"
    )
    rows = json_items(payloads, item, ["jobs"], extra="company: struct<name: string>")
    rows = rows.filter(tech_prefilter(F.col("title")))
    if boards is None:
        rows = rows.withColumn("board_name", F.lit(None).cast("string"))
    else:
        rows = rows.join(boards.select("request_key", "board_name"), "request_key", "left")
    text = strip_html(_c("content"), "flat")
    rows = rows.transform(settle, 
        {
            "source_id": F.col("id"),
            "company": F.coalesce(
                blank_to_null(F.col("envelope.company.name")), _or_null(F.col("board_name")), "request_key"
            ),
            "location": F.coalesce("location.name", F.lit("")),
            "url": _c("absolute_url"),
            "experience_level": classify_experience(F.col("title"), text),
            "description": _or_null(text),
            "posted_at": parse_datetime(F.col("updated_at")),
        }
    )
    return finalize(rows.withColumn("remote", infer_remote(F.col("location"))), "greenhouse")


def lever(payloads: DataFrame) -> DataFrame:
    item = (
        "id: string, text: string, categories: struct<location: string, allLocations: array<string>>, "
        "hostedUrl: string, descriptionPlain: string, description: string, createdAt: bigint"
    )
    rows = json_items(payloads, item, [""]).filter(tech_prefilter(F.col("text")))
    rows = rows.transform(settle, 
        {
            "source_id": _c("id"),
            "title": F.col("text"),
            "company": humanize_slug(F.col("request_key"), acronyms=("ai", "io", "rx"), names=SLUG_NAMES),
            "location": F.coalesce(
                "categories.location", F.try_element_at("categories.allLocations", F.lit(1)), F.lit("")
            ),
            "url": _c("hostedUrl"),
            "description": F.coalesce("descriptionPlain", "description"),
            "posted_at": F.timestamp_millis(F.nullif("createdAt", F.lit(0))),
        }
    )
    rows = rows.transform(settle, 
        {
            "experience_level": classify_experience(F.col("title"), F.col("description")),
            "remote": infer_remote(F.col("location")),
        }
    )
    return finalize(rows, "lever")


def ashby(payloads: DataFrame, names: DataFrame) -> DataFrame:
    """``names(request_key, company_name)`` is the slug table of the platform."""
    item = (
        "id: string, title: string, location: string, isListed: boolean, isRemote: boolean, "
        "workplaceType: string, employmentType: string, descriptionPlain: string, jobUrl: string, "
        "applyUrl: string, publishedAt: string, "
        "compensation: struct<scrapeableCompensationSalarySummary: string>"
    )
    rows = json_items(payloads, item, ["jobs"]).join(
        names.select("request_key", "company_name"), "request_key", "left"
    )
    rows = rows.transform(settle, 
        {
            "source_id": js_trim(_c("id")),
            "title": js_trim(_c("title")),
            "url": js_trim(F.coalesce("jobUrl", "applyUrl", F.lit(""))),
            "location": F.coalesce(blank_to_null(F.col("location")), F.lit("Remote")),
            "description": js_trim(_c("descriptionPlain")),
            "company": F.coalesce("company_name", humanize_slug(F.col("request_key"), "[-_.]+")),
            "_pay": parse_salary(F.col("compensation.scrapeableCompensationSalarySummary"), "summary"),
        }
    )
    rows = rows.filter("title <> '' AND source_id <> '' AND url <> ''")
    rows = rows.filter(F.coalesce("isListed", F.lit(True)))
    rows = rows.filter(~_c("employmentType").isin("PartTime", "Contract") & ~is_non_us(F.col("location")))
    rows = rows.transform(settle, 
        {
            "experience_level": classify_experience(F.col("title"), F.col("description")),
            "remote": F.coalesce("isRemote", F.lit(False))
            | (_c("workplaceType") == "Remote")
            | infer_remote(F.col("location")),
            "description": _or_null(F.col("description")),
            "salary_min": F.col("_pay.min"),
            "salary_max": F.col("_pay.max"),
            "posted_at": parse_datetime(F.col("publishedAt")),
        }
    )
    return finalize(rows, "ashby")


_WORKABLE = (
    "id: string, title: string, state: string, url: string, description: string, "
    "requirementsSection: string, benefitsSection: string, created: string, updated: string, "
    "workplace: string, locations: array<string>, company: struct<title: string>, "
    "location: struct<city: string, subregion: string, countryName: string>"
)


def workable(payloads: DataFrame) -> DataFrame:
    """Search pages with the jobs payload embedded in a script, or its JSON."""
    data = embedded_object(
        F.regexp_extract("body", '(?s)"api/v1/jobs":\\{"status":(.*)', 1), ['"data":']
    )
    body = F.when(F.ltrim("body").startswith("{"), F.col("body")).otherwise(data)
    rows = json_items(payloads.withColumn("body", body), _WORKABLE, ["jobs"])
    structured = joined(
        F.col("location.city"), F.col("location.subregion"), F.col("location.countryName")
    )
    sections = [strip_html(_c(n)) for n in ("description", "requirementsSection", "benefitsSection")]
    signal = F.array_join(F.filter(F.array(*sections), lambda s: s != ""), "\n")
    remote_place = F.exists(F.array_compact(F.transform("locations", short_country)), infer_remote)
    rows = rows.transform(settle, 
        {
            "source_id": blank_to_null(F.col("id")),
            "title": blank_to_null(F.col("title")),
            "url": blank_to_null(F.col("url")),
            "_place": listed_place(F.col("locations"), structured),
            "_remote": F.coalesce(remote_place, F.lit(False)),
            "description": _or_null(sections[0]),
            "_signal": signal,
            "company": blank_to_null(F.col("company.title")),
            "posted_at": parse_datetime(F.coalesce("created", "updated")),
        }
    )
    rows = rows.transform(settle, 
        {
            "location": F.col("_place"),
            "remote": (F.lower(js_trim(_c("workplace"))) == "remote")
            | F.col("_remote")
            | infer_remote(F.col("_place")),
            "experience_level": classify_experience(F.col("title"), F.col("_signal")),
        }
    )
    rows = rows.filter("source_id IS NOT NULL AND title IS NOT NULL AND company IS NOT NULL AND url IS NOT NULL")
    rows = rows.filter((F.lower(js_trim(_c("state"))) == "published") & ~is_non_us(F.col("location")))
    return finalize(dedupe_by(rows, ["source_id"], ["ingest_seq"], keep="last"), "workable")


def recruitee(payloads: DataFrame) -> DataFrame:
    """Structured level codes go before the text."""
    item = (
        "id: string, guid: string, title: string, slug: string, city: string, country: string, "
        "location: string, locations: array<struct<city: string, country: string, name: string>>, "
        "remote: boolean, description: string, careers_url: string, company_name: string, "
        "department: string, experience_code: string, employment_type_code: string, "
        "created_at: string, published_at: string, status: string"
    )
    rows = json_items(payloads, item, ["offers"])
    rows = rows.withColumn("title", blank_to_null(F.col("title"))).filter("title IS NOT NULL")
    rows = rows.filter(F.lower(F.coalesce(blank_to_null(F.col("status")), F.lit("published"))) == "published")
    nested = F.transform(
        "locations", lambda p: F.coalesce(city_country(p["city"], p["country"]), blank_to_null(p["name"]))
    )
    place = F.coalesce(
        city_country(F.col("city"), F.col("country")),
        blank_to_null(F.col("location")),
        F.try_element_at(F.array_compact(nested), F.lit(1)),
        blank_to_null(F.col("country")),
    )
    text = strip_html(F.coalesce(blank_to_null(F.col("description")), F.lit("")), "page")
    codes = level_from_codes(F.col("experience_code"), F.col("employment_type_code"), F.col("title"))
    link, slug = blank_to_null(F.col("careers_url")), blank_to_null(F.col("slug"))
    site = F.concat(F.lit("https://"), F.col("request_key"), F.lit(".recruitee.com"))
    own_link = (
        F.when(link.rlike("^(?i)[a-z][a-z0-9+.-]*:"), link).when(link.startswith("/"), F.concat(site, link))
    )
    rows = rows.transform(settle, 
        {
            "_codes": codes,
            "_text": text,
            "source_id": F.coalesce("id", blank_to_null(F.col("guid")), slug),
            "company": F.coalesce(
                blank_to_null(F.col("company_name")),
                blank_to_null(F.col("department")),
                humanize_slug(F.col("request_key"), acronyms=("ai", "io", "qa", "hr")),
            ),
            "_place": place,
            "url": F.coalesce(own_link, F.concat(site, F.lit("/o/"), slug)),
            "posted_at": parse_datetime(
                F.coalesce(blank_to_null(F.col("created_at")), blank_to_null(F.col("published_at")))
            ),
        }
    ).filter("url IS NOT NULL AND coalesce(_codes, '') <> 'reject'")
    rows = rows.transform(settle, 
        {
            "location": F.col("_place"),
            "description": _or_null(F.col("_text")),
            "remote": F.coalesce("remote", infer_remote(F.col("_place"))),
            "experience_level": F.coalesce("_codes", classify_experience(F.col("title"), F.col("_text"))),
        }
    )
    return dedupe_by(finalize(rows, "recruitee"), ["dedup_hash"], ["ingest_seq"], keep="last")


_SECTIONS = ("companyDescription", "jobDescription", "qualifications", "additionalInformation")


def smartrecruiters(payloads: DataFrame, details: DataFrame) -> DataFrame:
    """Detail bodies are keyed by the posting id; ``request_key`` is the company."""
    item = (
        "id: string, uuid: string, name: string, releasedDate: string, ref: string, "
        "company: struct<name: string, identifier: string>, experienceLevel: struct<id: string>, "
        "location: struct<city: string, region: string, country: string, remote: boolean, fullLocation: string>"
    )
    rows = json_items(payloads, item, ["content"])
    rows = rows.transform(settle, 
        {
            "source_id": first_named(F.col("id"), F.col("uuid")),
            "title": blank_to_null(F.col("name")),
        }
    ).filter("source_id IS NOT NULL AND title IS NOT NULL")
    rows = dedupe_by(rows, ["request_key", "source_id"], ["ingest_seq"])
    rows = rows.filter(tech_prefilter(F.col("title"), kind="signal"))
    country = F.col("location.country")
    rows = rows.transform(settle, 
        {
            "_place": F.coalesce(
                blank_to_null(F.col("location.fullLocation")),
                distinct_joined(", ", F.col("location.city"), F.col("location.region"), country_name(country)),
            ),
            "_remote": F.coalesce("location.remote", F.lit(False)) | infer_remote(F.col("location.fullLocation")),
            "_home": F.coalesce(country_name(country) == "United States", F.lit(False)),
        }
    )
    allowed = F.col("_remote") | F.col("_home") | (F.col("_place").isNotNull() & ~is_non_us(F.col("_place")))
    rows = rows.filter(F.col("location").isNotNull() & allowed)
    owner = first_named(F.col("company.identifier"), F.col("request_key"))
    ref = blank_to_null(F.col("ref"))
    slug = slugify(F.col("title"))
    built = F.concat(
        F.lit("https://jobs.smartrecruiters.com/"), F.url_encode(owner), F.lit("/"), F.col("source_id"),
        F.when(slug != "", F.concat(F.lit("-"), slug)).otherwise(""),
    )
    rows = rows.transform(settle, 
        {
            "experience_level": level_from_board_id(F.col("experienceLevel.id"), F.col("title")),
            "url": F.when(~ref.contains("api.smartrecruiters.com"), ref).otherwise(built),
            "posted_at": parse_datetime(F.col("releasedDate")),
            "remote": F.col("_remote") | infer_remote(F.col("_place")),
            "location": F.col("_place"),
            "company": first_named(F.col("company.name"), F.col("request_key")),
        }
    ).filter("company IS NOT NULL")
    sections = ", ".join(f"{s}: struct<text: string>" for s in _SECTIONS)
    ad = F.from_json("body", f"struct<jobAd: struct<sections: struct<{sections}>>>")["jobAd"]["sections"]
    parts = F.array_compact(F.array(*[blank_to_null(strip_html(ad[s]["text"])) for s in _SECTIONS]))
    pages = newest_payload(details).select(
        F.col("request_key").alias("source_id"), F.array_join(parts, "\n\n").alias("detail_text")
    )
    rows = finalize(detail_enrich(rows, pages, ["source_id"]), "smartrecruiters")
    return dedupe_by(rows, ["source_id"], ["ingest_seq"], keep="last")


def careerjet(payloads: DataFrame) -> DataFrame:
    item = "url: string, title: string, description: string, locations: string, company: string"
    rows = json_items(payloads, item, ["jobs"]).filter(_c("url") != "")
    rows = dedupe_by(rows, ["url"], ["ingest_seq"])
    rows = rows.transform(settle, 
        {
            "source_id": F.col("url"),
            "title": _c("title"),
            "company": _c("company"),
            "location": _or_null(_c("locations")),
            "experience_level": classify_experience(_c("title"), _c("description")),
            "description": _or_null(F.substring(_c("description"), 1, 5000)),
            "remote": infer_remote(F.col("locations")) | infer_remote(F.col("title")),
        }
    )
    return finalize(rows, "careerjet")


def handshake(payloads: DataFrame) -> DataFrame:
    """The words ``intern`` in employment type or title force the internship level."""
    item = (
        "id: string, posting_id: string, title: string, employer_name: string, company_name: string, "
        "employer: struct<name: string>, city: string, state_name: string, state: string, location: string, "
        "remote_work_type: string, job_posting_url: string, url: string, posting_url: string, "
        "description: string, salary_min: double, salary_max: double, created_at: string, "
        "posted_at: string, employment_type: string, employment_type_name: string"
    )
    rows = json_items(payloads, item, ["results", "postings", "data", ""])
    rows = rows.withColumn("source_id", F.coalesce("id", "posting_id"))
    rows = rows.filter((_c("source_id") != "") & (_c("title") != ""))
    parts = F.array(_or_null(_c("city")), _or_null(F.coalesce("state_name", "state", F.lit(""))))
    place = F.array_join(F.array_compact(parts), ", ")
    kind = F.lower(F.coalesce("employment_type", "employment_type_name", F.lit("")))
    intern = kind.contains("intern") | F.lower("title").contains("intern")
    text = F.when(_c("description").contains("<"), strip_html(_c("description"))).otherwise(_c("description"))
    rows = rows.transform(settle, 
        {
            "company": F.coalesce("employer_name", "company_name", "employer.name", F.lit("Unknown")),
            "location": F.when(place != "", place).otherwise(_c("location")),
            "url": absolute_url(
                F.coalesce("job_posting_url", "url", "posting_url", F.lit("")), "https://app.joinhandshake.com"
            ),
            "description": text,
            "posted_at": parse_datetime(F.coalesce("created_at", "posted_at")),
            "salary_min": F.floor(F.col("salary_min") + 0.5).try_cast("int"),
            "salary_max": F.floor(F.col("salary_max") + 0.5).try_cast("int"),
            "_intern": intern,
        }
    ).filter("url <> ''")
    level = classify_experience(F.col("title"), F.col("description"))
    rows = rows.transform(settle, 
        {
            "experience_level": F.when(F.col("_intern"), "internship").otherwise(level),
            "remote": F.lower(_c("remote_work_type")).contains("remote") | infer_remote(F.col("location")),
        }
    )
    return dedupe_by(finalize(rows, "handshake"), ["source_id"], ["ingest_seq"])


def usajobs(payloads: DataFrame) -> DataFrame:
    """The pay grade overrides the level of the text."""
    descriptor = (
        "PositionTitle: string, OrganizationName: string, PositionLocationDisplay: string, "
        "PositionRemuneration: array<struct<MinimumRange: string, MaximumRange: string, RateIntervalCode: string>>, "
        "ApplyURI: array<string>, PublicationStartDate: string, QualificationSummary: string, "
        "UserArea: struct<Details: struct<LowGrade: string>>"
    )
    item = f"MatchedObjectId: string, MatchedObjectDescriptor: struct<{descriptor}>"
    rows = json_items(payloads, item, ["SearchResult.SearchResultItems"]).select(
        "ingest_seq", "MatchedObjectId", "MatchedObjectDescriptor.*"
    )
    pay = F.try_element_at("PositionRemuneration", F.lit(1))
    annual = parse_annual(pay["RateIntervalCode"], pay["MinimumRange"], pay["MaximumRange"])
    rows = rows.transform(settle, 
        {
            "title": _c("PositionTitle"),
            "company": _c("OrganizationName", "US Government"),
            "location": _or_null(_c("PositionLocationDisplay")),
            "url": F.coalesce(F.try_element_at("ApplyURI", F.lit(1)), F.lit("")),
            "description": _or_null(_c("QualificationSummary")),
            "source_id": F.col("MatchedObjectId"),
            "salary_min": annual["min"],
            "salary_max": annual["max"],
            "posted_at": parse_datetime(F.col("PublicationStartDate")),
        }
    ).filter("title <> '' AND url <> ''")
    rows = rows.transform(settle, 
        {
            "experience_level": level_from_grade(
                F.col("UserArea.Details.LowGrade"), F.col("title"), F.col("description")
            ),
            "remote": infer_remote(F.col("location")),
        }
    )
    rows = finalize(rows, "usajobs")
    return dedupe_by(rows, [F.coalesce("source_id", "dedup_hash")], ["ingest_seq"])


def workatastartup(hits: DataFrame, pages: DataFrame, details: DataFrame) -> DataFrame:
    """Search hits first, then role pages; missing descriptions from detail pages.

    Pages carry their JSON in an attribute. Detail bodies are keyed by the job id.
    """
    item = (
        "objectID: string, title: string, company_name: string, locations: array<string>, "
        "description: string, remote: boolean, created_at: double"
    )
    found = json_items(hits, item, ["hits"])
    places = F.filter("locations", lambda p: js_trim(p) != "")
    found = found.withColumn("_places", F.coalesce(places, F.array().cast("array<string>")))
    home = F.try_element_at(F.filter("_places", lambda p: ~is_non_us(p)), F.lit(1))
    found = found.select(
        js_trim(_c("objectID")).alias("source_id"),
        js_trim(_c("title")).alias("title"),
        js_trim(_c("company_name")).alias("company"),
        F.coalesce(home, F.try_element_at("_places", F.lit(1)), F.lit("")).alias("location"),
        (F.coalesce("remote", F.lit(False)) | F.exists("_places", lambda p: F.lower(p).contains("remote"))).alias("remote"),
        clean_unicode(_c("description")).alias("description"),
        clean_unicode(_c("description")).alias("_signal"),
        F.timestamp_seconds("created_at").alias("posted_at"),
        F.lit(None).cast("string").alias("url"),
        F.lit(0).alias("_tier"),
        "ingest_seq",
    )
    page_item = (
        "id: string, title: string, companyName: string, location: string, companyOneLiner: string, applyUrl: string"
    )
    listed = pages.withColumn("body", decode_entities(page_attribute(F.col("body"))))
    listed = json_items(listed, page_item, ["props.jobs"]).select(
        js_trim(_c("id")).alias("source_id"),
        js_trim(_c("title")).alias("title"),
        js_trim(_c("companyName")).alias("company"),
        js_trim(_c("location")).alias("location"),
        F.lower(_c("location")).contains("remote").alias("remote"),
        F.lit("").alias("description"),
        _c("companyOneLiner").alias("_signal"),
        F.lit(None).cast("timestamp").alias("posted_at"),
        blank_to_null(F.col("applyUrl")).alias("url"),
        F.lit(1).alias("_tier"),
        "ingest_seq",
    )
    rows = found.unionByName(listed).filter("source_id <> '' AND title <> '' AND company <> ''")
    rows = rows.filter(has_tech_signal(F.col("title")) & ~is_non_us(F.col("location")))
    level = classify_experience(F.col("title"), F.col("_signal"))
    rows = rows.withColumn("experience_level", level).filter("experience_level IS NOT NULL")
    rows = dedupe_by(rows, ["source_id"], ["_tier", "ingest_seq"])
    link = F.concat(F.lit("https://www.workatastartup.com/jobs/"), "source_id")
    rows = rows.transform(settle, {"url": F.coalesce("url", link), "location": _or_null(F.col("location"))})
    page = F.from_json(
        decode_entities(page_attribute(F.col("body"))),
        "struct<props: struct<job: struct<descriptionHtml: string>>>",
    )
    texts = newest_payload(details).select(
        F.col("request_key").alias("source_id"),
        clean_unicode(page["props"]["job"]["descriptionHtml"]).alias("detail_text"),
    )
    return finalize(detail_enrich(rows, texts, ["source_id"], only_missing=True), "workatastartup")


def rippling(boards: DataFrame, details: DataFrame) -> DataFrame:
    """Board pages and job pages with dehydrated state; details keyed by ``slug/id``.

    Titles are filtered before the detail join.
    """
    place = "array<struct<name: string, workplaceType: string>>"
    job = f"id: string, name: string, url: string, locations: {place}"
    schema = (
        "struct<props: struct<pageProps: struct<jobBoard: struct<title: string, boardURL: string>, "
        "dehydratedState: struct<queries: array<struct<queryKey: string, "
        f"state: struct<data: struct<items: array<struct<{job}>>>>>>>>>>"
    )
    state = F.from_json(next_data(F.col("body")), schema)["props"]["pageProps"]
    queries = F.filter(
        state["dehydratedState"]["queries"],
        lambda q: (F.from_json(q["queryKey"], "array<string>")[2] == "job-posts")
        & q["state"]["data"]["items"].isNotNull(),
    )
    rows = boards.withColumn("_page", state).select(
        "request_key",
        "fetch_seq",
        F.col("_page.jobBoard.title").alias("board_title"),
        F.col("_page.jobBoard.boardURL").alias("board_url"),
        F.posexplode(F.try_element_at(queries, F.lit(1))["state"]["data"]["items"]).alias("pos", "item"),
    )
    rows = rows.select("request_key", "board_title", "board_url", (F.shiftleft("fetch_seq", 32) + F.col("pos")).alias("ingest_seq"), "item.*")
    rows = rows.transform(settle, {"title": blank_to_null(F.col("name")), "job_id": blank_to_null(F.col("id"))})
    rows = rows.filter("title IS NOT NULL AND job_id IS NOT NULL").filter(has_tech_signal(F.col("title")))
    rows = rows.filter(classify_experience(F.col("title")).isNotNull())
    rows = dedupe_by(rows, ["request_key", "job_id"], ["ingest_seq"], keep="last")
    post = (
        "uuid: string, url: string, companyName: string, createdOn: string, "
        f"workLocations: {place}, description: struct<company: string, role: string>"
    )
    detail = F.from_json("body", f"struct<pageProps: struct<apiData: struct<jobPost: struct<{post}>>>>")
    pages = newest_payload(details).select(
        F.split("request_key", "/")[0].alias("request_key"),
        F.split("request_key", "/")[1].alias("job_id"),
        detail["pageProps"]["apiData"]["jobPost"].alias("post"),
    )
    rows = rows.join(pages, ["request_key", "job_id"], "left")
    parts = [_or_null(strip_html(F.col(f"post.description.{p}"), "sections")) for p in ("company", "role")]
    places = F.when(F.size("post.workLocations") > 0, F.col("post.workLocations")).otherwise(F.col("locations"))
    rows = rows.transform(settle, 
        {
            "description": _or_null(F.array_join(F.array_compact(F.array(*parts)), "\n\n")),
            "_places": places,
        }
    )
    names = F.array_distinct(F.array_compact(F.transform("_places", lambda p: blank_to_null(p["name"]))))
    on_remote = F.exists("_places", lambda p: p["workplaceType"] == "REMOTE")
    default_url = F.concat(F.lit("https://ats.rippling.com/"), "request_key", F.lit("/jobs/"), "job_id")
    rows = rows.transform(settle, 
        {
            "location": _or_null(F.array_join(names, " | ")),
            "company": F.coalesce(
                blank_to_null(F.col("post.companyName")), blank_to_null(F.col("board_title")),
                humanize_slug(F.col("request_key")),
            ),
            "url": F.coalesce("post.url", "url", "board_url", default_url),
            "source_id": F.concat("request_key", F.lit(":"), F.coalesce("post.uuid", "job_id")),
            "posted_at": parse_datetime(F.col("post.createdOn")),
            "experience_level": classify_experience(F.col("title"), F.col("description")),
            "_remote": F.coalesce(on_remote, F.lit(False)),
        }
    )
    rows = rows.withColumn("remote", F.col("_remote") | infer_remote(F.col("location")))
    return dedupe_by(finalize(rows, "rippling"), ["source_id"], ["ingest_seq"], keep="last")


def builtin_api(payloads: DataFrame) -> DataFrame:
    """Three envelope forms; dates without a zone are UTC."""
    item = (
        "id: string, title: string, companyDetails: struct<name: string>, city: string, state: string, "
        "description: string, remote: boolean, builtinUrl: string, salaryMin: double, salaryMax: double, "
        "datePosted: string"
    )
    rows = json_items(payloads, item, ["jobs", "data.jobs", "results"])
    text = F.substring("description", 1, 5000)
    parts = F.array_compact(F.array(_or_null(_c("city")), _or_null(_c("state"))))
    rows = rows.transform(settle, 
        {
            "source_id": F.col("id"),
            "title": js_trim(_c("title")),
            "company": js_trim(F.coalesce("companyDetails.name", F.lit(""))),
            "location": _or_null(js_trim(F.array_join(parts, ", "))),
            "description": text,
            "remote": F.coalesce("remote", F.lit(False)),
            "url": F.concat(
                F.lit("https://builtin.com"),
                F.coalesce(_or_null(F.col("builtinUrl")), F.concat(F.lit("/job/"), "id")),
            ),
            "salary_min": F.nullif(F.col("salaryMin").try_cast("int"), F.lit(0)),
            "salary_max": F.nullif(F.col("salaryMax").try_cast("int"), F.lit(0)),
            "posted_at": parse_zoneless(F.col("datePosted")),
            "experience_level": classify_experience(_c("title"), text),
        }
    ).filter("source_id IS NOT NULL AND title <> '' AND company <> ''")
    return dedupe_by(finalize(rows, "builtin"), ["source_id"], ["ingest_seq"])


_SEARCH = (
    "guid: string, id: string, title: string, summary: string, description: string, companyName: string, "
    "company: string, jobLocation: struct<displayName: string>, location: string, detailsPageUrl: string, "
    "url: string, salary: string, workplaceTypes: array<string>, isRemote: boolean, postedDate: string, "
    "modifiedDate: string, date: string"
)


def search_jobs(rows: DataFrame, as_of: Column) -> DataFrame:
    """Common tail of the ``dice`` forms: API rows, JSON-LD objects and result cards."""
    names = F.transform("workplaceTypes", lambda t: F.lower(t))
    raw_url = F.coalesce("detailsPageUrl", "url", F.lit(""))
    pay = parse_salary(F.col("salary"), "numbers")
    rows = rows.transform(settle, 
        {
            "title": js_trim(_c("title")),
            "description": js_trim(F.coalesce("summary", "description", F.lit(""))),
            "company": F.coalesce(blank_to_null(F.coalesce("companyName", "company")), F.lit("Unknown")),
            "location": js_trim(F.coalesce("jobLocation.displayName", "location", F.lit(""))),
            "url": absolute_url(raw_url, "https://www.dice.com"),
            "salary_min": pay["min"],
            "salary_max": pay["max"],
            "_remote": F.coalesce("isRemote", F.lit(False))
            | F.coalesce(F.array_contains(names, "remote"), F.lit(False)),
            "posted_at": F.coalesce(
                parse_posted(F.coalesce("postedDate", "modifiedDate"), as_of, "chip"),
                parse_posted(F.col("date"), as_of, "chip"),
            ),
        }
    )
    rows = rows.transform(settle, 
        {
            "source_id": F.coalesce("guid", "id", "url"),
            "remote": F.col("_remote") | infer_remote(F.col("location")),
            "experience_level": classify_experience(F.col("title"), F.col("description")),
            "description": _or_null(F.col("description")),
        }
    ).filter("title <> '' AND url <> ''")
    return dedupe_by(finalize(rows, "dice"), ["url"], ["ingest_seq"])


def dice_api(payloads: DataFrame, as_of: Column) -> DataFrame:
    return search_jobs(json_items(payloads, _SEARCH, ["data"]), as_of)
