"""Boards that land as HTML or XML, most of them enriched by detail pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.classify import (
    classify_experience,
    has_tech_signal,
    infer_roles,
    infer_target_roles,
    staged_reject_reason,
)
from ..functions.dates import parse_datetime, parse_posted, parse_zoneless
from ..functions.keys import posting_hash
from ..functions.location import infer_remote, is_non_us, keep_office, office_remote
from ..functions.places import address, first_named, joined, state_code_place
from ..functions.regex import first_match, has_pattern
from ..functions.salary import parse_salary
from ..functions.text import (
    blank_to_null,
    clean_unicode,
    decode_entities,
    decode_named,
    humanize_slug,
    js_trim,
    squash_ws,
    strip_html,
)
from ..operators.dedup import dedupe_by
from ..settle import settle
from .boards import search_jobs
from .canonical import finalize, normalize_posting
from .readers import (
    absolute_url,
    blocks,
    cards,
    detail_enrich,
    newest_payload,
    embedded_object,
    first_nonempty_payload,
    json_items,
    json_ld_place,
    json_ld_posting,
    nested_objects,
    plain_tag,
    tag,
    tag_text,
    tag_texts,
)


def _c(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def _or_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def _text(block: Column, pattern: str, dialect: str = "block") -> Column:
    """Readable text of the first group; null when nothing is left."""
    return _or_null(strip_html(first_match(block, pattern), dialect))


# -- Listings with a detail page: two role gates ------------------------------------------


def _gated(rows: DataFrame, signal: list[str]) -> DataFrame:
    """Listings whose listing text names a feed role."""
    text = F.concat_ws("\n", *[_c(n) for n in signal])
    return rows.filter(F.size(infer_target_roles(text)) > 0)


def _with_detail(
    listings: DataFrame,
    details: DataFrame,
    source: str,
    remote: Column,
    signal: list[str] = [],
    fallback: Column | None = None,
) -> DataFrame:
    """Detail values override the listing; the role gate runs again on the longer text.

    Expects ``request_key``, ``source_id``, ``title``, ``company``, ``url``, ``location``
    and ``posted_text``. Internships are dropped: these boards feed full-time lists.
    """
    pages = newest_payload(details).select(
        F.col("request_key").alias("url"),
        F.col("body").alias("page"),
        json_ld_posting(F.col("body")).alias("ld"),
    )
    rows = listings.join(pages, "url", "inner")
    ld = F.col("ld")
    text = strip_html(ld["description"] if fallback is None else F.coalesce(ld["description"], fallback))
    if fallback is not None:
        text = F.coalesce(_or_null(text), "summary")
    rows = rows.transform(settle, 
        {
            "description": F.coalesce(text, F.lit("")),
            "title": F.coalesce(blank_to_null(ld["title"]), "title"),
            "company": F.coalesce(blank_to_null(ld["hiringOrganization"]["name"]), "company"),
            "location": json_ld_place(ld, F.col("location")),
            "posted_text": F.coalesce(blank_to_null(ld["datePosted"]), "posted_text"),
            "_kind": F.lower(F.coalesce(ld["jobLocationType"], F.lit(""))),
        }
    )
    rows = rows.transform(settle, 
        {
            "roles": infer_target_roles(F.concat_ws("\n", "title", *[_c(s) for s in signal], "description")),
            "remote": remote,
            "experience_text": F.col("description"),
        }
    ).filter(F.size("roles") > 0)
    out = normalize_posting(rows, source).filter("experience_level <> 'internship' AND size(roles) > 0")
    return dedupe_by(out, [F.coalesce("source_id", "url")], ["ingest_seq"], keep="last")



def _place_remote() -> Column:
    return F.lower(_c("location")).contains("remote") | F.col("_kind").contains("remote")


def _boards(rows: DataFrame, names: DataFrame) -> DataFrame:
    """``names(request_key, company_name)`` gives the company of a board."""
    joined_rows = rows.join(names.select("request_key", "company_name"), "request_key", "left")
    return joined_rows.withColumn("company", F.coalesce("company_name", "request_key"))


_BREEZY_PLACE = (
    "struct<name: string, city: string, state: struct<id: string, name: string>, "
    "country: struct<id: string, name: string>, is_remote: boolean>"
)


def breezy(payloads: DataFrame, names: DataFrame, details: DataFrame) -> DataFrame:
    item = (
        "id: string, friendly_id: string, name: string, url: string, published_date: string, "
        f"department: string, company: struct<name: string>, location: {_BREEZY_PLACE}, "
        f"locations: array<{_BREEZY_PLACE}>"
    )
    rows = json_items(payloads, item, [""])
    places = F.array_compact(
        F.concat(F.array("location"), F.coalesce("locations", F.array().cast(f"array<{_BREEZY_PLACE}>")))
    )

    def shown(p: Column) -> Column:
        state = first_named(p["state"]["id"], p["state"]["name"])
        return F.coalesce(blank_to_null(p["name"]), joined(p["city"], state), blank_to_null(p["country"]["name"]))

    def preferred(p: Column) -> Column:
        home = (p["country"]["id"] == "US") | (p["country"]["name"] == "United States")
        remote = F.when(F.coalesce(p["is_remote"], F.lit(False)), "Remote, United States")
        return F.when(shown(p).isNotNull(), F.coalesce(remote, F.when(home, shown(p))))

    best = F.coalesce(
        F.try_element_at(F.array_compact(F.transform("_places", preferred)), F.lit(1)),
        F.try_element_at(F.array_compact(F.transform("_places", shown)), F.lit(1)),
    )
    rows = _boards(rows.withColumn("_owner", blank_to_null(F.col("company.name"))).withColumn("_places", places), names)
    rows = rows.withColumn("_best", best).transform(settle, 
        {
            "source_id": first_named(F.col("id"), F.col("friendly_id")),
            "title": blank_to_null(F.col("name")),
            "url": blank_to_null(F.col("url")),
            "company": F.coalesce("_owner", "company"),
            "location": F.col("_best"),
            "posted_text": F.col("published_date"),
            "_listed_remote": F.exists("_places", lambda p: F.coalesce(p["is_remote"], F.lit(False)))
            | F.lower(_c("_best")).contains("remote"),
        }
    )
    rows = rows.filter("source_id IS NOT NULL AND title IS NOT NULL AND url IS NOT NULL")
    rows = _gated(rows, ["title", "department", "location"])
    remote = F.col("_listed_remote") | F.col("_kind").contains("remote")
    return _with_detail(rows, details, "breezy", remote)


def icims(payloads: DataFrame, names: DataFrame, details: DataFrame) -> DataFrame:
    rows = cards(payloads, '<li class="iCIMS_JobCardItem">', "</li>")
    block = F.col("block")
    heads = F.regexp_extract_all(block, F.lit('(?s)<div class="iCIMS_JobHeaderTag">(.*?)</div>'), F.lit(1))

    def field(*labels: str) -> Column:
        hits = F.filter(heads, lambda h: squash_ws(strip_html(tag(h, "dt"))).isin(*labels))
        return squash_ws(strip_html(tag(F.try_element_at(hits, F.lit(-1)), "dd")))

    url = first_match(block, '(?i)<a href="([^"]+/jobs/\\d+/[^"]+/job\\?[^"]*)"')
    rows = _boards(rows, names).transform(settle, 
        {
            "url": url,
            "title": _or_null(strip_html(tag(block, "h3"))),
            "source_id": first_match(url, "/jobs/(\\d+)/"),
            "category": _or_null(field("Category")),
            "summary": _text(block, '(?is)<div class="col-xs-12 description">(.*?)</div>'),
            "location": state_code_place(field("Job Location", "JobLocation")),
            "posted_text": F.lit(None).cast("string"),
        }
    ).filter("url IS NOT NULL AND title IS NOT NULL AND source_id IS NOT NULL")
    rows = _gated(rows, ["title", "category", "summary"])
    text = F.lower(F.concat_ws("\n", _c("location"), _c("description")))
    remote = F.col("_kind").contains("telecommute") | F.col("_kind").contains("remote") | text.contains("remote")
    content = F.coalesce(
        first_match(F.col("page"), '(?is)<div class="iCIMS_JobContent">(.*?)</div>'), "summary"
    )
    return _with_detail(rows, details, "icims", remote, ["category"], content)


def jazzhr(payloads: DataFrame, names: DataFrame, details: DataFrame) -> DataFrame:
    # A card holds list items of its own, so it runs to the next card, not to ``</li>``.
    rows = cards(payloads, '<li class="list-group-item">')
    block = F.col("block")
    facts = F.regexp_extract_all(
        block, F.lit("(?is)<li>\\s*<i class='fa fa-[^']+'></i>(.*?)</li>"), F.lit(1)
    )
    facts = F.filter(F.transform(facts, lambda f: strip_html(f)), lambda f: f != "")
    url = blank_to_null(first_match(block, '(?i)<a href="([^"]+)"'))
    rows = _boards(rows, names).transform(settle, 
        {
            "url": url,
            "title": _or_null(strip_html(tag(block, "h3"))),
            "source_id": F.coalesce(
                first_match(url, "(?i)/apply/([^/]+)"), first_match(url, "(?i)/app/share/([^/?#]+)")
            ),
            "location": F.try_element_at(facts, F.lit(1)),
            "department": F.try_element_at(facts, F.lit(2)),
            "posted_text": F.lit(None).cast("string"),
        }
    ).filter("url IS NOT NULL AND title IS NOT NULL AND source_id IS NOT NULL")
    rows = _gated(rows, ["title", "department", "location"])
    return _with_detail(rows, details, "jazzhr", _place_remote(), ["department"])


def jobvite(payloads: DataFrame, names: DataFrame, details: DataFrame) -> DataFrame:
    row = (
        '(?is)<tr>\\s*<td class="jv-job-list-name">\\s*(<a href="[^"]+">.*?</a>\\s*</td>\\s*'
        '<td class="jv-job-list-location">.*?)</td>\\s*</tr>'
    )
    rows = blocks(payloads, row)
    block = F.col("block")
    href = first_match(block, '(?i)<a href="([^"]+)"')
    host = F.lit("https://jobs.jobvite.com")
    url = (
        F.when(href.rlike("^https?://"), href)
        .when(href.startswith("/"), F.concat(host, href))
        .otherwise(F.concat(host, F.lit("/"), href))
    )
    rows = _boards(rows, names).transform(settle, 
        {
            "url": url,
            "title": _text(block, '(?is)<a href="[^"]+">(.*?)</a>'),
            "location": _text(block, '(?is)<td class="jv-job-list-location">(.*)'),
            "source_id": first_match(url, "(?i)/job/([^/?#]+)"),
            "posted_text": F.lit(None).cast("string"),
        }
    ).filter("title IS NOT NULL AND source_id IS NOT NULL")
    rows = _gated(rows, ["title", "location"])
    return _with_detail(rows, details, "jobvite", _place_remote())


def oraclecloud(payloads: DataFrame, sites: DataFrame, details: DataFrame) -> DataFrame:
    """``sites(request_key, company_name, base_url, site_number)``; details keyed by
    ``request_key/id``."""
    item = "requisitionList: array<struct<Id: string, Title: string, PostedDate: string, PrimaryLocation: string, WorkplaceType: string>>"
    pages = json_items(payloads, item, ["items"])
    pages = dedupe_by(pages, ["run_id", "request_key", "fetch_seq"], ["ingest_seq"])
    rows = pages.select(
        "request_key", "fetch_seq", F.posexplode("requisitionList").alias("pos", "item")
    ).select("request_key", (F.shiftleft("fetch_seq", 32) + F.col("pos")).alias("ingest_seq"), "item.*")
    rows = rows.transform(settle, {"source_id": blank_to_null(F.col("Id")), "title": blank_to_null(F.col("Title"))})
    rows = rows.filter("source_id IS NOT NULL AND title IS NOT NULL")
    rows = _gated(rows, ["title"])
    rows = dedupe_by(rows, ["request_key", "source_id"], ["ingest_seq"], keep="last")
    rows = rows.join(sites, "request_key").withColumn("company", F.col("company_name"))
    place = "array<struct<TownOrCity: string, Region2: string, Country: string, LocationName: string>>"
    detail = (
        "Title: string, PostedDate: string, PrimaryLocation: string, WorkplaceType: string, "
        "ExternalDescriptionStr: string, ExternalQualificationsStr: string, ExternalResponsibilitiesStr: string, "
        f"workLocation: {place}, otherWorkLocations: {place}"
    )
    d = F.coalesce(
        F.from_json("body", f"struct<items: array<struct<{detail}>>>")["items"][0], F.from_json("body", f"struct<{detail}>")
    )
    parts = F.split("request_key", "/")
    found = newest_payload(details).select(parts[0].alias("request_key"), parts[1].alias("source_id"), d.alias("d"))
    rows = rows.join(found, ["request_key", "source_id"])
    sections = F.array(*[_or_null(F.col(f"d.External{s}Str")) for s in ("Description", "Qualifications", "Responsibilities")])
    empty = F.array().cast(place)
    places = F.concat(F.coalesce("d.workLocation", empty), F.coalesce("d.otherWorkLocations", empty))
    shown = F.transform(
        places,
        lambda p: F.coalesce(address(p["TownOrCity"], p["Region2"], p["Country"]), blank_to_null(p["LocationName"])),
    )
    rows = rows.transform(settle, 
        {
            "description": strip_html(F.array_join(F.array_compact(sections), "\n\n")),
            "title": F.coalesce(blank_to_null(F.col("d.Title")), "title"),
            "location": F.coalesce(
                F.try_element_at(F.array_compact(shown), F.lit(1)),
                blank_to_null(F.col("d.PrimaryLocation")),
                blank_to_null(F.col("PrimaryLocation")),
            ),
            "posted_text": F.coalesce("d.PostedDate", "PostedDate"),
            "url": F.concat(
                "base_url", F.lit("/hcmUI/CandidateExperience/en/sites/"), "site_number", F.lit("/job/"), "source_id"
            ),
        }
    )
    kind = F.lower(F.concat_ws(" ", "WorkplaceType", "d.WorkplaceType"))
    rows = rows.transform(settle, 
        {
            "remote": kind.contains("remote") | F.lower(_c("location")).contains("remote"),
            "roles": infer_target_roles(F.concat_ws("\n", "title", "description")),
            "experience_text": F.col("description"),
        }
    ).filter(F.size("roles") > 0)
    out = normalize_posting(rows, "oraclecloud").filter("experience_level <> 'internship' AND size(roles) > 0")
    return dedupe_by(out, ["url"], ["ingest_seq"], keep="last")


# -- XML ----------------------------------------------------------------------------------


def personio(payloads: DataFrame) -> DataFrame:
    """Position feeds; roles from the title, else from the description."""
    rows = blocks(payloads, "(?s)<position>(.*?)</position>")
    block = F.col("block")
    texts = F.transform(
        F.regexp_extract_all(block, F.lit("(?is)<jobDescription>(.*?)</jobDescription>"), F.lit(1)),
        lambda b: tag_text(b, "value"),
    )
    number = F.coalesce(tag_text(block, "id"), F.lit(""))
    built = F.concat(
        F.lit("https://"), F.col("request_key"), F.lit(".jobs.personio.de/job/"), number, F.lit("?language=en")
    )
    more = F.regexp_extract(block, "(?is)<additionalOffices>(.*?)</additionalOffices>", 1)
    rows = rows.transform(settle, 
        {
            "title": F.coalesce(tag_text(block, "title"), tag_text(block, "name")),
            "location": tag_text(block, "office"),
            "description": _or_null(F.array_join(F.array_compact(texts), "\n\n")),
            "_more": tag_texts(more, "office"),
            "url": F.coalesce(tag_text(block, "url"), F.when(number != "", built)),
            "company": humanize_slug(F.col("request_key"), "-+"),
        }
    ).filter("title IS NOT NULL AND url IS NOT NULL")
    rows = rows.filter(keep_office(F.col("location"), F.col("description"), F.col("_more")))
    rows = rows.transform(settle, {"_by_title": infer_roles(F.col("title"))})
    by_title = F.col("_by_title")
    path = F.regexp_extract("url", "^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    rows = rows.transform(settle, 
        {
            "remote": office_remote(F.col("location"), F.col("description"), F.col("_more")),
            "source_id": first_match(path, "([^/]+)/*$"),
            "experience_level": classify_experience(F.col("title"), F.col("description")),
            "roles": F.when((F.size(by_title) > 0) | F.col("description").isNull(), by_title).otherwise(
                infer_roles(F.col("description"))
            ),
        }
    )
    return dedupe_by(finalize(rows, "personio"), ["dedup_hash"], ["ingest_seq"], keep="last")


def dice_rss(payloads: DataFrame) -> DataFrame:
    rows = blocks(payloads, "(?s)<item>(.*?)</item>")
    block = F.col("block")
    rows = rows.transform(settle, 
        {
            "title": plain_tag(block, "title"),
            "url": plain_tag(block, "link"),
            "description": _or_null(strip_html(plain_tag(block, "description"), "line")),
            "company": F.coalesce(_or_null(plain_tag(block, "source")), F.lit("Unknown")),
            "location": _or_null(plain_tag(block, "location")),
            "posted_at": parse_datetime(plain_tag(block, "pubDate")),
        }
    ).filter("title <> '' AND url <> ''")
    rows = rows.transform(settle, 
        {
            "source_id": F.element_at(F.split("url", "/"), -1),
            "remote": infer_remote(F.col("location")),
            "experience_level": classify_experience(F.col("title"), F.col("description")),
        }
    )
    rows = finalize(rows, "dice_rss")
    return dedupe_by(rows, ["source_id"], ["ingest_seq"])


# -- HTML ---------------------------------------------------------------------------------

# Titles that are no postings, and the titles of an untouched demo board.
GENERIC_TITLES = [
    "general application", "open application", "talent community", "future opportunity",
    "future opportunities", "demo job",
]
DEMO_TITLES = [
    "financial analyst", "general application", "it security engineer", "marketing manager",
    "software engineer",
]


def _without_demo(rows: DataFrame) -> DataFrame:
    """Boards whose titles are exactly the demo titles are dropped.

    Only the number of titles and of demo titles per board is grouped, never the rows.
    """
    lower = F.lower("title")
    boards = rows.groupBy("request_key").agg(
        F.count("*").alias("n"), F.count_distinct(F.when(lower.isin(DEMO_TITLES), lower)).alias("demo")
    )
    demo = boards.filter((F.col("n") == len(DEMO_TITLES)) & (F.col("demo") == len(DEMO_TITLES)))
    return rows.join(demo.select("request_key"), "request_key", "left_anti")


def bamboohr(embeds: DataFrame, careers: DataFrame) -> DataFrame:
    """The embedded list of a board, or its JSON list when the embed gives no rows."""
    pages = embeds.filter(F.col("body").contains("BambooHR-ATS-board"))
    card = (
        '(?s)(<li[^>]*id="bhrPositionID_\\d+".*?<a href="[^"]+">.*?</a>.*?'
        '<span[^>]*class="BambooHR-ATS-Location"[^>]*>.*?</span>)'
    )
    block = F.col("block")
    inner = lambda p: squash_ws(F.regexp_replace(decode_entities(first_match(block, p)), "<[^>]+>", " "))
    href = first_match(block, '<a href="([^"]+)"')
    site = F.concat(F.lit("https://"), F.col("request_key"), F.lit(".bamboohr.com"))
    url = (
        F.when(href.rlike("^https?://"), href)
        .when(href.startswith("//"), F.concat(F.lit("https:"), href))
        .when(href.startswith("/"), F.concat(site, href))
        .otherwise(F.concat(site, F.lit("/"), href))
    )
    listed = blocks(pages, card).select(
        "request_key",
        "ingest_seq",
        first_match(block, 'id="bhrPositionID_(\\d+)"').alias("source_id"),
        F.coalesce(inner('(?s)<a href="[^"]+">(.*?)</a>'), F.lit("")).alias("title"),
        F.coalesce(inner('(?s)class="BambooHR-ATS-Location"[^>]*>(.*?)</span>'), F.lit("")).alias("location"),
        url.alias("url"),
        F.lit(False).alias("_remote"),
        F.lit(0).alias("priority"),
    )
    item = (
        "id: string, jobOpeningName: string, isRemote: boolean, locationType: string, "
        "location: struct<city: string, state: string>, "
        "atsLocation: struct<city: string, state: string, province: string, country: string>"
    )
    rows = json_items(careers, item, ["result"]).filter((_c("id") != "") & (_c("jobOpeningName") != ""))
    ats = F.col("atsLocation")
    fallback = F.array(
        _or_null(ats["city"]), _or_null(F.coalesce(ats["state"], ats["province"])), _or_null(ats["country"])
    )
    direct = F.array(_or_null(F.col("location.city")), _or_null(F.col("location.state")))
    place = F.coalesce(
        _or_null(F.array_join(F.array_compact(direct), ", ")), F.array_join(F.array_compact(fallback), ", ")
    )
    json_rows = rows.select(
        "request_key",
        "ingest_seq",
        F.col("id").alias("source_id"),
        F.col("jobOpeningName").alias("title"),
        place.alias("location"),
        F.concat(site, F.lit("/careers/"), "id").alias("url"),
        (F.coalesce("isRemote", F.lit(False)) | (_c("locationType") == "2")).alias("_remote"),
        F.lit(1).alias("priority"),
    )
    both = _without_demo(listed).unionByName(_without_demo(json_rows))
    rows = first_nonempty_payload(both).transform(settle, 
        {"title": js_trim(F.col("title")), "location": js_trim(F.col("location"))}
    )
    generic = F.lower("title").rlike("|".join(GENERIC_TITLES))
    rows = rows.filter("title <> '' AND url <> ''").filter(~generic & ~is_non_us(F.col("location")))
    rows = rows.transform(settle, 
        {
            "company": humanize_slug(F.col("request_key")),
            "remote": F.col("_remote") | infer_remote(F.col("location")),
            "experience_level": classify_experience(F.col("title")),
        }
    )
    return finalize(rows, "bamboohr")


def builtin_pages(payloads: DataFrame) -> DataFrame:
    """Result pages: cards, with dates and descriptions from two maps keyed by card id."""
    dates = F.map_from_arrays(
        F.regexp_extract_all("body", F.lit("'id':\\s*(\\d+)\\s*,\\s*'published_date':'([^']+)'"), F.lit(1)),
        F.regexp_extract_all("body", F.lit("'id':\\s*(\\d+)\\s*,\\s*'published_date':'([^']+)'"), F.lit(2)),
    )
    script = first_match(
        F.col("body"), '(?is)<script[^>]*type="application/ld(?:&#x2B;|\\+)json"[^>]*>(.*?)</script>'
    )
    graph = F.from_json(
        script,
        "struct<`@graph`: array<struct<`@type`: string, itemListElement: array<struct<url: string, description: string>>>>>",
    )["@graph"]
    items = F.try_element_at(F.filter(graph, lambda g: g["@type"] == "ItemList"), F.lit(1))["itemListElement"]
    pages = payloads.select("request_key", "run_id", "fetch_seq", "body", dates.alias("_dates"), items.alias("_items"))
    parts = F.split("body", '(?=<div id="job-card-\\d+")', -1)
    rows = pages.select(
        "request_key", "fetch_seq", "_dates", "_items", F.posexplode(parts).alias("pos", "block")
    ).withColumn("ingest_seq", F.shiftleft("fetch_seq", 32) + F.col("pos"))
    block = F.col("block")

    def after_icon(icon: str) -> Column:
        pattern = (
            f'(?is){icon}[^>]*></i></div>\\s*(?:<div>)?\\s*<span class="font-barlow text-gray-04">(.*?)</span>'
        )
        return _text(block, pattern)

    card_id = first_match(block, '<div id="job-card-(\\d+)"')
    described = F.filter("_items", lambda i: first_match(i["url"], "/(\\d+)(?:[/?#]|$)") == F.col("source_id"))
    link = '(?is)<a[^>]*href="([^"]+)"[^>]*data-id="job-card-title"[^>]*>(.*?)</a>'
    pay = parse_salary(after_icon("fa-sack-dollar"), "tokens")
    rows = rows.withColumn("source_id", card_id).filter("source_id IS NOT NULL").transform(settle, 
        {
            "title": _or_null(strip_html(first_match(block, link, 2))),
            "company": _text(block, '(?is)data-id="company-title"[^>]*>\\s*<span>(.*?)</span>'),
            "url": absolute_url(decode_entities(first_match(block, link)), "https://builtin.com"),
            "location": after_icon("fa-location-dot"),
            "_mode": after_icon("fa-house-building"),
            "description": F.substring(
                F.coalesce(
                    _or_null(strip_html(F.try_element_at(described, F.lit(-1))["description"])),
                    _text(block, '(?is)<div class="fs-sm fw-regular mb-md text-gray-04">(.*?)</div>'),
                ),
                1,
                5000,
            ),
            "salary_min": pay["min"],
            "salary_max": pay["max"],
            "posted_at": parse_zoneless(F.try_element_at("_dates", F.col("source_id"))),
        }
    ).filter("title IS NOT NULL AND company IS NOT NULL AND url IS NOT NULL")
    rows = rows.transform(settle, 
        {
            "remote": has_pattern(F.concat_ws("\n", "_mode", "location"), [r"\bremote\b"]),
            "experience_level": classify_experience(F.col("title"), F.col("description")),
        }
    )
    return dedupe_by(finalize(rows, "builtin"), ["source_id"], ["ingest_seq"])


_RESULT_CARD = '(?is)(<div[^>]*data-jobkey="[^"]+"[^>]*data-testid="searchSerpJob".*?</div>\\s*</li>)'


def result_cards(payloads: DataFrame, host: str) -> DataFrame:
    """Search result cards of ``dice`` and ``simplyhired`` with raw field texts."""
    rows = blocks(payloads, _RESULT_CARD)
    block = F.col("block")

    def part(pattern: str, group: int = 1) -> Column:
        text = strip_html(first_match(block, f"(?is){pattern}", group), "line")
        return F.coalesce(decode_named(text, apostrophe=True), F.lit(""))

    chips = F.regexp_extract_all(
        block,
        F.lit('(?is)data-testid="(?:jobTypeChip|requirementChip|benefitChip)-\\d+"[^>]*>(.*?)</span>'),
        F.lit(1),
    )
    chips = F.transform(chips, lambda c: decode_named(strip_html(c, "line"), apostrophe=True))
    link = 'data-testid="searchSerpJobTitle".*?<a[^>]*href="([^"]+)"[^>]*>(.*?)</a>'
    href = decode_named(F.coalesce(first_match(block, f"(?is){link}"), F.lit("")), apostrophe=True)
    rows = rows.transform(settle, 
        {
            "id": first_match(block, '(?i)data-jobkey="([^"]+)"'),
            "title": part(link, 2),
            "companyName": part('data-testid="companyName">(.*?)</span>'),
            "location": part('data-testid="searchSerpJobLocation"[^>]*>(.*?)</span>'),
            "postedDate": part('data-testid="searchSerpJobDateStamp"[^>]*>(.*?)</p>'),
            "salary": part('data-testid="salaryChip-\\d+"[^>]*>(.*?)</span>'),
            "url": absolute_url(href, host),
            "description": F.array_join(chips, " "),
            "isRemote": F.exists(chips, lambda c: has_pattern(c, [r"\b(remote|hybrid|work from home)\b"])),
        }
    )
    return rows.filter("title <> '' AND companyName <> '' AND url <> ''")


_PAGE = ["run_id", "request_key", "fetch_seq"]
_FOUND = [
    *_PAGE, "id", "title", "companyName", "location", "postedDate", "salary", "url", "description",
    "isRemote", "ingest_seq",
]


def _ld_search_rows(payloads: DataFrame) -> DataFrame:
    """JSON-LD postings at any depth, in the field names of the search forms."""
    scripts = blocks(payloads, '(?is)<script[^>]*type="application/ld\\+json"[^>]*>(.*?)</script>')
    objects = scripts.select(
        "run_id",
        "request_key",
        "fetch_seq",
        "ingest_seq",
        F.posexplode(nested_objects(F.col("block"), [], "JobPosting")).alias("p", "json"),
    )
    schema = (
        "identifier: string, url: string, title: string, hiringOrganization: struct<name: string>, "
        "jobLocation: string, datePosted: string, baseSalary: string, description: string"
    )
    seq = F.shiftleft("fetch_seq", 32) + F.pmod("ingest_seq", F.lit(1 << 32)) * 65536 + F.col("p")
    rows = objects.select(*_PAGE, seq.alias("ingest_seq"), F.from_json("json", f"struct<{schema}>").alias("o"))
    rows = rows.select(*_PAGE, "ingest_seq", "o.*")
    place = strip_html(F.col("jobLocation"), "line")
    return rows.select(
        *_PAGE,
        "ingest_seq",
        F.coalesce(F.from_json("identifier", "struct<value: string>")["value"], "identifier", "url").alias("id"),
        "title",
        F.col("hiringOrganization.name").alias("companyName"),
        F.coalesce(place, F.lit("")).alias("location"),
        F.col("datePosted").alias("postedDate"),
        strip_html(F.col("baseSalary"), "line").alias("salary"),
        "url",
        strip_html(F.col("description"), "line").alias("description"),
        has_pattern(F.coalesce(place, F.lit("")), [r"\bremote\b"]).alias("isRemote"),
    )


_SEARCH_COLUMNS = {
    "guid": "string", "summary": "string", "company": "string", "jobLocation": "struct<displayName: string>",
    "detailsPageUrl": "string", "workplaceTypes": "array<string>", "modifiedDate": "string", "date": "string",
}


def dice_pages(payloads: DataFrame, as_of: Column) -> DataFrame:
    """Search pages: JSON-LD when a page has any, else its result cards."""
    ld = _ld_search_rows(payloads).select(*_FOUND, F.lit(0).alias("priority"))
    found = result_cards(payloads, "https://www.dice.com").select(*_FOUND, F.lit(1).alias("priority"))
    rows = first_nonempty_payload(ld.unionByName(found), _PAGE)
    rows = rows.transform(settle, {n: F.lit(None).cast(t) for n, t in _SEARCH_COLUMNS.items()})
    return search_jobs(rows, as_of)


_STATE_MARKERS = [
    "window.__initialData", "window.__INITIAL_DATA__", "window.__PRELOADED_STATE__", "window.__INITIAL_STATE__",
]


def simplyhired(payloads: DataFrame, as_of: Column) -> DataFrame:
    """Result pages: JSON-LD, else page state, else cards. Challenge pages give nothing."""
    pages = payloads.filter(
        ~F.col("body").rlike("(?i)just a moment|enable javascript and cookies to continue|_cf_chl_opt")
    )
    ld = _ld_search_rows(pages).select(*_FOUND, F.lit(0).alias("priority"))
    state = pages.withColumn("state", embedded_object(F.col("body"), _STATE_MARKERS))
    state = state.withColumn(
        "found", nested_objects(F.col("state"), [["title"], ["companyName", "company"], ["url", "link"]])
    ).select(*_PAGE, F.posexplode("found").alias("pos", "json"))
    schema = (
        "id: string, jobKey: string, title: string, companyName: string, company: string, location: string, "
        "formattedLocation: string, url: string, link: string, datePosted: string, postedDate: string, "
        "salaryText: string, salary: string, description: string, snippet: string, isRemote: boolean"
    )
    o = F.col("o")
    place = F.coalesce(o["location"], o["formattedLocation"], F.lit(""))
    link = F.coalesce(o["url"], o["link"])
    in_state = state.withColumn("o", F.from_json("json", f"struct<{schema}>")).select(
        *_PAGE,
        F.coalesce(o["id"], o["jobKey"], link).alias("id"),
        o["title"].alias("title"),
        F.coalesce(o["companyName"], o["company"]).alias("companyName"),
        place.alias("location"),
        F.coalesce(o["datePosted"], o["postedDate"]).alias("postedDate"),
        F.coalesce(o["salaryText"], o["salary"]).alias("salary"),
        link.alias("url"),
        F.coalesce(o["description"], o["snippet"]).alias("description"),
        (F.coalesce(o["isRemote"], F.lit(False)) | has_pattern(F.concat_ws("\n", place, o["description"]), [r"\bremote\b"])).alias("isRemote"),
        (F.shiftleft("fetch_seq", 32) + F.col("pos")).alias("ingest_seq"),
        F.lit(1).alias("priority"),
    )
    found = result_cards(pages, "https://www.simplyhired.com").select(*_FOUND, F.lit(2).alias("priority"))
    rows = first_nonempty_payload(ld.unionByName(in_state).unionByName(found), _PAGE)
    pay = parse_salary(F.col("salary"), "numbers")
    rows = rows.transform(settle, 
        {
            "title": js_trim(_c("title")),
            "company": js_trim(_c("companyName")),
            "location": js_trim(_c("location")),
            "url": absolute_url(_c("url"), "https://www.simplyhired.com"),
            "description": js_trim(_c("description")),
            "salary_min": pay["min"],
            "salary_max": pay["max"],
            "posted_at": parse_posted(F.col("postedDate"), as_of, "chip_days"),
        }
    ).filter("title <> '' AND company <> '' AND url <> ''")
    rows = rows.filter(has_tech_signal(F.col("title")))
    rows = rows.transform(settle, 
        {
            "source_id": F.coalesce("id", "url"),
            "remote": F.coalesce("isRemote", F.lit(False)) | infer_remote(F.col("location")),
            "experience_level": classify_experience(F.col("title"), F.col("description")),
            "description": _or_null(F.col("description")),
        }
    )
    return dedupe_by(finalize(rows, "simplyhired"), ["url"], ["ingest_seq"])


# -- Listing plus detail JSON ---------------------------------------------------------------

# Display names that do not follow from the company slug.
COMPANY_LABELS = {
    "athenahealth": "athenahealth", "bdx": "BD", "biibhr": "Biogen", "bostondynamics": "Boston Dynamics",
    "bristolmyerssquibb": "Bristol Myers Squibb", "caci": "CACI", "cae": "CAE", "clarioclinical": "Clario",
    "dxctechnology": "DXC Technology", "geaerospace": "GE Aerospace", "gehc": "GE HealthCare",
    "globalhr": "RTX", "gsk": "GSK", "healthcare": "Solventum", "kohls": "Kohl's", "lytx": "Lytx",
    "mufgub": "MUFG", "nxp": "NXP", "paypal": "PayPal", "shi": "SHI", "tmobile": "T-Mobile",
    "troweprice": "T. Rowe Price", "vrtx": "Vertex Pharmaceuticals",
}

_WORKDAY = (
    "title: string, externalPath: string, externalUrl: string, jobPostingUrl: string, "
    "locationsText: string, postedOn: string, bulletFields: array<string>, jobPostingId: string"
)


def workday_postings(payloads: DataFrame, as_of: Column) -> DataFrame:
    """All listed postings with the gate they fail; ``request_key`` is
    ``company/version/site``."""
    rows = json_items(payloads, _WORKDAY, ["jobPostings"])
    parts = F.split("request_key", "/")
    slug, version, site = parts[0], parts[1], parts[2]
    host = F.concat(F.lit("https://"), slug, F.lit("."), version, F.lit(".myworkdayjobs.com/"))
    path = _c("externalPath")

    def full(name: str) -> Column:
        link = F.col(name)
        return F.when(link.startswith("http") & ~link.contains("invalid-url"), link)

    short = F.when(
        ~path.startswith("/job/") & path.contains("/en-US/"), F.regexp_replace(path, "^(.*?)/en-US/", "$1/")
    ).otherwise(path)
    usable = path.startswith("/") | path.contains("/en-US/")
    url = F.coalesce(
        full("externalUrl"),
        full("jobPostingUrl"),
        F.when(usable, F.concat(host, site, short)).otherwise(F.concat(host, F.lit("en-US/"), site)),
    )
    title, place = _c("title"), _c("locationsText")
    bullets = F.filter(
        F.transform("bulletFields", js_trim), lambda b: b.rlike("(?i)^[A-Z]{1,6}\\d{4,}\\z")
    )
    stable = F.concat_ws(":", slug, js_trim(F.lower(title)), js_trim(F.lower(place)))
    labels = F.create_map(*[F.lit(x) for pair in COMPANY_LABELS.items() for x in pair])
    shown = F.concat(F.upper(F.substring(slug, 1, 1)), F.substring(slug, 2, 1 << 20))
    return rows.transform(settle, 
        {
            "_slug": slug,
            "company": F.coalesce(F.try_element_at(labels, slug), shown),
            "location": place,
            "url": url,
            "source_id": F.coalesce(
                "jobPostingId",
                F.try_element_at(bullets, F.lit(1)),
                first_match(F.col("externalPath"), "_([A-Za-z0-9-]+)$"),
                stable,
            ),
            "title": title,
            "remote": infer_remote(place),
            "experience_level": classify_experience(title),
            "posted_at": parse_posted(F.col("postedOn"), as_of, "posted"),
            "dedup_hash": posting_hash(slug, title, place),
            "reject_reason": staged_reject_reason(title, slug, place, url),
        }
    )


def workday(payloads: DataFrame, details: DataFrame, as_of: Column) -> DataFrame:
    """Postings that pass all gates, with the text of their detail payloads.

    Details are keyed by ``company/version/site`` and the path: ``key|path``. The hash uses
    the company slug, not its display name.
    """
    rows = workday_postings(payloads, as_of).filter("reject_reason IS NULL")
    rows = dedupe_by(rows, ["request_key", "dedup_hash"], ["ingest_seq"])
    rows = dedupe_by(rows, ["_slug", "dedup_hash"], ["ingest_seq"], keep="last")
    text = F.from_json("body", "struct<jobPostingInfo: struct<jobDescription: string>>")["jobPostingInfo"]["jobDescription"]
    parts = F.split("request_key", "\\|", 2)
    pages = newest_payload(details).select(
        parts[0].alias("request_key"), parts[1].alias("externalPath"), clean_unicode(text).alias("detail_text")
    )
    return finalize(detail_enrich(rows, pages, ["request_key", "externalPath"]), "workday")
