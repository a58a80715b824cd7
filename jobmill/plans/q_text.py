"""Queries over the text and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, salary, text
from ..functions.places import city_country, first_named
from . import oracle as o
from . import workload as w
from .registry import query

DOC_MD5 = "SELECT doc_id, md5({e}) AS text_md5, length({e}) AS n FROM documents"
PAGE_MD5 = "SELECT page_id, md5({e}) AS text_md5, length({e}) AS n FROM pages"


def _digest(df, key, col):
    return df.select(key, F.md5(col).alias("text_md5"), F.length(col).cast("bigint").alias("n"))


@query("t1_squash_ws", DOC_MD5.format(e=o.squash("text")))
def squash_ws(spark, d):
    return _digest(w.table(spark, d, "documents"), "doc_id", text.squash_ws(F.col("text")))


def _block_sql(e: str) -> str:
    for a, b in [("&amp;", "&"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">")]:
        e = f"replace({e}, {o.lit(a)}, {o.lit(b)})"
    for p, b in [(r"(?i)<br\s*/?>", "\n"), ("(?i)</p>", "\n\n"), ("(?i)</li>", "\n"), ("(?i)<li[^>]*>", "- "),
                 ("<[^>]+>", " "), ("\r", ""), ("\n{3,}", "\n\n"), ("[ \t]+", " "), ("[ \t]*\n[ \t]*", "\n")]:
        e = o.sub(e, p, b)
    return o.trim(e)


@query("t2_strip_html", "WITH s AS (SELECT page_id, " + _block_sql("html") + " AS e FROM pages) SELECT page_id, md5(e) AS text_md5, length(e) AS n FROM s")
def strip_html(spark, d):
    return _digest(w.table(spark, d, "pages"), "page_id", text.strip_html(F.col("html")))


_NAMED = "html"
for _a, _b in [("&amp;", "&"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">")]:
    _NAMED = f"replace({_NAMED}, {o.lit(_a)}, {o.lit(_b)})"


@query("t3_decode_entities", PAGE_MD5.format(e=_NAMED))
def decode_entities(spark, d):
    return _digest(w.table(spark, d, "pages"), "page_id", text.decode_entities(F.col("html")))


@query("t4_clean_unicode", DOC_MD5.format(e="text"))
def clean_unicode(spark, d):
    return _digest(w.table(spark, d, "documents"), "doc_id", text.clean_unicode(F.col("text")))


@query(
    "t5_truncate_text",
    "SELECT doc_id, CASE WHEN length(text) <= 160 THEN text ELSE "
    + o.sub("substr(text, 1, 157)", f"{o.WS}+$", "") + " || '...' END AS short FROM documents",
)
def truncate_text(spark, d):
    return w.table(spark, d, "documents").select("doc_id", text.truncate_text(F.col("text"), 160).alias("short"))


@query(
    "t6_urls",
    """WITH found AS (SELECT page_id, nullif(regexp_extract(html, '(?i)href="([^"]+)"', 1), '') AS first_url,
      list_concat(regexp_extract_all(html, '(?i)href="([^"]+)"', 1),
        regexp_extract_all(html, '(?i)\\b(https?://[^\\s<>"'')]+)', 1)) AS urls FROM pages),
    numbered AS (SELECT page_id, u, min(i) AS i FROM (SELECT page_id, unnest(urls) AS u, generate_subscripts(urls, 1) AS i FROM found)
      GROUP BY page_id, u)
    SELECT f.page_id, f.first_url, (SELECT count(*) FROM numbered n WHERE n.page_id = f.page_id) AS n_urls,
      coalesce((SELECT md5(string_agg(u, ' ' ORDER BY i)) FROM numbered n WHERE n.page_id = f.page_id), md5('')) AS urls_md5 FROM found f""",
)
def urls(spark, d):
    all_urls = text.extract_all_urls(F.col("html"))
    return w.table(spark, d, "pages").select(
        "page_id",
        text.extract_first_url(F.col("html")).alias("first_url"),
        F.size(all_urls).cast("bigint").alias("n_urls"),
        F.md5(F.array_join(all_urls, " ")).alias("urls_md5"),
    )


def _cell_sql(e: str) -> str:
    for p, b in [(r"(?i)<img\b[^>]*>", ""), (r"(?i)<a\b[^>]*>(.*?)</a>", r"\1"), (r"\[([^\]]+)\]\((?:[^)]+)\)", r"\1"),
                 ("<[^>]+>", ""), ("[*_`~]", ""), ("(?i)&nbsp;", " "), ("(?i)&amp;", "&")]:
        e = o.sub(e, p, b)
    return o.trim(o.sub(o.sub(o.squash(e), "^↳\\s*", ""), "^[^A-Za-z0-9]+", ""))


@query("t7_extract_cell_text", "WITH s AS (SELECT page_id, " + _cell_sql("html") + " AS e FROM pages) SELECT page_id, md5(e) AS text_md5, length(e) AS n FROM s")
def cell_text(spark, d):
    return _digest(w.table(spark, d, "pages"), "page_id", text.extract_cell_text(F.col("html")))


@query("t8_canonical_url", f"SELECT page_id, {o.canonical_url('url')} AS plain, {o.dedupe_url('url')} AS strict FROM pages")
def canonical_url(spark, d):
    url = F.col("url")
    return w.table(spark, d, "pages").select(
        "page_id", text.canonical_url(url).alias("plain"), text.dedupe_url(url).alias("strict")
    )


@query("t9_dedupe_text", "WITH s AS (SELECT doc_id, " + o.dedupe_text("text") + " AS e FROM documents) SELECT doc_id, md5(e) AS text_md5, length(e) AS n FROM s")
def dedupe_text(spark, d):
    return _digest(w.table(spark, d, "documents"), "doc_id", text.dedupe_text(F.col("text")))


@query(
    "t10_company_root",
    f"WITH n AS (SELECT c_name || {o.pick(w.COMPANY_SUFFIXES, 'c_custkey % 5')} AS name FROM customer UNION ALL "
    f"SELECT s_name || ' Company Ltd' FROM supplier) SELECT name, {o.company_root('name')} AS root FROM n",
)
def company_root(spark, d):
    customers = w.table(spark, d, "customer").select(
        F.concat("c_name", w.pick(w.COMPANY_SUFFIXES, F.col("c_custkey") % 5)).alias("name")
    )
    suppliers = w.table(spark, d, "supplier").select(F.concat("s_name", F.lit(" Company Ltd")).alias("name"))
    return customers.unionByName(suppliers).withColumn("root", text.company_root(F.col("name")))


_SLUG = o.sub(o.sub("lower(p_name || ' ' || p_brand)", "[^a-z0-9]+", "-"), "^-+|-+$", "")


@query(
    "t11_slugs",
    f"""WITH s AS (SELECT p_partkey, {_SLUG} AS slug FROM part)
    SELECT p_partkey, slug, array_to_string(list_transform(string_split(slug, '-'),
      lambda x: CASE WHEN x IN ('red', 'io') THEN upper(x) ELSE upper(x[1]) || x[2:] END), ' ') AS shown FROM s""",
)
def slugs(spark, d):
    slug = text.slugify(F.concat_ws(" ", "p_name", "p_brand"))
    return w.table(spark, d, "part").select(
        "p_partkey",
        slug.alias("slug"),
        text.humanize_slug(slug, acronyms=("red", "io"), names=text.SLUG_NAMES).alias("shown"),
    )


#: salary texts per order, in both languages
_PAY_FORMS = 6


def _pay_text():
    key, k = F.col("o_orderkey"), F.floor(F.col("o_totalprice") / 1000).cast("bigint")
    s = lambda c: c.cast("string")
    return (
        F.when(key % _PAY_FORMS == 0, F.concat(F.lit("$"), s(k), F.lit("K - $"), s(k + 20), F.lit("K")))
        .when(key % _PAY_FORMS == 1, F.concat(F.lit("$"), s(k), F.lit("/hr")))
        .when(key % _PAY_FORMS == 2, F.concat(F.lit("$"), s(k), F.lit(",000 - $"), s(k + 9), F.lit(",500")))
        .when(key % _PAY_FORMS == 3, F.concat(F.lit("USD "), s(k), F.lit(" per hour")))
        .when(key % _PAY_FORMS == 4, F.concat(s(k), F.lit("k")))
        .otherwise(F.lit("competitive"))
    )


_PAY_SQL = """pay AS (SELECT o_orderkey, CAST(floor(o_totalprice / 1000) AS BIGINT) AS k, o_orderkey % 6 AS f FROM orders)"""


@query(
    "t12_parse_salary",
    f"""WITH {_PAY_SQL}
    SELECT o_orderkey,
      CAST(CASE f WHEN 0 THEN k * 1000 WHEN 1 THEN k * 2080 WHEN 2 THEN k * 1000 WHEN 4 THEN k * 1000 END AS INTEGER) AS summary_min,
      CAST(CASE f WHEN 0 THEN (k + 20) * 1000 WHEN 1 THEN k * 2080 WHEN 2 THEN (k + 9) * 1000 + 500 WHEN 4 THEN k * 1000 END AS INTEGER) AS summary_max,
      CAST(CASE WHEN f IN (0, 4) AND k >= 1 THEN k * 1000 WHEN f = 0 THEN (k + 20) * 1000
        WHEN f = 2 THEN CASE WHEN k >= 1 THEN k * 1000 ELSE 9500 END WHEN f IN (1, 3) AND k >= 1000 THEN k END AS INTEGER) AS numbers_min,
      CAST(CASE WHEN f = 0 AND k >= 1 THEN (k + 20) * 1000 WHEN f = 2 AND k >= 1 THEN (k + 9) * 1000 + 500 END AS INTEGER) AS numbers_max,
      CAST(CASE f WHEN 0 THEN k * 1000 WHEN 1 THEN k WHEN 2 THEN k * 1000 WHEN 3 THEN k WHEN 4 THEN k * 1000 END AS INTEGER) AS tokens_min,
      CAST(CASE f WHEN 0 THEN (k + 20) * 1000 WHEN 2 THEN (k + 9) * 1000 + 500 END AS INTEGER) AS tokens_max
    FROM pay""",
)
def parse_salary(spark, d):
    rows = w.table(spark, d, "orders").select("o_orderkey", _pay_text().alias("pay"))
    for dialect in ("summary", "numbers", "tokens"):
        rows = rows.withColumn(dialect, salary.parse_salary(F.col("pay"), dialect))
    return rows.select(
        "o_orderkey",
        *[F.col(f"{s}.{m}").alias(f"{s}_{m}") for s in ("summary", "numbers", "tokens") for m in ("min", "max")],
    )


@query(
    "t13_parse_posted",
    f"""WITH s AS (SELECT o_orderkey, o_orderkey % 8 AS f, 1 + o_orderkey % 29 AS n, o_orderdate AS dt, TIMESTAMP '{w.AS_OF}' AS now FROM orders)
    SELECT o_orderkey, strftime(CASE f WHEN 0 THEN now WHEN 1 THEN now - INTERVAL 1 DAY WHEN 2 THEN now - n * INTERVAL 1 HOUR
      WHEN 3 THEN now - n * INTERVAL 1 DAY WHEN 4 THEN now - n * INTERVAL 7 DAY
      WHEN 5 THEN CASE WHEN make_date(2001, month(dt)::INT, least(day(dt), 28)::INT) > now + INTERVAL 1 DAY
        THEN make_date(2000, month(dt)::INT, least(day(dt), 28)::INT) ELSE make_date(2001, month(dt)::INT, least(day(dt), 28)::INT) END
      WHEN 6 THEN dt END, '%Y-%m-%d %H:%M:%S') AS curated,
      strftime(CASE WHEN f = 0 THEN now WHEN f = 7 THEN now - n * INTERVAL 1 DAY WHEN f = 3 THEN now - n * INTERVAL 1 DAY
        WHEN f = 6 THEN dt END, '%Y-%m-%d %H:%M:%S') AS posted FROM s""",
)
def parse_posted(spark, d):
    key = F.col("o_orderkey")
    form, n = key % 8, (1 + key % 29).cast("string")
    date = F.col("o_orderdate")
    day = F.least(F.dayofmonth(date), F.lit(28)).cast("string")
    raw = (
        F.when(form == 0, F.lit(" Today "))
        .when(form == 1, F.lit("yesterday"))
        .when(form == 2, F.concat(n, F.lit("h")))
        .when(form == 3, F.concat(n, F.lit(" days")))
        .when(form == 4, F.concat(n, F.lit("wk")))
        .when(form == 5, F.concat(F.date_format(date, "MMM"), F.lit(" "), day))
        .when(form == 6, F.date_format(date, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .otherwise(F.concat(F.lit("Posted "), n, F.lit("+ Days Ago")))
    )
    shown = lambda dialect: F.date_format(
        dates.parse_posted(F.col("raw"), w.as_of(), dialect), "yyyy-MM-dd HH:mm:ss"
    )
    return (
        w.table(spark, d, "orders")
        .select("o_orderkey", raw.alias("raw"))
        .select("o_orderkey", shown("curated").alias("curated"), shown("posted").alias("posted"))
    )


@query(
    "t14_build_location",
    """SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'HQ' WHEN lower(c_mktsegment) = 'machinery' THEN c_mktsegment
      ELSE c_mktsegment || ', ' || n_name END AS place FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def build_location(spark, d):
    joined = w.table(spark, d, "customer").join(
        w.table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    country = F.when(F.col("c_mktsegment") == "MACHINERY", "Machinery").otherwise(F.col("n_name"))
    office = F.when(F.col("c_custkey") % 4 == 0, " HQ ")
    return joined.select(
        "c_custkey", first_named(office, city_country(F.col("c_mktsegment"), country)).alias("place")
    )


@query(
    "t15_has_non_latin",
    "SELECT doc_id, regexp_matches(text, '[\\x{3000}-\\x{9fff}\\x{ac00}-\\x{d7af}\\x{0600}-\\x{06ff}\\x{0400}-\\x{04ff}]') AS non_latin FROM documents",
)
def has_non_latin(spark, d):
    return w.table(spark, d, "documents").select("doc_id", text.has_non_latin(F.col("text")).alias("non_latin"))


@query(
    "t16_display_fields",
    f"""WITH {o.RAW} SELECT source_id, coalesce(nullif({o.squash('location')}, ''), 'Location unavailable') AS place,
    coalesce(nullif({o.squash('title')}, ''), 'Untitled role') AS title,
    coalesce(nullif({o.squash('company')}, ''), 'Unknown company') AS company,
    coalesce('Posted ' || strftime(posted_at, '%b %-d, %Y'), 'Posted date unavailable') AS posted FROM raw""",
)
def display_fields(spark, d):
    return w.raw_postings(spark, d).select(
        "source_id",
        text.or_label(F.col("location"), "Location unavailable").alias("place"),
        text.or_label(F.col("title"), "Untitled role").alias("title"),
        text.or_label(F.col("company"), "Unknown company").alias("company"),
        text.posted_label(F.col("posted_at")).alias("posted"),
    )


@query(
    "t17_first_words",
    f"""WITH s AS (SELECT doc_id, {o.sub(o.squash(o.sub('text', "^['\"]+|['\"]+$", '')), '^[-*]\\s*', '')} AS t FROM documents),
    k AS (SELECT doc_id, array_to_string(list_filter(string_split(t, ' '), lambda x: x <> '')[1:20], ' ') AS line FROM s)
    SELECT doc_id, CASE WHEN line <> '' THEN 'Why this matches you: ' || line END AS line FROM k""",
)
def first_words(spark, d):
    return w.table(spark, d, "documents").select("doc_id", text.first_words(F.col("text")).alias("line"))
