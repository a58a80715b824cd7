"""Posting tables derived from the star-schema test tables.

The tables hold no postings, so orders stand for postings, customers for companies, and
documents for descriptions. All views cover whole tables. A third of the postings comes
from one source, and postings repeat across sources.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.classify import classify_experience, infer_roles
from ..functions.keys import posting_hash
from ..functions.location import infer_remote, is_usa
from ..operators.dedup import dedupe_by
from ..settle import settle

TITLES = [
    "Software Engineer", "Software Engineer 2026 New Grad", "Software Engineer, Internal Tools",
    "External Audit Associate", "Software Engineer Infrastructure", "Test Engineer Vehicle",
    "Senior Engineer", "Intern", "License Inspector", "Data Scientist", "Data Analyst",
    "Machine Learning Engineer", "AI Researcher", "Product Manager", "Associate Product Manager",
    "Security Analyst", "DevOps Engineer", "Consultant", "Associate Consultant",
    "Quantitative Analyst", "Mechanical Engineer", "Hardware Engineer", "Embedded Software Engineer",
    "Process Engineer", "Field Engineer", "Financial Analyst", "Quality Assurance Tester",
    "Registered Nurse", "Staff Software Engineer", "Principal Scientist", "Vice President, Sales",
    "Backend Developer II", "Frontend Developer", "Full Stack Developer", "iOS Developer",
    "Site Reliability Engineer", "Cloud Support Associate", "Graduate Program Analyst",
    "SWE I", "L4 Engineer", "Research Scientist", "Business Analyst", "Program Manager",
    "UX Researcher", "Tax Associate", "Warehouse Associate", "Civil Engineer",
    "Firmware Engineer", "Solutions Architect", "Lead Developer", "Prompt Engineer",
    "Wizard of Networks", "Account Executive",
]
PREFIXES = ["", "Junior ", "", "Senior ", "New Grad ", "", "Associate "]
SUFFIXES = ["", " (Remote)", " - Summer 2026"]
LOCATIONS = [
    "Berlin, DE", "Bangalore, IN", "Grenoble, France", "La Paz", "Perth, WA", "Milwaukee, WI",
    "Indianapolis, IN", "Albuquerque, New Mexico", "Foo - ON", "", None, "Remote", "New York, NY",
    "San Francisco, CA", "Toronto, ON", "London, UK", "US, Santa Clara", "CA-SAN JOSE-12",
    "3 Locations", "Austin, Texas", "Anywhere", "Hybrid", "SF", "NYC or Remote", "Paris",
    "United States", "U.S.", "Quantico", "Warsaw", "Acme - Toronto, ON", "Acme - Boston, MA",
    "Tokyo, Japan", "Reno, Nevada", "West Virginia", "Huntington Beach", "Work from home",
    "Sydney NSW", "Mexico City", "Denver", "Portland, OR", "Dublin, OH",
]
SOURCES = [
    "pittcsc", "jobright_swe", "zapplyjobs", "adzuna", "remoteok", "arbeitnow", "jobspy",
    "greenhouse", "lever", "workday", "ashby",
]
BIG_SOURCE = "simplify_internships"
RUN_ORDER = ["pittcsc", BIG_SOURCE] + SOURCES[1:]
COMPANY_SUFFIXES = [" Inc.", " LLC", " Healthcare", "", " & Co"]
BLURBS = [
    "", "Bachelor degree or equivalent.", "We want 5+ years of experience.",
    "Recent graduates encouraged. Great team &amp; product.", "0-2 years in a team.",
    "A minimum 3 years in the field.", "Join our early career cohort.",
    "You will own services end to end.", "Open to anyone who ships.",
]
ROLE_SPELLINGS = ["SWE", " ds ", "ml", "Wizard", "Finance", "pm", "SWE "]
AS_OF = "2001-08-02 00:00:00"
SNAPSHOT_END = "2000-01-01"
BATCH_START = "1999-01-01"


#: tables that feed rule packs over text, with the key that spreads them
CPU_HEAVY = {"orders": "o_orderkey", "documents": "doc_id", "pages": "page_id"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. Rules over text cost far more than reading it, so a table that comes
    in fewer splits than there are cores is spread; large tables are read as they are."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    if name in CPU_HEAVY and df.rdd.getNumPartitions() < cores:
        return df.repartition(cores, CPU_HEAVY[name])
    return df


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")


def pick(values: list, index: Column) -> Column:
    """The value at a 0-based position."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def title_of(order_key: Column, company_key: Column) -> Column:
    base = pick(TITLES, (company_key * 7 + order_key % 6) % len(TITLES))
    prefix = pick(PREFIXES, company_key % len(PREFIXES))
    return F.concat(prefix, base, pick(SUFFIXES, order_key % len(SUFFIXES)))


def raw_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One posting per order, before classification."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    source = F.when(key % 3 == 0, BIG_SOURCE).otherwise(pick(SOURCES, key % len(SOURCES)))
    slash = F.when(key % 5 == 0, "/").otherwise("")
    url = F.concat(F.lit("https://jobs.example.com/"), cust, F.lit("/"), key % 4, slash)
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(
        source.alias("source"),
        key.cast("string").alias("source_id"),
        title_of(key, cust).alias("title"),
        F.concat("c_name", pick(COMPANY_SUFFIXES, cust % len(COMPANY_SUFFIXES))).alias("company"),
        pick(LOCATIONS, cust % len(LOCATIONS)).alias("location"),
        F.when(key % 97 == 0, "").otherwise(url).alias("url"),
        pick(BLURBS, (key + cust) % len(BLURBS)).alias("description"),
        F.when(key % 13 != 0, F.col("o_orderdate").cast("timestamp")).alias("posted_at"),
        F.col("o_orderdate").cast("timestamp").alias("ordered_at"),
        key.alias("ingest_seq"),
        "o_custkey",
        F.col("c_nationkey").alias("nation"),
    ).withColumn(
        "source_rank",
        F.array_position(F.array(*map(F.lit, RUN_ORDER)), F.col("source")).cast("int"),
    )


def classified_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings with level, roles, flags and hash; senior ones keep a null level."""
    raw = raw_postings(spark, sf_dir)
    title, place = F.col("title"), F.col("location")
    return raw.transform(
        settle,
        {
            "remote": infer_remote(place),
            "experience_level": classify_experience(title, F.col("description")),
            "roles": infer_roles(title),
            "dedup_hash": posting_hash(F.col("company"), title, place),
        }
    ).withColumn("is_usa", is_usa(place, F.col("remote")))


def hashed_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw postings with their hash; enough for merge and dedup."""
    return raw_postings(spark, sf_dir).withColumn(
        "dedup_hash", posting_hash(F.col("company"), F.col("title"), F.col("location"))
    )


MERGE_COLUMNS = [
    "source", "source_id", "title", "company", "location", "url", "description", "posted_at",
    "dedup_hash",
]


def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored jobs before a run: one row per hash among the older postings."""
    old = hashed_postings(spark, sf_dir).filter(F.col("ordered_at") < F.lit(SNAPSHOT_END))
    latest = dedupe_by(old, ["dedup_hash"], ["ingest_seq"], keep="last")
    return latest.select(
        *MERGE_COLUMNS,
        F.md5("dedup_hash").alias("id"),
        F.col("ordered_at").alias("scraped_at"),
        (F.col("ingest_seq") % 10 != 0).alias("is_active"),
    )


def batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The postings of a run; a year of them is already stored."""
    new = hashed_postings(spark, sf_dir).filter(F.col("ordered_at") >= F.lit(BATCH_START))
    return new.select(*MERGE_COLUMNS, "ingest_seq", "source_rank")


def run_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome per source of the run; the rank stands in for a log."""
    rows = hashed_postings(spark, sf_dir).select("source").distinct()
    return rows.withColumn("success", F.col("source") != "lever")


def text_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One posting per document, with the whole text as its description."""
    doc = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        doc.cast("string").alias("id"),
        F.col("source"),
        title_of(doc, doc).alias("title"),
        F.concat(F.lit("Firm "), doc % 211, pick(COMPANY_SUFFIXES, doc % 5)).alias("company"),
        pick(LOCATIONS, doc % len(LOCATIONS)).alias("location"),
        F.concat(F.lit("https://docs.example.com/"), doc % 400).alias("url"),
        F.col("text").alias("description"),
        "lang",
        doc.alias("doc_id"),
    )


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as users; every second one has a resume vector."""
    key = F.col("s_suppkey")
    email = F.when(key % 11 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" u"), key, F.lit("@example.com ")))
    wishes = pick(["swe", "ds", "analyst", "SWE ", "finance"], key % 5)
    return table(spark, sf_dir, "supplier").select(
        key.cast("string").alias("id"),
        email.alias("email"),
        F.when(key % 3 == 0, "pro").otherwise("free").alias("tier"),
        (key % 7 != 0).alias("job_alerts_enabled"),
        F.when(key % 4 != 0, F.array(wishes, F.lit("consulting"))).alias("target_roles"),
        F.when(key % 3 != 0, F.array(F.lit("Entry Level"), F.lit("New Grad"), F.lit("Boss"))).alias("target_levels"),
        F.lit("").alias("resume_text"),
        F.when(key % 2 == 0, F.array(F.lit(1.0), F.lit(0.0)).cast("array<float>")).alias("resume_embedding"),
    )


def digest_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings as jobs of the digest; senior ones are not stored."""
    rows = classified_postings(spark, sf_dir).filter("experience_level IS NOT NULL")
    return rows.withColumn("id", F.col("source_id")).withColumn("is_active", F.col("ingest_seq") % 10 != 0)


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as match scores: supplier is the user, order the job."""
    best = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_orderkey").agg(
        F.max("l_quantity").alias("q")
    )
    value = F.lit(0.5) + F.col("q") / 100
    grade = F.when(value > 0.85, "A").when(value > 0.75, "B").when(value > 0.65, "C").when(value > 0.55, "D")
    return best.select(
        F.col("l_suppkey").cast("string").alias("user_id"),
        F.col("l_orderkey").cast("string").alias("job_id"),
        value.alias("similarity"),
        grade.otherwise("F").alias("grade"),
    )


def applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returned line items as applications."""
    rows = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R")
    states = ["applied", "phone_screen", "oa", "interview", "offer", "rejected", "withdrawn"]
    return rows.groupBy("l_suppkey", "l_orderkey").agg(
        F.max("l_shipdate").alias("d"), F.max("l_linenumber").alias("n")
    ).select(
        F.col("l_suppkey").cast("string").alias("user_id"),
        F.col("l_orderkey").cast("string").alias("job_id"),
        pick(states, F.col("n") % 7).alias("status"),
        F.col("d").cast("timestamp").alias("applied_at"),
        (F.col("n") % 3).cast("int").alias("interview_count"),
    )


def sent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lightly taxed accepted line items as postings that were already sent."""
    rows = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'A' AND l_tax < 0.03")
    return rows.select(
        F.col("l_suppkey").cast("string").alias("user_id"),
        F.col("l_orderkey").cast("string").alias("job_id"),
    ).distinct()
