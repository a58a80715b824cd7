"""Odd payloads: broken bodies, fallbacks, drop rules."""

import json

from pyspark.sql import functions as F

from jobmill.plans import q_sources
from jobmill.schema import RAW_PAYLOAD
from jobmill.sources import boards, lists, pages, readers, thread

AS_OF = F.lit("2026-04-23 00:00:00").cast("timestamp")


def landed(spark, *bodies, key="acme"):
    rows = [("s", "r", i, key, 200, "", b if isinstance(b, str) else json.dumps(b)) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, RAW_PAYLOAD)


def test_broken_bodies_give_no_rows(spark):
    good = {"jobs": [{"id": 7, "title": "Data Engineer", "location": {"name": "Austin, TX"}, "content": "<p>x</p>", "absolute_url": "u"}]}
    rows = boards.greenhouse(landed(spark, "{broken", "", "[1, 2]", {"jobs": None}, good, {"jobs": ["x"]})).collect()
    assert [(r["source_id"], r["company"], r["description"].strip()) for r in rows] == [("7", "acme", "x")]


def test_envelopes_fall_back_in_order(spark):
    bodies = [{"data": {"jobs": [{"id": "1"}]}}, {"results": [{"id": "2"}]}, [{"id": "3"}]]
    rows = readers.json_items(landed(spark, *bodies), "id: string", ["jobs", "data.jobs", "results", ""])
    assert sorted(r["id"] for r in rows.collect()) == ["1", "2", "3"]


def test_an_empty_company_cell_resets_the_carry(spark):
    table = "\n".join(
        [
            "| Company | Job Title | Location | Work Model | Date |", "| --- | --- | --- | --- | --- |",
            "| **Acme** | [Data Engineer](https://x/1) | Austin, TX | Remote | today |",
            "| ↳ | [Data Analyst](https://x/2) | Austin, TX | On Site | 3d |",
            "| | [Lost](https://x/3) | Austin, TX | | |", "| ↳ | [Lost too](https://x/4) | Austin, TX | | |",
            "| Beta | [Data Scientist](https://x/5/) | Toronto | | |", "| Beta | [Copy](https://x/1/) | Austin | | |",
            "| too | few |", "no row",
        ]
    )
    rows = lists.repeated_company_table(landed(spark, table), "jobright_swe", AS_OF).collect()
    assert sorted((r["company"], r["title"], r["remote"]) for r in rows) == [
        ("Acme", "Data Analyst", False), ("Acme", "Data Engineer", True),
    ]


def test_the_table_counts_when_the_file_has_no_rows(spark):
    table = "| Company | Role | Location | Posted | Apply |\n|---|---|---|---|---|\n| Acme | Data Engineer | Austin | 2 days ago | [a](https://x/1) |\n| Shut 🔒 | Data Engineer | Austin | today | [a](https://x/2) |"
    listed = {"jobs": [{"company": "Json Inc", "title": "Analyst", "url": "https://x/3", "is_closed": False}]}
    closed = {"jobs": [{**listed["jobs"][0], "is_closed": True}]}
    by_file = lists.lock_table(landed(spark, table), AS_OF, landed(spark, listed)).collect()
    by_table = lists.lock_table(landed(spark, table), AS_OF, landed(spark, closed)).collect()
    assert [r["company"] for r in by_file] == ["Json Inc"]
    assert [(r["company"], str(r["posted_at"])[:10]) for r in by_table] == [("Acme", "2026-04-21")]


def test_demo_boards_are_dropped(spark):
    def board(titles):
        cards = "".join(
            f'<li id="bhrPositionID_{i}"><a href="/jobs/{i}">{t}</a><span class="BambooHR-ATS-Location">Austin</span></li>'
            for i, t in enumerate(titles)
        )
        return f'<div class="BambooHR-ATS-board">{cards}</div>'

    demo = landed(spark, board([t.title() for t in pages.DEMO_TITLES]), key="demo-co")
    real = landed(spark, board(["Software Engineer", "General Application"]), key="real-co")
    none = demo.limit(0)
    rows = pages.bamboohr(demo.unionByName(real), none).collect()
    assert [(r["company"], r["title"], r["url"]) for r in rows] == [
        ("Real Co", "Software Engineer", "https://real-co.bamboohr.com/jobs/0")
    ]


def test_json_ld_skips_broken_scripts_and_reads_type_lists(spark):
    posting = {"@type": ["Thing", "jobPosting"], "title": "T", "jobLocation": [{"address": {}}, {"address": {"addressLocality": "Rome", "addressCountry": "IT"}}]}
    html = '<script type="application/ld+json">{oops</script><script type=\'application/ld+json\'>' + json.dumps([{"@type": "WebSite"}, posting]) + "</script>"
    ld = readers.json_ld_posting(F.col("body"))
    rows = landed(spark, html, "<p>none</p>").orderBy("fetch_seq")
    got = rows.select(ld["title"].alias("t"), readers.json_ld_place(ld, F.lit("listed")).alias("p")).collect()
    assert [(r["t"], r["p"]) for r in got] == [("T", "Rome, IT"), (None, "listed")]


def test_challenge_pages_and_deep_state(spark):
    state = '<script>window.__INITIAL_STATE__ = {"a": {"x": "}{", "b": [{"title": "Data Engineer", "company": "Acme", "url": "/j/1"}]}};</script>'
    rows = pages.simplyhired(landed(spark, state, "Just a moment... " + state), AS_OF).collect()
    assert [(r["title"], r["url"]) for r in rows] == [("Data Engineer", "https://www.simplyhired.com/j/1")]


def test_whole_pages_are_not_collected_into_arrow_batches(spark):
    """Objects at any depth are found a few pages at a time, however large the pages are."""
    pad, nested = "x" * 50_000, {"@type": ["Thing", "Job"], "t": "a", "in": [{"t": "b"}, {"@type": "Job", "t": "c \u00e9\U0001f600"}]}
    texts = [json.dumps({"pad": pad, "list": [[{"u": nested}], 7]}), "{broken", "", None, "[]"] * 30
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    found = df.select("i", readers.nested_objects(F.col("text"), [["no", "t"]], "Job").alias("o"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan
    rows = {r["i"]: [json.loads(o) for o in r["o"]] for r in found.collect()}
    for i in range(len(texts)):
        assert rows[i] == ([nested, nested["in"][1]] if i % 5 == 0 else [])


def test_workday_links_and_gates(spark):
    jobs = [
        {"title": "Data Engineer", "externalPath": "/job/a_R1", "locationsText": "Austin, TX"},
        {"title": "Data Engineer", "externalPath": "/en-US/S/job/b_R2", "locationsText": "Boston, MA"},
        {"title": "Data Engineer", "externalPath": "", "locationsText": "Reno, NV"},
        {"title": "Registered Nurse", "externalPath": "/job/c_R3", "locationsText": "Austin, TX"},
        {"title": "Senior Data Engineer", "externalPath": "/job/d_R4", "locationsText": "Austin, TX"},
        {"title": "Data Engineer", "externalPath": "/job/e", "locationsText": "Berlin", "bulletFields": [" JR12345 "]},
    ]
    rows = pages.workday_postings(landed(spark, {"jobPostings": jobs}, key="kohls/wd1/Site"), AS_OF).orderBy("ingest_seq").collect()
    host = "https://kohls.wd1.myworkdayjobs.com/"
    assert [r["url"] for r in rows][:3] == [host + "Site/job/a_R1", host + "Site/S/job/b_R2", host + "en-US/Site"]
    assert [r["reject_reason"] for r in rows] == [None, None, "bad_url", "non_tech", "level", "non_us"]
    assert rows[0]["company"] == "Kohl's" and rows[0]["source_id"] == "R1" and rows[5]["source_id"] == "JR12345"


def test_comments(spark):
    items = [
        {"id": 1, "time": 1700000000, "text": "Acme (acme.com) | Senior Data Engineer | Data Analyst | REMOTE (US) | Full-time<p>Join us. <a href=\"https:&#x2F;&#x2F;acme.com&#x2F;j\">x</a>"},
        {"id": 2, "text": "Dead | Data Engineer", "dead": True}, {"id": 3, "text": "No title here"},
        {"id": 4, "text": "Beta | Berlin<p>We are hiring for: Backend Engineer: great team"},
        {"id": 5, "text": "Gamma | Austin, TX<p>- Backend Engineer: great team"},
    ]
    rows = {r["source_id"]: r for r in thread.comment_thread(landed(spark, items)).collect()}
    assert set(rows) == {"1", "5"}
    one, five = rows["1"], rows["5"]
    assert (one["company"], one["title"], one["location"], one["remote"]) == ("Acme", "Data Analyst", "REMOTE (US)", True)
    assert one["url"] == "https://acme.com/j"
    assert (five["title"], five["location"], five["url"]) == ("Backend Engineer", "Austin, TX", thread.ITEM_URL + "5")


def test_the_newest_detail_counts_once(spark):
    """A detail page that landed again neither multiplies a posting nor loses its text."""
    listed = {"results": [{"id": 5, "name": "Software Engineer", "company": {"name": "Acme"}, "locations": [{"name": "Austin, TX"}],
                           "refs": {"landing_page": "https://x/5"}, "publication_date": "2026-04-01T00:00:00Z"}]}
    rows = [("s", run, seq, "5", 200, "", json.dumps({"contents": text})) for run, seq, text in
            (("r2", 1, "new"), ("r1", 7, "old"), ("r2", 0, "early"))]
    found = boards.themuse(landed(spark, listed), spark.createDataFrame(rows, RAW_PAYLOAD)).collect()
    assert [r["description"] for r in found] == ["new"]
    post = {"content": [{"id": "9", "name": "Data Engineer", "company": {"name": "Acme"}, "location": {"fullLocation": "Austin, TX", "remote": False}}]}
    ad = lambda t: json.dumps({"jobAd": {"sections": {"jobDescription": {"text": t}}}})
    rows = [("s", run, seq, "9", 200, "", ad(text)) for run, seq, text in (("r1", 7, "old"), ("r2", 1, "new"))]
    found = boards.smartrecruiters(landed(spark, post), spark.createDataFrame(rows, RAW_PAYLOAD)).collect()
    assert [r["description"] for r in found] == ["new"]


def test_a_comment_is_cleaned_once(spark):
    """Filters on what comes out of the text must not compute it again."""
    plan = thread.comment_thread(landed(spark, [{"id": 1, "text": "x"}]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("(?i)</li>") == 1


def test_payloads_are_made_in_one_shuffle_that_keeps_all_cores_busy(spark):
    rows = spark.range(1000).select(F.col("id").alias("ingest_seq"))
    made = q_sources.payloads(rows, F.col("ingest_seq").cast("string"), q_sources.lines())
    both = made.unionByName(made).transform(lambda df: df.filter("length(body) > 0"))
    assert made._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert both.rdd.getNumPartitions() >= 2 * spark.sparkContext.defaultParallelism
    assert made.count() == 20 and made.selectExpr("sum(size(split(body, '\n')))").first()[0] == 1000


def test_only_scripts_that_name_a_posting_are_parsed(spark):
    script = '<script type="application/ld+json">%s</SCRIPT>'
    bodies = [
        script % '{"@type":"WebSite"}' + script % '{broken JobPosting' + script % '{"@type":"JobPosting","title":"a <b>x</b>"}',
        script % '{"@type":"Job\\u0050osting","title":"escaped"}',
        script % '{"@type":"jobposting","title":"open"}' + '<script type="application/ld+json">{"@type":"JobPosting"}',
        '<script type="application/ld+json">{"@type":"JobPosting","title":"never closed"}',
    ]
    df = spark.createDataFrame(list(enumerate(bodies)), "i int, body string")
    ld = readers.json_ld_posting(F.col("body"))
    assert [r[0] for r in df.orderBy("i").select(ld["title"]).collect()] == ["a <b>x</b>", "escaped", "open", None]
    plan = df.select(ld.alias("ld"))._jdf.queryExecution().analyzed().toString()
    assert readers._LD_NAMED in plan


def test_run_ids_with_one_number_at_the_end_need_no_pattern(spark):
    ids = ["run9", "run10", "run010", "2024-01-02", "a1b", "run", "", "7", "x" + "9" * 41, None]
    df = spark.createDataFrame(list(enumerate(ids)), "i int, r string")
    padded = F.regexp_replace(F.regexp_replace("r", r"(\d+)", "0" * 40 + "$1"), r"0*(\d{40})(?!\d)", "$1")
    rows = df.orderBy("i").select(readers.run_order(F.col("r")), padded).collect()
    assert [r[0] for r in rows] == [r[1] for r in rows]
    assert "CASE WHEN" in df.select(readers.run_order(F.col("r")))._jdf.queryExecution().analyzed().toString()
