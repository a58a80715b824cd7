import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from jobmill import run
from jobmill.schema import JOB, POSTING, RAW_PAYLOAD
from jobmill.sources.registry import SOURCES, Landed, chosen

NOW = F.lit("2026-01-10 00:00:00").cast("timestamp")


def listing(*entries):
    return json.dumps([
        {"id": str(i), "title": title, "company_name": company, "locations": ["Austin, TX"], "url": url,
         "date_posted": 1_767_000_000, "is_visible": True, "active": True}
        for i, title, company, url in entries
    ])


def payload(source, body, status=200, seq=0, key="k", run_id="r1"):
    return (source, run_id, seq, key, status, "application/json", body)


def landed(spark, tmp_path, rows):
    run.land(spark.createDataFrame(rows, RAW_PAYLOAD), str(tmp_path / "landing"))
    return run.landed_run(spark, str(tmp_path / "landing"), "r1")


def job(spark, rows):
    """Stored jobs (source, hash, active)."""
    base = spark.createDataFrame([], JOB)
    given = spark.createDataFrame(rows, "source string, dedup_hash string, is_active boolean")
    old = F.lit(datetime(2025, 1, 1))
    given = given.withColumns({"id": F.md5("dedup_hash"), "scraped_at": old, "url": F.lit("https://old")})
    return base.unionByName(given, allowMissingColumns=True)


ROWS = [
    payload("pittcsc", listing((1, "Software Engineer", "A", "https://x/1"), (2, "Data Analyst", "A", "https://x/2"))),
    payload("pittcsc", "gone", status=500, seq=1),
    payload("vanshb03_newgrad", listing((1, "Software Engineer", "B", "https://x/2/"), (2, "Software Engineer", "C", "https://x/3"))),
    payload("remoteok", "down", status=503),
    payload("arbeitnow", json.dumps({"data": []})),
    payload("pittcsc", listing((9, "Software Engineer", "Z", "https://x/9")), run_id="r0"),
]
NAMES = ["pittcsc", "vanshb03_newgrad", "remoteok", "arbeitnow", "lever"]


@pytest.fixture(scope="module")
def result(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("run")
    old = [(s, f"{s}-{i}", True) for s in ("pittcsc", "remoteok", "arbeitnow") for i in range(2)]
    return run.run_all_sources(
        landed(spark, folder, ROWS), job(spark, old), str(folder / "out"), NOW, names=NAMES
    ), folder


def test_report(result):
    report = {r["source"]: r for r in result[0].report.collect()}
    assert list(report) == [s.name for s in SOURCES if s.name in NAMES]
    shown = {n: (r["success"], r["payloads"], r["failed_payloads"], r["fetched"], r["kept"]) for n, r in report.items()}
    assert shown == {
        "pittcsc": (True, 2, 1, 2, 2),  # of this run only, without the failed payload
        "vanshb03_newgrad": (True, 1, 0, 2, 1),  # the first list keeps the shared URL
        "remoteok": (False, 1, 1, 0, 0),
        "arbeitnow": (True, 1, 0, 0, 0),
        "lever": (False, 0, 0, 0, 0),
    }
    assert {n: r["decision"] for n, r in report.items()} == {
        "pittcsc": "retire", "vanshb03_newgrad": "nothing_stale", "remoteok": "not_considered",
        "arbeitnow": "skip_empty", "lever": "not_considered",
    }
    assert {n: r["retired"] for n, r in report.items() if r["retired"]} == {"pittcsc": 2}


def test_snapshot_and_totals(result):
    rows = [(r["source"], r["title"], r["is_active"]) for r in result[0].jobs.collect()]
    assert sorted(r for r in rows if r[1]) == [
        ("pittcsc", "Data Analyst", True), ("pittcsc", "Software Engineer", True), ("vanshb03_newgrad", "Software Engineer", True),
    ]
    old = sorted((s, active) for s, title, active in rows if not title)
    assert old == [("arbeitnow", True)] * 2 + [("pittcsc", False)] * 2 + [("remoteok", True)] * 2
    assert result[0].totals == {"jobs": 9, "active": 7}
    assert result[0].jobs.columns == [f.split(" ")[0] for f in JOB.replace("array<float>", "x").split(", ")]


def test_audit_of_a_run(spark, result):
    rules = spark.createDataFrame(
        [("pittcsc", 3, 1, "strict"), ("vanshb03_newgrad", 3, 1, "strict"), ("remoteok", 1, 0, "strict"), ("dice", 1, 0, "skip")],
        "source string, baseline int, threshold int, mode string",
    )
    status = {r["source"]: r["status"] for r in run.audited(result[0].report, rules).collect()}
    assert status == {"pittcsc": "PASS", "vanshb03_newgrad": "WARN", "remoteok": "FAIL", "dice": "SKIP"}


def test_every_payload_is_read_once(spark, result):
    """The branch of a source reads the folder of that source and run, and no other."""
    landing = run.landed_run(spark, str(result[1] / "landing"), "r1")
    for source in chosen(["pittcsc", "arbeitnow"]):
        rows = source.adapter(Landed(landing, source.name, NOW))
        files = {f.split("/landing/")[1].rsplit("/", 1)[0] for f in rows.inputFiles()}
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Scan parquet") == 1 and f"(source" in plan and files, plan


def test_a_second_run_goes_on_from_the_first(spark, result, tmp_path):
    first = result[0].jobs
    rows = [payload("pittcsc", listing((1, "Software Engineer", "A", "https://x/1"))),
            payload("vanshb03_newgrad", listing((2, "Software Engineer", "C", "https://x/3")))]
    second = run.run_all_sources(landed(spark, tmp_path, rows), first, str(tmp_path / "out"), NOW, names=NAMES[:2])
    gone = {r["title"] for r in second.jobs.collect() if r["title"] and not r["is_active"]}
    assert gone == {"Data Analyst"}
    assert second.totals["jobs"] == result[0].totals["jobs"]


def test_registry(spark):
    assert len({s.name for s in SOURCES}) == len(SOURCES) == 45
    assert {s.name for s in SOURCES} - {s.name for s in chosen(skip_slow=True)} == {
        "ziprecruiter", "glassdoor", "handshake", "bamboohr", "dice_rss"
    }
    with pytest.raises(ValueError, match="nowhere"):
        chosen(["nowhere"])
    empty = spark.createDataFrame([], RAW_PAYLOAD)
    want = spark.createDataFrame([], POSTING)
    several = ("ambicuity", "builtin", "ashby", "breezy", "oraclecloud")  # of several parts or tables
    for source in chosen(several):
        rows = source.adapter(Landed(empty, source.name, NOW))
        assert rows.dtypes == want.dtypes, source.name
