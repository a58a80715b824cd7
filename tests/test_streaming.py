"""Streams of landed payloads against the same runs merged as batches."""

import json

import pytest
from pyspark.sql import functions as F

from jobmill.operators.dedup import dedupe_across_sources
from jobmill.operators.merge import merge_snapshot
from jobmill.schema import JOB, RAW_PAYLOAD
from jobmill.sources import lists
from jobmill.sources.readers import newest_payload
from jobmill.streaming import incremental as inc

NOW = F.lit("2026-04-23 00:00:00").cast("timestamp")
SOURCES = ("pittcsc", "simplify_internships", "vanshb03_newgrad")


def entry(i, url, company="Acme", day=1):
    return {
        "id": f"x{i}", "title": f"Software Engineer {i}", "company_name": company, "locations": ["Austin, TX"],
        "url": url, "is_visible": True, "date_posted": 1_700_000_000 + day * 86_400,
    }


def adapter(payloads):
    parts = [
        lists.visible_list(payloads.filter(F.col("source") == s), s, "new_grad").withColumn("source_rank", F.lit(i))
        for i, s in enumerate(SOURCES)
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


RUNS = {
    "r1": [
        ("pittcsc", [entry(1, "https://a/1"), entry(2, "https://a/2", day=5)]),
        ("vanshb03_newgrad", [entry(9, "https://a/1"), entry(2, "https://other/2", day=2)]),
        ("simplify_internships", [entry(3, "https://a/3"), entry(2, "https://a/2")]),
    ],
    "r2": [
        ("simplify_internships", [entry(1, "https://b/1", day=9), entry(4, "https://b/4")]),
        ("pittcsc", [entry(4, "https://b/4", day=3)]),
    ],
}


def shown(df):
    columns = ["dedup_hash", "source", "title", "url", "posted_at", "is_active", "id"]
    return sorted(tuple(r) for r in df.select(*columns).collect())


def frame(spark, run, name, body, seq):
    return spark.createDataFrame([(name, run, seq, name, 200, "application/json", json.dumps(body))], RAW_PAYLOAD)


@pytest.mark.parametrize("files", [1, 3, 1000])
def test_result_does_not_depend_on_micro_batches(spark, tmp_path, files):
    expected = spark.createDataFrame([], JOB)
    for run, bodies in RUNS.items():
        whole = None
        for seq, (name, body) in enumerate(bodies):
            part = frame(spark, run, name, body, seq)
            part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/landing")
            whole = part if whole is None else whole.unionByName(part)
        inc.run_end(spark, run).coalesce(1).write.mode("append").parquet(f"{tmp_path}/landing")
        expected = merge_snapshot(expected, dedupe_across_sources(adapter(whole)), NOW)
    stream = inc.incremental_merge(
        spark, f"{tmp_path}/landing", f"{tmp_path}/store", adapter, f"{tmp_path}/check", NOW, files_per_batch=files, buckets=4
    )
    stream.awaitTermination()
    assert shown(inc.read_snapshot(spark, f"{tmp_path}/store")) == shown(expected)


def test_only_touched_buckets_are_written(spark, tmp_path):
    store = f"{tmp_path}/store"
    first = adapter(frame(spark, "r1", "pittcsc", [entry(i, f"https://a/{i}") for i in range(40)], 0))
    inc.merge_run(spark, store, "r1", first, NOW, buckets=8)
    one = adapter(frame(spark, "r2", "pittcsc", [entry(7, "https://a/7")], 0))
    inc.merge_run(spark, store, "r2", one, NOW, buckets=8)
    inc.merge_run(spark, store, "r2", one, NOW, buckets=8)  # a run is merged once
    assert inc.read_snapshot(spark, store).count() == 40
    assert len(list((tmp_path / "store/data/version=0000000002").glob("bucket=*"))) == 1
    assert not (tmp_path / "store/data/version=0000000003").exists()


def _land(spark, tmp_path, run, day):
    part = frame(spark, run, "pittcsc", [entry(1, f"https://{run}/1", day=day), entry(day, f"https://{run}/{day}")], 0)
    part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/landing")
    inc.run_end(spark, run).coalesce(1).write.mode("append").parquet(f"{tmp_path}/landing")
    return part


@pytest.mark.parametrize("files", [1, 1000])
@pytest.mark.parametrize("runs", [("r2", "r1"), ("run9", "run10")])
def test_runs_are_merged_in_the_order_they_end(spark, tmp_path, runs, files):
    expected = spark.createDataFrame([], JOB)
    for n, run in enumerate(runs):
        part = _land(spark, tmp_path, run, 5 + n)
        expected = merge_snapshot(expected, dedupe_across_sources(adapter(part)), NOW)
    inc.incremental_merge(
        spark, f"{tmp_path}/landing", f"{tmp_path}/store", adapter, f"{tmp_path}/check", NOW, files_per_batch=files, buckets=4
    ).awaitTermination()
    assert shown(inc.read_snapshot(spark, f"{tmp_path}/store")) == shown(expected)


def _stream(spark, tmp_path, adapt=adapter):
    inc.incremental_merge(
        spark, f"{tmp_path}/landing of runs", f"{tmp_path}/store", adapt, f"{tmp_path}/check", NOW, buckets=4
    ).awaitTermination()


def _append(tmp_path, rows):
    rows.coalesce(1).write.mode("append").parquet(f"{tmp_path}/landing of runs")


def test_a_run_reads_its_own_files_and_late_payloads_are_named(spark, tmp_path):
    read = []

    def adapt(payloads):
        read.append(len(payloads.inputFiles()))
        return adapter(payloads)

    for i in range(10, 13):  # a run that stays open; postings are told apart by title
        _append(tmp_path, frame(spark, "open", "pittcsc", [entry(i, f"https://o/{i}")], i))
    _append(tmp_path, frame(spark, "r1", "pittcsc", [entry(1, "https://a/1")], 0))
    _append(tmp_path, frame(spark, "r1", "pittcsc", [entry(2, "https://a/2")], 1))
    _append(tmp_path, inc.run_end(spark, "r1"))
    _append(tmp_path, inc.run_end(spark, "r0"))  # a run without payloads
    _stream(spark, tmp_path, adapt)
    store = f"{tmp_path}/store"
    assert sorted(read) == [0, 2]
    assert inc.late_payloads(spark, store).count() == 0
    assert [tuple(r)[:3] for r in inc.open_runs(spark, store).collect()] == [("open", 3, 3)]
    before = shown(inc.read_snapshot(spark, store))
    assert len(before) == 2
    _append(tmp_path, frame(spark, "r1", "pittcsc", [entry(3, "https://a/3")], 2))  # after its closing row
    _append(tmp_path, inc.run_end(spark, "open"))
    _stream(spark, tmp_path, adapt)
    assert sorted(read) == [0, 2, 3]
    assert [(r["run_id"], r["payloads"]) for r in inc.late_payloads(spark, store).collect()] == [("r1", 1)]
    assert inc.open_runs(spark, store).count() == 0
    after = shown(inc.read_snapshot(spark, store))
    assert len(after) == 5 and {r[0] for r in before} < {r[0] for r in after}


def test_newest_payload_takes_numbers_and_landed_times(spark):
    both = frame(spark, "run9", "a", [], 7).unionByName(frame(spark, "run10", "a", [], 0))
    assert [r["run_id"] for r in newest_payload(both).collect()] == ["run10"]
    timed = both.withColumn("landed_at", F.when(F.col("run_id") == "run9", NOW).otherwise(NOW - F.expr("INTERVAL 1 DAY")))
    assert [r["run_id"] for r in newest_payload(timed).collect()] == ["run9"]
