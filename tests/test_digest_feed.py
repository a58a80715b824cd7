"""Digests, search and the tracker on small tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from jobmill.operators import digest, feed

AS_OF = dt.datetime(2026, 4, 23)
NOW = F.lit("2026-04-23 00:00:00").cast("timestamp")


def jobs_frame(spark, rows):
    """``(id, days ago, title, roles)``"""
    data = [
        (i, t, f"Firm {i}", "Austin, TX", f"https://x/{i}", "", AS_OF - dt.timedelta(days=d), True, True, "entry_level", r)
        for i, d, t, r in rows
    ]
    return spark.createDataFrame(
        data,
        "id string, title string, company string, location string, url string, description string, posted_at timestamp, "
        "is_active boolean, is_usa boolean, experience_level string, roles array<string>",
    )


def users_frame(spark, rows):
    return spark.createDataFrame(
        rows, "user_id string, has_vector boolean, wanted_roles array<string>, wanted_levels array<string>"
    )


def no_pairs(spark):
    return spark.createDataFrame([], "user_id string, job_id string")


def test_the_first_window_with_a_match_wins(spark):
    rows = [("near", 2, "One", ["swe"])] + [(f"far{i}", 6, f"T{i}", ["swe"]) for i in range(10)]
    users = users_frame(spark, [("u", False, [], [])])
    out = digest.recent_digest(users, jobs_frame(spark, rows), no_pairs(spark), no_pairs(spark), NOW).collect()
    assert [(r["job_id"], r["window_days"], r["grade"]) for r in out] == [("near", 3, "C")]


def recent_model(jobs, users, seen):
    out = {}
    for user, _, roles, levels in users:
        rows = [j for j in jobs if (not roles or set(roles) & set(j[3])) and (user, j[0]) not in seen]
        rows.sort(key=lambda j: (j[1], j[0]))
        window = next((w for w in (3, 7, 14) if any(j[1] < w for j in rows)), None)
        kept, titles = [], set()
        for j in rows:
            if window is None or j[1] >= window or len(kept) == 10:
                continue
            if j[2] not in titles:
                titles.add(j[2])
                kept.append(j[0])
        out[user] = kept
    return out


def _days(spark, monkeypatch, prefix, jobs, users, seen=()):
    monkeypatch.setattr(digest, "CELL_PREFIX", prefix)
    frame = jobs_frame(spark, jobs).withColumn("company", F.lit("Acme"))
    pairs = spark.createDataFrame(sorted(seen), "user_id string, job_id string")
    out = digest.recent_digest(users_frame(spark, users), frame, pairs, no_pairs(spark), NOW).collect()
    return [r["job_id"] for r in sorted(out, key=lambda r: r["keep_rank"])], {r["window_days"] for r in out}


@pytest.mark.parametrize("prefix", [4, 50, 200, 1000])
def test_an_older_cell_does_not_overtake(spark, monkeypatch, prefix):
    """Two wanted cells; the prefix of one ends before the other begins."""
    jobs = [(f"a{i:03d}", 1, "Same", ["swe"]) for i in range(200)]
    jobs += [(f"b{i:02d}", 1.5, f"B{i}", ["swe"]) for i in range(20)]
    jobs += [(f"c{i:02d}", 2.5, f"C{i}", ["ds"]) for i in range(20)]
    users = [("u", False, ["swe", "ds"], [])]
    assert _days(spark, monkeypatch, prefix, jobs, users) == (["a000", *[f"b{i:02d}" for i in range(9)]], {3})


@pytest.mark.parametrize("prefix", [4, 50, 200, 1000])
def test_seen_rows_do_not_widen_the_window(spark, monkeypatch, prefix):
    jobs = [(f"a{i:03d}", 1, f"A{i}", ["swe"]) for i in range(200)]
    jobs += [(f"b{i:02d}", 2, f"B{i}", ["swe"]) for i in range(20)]
    jobs += [(f"c{i:02d}", 5, f"C{i}", ["ds"]) for i in range(20)]
    users = [("u", False, ["swe", "ds"], [])]
    seen = {("u", f"a{i:03d}") for i in range(200)}
    assert _days(spark, monkeypatch, prefix, jobs, users, seen) == ([f"b{i:02d}" for i in range(10)], {3})


@pytest.mark.parametrize("prefix", [4, 200])
def test_recent_digest_equals_a_scan(spark, monkeypatch, prefix):
    """Also when users need more than the prefix of their cells."""
    monkeypatch.setattr(digest, "CELL_PREFIX", prefix)
    kinds = [["swe"], ["ds"], ["swe", "ds"], []]
    jobs = [(f"j{i:02d}", 1 + i % 5, f"Title {i % 23}", kinds[i % 4]) for i in range(60)]
    # The same company everywhere, so that equal titles are the same posting.
    frame = jobs_frame(spark, jobs).withColumn("company", F.lit("Acme"))
    users = [("a", False, ["swe"], []), ("b", False, [], []), ("c", False, ["pm"], []), ("d", False, ["ds", "swe"], ["entry_level"])]
    seen = {("a", "j00"), ("b", "j05"), ("b", "j10"), ("d", "j20")}
    pairs = spark.createDataFrame(sorted(seen), "user_id string, job_id string")
    out = digest.recent_digest(users_frame(spark, users), frame, pairs, no_pairs(spark), NOW).collect()
    want = recent_model(jobs, users, seen)
    for user, kept in want.items():
        mine = sorted((r["keep_rank"], r["job_id"]) for r in out if r["user_id"] == user)
        assert [j for _, j in mine] == kept


def test_profile_clean_up(spark):
    rows = [
        ("1", " a@x ", None, True, [" SWE", "", "swe"], ["Entry Level", "?"], None),
        ("2", "  ", "pro", True, None, None, [1.0]), ("3", "b@x", "Pro ", False, None, None, None),
    ]
    df = spark.createDataFrame(
        rows,
        "id string, email string, tier string, job_alerts_enabled boolean, target_roles array<string>, "
        "target_levels array<string>, resume_embedding array<float>",
    )
    out = digest.eligible_users(df).collect()
    assert [(r["user_id"], r["email"], r["tier"], r["wanted_roles"], r["wanted_levels"], r["has_vector"]) for r in out] == [
        ("1", "a@x", "free", ["swe"], ["entry_level"], False)
    ]


def test_search_needs_every_word(spark):
    rows = [("1", "Data Engineer", "Acme", "data data"), ("2", "Engineer", "Data Co", ""), ("3", "Data", "x", "")]
    df = spark.createDataFrame(rows, "id string, title string, company string, description string")
    out = {r["id"]: round(r["rank"], 6) for r in feed.search_ranked(df, "Engineer, data!").collect()}
    assert out == {"1": 2.4, "2": 1.4}
    assert feed.search_ranked(df, " ?! ").count() == 0


def test_paging(spark):
    df = spark.range(120)
    order = [F.col("id")]
    assert [r["id"] for r in feed.page(df, order, "pro", 3).collect()] == list(range(100, 120))
    assert feed.page(df, order, "free", 1).count() == 20
    assert feed.page(df, order, "free", 2).count() == 0 and feed.needs_upgrade("free", 2)


def test_send_cap_counts_users(spark):
    df = spark.createDataFrame([(f"u{i % 5}", i) for i in range(20)], "user_id string, j int")
    assert {r["user_id"] for r in digest.send_cap(df, 2).collect()} == {"u0", "u1"}


def test_pairs_of_users_and_postings_are_spread_over_tasks(spark, monkeypatch):
    """The users come in one split; their pairs may not end up in one task."""
    monkeypatch.setattr(digest, "PAIRS_PER_TASK", 100)
    users = [(f"u{i:02d}", "*", "*") for i in range(40)] + [("u00", "swe", "*")]
    waiting = spark.createDataFrame(users, "user_id string, cell_role string, cell_level string").coalesce(1)
    cells = [(r, "*", f"j{i:02d}", AS_OF - dt.timedelta(hours=i)) for r in ("*", "swe") for i in range(50)]
    newest = spark.createDataFrame(cells, "cell_role string, cell_level string, job_id string, posted_at timestamp")
    place = F.struct((-F.unix_micros("posted_at")).alias("age"), F.col("job_id").alias("job"))
    bounds = newest.filter("job_id = 'j09'").limit(1).select(F.lit("u01").alias("user_id"), place.alias("_bound"))
    parts = digest._recent_pairs(waiting, newest, bounds, place).select("user_id", "job_id").rdd.glom().collect()
    assert max(map(len, parts)) < 400
    found = sorted((r["user_id"], r["job_id"]) for part in parts for r in part)
    assert found == sorted((f"u{i:02d}", f"j{j:02d}") for i in range(40) for j in range(10 if i == 1 else 50))
