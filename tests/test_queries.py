"""The registry, and a sample of queries against DuckDB at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as entry
from check_oracles import TABLES, compare

FOLDER = "/root/testdata/sf0.001"
SAMPLE = [
    "classified_postings", "c8_staged_filter", "d3_dedupe_across_sources", "d6_greedy_dedupe", "m1_merge_snapshot",
    "m5_retire", "f5_alert_digest", "e3_embedding_batches", "e10_vector_topk", "b6_apply_validation",
    "s1_greenhouse", "s2_headed_table", "s3_personio", "s5_icims", "s7_comment_thread", "st1_incremental_merge",
]


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for t in TABLES.split():
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return connection


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, con, name):
    status, _, _, detail = compare(spark, con, name, FOLDER)
    assert status == "ok", detail
