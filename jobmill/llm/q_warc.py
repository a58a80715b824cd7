"""Query and SQL of the WARC round trip."""

from pyspark.sql import DataFrame, SparkSession

from .registry import register, table
from .store import fresh_path, rewritten
from .warc import read_records, resolve, write_archives

_CODE = "sha1(coalesce(html, ''))"
_DIGITS = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (('0x' || substr(code, {5 * i + 1}, 5))::BIGINT // {32**j}) % 32 + 1, 1)"
    for i in range(8)
    for j in (3, 2, 1, 0)
)

SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, {_CODE} AS code FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, {_DIGITS} AS payload_digest FROM p),
m AS (SELECT payload_digest AS x, max(page_id) AS largest FROM d GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> largest THEN largest END AS refers_to
FROM d JOIN m ON payload_digest = x
"""


@register("op7_warc_round_trip", SQL)
def op7_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "archives")
    write_archives(table(spark, sf_dir, "pages"), path)
    found = resolve(rewritten(read_records(spark, path), "records"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
