import base64
import gzip
import hashlib
from pathlib import Path

from llm_cases import clashing, frame
from pyspark.sql import functions as F

from jobmill.llm import warc

ROWS = "page_id long, url string, html string"


def rows():
    return [
        (1, "http://a/1", "<html>one</html>"),
        (2, "http://a/2", "<html>one</html>"),
        (9, "http://a/9", "<html>one</html>"),
        (3, None, None),
        (4, "http://a/4\r\nWARC-Type: forged", ""),
        (5, "http://a/é", "ends with return\r"),
        (6, "http://a/6", "ends with line\r\n"),
        (7, "http://a/7", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.1\r\n"),
        (8, "http://a/8", "\r\n\r\n\r\r\n"),
        (None, "http://a/n", "no id"),
        (10, "http://a/10", "née " * 700 + "\r\n" + "ü" * 1000),
        (11, "http://a/11", "twice"),
        (11, "http://a/11", "twice"),
    ]


def expected(least=0):
    table = rows()
    out = []
    for page, _, html in table:
        data = (html or "").encode()
        same = [p for p, _, h in table if (h or "") == (html or "") and p is not None]
        largest = max(same) if same and len(data) >= least else page
        code = base64.b32encode(hashlib.sha1(data).digest()).decode()
        kind = "response" if page == largest else "revisit"
        out.append((page, len(data), code, kind, None if page == largest else largest))
    return sorted(out, key=str)


def trip(spark, tmp_path, name, df, **options):
    path = str(tmp_path / name)
    warc.write_archives(df, path, **options)
    found = warc.resolve(warc.read_records(spark, path)).collect()
    return path, sorted(
        ((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in found),
        key=str,
    )


def test_round_trip(spark, tmp_path):
    df = clashing(frame(spark, rows(), ROWS), "digest", "bytes", "payload", "chunk")
    path, found = trip(spark, tmp_path, "a", df)
    assert found == expected()
    text = b"".join(gzip.decompress(p.read_bytes()) for p in Path(path).glob("part-*"))
    assert text.count(b"WARC-Type: response") + text.count(b"WARC-Type: revisit") == len(rows())
    assert b"\r\nWARC-Type: forged" not in text


def test_least_bytes(spark, tmp_path):
    _, found = trip(spark, tmp_path, "b", frame(spark, rows(), ROWS), least_bytes=10)
    assert found == expected(10)


def test_chunks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "CHUNK_BYTES", 64)
    df = frame(spark, rows(), ROWS)
    body = F.coalesce("html", F.lit(""))
    sized = df.select("page_id", "url", body.alias("payload")).withColumns(
        {"digest": warc.payload_digest(F.col("payload")), "bytes": F.octet_length("payload").cast("long"),
         "refers_to": F.lit(None).cast("long")}
    )
    assert warc.chunk_rows(sized).count() >= len(rows())


def test_segmented_records_are_joined(spark, tmp_path):
    long = "é" * (warc.CHUNK_BYTES // 2 * 3 + 5) + "\r\n" + "x" * 10
    path, found = trip(spark, tmp_path, "c", frame(spark, [(1, "u", long), (2, "v", "short")], ROWS))
    data = long.encode()
    assert (1, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response", None) in found
    text = b"".join(gzip.decompress(p.read_bytes()) for p in Path(path).glob("part-*"))
    assert text.count(b"WARC-Type: continuation") == 3 and text.count(b"WARC-Segment-Number: ") == 4


def test_empty_table(spark, tmp_path):
    _, found = trip(spark, tmp_path, "d", frame(spark, [], ROWS))
    assert found == []
