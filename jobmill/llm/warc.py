"""WARC archives as a table of record chunks, and back.

Writing: pages become rows (record id, chunk number, bytes). A payload longer than
``CHUNK_BYTES`` is cut into chunks, and each chunk is a record of its own, the first one
the ``response`` or ``resource`` itself and the others ``continuation`` records that name
it (segmentation as the WARC format has it). Every chunk carries the SHA-1 of the payload
up to its end, kept up from chunk to chunk, so the last one has the digest of the whole.
Spark's text writer puts the records into gzip files, one per task, with CRLF after each.

Reading: files are read as lines that end with CRLF; a task follows Content-Length from
line to line and never holds more than one line, which a chunk bounds. Digests are kept up
from line to line; digest, length and the previous chunk are checked against the headers.

Equal payloads of at least ``least_bytes`` are stored once: the page with the largest id
has the ``response``, the others are ``revisit`` records without payload that refer to it.

Defined cases: a null payload is empty, a null url is an empty header; rows that tie for
the largest id are all responses, as are payloads whose ids are all null; URLs lose
control characters in the header, since a line end would end it; an empty table gives
archives without records.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship
from .spans import blocks
from .store import rewritten

CHUNK_BYTES = 1 << 20
BROADCAST_ROWS = 200_000
CRLF = "\r\n"

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def payload_digest(payload: Column) -> Column:
    """SHA-1 in upper-case base 32, as WARC headers write it."""
    code = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(code, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", _BASE32)


def elect(pages: DataFrame, least_bytes: int) -> DataFrame:
    """Rows (page_id, payload, digest, bytes) with ``refers_to``, null for responses."""
    large = pages.filter(F.col("bytes") >= least_bytes)
    chosen = large.groupBy("digest", "bytes").agg(
        F.count("*").alias("n"), F.max("page_id").alias("largest")
    )
    chosen = rewritten(chosen.filter("n > 1").drop("n"), "responses")
    small = chosen.count() <= BROADCAST_ROWS
    joined = pages.join(F.broadcast(chosen) if small else chosen, ["digest", "bytes"], "left")
    later = F.col("largest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("largest"))
    return joined.withColumn("refers_to", F.when(later, F.col("largest"))).drop("largest")


def chunk_rows(pages: DataFrame) -> DataFrame:
    """Rows (page_id, url, digest, bytes, refers_to, chunk, chunks, body, so_far)."""
    fixed = ["page_id", "url", "digest", "bytes", "refers_to"]
    source = pages.select(
        *fixed, F.when(F.col("refers_to").isNull(), F.col("payload")).otherwise("").alias("payload")
    )
    schema = source.drop("payload").schema.add("chunk", "long").add("chunks", "long")
    schema = schema.add("body", "string").add("so_far", "string")
    names = schema.names
    ship(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(len(fixed))):
                data, rows, numbers, counts, bodies, codes = block.data, [], [], [], [], []
                for i in range(block.rows):
                    lo, hi = block.offsets[i], block.offsets[i + 1]
                    cuts = [lo]
                    while hi - cuts[-1] > CHUNK_BYTES:
                        cut = cuts[-1] + CHUNK_BYTES
                        while data[cut] & 0xC0 == 0x80:  # not inside a character
                            cut -= 1
                        cuts.append(cut)
                    cuts.append(hi)
                    state = hashlib.sha1()
                    for k in range(len(cuts) - 1):
                        piece = data[cuts[k] : cuts[k + 1]].tobytes()
                        state.update(piece)
                        rows.append(block.row + i)
                        numbers.append(k + 1)
                        counts.append(len(cuts) - 1)
                        bodies.append(piece)
                        codes.append(base64.b32encode(state.digest()).decode())
                kept = [c.take(pa.array(rows, pa.int64())) for c in batch.columns[: len(fixed)]]
                made = [
                    pa.array(numbers, pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array(bodies, pa.binary()).cast(pa.string()),
                    pa.array(codes, pa.string()),
                ]
                yield pa.RecordBatch.from_arrays([*kept, *made], names)

    return source.mapInArrow(run, schema)


def _record_id(page_id: Column, digest: Column, chunk: Column) -> Column:
    code = F.md5(F.concat_ws("|", F.coalesce(page_id.cast("string"), F.lit("null")), digest, chunk.cast("string")))
    cuts = [F.substring(code, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def _header(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))


def records(chunks: DataFrame, date: str) -> DataFrame:
    """The text of one record per chunk row, without its last CRLF."""
    body = F.col("body")
    first, later = F.col("chunk") == 1, F.col("refers_to").isNotNull()
    uri = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7F]", "")
    origin = _record_id(F.col("page_id"), F.col("digest"), F.lit(1))
    none = F.lit("")
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _header("WARC-Type", F.when(later, "revisit").when(first, "response").otherwise("continuation")),
        _header("WARC-Record-ID", _record_id(F.col("page_id"), F.col("digest"), F.col("chunk"))),
        _header("WARC-Date", F.lit(date)),
        _header("WARC-Target-URI", uri),
        F.when(F.col("page_id").isNotNull(), _header("X-Page-ID", F.col("page_id").cast("string"))).otherwise(none),
        F.when(later, F.concat(
            _header("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            _header("WARC-Refers-To", _record_id(F.col("refers_to"), F.col("digest"), F.lit(1))),
            _header("X-Refers-To-Page-ID", F.col("refers_to").cast("string")),
        )).otherwise(none),
        F.when(F.col("chunks") > 1, F.concat(
            _header("WARC-Segment-Number", F.col("chunk").cast("string")),
            F.when(first, none).otherwise(_header("WARC-Segment-Origin-ID", origin)),
            F.when(F.col("chunk") == F.col("chunks"),
                   _header("WARC-Segment-Total-Length", F.col("bytes").cast("string"))).otherwise(none),
            _header("X-Digest-So-Far", F.concat(F.lit("sha1:"), F.col("so_far"))),
        )).otherwise(none),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _header("Content-Type", F.lit("text/html")),
        _header("Content-Length", F.octet_length(body).cast("string")),
        F.lit(CRLF),
    )
    return chunks.select(F.concat(head, body, F.lit(CRLF)).alias("value"))


def write_archives(
    pages: DataFrame,
    path: str,
    page_id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least_bytes: int = 0,
    date: str = "1970-01-01T00:00:00Z",
) -> None:
    """Write a record per page below ``path``, as gzip files of whole records."""
    body = F.coalesce(F.col(payload), F.lit(""))
    named = pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"), body.alias("payload"))
    sized = named.withColumns(
        {"digest": payload_digest(F.col("payload")), "bytes": F.octet_length("payload").cast("long")}
    )
    chunks = chunk_rows(elect(sized, least_bytes))
    records(chunks, date).write.option("lineSep", CRLF).option("compression", "gzip").text(path)


FIELDS = (
    "page_id long, record_type string, refers_to long, payload_bytes long,"
    " declared string, computed string"
)


class _Reader:
    """Follows the records of archive files line by line; lines come without their CRLF."""

    def __init__(self) -> None:
        self.head: dict[str, str] | None = None  # None between records
        self.left = -1  # payload bytes still to come, -1 in the header
        self.total = 0
        self.state = hashlib.sha1()

    def line(self, line: bytes) -> dict | None:
        """Take a line; a finished payload is given back."""
        if self.head is None:
            if line:
                if not line.startswith(b"WARC/"):
                    raise ValueError(f"no record begins with {line[:40]!r}")
                self.head, self.left = {}, -1
            return None
        if self.left < 0:
            if line:
                name, _, value = line.decode("utf-8", "replace").partition(":")
                self.head[name.strip().lower()] = value.strip()
            else:
                self.left = int(self.head["content-length"])
                if int(self.head.get("warc-segment-number", 1)) == 1:
                    self.state, self.total = hashlib.sha1(), 0
                self.total += self.left
            return None
        piece = line + b"\r\n"
        self.state.update(piece[: self.left])
        if len(piece) <= self.left:
            self.left -= len(piece)
            return None
        if len(piece) - self.left != 2:  # all that follows a payload is the record's CRLF
            raise ValueError("a record does not end where its length says")
        head, self.head = self.head, None
        return self._payload(head)

    def _payload(self, head: dict[str, str]) -> dict | None:
        code = base64.b32encode(self.state.digest()).decode()
        if head.get("x-digest-so-far", f"sha1:{code}") != f"sha1:{code}":
            raise ValueError("a chunk does not follow the one before it")
        if "warc-segment-number" in head and "warc-segment-total-length" not in head:
            return None
        return {
            "page_id": int(head["x-page-id"]) if "x-page-id" in head else None,
            "record_type": "revisit" if head["warc-type"] == "revisit" else "response",
            "refers_to": int(head["x-refers-to-page-id"]) if "x-refers-to-page-id" in head else None,
            "payload_bytes": self.total,
            "declared": head["warc-payload-digest"].removeprefix("sha1:"),
            "computed": code,
        }


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """A row per payload of the archives below ``path``, its length and digest as read."""
    ship(spark)
    names = [x.split()[0] for x in FIELDS.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader()
        for batch in batches:
            found = []
            for line in batch.column(0):
                record = reader.line(line.as_buffer().to_pybytes() if line.is_valid else b"")
                if record is not None:
                    found.append(record)
            columns = [pa.array([r[n] for r in found], k) for n, k in zip(names, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names)

    lines = spark.read.option("lineSep", CRLF).schema("value string").text(path)
    return lines.mapInArrow(run, FIELDS)


def resolve(found: DataFrame) -> DataFrame:
    """Records with the length and digest of the full payload, also for revisits.

    A revisit takes them from the response that it refers to; only revisits are joined.
    """
    fixed = ["page_id", "record_type", "refers_to"]
    responses = found.filter("record_type = 'response'")
    stored = responses.groupBy(F.col("page_id").alias("own"), F.col("computed").alias("code")).agg(
        F.max("payload_bytes").alias("payload_bytes")
    )
    later = found.filter("record_type = 'revisit'").select(*fixed, "declared")
    later = later.join(stored, (F.col("refers_to") == F.col("own")) & (F.col("declared") == F.col("code")), "left")
    columns = [*fixed, "payload_bytes", F.col("computed").alias("payload_digest")]
    return responses.select(*columns).unionByName(
        later.select(*fixed, "payload_bytes", F.col("code").alias("payload_digest"))
    )
