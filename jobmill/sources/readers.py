"""Landed payloads to rows: JSON arrays, Markdown tables, XML items, HTML cards, JSON-LD.

A payload row is ``source, run_id, fetch_seq, request_key, status, content_type, body``.
Readers add ``ingest_seq``, the order in which entries arrived.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.places import address
from ..functions.regex import ecma, first_match, let
from ..functions.text import js_trim, strip_html
from ..operators.dedup import dedupe_by
from ..settle import settle

_ID = ["run_id", "request_key", "fetch_seq"]


def ingest_seq(fetch_seq: str = "fetch_seq", pos: str = "pos") -> Column:
    """Payload order first, position in the payload second."""
    return F.shiftleft(F.col(fetch_seq), 32) + F.col(pos)


def _is_array(text: Column) -> Column:
    return F.ltrim(text).startswith("[")


def parse_array(text: Column, item: str) -> Column:
    """The JSON array ``text`` as ``array<struct<item>>``; null when it is no array."""
    return let(text, lambda t: F.when(_is_array(t), F.from_json(t, f"array<struct<{item}>>")))


def json_items(
    payloads: DataFrame, item: str, paths: Sequence[str], extra: str = ""
) -> DataFrame:
    """One row per element of the first path that holds an array; ``""`` is the root.

    ``item`` declares the element fields, so the parser reads only those. ``extra``
    declares further top-level fields, returned as ``envelope``. Broken bodies and
    elements that are no objects give no rows.
    """
    tree: dict = {}
    for path in filter(None, paths):
        node = tree
        for step in path.split("."):
            node = node.setdefault(step, {})

    def ddl(node: dict) -> str:
        inner = [
            f"`{name}`: array<struct<{item}>>" if not sub else f"`{name}`: struct<{ddl(sub)}>"
            for name, sub in node.items()
        ]
        return ", ".join(inner)

    fields = ", ".join(filter(None, [ddl(tree), extra])) or "_none: string"
    parsed = payloads.withColumn(
        "envelope", F.when(~_is_array(F.col("body")), F.from_json("body", f"struct<{fields}>"))
    )
    arrays = [
        parse_array(F.col("body"), item) if not path else F.col("envelope." + path)
        for path in paths
    ]
    return (
        parsed.select(*_ID, "envelope", F.posexplode(F.coalesce(*arrays)).alias("pos", "item"))
        .filter("item IS NOT NULL")
        .withColumn("ingest_seq", ingest_seq())
        .select(*_ID, "ingest_seq", "envelope", "item.*")
    )


# -- Markdown ---------------------------------------------------------------------------

_SEPARATOR = ecma(r"^(?:\|\s*:?-{3,}:?\s*)+\|\z")


def markdown_lines(payloads: DataFrame) -> DataFrame:
    """Lines with their cells; ``cells`` is null on lines that are no table rows."""
    lines = payloads.select(*_ID, F.posexplode(F.split("body", "\n")).alias("pos", "line"))
    cells = F.transform(F.split("line", "\\|", -1), js_trim)
    inner = F.slice(cells, 2, F.greatest(F.size(cells) - 2, F.lit(0)))
    is_row = F.col("line").startswith("|") & ~js_trim(F.col("line")).rlike(_SEPARATOR)
    return lines.transform(settle, {"cells": F.when(is_row, inner), "ingest_seq": ingest_seq()})


def in_document() -> "Window":
    """Lines of one payload up to the current one."""
    return Window.partitionBy(*_ID).orderBy("pos").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )


def markdown_table(
    payloads: DataFrame, columns: Sequence[str], header: str = "Company", repeat: str | None = None
) -> DataFrame:
    """Rows with exactly these columns, raw cell text.

    With ``repeat``, a first cell that equals it takes the first cell of the row above.
    An empty first cell is a value of its own.
    """
    rows = markdown_lines(payloads).filter(
        (F.size("cells") == len(columns)) & (F.col("cells")[0] != header)
    )
    rows = rows.select(
        *_ID, "pos", "ingest_seq", *[F.col("cells")[i].alias(c) for i, c in enumerate(columns)]
    )
    if repeat is not None:
        first = columns[0]
        named = F.when(F.col(first) != repeat, F.col(first))
        rows = rows.withColumn(first, F.last(named, ignorenulls=True).over(in_document()))
    return rows


# -- XML and HTML -----------------------------------------------------------------------


def tag(block: Column, name: str) -> Column:
    """Inner text of the first element of that name, untouched; null without any."""
    return first_match(block, f"(?is)<{name}[^>]*>(.*?)</{name}>")


def tag_text(block: Column, name: str) -> Column:
    """Readable text of an element; null when nothing is left."""
    return F.nullif(strip_html(tag(block, name), "xml"), F.lit(""))


def tag_texts(block: Column, name: str) -> Column:
    found = F.regexp_extract_all(block, F.lit(f"(?is)<{name}[^>]*>(.*?)</{name}>"), F.lit(1))
    return F.filter(F.transform(found, lambda b: strip_html(b, "xml")), lambda t: t != "")


def plain_tag(block: Column, name: str) -> Column:
    """Trimmed inner text with one CDATA wrapper removed; empty when absent."""
    inner = js_trim(F.coalesce(tag(block, name), F.lit("")))
    inner = F.regexp_replace(inner, "^<!\\[CDATA\\[", "")
    return js_trim(F.regexp_replace(inner, "\\]\\]>\\z", ""))


def blocks(payloads: DataFrame, pattern: str, group: int = 1) -> DataFrame:
    """One row per match of a pattern in the body: XML items or whole HTML cards."""
    found = F.regexp_extract_all("body", F.lit(pattern), F.lit(group))
    return payloads.select(*_ID, F.posexplode(found).alias("pos", "block")).withColumn(
        "ingest_seq", ingest_seq()
    )


def cards(payloads: DataFrame, marker: str, end: str | None = None) -> DataFrame:
    """The page cut at each marker (a Java pattern); ``end`` closes a card early."""
    parts = F.split("body", marker, -1)
    parts = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
    block = F.col("block") if end is None else F.substring_index("block", end, 1)
    return (
        payloads.select(*_ID, F.posexplode(parts).alias("pos", "block"))
        .withColumn("block", block)
        .withColumn("ingest_seq", ingest_seq())
    )


def absolute_url(url: Column, root: str | Column) -> Column:
    base = F.lit(root) if isinstance(root, str) else root
    return F.when(url.startswith("http") | (url == ""), url).otherwise(F.concat(base, url))


# -- JSON inside pages ------------------------------------------------------------------

_LD_SCRIPT = (
    "(?is)<script[^>]+type=[\"']application/ld\\+json[\"'][^>]*>([^<]*+(?:<(?!/script>)[^<]*+)*+)</script>"
)
#: what a script with a whole posting contains; letters may be written as escapes
_LD_NAMED = r"(?i)jobposting|\\u"
_LD_ITEM = (
    "`@type`: string, title: string, description: string, datePosted: string, url: string, "
    "hiringOrganization: struct<name: string>, jobLocation: string, jobLocationType: string"
)
_LD_ROOT = f"{_LD_ITEM}, `@graph`: array<struct<{_LD_ITEM}>>"
_ADDRESS = (
    "address: struct<addressLocality: string, addressRegion: string, addressCountry: string>"
)


def json_ld_posting(html: Column) -> Column:
    """The first job posting in the page's JSON-LD scripts, as a struct; null without one.

    Looks at objects, arrays of objects and their ``@graph``. Broken scripts are skipped.
    """
    scripts = F.regexp_extract_all(html, F.lit(_LD_SCRIPT), F.lit(1))
    names = [f.split(":")[0].strip(" `") for f in _LD_ITEM.replace("struct<name: string>", "x").split(", ")]

    def objects(script: Column) -> Column:
        roots = F.coalesce(
            parse_array(script, _LD_ROOT),
            F.array(F.from_json(script, f"struct<{_LD_ROOT}>")),
        )

        def flat(root: Column) -> Column:
            own = F.struct(*[root[n].alias(n) for n in names])
            graph = F.coalesce(root["@graph"], F.array().cast(f"array<struct<{_LD_ITEM}>>"))
            return F.concat(F.array(own), graph)

        return F.flatten(F.transform(roots, flat))

    # Parsing costs most, a broken text more than a whole one: only what can hold a posting is.
    named = F.filter(scripts, lambda s: s.contains("}") & s.rlike(_LD_NAMED))
    found = F.flatten(F.transform(named, objects))
    jobs = F.filter(found, lambda o: F.lower(o["@type"]).rlike('(^|")jobposting("|\\z)'))
    return F.try_element_at(jobs, F.lit(1))


def json_ld_place(posting: Column, fallback: Column) -> Column:
    """City, region and foreign country of the first location that has any."""
    raw = posting["jobLocation"]
    places = F.coalesce(
        parse_array(raw, _ADDRESS), F.array(F.from_json(raw, f"struct<{_ADDRESS}>"))
    )

    def named(place: Column) -> Column:
        a = place["address"]
        return address(a["addressLocality"], a["addressRegion"], a["addressCountry"])

    return F.coalesce(
        F.try_element_at(F.array_compact(F.transform(places, named)), F.lit(1)), fallback
    )


def next_data(html: Column) -> Column:
    """Text of the page's ``__NEXT_DATA__`` script."""
    return first_match(html, '(?s)<script[^>]*id="__NEXT_DATA__"[^>]*>(.*?)</script>')


def page_attribute(html: Column) -> Column:
    """Text of the ``data-page`` attribute, still escaped."""
    return first_match(html, 'data-page="([^"]+)"')


def embedded_object(html: Column, markers: Sequence[str]) -> Column:
    """The JSON object after the first marker that is followed by a whole one.

    Spark's parser stops at the end of the object and tells braces inside strings apart;
    what follows the object does not matter.
    """

    def after(marker: str) -> Column:
        at = F.position(F.lit(marker), html)
        start = F.position(F.lit("{"), html, at + len(marker))
        found = F.to_json(F.try_parse_json(F.substr(html, start)))
        return F.when((at > 0) & (start > 0), found)

    return F.coalesce(*[after(marker) for marker in markers])


def nested_objects(text: Column, required: Sequence[Sequence[str]], type_name: str = "") -> Column:
    """JSON text of all objects at any depth that have the required string fields.

    Each entry of ``required`` lists alternative names. With ``type_name`` the object's
    ``@type`` must be, or contain, it. The depth is open, so no fixed schema can walk it.

    Whole pages travel here, so they go to Python a hundred at a time: an Arrow batch holds up
    to 64 MB of them, of which both sides of each task keep several copies.
    """
    wanted = [list(names) for names in required]

    def fits(node: dict) -> bool:
        if type_name:
            kind = node.get("@type")
            if kind != type_name and not (isinstance(kind, list) and type_name in kind):
                return False
        return all(
            any(isinstance(node.get(n), str) and node[n] for n in names) for names in wanted
        )

    def walk(node) -> Iterator[dict]:
        stack = [node]
        while stack:
            current = stack.pop()
            if isinstance(current, list):
                stack.extend(reversed(current))
            elif isinstance(current, dict):
                if fits(current):
                    yield current
                stack.extend(reversed(list(current.values())))

    def find(value: str | None) -> list[str]:
        try:
            root = json.loads(value) if value else None
        except ValueError:
            return []
        return [json.dumps(o, ensure_ascii=False) for o in walk(root)]

    return F.udf(find, "array<string>", useArrow=False)(text)


# -- Choosing and joining payloads -------------------------------------------------------


def first_nonempty_payload(
    candidates: DataFrame, keys: Sequence[str] = ("request_key",), priority: str = "priority"
) -> DataFrame:
    """Rows of the best endpoint that gave any, per request."""
    best = F.min(priority).over(Window.partitionBy(*keys))  # candidates are parsed once
    return candidates.withColumn("_best", best).filter(F.col(priority) == F.col("_best")).drop("_best")


def run_order(run_id: Column) -> Column:
    """Orders run ids with their numbers compared as numbers: ``run9`` before ``run10``."""
    padded = F.regexp_replace(run_id, r"(\d+)", "0" * 40 + "$1")
    anywhere = F.regexp_replace(padded, r"0*(\d{40})(?!\d)", "$1")
    # Most ids end in their only number, which needs no pattern.
    name = F.translate(run_id, "0123456789", "")
    digits = F.length(run_id) - F.length(name)
    number = F.lpad(F.substring(run_id, F.length(name) + 1, digits), 40, "0")
    return F.when(run_id.startswith(name) & digits.between(1, 40), F.concat(name, number)).otherwise(anywhere)


def newest_payload(payloads: DataFrame, keys: Sequence[str] = ("request_key",)) -> DataFrame:
    """The payload of each key that landed last, so a page fetched again counts once.

    A column ``landed_at`` decides if there is one; otherwise, and between equal times,
    the numbers in ``run_id`` do, then the id and ``fetch_seq``.
    """
    landed = [c for c in ("landed_at",) if c in payloads.columns]
    rows = payloads.withColumn("_run", run_order(F.col("run_id")))
    return dedupe_by(rows, list(keys), [*landed, "_run", "run_id", "fetch_seq"], keep="last").drop("_run")


def detail_enrich(
    listings: DataFrame,
    details: DataFrame,
    keys: Sequence[str],
    only_missing: bool = False,
) -> DataFrame:
    """Listings with the description of their detail page, empty when there is none.

    ``details`` has the keys and ``detail_text``, one row per key. With ``only_missing``
    a listing that has a description keeps it.
    """
    joined = listings.join(details.select(*keys, "detail_text"), list(keys), "left")
    text = F.coalesce("detail_text", F.lit(""))
    if only_missing:
        own = F.coalesce("description", F.lit(""))
        text = F.when(js_trim(own) != "", own).otherwise(text)
    return joined.withColumn("description", text).drop("detail_text")
