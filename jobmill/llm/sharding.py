"""Shards of nearly equal bytes that keep equal texts together, by balanced label propagation.

Documents with equal texts are linked. Their rows start in the shard of their id's hash
and then move, in rounds, towards the shard where most bytes of their group are:

* Rows of a group in one shard form a block; rounds work on groups with their blocks,
  counted once, so a group of any number of rows costs at most one block per shard.
* A group larger than a share cannot stay whole. It is cut beforehand into parts of about
  ``PART`` of a share, and each part is a group of its own. Rows are dealt to parts by a
  hash of the row and its number among the rows with the same id and text, so that a row
  repeated any number of times is dealt out like different rows.
* A group asks for the shard of its heaviest block that has room for all of it, then for
  others with such room. A shard grants requests, large groups first and then in the order
  of their hash, while its share lasts; what the shard holds is only what it granted, so
  groups that have not moved yet take no room. The grant is a threshold per shard, from
  sums in bins, never a sort of all requests. Rounds end when nothing asks or is granted.
  A row of more than ``1 / SINGLE`` of a share is placed as a group of one.
* What has no partner, and groups that fit into no shard, fill the shards up: their rows
  are laid out on a line as long as the free room of all shards, those of one group side by
  side, and take the shard of their place; large rows first, in a few classes of size, so
  that the small ones even out. Sizes then differ by about one small document.

Places on the line and slots come from sums per hash bin, added up in Spark in two levels,
and from an order inside the bin, so no task ranks a whole shard and no list that grows with
the rows reaches the driver. Defined cases: a null text counts 8 bytes and has the checksum
of an empty one, null and empty texts being two groups; repeated rows are equal texts; a null
id is hashed like any other; a document larger than a share makes its shard larger.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import rewritten

SHARDS = 24
OVERHEAD = 8
PART = 0.2
SINGLE = 32
BINS = 1024
#: Groups of a share divided by powers of two up to this one are granted one class after another.
CLASSES = 8
#: Rounds without a grant (requests that met in one bin) before what still asks is laid out.
IDLE = 3
#: Rows of a share divided by these sizes are laid out one class after another.
EVEN_OUT = (128, 512)
#: Rows that one window of the layout may hold; the number of bins follows the rows.
BIN_ROWS = 20_000
#: Bins added up by one task.
WIDE = 1024


def _goal(room: Column, shards: int, number: int) -> Column:
    """The shard that a group asks for: of its blocks, else any; null if none has room."""
    enough = lambda at: F.get(room, at) >= F.col("bytes")
    homes = F.filter("homes", lambda h: enough(h["shard"]))
    others = F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), enough)
    drawn = F.pmod(F.xxhash64("part", F.lit(number)), F.greatest(F.size(others), F.lit(1)))
    return F.coalesce(F.get(homes, F.lit(0))["shard"], F.get(others, drawn.cast("int")))


def place_groups(groups: DataFrame, shards: int, share: float) -> DataFrame:
    """(part, shard) for every group that a shard takes whole.

    ``groups`` has rows (part, shard, bytes): the blocks where they start.
    """
    drawn = F.xxhash64("part", "shard")
    home = F.struct(F.col("bytes").alias("held"), drawn.alias("draw"), F.col("shard").cast("int").alias("shard"))
    waiting = groups.groupBy("part").agg(
        F.sort_array(F.collect_list(home), asc=False).alias("homes"), F.sum("bytes").alias("bytes")
    )
    waiting = rewritten(waiting, "groups")
    used = [0.0] * shards
    placed, number, idle = waiting.select("part", F.lit(0).alias("shard")).limit(0), 0, 0
    size = F.greatest(F.floor(F.log2(F.lit(share) / F.col("bytes"))), F.lit(0))
    while idle < IDLE:
        room = F.array(*[F.lit(share - x) for x in used])
        spot = F.least(size, F.lit(CLASSES - 1)) * BINS
        spot += F.pmod(F.xxhash64("part", F.lit(number), F.lit("bin")), F.lit(BINS))
        asks = waiting.withColumns({"goal": _goal(room, shards, number), "spot": spot}).filter("goal is not null")
        sums = asks.groupBy("goal", "spot").agg(F.sum("bytes").alias("bytes"))
        running = F.sum("bytes").over(Window.partitionBy("goal").orderBy("spot"))
        sums = sums.withColumn("running", running).filter(F.col("running") <= F.get(room, F.col("goal")))
        last = sums.groupBy("goal").agg(F.max("spot").alias("last"))  # a row per shard at most
        asks = asks.join(F.broadcast(last), "goal", "left")
        asks = asks.withColumn("shard", F.when(F.col("spot") <= F.col("last"), F.col("goal")))
        asks = rewritten(asks.select("part", "homes", "bytes", "shard"), "asks")
        found = asks.groupBy("shard").agg(F.sum("bytes").alias("bytes")).collect()
        if not found:
            break
        granted = [r for r in found if r["shard"] is not None]
        for r in granted:
            used[r["shard"]] += r["bytes"]
        placed = placed.unionByName(asks.filter("shard is not null").select("part", "shard"))
        waiting = asks.filter("shard is null").drop("shard")
        number, idle = number + 1, 0 if granted else idle + 1
    return placed


def _bins(rows: int) -> int:
    return max(256, 1 << math.ceil(math.log2(max(rows, 1) / BIN_ROWS + 1)))


def shard(
    docs: DataFrame, keep: list[str], shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Columns ``keep`` with ``size``, ``text_crc32``, ``shard`` and ``slot``."""
    added = ("size", "text_crc32", "shard", "slot")
    keep = [c for c in keep if c.lower() not in added]
    body = F.coalesce(F.col(text), F.lit(""))
    own = {f"__keep{i}": c for i, c in enumerate(keep)}  # apart from the names used here
    sized = docs.select(
        *[F.col(f"`{c}`").alias(x) for x, c in own.items()],
        (F.octet_length(body) + OVERHEAD).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.xxhash64(F.col(doc_id), F.col(text)).alias("__draw"),
        F.coalesce(F.unhex(F.substring(F.sha2(F.col(text), 256), 1, 32)), F.lit(b"")).alias("__group"),
    )
    written = rewritten(sized, "sized").select(
        "*", F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__row")
    )
    found = spread(written, shards)
    return found.select(*[F.col(x).alias(c) for x, c in own.items()], *added)


def _numbered(own: DataFrame) -> DataFrame:
    """Mix the number among rows with one ``__draw`` into it, so that no value is hot.

    Rows are counted per file of the written table, so a window holds rows of one file.
    """
    earlier = Window.partitionBy("__draw").orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)
    held = own.filter("parts is not null").groupBy("__draw", "__file").agg(F.count("*").alias("n"))
    held = held.select(
        "__draw",
        "__file",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
        F.sum("n").over(Window.partitionBy("__draw")).alias("all"),
    )
    held = rewritten(held.filter("all > 1").drop("all"), "held")
    if held.isEmpty():
        return own
    rank = F.row_number().over(Window.partitionBy("__draw", "__file").orderBy("__row"))
    twins = own.join(held, ["__draw", "__file"]).withColumn("number", F.col("before") + rank)
    twins = twins.withColumn("__draw", F.xxhash64("__draw", "number"))
    others = own.join(held, ["__draw", "__file"], "left_anti")
    return others.unionByName(twins.select(*own.columns))


def spread(sized: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Rows (…, size, __draw, __group, __file, __row) with ``shard`` and ``slot``."""
    total, count = sized.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    if not count:
        return sized.withColumn("shard", F.lit(0)).withColumn("slot", F.lit(0).cast("long"))
    share = total / shards
    sums = sized.groupBy("__group").agg(F.count("*").alias("n"), F.sum("size").alias("b"))
    parts = F.when(F.col("b") <= share, 1).otherwise(F.ceil(F.col("b") / (PART * share)))
    linked = sums.filter((F.col("n") > 1) | (F.col("b") * SINGLE > share)).select(
        "__group", parts.cast("long").alias("parts"), F.ceil(F.col("n") / BIN_ROWS).alias("pieces")
    )
    own = sized.join(rewritten(linked, "linked"), "__group", "left")  # a hot group can be split
    own = _numbered(rewritten(own, "own"))
    number = F.pmod(F.xxhash64("__draw", F.lit("part")), F.col("parts"))
    piece = F.pmod(F.xxhash64("__draw", F.lit("piece")), F.col("pieces"))
    own = own.withColumn("part", F.when(F.col("parts").isNotNull(), F.xxhash64("__group", number)))
    key = F.when(F.col("part").isNotNull(), F.xxhash64("part", piece)).otherwise(F.col("__draw"))
    own = own.withColumn("__key", key)
    own = own.withColumn("__bin", F.pmod(F.shiftright("__key", 20), F.lit(_bins(count))).cast("int"))
    own = rewritten(own.drop("parts", "pieces", "__group", "__file", "__row"), "parts")
    start = F.pmod(F.col("__draw"), F.lit(shards)).alias("shard")
    groups = own.filter("part is not null").groupBy("part", start).agg(F.sum("size").alias("bytes"))
    placed = rewritten(place_groups(groups, shards, share), "placed")
    own = rewritten(own.join(placed, "part", "left").drop("part"), "joined")
    return _slots(rewritten(_filled(own, shards, share), "shards"))


def _begins(sums: DataFrame, *over: str) -> DataFrame:
    """(*over, __bin, begin): the ``total`` of all bins before, added up in two levels."""
    sums = sums.withColumn("wide", F.floor(F.col("__bin") / WIDE))
    earlier = (Window.unboundedPreceding, -1)
    wide = Window.partitionBy(*over).orderBy("wide").rowsBetween(*earlier)
    bins = Window.partitionBy(*over, "wide").orderBy("__bin").rowsBetween(*earlier)
    ahead = sums.groupBy(*over, "wide").agg(F.sum("total").alias("total"))
    ahead = ahead.select(*over, "wide", F.coalesce(F.sum("total").over(wide), F.lit(0)).alias("ahead"))
    inside = sums.withColumn("inside", F.coalesce(F.sum("total").over(bins), F.lit(0)))
    begin = (F.col("ahead") + F.col("inside")).alias("begin")
    return inside.join(ahead, [*over, "wide"]).select(*over, "__bin", begin)


def _filled(own: DataFrame, shards: int, share: float) -> DataFrame:
    """Give a shard to the rows that have none, large rows first, so small ones even out."""
    done = own.filter("shard is not null")
    free = own.filter("shard is null")
    bounds = [math.inf, *(share / x for x in EVEN_OUT), -1.0]
    for most, least in zip(bounds, bounds[1:], strict=False):
        rows = free.filter((F.col("size") >= least) & (F.col("size") < most))
        line = rows.agg(F.sum("size")).first()[0]
        if line is None:
            continue
        used = done.groupBy("shard").agg(F.sum("size").alias("b")).collect()
        used = {r["shard"]: r["b"] for r in used}
        room = [max(share - used.get(i, 0.0), 0.0) for i in range(shards)]
        scale = line / sum(room) if sum(room) else 0.0
        ends, at = [], 0.0
        for x in room:
            at += x * scale
            ends.append(at)
        order = Window.partitionBy("__bin").orderBy("__key", "__draw", "size")
        before = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1))
        middle = F.col("begin") + F.coalesce(before, F.lit(0)) + F.col("size") / 2
        begins = _begins(rows.groupBy("__bin").agg(F.sum("size").alias("total")))
        place = rows.join(begins, "__bin").withColumn("middle", middle)
        passed = F.lit(0)
        for end in ends[:-1]:
            passed += (F.col("middle") >= F.lit(end)).cast("int")
        filled = place.withColumn("shard", passed).drop("begin", "middle")
        filled = rewritten(filled.select(*done.columns), "filled")
        done = done.unionByName(filled)
    return done


def _slots(rows: DataFrame) -> DataFrame:
    begins = _begins(rows.groupBy("shard", "__bin").agg(F.count("*").alias("total")), "shard")
    order = Window.partitionBy("shard", "__bin").orderBy("__key", "__draw", "size")
    out = rows.join(begins, ["shard", "__bin"])
    return out.withColumn("slot", F.col("begin") + F.row_number().over(order) - 1).drop("begin")


def cut_report(found: DataFrame, group: str) -> DataFrame:
    """One row: groups of several rows, those in several shards, and the links in all.

    A group of n rows has n - 1 links, of which one per shard beyond the first is cut.
    """
    per = found.groupBy(F.col(group).alias("group"), "shard").agg(F.count("*").alias("n"))
    per = per.groupBy("group").agg(F.sum("n").alias("n"), F.count("*").alias("shards")).filter("n > 1")
    return per.agg(
        F.count("*").alias("groups"),
        F.count_if(F.col("shards") > 1).alias("cut_groups"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("links"),
        F.coalesce(F.sum(F.col("shards") - 1), F.lit(0)).alias("cut_links"),
    )
