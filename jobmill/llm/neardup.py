"""Near-duplicate classes by improved consistent weighted sampling.

A text is the multiset of its five-word shingles (a shorter text is one shingle of all
its words), weighted tf x idf. ``BANDS`` x ``ROWS`` consistent weighted samples are
banded; texts that share a band are compared by weighted Jaccard similarity, and links
of ``SIMILARITY`` or more make classes, transitively.

* idf = ``IDF_FLOOR`` + log(1 / p) / log(1 / ``RARE``), p the share of documents that hold
  the shingle, at least ``RARE``. Document frequencies of all documents are counted in
  ``IDF_BINS`` hashed bins, so their size does not grow with the corpus; a bin holds about
  600 / ``IDF_BINS`` of the documents by chance, below ``RARE``. The floor keeps the
  shingles of a large group of copies from weighing nothing.
* Equal texts are one node from the start, found by SHA-256. No pair is ever listed for
  a group: a bucket is cut into chunks of about ``CHUNK`` nodes by a hash, its smallest
  and largest node join every chunk, and a task compares inside one chunk, skipping what
  is already connected. Chunks differ from band to band. The first bands link most
  texts; of the others only buckets with nodes of different classes are looked at.
* What chunks kept apart is settled exactly: the nodes of every bucket of more than
  ``CHUNK`` nodes that still holds different classes go through a prefix join. In one
  order of all shingles, rarest first, two texts of similarity s or more share a shingle
  before either has used up 1 - s of its weight. Nodes that share such a shingle are
  compared across classes: all nodes outside the group's largest class, in parts, with
  all nodes of the group, in chunks. Nothing is capped; a task sees a part and a chunk.
* Chunks travel as text, and only texts that share a bucket travel at all.

Defined cases: a null text is a class of its own; equal texts without words are one
class; repeated rows are copies; the class id is the smallest id of its members.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship
from .graph import components
from .spans import PLAIN_WORD, U64, Block, blocks, fold_texts, gram_starts, grams, map_texts, mix
from .store import rewritten

SHINGLE = 5
SIMILARITY = 0.8
ROWS = 2
BANDS = 10
FIRST_BANDS = 3
IDF_BINS = 1 << 18
IDF_SLICES = 128
IDF_FLOOR = 4.0
RARE = 0.01
CHUNK = 48
#: Weights are banded by this step of their logarithm; texts that are alike are at most
#: ``NEAR_BANDS`` bands apart.
NEAR_BANDS = 8
BAND_STEP = math.log(1 / SIMILARITY) / NEAR_BANDS
BROADCAST_ROWS = 200_000

_HASH_BITS = 52
_ODD = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15)) | U64(1)


def shingles(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text in order, their counts, and the bounds by text."""
    words = block.lower().words(PLAIN_WORD)
    hashes = words.hashes()
    at = gram_starts(words.first, SHINGLE)
    owner = np.searchsorted(words.first, at, "right") - 1
    codes = grams(hashes, SHINGLE)[at] if len(at) else np.zeros(0, U64)
    for size in range(1, SHINGLE):
        short = np.flatnonzero(words.counts == size)
        if len(short):
            own = grams(hashes, size)[words.first[short]]
            owner, codes = np.concatenate([owner, short]), np.concatenate([codes, own])
    keys = (owner.astype(U64) << U64(_HASH_BITS)) | (codes >> U64(64 - _HASH_BITS))
    keys.sort()
    fresh = np.ones(len(keys), bool)
    fresh[1:] = keys[1:] != keys[:-1]
    heads = np.flatnonzero(fresh)
    counts = np.diff(np.append(heads, len(keys)))
    keys = keys[heads]
    first = np.searchsorted(keys >> U64(_HASH_BITS), np.arange(block.rows + 1, dtype=U64))
    return keys & U64((1 << _HASH_BITS) - 1), counts, first


def _bin(codes: np.ndarray) -> np.ndarray:
    return (codes & U64(IDF_BINS - 1)).astype(np.int64)


def bin_counts(docs: DataFrame, text: str) -> tuple[np.ndarray, int]:
    """Document frequencies by bin of all ``docs``, and how many of them have words."""
    width = IDF_BINS // IDF_SLICES

    def worker():
        seen = np.zeros(IDF_BINS, np.int64)
        texts = np.zeros(1, np.int64)

        def take(block: Block, batch: pa.RecordBatch) -> None:
            codes, _, first = shingles(block)
            np.add(seen, np.bincount(_bin(codes), minlength=IDF_BINS), out=seen)
            texts[0] += int((np.diff(first) > 0).sum())

        def give() -> Iterator[pa.RecordBatch]:
            numbers = [i for i in range(IDF_SLICES) if seen[i * width : (i + 1) * width].any()]
            packed = [zlib.compress(seen[i * width : (i + 1) * width].tobytes(), 1) for i in numbers]
            if texts[0]:
                numbers, packed = [*numbers, -1], [*packed, zlib.compress(texts.tobytes())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers, pa.int32()), pa.array(packed, pa.binary())], ["slice", "counts"]
            )

        return take, give

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = np.frombuffer(zlib.decompress(counts), np.int64)
                sums[number] = sums[number] + own if number in sums else own
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(sums), pa.int32()),
                pa.array([zlib.compress(x.tobytes(), 1) for x in sums.values()], pa.binary()),
            ],
            ["slice", "counts"],
        )

    schema = "slice int, counts binary"
    parts = fold_texts(docs, [text], schema, worker)
    total = np.zeros(IDF_BINS, np.int64)
    texts = 0
    for row in parts.repartition("slice").mapInArrow(add, schema).collect():
        own = np.frombuffer(zlib.decompress(bytes(row["counts"])), np.int64)
        if row["slice"] < 0:
            texts += int(own[0])
        else:
            total[row["slice"] * width : (row["slice"] + 1) * width] += own
    return total, texts


def idf_table(docs: DataFrame, text: str) -> np.ndarray:
    """idf by bin, from the document frequencies of all documents."""
    total, texts = bin_counts(docs, text)
    share = np.clip(total / max(texts, 1), RARE, 1.0)
    return (IDF_FLOOR + np.log(1 / share) / math.log(1 / RARE)).astype(np.float32)


def _gamma_quantiles(bits: int) -> np.ndarray:
    """Quantiles of the gamma distribution with shape 2 in the middle of equal steps."""
    x = np.exp(np.linspace(math.log(1e-6), math.log(60), 200_001))
    return np.interp((np.arange(1 << bits) + 0.5) / (1 << bits), 1 - (1 + x) * np.exp(-x), x)


class Sampler:
    """Consistent weighted samples of weighted sets, by tables of the random variables."""

    def __init__(self) -> None:
        self.log_c = np.log(_gamma_quantiles(20)).astype(np.float32)
        self.r = _gamma_quantiles(16).astype(np.float32)

    def samples(self, codes: np.ndarray, weights: np.ndarray, first: np.ndarray, count: int) -> np.ndarray:
        """A row per set and a column per sample; sets must not be empty."""
        log_w = np.log(weights).astype(np.float32)
        sizes = np.diff(first)
        out = np.zeros((len(sizes), count), U64)
        for k in range(count):
            x = codes * _ODD[k]
            x ^= x >> U64(29)
            x *= U64(0xBF58476D1CE4E5B9)
            r = self.r[(x >> U64(28) & U64(0xFFFF)).astype(np.int32)]
            beta = (x >> U64(12) & U64(0xFFFF)).astype(np.float32) * np.float32(1 / 65536)
            t = np.floor(log_w / r + beta)
            log_a = self.log_c[(x >> U64(44)).astype(np.int32)] - r * (t - beta + 1)
            least = np.minimum.reduceat(log_a, first[:-1])
            at = np.flatnonzero(log_a == np.repeat(least, sizes))
            owner = np.searchsorted(first, at, "right") - 1
            head = np.ones(len(at), bool)
            head[1:] = owner[1:] != owner[:-1]
            at = at[head]
            level = t[at].astype(np.int64).view(U64) * U64(0x9E3779B97F4A7C15)
            out[:, k] = mix(codes[at] ^ level ^ U64(k << 52))
        return out


def _band_names() -> list[str]:
    return [f"band{i}" for i in range(BANDS)]


def signatures(docs: DataFrame, text: str, keep: list[str], idf) -> DataFrame:
    """Columns ``keep`` and one hash per band, all null where the text has no word."""
    fields = T.StructType(
        [T.StructField("worded", T.BooleanType())]
        + [T.StructField(x, T.LongType()) for x in _band_names()]
    )

    def worker():
        weigh, sampler = idf.value, Sampler()

        def work(block: Block) -> list[np.ndarray]:
            codes, counts, first = shingles(block)
            worded = np.diff(first) > 0
            found = np.zeros((block.rows, BANDS), np.int64)
            if worded.any():
                bounds = np.append(first[:-1][worded], first[-1])
                drawn = sampler.samples(codes, counts * weigh[_bin(codes)], bounds, BANDS * ROWS)
                for i in range(BANDS):
                    code = np.full(len(drawn), i + 1, U64)
                    for j in range(ROWS):
                        code = mix(code ^ drawn[:, i * ROWS + j]) * U64(0xD6E8FEB86659FD93)
                    found[worded, i] = code.view(np.int64)
            return [worded, *found.T]

        return work

    return map_texts(docs, text, keep, fields, worker)


def _sets(texts: list[str], weigh: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    out = []
    for block in blocks(pa.array(texts, pa.large_string())):
        codes, counts, first = shingles(block)
        weights = counts * weigh[_bin(codes)].astype(np.float64)
        out += [(codes[a:b], weights[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
    return out


def _linked(
    nodes: list[bytes], texts: list[str], roots: list[bytes], weigh: np.ndarray
) -> list[tuple[bytes, bytes]]:
    """A star per class of texts of weighted Jaccard similarity ``SIMILARITY`` or more
    (sum of the smaller weights over the sum of the larger ones), without what ``roots``
    has connected before."""
    order = sorted(range(len(nodes)), key=nodes.__getitem__)
    sets = _sets([texts[i] for i in order], weigh)
    if len(sets) < 2:
        return []
    sums = np.array([w.sum() for _, w in sets])
    first = np.cumsum([0, *(len(c) for c, _ in sets)])
    owner = np.repeat(np.arange(len(sets)), np.diff(first))
    weights = np.concatenate([w for _, w in sets])
    known, place = np.unique(np.concatenate([c for c, _ in sets]), return_inverse=True)
    heads: dict[bytes, int] = {}
    label = np.array([heads.setdefault(roots[x], i) for i, x in enumerate(order)])
    own = np.zeros(len(known))
    for i in range(len(sets) - 1):  # one text against all later ones at once
        later = np.arange(len(sets)) > i
        fits = np.minimum(sums, sums[i]) >= SIMILARITY * np.maximum(sums, sums[i])
        if not (later & fits & (label != label[i])).any():
            continue
        mine, rest = slice(first[i], first[i + 1]), slice(first[i + 1], None)
        own[place[mine]] = weights[mine]
        low = np.bincount(owner[rest], np.minimum(own[place[rest]], weights[rest]), len(sets))
        own[place[mine]] = 0
        alike = later & (low > 0) & (low >= SIMILARITY * (sums + sums[i] - low))
        if alike.any():
            same = np.unique(label[alike | (np.arange(len(sets)) == i)])
            label[np.isin(label, same)] = same[0]
    return [(nodes[order[i]], nodes[order[label[i]]]) for i in heads.values() if label[i] != i]


def _links(chunks: DataFrame, idf) -> DataFrame:
    """Rows (bucket, chunk, node, root, text), a chunk's rows one after another, to links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weigh = idf.value
        now, nodes, texts, roots, found = None, [], [], [], []
        for batch in batches:
            buckets, parts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, key in enumerate(zip(buckets, parts, strict=True)):
                if key != now:
                    found += _linked(nodes, texts, roots, weigh)
                    now, nodes, texts, roots = key, [], [], []
                nodes.append(batch.column(2)[i].as_py())
                roots.append(batch.column(3)[i].as_py())
                texts.append(batch.column(4)[i].as_py())
            if found:
                yield _pairs(found)
                found = []
        found += _linked(nodes, texts, roots, weigh)
        if found:
            yield _pairs(found)

    return chunks.mapInArrow(run, "a binary, b binary")


def _pairs(found: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    a, b = zip(*found, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])


def _chunks(nodes: DataFrame, bands: list[str]) -> DataFrame:
    """(bucket, chunk, node, root) of all buckets that hold nodes of more than one class."""
    rows = nodes.select("node", "root", F.explode(F.array(*bands)).alias("bucket"))
    shared = (
        rows.groupBy("bucket")
        .agg(
            F.count("*").alias("n"),
            F.min(F.struct("node", "root")).alias("low"),
            F.max(F.struct("node", "root")).alias("high"),
            F.sum(F.xxhash64("node") / F.lit(1 << 20)).cast("long").alias("sum"),
            F.min("root").alias("root0"),
            F.max("root").alias("root1"),
        )
        .filter("root0 <> root1")
        .groupBy("n", "low", "high", "sum")  # several bands often hold the same nodes
        .agg(F.min("bucket").alias("bucket"))
        .withColumn("chunks", F.ceil(F.col("n") / CHUNK).cast("long"))
    )
    own = rows.join(shared.select("bucket", "chunks"), "bucket").select(
        "bucket", F.pmod(F.xxhash64("node", "bucket"), "chunks").alias("chunk"), "node", "root"
    )
    pivots = shared.filter("chunks > 1").select(
        "bucket",
        F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
        F.array("low", "high").alias("ends"),
    )
    pivots = pivots.select("bucket", "chunk", F.inline("ends"))
    return own.unionByName(pivots).distinct()


def _prefixes(rows: DataFrame, idf, seen) -> DataFrame:
    """(token, node, root, band, most): the shingles of (node, root, text) that a similar
    text must share, the band of the text's weight, and how many bands above it a text
    may weigh whose first shared shingle this is.

    Let t be the first shared shingle, in the order of all, of two texts with weights W and
    V of similarity s or more. What they share lies at t and after it, and it is at least
    s / (1 + s) * (W + V). So what lies before t is at most W - s / (1 + s) * (W + V).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, roots = batch.column(0), batch.column(1)
            for block in blocks(batch.column(2)):
                codes, counts, first = shingles(block)
                weights = counts * idf.value[_bin(codes)].astype(np.float64)
                owner = np.repeat(np.arange(block.rows), np.diff(first))
                order = np.lexsort((codes, seen.value[_bin(codes)], owner))
                sums = np.concatenate([[0.0], np.cumsum(weights[order])])
                total = sums[first[1:]] - sums[first[:-1]]
                after = 1 - (sums[:-1] - sums[first[owner]]) / total[owner] + 1e-6
                at = np.flatnonzero(after >= SIMILARITY)
                row = owner[at]
                ratio = after[at] * (1 + SIMILARITY) / SIMILARITY - 1  # of V to W, at most
                most = np.minimum(np.floor(np.log(ratio) / BAND_STEP).astype(np.int32) + 1, NEAR_BANDS)
                band = np.floor(np.log(total[row]) / BAND_STEP).astype(np.int32)
                own = pa.array(block.row + row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(codes[order[at]].view(np.int64)), nodes.take(own), roots.take(own),
                     pa.array(band), pa.array(most)],
                    ["token", "node", "root", "band", "most"],
                )

    return rows.mapInArrow(run, "token long, node binary, root binary, band int, most int")


def _units(tokens: DataFrame) -> DataFrame:
    """(bucket, chunk, node, root): whom to compare in the groups that share a token.

    A group is split by pairs of weight bands. Such a group is cut into chunks, and its
    nodes outside the largest class into parts; every part meets every chunk, so that any
    two nodes of different classes meet.
    """
    bands = tokens.groupBy("token").agg(
        F.min("root").alias("root0"), F.max("root").alias("root1"), F.collect_set("band").alias("bands")
    )
    bands = rewritten(bands.filter("root0 <> root1").select("token", "bands"), "bands")
    other = F.filter(
        F.transform(F.sequence(F.lit(-NEAR_BANDS), F.col("most")), lambda x: F.col("band") + x),
        lambda x: F.array_contains("bands", x),
    )
    tokens = tokens.join(bands, "token").select("token", "node", "root", "band", F.explode(other).alias("other"))
    pair = F.xxhash64("token", F.least("band", "other"), F.greatest("band", "other"))
    tokens = rewritten(tokens.select(pair.alias("token"), "node", "root"), "pairs")
    one = tokens.groupBy("token", "root").agg(
        F.count("*").alias("n"),
        F.min("node").alias("low"),
        F.max("node").alias("high"),
        F.bit_xor(F.xxhash64("node")).alias("code"),
    )
    groups = (
        one.groupBy("token")
        .agg(
            F.count("*").alias("classes"),
            F.sum("n").alias("n"),
            F.max(F.struct("n", "root")).alias("main"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
            F.bit_xor("code").alias("code"),
        )
        .filter("classes > 1")
        .groupBy("n", "main", "low", "high", "code")  # many tokens have the same nodes
        .agg(F.min("token").alias("token"))
        .select(
            "token",
            F.col("main.root").alias("main"),
            F.ceil(F.col("n") / CHUNK).cast("long").alias("chunks"),
            F.ceil((F.col("n") - F.col("main.n")) / CHUNK).cast("long").alias("parts"),
        )
    )
    rows = tokens.join(rewritten(groups, "groups"), "token")
    spot = F.xxhash64("node", "token")
    chunk, part = F.pmod(spot, "chunks"), F.pmod(F.shiftrightunsigned(spot, 20), "parts")
    wide = F.col("parts")
    whole = F.transform(F.sequence(F.lit(0), wide - 1), lambda p: chunk * wide + p)
    other = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda c: c * wide + part)
    every = F.when(F.col("root") == F.col("main"), whole).otherwise(F.array_union(whole, other))
    return rows.select(F.col("token").alias("bucket"), F.explode(every).alias("chunk"), "node", "root")


def _kept_apart(texts: DataFrame, roots: DataFrame, named: DataFrame, idf) -> DataFrame:
    """Links between the classes of buckets that are larger than a chunk."""
    names = _band_names()
    nodes = texts.filter(F.col(names[0]).isNotNull()).select("node", *names)
    nodes = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rows = nodes.select("node", "root", F.explode(F.array(*names)).alias("bucket"))
    large = rows.groupBy("bucket").agg(
        F.count("*").alias("n"), F.min("root").alias("root0"), F.max("root").alias("root1")
    )
    large = rewritten(large.filter((F.col("n") > CHUNK) & (F.col("root0") != F.col("root1"))).select("bucket"), "large")
    left = rewritten(rows.join(large, "bucket").select("node", "root").distinct(), "left")
    bodies = left.join(_bodies(left, texts, named), "node").select("node", "root", "text")
    bodies = rewritten(bodies, "bodies")
    seen = bodies.sparkSession.sparkContext.broadcast(bin_counts(bodies, "text")[0])
    tokens = rewritten(_prefixes(bodies, idf, seen), "prefixes")
    units = rewritten(_units(tokens), "units")
    return rewritten(_links(_grouped(units, bodies.select("node", "text")), idf), "links")


_ID, _NODE, _BODY = "__id", "__node", "__body"


def _node(text: str) -> Column:
    """Half of the text's SHA-256: equal texts are one node, null has none."""
    return F.unhex(F.substring(F.sha2(F.col(f"`{text}`"), 256), 1, 32))


def _classes(docs: DataFrame, keep: list[str], doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Rows (keep, id, node) of all documents, and the class of every node:
    (node, class_id, class_rows, keeper), the keeper being the class's smallest (id, node)."""
    spark = docs.sparkSession
    ship(spark)
    named = docs.select(
        *[F.col(f"`{c}`") for c in keep],
        F.col(f"`{doc_id}`").alias(_ID),
        _node(text).alias(_NODE),
        F.col(f"`{text}`").alias(_BODY),
    )
    idf = spark.sparkContext.broadcast(idf_table(named, _BODY))
    signed = rewritten(signatures(named, _BODY, [*keep, _ID, _NODE], idf), "signatures")
    texts = signed.filter(F.col(_NODE).isNotNull()).groupBy(F.col(_NODE).alias("node"))
    names = _band_names()
    texts = rewritten(
        texts.agg(
            F.min(_ID).alias("first_id"),
            F.count("*").alias("copies"),
            *[F.min(F.when(F.col("worded"), F.col(x))).alias(x) for x in names],
        ),
        "texts",
    )
    roots = links = None
    for bands in (names[:FIRST_BANDS], names[FIRST_BANDS:]):
        nodes = texts.filter(F.col(names[0]).isNotNull()).select("node", *bands)
        if roots is None:
            nodes = nodes.withColumn("root", F.col("node"))
        else:
            nodes = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        chunks = rewritten(_chunks(nodes, bands), "chunks")
        found = rewritten(_links(_grouped(chunks, _bodies(chunks, texts, named)), idf), "links")
        links = found if links is None else links.unionByName(found)
        roots = components(links)
    found = _kept_apart(texts, roots, named, idf)
    if found.head(1):
        joined = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
        roots = components(joined.unionByName(found))
    known = texts.select("node", "first_id", "copies").join(roots, "node", "left")
    known = known.withColumn("root", F.coalesce("root", "node"))
    classes = known.groupBy("root").agg(
        F.min("first_id").alias("class_id"),
        F.sum("copies").alias("class_rows"),
        F.min(F.struct("first_id", "node")).alias("keeper"),
    )
    members = known.join(classes, "root").select("node", "class_id", "class_rows", "keeper")
    return signed.select(*keep, _ID, _NODE), members


def near_duplicate_classes(
    docs: DataFrame, keep: list[str], doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Columns ``keep``, ``class_id`` and ``class_rows`` for every row of ``docs``."""
    keep = [c for c in keep if c not in ("class_id", "class_rows")]
    rows, members = _classes(docs, keep, doc_id, text)
    own = F.when(F.col(_NODE).isNull(), F.col(_ID)).otherwise(F.col("class_id"))
    return rows.join(members.withColumnRenamed("node", _NODE), _NODE, "left").select(
        *keep, own.alias("class_id"), F.coalesce("class_rows", F.lit(1)).cast("long").alias("class_rows")
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class, its smallest id, with all columns of ``docs``.

    Only what changes is joined to the documents: rows that go, and keepers that are
    there more than once; the latter leave their first row in the order of all columns.
    """
    rows, members = _classes(docs, [], doc_id, text)
    rows = rows.filter(F.col(_NODE).isNotNull()).groupBy(_ID, _NODE).agg(F.count("*").alias("n"))
    stays = F.col(_ID).eqNullSafe(F.col("keeper.first_id")) & (F.col(_NODE) == F.col("keeper.node"))
    changed = rows.join(members, F.col(_NODE) == F.col("node")).withColumn("__stays", stays)
    changed = rewritten(
        changed.filter("NOT __stays OR n > 1").select(
            F.col(_ID).alias("__other"), F.col(_NODE).alias("__text"), "__stays"
        ),
        "changed",
    )
    small = changed.count() <= BROADCAST_ROWS
    same = F.col(f"`{doc_id}`").eqNullSafe(F.col("__other")) & (_node(text) == F.col("__text"))
    joined = docs.join(F.broadcast(changed) if small else changed, same, "left")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    out = joined.filter("__stays IS NULL").select(*columns)
    if changed.filter("__stays").head(1):
        order = Window.partitionBy("__other", "__text").orderBy(*[F.hash(c) for c in columns])
        twice = joined.filter("__stays").withColumn("__rank", F.row_number().over(order))
        out = out.unionByName(twice.filter("__rank = 1").select(*columns))
    return out


def _bodies(nodes: DataFrame, texts: DataFrame, named: DataFrame) -> DataFrame:
    """(node, text) of the nodes of ``nodes``, once each."""
    wanted = rewritten(
        texts.join(nodes.select("node").distinct(), "node", "left_semi").select(
            "node", F.col("first_id").alias("__id")
        ),
        "wanted",
    )
    rows = named.select("__id", F.col("__node").alias("own"), F.col("__body").alias("text"))
    small = wanted.count() <= BROADCAST_ROWS
    rows = rows.join(F.broadcast(wanted) if small else wanted, rows["__id"].eqNullSafe(wanted["__id"]))
    rows = rows.filter(F.col("own") == F.col("node")).select("node", "text")
    return rows.groupBy("node").agg(F.min("text").alias("text"))  # repeated rows


def _grouped(chunks: DataFrame, bodies: DataFrame) -> DataFrame:
    """Chunk rows with their texts, each chunk's rows together in one partition."""
    return (
        chunks.join(bodies, "node")
        .select("bucket", "chunk", "node", "root", "text")
        .repartition("bucket", "chunk")
        .sortWithinPartitions("bucket", "chunk")
    )
