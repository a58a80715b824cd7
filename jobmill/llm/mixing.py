"""Mix sources to target weights by entropy balancing.

Every document gets a rate, the number of copies it should have. Among all rates whose
words meet the target of each source, and that are at most ``MOST_COPIES``, those are
wanted that stay closest to 1 in relative entropy, a document counting by a power of its
size. The convex dual has one variable per source, and its solution is

    rate = min(MOST_COPIES, exp(multiplier * (size / mean size of the source) ** TILT))

``TILT`` 0 would give all documents of a source one rate, 1 is the balance of documents
regardless of size; the default tilts mildly towards short texts where a source is cut
and towards long ones where it is repeated. The multipliers come from Newton steps, kept
inside a bracket, over sums per source. The sums run over the number of documents per
(source, size), which grows with the distinct sizes and not with the documents.

Rates become copies by a threshold from the document's hash. ``OFFSETS`` shifts of the
threshold are summed up in one pass and each source takes the one whose words come
nearest to its target.

Defined cases: a null text has size 0, a null source is a source of its own that sorts
last; a source without words has target 0; documents of size 0 are copied once, which
takes no words; repeated rows are decided alike; a tie of offsets goes to the smaller.
An empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import global_rank
from .store import rewritten

WEIGHTS = (5.0, 2.0, 1.0)
VOLUME = 1.5
MOST_COPIES = 2
TILT = 0.25
OFFSETS = 64
STEPS = 60
TOLERANCE = 1e-9

WORDS = r"[^\x20\x09-\x0D]+"


def text_words(text: str) -> Column:
    """The number of words between white space; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORDS)), F.lit(0)).cast("long")


def targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, volume: float = VOLUME
) -> DataFrame:
    """(source, source_size, target) from rows (source, source_size), one per source.

    ``volume`` times all words are shared out by weight, the weights repeating in the
    order of the sources; what exceeds ``MOST_COPIES`` times a source's size is shared
    out again among the others. Only the sums of a round reach the driver.
    """
    order = [F.col("source").asc_nulls_last()]
    ranked = global_rank(sizes, order, "rank")
    choice = F.element_at(F.array(*map(F.lit, weights)), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    state = rewritten(
        ranked.select(
            "source", "source_size", choice.alias("weight"),
            (F.col("source_size") * float(MOST_COPIES)).alias("most"),
        ),
        "weights",
    )
    total = volume * (state.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0  # words per weight; a source is full once its most is below its share
    while True:
        full = F.col("most") < F.col("weight") * F.lit(level)
        row = state.agg(
            F.sum(F.when(full, F.col("most")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))
        ).first()
        taken, rest = row[0] or 0.0, row[1] or 0.0
        raised = (total - taken) / rest if rest else level
        if raised <= level:
            break
        level = raised
    share = F.least(F.col("most"), F.col("weight") * F.lit(level))
    return state.select("source", "source_size", share.alias("target"))


def _rate() -> Column:
    return F.least(F.lit(float(MOST_COPIES)), F.exp(F.least(F.col("multiplier") * F.col("z"), F.lit(50.0))))


def multipliers(histogram: DataFrame, wanted: DataFrame, tilt: float = TILT) -> DataFrame:
    """(source, multiplier, mean) that solve the dual, from rows (source, size, documents)."""
    means = histogram.groupBy("source").agg(
        (F.sum(F.col("size") * F.col("documents")) / F.sum("documents")).alias("mean")
    )
    counted = histogram.filter("size > 0")
    bound = F.col("target") >= F.col("source_size") * (MOST_COPIES * (1 - TOLERANCE))
    ratio = F.when(F.col("target") > 0, F.col("target") / F.col("source_size"))
    state = wanted.join(means, wanted["source"].eqNullSafe(means["source"])).select(
        wanted["source"], "source_size", "target", "mean",
        # A source at its bound has every document at the most copies; others start at
        # the flat rate.
        F.when(bound, 700.0).otherwise(F.coalesce(F.log(ratio), F.lit(0.0))).alias("multiplier"),
        F.when(bound, 700.0).otherwise(-700.0).alias("low"), F.lit(700.0).alias("high"),
    )
    state = rewritten(state, "dual")
    small = state.count() <= BROADCAST_SOURCES
    for _ in range(STEPS):
        rows = counted.join(
            F.broadcast(state) if small else state, counted["source"].eqNullSafe(state["source"])
        )
        rows = rows.select(
            state["source"], "size", "documents", "multiplier",
            F.pow(F.col("size") / F.col("mean"), F.lit(tilt)).alias("z"),
        )
        words = F.col("size") * F.col("documents") * _rate()
        free = _rate() < MOST_COPIES
        sums = rows.groupBy("source").agg(
            F.sum(words).alias("words"), F.sum(F.when(free, words * F.col("z")).otherwise(0.0)).alias("slope")
        )
        error = F.coalesce("words", F.lit(0.0)) - F.col("target")
        newton = F.col("multiplier") - error / F.col("slope")
        low = F.when(error < 0, F.col("multiplier")).otherwise(F.col("low"))
        high = F.when(error < 0, F.col("high")).otherwise(F.col("multiplier"))
        near = F.abs(error) <= TOLERANCE * F.greatest(F.col("target"), F.lit(1.0))
        inside = (F.col("slope") > 0) & (newton > low) & (newton < high)
        step = F.when(near, F.col("multiplier")).when(inside, newton).otherwise((low + high) / 2)
        joined = state.join(sums.withColumnRenamed("source", "own"), F.col("source").eqNullSafe(F.col("own")), "left")
        state = rewritten(
            joined.select(
                "source", "source_size", "target", "mean",
                step.alias("multiplier"), low.alias("low"), high.alias("high"), near.alias("done"),
            ),
            "dual",
        )
        if not state.filter("not done and high - low > 1e-12").head(1):
            break
    return state.select("source", "source_size", "target", "mean", "multiplier")


def fit(
    sizes: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    volume: float = VOLUME,
    tilt: float = TILT,
) -> DataFrame:
    """One row per source of ``sizes`` (source, size, draw): target, multiplier and offset."""
    histogram = rewritten(
        sizes.groupBy("source", "size").agg(F.count("*").alias("documents")), "histogram"
    )
    words = F.sum(F.col("size") * F.col("documents"))
    per_source = histogram.groupBy("source").agg(words.alias("source_size"))
    solved = rewritten(multipliers(histogram, targets(per_source, weights, volume), tilt), "solved")
    rated = _joined(sizes.select("source", "size", "draw"), solved.withColumn("offset", F.lit(0.0)))
    tried = [_copies("size", "draw", F.lit(i / OFFSETS), tilt) for i in range(OFFSETS)]
    tries = rated.groupBy(KNOWN).agg(
        F.first(f"{KNOWN}.target").alias("target"),
        *[F.sum(F.col("size") * x).alias(f"words{i}") for i, x in enumerate(tried)],
    )
    ranked = F.array_min(
        F.array(
            *[
                F.struct(F.abs(F.col(f"words{i}") - F.col("target")).alias("off"), F.lit(i / OFFSETS).alias("offset"))
                for i in range(OFFSETS)
            ]
        )
    )
    columns = [f"{KNOWN}.{c}" for c in ("source", "source_size", "target", "mean", "multiplier")]
    return rewritten(tries.select(*columns, ranked["offset"].alias("offset")), "fitted")


KNOWN = "__known"
BROADCAST_SOURCES = 100_000


def _joined(rows: DataFrame, fitted: DataFrame, source: str = "source") -> DataFrame:
    """Rows with what is known of their source as a struct ``KNOWN``."""
    known = fitted.select(F.struct(*fitted.columns).alias(KNOWN))
    known = F.broadcast(known) if fitted.count() <= BROADCAST_SOURCES else known
    return rows.join(known, rows[source].eqNullSafe(F.col(f"{KNOWN}.source")))


def _copies(size: str, draw: str, offset: Column, tilt: float) -> Column:
    """The rate of a document, rounded up if its draw falls below the fraction."""
    z = F.pow(F.col(size) / F.col(f"{KNOWN}.mean"), F.lit(tilt))
    power = F.least(F.col(f"{KNOWN}.multiplier") * z, F.lit(50.0))
    rate = F.least(F.lit(float(MOST_COPIES)), F.exp(power))
    rate = F.when(F.col(size) > 0, rate).otherwise(F.lit(1.0))
    at = F.pmod(F.col(draw), F.lit(1 << 40)) / float(1 << 40) + offset
    return (F.floor(rate) + (at - F.floor(at) < rate - F.floor(rate)).cast("long")).cast("long")


def copies(
    rows: DataFrame,
    fitted: DataFrame,
    source: str = "source",
    size: str = "size",
    draw: str = "draw",
    tilt: float = TILT,
) -> DataFrame:
    """``rows`` with ``__copies``, ``__source_size`` and ``__target``; equal rows alike."""
    joined = _joined(rows, fitted, source)
    return joined.withColumns(
        {
            "__copies": _copies(size, draw, F.col(f"{KNOWN}.offset"), tilt),
            "__source_size": F.col(f"{KNOWN}.source_size"),
            "__target": F.col(f"{KNOWN}.target"),
        }
    ).drop(KNOWN)


def draw(doc_id: str, text: str) -> Column:
    """The hash that rounds a document's rate."""
    return F.xxhash64(F.lit("mix"), F.col(doc_id), F.col(text))
