"""Mixing sources to target weights by a low-discrepancy source schedule.

Slot ``k`` of the schedule gets the van der Corput point of ``k``; the point
falls in one source's interval of the cumulative targets, which makes every
prefix of the schedule follow the target shares within a few slots.  Slots are
ranked within their source and the slot of rank ``r`` takes block ``r`` of that
source: blocks are runs of ``block_words`` words in the source's shuffled order,
which starts again when a source is used up.  What a source gives is what its
slots take, nothing is refilled or trimmed to the target: with ``n`` slots a
source is within ``log2(n) / 2 + 1`` blocks of its target on either side (the
discrepancy bound of an interval).  Only blocks past ``most`` times a source's
words do not exist.

Native.  Orders are never taken over a whole source in one task: prefix sums go
through 4096 hash buckets a source, sources are ranked through range partitions,
and the rank of a slot is a closed formula over the binary digits of its
source's interval, without any exchange.

Nulls: a null text has size 0, a null source is a source of its own (last),
null ids are kept.  Texts without words take nothing.  Repeated rows are placed
one by one; rows that tie in order are alike in id and size.  A very long text
spans many blocks.  An empty table gives an empty result; if nothing has words,
all targets are 0.  Other columns play no part; ``resampled`` carries them, and
names that start with ``__ff_`` are taken.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import KEYS, in_order, materialize, offsets, row_key, settled

WORD = r"[^\x20\x09-\x0D]+"
BUCKET_BITS = 12
POINT_BITS = 48
BROADCAST_ROWS = 1_000_000


def _mirrored(x: Column, bits: int = POINT_BITS) -> Column:
    return F.conv(F.reverse(F.lpad(F.bin(x), bits, "0")), 2, 10).cast("long")


def point(k: Column) -> Column:
    """The van der Corput point of ``k`` in base 2, its bits mirrored, as a
    whole number below ``2**POINT_BITS``."""
    return _mirrored(k)


def digits(bound: Column) -> Column:
    """The dyadic intervals that make up [0, ``bound``), each as the step and the
    first slot of the points in it."""
    high = F.transform(F.sequence(F.lit(0), F.lit(POINT_BITS)), lambda i: F.struct(i.alias("i"), F.call_function("shiftright", bound, F.lit(POINT_BITS) - i).alias("x")))
    on = F.filter(high, lambda d: d["x"].bitwiseAND(F.lit(1).cast("long")) == 1)
    return F.transform(on, lambda d: F.struct(d["i"].alias("i"), F.call_function("shiftright", _mirrored(d["x"] - 1), F.lit(POINT_BITS) - d["i"]).alias("r")))


def points_below(k: Column, parts: Column) -> Column:
    """How many of the slots 0 to ``k`` - 1 have their point in the interval of ``digits``."""
    one = F.lit(1).cast("long")
    count = lambda d: F.call_function("shiftright", k + F.call_function("shiftleft", one, d["i"]) - 1 - d["r"], d["i"])
    return F.aggregate(parts, F.lit(0).cast("long"), lambda n, d: n + count(d))


def _level(limits: DataFrame, total: float) -> float:
    """The words per weight that share out ``total`` with no source above its
    limit: each step takes out the sources that are full at the last level."""
    level = 0.0
    while True:
        full = F.col("ratio") < level
        row = limits.agg(F.sum(F.when(full, F.col("limit")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        now = (total - row[0]) / row[1] if row[1] else float("inf")
        if now <= level:
            return level
        level = now


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: int) -> DataFrame:
    """Targets per source (``empty`` marks the null one): all sources share
    ``share`` of all words by weight, none more than ``most`` times its own.
    ``lo`` and ``hi`` are the bounds of its interval among the points."""
    total = sizes.agg(F.sum("source_size")).first()[0] or 0
    wanted = min(float(share), float(most)) * total
    named = in_order(sizes, ["empty", "name"], "sources")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranks = offsets(named, n0=F.lit(1))
    place = F.row_number().over(Window.partitionBy("__ff_p").orderBy("__ff_at"))
    limits = named.join(F.broadcast(ranks.select("__ff_p", "n0")), "__ff_p").withColumn("sid", (F.col("n0") + place).cast("long"))
    limits = limits.withColumn("weight", F.element_at(cycle, ((F.col("sid") - 1) % len(weights) + 1).cast("int"))).withColumn("limit", F.col("source_size") * float(most))
    limits = materialize(limits.withColumn("ratio", F.col("limit") / F.col("weight")).drop("n0"), "limits")
    level = _level(limits, wanted) if total else 0.0
    targets = limits.withColumn("target", F.least("limit", F.lit(level) * F.col("weight")))
    upto = F.sum("target").over(Window.partitionBy("__ff_p").orderBy("__ff_at")) + F.col("t0")
    bound = F.round(upto / F.lit(wanted or 1.0) * float(1 << POINT_BITS)).cast("long")
    sums = offsets(targets, t0=F.col("target"), n=F.lit(1)).select("__ff_p", "t0", "n_all")
    # the last source ends where the points end, whatever the sums have rounded
    out = targets.join(F.broadcast(sums), "__ff_p").withColumn("hi", F.when(F.col("sid") == F.col("n_all"), F.lit(1 << POINT_BITS)).otherwise(bound))
    first = F.lag("hi").over(Window.partitionBy("__ff_p").orderBy("__ff_at"))
    before = F.round(F.col("t0") / F.lit(wanted or 1.0) * float(1 << POINT_BITS)).cast("long")
    return out.withColumn("lo", F.coalesce(first, before)).select("empty", "name", "sid", "source_size", "target", "lo", "hi")


@dataclass
class Mixture:
    """``placed``: a row for each document with its place in its source;
    ``slots``: the schedule (slot, sid, block); ``n_slots`` of it."""

    placed: DataFrame
    slots: DataFrame
    n_slots: int
    block_words: int
    most: int

    def runs(self) -> DataFrame:
        """Each document at its place ``a`` in each pass over its source."""
        passes = self.placed.where("size > 0").withColumn("pass", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(self.most - 1).cast("long"))))
        return passes.withColumn("a", F.col("pass") * F.col("source_size") + F.col("start"))

    def taken(self) -> DataFrame:
        """Words of each placed document that the scheduled blocks hold."""
        size = F.lit(self.block_words).cast("long")
        runs = self.runs().select("sid", "start", "a", (F.col("a") + F.col("size")).alias("b"))
        spans = runs.withColumn("block", F.explode(F.sequence(F.floor(F.col("a") / size), F.floor((F.col("b") - 1) / size)))).select(
            "sid", "block", "start", (F.least("b", (F.col("block") + 1) * size) - F.greatest("a", F.col("block") * size)).alias("words")
        )
        used = spans.join(self.slots.select("sid", "block"), ["sid", "block"])
        sums = used.groupBy("sid", F.col("start").alias("__ff_start")).agg(F.sum("words").alias("taken"))
        key = self.placed.withColumn("__ff_start", F.when(F.col("size") > 0, F.col("start")))
        return key.join(sums, ["sid", "__ff_start"], "left").withColumn("taken", F.coalesce("taken", F.lit(0).cast("long"))).drop("__ff_start")


def mixture(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2, block_words: int = 64, seed: str = "mix") -> Mixture:
    # null ids are dealt by their texts, so that they do not share one place
    own = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null"), F.md5(F.coalesce("text", F.lit("")).cast("binary"))))
    order = F.conv(F.substring(F.md5(F.concat(own, F.lit(":" + seed)).cast("binary")), 1, 15), 16, 10).cast("long")
    sized = docs.select(
        "doc_id",
        F.coalesce("source", F.lit("")).alias("name"),
        F.col("source").isNull().alias("empty"),
        *row_key(docs),
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("size"),
        order.alias("at"),
    ).withColumn("bucket", F.shiftright("at", 60 - BUCKET_BITS))
    sized = materialize(sized, "sized")

    buckets = sized.groupBy("empty", "name", "bucket").agg(F.sum("size").alias("words"))
    sources = settled(lambda: source_targets(buckets.groupBy("empty", "name").agg(F.sum("words").alias("source_size")), weights, share, most), "targets")
    earlier = Window.partitionBy("empty", "name").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.select("empty", "name", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("before")).join(sources, ["empty", "name"])
    inside = Window.partitionBy("empty", "name", "bucket").orderBy("at", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        sized.join(buckets, ["empty", "name", "bucket"])
        .withColumn("start", F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .select("doc_id", *KEYS, "size", "sid", "source_size", "target", "start")
    )
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    n_slots = -int(-(min(float(share), float(most)) * total) // block_words)
    return Mixture(materialize(placed, "placed"), schedule(sources, n_slots), n_slots, block_words, most)


def schedule(sources: DataFrame, n_slots: int) -> DataFrame:
    """One row for each slot: slot, sid and the block it takes, its rank among
    the slots of its source."""
    reached = lambda bound: F.filter(digits(F.col(bound)), lambda d: d["r"] < n_slots)
    # intervals whose first slot lies beyond the schedule count for none of its slots
    bounds = sources.where("hi > lo").select("sid", "lo", "hi", reached("lo").alias("below_lo"), reached("hi").alias("below_hi"))
    cell_bits = max(6, (4 * sources.count()).bit_length())
    cell = lambda x: F.shiftright(x, POINT_BITS - cell_bits)
    # a source is listed in each cell of the unit interval that its own interval meets: points find it by equality
    cut = bounds.withColumn("cell", F.explode(F.sequence(cell(F.col("lo")), cell(F.col("hi") - 1))))
    cut = F.broadcast(cut) if cut.count() <= BROADCAST_ROWS else cut
    tasks = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    points = sources.sparkSession.range(0, n_slots, 1, tasks).select(F.col("id").alias("slot"), point(F.col("id")).alias("v"))
    hit = points.withColumn("cell", cell(F.col("v"))).join(cut, "cell").where("v >= lo and v < hi")
    return hit.select("slot", "sid", (points_below(F.col("slot"), F.col("below_hi")) - points_below(F.col("slot"), F.col("below_lo"))).alias("block"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target and the words taken, per document."""
    return mixture(docs, **options).taken().select("doc_id", "size", "source_size", "target", "taken")


def resampled(docs: DataFrame, **options) -> DataFrame:
    """The documents as the schedule takes them, in the order of its slots: once
    for each slot whose block has their middle word; all columns as they are.
    Texts without words are in no mix."""

    def copies() -> DataFrame:
        m = mixture(docs, **options)
        middle = m.runs().select(*KEYS, F.floor((F.col("a") + F.floor(F.col("size") / 2)) / m.block_words).alias("block"), "sid")
        n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        run = F.floor(F.col("slot") * n / max(1, m.n_slots)).cast("int")
        return middle.join(m.slots, ["sid", "block"]).select(*KEYS, F.col("slot").alias("__ff_slot"), run.alias("__ff_run"))

    found = settled(copies, "copies")
    once = docs.select("*", *row_key(docs)).dropDuplicates(KEYS)
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # files follow the schedule: run i of its slots is partition i
    return once.join(found, KEYS).repartitionById(n, "__ff_run").sortWithinPartitions("__ff_slot", *KEYS).select(*docs.columns)
