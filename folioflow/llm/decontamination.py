"""Benchmark decontamination: SimHash of item-sized windows.

A window has as many words as a benchmark item.  Windows are placed wherever a
document has a five-word shingle of some item, in line with that shingle's place
in the item; a window without any such shingle has similarity 0 with every item,
so none is lost.  Every window and item gets a 64-bit SimHash of its weighted
shingles, and a pair is a candidate if they differ in at most ``RADIUS`` bits.
Multi-index blocks find all of these: a fingerprint is cut into ``WIDTHS`` blocks,
and with at most ``RADIUS`` differing bits some block has at most ``2 * FLIPS`` of
them, so that it agrees after up to ``FLIPS`` flips on either side.  Each pair meets
once per such block (the window flips the lower half of the differing bits); chance
lets 0.9 % of unrelated pairs meet, and the radius 5 in a million.  For up to
``FEW_ITEMS`` items, blocks are narrower and one flip on either side finds all: more
pairs meet by chance (6.4 %), but a window or item has 69 rows in place of 718, and
the table of flipped items, which the driver builds, is as much smaller.  Candidates are
verified exactly: a shingle weighs what it occurs, and the sum of minima over the
sum of maxima must reach the threshold.  (Weights by rarity among the items would
let the odd words of one item outvote the many that its variants share.)

At a similarity of exactly 0.8 two fingerprints differ in 14 bits or fewer with a
probability of about 0.95, and sooner above; ``tests/llm`` measure the recall.

Native.  The text is scanned once for shingles of items (their table is broadcast
while its counted size is small, else exchanged) and read again only for the
documents that have windows.

Words are compared in lower case.  An item of fewer than five words is one shingle.
Nulls: null or empty texts and items match nothing; a null doc_id or item_id is
kept.  Repeated rows (same id and text) give one result; windows that tie in
similarity give the first.  A very long text is read whole.  Empty tables give an
empty result.  Other columns play no part; names that start with ``__ff_`` are taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import materialize, settled

SHINGLE = 5
RADIUS = 14
WIDTHS = (22, 21, 21)
FLIPS = 2
#: The same for few items: beyond about 12,000 what meets by chance would cost more than the flips that are saved.
FEW_ITEMS = 10_000
FEW_WIDTHS = (13, 13, 13, 13, 12)
FEW_FLIPS = 1
VALUE_BITS = max(WIDTHS)
BLOCK_BITS = 3
BROADCAST_ROWS = 1_000_000
#: Of flipped items, about 20 MB.
BROADCAST_FLIPPED = 150_000


def _word_hashes(text: Column) -> Column:
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _grams(hashes: Column, size: int) -> Column:
    """Hashes of all runs of ``size`` words."""
    starts = F.when(F.size(hashes) >= size, F.sequence(F.lit(0), F.size(hashes) - size)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(F.lit(size), *[F.get(hashes, i + k) for k in range(size)]))


def _placed_grams(hashes: Column, size: int) -> Column:
    return F.transform(_grams(hashes, size), lambda h, i: F.struct(F.lit(size).alias("k"), i.alias("at"), h.alias("h")))


def _prepared_items(items: DataFrame) -> DataFrame:
    """item, m (words), k (shingle size), pos and h of every item shingle."""
    hashed = items.select("item_id", _word_hashes(F.col("text")).alias("w")).withColumn("m", F.size("w")).where("m > 0")
    hashed = hashed.withColumn("item", F.xxhash64("item_id", "w")).withColumn("k", F.least(F.col("m"), F.lit(SHINGLE)))
    grams = F.when(F.col("k") == SHINGLE, _grams(F.col("w"), SHINGLE))
    for k in range(1, SHINGLE):
        grams = grams.when(F.col("k") == k, _grams(F.col("w"), k))
    return hashed.select("item_id", "item", "m", "k", F.posexplode(grams).alias("pos", "h"))


def _simhash(shingles: DataFrame, keys: list[str]) -> DataFrame:
    """keys, simhash and the total weight from rows (keys, h, weight)."""
    bits = [F.sum(F.when(F.shiftright("h", b).bitwiseAND(F.lit(1).cast("long")) == 1, F.col("weight")).otherwise(-F.col("weight"))).alias(f"b{b}") for b in range(64)]
    sums = shingles.groupBy(*keys).agg(*bits, F.sum("weight").alias("total"))
    value = F.lit(0).cast("long")
    for b in range(64):
        value = value.bitwiseOR(F.when(F.col(f"b{b}") > 0, F.shiftleft(F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long")))
    return sums.select(*keys, value.alias("simhash"), "total")


def flips(spark: SparkSession, widths: tuple[int, ...] = WIDTHS, up_to: int = FLIPS) -> DataFrame:
    """block and mask: each set of up to ``up_to`` bits (one or two) of each block, a few hundred rows."""
    most = max(widths) + 1  # the last number stands for no bit
    block, low, high = F.floor(F.col("id") / most**2).cast("int"), F.floor(F.col("id") / most) % most, F.col("id") % most
    pairs = spark.range(len(widths) * most**2).select(block.alias("block"), low.cast("int").alias("low"), high.cast("int").alias("high"))
    width = F.element_at(F.array(*[F.lit(w) for w in widths]), F.col("block") + 1)
    none = F.lit(most - 1)
    pairs = pairs.where(((F.col("low") < width) & ((F.col("high") == none) | (F.col("high") < width) & (F.col("low") < F.col("high")))) | ((F.col("low") == none) & (F.col("high") == none)))
    pairs = pairs if up_to > 1 else pairs.where(F.col("high") == none)
    bit = lambda c: F.when(F.col(c) == none, F.lit(0).cast("long")).otherwise(F.call_function("shiftleft", F.lit(1).cast("long"), F.col(c)))
    return pairs.select("block", bit("low").bitwiseOR(bit("high")).alias("mask"))


def rows_flipped(widths: tuple[int, ...], up_to: int) -> int:
    """Rows that ``flipped`` makes of one."""
    return sum(1 + w + (up_to > 1) * w * (w - 1) // 2 for w in widths)


def flipped(prints: DataFrame, masks: DataFrame, name: str, widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    """Each row of ``prints`` for each block of its simhash and each flip of it:
    block, value and, under ``name``, the mask."""
    cuts = [sum(widths[:j]) for j in range(len(widths))]
    own = [F.struct(F.lit(j).alias("block"), F.call_function("shiftrightunsigned", F.col("simhash"), F.lit(a)).bitwiseAND(F.lit((1 << w) - 1)).alias("value")) for j, (a, w) in enumerate(zip(cuts, widths, strict=True))]
    cut = prints.select("*", F.inline(F.array(*own)))
    return cut.join(F.broadcast(masks), "block").withColumn("value", F.col("value").bitwiseXOR(F.col("mask"))).withColumnRenamed("mask", name)


def once(x: Column, y: Column) -> Column:
    """Whether two flips are the ones that a pair of blocks meets by: ``x`` has the
    lower half of the differing bits, and the middle one."""
    lowest = y.bitwiseAND(-y)
    more = F.bit_count(x) - F.bit_count(y)
    return more.between(0, 1) & ((y == 0) | (x < lowest))


def row_key() -> Column:
    """Identifies a document by id and text, nulls included."""
    return F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text")


def without_leaks(docs: DataFrame, items: DataFrame, threshold: int = 80) -> DataFrame:
    """The documents that contain no item; all columns as they are."""
    found = settled(lambda: leaks(docs, items, threshold).select(F.col("key").alias("__ff_key")).distinct(), "leaks")
    found = F.broadcast(found) if found.count() <= BROADCAST_ROWS else found
    return docs.withColumn("__ff_key", row_key()).join(found, "__ff_key", "left_anti").select(*docs.columns)


def leaks(docs: DataFrame, items: DataFrame, threshold: int = 80) -> DataFrame:
    """doc_id, key (of id and text), item_id, the best window (first_word, n_words), its similarity and
    fingerprint distance: a row for each document and item that it contains."""
    return settled(lambda: _leaks(docs, items, threshold), "found")


def _leaks(docs: DataFrame, items: DataFrame, threshold: int) -> DataFrame:
    grams = materialize(_prepared_items(items), "items")
    small = grams.count() <= BROADCAST_ROWS

    def hint(table: DataFrame) -> DataFrame:
        return F.broadcast(table) if small else table

    keyed = docs.select("doc_id", row_key().alias("key"), F.coalesce("doc_id", F.lit(0)).alias("id"), "text")
    hashed = keyed.select("id", "key", _word_hashes(F.col("text")).alias("w"))
    sizes = sorted(r["k"] for r in grams.select("k").distinct().collect())
    # one scan for all sizes of shingles: five words, and those of the shorter items
    all_grams = F.concat(*[_placed_grams(F.col("w"), k) for k in sizes or [SHINGLE]])
    shingles = hashed.select("id", "key", F.size("w").alias("n"), F.inline(all_grams))
    found = shingles.join(hint(grams.select("k", "h", "m", "pos").distinct()), ["k", "h"])
    first, last = F.greatest(F.col("at") - F.col("pos"), F.lit(0)), F.least(F.col("at") - F.col("pos") + F.col("m"), F.col("n"))
    windows = found.select("id", "key", "m", "k", first.alias("first"), (last - first).alias("len")).distinct()
    windows = materialize(windows.where(F.col("len") >= F.col("k")), "places")

    few = windows.count() <= BROADCAST_ROWS
    per_doc = windows.groupBy("id", "key").agg(F.collect_set(F.struct("m", "k", "first", "len")).alias("places"))
    texts = keyed.join(F.broadcast(per_doc) if few else per_doc, ["id", "key"]).dropDuplicates(["id", "key"])
    cut = texts.select("doc_id", "id", "key", _word_hashes(F.col("text")).alias("w"), F.explode("places").alias("p"))
    cut = cut.select("doc_id", "id", "key", "p.*", F.slice("w", F.col("p.first") + 1, F.col("p.len")).alias("w"))
    own = F.when(F.col("k") == SHINGLE, _grams(F.col("w"), SHINGLE))
    for k in range(1, SHINGLE):
        own = own.when(F.col("k") == k, _grams(F.col("w"), k))
    place = ["id", "key", "m", "first", "len"]
    bags = cut.select("doc_id", *place, F.explode(own).alias("h")).groupBy("doc_id", *place, "h").agg(F.count(F.lit(1)).alias("weight"))
    bags = materialize(bags, "bags")
    item_bags = materialize(grams.groupBy("item_id", "item", "m", "h").agg(F.count(F.lit(1)).alias("weight")), "bags")

    # written: with 64 sums each they are the largest part of the plan, and adaptive execution plans it again after every stage
    windows = materialize(_simhash(bags, place).withColumnRenamed("simhash", "own_print"), "prints").withColumn("simhash", F.col("own_print"))
    asked = materialize(_simhash(item_bags, ["item", "m"]).withColumnRenamed("total", "item_total"), "asked").withColumn("item_print", F.col("simhash"))
    n_items = asked.count()
    widths, up_to = (FEW_WIDTHS, FEW_FLIPS) if n_items <= FEW_ITEMS else (WIDTHS, FLIPS)
    masks = materialize(flips(docs.sparkSession, widths, up_to), "flips")
    # one number to meet by, and of the items no more than meets: the table is built in the driver before it is sent
    bits = lambda c, n: F.shiftleft(F.col(c).cast("long"), n)
    spot = bits("m", VALUE_BITS + BLOCK_BITS).bitwiseOR(bits("block", VALUE_BITS)).bitwiseOR(F.col("value")).alias("spot")
    x = flipped(windows, masks, "own_mask", widths).select(*place, "total", "own_print", "own_mask", spot)
    y = flipped(asked.select("m", "simhash", "item_print").distinct(), masks, "item_mask", widths).select("item_print", "item_mask", spot)
    y = F.broadcast(y) if n_items * rows_flipped(widths, up_to) <= min(BROADCAST_ROWS, BROADCAST_FLIPPED) else y
    distance = F.bit_count(F.col("own_print").bitwiseXOR(F.col("item_print"))).alias("distance")
    met = x.join(y, "spot").where(once(F.col("own_mask"), F.col("item_mask")))
    near = met.select(*place, "total", "item_print", distance).where(F.col("distance") <= RADIUS).distinct()
    named = asked.select("m", "item_print", "item", "item_total")
    candidates = near.join(F.broadcast(named) if n_items <= BROADCAST_ROWS else named, ["m", "item_print"])

    shared = (
        candidates.join(bags.select("doc_id", *place, "h", F.col("weight").alias("own")), place)
        .join(hint(item_bags.select("item_id", "item", "h", F.col("weight").alias("asked"))), ["item", "h"])
        .groupBy("doc_id", "item_id", *place, "item", "total", "item_total", "distance")
        .agg(F.sum(F.least("own", "asked")).alias("low"))
    )
    high = F.col("total") + F.col("item_total") - F.col("low")
    verified = shared.where(100 * F.col("low") >= threshold * high).withColumn("similarity", F.col("low") / high)
    best = F.max_by(F.struct("first", "len", "similarity", "distance"), F.struct(F.col("similarity"), -F.col("first"))).alias("best")
    out = verified.groupBy("doc_id", "id", "key", "item_id", "item").agg(best)
    return out.select("doc_id", "key", "item_id", F.col("best.first").alias("first_word"), F.col("best.len").alias("n_words"), F.col("best.similarity").alias("similarity"), F.col("best.distance").cast("int").alias("distance"))
