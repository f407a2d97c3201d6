"""Removal of boilerplate lines by their spread over distinct sites.

A line (a \\n-separated piece with a word in it, trimmed of spaces) is
boilerplate if it occurs on at least ``min_sites`` distinct sites.  Distinct
sites are estimated by a HyperLogLog sketch per line hash; sketches merge by
aggregation, so a line on every site costs one small sketch per task.  Lines
whose estimate is near the threshold get an exact distinct count.

A line on ``min_sites`` sites occurs at least as often, so counts come first
and only lines that reach it are sketched; no line is lost by that.

Native.  A hot line meets in partial aggregates only.  The set of frequent lines
is broadcast if its counted size is small (``BROADCAST_LINES``), else joined by
exchange.  Texts travel once, to meet the places of their own bad lines.

Lines are compared by a 64-bit hash: among ``N`` distinct lines about ``N**2 / 2**65``
pairs would be taken for equal.

Nulls: a null text has no lines, null sites are one site of their own, null ids
are kept; repeated rows lose the same lines.  A line on exactly ``min_sites`` sites
is boilerplate.  A very long text is one row with many lines.  An empty table gives
an empty result.  Other columns play no part; names that start with ``__ff_`` are
taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import materialize, settled

LG_K = 10
#: Relative half-width of "near": over six standard errors of 2**10 registers.
NEAR = 0.2
BROADCAST_LINES = 100_000
_HAS_WORD = r"[^\x20\x09-\x0D]"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _hash(line: Column) -> Column:
    return F.xxhash64(F.trim(line))


def occurrences(docs: DataFrame) -> DataFrame:
    """h (line hash), doc and site of every line that has a word."""
    own = F.filter(_lines(F.col("text")), lambda x: x.rlike(_HAS_WORD))
    site = F.xxhash64(F.col("source").isNull(), "source").alias("site")
    return docs.select(site, F.explode(F.transform(own, _hash)).alias("h"))


def spread(docs: DataFrame, min_sites: int) -> DataFrame:
    """h and n_sites of every line on at least ``min_sites`` distinct sites."""
    all_lines = occurrences(docs)
    often = materialize(all_lines.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_sites).select("h"), "often")
    small = often.count() <= BROADCAST_LINES
    keys = F.broadcast(often) if small else often
    frequent = all_lines.join(keys, "h", "left_semi")
    sketched = frequent.groupBy("h").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LG_K))).alias("estimate"))
    sketched = materialize(sketched, "spread")
    near = F.abs(F.col("estimate") - min_sites) <= F.greatest(F.lit(1.0), F.lit(NEAR * min_sites))
    unsure = sketched.where(near).select("h")
    exact = frequent.join(F.broadcast(unsure) if small else unsure, "h", "left_semi").groupBy("h", "site").agg(F.lit(1).alias("one")).groupBy("h").agg(F.count(F.lit(1)).alias("n_sites"))
    sure = sketched.where(~near).select("h", F.col("estimate").alias("n_sites"))
    return sure.unionByName(exact).where(F.col("n_sites") >= min_sites)


def without_boilerplate(docs: DataFrame, min_sites: int = 10) -> DataFrame:
    """doc_id, n_lines, n_removed and the text that is left."""
    bad = settled(lambda: spread(docs, min_sites), "boilerplate")
    small = bad.count() <= BROADCAST_LINES
    keyed = docs.select("doc_id", "text", F.coalesce("doc_id", F.lit(0)).alias("__ff_id"), F.xxhash64(F.col("doc_id").isNull(), "text").alias("__ff_key"))
    places = keyed.select("__ff_id", "__ff_key", F.posexplode(_lines(F.col("text"))).alias("pos", "line")).where(F.col("line").rlike(_HAS_WORD))
    places = places.select("__ff_id", "__ff_key", "pos", _hash(F.col("line")).alias("h"))
    hit = places.join(F.broadcast(bad.select("h")) if small else bad.select("h"), "h", "left_semi")
    gone = hit.groupBy("__ff_id", "__ff_key").agg(F.collect_set("pos").alias("gone"))
    lines = _lines(F.col("text"))
    kept = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(F.filter(lines, lambda x, i: ~F.array_contains(F.col("gone"), i)), "\n"))
    out = keyed.join(gone, ["__ff_id", "__ff_key"], "left").withColumn("kept_text", kept)
    return out.select(
        "doc_id",
        F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        F.col("kept_text").alias("text"),
    )
