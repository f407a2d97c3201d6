"""Ordered-window operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(rows: DataFrame, keys: list[str], at: str) -> DataFrame:
    """Order-preserving dedup: the first row of each key."""
    w = Window.partitionBy(*keys).orderBy(at)
    return rows.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def first_of_each(rows: DataFrame, keys: list[str], n: int, *order: Column, salts: int = 256) -> DataFrame:
    """The first ``n`` rows of each key in an order that ends in a unique column:
    of each salt first, so that no task sorts a whole key."""
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    kept = salted.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys, "__salt").orderBy(*order))).where(F.col("__rn") <= n)
    return kept.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("__rn") <= n).drop("__rn", "__salt")


def positions(rows: DataFrame, keys: list[str], at: str, width: int = 1 << 20) -> DataFrame:
    """rows with ``__i``, their place (from 0) in the order of the whole number
    ``at`` within their key: from the counts of earlier runs of ``width`` values
    and the place in the own run, so that no task holds a whole key."""
    run = rows.withColumn("__run", F.floor(F.col(at) / width))
    counts = run.groupBy(*keys, "__run").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__run").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*keys, "__run", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    inside = F.row_number().over(Window.partitionBy(*keys, "__run").orderBy(at)) - 1
    return run.withColumn("__inside", inside).join(counts, [*keys, "__run"]).withColumn("__i", F.col("__before") + F.col("__inside")).drop("__run", "__inside", "__before")


def moving_average(rows: DataFrame, keys: list[str], at: str, value: str, width: int = 7, block: int = 1 << 20) -> DataFrame:
    """Centered mean over ``width`` places with the edge values repeated, so
    every mean has ``width`` terms (a shrinking frame would differ there).  Windows
    run over blocks of ``block`` places and the few places beside them."""
    half = width // 2
    ends = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.min_by(value, at).alias("__first"), F.max_by(value, at).alias("__last"))
    placed = positions(rows, keys, at)
    near = F.array_distinct(F.array(*[F.greatest(F.floor((F.col("__i") + k) / block), F.lit(0)) for k in (-half, 0, half)]))
    w = Window.partitionBy(*keys, "__block").orderBy("__i")
    sums = placed.withColumn("__block", F.explode(near)).withColumn("__sum", F.sum(value).over(w.rowsBetween(-half, half)))
    own = sums.where(F.col("__block") == F.floor(F.col("__i") / block)).join(ends, keys)
    before, after = F.greatest(half - F.col("__i"), F.lit(0)), F.greatest(half - (F.col("__n") - 1 - F.col("__i")), F.lit(0))
    mean = (F.col("__sum") + before * F.col("__first") + after * F.col("__last")) / (2 * half + 1)
    return own.withColumn("mean", mean).select(*rows.columns, "mean")


def longest_run(rows: DataFrame, keys: list[str], at: str, flag: Column, min_run: int) -> DataFrame:
    """Share of the longest run of true flags among all places; runs shorter
    than ``min_run`` do not count (gaps and islands)."""
    w = Window.partitionBy(*keys).orderBy(at)
    marked = rows.select(*keys, at, flag.alias("__on"))
    islands = marked.withColumn("__g", F.row_number().over(w) - F.row_number().over(Window.partitionBy(*keys, "__on").orderBy(at)))
    runs = islands.groupBy(*keys, "__on", "__g").agg(F.count(F.lit(1)).alias("__n"))
    long = F.when(F.col("__on") & (F.col("__n") >= min_run), F.col("__n")).otherwise(0)
    return runs.groupBy(*keys).agg((F.max(long).cast("double") / F.sum("__n")).alias("share"))


def rates(rows: DataFrame, keys: list[str], at: str, value: str) -> DataFrame:
    """Change and change per second since the previous poll (null at the first)."""
    w = Window.partitionBy(*keys).orderBy(at)
    delta = F.col(value) - F.lag(value).over(w)
    seconds = F.unix_micros(at) / 1e6 - F.unix_micros(F.lag(at).over(w)) / 1e6
    return rows.withColumns({"delta": delta, "seconds": seconds}).withColumn("rate", F.try_divide("delta", "seconds"))


def page_of_offset(pages: DataFrame, key: str, at: str, length: Column, offset: int) -> DataFrame:
    """The page of each document that holds a character offset of the pages
    joined by one character."""
    w = Window.partitionBy(key).orderBy(at)
    placed = pages.select(key, at, F.sum(length + 1).over(w).alias("__end"))
    return placed.where(F.col("__end") > offset).groupBy(key).agg(F.min(at).alias("page"))
