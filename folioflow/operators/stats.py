"""Grouped statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nulls import count_if, is_blank, share


def distribution(rows: DataFrame, key: str, **flags: Column) -> DataFrame:
    """Per key: total, percent of all, and for each flag its count and rate."""
    aggs = [F.count(F.lit(1)).alias("total")] + [count_if(c).alias(n) for n, c in flags.items()]
    out = rows.groupBy(key).agg(*aggs)
    out = out.withColumn("pct", F.col("total") * 100.0 / F.sum("total").over(Window.partitionBy()))
    return out.withColumns({f"{n}_rate": F.col(n) * 100.0 / F.col("total") for n in flags})


def completeness(rows: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column: filled and blank counts, distinct values, percent and
    band; every column in one pass over the table."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for c in columns:
        v = F.col(c).cast("string")
        aggs += [count_if(~is_blank(v)).alias(f"{c}__filled"), F.countDistinct(v).alias(f"{c}__distinct")]
    one = rows.agg(*aggs)
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"{c}__filled").alias("filled"), F.col(f"{c}__distinct").alias("n_distinct")) for c in columns])).alias("x")
    pct = share(F.col("x.filled") * 100.0, F.col("n"))
    band = F.when(pct >= 99, "complete").when(pct >= 50, "partial").otherwise("sparse")
    return one.select("n", each).select("x.field", "x.filled", (F.col("n") - F.col("x.filled")).alias("blank"), "x.n_distinct", pct.alias("pct"), band.alias("band"))


def missing_years(rows: DataFrame, year: str, limit: int | None = None) -> DataFrame:
    """Years between the first and the last that no row has: all, or the first
    ``limit``."""
    seen = rows.where(F.col(year).isNotNull()).select(year).distinct()
    span = seen.agg(F.min(year).alias("a"), F.max(year).alias("b")).where("a is not null")
    every = span.select(F.explode(F.sequence("a", "b")).alias(year))
    missing = every.join(seen, year, "left_anti").orderBy(year)
    return missing if limit is None else missing.limit(limit)


def order_statistic(rows: DataFrame, value: str, share_: float, keys: list[str] | None = None, descending: bool = False) -> DataFrame:
    """The element at index ``int(n * share)`` of the sorted values (by group),
    never interpolated.  Ranks come from a window over counted distinct values."""
    keys = keys or []
    counted = rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    order = Window.partitionBy(*keys).orderBy(F.desc(value) if descending else F.asc(value))
    everything = Window.partitionBy(*keys)
    placed = counted.withColumn("__upto", F.sum("__n").over(order)).withColumn("__at", F.floor(F.sum("__n").over(everything) * F.lit(share_)))
    hit = placed.where((F.col("__upto") > F.col("__at")) & (F.col("__upto") - F.col("__n") <= F.col("__at")))
    return hit.select(*keys, value)


def percent_of(part: Column, whole: Column) -> Column:
    return share(part * 100.0, whole)


def era(year: Column) -> Column:
    """Eras by lower bound; null and earlier years have their own names."""
    return F.when(year.isNull(), "unknown").when(year < 1960, "before 1960").when(year < 1980, "1960-1979").when(year < 2000, "1980-1999").when(year < 2010, "2000-2009").when(year < 2020, "2010-2019").otherwise("2020 on")


def length_bucket(n: Column) -> Column:
    return F.when(n < 5000, "under 5k").when(n < 20000, "5k-20k").when(n < 50000, "20k-50k").when(n < 100000, "50k-100k").otherwise("100k and more")
