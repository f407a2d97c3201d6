"""Seeded and stratified samples.  Orders are hash orders of key and seed, so a
sample does not depend on partitioning and repeats exactly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .windows import first_of_each


def hash_order(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")).cast("binary"))


def take(rows: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    return rows.orderBy(hash_order(key, seed), key).limit(n)


def stratified(rows: DataFrame, key: str, category: str, era: str, quotas: dict[str, int], shares: dict[str, float], seed: int = 42) -> DataFrame:
    """Per category up to its quota: first ``int(quota * share)`` rows of each
    era, then what is missing from the category's other rows.  ``round`` is 1
    or 2.  Each row belongs to one category and is taken once."""
    quota = F.create_map(*[F.lit(x) for p in quotas.items() for x in p])
    share = F.create_map(*[F.lit(x) for p in shares.items() for x in p])
    order = [hash_order(key, seed), F.col(key)]
    q = F.try_element_at(quota, F.col(category))
    # whatever is taken is among the first ``quota`` rows of its category and era
    kept = first_of_each(rows.where(q.isNotNull()), [category, era], max(quotas.values()), *order)
    ranked = kept.withColumn("__q", q)
    ranked = ranked.withColumn("__rn", F.row_number().over(Window.partitionBy(category, era).orderBy(*order)))
    first = F.col("__rn") <= F.floor(F.col("__q") * F.coalesce(F.try_element_at(share, F.col(era)), F.lit(0.0)))
    ranked = ranked.withColumn("__first", first)
    by_category = Window.partitionBy(category)
    ranked = ranked.withColumn("__got", F.sum(F.col("__first").cast("int")).over(by_category))
    rest = F.row_number().over(Window.partitionBy(category, "__first").orderBy(*order))
    ranked = ranked.withColumn("__rest", rest)
    taken = F.col("__first") | (F.col("__rest") <= F.col("__q") - F.col("__got"))
    return ranked.where(taken).withColumn("round", F.when(F.col("__first"), 1).otherwise(2)).drop("__q", "__rn", "__first", "__got", "__rest")


def page_picks(n: Column) -> Column:
    """First, middle and last page of n, each once."""
    return F.when(n > 0, F.array_distinct(F.array(F.lit(0).cast("long"), F.floor(n / 2), (n - 1).cast("long"))))
