"""Upserts, merges and versioned writes as DataFrame rewrites.

Each takes the old and the new rows and returns the table as it should be; the
caller writes it to a new place and swaps (see ``sources.sinks.replace_table``).
A batch may name a key more than once: the last by ``order`` wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nulls import is_blank


def latest(rows: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in the given order."""
    return rows.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__rn = 1").drop("__rn")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], keep_old: tuple[str, ...] = (), keep_if_null: tuple[str, ...] = ()) -> DataFrame:
    """Insert new keys, overwrite known ones.  ``keep_old`` columns never
    change once set; ``keep_if_null`` ones only take values that are not null."""
    o, n = old.alias("o"), new.alias("n")
    both = o.join(n, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys], "full_outer")
    there = F.col(f"n.{keys[0]}").isNotNull()
    columns = []
    for c in old.columns:
        a, b = F.col(f"o.{c}"), F.col(f"n.{c}")
        if c in keys:
            columns.append(F.coalesce(a, b).alias(c))
        elif c in keep_old:
            columns.append(F.coalesce(a, b).alias(c))
        elif c in keep_if_null:
            columns.append(F.coalesce(b, a).alias(c))
        else:
            columns.append(F.when(there, b).otherwise(a).alias(c))
    return both.select(*columns)


def upsert_counting(old: DataFrame, failures: DataFrame, keys: list[str], counter: str, message: str, at: str) -> DataFrame:
    """Failures raise the counter by how often a key occurs and refresh its
    message and time with the latest."""
    batch = failures.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.max_by(message, at).alias("__m"), F.max(at).alias("__at"))
    both = old.join(batch, keys, "full_outer")
    known = F.col(counter).isNotNull()
    return both.select(
        *keys,
        F.when(known, F.col(counter) + F.coalesce("__n", F.lit(0))).otherwise(F.col("__n") - 1).alias(counter),
        F.coalesce("__m", message).alias(message),
        F.coalesce("__at", at).alias(at),
    )


def update_where(rows: DataFrame, condition: Column, **values: Column) -> DataFrame:
    return rows.withColumns({c: F.when(condition, v).otherwise(F.col(c)) for c, v in values.items()})


def delete_keys(rows: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(gone.select(*keys), keys, "left_anti")


def insert_ignore(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    return old.unionByName(new.dropDuplicates(keys).join(old.select(*keys), keys, "left_anti"))


def merge_actions(old: DataFrame, new: DataFrame, key: str, url: str, placeholder: str = "NO_PDF") -> DataFrame:
    """key, action: "inserted", "updated" (old url missing or the placeholder, new
    one present) or "skipped" for every row of the new store."""
    o = old.select(key, F.col(url).alias("__old"), F.lit(True).alias("__there"))
    joined = new.join(o, key, "left")
    fresh = F.col("__old").isNull() | (F.col("__old") == placeholder)
    usable = ~is_blank(url) & (F.col(url) != placeholder)
    action = F.when(F.col("__there").isNull(), "inserted").when(fresh & usable, "updated").otherwise("skipped")
    return joined.select(key, action.alias("action"))


def new_version(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Deactivate the rows of the keys that get a new version, add those."""
    touched = old.join(new.select(*keys).distinct().withColumn("__new", F.lit(True)), keys, "left")
    kept = touched.withColumn("is_active", F.when(F.col("__new"), F.lit(False)).otherwise(F.col("is_active"))).drop("__new")
    return kept.unionByName(new.withColumn("is_active", F.lit(True)))
