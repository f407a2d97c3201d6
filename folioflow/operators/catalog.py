"""Catalog scans, search, paging and worklists."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nulls import all_of, is_blank


@dataclass(frozen=True)
class Search:
    """A search request; unset fields do not restrict."""

    text: str = ""
    kind: str = ""
    year: int | None = None
    year_from: int | None = None
    year_to: int | None = None
    has_pdf: bool | None = None
    active: bool | None = None
    exact_status: bool = False


def parse_years(spec: str) -> tuple[int, int]:
    """"2020-2024" -> (2020, 2024); a single year is its own range."""
    first, _, last = spec.partition("-")
    return int(first), int(last or first)


def conditions(s: Search) -> list[Column]:
    found = []
    if s.text:
        found.append(F.col("tentang").ilike(f"%{s.text}%"))
    if s.kind:
        found.append(F.col("jenis") == s.kind.upper())
    if s.year is not None:
        found.append(F.col("tahun") == s.year)
    if s.year_from is not None:
        found.append(F.col("tahun") >= s.year_from)
    if s.year_to is not None:
        found.append(F.col("tahun") <= s.year_to)
    if s.has_pdf is not None:
        found.append(is_blank("local_path") if not s.has_pdf else ~is_blank("local_path"))
    if s.active is not None:
        status = F.col("status")
        if s.exact_status:
            found.append(status == ("Berlaku" if s.active else "Tidak Berlaku"))
        elif s.active:
            found.append(status.ilike("%berlaku%") & ~status.ilike("%tidak%"))
        else:
            found.append(status.ilike("%tidak%") | status.ilike("%dicabut%"))
    return found


def search(catalog: DataFrame, s: Search) -> DataFrame:
    return catalog.where(all_of(conditions(s)))


def ordering(name: str) -> list[Column]:
    """Named sort orders; the slug makes each a total order."""
    known = {
        "year_desc": [F.desc("tahun"), F.asc("nomor")],
        "year_asc": [F.asc("tahun"), F.asc("nomor")],
        "type": [F.asc("jenis"), F.desc("tahun")],
        "title": [F.asc("tentang")],
    }
    return [*known.get(name, known["year_desc"]), F.asc("slug")]


def page(rows: DataFrame, order: list[Column], number: int, size: int) -> DataFrame:
    return rows.orderBy(*order).offset((number - 1) * size).limit(size)


def page_counts(rows: DataFrame, size: int) -> DataFrame:
    """total and total_pages (at least one page)."""
    n = F.count(F.lit(1))
    return rows.agg(n.alias("total"), F.greatest(F.ceil(n / size), F.lit(1)).alias("total_pages"))


def top_k(rows: DataFrame, k: int, *order: Column) -> DataFrame:
    return rows.orderBy(*order).limit(k)


def retry_queue(failed: DataFrame, kind: str, max_retries: int, limit: int) -> DataFrame:
    """Items of one kind that may be tried again, oldest first."""
    return failed.where((F.col("item_type") == kind) & (F.col("retry_count") < max_retries)).orderBy("failed_at", "url").limit(limit)


def pending(work: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Work whose key is not among the finished ones."""
    return work.join(done.select(key), key, "left_anti")


def shard(files: DataFrame, path: str, shard_no: int, shards: int, skip: str) -> DataFrame:
    """Sorted paths without ``skip``, every ``shards``-th from ``shard_no``.

    The place in the sorted order comes from per-range counts, not from one
    global window: paths are range-partitioned and numbered inside ranges."""
    kept = files.where(~F.col(path).contains(skip))
    ranged = kept.repartitionByRange(F.col(path)).sortWithinPartitions(path).withColumn("__at", F.monotonically_increasing_id())
    counts = ranged.groupBy(F.shiftright("__at", 33).alias("__p")).count()
    before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__p", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__n"))
    at = F.col("__n") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    placed = ranged.withColumn("__p", F.shiftright("__at", 33)).join(F.broadcast(offsets), "__p")
    return placed.where(at % shards == shard_no).drop("__p", "__at", "__n")
