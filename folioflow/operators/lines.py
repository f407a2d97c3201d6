"""Line frequency, page cleaning and rule engines over (doc, page, text) rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import PAGE_NOISE, any_match, header_metadata, normalize_line, split_lines


def repeated_lines(pages: DataFrame, doc: str, page: str, threshold: float = 0.6) -> DataFrame:
    """doc, line (normalised), hits: lines on at least ``threshold`` of a
    document's pages; documents of one page have none."""
    keys = F.array_distinct(F.filter(F.transform(split_lines(F.col("text")), lambda x: normalize_line(x)), lambda x: x != ""))
    hits = pages.select(doc, page, F.explode(keys).alias("line")).groupBy(doc, "line").agg(F.count(F.lit(1)).alias("hits"))
    n = pages.groupBy(doc).agg(F.count(F.lit(1)).alias("n_pages"))
    return hits.join(n, doc).where((F.col("n_pages") > 1) & (F.col("hits") / F.col("n_pages") >= threshold)).select(doc, "line", "hits")


def repeated_ratio(pages: DataFrame, doc: str, page: str, threshold: float = 0.6) -> DataFrame:
    """doc, ratio: hits of repeated lines over all distinct lines of its pages."""
    keys = F.array_distinct(F.filter(F.transform(split_lines(F.col("text")), lambda x: normalize_line(x)), lambda x: x != ""))
    total = pages.groupBy(doc).agg(F.sum(F.size(keys)).alias("total"))
    hits = repeated_lines(pages, doc, page, threshold).groupBy(doc).agg(F.sum("hits").alias("hits"))
    return total.join(hits, doc, "left").select(doc, F.coalesce(F.try_divide("hits", "total"), F.lit(0.0)).alias("ratio"))


def clean_pages(pages: DataFrame, doc: str, page: str, noise: list[str] | None = None, threshold: float = 0.6) -> DataFrame:
    """doc, page, text, n_lines, n_removed: pages without noise lines (a pattern
    found anywhere) and without lines repeated over the document."""
    bad = repeated_lines(pages, doc, page, threshold).groupBy(doc).agg(F.collect_list("line").alias("__bad"))
    lines = split_lines(F.col("text"))
    joined = pages.join(bad, doc, "left").withColumn("__bad", F.coalesce("__bad", F.array().cast("array<string>")))
    kept = F.filter(lines, lambda x: ~any_match(x, noise or PAGE_NOISE) & ~((normalize_line(x) != "") & F.array_contains(F.col("__bad"), normalize_line(x))))
    out = joined.withColumn("__kept", kept)
    return out.select(doc, page, F.trim(F.array_join("__kept", "\n"), F.lit(" \t\r\n\x0b\x0c")).alias("clean"), F.size(lines).alias("n_lines"), (F.size(lines) - F.size("__kept")).alias("n_removed"))


def clean_pages_at_start(pages: DataFrame, doc: str, page: str, noise: list[str], threshold: float = 0.6) -> DataFrame:
    """doc, page, clean: like ``clean_pages``, but a noise pattern must match from
    the start of a line, and runs of blank lines become one."""
    out = clean_pages(pages, doc, page, [rf"^(?:{p})" for p in noise], threshold)
    return out.select(doc, page, F.trim(F.regexp_replace("clean", r"\n{3,}", "\n\n"), F.lit(" \t\r\n\x0b\x0c")).alias("clean"))


def cleaned_with_metadata(pages: DataFrame, doc: str, page: str, rules: list[dict], threshold: float = 0.6) -> DataFrame:
    """doc, page, clean and the head's metadata: frequent lines go, then the
    rules apply; metadata come from the text as it was."""
    kept = drop_frequent_lines(pages, doc, page, threshold)
    clean = kept.select(doc, page, apply_rules(F.col("clean"), rules).alias("clean"))
    return clean.join(pages.select(doc, page, header_metadata(F.col("text")).alias("m")), [doc, page]).select(doc, page, "clean", "m.*")


def drop_frequent_lines(pages: DataFrame, doc: str, page: str, threshold: float = 0.6, guard: bool = True) -> DataFrame:
    """Pages without lines (trimmed) on at least ``threshold`` of the pages.  With
    ``guard`` documents of one page are left alone."""
    split = F.split("text", "\n", -1)
    keys = F.array_distinct(F.filter(F.transform(split, lambda x: F.trim(x)), lambda x: x != ""))
    hits = pages.select(doc, page, F.explode(keys).alias("line")).groupBy(doc, "line").agg(F.count(F.lit(1)).alias("hits"))
    n = pages.groupBy(doc).agg(F.count(F.lit(1)).alias("n_pages"))
    often = hits.join(n, doc).where((F.col("hits") / F.col("n_pages") >= threshold) & (F.lit(not guard) | (F.col("n_pages") > 1)))
    bad = often.groupBy(doc).agg(F.collect_list("line").alias("__bad"))
    kept = F.filter(split, lambda x: ~F.coalesce(F.array_contains("__bad", F.trim(x)), F.lit(False)))
    return pages.join(bad, doc, "left").select(doc, page, F.array_join(kept, "\n").alias("clean"))


def apply_rule(text: Column, kind: str, pattern: str, replacement: str = "") -> Column:
    """One rule: "regex" drops lines that match whole and replaces elsewhere,
    "exact" compares trimmed lines, "contains", "startswith" and "endswith" ignore
    case."""
    lines, low = F.split(text, "\n", -1), pattern.lower()
    if kind == "regex":
        kept = F.filter(lines, lambda x: ~F.trim(x).rlike(f"(?i)^(?:{pattern})$"))
        if replacement:
            kept = F.transform(kept, lambda x: F.regexp_replace(x, f"(?i){pattern}", replacement))
        return F.array_join(kept, "\n")
    tests = {
        "exact": lambda x: F.trim(x) == pattern,
        "contains": lambda x: F.lower(x).contains(low),
        "startswith": lambda x: F.lower(F.trim(x)).startswith(low),
        "endswith": lambda x: F.lower(F.trim(x)).endswith(low),
    }
    return F.array_join(F.filter(lines, lambda x: ~tests[kind](x)), "\n") if kind in tests else text


def apply_rules(text: Column, rules: list[dict]) -> Column:
    """Rules by scope (global first), then priority; each sees what is left."""
    for r in sorted(rules, key=lambda r: (r.get("cluster_id") is not None, -r.get("priority", 0), r.get("id", 0))):
        text = apply_rule(text, r["kind"], r["pattern"], r.get("replacement", ""))
    return F.trim(F.regexp_replace(text, r"\n{3,}", "\n\n"), F.lit(" \t\r\n"))


def position_frequency(docs: DataFrame, cluster: str, top: int = 3, share: float = 0.3) -> DataFrame:
    """Per cluster and line position the ``top`` lines on more than ``share`` of
    its documents."""
    lines = docs.select(cluster, F.posexplode(F.split("text", "\n", -1)).alias("pos", "line")).where(F.trim("line") != "")
    n = docs.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"))
    hits = lines.groupBy(cluster, "pos", F.trim("line").alias("line")).agg(F.count(F.lit(1)).alias("hits"))
    order = Window.partitionBy(cluster, "pos").orderBy(F.desc("hits"), "line")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(n, cluster).where(F.col("hits") / F.col("n") > share).select(cluster, "pos", "line", "hits", "rank")


def noise_frequency(docs: DataFrame, key: str, top: int) -> DataFrame:
    """Lines by how many documents hold them (exact), then by occurrences."""
    lines = docs.select(key, F.explode(F.split("text", "\n", -1)).alias("line")).where(F.trim("line") != "")
    per_doc = lines.groupBy("line", key).agg(F.count(F.lit(1)).alias("n"))
    return per_doc.groupBy("line").agg(F.sum("n").alias("hits"), F.count(F.lit(1)).alias("docs")).orderBy(F.desc("docs"), F.desc("hits"), "line").limit(top)


def sections(lines: DataFrame, doc: str, at: str) -> DataFrame:
    """doc, section, text: lines carried under the last heading before them."""
    heading = F.regexp_extract(F.trim("line"), r"(?i)^(Menimbang|Mengingat|Memutuskan|Menetapkan|Pasal\s+\d+|BAB\s+[IVXLCDM]+)\b", 1)
    w = Window.partitionBy(doc).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    named = lines.withColumn("section", F.coalesce(F.last(F.when(heading != "", F.upper(heading)), ignorenulls=True).over(w), F.lit("PREAMBLE")))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(at).alias("at"), "line"))), lambda x: x["line"]), "\n")
    return named.groupBy(doc, "section").agg(F.min(at).alias("first"), body.alias("text"))
