"""Report roll-ups, file routing and issue lists."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import extract, html, records, text
from ..functions.nulls import count_if, share
from ..functions.quality import LEGAL_TERMS
from ..operators import cluster
from ..operators import graph as G
from ..operators import stats as S
from ..sources import sinks
from ..sources.tables import CATALOG_SQL, catalog, table
from .registry import query

W = f"with {CATALOG_SQL} "


@query("a9_full_report", W + "select 'type' as section, jenis as item, count(*) as n from catalog group by 2 union all select 'year', tahun::varchar, count(*) from catalog group by 2 union all select 'status', coalesce(status, 'none'), count(*) from catalog group by 2")
def _(s, d):
    c = catalog(s, d)
    part = lambda name, item: c.groupBy(item.alias("item")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("section"), "item", "n")
    return part("type", F.col("jenis")).unionByName(part("year", F.col("tahun").cast("string"))).unionByName(part("status", F.coalesce("status", F.lit("none"))))


@query("a20_nested_facts", "with t as (select conv_id, list(role) as roles from conversations group by 1) select role, count(*) as n, count(distinct conv_id) as holders from (select conv_id, unnest(roles) as role from t) group by 1")
def _(s, d):
    t = table(s, d, "conversations").groupBy("conv_id").agg(F.collect_list("role").alias("roles"))
    return t.select("conv_id", F.explode("roles").alias("role")).groupBy("role").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("conv_id").alias("holders"))


@query("a25_structural_stats", "select count(*) as n, count(*) filter (text like '%|%') * 100.0::double / count(*) as with_bars, avg(length(text) - length(replace(text, chr(10), ''))) as mean_breaks from documents")
def _(s, d):
    n, t = F.count(F.lit(1)), F.col("text")
    return table(s, d, "documents").agg(n.alias("n"), S.percent_of(count_if(t.contains("|")), n).alias("with_bars"), F.avg(F.length(t) - F.length(F.replace(t, F.lit("\n"), F.lit("")))).alias("mean_breaks"))


@query("a31_error_summary", "select event_type as kind, count(*) as n, count(*) filter (value >= 90) as high, count(*) filter (value < 90) as low from events group by 1")
def _(s, d):
    v = F.col("value")
    return table(s, d, "events").groupBy(F.col("event_type").alias("kind")).agg(F.count(F.lit(1)).alias("n"), count_if(v >= 90).alias("high"), count_if(v < 90).alias("low"))


@query("a36_before_after", "select count(*) as n, avg(n_chars) as before, avg(length(replace(text, chr(10), ''))) as after, count(*) filter (text ilike '%the%')::double / count(*) as marked from documents")
def _(s, d):
    t = F.col("text")
    return table(s, d, "documents").agg(F.count(F.lit(1)).alias("n"), F.avg("n_chars").alias("before"), F.avg(F.length(F.replace(t, F.lit("\n"), F.lit("")))).alias("after"), share(count_if(t.ilike("%the%")), F.count(F.lit(1))).alias("marked"))


@query("a37_flag_counts", "with f as (select doc_id, list_filter([case when n_chars < 500 then 'low' end, case when text like '%!!%' then 'loud' end], lambda x: x is not null) as flags from documents) select count(*) as n, count(*) filter (list_contains(flags, 'low')) as low, count(*) filter (list_contains(flags, 'loud')) as loud from f")
def _(s, d):
    flags = F.array_compact(F.array(F.when(F.col("n_chars") < 500, "low"), F.when(F.col("text").contains("!!"), "loud")))
    f = table(s, d, "documents").select(flags.alias("flags"))
    return f.agg(F.count(F.lit(1)).alias("n"), count_if(F.array_contains("flags", "low")).alias("low"), count_if(F.array_contains("flags", "loud")).alias("loud"))


@query("a41_similarity_rollup", "select conv_id, avg(length(text)) as mean, min_by(turn, (length(text), turn)) as worst, bool_or(length(text) < 40) as short from conversations group by 1")
def _(s, d):
    n = F.length("text")
    return table(s, d, "conversations").groupBy("conv_id").agg(F.avg(n).alias("mean"), F.min_by("turn", F.struct(n.alias("n"), F.col("turn"))).alias("worst"), F.bool_or(n < 40).alias("short"))


@query("a44_error_rate_rollup", "select user_id, max(value) as worst, count(*) as pages, case when bool_and(value < 99) then 'pass' else 'fail' end as status from events group by 1")
def _(s, d):
    return table(s, d, "events").groupBy("user_id").agg(F.max("value").alias("worst"), F.count(F.lit(1)).alias("pages"), F.when(F.bool_and(F.col("value") < 99), "pass").otherwise("fail").alias("status"))


@query("a47_quality_summary", "select source, count(*) as n, avg(n_chars) as mean, count(*) filter (n_chars < 100) as low_text from documents group by 1")
def _(s, d):
    return table(s, d, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.avg("n_chars").alias("mean"), count_if(F.col("n_chars") < 100).alias("low_text"))


@query("a48_candidates", "select doc_id, n_chars, case when text is null then 'error' when n_chars < 100 then 'needs_ocr' else 'low_score' end as reason from documents where text is null or n_chars < 100 or n_chars % 100 < 5")
def _(s, d):
    n = F.col("n_chars")
    rows = table(s, d, "documents").where("text is null or n_chars < 100 or n_chars % 100 < 5")
    return rows.select("doc_id", "n_chars", F.when(F.col("text").isNull(), "error").when(n < 100, "needs_ocr").otherwise("low_score").alias("reason"))


@query("q16_rate_calibration", "with s as (select n_chars, row_number() over (order by n_chars, doc_id) - 1 as i, count(*) over () as n from documents where n_chars > 0) select max(n_chars) filter (i = floor(n * 0.05)) as quality_at, max(n_chars) filter (i = floor(n * 0.03)) as manual_at from s")
def _(s, d):
    rows = table(s, d, "documents").where("n_chars > 0")
    a = S.order_statistic(rows, "n_chars", 0.05).agg(F.max("n_chars").alias("quality_at"))
    return a.join(F.broadcast(S.order_statistic(rows, "n_chars", 0.03).agg(F.max("n_chars").alias("manual_at"))))


@query("q17_issue_rows", "with i as (select doc_id, unnest(list_filter([case when n_chars < 100 then {'issue': 'short', 'severity': 'error'} end, case when n_chars > 10000 then {'issue': 'long', 'severity': 'info'} end, case when lang <> 'en' then {'issue': 'language', 'severity': 'warning'} end], lambda x: x is not null)) as x from documents) select doc_id, x.issue as issue, x.severity as severity from i")
def _(s, d):
    made = lambda when, issue, severity: F.when(when, F.struct(F.lit(issue).alias("issue"), F.lit(severity).alias("severity")))
    n = F.col("n_chars")
    found = F.array_compact(F.array(made(n < 100, "short", "error"), made(n > 10000, "long", "info"), made(F.col("lang") != "en", "language", "warning")))
    return table(s, d, "documents").select("doc_id", F.explode(found).alias("x")).select("doc_id", "x.*")


@query("pf24_download_eligible", W + "select slug from catalog where pdf_url is not null and pdf_url not in ('', 'NO_PDF') and (local_path is null or owner % 10 = 0)")
def _(s, d):
    size = F.when(F.col("local_path").isNull(), None).when(F.col("owner") % 10 == 0, 0).otherwise(10)
    return catalog(s, d).where(records.needs_download(F.col("pdf_url"), size)).select("slug")


@query("pf25_pf29_file_states", "select page_id, case when html ilike '%<html%' or html ilike '%<!doctype%' then 'html_error' else 'unknown' end as state from pages")
def _(s, d):
    return table(s, d, "pages").select("page_id", records.file_state(sinks.file_kind(F.col("html").cast("binary")), F.length("html")).alias("state"))


@query("pf27_status_meta", W + "select case when lower(coalesce(status, '')) like '%dicabut%' then 'revoked' when lower(coalesce(status, '')) like '%diubah%' then 'amended' when lower(coalesce(status, '')) like '%tidak berlaku%' then 'inactive' when lower(coalesce(status, '')) like '%berlaku%' then 'active' else 'unknown' end as meta, count(*) as n from catalog group by 1")
def _(s, d):
    return catalog(s, d).groupBy(records.status_meta(F.col("status")).alias("meta")).agg(F.count(F.lit(1)).alias("n"))


@query("pf30_routing", "select case when n_chars >= 100 then 'valid' else 'invalid' end as sink, count(*) as n from documents group by 1")
def _(s, d):
    return table(s, d, "documents").groupBy(F.when(F.col("n_chars") >= 100, "valid").otherwise("invalid").alias("sink")).agg(F.count(F.lit(1)).alias("n"))


@query("f20_scanned_exit", "select conv_id, count(*) > 1 and sum(length(text))::double / count(*) < 100 as scanned from conversations group by 1")
def _(s, d):
    return table(s, d, "conversations").groupBy("conv_id").agg(records.is_scanned(F.sum(F.length("text")), F.count(F.lit(1))).alias("scanned"))


def _quoted(words):
    return "(" + ", ".join(f"'{w}'" for w in sorted(words)) + ")"


@query("f39_word_analysis", "with w as (select doc_id, regexp_extract_all(lower(text), '[a-z]+') as w from documents), n as (select doc_id, len(w)::int as total, len(list_filter(w, lambda x: x in KNOWN))::int as known, len(list_filter(w, lambda x: x in LEGAL))::int as legal, len(list_filter(w, lambda x: x in STOP))::int as stop from w) select *, coalesce(known::double / nullif(total, 0), 0) as share from n".replace("KNOWN", _quoted(text.CORE_WORDS | set(LEGAL_TERMS))).replace("LEGAL", _quoted(LEGAL_TERMS)).replace("STOP", _quoted(records.STOPWORDS)))
def _(s, d):
    return table(s, d, "documents").select("doc_id", records.word_analysis(F.col("text")).alias("a")).select("doc_id", "a.*")


@query("f41_document_uris", "select o_orderkey, '/akn/id/act/' || lower(o_orderpriority) || '/' || year(o_orderdate) || '/' || o_custkey || '/ind@' as uri from orders")
def _(s, d):
    return table(s, d, "orders").select("o_orderkey", records.document_uri(F.col("o_orderpriority"), F.year("o_orderdate"), F.col("o_custkey"), "expression").alias("uri"))


@query("f52_years_in_urls", r"with y as (select page_id, [try_cast(regexp_extract(url, '(?i)tahun[-_ ]?(\d{4})', 1) as int), try_cast(regexp_extract(url, '[-_ ](\d{4})(?:[-_. ]|$)', 1) as int), try_cast(regexp_extract(url, '(\d{4})', 1) as int)] as y from pages) select page_id, list_filter(y, lambda x: x between 1900 and 2100)[1] as year from y")
def _(s, d):
    return table(s, d, "pages").select("page_id", text.year_in_name(F.col("url")).alias("year"))


@query("f53_line_categories", r"with l as (select trim(unnest(string_split(text, chr(10))), ' ') as s from documents) select case when regexp_matches(s, '^-?\s*\d{1,4}\s*-?$') then 'page_number' when regexp_matches(s, '(?i)^(?:presiden|republik|menteri)') then 'institution' when regexp_matches(s, '(?i)nomor|tahun') then 'number' when regexp_matches(s, '(?i)www\.|http') then 'url' when upper(s) = s and length(s) > 3 then 'heading' else 'text' end as category, count(*) as n from l group by 1")
def _(s, d):
    lines = table(s, d, "documents").select(F.explode(F.split("text", "\n", -1)).alias("line"))
    return lines.groupBy(text.line_category(F.col("line")).alias("category")).agg(F.count(F.lit(1)).alias("n"))


@query("n14_nested_histogram", "select lang, sum(n)::bigint as total, string_agg(bucket || '=' || n, ',' order by bucket) as histogram from (select lang, case when n_chars < 1000 then 'a' when n_chars < 5000 then 'b' else 'c' end as bucket, count(*) as n from documents group by 1, 2) group by 1")
def _(s, d):
    bucket = F.when(F.col("n_chars") < 1000, "a").when(F.col("n_chars") < 5000, "b").otherwise("c").alias("bucket")
    n = table(s, d, "documents").groupBy("lang", bucket).agg(F.count(F.lit(1)).alias("n"))
    entries = F.map_from_entries(F.array_sort(F.collect_list(F.struct("bucket", "n"))))
    nested = n.groupBy("lang").agg(F.sum("n").alias("total"), entries.alias("m"))
    return nested.select("lang", "total", F.array_join(F.transform(F.map_entries("m"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",").alias("histogram"))


@query("w8_running_alignment", "select conv_id, turn, (sum(length(text)) over (partition by conv_id order by turn, role rows between unbounded preceding and current row) - length(text))::bigint as starts_at from conversations")
def _(s, d):
    w = Window.partitionBy("conv_id").orderBy("turn", "role").rowsBetween(Window.unboundedPreceding, 0)
    n = F.length("text")
    return table(s, d, "conversations").select("conv_id", "turn", (F.sum(n).over(w) - n).alias("starts_at"))


@query("m3_histogram", "with v as (select vec_id, list_transform(embedding, lambda x: (abs(floor(x * 1000))::bigint % 256)) as p from embeddings) select vec_id, len(list_filter(p, lambda x: x < 16))::double / len(p) as first_bin, len(list_filter(p, lambda x: x >= 240))::double / len(p) as last_bin from v")
def _(s, d):
    p = F.transform("embedding", lambda x: F.abs(F.floor(x * F.lit(1000).cast("float"))) % 256)
    h = table(s, d, "embeddings").select("vec_id", cluster.channel_histogram(p).alias("h"))
    return h.select("vec_id", F.get("h", F.lit(0)).alias("first_bin"), F.get("h", F.lit(15)).alias("last_bin"))


@query("st11_url_changes", "select event_type, user_id, min(event_id) as first_seen, count(*) as times from events group by 1, 2")
def _(s, d):
    return table(s, d, "events").groupBy("event_type", "user_id").agg(F.min("event_id").alias("first_seen"), F.count(F.lit(1)).alias("times"))


@query("sk22_page_texts", "select conv_id, string_agg(text, chr(10) || '=====' || chr(10) order by turn, text) as text from conversations group by 1 having count(*) = count(text)")
def _(s, d):
    return sinks.joined_pages(table(s, d, "conversations"), "conv_id", "turn", "\n=====\n")


@query("sk8_facts", "select doc_id, quality, 'score' as fact from labels union all select doc_id, toxic, 'toxic' from labels")
def _(s, d):
    l = table(s, d, "labels")
    return l.select("doc_id", "quality", F.lit("score").alias("fact")).union(l.select("doc_id", "toxic", F.lit("toxic")))
