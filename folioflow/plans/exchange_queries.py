"""Sources, exports and shared work: what is written is read again and compared."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..functions.text import PAGE_NOISE
from ..functions.vectorized import vectorized
from ..operators import cluster, lines, sampling
from ..sources import sinks
from ..sources.tables import CATALOG_SQL, LAWS_SQL, catalog, laws, table
from ..streaming import progress
from .registry import query

W = f"with {CATALOG_SQL} "
L = f"with {LAWS_SQL} "


@query("sc9_result_folders", "select 'r' || n_nationkey as stem, case when n_nationkey % 5 = 0 then 'human' when n_nationkey % 2 = 0 then 'llm' else 'approved' end as grade, n_nationkey::double as quality_score from nation")
def _(s, d):
    out, n = sinks.scratch(s, "results"), table(s, d, "nation")
    for folder, step in (("approved", 1), ("llm", 2), ("human", 5)):
        rows = n.where(F.col("n_nationkey") % step == 0).select(F.concat(F.lit("r"), "n_nationkey").alias("stem"), F.lit(folder).alias("grade"), F.col("n_nationkey").cast("double").alias("quality_score"))
        rows.write.partitionBy("stem").json(f"{out}/{folder}")
    return sinks.read_results(s, [f"{out}/approved", f"{out}/llm", f"{out}/human"], "grade string, quality_score double").select("stem", "grade", "quality_score")


@query("sc10_run_log", "select distinct 'u' || user_id as slug from events where event_id % 3 = 0 and event_id % 10 <> 0")
def _(s, d):
    out, e = sinks.scratch(s, "log"), F.col("event_id")
    row = F.to_json(F.struct(F.when(e % 3 == 0, "doc_done").otherwise("doc_start").alias("event"), F.concat(F.lit("u"), "user_id").alias("slug"), F.col("ts").cast("string").alias("ts")))
    table(s, d, "events").select(F.when(e % 10 == 0, F.concat(F.lit("cut off "), row)).otherwise(row).alias("value")).write.text(out)
    return sinks.completed_keys(s, out)


@query("sc11_csv_worklist", W + "select slug, pdf_url as url from catalog where pdf_url is not null and owner % 2 = 0")
def _(s, d):
    out = sinks.scratch(s, "worklist")
    catalog(s, d).select("slug", F.col("pdf_url").alias("url"), F.when(F.col("owner") % 2 == 0, "no").otherwise("yes").alias("in_db")).write.option("header", "true").csv(out)
    return sinks.read_worklist(s, out).where("in_db = 'no' and url is not null").select("slug", "url")


@query("sc17_word_list", "select distinct lower(unnest(string_split(p_name, ' '))) as word from part where p_partkey % 4 <> 0")
def _(s, d):
    out = sinks.scratch(s, "words")
    words = table(s, d, "part").select(F.explode(F.split("p_name", " ")).alias("w"), "p_partkey")
    words.select(F.when(F.col("p_partkey") % 4 == 0, F.concat(F.lit("# "), "w")).otherwise(F.concat(F.lit("  "), F.upper("w"))).alias("value")).write.text(out)
    return sinks.read_words(s, out)


@query("sc13_docx_blocks", "select n_name as name, 0 as at, 'paragraph' as kind, 'Law of ' || n_name as text from nation union all select n_name, 1, 'table', 'key|' || n_nationkey || chr(10) || 'region|' || n_regionkey from nation union all select n_name, 2, 'paragraph', 'End & close' from nation")
def _(s, d):
    return sinks.docx_blocks(table(s, d, "nation").select(F.col("n_name").alias("name"), _docx("n_name", "n_nationkey", "n_regionkey").alias("content")), "name")


@vectorized("binary")
def _docx(names: pd.Series, keys: pd.Series, regions: pd.Series) -> pd.Series:
    """Small word files: a heading, an empty paragraph, a table and an end."""
    space = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    p = lambda t: f"<w:p><w:r><w:t>{t}</w:t></w:r></w:p>"
    row = lambda *cells: "<w:tr>" + "".join(f"<w:tc>{p(c)}</w:tc>" for c in cells) + "</w:tr>"

    def made(name: str, key: int, region: int) -> bytes:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            z.writestr("word/document.xml", f"<w:document {space}><w:body><w:p><w:r><w:t>Law of </w:t></w:r><w:r><w:t>{name}</w:t></w:r></w:p><w:p/><w:tbl>{row('key', key)}{row('region', region)}</w:tbl>{p('End &amp; close')}</w:body></w:document>")
        return out.getvalue()

    return pd.Series([made(*x) for x in zip(names, keys, regions, strict=True)])


@query("sk15_metadata_export", W + "select slug, jenis, nomor, tahun, status from catalog")
def _(s, d):
    out, columns = sinks.scratch(s, "metadata"), ["slug", "jenis", "nomor", "tahun", "status"]
    rows = catalog(s, d)
    sinks.export_metadata(rows, f"{out}/json", columns)
    sinks.export_metadata(rows, f"{out}/csv", columns, "csv")
    schema = "slug string, jenis string, nomor string, tahun int, status string"
    return s.read.schema(schema).json(f"{out}/json").intersect(s.read.schema(schema).csv(f"{out}/csv", header=True))


@query("sk17_markdown_export", W + "select jenis, slug, '---' || chr(10) || 'jenis: ' || jenis || chr(10) || 'tahun: ' || tahun || coalesce(chr(10) || 'status: ' || status, '') || chr(10) || '---' || chr(10) || chr(10) || '# ' || tentang || chr(10) || chr(10) || 'Nomor ' || nomor as note from catalog")
def _(s, d):
    out = sinks.scratch(s, "notes")
    rows = sinks.markdown(catalog(s, d), F.col("tentang"), ["jenis", "tahun", "status"], F.concat(F.lit("Nomor "), "nomor"))
    sinks.export_markdown(rows, out, "jenis")
    return s.read.schema("slug string, note string, jenis string").json(out)


@query("sk18_sample_pack", W + "select slug, jenis, tahun, count(*) over (partition by jenis) as n from (select * from catalog order by md5(slug || ':7'), slug limit 200)")
def _(s, d):
    out = sinks.scratch(s, "pack")
    sinks.export_pack(sampling.take(catalog(s, d).select("slug", "jenis", "tahun"), "slug", 200, 7), out, "jenis")
    rows = s.read.schema("slug string, jenis string, tahun int").json(f"{out}/json").intersect(s.read.schema("slug string, jenis string, tahun int").csv(f"{out}/csv", header=True))
    return rows.join(s.read.schema("jenis string, n bigint").json(f"{out}/stats"), "jenis")


@query("sk21_transaction", "select n_nationkey as k, n_name || '!' as name, true as first, false as second from nation")
def _(s, d):
    out, n = sinks.scratch(s, "table"), table(s, d, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name"))
    n.write.parquet(out)
    first = sinks.committed(lambda: s.read.parquet(out).withColumn("name", F.concat("name", F.lit("!"))), out)
    broken = F.when(F.col("k") == 7, F.raise_error(F.lit("no such law"))).otherwise(F.lit("lost"))
    second = sinks.committed(lambda: s.read.parquet(out).withColumn("name", broken), out)
    return s.read.parquet(out).select("k", "name", F.lit(first).alias("first"), F.lit(second).alias("second"))


@query("pf31_failed_rows", "select o_orderkey as k, o_totalprice as error_rate from orders where o_orderkey % 7 = 0")
def _(s, d):
    out, k = sinks.scratch(s, "report"), F.col("o_orderkey")
    status = F.when(k % 7 == 0, F.when(k % 2 == 0, "FAIL").otherwise("fail")).otherwise("pass")
    table(s, d, "orders").select(k.alias("k"), F.col("o_totalprice").alias("error_rate"), status.alias("status")).write.json(out)
    return sinks.failed_rows(s, out, "k bigint, error_rate double, status string").drop("status")


@query("t13_random_claims", "select o_orderkey, md5(o_orderkey || ':5') as turn, (('0x' || substr(md5(o_orderkey || ':5'), 1, 8))::bigint % 4)::int as worker from orders")
def _(s, d):
    return progress.random_order(table(s, d, "orders").select("o_orderkey"), "o_orderkey", 4, 5)


@query("st9_stall_recovery", "with g as (select user_id, ts, epoch(ts) - epoch(lag(ts) over (partition by user_id order by ts)) as idle from (select distinct user_id, ts from events)), a as (select *, row_number() over (partition by user_id order by ts) as attempt from g where idle > 86400) select user_id, ts as at, round(idle, 3) as idle, attempt::int as attempt, case when attempt <= 3 then 'recover' else 'manual' end as action from a")
def _(s, d):
    beats = table(s, d, "events").select("user_id", F.col("ts").cast("timestamp").alias("at")).distinct()
    out = progress.recoveries(beats, "user_id", "at", 86400)
    return out.withColumns({"idle": F.round("idle", 3), "at": F.col("at").cast("timestamp_ntz")})


@query("st10_watchdog", "with h as (select event_type, date_trunc('hour', ts) as hour, count(*) filter (value > 90) as n from events group by 1, 2), p as (select event_type, hour, sum(n) over (partition by event_type order by hour)::bigint as done from h), q as (select event_type, hour, coalesce(done - lag(done) over (partition by event_type order by hour), done) as delta from p), r as (select *, sum((delta > 0)::int) over (partition by event_type order by hour) as run from q), t as (select event_type, hour, delta, (sum((delta <= 0)::int) over (partition by event_type, run order by hour))::int as stalled from r) select event_type, hour as at, delta, stalled, delta <= 0 and stalled % 2 = 0 as restart from t")
def _(s, d):
    hours = table(s, d, "events").groupBy("event_type", F.date_trunc("hour", "ts").alias("at")).agg(F.count(F.when(F.col("value") > 90, 1)).alias("n"))
    polls = hours.select("event_type", F.col("at").cast("timestamp_ntz").alias("at"), F.sum("n").over(Window.partitionBy("event_type").orderBy("at")).alias("done"))
    return progress.watchdog(polls, "event_type", "at", "done")


@query("st12_claims", "select user_id, min_by(event_type, (event_id, event_type)) as event_type from events where user_id % 3 <> 0 group by 1")
def _(s, d):
    return progress.claims(table(s, d, "events"), "user_id", "event_type", "event_id", F.col("user_id") % 3 != 0)


def _law_pages(s, d) -> DataFrame:
    """Laws as three pages with a running head."""
    head = F.concat(F.lit("LEMBAR "), "n", F.lit("\n"))
    pages = [F.concat(head, F.lit("SALINAN\n"), "head"), F.concat(head, "body", F.lit("\n\n\n\nAkhir")), F.concat(head, F.lit("- 3 -\nDitetapkan di Jakarta"))]
    return laws(s, d).select("slug", F.posexplode(F.array(*pages)).alias("page", "text"))


_CLEAN = "case page when 0 then rtrim(head, chr(10)) when 1 then rtrim(body, chr(10)) || chr(10) || chr(10) || 'Akhir' else {last} end"


@query("f13_clean_at_start", L + f"select slug, page, {_CLEAN.format(last=repr('Ditetapkan di Jakarta'))} as clean from laws, (select unnest([0, 1, 2]) as page)")
def _(s, d):
    return lines.clean_pages_at_start(_law_pages(s, d), "slug", "page", PAGE_NOISE)


@query("f17_cleaned_with_metadata", L + f"select slug, page, {_CLEAN.format(last=repr('Ditetapkan di Jakarta'))} as clean, case page when 0 then code when 1 then case when clause_at < 5 then ref_code end end as law_type, case page when 0 then n::varchar when 1 then case when clause_at < 5 then ref_number::varchar end end as nomor, case page when 0 then y when 1 then case when clause_at < 5 then ref_year end end as tahun, case page when 0 then 'POKOK ' || c end as tentang from laws, (select unnest([0, 1, 2]) as page)")
def _(s, d):
    rules = [{"kind": "exact", "pattern": "SALINAN"}, {"kind": "regex", "pattern": r"-\s*\d+\s*-"}]
    return lines.cleaned_with_metadata(_law_pages(s, d), "slug", "page", rules)


@query("a46_distributed_compare", "with p as (select item_id, text as a, regexp_replace(text, '[aeiou]', case when item_id % 3 = 0 then '' else 'e' end, 'g') as b from benchmark), r as (select item_id, levenshtein(a, b)::double / length(a) as rate from p) select item_id, round(rate, 9) as rate, case when rate <= 0.2 then 'pass' when rate <= 0.3 then 'warning' else 'fail' end as status from r")
def _(s, d):
    other = F.regexp_replace("text", F.lit("[aeiou]"), F.when(F.col("item_id") % 3 == 0, "").otherwise("e"))
    rate = text.character_error_rate(F.col("text"), other)
    return table(s, d, "benchmark").select("item_id", rate.alias("rate")).select("item_id", F.round("rate", 9).alias("rate"), _grade(F.col("rate")).alias("status"))


def _grade(rate: Column) -> Column:
    return F.when(rate <= 0.2, "pass").when(rate <= 0.3, "warning").otherwise("fail")


@query("m2_image_hashes", "select vec_id, array_to_string([array_to_string([case when embedding[r * 8 + i + 1] > embedding[r * 8 + i] then '1' else '0' end for i in range(1, 8)], '') for r in range(8)], '') as dhash from embeddings")
def _(s, d):
    return table(s, d, "embeddings").select("vec_id", cluster.row_hash(F.col("embedding"), 8).alias("dhash"))


@query("m7_main_kinds", "with n as (select lang as cluster, source as kind, count(*) as n from documents group by 1, 2) select cluster, sum(n)::bigint as size, arg_min(kind, (-n, kind)) as main_kind, max(n)::double / sum(n) as purity from n group by 1")
def _(s, d):
    return cluster.main_kinds(table(s, d, "documents").select(F.col("lang").alias("cluster"), F.col("source").alias("kind")), "cluster", "kind")
