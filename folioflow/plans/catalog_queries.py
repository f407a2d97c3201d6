"""Catalog scans, search, predicates, sorting, sets and statistics."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import legal
from ..functions.nulls import count_if, is_blank, share
from ..operators import catalog as C
from ..operators import mutations as M
from ..operators import stats as S
from ..operators import windows
from ..sources.tables import CATALOG_SQL, catalog, table
from .registry import query

W = f"with {CATALOG_SQL} "


def failed_items(spark, sf_dir):
    """Purchase events as a dead-letter queue."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.concat(F.lit("u"), F.col("user_id")).alias("url"),
        F.col("event_type").alias("item_type"),
        (F.col("event_id") % 5).cast("int").alias("retry_count"),
        F.concat(F.lit("error "), F.col("event_id") % 3).alias("message"),
        F.col("ts").alias("failed_at"),
        "event_id",
    )


FAILED_SQL = "failed as (select 'u' || user_id as url, event_type as item_type, (event_id % 5)::int as retry_count, 'error ' || (event_id % 3) as message, ts as failed_at, event_id from events)"


@query("sc1_point_lookup", W + "select * from catalog where slug = 'ord-32'")
def _(s, d):
    return catalog(s, d).where(F.col("slug") == "ord-32")


@query("sc2_filtered_scan", W + "select slug, jenis, tahun, nomor from catalog where jenis = '1-URGENT' and pdf_url is not null order by tahun desc, nomor, slug limit 50 offset 10")
def _(s, d):
    rows = catalog(s, d).where((F.col("jenis") == "1-URGENT") & F.col("pdf_url").isNotNull())
    return rows.orderBy(*C.ordering("year_desc")).offset(10).limit(50).select("slug", "jenis", "tahun", "nomor")


@query("sc3_count", W + "select count(*) as n from catalog where jenis = '2-HIGH'")
def _(s, d):
    return catalog(s, d).where("jenis = '2-HIGH'").agg(F.count(F.lit(1)).alias("n"))


@query("sc4_retry_queue", f"with {FAILED_SQL} select url, item_type, retry_count, failed_at, event_id from failed where item_type = (select min(item_type) from failed) and retry_count < 3 order by failed_at, url, event_id limit 40")
def _(s, d):
    f = failed_items(s, d)
    first = f.agg(F.min("item_type").alias("item_type"))
    mine = f.join(F.broadcast(first), "item_type")
    return mine.where("retry_count < 3").orderBy("failed_at", "url", "event_id").limit(40).select("url", "item_type", "retry_count", "failed_at", "event_id")


@query("sc5_pending", "select doc_id from documents where length(text) > 100 and doc_id not in (select doc_id from labels)")
def _(s, d):
    return C.pending(table(s, d, "documents").where(F.length("text") > 100), table(s, d, "labels"), "doc_id").select("doc_id")


@query("sc6_shard_scan", "with f as (select url, row_number() over (order by url) - 1 as i from (select distinct url from pages) where url not like '%page=%') select url from f where i % 4 = 1")
def _(s, d):
    return C.shard(table(s, d, "pages").select("url").distinct(), "url", 1, 4, "page=")


@query("sc12_cross_store_scan", "select 'orders' as store, count(*) as n from orders union all select 'documents', count(*) from documents")
def _(s, d):
    return table(s, d, "orders").agg(F.lit("orders").alias("store"), F.count(F.lit(1)).alias("n")).unionByName(table(s, d, "documents").agg(F.lit("documents").alias("store"), F.count(F.lit(1)).alias("n")))


@query("sc14_column_scan", "select * from (values ('c_custkey', 1), ('c_name', 2), ('c_nationkey', 3), ('c_acctbal', 4), ('c_mktsegment', 5)) v(name, position)")
def _(s, d):
    fields = table(s, d, "customer").schema.names
    return s.createDataFrame([(n, i + 1) for i, n in enumerate(fields)], "name string, position int")


@query("sc15_path_choice", W + "select slug, coalesce(local_path, pdf_url) as path from catalog where local_path is not null or (pdf_url is not null and pdf_url <> 'NO_PDF')")
def _(s, d):
    rows = catalog(s, d).where("local_path is not null or (pdf_url is not null and pdf_url <> 'NO_PDF')")
    return rows.select("slug", F.coalesce("local_path", "pdf_url").alias("path"))


@query("sc16_rule_scan", "select p_partkey, p_brand, p_size from part where p_size <= 10 and (p_brand = 'Brand#1' or p_partkey % 3 = 0) order by p_size desc, p_partkey limit 100")
def _(s, d):
    return table(s, d, "part").where("p_size <= 10 and (p_brand = 'Brand#1' or p_partkey % 3 = 0)").orderBy(F.desc("p_size"), "p_partkey").limit(100).select("p_partkey", "p_brand", "p_size")


@query("pf1_search", W + "select slug, tahun, status from catalog where tentang ilike '%HIGH order%' and tahun between 1993 and 1996 and local_path is not null and local_path <> '' and status ilike '%berlaku%' and not status ilike '%tidak%'")
def _(s, d):
    return C.search(catalog(s, d), C.Search(text="HIGH order", year_from=1993, year_to=1996, has_pdf=True, active=True)).select("slug", "tahun", "status")


@query("pf2_cli_search", W + "select slug, jenis from catalog where jenis = '5-LOW' and status = 'Tidak Berlaku' and tahun = 1997")
def _(s, d):
    return C.search(catalog(s, d), C.Search(kind="5-low", year=1997, active=False, exact_status=True)).select("slug", "jenis")


@query("pf3_api_search", W + ", hit as (select slug, tahun, nomor from catalog where tentang ilike '%customer 1%' and tahun = 1995 order by tahun desc, nomor, slug limit 20) select *, count(*) over () as total from hit")
def _(s, d):
    hit = C.search(catalog(s, d), C.Search(text="customer 1", year=1995)).orderBy(*C.ordering("year_desc")).limit(20).select("slug", "tahun", "nomor")
    return hit.withColumn("total", F.count(F.lit(1)).over(Window.partitionBy()))


@query("pf4_year_range", W + "select jenis, count(*) as n from catalog where tahun between 1994 and 1996 group by 1")
def _(s, d):
    a, b = C.parse_years("1994-1996")
    return catalog(s, d).where(F.col("tahun").between(a, b)).groupBy("jenis").agg(F.count(F.lit(1)).alias("n"))


@query("pf5_membership", W + "select count(*) as n from catalog where jenis in ('1-URGENT', '2-HIGH')")
def _(s, d):
    return catalog(s, d).where(F.col("jenis").isin("1-URGENT", "2-HIGH")).agg(F.count(F.lit(1)).alias("n"))


@query("pf6_negated_prefixes", W + "select distinct jenis from catalog where jenis not like '1%' and jenis not like '5%'")
def _(s, d):
    return catalog(s, d).where(~F.col("jenis").startswith("1") & ~F.col("jenis").startswith("5")).select("jenis").distinct()


@query("pf7_exists", "select count(*) as n, sum(o_custkey)::bigint as keys from orders o where exists (select 1 from lineitem l where l.l_orderkey = o.o_orderkey and l.l_quantity > 49)")
def _(s, d):
    big = table(s, d, "lineitem").where("l_quantity > 49").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(s, d, "orders").join(big, "o_orderkey", "left_semi").agg(F.count(F.lit(1)).alias("n"), F.sum("o_custkey").alias("keys"))


@query("pf8_not_exists", "select c_custkey from customer c where not exists (select 1 from orders o where o.o_custkey = c.c_custkey)")
def _(s, d):
    return table(s, d, "customer").join(table(s, d, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti").select("c_custkey")


@query("pf9_not_exists_distinct", "select distinct e.user_id from events e where not exists (select 1 from events f where f.user_id = e.user_id and f.value > 95)")
def _(s, d):
    e = table(s, d, "events")
    return e.select("user_id").distinct().join(e.where("value > 95").select("user_id"), "user_id", "left_anti")


@query("pf10_scalar_subquery", "select n_name, (select count(*) from supplier where s_nationkey = n_nationkey) as n_suppliers from nation")
def _(s, d):
    n = table(s, d, "supplier").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("k"))
    return table(s, d, "nation").join(n, "n_nationkey", "left").select("n_name", F.coalesce("k", F.lit(0).cast("long")).alias("n_suppliers"))


@query("pf11_coalesce", W + "select slug, coalesce(local_path, pdf_url, 'none') as place from catalog")
def _(s, d):
    return catalog(s, d).select("slug", F.coalesce("local_path", "pdf_url", F.lit("none")).alias("place"))


@query("pf12_status_case", W + "select case when status ilike '%tidak berlaku%' or status ilike '%dicabut%' then 'inactive' when status ilike '%berlaku%' then 'active' when status is null or status = '' then 'unknown' else 'other' end as state, count(*) as n from catalog group by 1")
def _(s, d):
    return catalog(s, d).groupBy(legal.status_class(F.col("status")).alias("state")).agg(F.count(F.lit(1)).alias("n"))


_ERA = "case when {0} is null then 'unknown' when {0} < 1960 then 'before 1960' when {0} < 1980 then '1960-1979' when {0} < 2000 then '1980-1999' when {0} < 2010 then '2000-2009' when {0} < 2020 then '2010-2019' else '2020 on' end"


@query("pf13_era_bucket", W + f"select {_ERA.format('tahun')} as era, count(*) as n from catalog group by 1")
def _(s, d):
    return catalog(s, d).groupBy(S.era(F.col("tahun")).alias("era")).agg(F.count(F.lit(1)).alias("n"))


@query("pf14_length_bucket", "select case when length(text) < 5000 then 'under 5k' when length(text) < 20000 then '5k-20k' when length(text) < 50000 then '20k-50k' when length(text) < 100000 then '50k-100k' else '100k and more' end as bucket, count(*) as n from documents group by 1")
def _(s, d):
    return table(s, d, "documents").groupBy(S.length_bucket(F.length("text")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query("pf15_era_three_bands", "select case when y is null then 'unknown' when y < 1990 then 'old' when y < 2010 then 'middle' else 'recent' end as era, count(*) as n from (select 1940 + (p_partkey % 90) as y from part) group by 1")
def _(s, d):
    y = (F.lit(1940) + F.col("p_partkey") % 90).alias("y")
    return table(s, d, "part").select(y).groupBy(legal.era_three(F.col("y")).alias("era")).agg(F.count(F.lit(1)).alias("n"))


@query("pf16_era_four_bands", "select case when y is null then 'unknown' when y < 1970 then 'before 1970' when y < 1990 then '1970-1989' when y < 2010 then '1990-2009' else '2010 on' end as era, count(*) as n from (select 1940 + (p_partkey % 90) as y from part) group by 1")
def _(s, d):
    y = (F.lit(1940) + F.col("p_partkey") % 90).alias("y")
    return table(s, d, "part").select(y).groupBy(legal.era_four(F.col("y")).alias("era")).agg(F.count(F.lit(1)).alias("n"))


@query("pf26_prefix_counts", "select count(*) filter (url like 'https://%') as https, count(*) filter (url like 'http://%') as http, count(*) filter (url like 'https://blog.%') as blogs from pages")
def _(s, d):
    u = F.col("url")
    return table(s, d, "pages").agg(count_if(u.startswith("https://")).alias("https"), count_if(u.startswith("http://")).alias("http"), count_if(u.startswith("https://blog.")).alias("blogs"))


@query("pf28_download_status", W + "select count(*) filter (local_path is not null and local_path <> '') as downloaded, count(*) filter (pdf_url is not null and pdf_url not in ('', 'NO_PDF') and (local_path is null or local_path = '')) as pending, count(*) filter (pdf_url is null or pdf_url in ('', 'NO_PDF')) as no_pdf, count(*) filter (local_path is not null and local_path <> '') * 100.0::double / count(*) as pct from catalog")
def _(s, d):
    got, url = ~is_blank("local_path"), ~is_blank("pdf_url") & (F.col("pdf_url") != "NO_PDF")
    n = F.count(F.lit(1))
    return catalog(s, d).agg(count_if(got).alias("downloaded"), count_if(url & ~got).alias("pending"), count_if(~url | is_blank("pdf_url")).alias("no_pdf"), S.percent_of(count_if(got), n).alias("pct"))


@query("t1_multi_key_sort", W + "select slug, tahun, nomor from catalog order by tahun desc, nomor, slug limit 100")
def _(s, d):
    return catalog(s, d).orderBy(F.desc("tahun"), F.asc("nomor"), F.asc("slug")).limit(100).select("slug", "tahun", "nomor")


for _name, _order in {"year_desc": "tahun desc, nomor", "year_asc": "tahun, nomor", "type": "jenis, tahun desc", "title": "tentang"}.items():
    query(f"t2_order_{_name}", W + f"select slug, tahun from catalog order by {_order}, slug limit 30")(lambda s, d, n=_name: catalog(s, d).orderBy(*C.ordering(n)).limit(30).select("slug", "tahun"))


@query("t3_page", W + ", hit as (select * from catalog where status = 'Berlaku'), n as (select count(*) as total, ceil(count(*) / 20.0)::bigint as total_pages from hit) select p.slug, n.total, n.total_pages from (select slug from hit order by tahun desc, nomor, slug limit 20 offset 40) p, n")
def _(s, d):
    rows = catalog(s, d).where("status = 'Berlaku'")
    return C.page(rows, C.ordering("year_desc"), 3, 20).select("slug").join(F.broadcast(C.page_counts(rows, 20)))


@query("t4_last_page", "select greatest(ceil(count(*) / 20.0), 1)::bigint as last_page from orders")
def _(s, d):
    return C.page_counts(table(s, d, "orders"), 20).select(F.col("total_pages").alias("last_page"))


@query("t5_top_k", W + "select pemrakarsa, count(*) as n from catalog where pemrakarsa <> '' group by 1 order by n desc, pemrakarsa limit 20")
def _(s, d):
    n = catalog(s, d).where(~is_blank("pemrakarsa")).groupBy("pemrakarsa").agg(F.count(F.lit(1)).alias("n"))
    return C.top_k(n, 20, F.desc("n"), F.asc("pemrakarsa"))


@query("t6_worst_k", "select c_custkey, c_acctbal from customer where c_mktsegment = 'BUILDING' order by c_acctbal, c_custkey limit 25")
def _(s, d):
    return C.top_k(table(s, d, "customer").where("c_mktsegment = 'BUILDING'").select("c_custkey", "c_acctbal"), 25, F.asc("c_acctbal"), F.asc("c_custkey"))


@query("s2_distinct", W + "select distinct jenis from catalog")
def _(s, d):
    return catalog(s, d).select("jenis").distinct()


@query("s3_count_distinct", W + "select count(distinct pemrakarsa) as n from catalog")
def _(s, d):
    return catalog(s, d).agg(F.countDistinct("pemrakarsa").alias("n"))


@query("s4_key_sets", "with a as (select distinct doc_id from documents where doc_id % 2 = 0), b as (select distinct doc_id from labels), i as (select doc_id from a intersect select doc_id from b) select 'both' as side, count(*) as n from i union all select 'first', count(*) from (select doc_id from a except select doc_id from b) union all select 'second', count(*) from (select doc_id from b except select doc_id from a)")
def _(s, d):
    a, b = table(s, d, "documents").where("doc_id % 2 = 0").select("doc_id"), table(s, d, "labels").select("doc_id")
    count = lambda df, side: df.agg(F.lit(side).alias("side"), F.count(F.lit(1)).alias("n"))
    return count(a.intersect(b), "both").union(count(a.subtract(b), "first")).union(count(b.subtract(a), "second"))


@query("s5_missing_years", "with y as (select distinct (l_suppkey * 3)::int as y from lineitem) select g::int as y from (select unnest(generate_series((select min(y) from y), (select max(y) from y))) as g) where g not in (select y from y)")
def _(s, d):
    return S.missing_years(table(s, d, "lineitem").select((F.col("l_suppkey") * 3).cast("int").alias("y")), "y")


@query("s7_tagged_union", W + "select 'first' as origin, slug from catalog where jenis = '1-URGENT' union all select 'second', slug from catalog where tahun = 1998")
def _(s, d):
    c = catalog(s, d)
    return c.where("jenis = '1-URGENT'").select(F.lit("first").alias("origin"), "slug").unionByName(c.where("tahun = 1998").select(F.lit("second").alias("origin"), "slug"))


@query("s9_tag_sets", "select user_id, array_to_string(list_sort(list_distinct(list(event_type))), ',') as tags from events group by 1")
def _(s, d):
    return table(s, d, "events").groupBy("user_id").agg(F.array_join(F.array_sort(F.collect_set("event_type")), ",").alias("tags"))


@query("a1_counts_by_type", W + "select jenis, count(*) as n from catalog group by 1")
def _(s, d):
    return catalog(s, d).groupBy("jenis").agg(F.count(F.lit(1)).alias("n"))


@query("a2_type_distribution", W + "select jenis, count(*) as total, count(*) filter (status = 'Berlaku') as active, count(*) filter (status = 'Tidak Berlaku') as inactive, count(*) * 100.0::double / sum(count(*)) over () as pct, count(*) filter (status = 'Berlaku') * 100.0::double / count(*) as active_rate, count(*) filter (status = 'Tidak Berlaku') * 100.0::double / count(*) as inactive_rate from catalog group by 1")
def _(s, d):
    return S.distribution(catalog(s, d), "jenis", active=F.col("status") == "Berlaku", inactive=F.col("status") == "Tidak Berlaku")


@query("a3_year_histogram", W + ", y as (select tahun, count(*) as n from catalog group by 1) select tahun, n, (floor(tahun / 10) * 10)::int as decade, sum(n) over (partition by floor(tahun / 10))::bigint as decade_n, (max(tahun) over () - min(tahun) over () + 1)::int as span from y")
def _(s, d):
    y = catalog(s, d).groupBy("tahun").agg(F.count(F.lit(1)).alias("n")).withColumn("decade", (F.floor(F.col("tahun") / 10) * 10).cast("int"))
    everything = Window.partitionBy()
    return y.withColumn("decade_n", F.sum("n").over(Window.partitionBy("decade"))).withColumn("span", (F.max("tahun").over(everything) - F.min("tahun").over(everything) + 1).cast("int"))


@query("a4_agency_coverage", W + "select count(distinct pemrakarsa) filter (pemrakarsa <> '') as agencies, count(*) filter (pemrakarsa is not null and pemrakarsa <> '') * 100.0::double / count(*) as coverage from catalog")
def _(s, d):
    named = ~is_blank("pemrakarsa")
    return catalog(s, d).agg(F.countDistinct(F.when(named, F.col("pemrakarsa"))).alias("agencies"), S.percent_of(count_if(named), F.count(F.lit(1))).alias("coverage"))


_FIELDS = ["slug", "status", "pemrakarsa", "pdf_url", "local_path"]


@query(
    "a5_completeness",
    W + " union all ".join(f"select '{c}' as field, count(*) filter ({c} is not null and {c} <> '') as filled, count(*) filter ({c} is null or {c} = '') as blank, count(distinct {c}) as n_distinct, count(*) filter ({c} is not null and {c} <> '') * 100.0::double / count(*) as pct, case when count(*) filter ({c} is not null and {c} <> '') * 100.0 / count(*) >= 99 then 'complete' when count(*) filter ({c} is not null and {c} <> '') * 100.0 / count(*) >= 50 then 'partial' else 'sparse' end as band from catalog" for c in _FIELDS),
)
def _(s, d):
    return S.completeness(catalog(s, d), _FIELDS)


@query("a6_availability", W + "select jenis, count(*) as total, count(*) filter (pdf_url is not null and pdf_url <> '') as with_url, count(*) filter (local_path is not null) as with_file from catalog group by 1")
def _(s, d):
    return catalog(s, d).groupBy("jenis").agg(F.count(F.lit(1)).alias("total"), count_if(~is_blank("pdf_url")).alias("with_url"), count_if(F.col("local_path").isNotNull()).alias("with_file"))


@query("a7_status_by_type", W + "select jenis, case when status ilike '%tidak berlaku%' or status ilike '%dicabut%' then 'inactive' when status ilike '%berlaku%' then 'active' when status is null or status = '' then 'unknown' else 'other' end as state, count(*) as n from catalog group by 1, 2")
def _(s, d):
    return catalog(s, d).groupBy("jenis", legal.status_class(F.col("status")).alias("state")).agg(F.count(F.lit(1)).alias("n"))


@query("a8_cross_source", "with a as (select c_nationkey as k, count(*) as a from customer group by 1), b as (select s_nationkey as k, count(*) as b from supplier group by 1) select k, coalesce(a, 0) as a, coalesce(b, 0) as b, abs(coalesce(a, 0) - coalesce(b, 0))::double / greatest(coalesce(a, 0), coalesce(b, 0), 1) as diff from a full join b using (k)")
def _(s, d):
    a = table(s, d, "customer").groupBy(F.col("c_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("a"))
    b = table(s, d, "supplier").groupBy(F.col("s_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("b"))
    j = a.join(b, "k", "full").na.fill(0, ["a", "b"])
    return j.withColumn("diff", F.abs(F.col("a") - F.col("b")) / F.greatest("a", "b", F.lit(1)))


@query("a10_failures_top", f"with {FAILED_SQL} select item_type, message, count(*) as n from failed group by 1, 2 order by n desc, item_type, message limit 10")
def _(s, d):
    n = failed_items(s, d).groupBy("item_type", "message").agg(F.count(F.lit(1)).alias("n"))
    return C.top_k(n, 10, F.desc("n"), F.asc("item_type"), F.asc("message"))


@query("a11_category_stats", W + "select count(*) as total, count(*) filter (jenis like '1%' or jenis like '2%') as urgent, count(*) filter (jenis like '5%') as low from catalog")
def _(s, d):
    j = F.col("jenis")
    return catalog(s, d).agg(F.count(F.lit(1)).alias("total"), count_if(j.startswith("1") | j.startswith("2")).alias("urgent"), count_if(j.startswith("5")).alias("low"))


@query("a12_tier_stats", "select quality, count(*) as n, avg(n_chars) as mean_chars, count(*) filter (toxic = 1) as n_toxic from labels join documents using (doc_id) group by 1")
def _(s, d):
    return table(s, d, "labels").join(table(s, d, "documents").select("doc_id", "n_chars"), "doc_id").groupBy("quality").agg(F.count(F.lit(1)).alias("n"), F.avg("n_chars").alias("mean_chars"), count_if(F.col("toxic") == 1).alias("n_toxic"))


@query("a13_conditional_mean", "select avg(case when o_orderstatus = 'F' then o_custkey end) as mean_owner, count(*) filter (o_orderstatus = 'F') as n from orders")
def _(s, d):
    done = F.col("o_orderstatus") == "F"
    return table(s, d, "orders").agg(F.avg(F.when(done, F.col("o_custkey"))).alias("mean_owner"), count_if(done).alias("n"))


@query("a14_page_rollup", "select conv_id, string_agg('[' || turn || ' ' || role || ']' || chr(10) || text, chr(10) || chr(10) order by turn, role, text) as body, count(*) as n_turns, avg(case when length(text) > 0 then length(text) end) as mean_len from conversations group by 1")
def _(s, d):
    part = F.concat(F.lit("["), F.col("turn"), F.lit(" "), F.col("role"), F.lit("]\n"), F.col("text"))
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", "text", part.alias("part"))))
    return table(s, d, "conversations").groupBy("conv_id").agg(F.array_join(F.transform(ordered, lambda x: x["part"]), "\n\n").alias("body"), F.count(F.lit(1)).alias("n_turns"), F.avg(F.when(F.length("text") > 0, F.length("text"))).alias("mean_len"))


@query("a15_two_level_counts", "select lang, source, count(*) as n from documents group by 1, 2")
def _(s, d):
    return table(s, d, "documents").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))


@query("a16_structure_stats", "select lang, sum(n_lines)::bigint as n_lines, avg(n_lines) as mean_lines, max(n_lines)::bigint as most, count(*) filter (n_lines > 1) as with_lines from (select lang, length(text) - length(replace(text, chr(10), '')) + 1 as n_lines from documents) group by 1")
def _(s, d):
    n = (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines")
    return table(s, d, "documents").select("lang", n).groupBy("lang").agg(F.sum("n_lines").alias("n_lines"), F.avg("n_lines").alias("mean_lines"), F.max("n_lines").alias("most"), count_if(F.col("n_lines") > 1).alias("with_lines"))


@query("a17_type_era", W + f"select jenis, {_ERA.format('tahun')} as era, count(*) as n, max(tahun)::int as last from catalog group by 1, 2")
def _(s, d):
    return catalog(s, d).groupBy("jenis", S.era(F.col("tahun")).alias("era")).agg(F.count(F.lit(1)).alias("n"), F.max("tahun").alias("last"))


_PATTERNS = ["license", "the", "und", "@", "http", "idiot"]


@query("a18_pattern_frequency", " union all ".join(f"select '{p}' as pattern, count(*) filter (text ilike '%{p}%') as n from documents" for p in _PATTERNS))
def _(s, d):
    one = table(s, d, "documents").agg(*[count_if(F.col("text").ilike(f"%{p}%")).alias(f"p{i}") for i, p in enumerate(_PATTERNS)])
    return one.select(F.explode(F.array(*[F.struct(F.lit(p).alias("pattern"), F.col(f"p{i}").alias("n")) for i, p in enumerate(_PATTERNS)])).alias("x")).select("x.*")


@query("a19_field_subset", W + "select count(*) as n, count(*) filter (pdf_url is not null and pdf_url <> '') as pdf_url, count(*) filter (status is not null and status <> '') as status from catalog")
def _(s, d):
    return catalog(s, d).agg(F.count(F.lit(1)).alias("n"), count_if(~is_blank("pdf_url")).alias("pdf_url"), count_if(~is_blank("status")).alias("status"))


@query("a21_run_aggregate", "select count(*) as n, count(*) filter (value > 0) as scored, median(case when value > 0 then event_id end) as median_id, min(case when value > 0 then value end) as least, max(value) as most from events")
def _(s, d):
    ok = F.col("value") > 0
    return table(s, d, "events").agg(F.count(F.lit(1)).alias("n"), count_if(ok).alias("scored"), F.percentile(F.when(ok, F.col("event_id")), F.lit(0.5)).alias("median_id"), F.min(F.when(ok, F.col("value"))).alias("least"), F.max("value").alias("most"))


@query("a22_weighted_ratio", "select l_orderkey, sum(l_linenumber * l_quantity::bigint)::bigint as weighted, sum(l_quantity::bigint)::bigint as weight, sum(l_linenumber * l_quantity::bigint)::double / sum(l_quantity::bigint) as ratio from lineitem group by 1")
def _(s, d):
    q = F.col("l_quantity").cast("long")
    weighted, weight = F.sum(F.col("l_linenumber") * q), F.sum(q)
    return table(s, d, "lineitem").groupBy("l_orderkey").agg(weighted.alias("weighted"), weight.alias("weight"), (weighted.cast("double") / weight).alias("ratio"))


@query("a23_pass_rates", "select event_type, count(*) filter (value >= 60) as passed, count(*) filter (value >= 30 and value < 60) as warned, count(*) filter (value < 30) as failed, count(*) filter (value >= 60)::double / count(*) as pass_rate from events group by 1")
def _(s, d):
    v = F.col("value")
    return table(s, d, "events").groupBy("event_type").agg(count_if(v >= 60).alias("passed"), count_if((v >= 30) & (v < 60)).alias("warned"), count_if(v < 30).alias("failed"), share(count_if(v >= 60), F.count(F.lit(1))).alias("pass_rate"))


@query("a24_pair_stats", "with p as (select abs(n_chars - length(text) * 2) as diff from documents) select count(*) as n, median(diff) as median_diff, max(diff)::bigint as most, round(stddev_samp(diff), 4) as spread from p where diff <> 0")
def _(s, d):
    diff = F.abs(F.col("n_chars") - F.length("text") * 2).alias("diff")
    return table(s, d, "documents").select(diff).where("diff <> 0").agg(F.count(F.lit(1)).alias("n"), F.percentile("diff", F.lit(0.5)).alias("median_diff"), F.max("diff").alias("most"), F.round(F.stddev_samp("diff"), 4).alias("spread"))


@query("a26_cluster_purity", "with c as (select lang, source, count(*) as n from documents group by 1, 2), t as (select lang, sum(n)::bigint as total, max(n) as top_n, min_by(source, (-n, source)) as top_source from c group by 1) select lang, total, top_n, top_source, top_n::double / total as purity from t")
def _(s, d):
    c = table(s, d, "documents").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    t = c.groupBy("lang").agg(F.sum("n").alias("total"), F.max("n").alias("top_n"), F.min_by("source", F.struct(-F.col("n"), F.col("source"))).alias("top_source"))
    return t.withColumn("purity", F.col("top_n").cast("double") / F.col("total"))


@query("a27_cluster_build", "with r as (select lang, source, doc_id, row_number() over (partition by lang order by doc_id) as i from documents) select lang, count(*) as size, string_agg(doc_id::varchar, ',' order by doc_id) filter (i <= 5) as samples from r group by 1")
def _(s, d):
    docs = table(s, d, "documents")
    first = windows.first_of_each(docs.select("lang", "doc_id"), ["lang"], 5, F.col("doc_id"))
    samples = first.groupBy("lang").agg(F.array_join(F.transform(F.array_sort(F.collect_list("doc_id")), lambda x: x.cast("string")), ",").alias("samples"))
    return docs.groupBy("lang").agg(F.count(F.lit(1)).alias("size")).join(samples, "lang")


@query("a30_issue_histogram", "with i as (select unnest(list_filter([case when length(text) < 500 then 'short' end, case when n_chars > 5000 then 'long' end, case when text like '%!!%' then 'loud' end], lambda x: x is not null)) as issue from documents) select issue, count(*) as n from i group by 1")
def _(s, d):
    issues = F.array_compact(F.array(F.when(F.length("text") < 500, "short"), F.when(F.col("n_chars") > 5000, "long"), F.when(F.col("text").contains("!!"), "loud")))
    return table(s, d, "documents").select(F.explode(issues).alias("issue")).groupBy("issue").agg(F.count(F.lit(1)).alias("n"))


@query("a33_stage_totals", "select role, count(*) as n, count(distinct conv_id) as conversations, sum(length(text))::bigint as chars from conversations group by 1")
def _(s, d):
    return table(s, d, "conversations").groupBy("role").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("conv_id").alias("conversations"), F.sum(F.length("text")).alias("chars"))


@query("a34_parsed_share", "select source, count(*) as n, count(l.doc_id) as labelled, count(l.doc_id)::double / count(*) as share from documents d left join labels l using (doc_id) group by 1")
def _(s, d):
    l = table(s, d, "labels").select("doc_id", F.lit(1).alias("l"))
    return table(s, d, "documents").join(l, "doc_id", "left").groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count("l").alias("labelled"), share(F.count("l"), F.count(F.lit(1))).alias("share"))


@query("a35_run_stats", "select lang, avg(n_chars) as mean_chars, count(*) filter (n_chars < 100) as tiny, count(*) as n from documents group by 1")
def _(s, d):
    return table(s, d, "documents").groupBy("lang").agg(F.avg("n_chars").alias("mean_chars"), count_if(F.col("n_chars") < 100).alias("tiny"), F.count(F.lit(1)).alias("n"))


@query("a38_completion_vs_known", "with known(k, total) as (values ('1-URGENT', 4000), ('2-HIGH', 3500), ('9-NONE', 10)), n as (select o_orderpriority as k, count(*) as n from orders group by 1) select known.k, total, coalesce(n.n, 0) as done, coalesce(n.n, 0) * 100.0::double / total as pct from known left join n on n.k = known.k")
def _(s, d):
    known = s.createDataFrame([("1-URGENT", 4000), ("2-HIGH", 3500), ("9-NONE", 10)], "k string, total int")
    n = table(s, d, "orders").groupBy(F.col("o_orderpriority").alias("k")).agg(F.count(F.lit(1)).alias("done"))
    return known.join(n, "k", "left").na.fill(0, ["done"]).withColumn("pct", F.col("done") * 100.0 / F.col("total"))


@query("a39_text_lengths", "select min(length(text))::bigint as least, max(length(text))::bigint as most, avg(length(text)) as mean, sum(length(text))::bigint as total from documents")
def _(s, d):
    n = F.length("text").cast("long")
    return table(s, d, "documents").agg(F.min(n).alias("least"), F.max(n).alias("most"), F.avg(n).alias("mean"), F.sum(n).alias("total"))


@query("a40_stage_percentages", "select count(*) filter (quality = 1) * 100.0::double / count(*) as auto_pct, count(*) filter (quality = 0 and toxic = 0) * 100.0::double / count(*) as llm_pct, count(*) filter (quality = 0 and toxic = 1) * 100.0::double / count(*) as human_pct, count(*) filter (quality = 1 or toxic = 0) * 100.0::double / count(*) as automation_pct from labels")
def _(s, d):
    q, t, n = F.col("quality"), F.col("toxic"), F.count(F.lit(1))
    auto, llm, human = count_if(q == 1), count_if((q == 0) & (t == 0)), count_if((q == 0) & (t == 1))
    return table(s, d, "labels").agg(S.percent_of(auto, n).alias("auto_pct"), S.percent_of(llm, n).alias("llm_pct"), S.percent_of(human, n).alias("human_pct"), S.percent_of(auto + llm, n).alias("automation_pct"))


@query("a42_pipeline_snapshot", "select lang, count(*) filter (bucket = 'a') as a, count(*) filter (bucket = 'b') as b, count(*) filter (bucket = 'c') as c from (select lang, case when n_chars < 1000 then 'a' when n_chars < 5000 then 'b' else 'c' end as bucket from documents) group by 1")
def _(s, d):
    bucket = F.when(F.col("n_chars") < 1000, "a").when(F.col("n_chars") < 5000, "b").otherwise("c").alias("bucket")
    return table(s, d, "documents").select("lang", bucket).groupBy("lang").pivot("bucket", ["a", "b", "c"]).agg(F.count(F.lit(1))).na.fill(0)


@query("a43_folder_rollup", "select coalesce(source, 'all') as folder, count(*) as n, sum(n_chars)::bigint as size from documents group by rollup (source)")
def _(s, d):
    return table(s, d, "documents").rollup("source").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("size")).select(F.coalesce("source", F.lit("all")).alias("folder"), "n", "size")


@query("a45_progress_report", "with known(k, total) as (values ('click', 5000), ('view', 100)), n as (select event_type as k, count(*) as done, max(ts) as last from events group by 1) select n.k, done, coalesce(total, done)::bigint as total, least(done * 100.0::double / coalesce(total, done), 100.0::double) as pct, last from n left join known using (k)")
def _(s, d):
    known = s.createDataFrame([("click", 5000), ("view", 100)], "k string, total long")
    n = table(s, d, "events").groupBy(F.col("event_type").alias("k")).agg(F.count(F.lit(1)).alias("done"), F.max("ts").alias("last"))
    total = F.coalesce("total", "done")
    return n.join(F.broadcast(known), "k", "left").select("k", "done", total.alias("total"), F.least(F.col("done") * 100.0 / total, F.lit(100.0)).alias("pct"), "last")


@query("w7_percent_of_total", "select event_type, count(*) * 100.0::double / sum(count(*)) over () as pct from events group by 1")
def _(s, d):
    n = table(s, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return n.select("event_type", (F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy())).alias("pct"))


@query("q15_threshold_calibration", "with s as (select quality, n_chars, row_number() over (partition by quality order by n_chars, doc_id) - 1 as up, row_number() over (partition by quality order by n_chars desc, doc_id) - 1 as down, count(*) over (partition by quality) as n from labels join documents using (doc_id)) select max(case when quality = 1 and up = floor(n * 0.1) then n_chars end) as high, max(case when quality = 0 and down = floor(n * 0.1) then n_chars end) as low from s")
def _(s, d):
    scored = table(s, d, "labels").join(table(s, d, "documents").select("doc_id", "n_chars"), "doc_id")
    high = S.order_statistic(scored.where("quality = 1"), "n_chars", 0.1).agg(F.max("n_chars").alias("high"))
    low = S.order_statistic(scored.where("quality = 0"), "n_chars", 0.1, descending=True).agg(F.max("n_chars").alias("low"))
    return high.join(F.broadcast(low))
