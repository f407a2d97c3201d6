"""Joins, mutations, windows, samples and graphs."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.nulls import count_if
from ..operators import catalog as C
from ..operators import graph as G
from ..operators import mutations as M
from ..operators import sampling as P
from ..operators import windows as X
from ..sources.tables import CATALOG_SQL, catalog, table
from .catalog_queries import FAILED_SQL, failed_items
from .registry import query

W = f"with {CATALOG_SQL} "


@query("j1_inner", W + "select c.slug, l_linenumber, l_partkey from lineitem join catalog c on c.slug = 'ord-' || l_orderkey where c.local_path is null and l_quantity > 45")
def _(s, d):
    items = table(s, d, "lineitem").where("l_quantity > 45").select(F.concat(F.lit("ord-"), "l_orderkey").alias("slug"), "l_linenumber", "l_partkey")
    return items.join(catalog(s, d).where("local_path is null").select("slug"), "slug")


@query("j2_left_fan_out", f"with {FAILED_SQL} select f.event_id, f.url, o.o_orderkey from (select * from failed where retry_count = 0) f left join orders o on o.o_custkey = substr(f.url, 2)::bigint and o.o_orderstatus = 'P'")
def _(s, d):
    f = failed_items(s, d).where("retry_count = 0").select("event_id", "url", F.substring("url", 2, 20).cast("long").alias("o_custkey"))
    o = table(s, d, "orders").where("o_orderstatus = 'P'").select("o_custkey", "o_orderkey")
    return f.join(o, "o_custkey", "left").select("event_id", "url", "o_orderkey")


@query("j3_filtered_inner_top", "select d.doc_id, l.quality from documents d join labels l using (doc_id) where d.lang = 'de' order by d.doc_id limit 50")
def _(s, d):
    return table(s, d, "documents").where("lang = 'de'").select("doc_id").join(table(s, d, "labels"), "doc_id").orderBy("doc_id").limit(50).select("doc_id", "quality")


@query("j4_left", "select d.doc_id, l.quality, l.toxic from documents d left join labels l using (doc_id)")
def _(s, d):
    return table(s, d, "documents").select("doc_id").join(table(s, d, "labels"), "doc_id", "left")


@query("j5_ordered_inner", "select n_name, r_name, count(*) as n from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by 1, 2 order by n desc, n_name limit 10")
def _(s, d):
    c = table(s, d, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("n"))
    n = table(s, d, "nation").join(table(s, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return c.join(n, "n_nationkey").select("n_name", "r_name", "n").orderBy(F.desc("n"), "n_name").limit(10)


@query("j6_review_queue", "select l.doc_id, d.n_chars from labels l join documents d using (doc_id) where l.quality = 0 order by d.n_chars, l.doc_id limit 20")
def _(s, d):
    bad = table(s, d, "labels").where("quality = 0").select("doc_id")
    return C.top_k(table(s, d, "documents").select("doc_id", "n_chars").join(bad, "doc_id"), 20, F.asc("n_chars"), F.asc("doc_id"))


@query("j7_composite_key", "select l1.l_orderkey, l1.l_linenumber, l2.l_extendedprice from lineitem l1 join lineitem l2 on l1.l_orderkey = l2.l_orderkey and l1.l_linenumber = l2.l_linenumber where l1.l_returnflag = 'R' and l2.l_linestatus = 'F' and l1.l_quantity > 48")
def _(s, d):
    l = table(s, d, "lineitem")
    a = l.where("l_returnflag = 'R' and l_quantity > 48").select("l_orderkey", "l_linenumber")
    b = l.where("l_linestatus = 'F'").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return a.join(b, ["l_orderkey", "l_linenumber"])


@query("j8_semi", "select p_partkey from part where exists (select 1 from lineitem where l_partkey = p_partkey and l_discount > 0.09)")
def _(s, d):
    return table(s, d, "part").select("p_partkey").join(table(s, d, "lineitem").where("l_discount > 0.09").select(F.col("l_partkey").alias("p_partkey")), "p_partkey", "left_semi")


@query("j9_anti", "select s_suppkey from supplier where not exists (select 1 from lineitem where l_suppkey = s_suppkey and l_quantity = 50 and l_returnflag = 'A')")
def _(s, d):
    l = table(s, d, "lineitem").where("l_quantity = 50 and l_returnflag = 'A'").select(F.col("l_suppkey").alias("s_suppkey"))
    return table(s, d, "supplier").select("s_suppkey").join(l, "s_suppkey", "left_anti")


@query("j10_in_subquery", "select count(*) as n from events where user_id in (select c_custkey from customer where c_acctbal < 0)")
def _(s, d):
    c = table(s, d, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("user_id"))
    return table(s, d, "events").join(c, "user_id", "left_semi").agg(F.count(F.lit(1)).alias("n"))


_RUNS = "a as (select doc_id, n_chars * 0.01::double as score from documents where doc_id % 3 <> 0), b as (select doc_id, n_chars * 0.01::double + (doc_id % 5) - 2 as score from documents where doc_id % 4 <> 0)"


@query("j11_run_comparison", f"with {_RUNS} select doc_id, case when b.score is null then 'only_baseline' when a.score is null then 'only_improved' when b.score - a.score > 0.5 then 'improved' when b.score - a.score < -0.5 then 'degraded' else 'unchanged' end as change from a full join b using (doc_id)")
def _(s, d):
    docs = table(s, d, "documents")
    a = docs.where("doc_id % 3 <> 0").select("doc_id", (F.col("n_chars") * 0.01).alias("a"))
    b = docs.where("doc_id % 4 <> 0").select("doc_id", (F.col("n_chars") * 0.01 + F.col("doc_id") % 5 - 2).alias("b"))
    diff = F.col("b") - F.col("a")
    change = F.when(F.col("b").isNull(), "only_baseline").when(F.col("a").isNull(), "only_improved").when(diff > 0.5, "improved").when(diff < -0.5, "degraded").otherwise("unchanged")
    return a.join(b, "doc_id", "full").select("doc_id", change.alias("change"))


@query("j12_mapping_join", "with m(a, b) as (values ('1-URGENT', 'BUILDING'), ('2-HIGH', 'MACHINERY'), ('3-MEDIUM', 'NONE')), x as (select o_orderpriority as a, count(*) as n_a from orders group by 1), y as (select c_mktsegment as b, count(*) as n_b from customer group by 1) select m.a, m.b, coalesce(n_a, 0) as n_a, coalesce(n_b, 0) as n_b from m left join x using (a) left join y using (b)")
def _(s, d):
    m = s.createDataFrame([("1-URGENT", "BUILDING"), ("2-HIGH", "MACHINERY"), ("3-MEDIUM", "NONE")], "a string, b string")
    x = table(s, d, "orders").groupBy(F.col("o_orderpriority").alias("a")).agg(F.count(F.lit(1)).alias("n_a"))
    y = table(s, d, "customer").groupBy(F.col("c_mktsegment").alias("b")).agg(F.count(F.lit(1)).alias("n_b"))
    return m.join(x, "a", "left").join(y, "b", "left").na.fill(0, ["n_a", "n_b"]).select("a", "b", "n_a", "n_b")


@query("j13_target_reconciliation", W + ", t(jenis, target) as (values ('1-URGENT', 4000), ('2-HIGH', 2000), ('0-NONE', 5)), g as (select jenis, count(*) as got, count(*) filter (pdf_url is null or pdf_url = 'NO_PDF') as no_pdf from catalog group by 1) select t.jenis, target, coalesce(got, 0) as got, coalesce(no_pdf, 0) as no_pdf, target - coalesce(got, 0) as diff, greatest(target - coalesce(got, 0), 0) as remaining from t left join g using (jenis)")
def _(s, d):
    t = s.createDataFrame([("1-URGENT", 4000), ("2-HIGH", 2000), ("0-NONE", 5)], "jenis string, target long")
    missing = F.col("pdf_url").isNull() | (F.col("pdf_url") == "NO_PDF")
    g = catalog(s, d).groupBy("jenis").agg(F.count(F.lit(1)).alias("got"), count_if(missing).alias("no_pdf"))
    j = t.join(g, "jenis", "left").na.fill(0, ["got", "no_pdf"])
    return j.withColumn("diff", F.col("target") - F.col("got")).withColumn("remaining", F.greatest("diff", F.lit(0)))


@query("j14_integrity_status", W + ", t(jenis, target) as (values ('1-URGENT', 100), ('2-HIGH', 3005), ('0-NONE', 50)), g as (select jenis, count(*) as got from catalog group by 1) select t.jenis, coalesce(got, 0) - target as diff, case when coalesce(got, 0) >= target then 'OK' when coalesce(got, 0) - target >= -10 then 'WARN' else 'MISSING' end as state from t left join g using (jenis)")
def _(s, d):
    t = s.createDataFrame([("1-URGENT", 100), ("2-HIGH", 3005), ("0-NONE", 50)], "jenis string, target long")
    g = catalog(s, d).groupBy("jenis").agg(F.count(F.lit(1)).alias("got"))
    diff = F.coalesce("got", F.lit(0)) - F.col("target")
    return t.join(g, "jenis", "left").select("jenis", diff.alias("diff"), F.when(diff >= 0, "OK").when(diff >= -10, "WARN").otherwise("MISSING").alias("state"))


def edges(s, d):
    """Amendment-like edges among orders."""
    o = table(s, d, "orders").where("o_orderkey % 2 = 0")
    return o.select(F.col("o_orderkey").alias("src"), (F.col("o_orderkey") / 2).cast("long").alias("dst"), F.when(F.col("o_orderkey") % 3 == 0, "AMENDS").when(F.col("o_orderkey") % 3 == 1, "REVOKES").otherwise("REFERS").alias("rel_type"))


EDGES = "edges as (select o_orderkey as src, o_orderkey // 2 as dst, case o_orderkey % 3 when 0 then 'AMENDS' when 1 then 'REVOKES' else 'REFERS' end as rel_type from orders where o_orderkey % 2 = 0)"


@query("j15_edge_endpoints", f"with {EDGES} select e.* from edges e where exists (select 1 from orders where o_orderkey = e.src) and exists (select 1 from orders where o_orderkey = e.dst)")
def _(s, d):
    return G.valid_edges(edges(s, d), table(s, d, "orders"), "o_orderkey")


@query("j16_neighbourhood", f"with {EDGES} select distinct 'out' as direction, dst as other, rel_type from edges where src = 64 union select distinct 'in', src, rel_type from edges where dst = 64")
def _(s, d):
    return G.neighbourhood(edges(s, d), 64)


@query("s1_union_distinct", f"with {EDGES} select dst as node, rel_type from edges where src % 4 = 0 union select src, rel_type from edges where dst % 4 = 0")
def _(s, d):
    e = edges(s, d)
    return e.where("src % 4 = 0").select(F.col("dst").alias("node"), "rel_type").union(e.where("dst % 4 = 0").select("src", "rel_type")).distinct()


@query("j17_missing_in_store", "select distinct l_partkey + 5 as key from lineitem where l_partkey + 5 not in (select p_partkey from part)")
def _(s, d):
    k = table(s, d, "lineitem").select((F.col("l_partkey") + 5).alias("key")).distinct()
    return k.join(table(s, d, "part").select(F.col("p_partkey").alias("key")), "key", "left_anti")


@query("j18_variable_length_path", f"with recursive {EDGES}, p(start, node, steps) as (select src, dst, 1 from edges union all select start, e.dst, steps + 1 from p join edges e on e.src = p.node where steps < 4) select start, node, min(steps)::int as steps from p where start <> node group by 1, 2")
def _(s, d):
    e = edges(s, d)
    return G.reachable(e, e.select(F.col("src").alias("start")).distinct(), 4)


@query("j19_optional_revoker", f"with {EDGES} select o_orderkey, r.src as revoker, case when r.src is null then 'in force' else 'revoked' end as state from orders left join (select dst, min(src) as src from edges where rel_type = 'REVOKES' group by 1) r on r.dst = o_orderkey")
def _(s, d):
    r = edges(s, d).where("rel_type = 'REVOKES'").groupBy(F.col("dst").alias("o_orderkey")).agg(F.min("src").alias("revoker"))
    o = table(s, d, "orders").select("o_orderkey")
    return o.join(r, "o_orderkey", "left").withColumn("state", F.when(F.col("revoker").isNull(), "in force").otherwise("revoked"))


@query("j20_probe_diff", "with c as (select page_id, url as configured from pages), p as (select page_id, case when page_id % 5 = 0 then url || '#moved' else url end as observed, case when page_id % 9 = 0 then 404 else 200 end as code from pages where page_id % 7 <> 0) select page_id, case when p.code is null then 'unprobed' when p.code = 404 then 'alias' when p.observed <> c.configured then 'changed' else 'same' end as state from c left join p using (page_id)")
def _(s, d):
    pages = table(s, d, "pages").select("page_id", "url")
    probes = pages.where("page_id % 7 <> 0").select("page_id", F.when(F.col("page_id") % 5 == 0, F.concat("url", F.lit("#moved"))).otherwise(F.col("url")).alias("observed"), F.when(F.col("page_id") % 9 == 0, 404).otherwise(200).alias("code"))
    state = F.when(F.col("code").isNull(), "unprobed").when(F.col("code") == 404, "alias").when(F.col("observed") != F.col("url"), "changed").otherwise("same")
    return pages.join(probes, "page_id", "left").select("page_id", state.alias("state"))


@query("j21_first_working_alias", "select l_orderkey, min_by(l_partkey, (l_linenumber, l_partkey)) as alias from lineitem where l_quantity >= 25 group by 1")
def _(s, d):
    return table(s, d, "lineitem").where("l_quantity >= 25").groupBy("l_orderkey").agg(F.min_by("l_partkey", F.struct("l_linenumber", "l_partkey")).alias("alias"))


@query("a32_graph_stats", f"with {EDGES} select rel_type, count(*) as n_edges, count(distinct src) as n_src, count(distinct dst) as n_dst from edges group by 1")
def _(s, d):
    return G.graph_stats(edges(s, d))


@query("t10_densest_subgraph", f"with {EDGES}, deg as (select node, count(*) as n from (select src as node from edges union all select dst from edges) group by 1), top as (select node from deg order by n desc, node limit 200) select * from edges where src in (select node from top) and dst in (select node from top)")
def _(s, d):
    return G.densest(edges(s, d), 200)


@query("sk16_graph_export", f"with {EDGES}, n as (select 'ord-' || o_orderkey as id, 0 as r from orders union all select 'ord-' || dst, 1 from edges) select id, min(r) = 0 as known from n group by 1")
def _(s, d):
    e = edges(s, d).select(F.concat(F.lit("ord-"), "src").alias("src"), F.concat(F.lit("ord-"), "dst").alias("dst"), "rel_type")
    return G.nodes_and_edges(catalog(s, d), e)[0]


# mutations: the catalog meets a newer batch of itself
_NEW = "old as (select slug, jenis, tahun, pdf_url, local_path from catalog where tahun < 1997), new as (select slug, 'new ' || jenis as jenis, tahun, case when tahun % 2 = 0 then '/new/' || slug end as pdf_url, null::varchar as local_path from catalog where tahun >= 1996)"


def _stores(s, d):
    c = catalog(s, d)
    old = c.where("tahun < 1997").select("slug", "jenis", "tahun", "pdf_url", "local_path")
    new = c.where("tahun >= 1996").select("slug", F.concat(F.lit("new "), "jenis").alias("jenis"), "tahun", F.when(F.col("tahun") % 2 == 0, F.concat(F.lit("/new/"), "slug")).alias("pdf_url"), F.lit(None).cast("string").alias("local_path"))
    return old, new


@query("sk1_upsert", W + f", {_NEW} select coalesce(n.slug, o.slug) as slug, case when n.slug is not null then n.jenis else o.jenis end as jenis, coalesce(o.tahun, n.tahun) as tahun, case when n.slug is not null then n.pdf_url else o.pdf_url end as pdf_url, coalesce(n.local_path, o.local_path) as local_path from old o full join new n on o.slug = n.slug")
def _(s, d):
    old, new = _stores(s, d)
    return M.upsert(old, new, ["slug"], keep_old=("tahun",), keep_if_null=("local_path",))


@query("sk2_upsert_counter", f"with {FAILED_SQL}, b as (select url, item_type, count(*) as n, max_by(message, (failed_at, event_id)) as message, max(failed_at) as failed_at from failed where event_id % 2 = 0 group by 1, 2), o as (select url, item_type, max(retry_count) as retry_count, min(message) as message, min(failed_at) as failed_at from failed where event_id % 2 = 1 group by 1, 2) select coalesce(o.url, b.url) as url, coalesce(o.item_type, b.item_type) as item_type, (case when o.url is not null then o.retry_count + coalesce(b.n, 0) else b.n - 1 end)::bigint as retry_count, coalesce(b.message, o.message) as message, coalesce(b.failed_at, o.failed_at) as failed_at from o full join b on o.url = b.url and o.item_type = b.item_type")
def _(s, d):
    f = failed_items(s, d)
    old = f.where("event_id % 2 = 1").groupBy("url", "item_type").agg(F.max("retry_count").alias("retry_count"), F.min("message").alias("message"), F.min("failed_at").alias("failed_at"))
    new = f.where("event_id % 2 = 0").withColumn("stamp", F.struct("failed_at", "event_id"))
    out = M.upsert_counting(old.withColumn("stamp", F.struct("failed_at", F.lit(-1).cast("long").alias("event_id"))).drop("failed_at"), new, ["url", "item_type"], "retry_count", "message", "stamp")
    return out.select("url", "item_type", F.col("retry_count").cast("long").alias("retry_count"), "message", F.col("stamp.failed_at").alias("failed_at"))


@query("sk3_preserve_non_null", W + f", {_NEW} select o.slug, coalesce(n.pdf_url, o.pdf_url) as pdf_url from old o left join new n using (slug)")
def _(s, d):
    old, new = _stores(s, d)
    keys = old.select("slug")
    return M.upsert(old.select("slug", "pdf_url"), new.join(keys, "slug", "left_semi").select("slug", "pdf_url"), ["slug"], keep_if_null=("pdf_url",))


@query("sk4_point_update", W + "select slug, case when slug = 'ord-64' then '/data/fixed.pdf' else local_path end as local_path from catalog where tahun = 1996")
def _(s, d):
    return M.update_where(catalog(s, d).where("tahun = 1996").select("slug", "local_path"), F.col("slug") == "ord-64", local_path=F.lit("/data/fixed.pdf"))


@query("sk5_delete", f"with {FAILED_SQL} select event_id from failed where url not in (select url from failed where retry_count = 4)")
def _(s, d):
    f = failed_items(s, d)
    return M.delete_keys(f, f.where("retry_count = 4"), ["url"]).select("event_id")


@query("sk6_replace", "select l_orderkey, l_suppkey, max_by(l_partkey, (l_shipdate, l_linenumber)) as l_partkey from lineitem group by 1, 2")
def _(s, d):
    rows = M.latest(table(s, d, "lineitem"), ["l_orderkey", "l_suppkey"], F.desc("l_shipdate"), F.desc("l_linenumber"))
    return rows.select("l_orderkey", "l_suppkey", "l_partkey")


@query("sk7_insert_ignore", W + f", {_NEW} select slug, jenis from old union all select slug, jenis from new where slug not in (select slug from old)")
def _(s, d):
    old, new = _stores(s, d)
    return M.insert_ignore(old.select("slug", "jenis"), new.select("slug", "jenis"), ["slug"])


@query("sk9_conditional_merge", W + f", {_NEW}, m as (select case when o.slug is null then 'inserted' when (o.pdf_url is null or o.pdf_url = 'NO_PDF') and n.pdf_url is not null and n.pdf_url not in ('', 'NO_PDF') then 'updated' else 'skipped' end as action from new n left join old o using (slug)) select action, count(*) as n from m group by 1")
def _(s, d):
    old, new = _stores(s, d)
    return M.merge_actions(old, new, "slug", "pdf_url").groupBy("action").agg(F.count(F.lit(1)).alias("n"))


@query("sk10_insert_absent", "select doc_id, 'label' as origin from labels union all select doc_id, 'document' from documents where doc_id not in (select doc_id from labels)")
def _(s, d):
    a = table(s, d, "labels").select("doc_id", F.lit("label").alias("origin"))
    return M.insert_ignore(a, table(s, d, "documents").select("doc_id", F.lit("document").alias("origin")), ["doc_id"])


@query("sk11_versioned_write", "select p_partkey, p_brand, p_partkey % 3 <> 0 as is_active, 1 as version from part union all select p_partkey, p_brand, true, 2 from part where p_partkey % 3 = 0")
def _(s, d):
    old = table(s, d, "part").select("p_partkey", "p_brand", F.lit(True).alias("is_active"), F.lit(1).alias("version"))
    new = table(s, d, "part").where("p_partkey % 3 = 0").select("p_partkey", "p_brand", F.lit(2).alias("version"))
    return M.new_version(old, new, ["p_partkey"])


@query("sk12_completed_parents", "select o_orderkey, case when o.n = c.n then 'completed' else 'partial' end as state from (select o_orderkey, 2 + o_orderkey % 4 as n from orders) o join (select l_orderkey, count(*) filter (l_linestatus = 'F') as n from lineitem group by 1) c on l_orderkey = o_orderkey")
def _(s, d):
    done = table(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(count_if(F.col("l_linestatus") == "F").alias("done"))
    want = table(s, d, "orders").select("o_orderkey", (F.lit(2) + F.col("o_orderkey") % 4).alias("n"))
    return want.join(done, "o_orderkey").select("o_orderkey", F.when(F.col("n") == F.col("done"), "completed").otherwise("partial").alias("state"))


@query("sk13_stage_advance", "select doc_id, case when doc_id in (select doc_id from labels where quality = 1) then 'scored' else 'new' end as stage from documents")
def _(s, d):
    good = table(s, d, "labels").where("quality = 1").select("doc_id", F.lit(True).alias("hit")).distinct()
    return table(s, d, "documents").join(good, "doc_id", "left").select("doc_id", F.when(F.col("hit"), "scored").otherwise("new").alias("stage"))


@query("sk20_invalidate", W + "select slug, case when local_path like '%9.pdf' then null else local_path end as local_path from catalog where local_path is not null")
def _(s, d):
    rows = catalog(s, d).where("local_path is not null").select("slug", "local_path")
    return M.update_where(rows, F.col("local_path").endswith("9.pdf"), local_path=F.lit(None).cast("string"))


@query("sk23_threshold_versions", "select doc_id, coalesce(max_by(quality, doc_id) over (partition by doc_id), 1) as threshold, true as is_current from labels")
def _(s, d):
    rows = M.latest(table(s, d, "labels"), ["doc_id"], F.desc("doc_id"))
    return rows.select("doc_id", F.coalesce("quality", F.lit(1)).alias("threshold"), F.lit(True).alias("is_current"))


@query("w1_latest_per_key", "select user_id, max_by(event_id, (ts, event_id)) as event_id from events where event_type = 'click' group by 1")
def _(s, d):
    return M.latest(table(s, d, "events").where("event_type = 'click'"), ["user_id"], F.desc("ts"), F.desc("event_id")).select("user_id", "event_id")


@query("w2_latest_per_stage", "select event_type, max(ts) as ts, max_by(event_id, (ts, event_id)) filter (value < 50) as active_id from events group by 1")
def _(s, d):
    stamp = F.struct("ts", "event_id")
    return table(s, d, "events").groupBy("event_type").agg(F.max("ts").alias("ts"), F.max_by("event_id", F.when(F.col("value") < 50, stamp)).alias("active_id"))


@query("w3_keep_first", "select text, min(doc_id) as doc_id from documents group by 1")
def _(s, d):
    return X.keep_first(table(s, d, "documents").select("text", "doc_id"), ["text"], "doc_id")


@query("w4_slices_between", "with m as (select conv_id, turn, lead(turn) over (partition by conv_id order by turn) as upto, max(turn) over (partition by conv_id) as last from conversations where role = 'user') select conv_id, turn, (coalesce(upto, last + 2) - turn)::bigint as span from m")
def _(s, d):
    c = table(s, d, "conversations").where("role = 'user'")
    w = Window.partitionBy("conv_id")
    return c.select("conv_id", "turn", (F.coalesce(F.lead("turn").over(w.orderBy("turn")), F.max("turn").over(w) + 2) - F.col("turn")).alias("span"))


@query("w5_moving_average", "with e as (select event_type, event_id, event_id % 100 as v, row_number() over (partition by event_type order by event_id) as i, count(*) over (partition by event_type) as n from events) select a.event_type, a.event_id, sum(b.v)::double / 7 as mean from e a, range(-3, 4) k(k), e b where b.event_type = a.event_type and b.i = greatest(1, least(a.n, a.i + k.k)) group by 1, 2")
def _(s, d):
    e = table(s, d, "events").select("event_type", "event_id", (F.col("event_id") % 100).alias("v"))
    return X.moving_average(e, ["event_type"], "event_id", "v").select("event_type", "event_id", "mean")


@query("w6_longest_run", "with e as (select user_id, event_id, value > 40 as hit, row_number() over (partition by user_id order by event_id) - row_number() over (partition by user_id, value > 40 order by event_id) as g from events), r as (select user_id, hit, g, count(*) as n from e group by all) select user_id, max(case when hit and n >= 3 then n else 0 end)::double / sum(n) as share from r group by 1")
def _(s, d):
    return X.longest_run(table(s, d, "events"), ["user_id"], "event_id", F.col("value") > 40, 3)


@query("w9_poll_rates", "with p as (select event_type, date_trunc('hour', ts) as hour, count(*) as n from events group by 1, 2), q as (select event_type, hour, n, n - lag(n) over (partition by event_type order by hour) as delta, (epoch(hour) - epoch(lag(hour) over (partition by event_type order by hour)))::double as seconds from p) select *, delta / nullif(seconds, 0) as rate from q")
def _(s, d):
    p = table(s, d, "events").groupBy("event_type", F.date_trunc("hour", "ts").alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    return X.rates(p, ["event_type"], "hour", "n")


@query("w10_page_of_offset", "with p as (select conv_id, turn, sum(length(text) + 1) over (partition by conv_id order by turn) as upto from conversations) select conv_id, min(turn) as page from p where upto > 300 group by 1")
def _(s, d):
    return X.page_of_offset(table(s, d, "conversations"), "conv_id", "turn", F.length("text"), 300)


@query("t7_hash_sample", "select doc_id from documents order by md5(doc_id || ':42'), doc_id limit 25")
def _(s, d):
    return P.take(table(s, d, "documents").select("doc_id"), "doc_id", 25)


@query("t8_seeded_shuffle", "select doc_id from documents where lang = 'fr' order by md5(doc_id || ':7'), doc_id limit 10")
def _(s, d):
    return P.take(table(s, d, "documents").where("lang = 'fr'").select("doc_id"), "doc_id", 10, seed=7)


@query(
    "t9_stratified_sample",
    "with d as (select doc_id, lang, case when n_chars < 1000 then 'old' when n_chars < 4000 then 'mid' else 'new' end as era, md5(doc_id || ':42') as h, case lang when 'en' then 40 when 'de' then 20 when 'fr' then 10 end as q from documents), a as (select *, row_number() over (partition by lang, era order by h, doc_id) <= floor(q * case era when 'old' then 0.1 when 'mid' then 0.2 else 0.7 end) as f from d where q is not null), b as (select *, sum(f::int) over (partition by lang) as got, row_number() over (partition by lang, f order by h, doc_id) as r from a) select doc_id, lang, era, case when f then 1 else 2 end as round from b where f or r <= q - got",
)
def _(s, d):
    era = F.when(F.col("n_chars") < 1000, "old").when(F.col("n_chars") < 4000, "mid").otherwise("new").alias("era")
    docs = table(s, d, "documents").select("doc_id", "lang", era)
    return P.stratified(docs, "doc_id", "lang", "era", {"en": 40, "de": 20, "fr": 10}, {"old": 0.1, "mid": 0.2, "new": 0.7})


@query("t11_page_picks", "select conv_id, unnest(list_distinct([0, n // 2, n - 1])) as page from (select conv_id, count(*) as n from conversations group by 1)")
def _(s, d):
    n = table(s, d, "conversations").groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    return n.select("conv_id", F.explode(P.page_picks(F.col("n"))).alias("page"))


@query("t12_anomalies", "select doc_id, abs(n_chars - 2000) as diff from documents where abs(n_chars - 2000) >= 1000 order by 2 desc, 1 limit 30")
def _(s, d):
    rows = table(s, d, "documents").select("doc_id", F.abs(F.col("n_chars") - 2000).alias("diff")).where("diff >= 1000")
    return C.top_k(rows, 30, F.desc("diff"), F.asc("doc_id"))
