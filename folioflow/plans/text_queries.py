"""Text, quality, similarity, cluster and stream queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, extract, html, legal, quality, text
from ..operators import cluster, lines, structure
from ..sources import sinks
from ..sources.tables import table
from ..streaming import progress
from .registry import query

def _docs(s, d, *columns):
    return table(s, d, "documents").select("doc_id", *(columns or ("text",)))


@query("f5_url_slugs", "select page_id, rtrim(case when url like '%/id/%' then string_split(url, '/id/')[2] else url end, '/') as slug from pages")
def _(s, d):
    return table(s, d, "pages").select("page_id", html.slug_of(F.col("url")).alias("slug"))


@query("f4_page_links", r"select page_id, len(regexp_extract_all(html, '(?i)<a\b[^>]*\bhref\s*=\s*[\x22'']([^\x22'']*)[\x22'']', 1))::int as n_links, regexp_extract_all(html, '(?i)<a\b[^>]*\bhref\s*=\s*[\x22'']([^\x22'']*)[\x22'']', 1)[1] as first_link from pages")
def _(s, d):
    h = html.hrefs(F.col("html"))
    return table(s, d, "pages").select("page_id", F.size(h).alias("n_links"), F.get(h, F.lit(0)).alias("first_link"))


@query("pf22_link_reasons", r"with l as (select trim(unnest(regexp_extract_all(html, '(?i)<a\b[^>]*\bhref\s*=\s*[\x22'']([^\x22'']*)[\x22'']', 1))) as h from pages) select case when h = '' then 'empty' when lower(h) like 'javascript:%' then 'javascript' when h like '%#' or h like '%/id/#%' then 'hash' when h not like '%/id/%' then 'other' else 'record' end as reason, count(*) as n from l group by 1")
def _(s, d):
    links = table(s, d, "pages").select(F.explode(html.hrefs(F.col("html"))).alias("h"))
    return links.groupBy(F.coalesce(html.link_reason(F.col("h")), F.lit("record")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query("f10_normalized_lines", r"with l as (select doc_id, lower(trim(regexp_replace(unnest(string_split(text, chr(10))), '\s+', ' ', 'g'))) as k from documents) select k, count(*) as n from l where length(k) >= 4 and not regexp_matches(k, '^\d+$') group by 1 having count(*) > 1")
def _(s, d):
    keys = _docs(s, d).select(F.explode(F.split("text", "\n", -1)).alias("line")).select(text.normalize_line(F.col("line")).alias("k"))
    return keys.where("k <> ''").groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


_PAGES = r"keys as (select distinct conv_id, turn, lower(trim(regexp_replace(l, '\s+', ' ', 'g'))) as k from (select conv_id, turn, unnest(string_split(text, chr(10))) as l from conversations)), n as (select conv_id, count(*) as n_pages from conversations group by 1), hits as (select conv_id, k as line, count(*) as hits from keys where length(k) >= 4 and not regexp_matches(k, '^\d+$') group by 1, 2), rep as (select conv_id, line, hits from hits join n using (conv_id) where n_pages > 1 and hits::double / n_pages >= 0.6)"


@query("f11_repeated_lines", f"with {_PAGES} select * from rep")
def _(s, d):
    return lines.repeated_lines(table(s, d, "conversations"), "conv_id", "turn")


@query("f12_clean_pages", f"with {_PAGES}, l as (select conv_id, turn, unnest(string_split(text, chr(10))) as l, generate_subscripts(string_split(text, chr(10)), 1) as i from conversations), m as (select l.conv_id, l.turn, l.i, l.l, regexp_matches(l.l, '(?i)^\\s*-?\\s*\\d{{1,4}}\\s*-?\\s*$|^\\s*SALINAN\\s*$|^PRESIDEN$|^MENTERI$') or rep.line is not null as bad from l left join rep on rep.conv_id = l.conv_id and rep.line = lower(trim(regexp_replace(l.l, '\\s+', ' ', 'g')))) select conv_id, turn, count(*)::int as n_lines, count(*) filter (bad)::int as n_removed, coalesce(trim(string_agg(l, chr(10) order by i) filter (not bad), ' ' || chr(10)), '') as clean from m group by 1, 2")
def _(s, d):
    return lines.clean_pages(table(s, d, "conversations"), "conv_id", "turn")


@query("f14_rule_engine", "select doc_id, length(array_to_string(list_filter(string_split(text, chr(10)), lambda x: not (lower(x) like '%license%') and not starts_with(lower(trim(x, ' ')), 'is ')), chr(10))) as n from documents")
def _(s, d):
    out = lines.apply_rule(lines.apply_rule(F.col("text"), "contains", "License"), "startswith", "Is ")
    return _docs(s, d).select("doc_id", F.length(out).cast("long").alias("n"))


@query("f15_drop_frequent", "with p as (select *, row_number() over () as r, count(*) over (partition by conv_id) as n_pages from conversations), l as (select conv_id, r, n_pages, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as i from p), bad as (select conv_id, trim(line, ' ') as line from l where trim(line, ' ') <> '' group by 1, 2, n_pages having n_pages > 1 and count(distinct r)::double / n_pages >= 0.6) select p.conv_id, p.turn, case when p.text is not null then coalesce((select string_agg(l.line, chr(10) order by i) from l where l.r = p.r and not exists (select 1 from bad where bad.conv_id = l.conv_id and bad.line = trim(l.line, ' '))), '') end as clean from p")
def _(s, d):
    return lines.drop_frequent_lines(table(s, d, "conversations"), "conv_id", "turn")


@query("a28_position_frequency", "with l as (select lang, doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) - 1 as pos from documents), h as (select lang, pos::int as pos, trim(line, ' ') as line, count(*) as hits from l where trim(line, ' ') <> '' group by 1, 2, 3), r as (select *, row_number() over (partition by lang, pos order by hits desc, line)::int as rank from h) select r.* from r join (select lang, count(*) as n from documents group by 1) using (lang) where rank <= 3 and hits::double / n > 0.01")
def _(s, d):
    return lines.position_frequency(table(s, d, "documents"), "lang", share=0.01)


@query("a29_noise_frequency", "with l as (select doc_id, unnest(string_split(text, chr(10))) as line from documents) select line, count(*) as hits, count(distinct doc_id) as docs from l where trim(line, ' ') <> '' group by 1 order by docs desc, hits desc, line limit 40")
def _(s, d):
    return lines.noise_frequency(table(s, d, "documents"), "doc_id", 40)


@query("f27_hyphen_breaks", r"select doc_id, regexp_replace(text, '([[:word:]]+)-\s*\n\s*([[:word:]]+)', '\1-\2', 'g') = text as untouched from documents")
def _(s, d):
    return _docs(s, d).select("doc_id", (text.join_hyphen_breaks(F.col("text")) == F.col("text")).alias("untouched"))


@query("f28_strip_html", r"select page_id, length(regexp_replace(regexp_replace(html, '(?i)<br\s*/?>', chr(10), 'g'), '(?i)</?(?:br|p|div|span|b|i|u|strong|em)[^>]*>', '', 'g')) as n from pages")
def _(s, d):
    return table(s, d, "pages").select("page_id", F.length(text.strip_html(F.col("html"))).cast("long").alias("n"))


@query("f35_punctuation_parts", r"with w as (select unnest(regexp_split_to_array(text, '[ \t\n\x0B\f\r]+')) as w from documents) select regexp_extract(w, '^([^\p{L}\p{N}]*)(.*?)([^\p{L}\p{N}]*)$', 3) as suffix, count(*) as n from w where w <> '' group by 1")
def _(s, d):
    words = _docs(s, d).select(F.explode(F.split("text", r"\s+")).alias("w")).where("w <> ''").select(text.punctuation_parts(F.col("w")).alias("p"))
    return words.groupBy("p.suffix").agg(F.count(F.lit(1)).alias("n"))


@query("f40_slugify", r"select part.p_partkey, trim(regexp_replace(regexp_replace(lower(p_name), '[^a-z0-9\s-]', '', 'g'), '[\s-]+', '-', 'g'), '-') as slug from part")
def _(s, d):
    return table(s, d, "part").select("p_partkey", text.slugify(F.col("p_name")).alias("slug"))


@query("f42_slug_builder", "select o_orderkey, replace(lower(o_orderpriority), ' ', '-') || '-no-' || o_custkey || '-tahun-' || year(o_orderdate) as slug from orders")
def _(s, d):
    return table(s, d, "orders").select("o_orderkey", legal.slug(F.col("o_orderpriority"), F.col("o_custkey"), F.year("o_orderdate")).alias("slug"))


@query("f43_unicode_normalization")
def _(s, d):
    return _docs(s, d).select("doc_id", text.nfkc("text").alias("clean"))


@query("f44_tokens", "select doc_id, len(regexp_extract_all(lower(text), '[a-z0-9]+'))::int as n_tokens from documents")
def _(s, d):
    return _docs(s, d).select("doc_id", F.size(text.tokens(F.col("text"))).alias("n_tokens"))


@query("f45_bounded_distance", "select a.n_nationkey as a, b.n_nationkey as b, least(levenshtein(a.n_name, b.n_name), 6)::int as distance from nation a join nation b on a.n_regionkey = b.n_regionkey and a.n_nationkey < b.n_nationkey")
def _(s, d):
    n = table(s, d, "nation")
    a = n.select(F.col("n_nationkey").alias("a"), "n_regionkey", F.col("n_name").alias("x"))
    b = n.select(F.col("n_nationkey").alias("b"), "n_regionkey", F.col("n_name").alias("y"))
    return a.join(b, "n_regionkey").where("a < b").select("a", "b", text.bounded_levenshtein(F.col("x"), F.col("y"), 5).alias("distance"))


@query("f46_error_rate", "select item_id, levenshtein(a, upper(a))::double / length(a) as cer from (select item_id, regexp_replace(text, '[^a-zA-Z ]', '', 'g') as a from benchmark)")
def _(s, d):
    a = F.regexp_replace("text", "[^a-zA-Z ]", "")
    return table(s, d, "benchmark").select("item_id", text.character_error_rate(a, F.upper(a)).alias("cer"))


@query("f47_sequence_ratio")
def _(s, d):
    b = table(s, d, "benchmark")
    return b.select("item_id", text.sequence_ratio(F.col("text"), F.reverse("text")).alias("ratio"))


@query("f48_better_text", "select doc_id, case when doc_id % 3 = 0 then 'b' when doc_id % 5 = 0 then 'a' when n_chars % 2 = 1 then 'b' else 'a' end as chosen from documents")
def _(s, d):
    a = F.when(F.col("doc_id") % 3 == 0, "").otherwise("a")
    similar = F.when(F.col("doc_id") % 5 == 0, 0.95).otherwise(0.2)
    return _docs(s, d, "n_chars").select("doc_id", text.better_text(a, F.lit("b"), similar, F.lit(0), F.col("n_chars") % 2).alias("chosen"))


@query("s6_jaccard", "with t as (select item_id, list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+')) as w from benchmark) select a.item_id as a, b.item_id as b, len(list_intersect(a.w, b.w))::double / len(list_distinct(list_concat(a.w, b.w))) as similarity from t a join t b on b.item_id = a.item_id + 1")
def _(s, d):
    t = table(s, d, "benchmark").select("item_id", F.array_distinct(text.tokens(F.col("text"))).alias("w"))
    b = t.select((F.col("item_id") - 1).alias("item_id"), F.col("item_id").alias("b"), F.col("w").alias("v"))
    return t.join(b, "item_id").select(F.col("item_id").alias("a"), "b", text.jaccard(F.col("w"), F.col("v")).alias("similarity"))


@query("d6_recency", "select event_id, ts >= (select max(ts) from events) - interval 15 minutes as recent from events")
def _(s, d):
    e = table(s, d, "events")
    now = F.broadcast(e.agg(F.max("ts").alias("now")))
    return e.join(now).select("event_id", dates.is_recent(F.col("ts"), F.col("now")).alias("recent"))


@query("d7_rate_eta", "with r as (select event_type, count(*) as done, epoch(max(ts)) - epoch(min(ts)) as seconds from events group by 1) select event_type, done, round(done / (seconds / 3600), 6) as per_hour, round((20000 - done) / (done / (seconds / 3600)), 6) as eta_hours from r")
def _(s, d):
    r = table(s, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("done"), ((F.unix_micros(F.max("ts").cast("timestamp")) - F.unix_micros(F.min("ts").cast("timestamp"))) / 1e6).alias("seconds"))
    rate = F.col("done") / (F.col("seconds") / 3600)
    return r.select("event_type", "done", F.round(rate, 6).alias("per_hour"), F.round((20000 - F.col("done")) / rate, 6).alias("eta_hours"))


@query("q1_word_recognition", "with w as (select doc_id, regexp_extract_all(lower(text), '[a-z]+') as w from documents) select doc_id, case when len(w) = 0 then 0.0::double else len(list_filter(w, lambda x: (length(x) >= 3 and regexp_matches(x, '[aeiou]')) or x in (" + ", ".join(f"'{t}'" for t in quality.LEGAL_TERMS) + ")))::double / len(w) end as rate from w")
def _(s, d):
    return _docs(s, d).select("doc_id", quality.word_recognition_rate(F.col("text")).alias("rate"))


@query("q2_legal_terms", "with w as (select doc_id, regexp_extract_all(lower(text), '[a-z]+') as w from documents) select doc_id, case when len(w) = 0 then 0.0::double else len(list_filter(w, lambda x: x in (" + ", ".join(f"'{t}'" for t in quality.LEGAL_TERMS) + ")))::double / len(w) end as rate from w")
def _(s, d):
    return _docs(s, d).select("doc_id", quality.legal_term_rate(F.col("text")).alias("rate"))


# RE2 has no look-around: separators are doubled, so that each side of a run has its own
_RUNS = r"regexp_extract_all(regexp_replace(text, '([^A-Za-z0-9])', '\1\1', 'g'), '(?i)(?:^|[^a-z])([li1]{3,})(?:[^a-z]|$)', 1)"
_BROKEN_SQL = r"least(coalesce((" + " + ".join(f"coalesce(list_sum(list_transform({x}, lambda m: length(m))), 0)" for x in [
    "regexp_extract_all(text, '(?i)[bcdfghjklmnpqrstvwxyz]{4,}')",
    "regexp_extract_all(text, '(?i)\\d[O0Il]{2,}\\d')",
    "regexp_extract_all(text, '[^\\p{L}\\p{M}\\p{N}_\\s.,;:!?\\-()\\x22\\x27\\[\\]{}]{3,}')",
    _RUNS,
]) + ")::double / nullif(length(text), 0), 0), 1)"
_TERMS_SQL = "(" + ", ".join(f"'{t}'" for t in quality.LEGAL_TERMS) + ")"


@query("q3_broken_chars", f"select doc_id, round({_BROKEN_SQL}, 9) as ratio from documents")
def _(s, d):
    return _docs(s, d).select("doc_id", F.round(quality.broken_char_ratio(F.col("text")), 9).alias("ratio"))


@query("q4_q7_assessment", rf"""with w as (select doc_id, text, (doc_id % 100) / 100.0::double as confidence, regexp_extract_all(lower(text), '[a-z]+') as w, {_BROKEN_SQL} as broken,
    least(0.0::double + case when regexp_matches(text, '(?i)BAB\s+[IVX]+') then 0.15 else 0 end + case when regexp_matches(text, '(?i)Bagian\s+[\p{{L}}\p{{N}}_]') then 0.10 else 0 end + case when regexp_matches(text, '(?i)Pasal\s+\d+') then 0.25 else 0 end + case when regexp_matches(text, '\(\d+\)') then 0.20 else 0 end + case when regexp_matches(text, '(?i)[a-z]\.') then 0.10 else 0 end + case when regexp_matches(text, '(?i)Menimbang') then 0.10 else 0 end + case when regexp_matches(text, '(?i)Mengingat') then 0.10 else 0 end, 1) as structure,
    regexp_matches(text, '(?i)Pasal\s+\d+') as articles from documents),
  m as (select doc_id, confidence, broken, structure, articles, case when len(w) = 0 then 0.0 else len(list_filter(w, lambda x: (length(x) >= 3 and regexp_matches(x, '[aeiou]')) or x in {_TERMS_SQL}))::double / len(w) end as words, case when len(w) = 0 then 0.0 else len(list_filter(w, lambda x: x in {_TERMS_SQL}))::double / len(w) end as legal from w),
  s as (select *, (confidence * 0.25 + words * 0.30 + least(legal / 0.05, 1) * 0.20 + case when articles then 0.15 else 0 end) as score,
    list_filter([case when confidence < 0.50 then 'very low confidence' end, case when words < 0.40 then 'low word recognition' end, case when legal < 0.02 then 'hardly any legal terms' end, case when broken > 0.10 then 'many broken characters' end, case when not articles then 'no articles' end], lambda x: x is not null) as found from m),
  t as (select *, case when score >= 0.8 then 'high' when score >= 0.6 then 'medium' when score >= 0.4 then 'low' else 'error' end as tier from s)
  select doc_id, round(words, 9) as words, round(legal, 9) as legal, round(broken, 9) as broken, round(structure, 9) as structure, articles, confidence, round(score, 9) as score, tier, case when tier = 'error' then array_to_string(found[1:3], '; ') when tier = 'low' and len(found) >= 2 then array_to_string(found[1:2], '; ') end as reason from t""")
def _(s, d):
    c = F.col("text")
    m = _docs(s, d).select("doc_id", quality.word_recognition_rate(c).alias("words"), quality.legal_term_rate(c).alias("legal"), quality.broken_char_ratio(c).alias("broken"), quality.structure_score(c).alias("structure"), c.rlike(r"(?i)Pasal\s+\d+").alias("articles"), ((F.col("doc_id") % 100) / 100.0).alias("confidence"))
    score = quality.overall_score(F.col("confidence"), F.col("words"), F.col("legal"), F.col("articles"), F.lit(False))
    found = quality.issues(F.col("confidence"), F.col("words"), F.col("legal"), F.col("broken"), F.col("articles"))
    out = m.withColumn("score", score).withColumn("tier", quality.tier(F.col("score"))).withColumn("reason", quality.review_reason(F.col("tier"), found))
    return out.withColumns({x: F.round(x, 9) for x in ("words", "legal", "broken", "structure", "score")})


@query("q8_q9_page_scores", rf"""with p as (select conv_id, turn, text, length(text) as n, length(regexp_replace(text, '[^\p{{L}}]', '', 'g'))::double / nullif(length(text), 0) as alpha, coalesce(list_sum(list_transform(regexp_extract_all(text, '[�■□▪▫]{{2,}}|\?{{3,}}|_{{5,}}'), lambda m: length(m))), 0)::double / nullif(length(text), 0) as broken, list_filter(regexp_extract_all(replace(lower(text), '-', ' '), '[\p{{L}}\p{{M}}\p{{N}}_]+'), lambda x: regexp_matches(x, '^[a-zÀ-ɏ]{{2,}}$')) as w from conversations),
  q as (select *, case when len(w) = 0 then 0.0 else len(list_filter(w, lambda x: x in {_TERMS_SQL}))::double / len(w) end as known from p),
  r as (select *, 0.2 * alpha + 0.3 * (1 - broken) + 0.3 * known + 0.2 * least(known * 10, 1) as score from q)
  select conv_id, turn, case when coalesce(trim(text, ' '), '') = '' then 0.0 else round(score, 9) end::double as score, case when coalesce(trim(text, ' '), '') = '' or n < 5 then 'ocr' when n < 20 then case when alpha > 0.7 and broken < 0.1 then 'text' else 'hybrid' end when score >= 0.75 then 'text' when score >= 0.45 then 'hybrid' else 'ocr' end as strategy from r""")
def _(s, d):
    return table(s, d, "conversations").select("conv_id", "turn", quality.page_score(F.col("text")).alias("q")).select("conv_id", "turn", F.round("q.score", 9).alias("score"), "q.strategy")


@query("q10_validation", r"""with t as (select doc_id, text, [((doc_id * i) % 100) / 100.0::double for i in range(1, 6)] as conf, 1950 + doc_id % 80 as year, list_filter(string_split(trim(regexp_replace(regexp_replace(lower(text), '[^\p{L}\p{M}\p{N}_\s-]', ' ', 'g'), '\s+', ' ', 'g'), ' '), ' '), lambda w: length(w) > 1 and not regexp_matches(w, '^\d+$')) as w from documents),
  u as (select doc_id, year, len(w) as n, greatest(0, least(100, (conf[1] + conf[2] + conf[3] + conf[4] + conf[5]) / 5 * 100 - len(list_filter(conf, lambda x: x < 0.8)) / 5 * 10)) as c, list_sum(list_transform(w, lambda x: case when x in ('the', 'of', 'and') or regexp_matches(x, '\d') then 1.0 when length(x) >= 4 then 0.7 else 0.0 end)) as credit, len(list_distinct(list_filter(w, lambda x: x in TERMS))) as terms,
    least(len(regexp_extract_all(text, '(?im)^pasal\s+\d+')), 5) + least(len(regexp_extract_all(text, '(?m)^\(\d+\)')), 5) + least(len(regexp_extract_all(text, '(?im)^[a-z]\.')), 5) + least(len(regexp_extract_all(text, '(?im)^bab\s+[ivxlcdm]+')), 5) + least(len(regexp_extract_all(text, '(?im)^bagian\s+[\p{L}\p{M}\p{N}_]+')), 5) + least(len(regexp_extract_all(text, '(?im)^ayat\s+\(\d+\)')), 5) as marks from t),
  v as (select *, c * 0.45 + credit / n * 100 * 0.35 + least(terms / 10 * 100, 100) * 0.15 + least(marks / 15 * 100, 100) * 0.05 as score, case when year < 1970 then 88 when year < 1990 then 91 when year < 2010 then 93 else 95 end as pass_at from u)
  select doc_id, case when n < 50 then 'FAIL' when score >= pass_at then 'PASS' when score >= pass_at - 5 then 'WARNING' else 'FAIL' end as grade, case when n < 50 then 0.0 else round(score, 9) end::double as score, n::int as n_words, terms::int as terms, marks::int as marks from v""".replace("TERMS", _TERMS_SQL))
def _(s, d):
    conf = F.transform(F.sequence(F.lit(1), F.lit(5)), lambda i: (F.pmod(F.col("doc_id") * i, F.lit(100)) / 100.0).cast("double"))
    v = quality.validation(F.col("text"), conf, (F.lit(1950) + F.col("doc_id") % 80).cast("int"), ["the", "of", "and"])
    return _docs(s, d).select("doc_id", v.alias("v")).select("doc_id", "v.*").withColumn("score", F.round("score", 9))


@query("q11_year_thresholds", "select y, case when y < 1970 then 88.0 when y < 1990 then 91.0 when y < 2010 then 93.0 else 95.0 end::double as pass_at, case when y < 1970 then 83.0 when y < 1990 then 86.0 when y < 2010 then 88.0 else 90.0 end::double as warn_at from (select unnest(generate_series(1950, 2030))::int as y)")
def _(s, d):
    return s.range(1950, 2031).select(F.col("id").cast("int").alias("y")).select("y", quality.year_thresholds(F.col("y")).alias("t")).select("y", "t.*")


@query("q12_simple_quality", r"with t as (select doc_id, length(text) as n, length(regexp_replace(text, '[^\p{L}\p{N}]', '', 'g'))::double / nullif(length(text), 0) as alnum, (length(text) - length(replace(text, ' ', '')))::double / nullif(length(text), 0) as space, length(regexp_replace(text, '[\p{L}\p{N}\s]', '', 'g'))::double / nullif(length(text), 0) as special from documents) select doc_id, case when coalesce(n, 0) < 10 then 0.0 else round(greatest(0, least(1, alnum - greatest(0, space - 0.3) * 2 - greatest(0, special - 0.1) * 3)), 9) end::double as quality from t")
def _(s, d):
    return _docs(s, d).select("doc_id", F.round(quality.simple_quality(F.col("text")), 9).alias("quality"))


@query("q13_page_source", "select conv_id, turn, case when length(text) >= 50 and turn % 2 = 0 then 'embedded' else 'ocr' end as source from conversations where length(text) > 0")
def _(s, d):
    q = F.when(F.col("turn") % 2 == 0, 0.8).otherwise(0.1)
    return table(s, d, "conversations").where("length(text) > 0").select("conv_id", "turn", quality.page_source(F.col("text"), q, F.col("text")).alias("source"))


@query("q14_f19_density_flags", "with t as (select doc_id, n_chars / 3 as density, lower(text) like '%pasal%' as article, lower(text) like '%memutuskan%' or lower(text) like '%menetapkan%' as decided from documents), u as (select *, greatest(0, 100.0 - case when density < 80 then 60 when density < 200 then 30 else 0 end - case when article then 0 else 20 end - case when decided then 0 else 15 end) as score from t) select doc_id, score::double as score, density < 80 or (density < 200 and not article) or score < 50 as needs_ocr, array_to_string(list_filter([case when density < 200 then 'low_text_density' end, case when not article then 'missing_pasal' end, case when not decided then 'missing_decision_marker' end], lambda x: x is not null), ',') as flags from u")
def _(s, d):
    return _docs(s, d, "text", "n_chars").select("doc_id", quality.density_flags(F.col("n_chars") / 3, F.lit(3), F.col("text"), F.lit(0.1)).alias("f")).select("doc_id", "f.score", "f.needs_ocr", F.array_join("f.flags", ",").alias("flags"))


@query("q18_document_tier", "select doc_id, case when n_chars / 10000.0 >= 0.85 then 'EXCELLENT' when n_chars / 10000.0 >= 0.70 then 'GOOD' when n_chars / 10000.0 >= 0.50 then 'FAIR' else 'POOR' end as tier from documents")
def _(s, d):
    return _docs(s, d, "n_chars").select("doc_id", quality.document_tier(F.col("n_chars") / 10000.0).alias("tier"))


@query("q19_nearest_rank", "with v as (select event_type, list_sort(list(event_id % 1000)) as v from events group by 1) select event_type, v[1 + round_even((len(v) - 1) * 0.9, 0)::int] as p90 from v")
def _(s, d):
    v = table(s, d, "events").groupBy("event_type", (F.col("event_id") % 1000).alias("p90")).agg(F.count(F.lit(1)).alias("n"))
    return quality.nearest_rank(v, "event_type", "p90", 0.9)


@query("q20_low_confidence_pages", "with t as (select event_type, value, row_number() over (partition by event_type order by event_id) - 1 as i from events) select distinct event_type, i // 50 as page from t where value / 100 < 0.05")
def _(s, d):
    lines_ = table(s, d, "events").select("event_type", "event_id", (F.col("value") / 100).alias("c"))
    return quality.low_confidence_pages(lines_, "event_type", "event_id", "c", below=0.05)


@query("q21_progress", "select l_orderkey, coalesce(count(*) filter (l_linestatus = 'F') * 100.0::double / nullif(count(*), 0), 0) as pct from lineitem group by 1")
def _(s, d):
    return table(s, d, "lineitem").groupBy("l_orderkey").agg(quality.progress_percent(F.count(F.when(F.col("l_linestatus") == "F", 1)), F.count(F.lit(1))).alias("pct"))


@query("n7_json_columns", "select event_id, (props->>'k')::int as k from events")
def _(s, d):
    return table(s, d, "events").select("event_id", F.from_json("props", "k int")["k"].alias("k"))


@query("n23_validity", "with e as (select o_orderkey // 2 as dst, case o_orderkey % 8 when 0 then 'MENCABUT' when 2 then 'MENGUBAH' when 4 then 'BERLAKU_BERSYARAT' else 'MASA_PERALIHAN' end as t from orders where o_orderkey % 2 = 0), f as (select dst, max(t = 'MENCABUT')::int as r, max(t = 'MENGUBAH')::int as a, max(t = 'BERLAKU_BERSYARAT')::int as c, max(t = 'MASA_PERALIHAN')::int as m from e group by 1) select o_orderkey as slug, case when r = 1 then 'DICABUT' when a = 1 then 'DIUBAH' when c = 1 then 'BERLAKU_BERSYARAT' when m = 1 then 'MASA_PERALIHAN' when o_orderstatus = 'O' then 'TIDAK_BERLAKU' when o_orderstatus = 'F' then 'BERLAKU' else 'UNCERTAIN' end as validity, case when r = 1 then 0.95 when a = 1 then 0.85 when c = 1 then 0.70 when m = 1 then 0.65 when o_orderstatus in ('O', 'F') then 0.90 else 0.40 end::double as confidence from orders left join f on dst = o_orderkey")
def _(s, d):
    o = table(s, d, "orders")
    r = F.col("o_orderkey") % 8
    e = o.where("o_orderkey % 2 = 0").select((F.col("o_orderkey") / 2).cast("long").alias("dst"), F.when(r == 0, "MENCABUT").when(r == 2, "MENGUBAH").when(r == 4, "BERLAKU_BERSYARAT").otherwise("MASA_PERALIHAN").alias("rel_type"))
    status = F.when(F.col("o_orderstatus") == "O", "Tidak Berlaku").when(F.col("o_orderstatus") == "F", "Berlaku").alias("status")
    return extract.validity(o.select(F.col("o_orderkey").alias("slug"), status), e)


@query("m1_text_clusters")
def _(s, d):
    return cluster.text_clusters(table(s, d, "documents"), "doc_id", 8)


@query("m4_hamming", "with b as (select vec_id, list_transform(embedding[1:64], lambda x: (x > 0)::int) as b from embeddings) select a.vec_id as a, c.vec_id as b, list_sum(list_transform(list_zip(a.b, c.b), lambda x: (x[1] <> x[2])::int))::int as distance from b a join b c on c.vec_id = a.vec_id + 1")
def _(s, d):
    b = table(s, d, "embeddings").select("vec_id", cluster.sign_bits(F.col("embedding")).alias("bits"))
    c = b.select((F.col("vec_id") - 1).alias("vec_id"), F.col("vec_id").alias("b"), F.col("bits").alias("other"))
    return b.join(c, "vec_id").select(F.col("vec_id").alias("a"), "b", cluster.hamming(F.col("bits"), F.col("other")).alias("distance"))


@query("m5_vector_clusters")
def _(s, d):
    return cluster.vector_clusters(table(s, d, "embeddings"), "vec_id", "embedding", 6)


@query("sk14_joined_pages", "select conv_id, string_agg(text, chr(10) || chr(10) || '--- PAGE BREAK ---' || chr(10) || chr(10) order by turn, text) as text from conversations group by 1 having count(*) = count(text)")
def _(s, d):
    return sinks.joined_pages(table(s, d, "conversations"), "conv_id", "turn")


def _event_stream(s, d):
    return progress.read_events(s, f"{d}/events.parquet", table(s, d, "events").schema)


@query("st2_st5_windowed_stream", "select date_trunc('hour', ts) as start, event_type, count(*) as n from events group by 1, 2")
def _(s, d):
    out = sinks.scratch(s, "windows")
    counts = progress.windowed_counts(_event_stream(s, d), "ts", "event_type", "1 hour", "1000 days")
    q = counts.writeStream.outputMode("update").foreachBatch(progress.idempotent_append(f"{out}/rows")).option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    rows = s.read.parquet(f"{out}/rows/batch=*")
    return rows.groupBy(F.col("start").cast("timestamp_ntz").alias("start"), "event_type").agg(F.max_by("n", "batch_id").alias("n"))


@query("st8_health", "with l as (select user_id, max(ts) as last, max_by(event_type, (ts, event_id)) as kind from events group by 1), m as (select max(ts) as now from events) select user_id, case when epoch(now) - epoch(last) > 600 then 'stalled' when epoch(now) - epoch(last) > 300 then 'warning' else 'healthy' end as health from l, m")
def _(s, d):
    e = table(s, d, "events")
    l = e.groupBy("user_id").agg(F.max("ts").alias("last"))
    now = F.broadcast(e.agg(F.max("ts").alias("now")))
    idle = (F.unix_micros(F.col("now").cast("timestamp")) - F.unix_micros(F.col("last").cast("timestamp"))) / 1e6
    return l.join(now).select("user_id", progress.health_of(idle, F.lit(0)).alias("health"))


@query("st3_resume_cursor", "select conv_id, turn from conversations where conv_id > 100 or (conv_id = 100 and turn > 1)")
def _(s, d):
    return progress.resume_after(table(s, d, "conversations"), "conv_id", "turn", 100, 1).select("conv_id", "turn")


@query("st6_rotation", "with p(kind, ordinal, pct) as (values ('a', 1, 99.0), ('b', 2, 40.0), ('c', 3, 10.0)) select min_by(kind, ordinal) as next_kind from p where pct < 95")
def _(s, d):
    return progress.rotation(s.createDataFrame([("a", 1, 99.0), ("b", 2, 40.0), ("c", 3, 10.0)], "kind string, ordinal int, pct double"))


@query("st1_checkpoint_states", "with l as (select event_type as stage, user_id as batch_id, max_by(event_id % 4, event_id) as a, max_by(value, event_id) as done from events group by 1, 2) select stage, batch_id, case a when 1 then 'completed' when 2 then 'failed' when 3 then 'paused' else 'running' end as state, done, 100.0::double as total, a in (2, 3) as resumable, done * 100.0::double / 100.0::double as pct from l")
def _(s, d):
    a = F.col("event_id") % 4
    action = F.when(a == 1, "complete").when(a == 2, "fail").when(a == 3, "pause").otherwise("advance")
    log = table(s, d, "events").select(F.col("event_type").alias("stage"), F.col("user_id").alias("batch_id"), F.col("event_id").alias("seq"), action.alias("action"), F.col("value").alias("done"), F.lit(100.0).alias("total"))
    return progress.checkpoint_states(log)
