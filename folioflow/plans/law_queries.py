"""Extraction, dates, structure and correction over whole tables of law texts.

The texts are made from orders (``sources.tables.laws``); the SQL gives what a
text says from the columns it was made of, not by reading it again."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, extract, html, legal, quality, records, text
from ..operators import graph, lines, structure
from ..sources.tables import LAWS_SQL, laws, table
from .registry import query

W = f"with {LAWS_SQL} "
HAS_REF = "clause_at < 5"
_REL = "case clause_at when 0 then 'MENCABUT' when 1 then 'MENGUBAH' when 2 then 'BERLAKU_BERSYARAT' when 3 then 'MASA_PERALIHAN' when 4 then 'MENGIMPLEMENTASI' end"
_RAW = "chr(10) || 'Pasal 2' || chr(10) || clause"
_OWN_SLUG = "lower(code) || '-no-' || n || '-tahun-' || y"
_MONTH = "lpad((month_at + 1)::varchar, 2, '0')"


def _law(s, d, *columns):
    return laws(s, d).select("slug", *(columns or ("text",)))


@query("f16_header_metadata", W + "select slug, code as law_type, n::varchar as nomor, y as tahun, 'POKOK ' || c as tentang from laws")
def _(s, d):
    head = F.substring_index("text", "Menimbang", 1)
    return _law(s, d).select("slug", text.header_metadata(head).alias("m")).select("slug", "m.*")


@query("f18_body_slice", W + "select slug, chr(10) || body as body from laws")
def _(s, d):
    return _law(s, d).select("slug", text.body_slice(F.col("text")).alias("body"))


_REFS = f"refs as (select slug, 0 as at, code as kind, n::varchar as number, y as year, {_OWN_SLUG} as target from laws union all select slug, 1, ref_code, ref_number::varchar, ref_year, ref_slug from laws where {HAS_REF})"


@query("s8_reference_keys", W + f", {_REFS} select slug, kind, number, year, min(refs.at) as at from refs group by 1, 2, 3, 4")
def _(s, d):
    r = _law(s, d).select("slug", F.posexplode(extract.references(F.col("text"))).alias("at", "r")).select("slug", "at", "r.*")
    return r.groupBy("slug", "kind", "number", "year").agg(F.min("at").alias("at"))


@query("n10_references", W + f", {_REFS} select * from refs")
def _(s, d):
    return _law(s, d).select("slug", F.posexplode(extract.references(F.col("text"))).alias("at", "r")).select("slug", "at", "r.*")


_DATES = f"t as (select k, day + case when k % 3 = 0 then 20 else 0 end as day, month_at, case when k % 13 = 0 then 'Brumaire' else month_name end as month_name, y from laws)"


@query("d1_d2_dates", W + f", {_DATES} select k, case when month_name <> 'Brumaire' then y || '-' || {_MONTH} || '-' || lpad(day::varchar, 2, '0') end as loose, case when month_name <> 'Brumaire' and day <= 31 then y || '-' || {_MONTH} || '-' || lpad(day::varchar, 2, '0') end as strict, case when month_name <> 'Brumaire' then y || '-' || {_MONTH} || '-' || lpad(day::varchar, 2, '0') end as padded from t")
def _(s, d):
    day = F.col("day") + F.when(F.col("k") % 3 == 0, 20).otherwise(0)
    x = F.concat_ws(" ", day, F.when(F.col("k") % 13 == 0, "Brumaire").otherwise(F.col("month_name")), "y")
    return laws(s, d).select("k", dates.iso_date(x).alias("loose"), dates.iso_date(x, True).alias("strict"), dates.pad_date(x).alias("padded"))


@query("d9_padded_dates", W + "select k, y || '-' || " + _MONTH + " || '-' || lpad((day + 40)::varchar, 2, '0') as padded from laws")
def _(s, d):
    return laws(s, d).select("k", dates.pad_date(F.concat_ws(" ", F.col("day") + 40, "month_name", "y")).alias("padded"))


_WORDS = list(dates.NUMBER_WORDS.items())
_NUMBER_CASE = "case cast(k % " + str(len(_WORDS)) + " as int) " + " ".join(f"when {i} then {{{i}}}" for i in range(len(_WORDS))) + " end"
_WORD_OF = _NUMBER_CASE.format(*[f"'{w}'" for w, _ in _WORDS])
_VALUE_OF = _NUMBER_CASE.format(*[str(v) for _, v in _WORDS])


@query("d3_d4_delays", W + f", t as (select k, published, case when k % 3 = 0 then day when k % 3 = 1 then {_VALUE_OF} end * case when c % 2 = 0 then 30 else 1 end as days from laws) select k, days, (published::date + days::int)::varchar as date from t")
def _(s, d):
    n = F.when(F.col("k") % 3 == 0, F.col("day").cast("string")).when(F.col("k") % 3 == 1, F.expr(_WORD_OF)).otherwise("banyak")
    days = dates.delay_days(n, F.when(F.col("c") % 2 == 0, "bulan").otherwise("hari"))
    return laws(s, d).select("k", days.alias("days"), dates.delayed_date(F.col("published"), days).alias("date"))


_ENTRY_DATE = f"y || '-' || {_MONTH} || '-' || lpad(day::varchar, 2, '0')"


@query(
    "d5_effective_dates",
    W
    + f"""select slug,
  case entry_at when 0 then 'immediate' when 1 then 'specific_date' when 2 then 'delayed' when 3 then 'delayed' when 4 then 'conditional' when 5 then 'retroactive' else 'unknown' end as date_type,
  case when entry_at = 0 then published when entry_at in (1, 5) then {_ENTRY_DATE} when entry_at = 2 then (published::date + day)::varchar when entry_at = 3 then (published::date + 360)::varchar end as effective_date,
  case entry_at when 0 then 0.95 when 1 then 0.90 when 4 then 0.70 when 6 then 0.0 else 0.85 end::double as confidence,
  case entry_at when 2 then day when 3 then 360 end as delay_days, case entry_at when 4 then 'Keputusan Menteri' end as condition from laws""",
)
def _(s, d):
    return dates.effective_dates(_law(s, d, "text", "published")).drop("text", "published")


@query("d8_retry_delays", "select event_id, least(greatest(1, event_id % 7) * power(2, event_id % 12), 3600)::double as delay from events")
def _(s, d):
    first, tries = F.greatest(F.lit(1), F.col("event_id") % 7), F.col("event_id") % 12
    return table(s, d, "events").select("event_id", dates.retry_delay(first, tries, 2.0, 3600.0).alias("delay"))


@query("q22_approval_stage", "with t as (select o_orderkey as k, 85.0 + o_orderkey % 13 as a, 85.0 + o_custkey % 13 as b, 85.0 + (o_orderkey + o_custkey) % 13 as e, (o_custkey % 20) / 20.0 as llm from orders), u as (select *, case when b <= a then a when e <= b then b else e end as best from t) select k, case when a >= 95 then 'auto' when a >= 90 and best >= 95 then 'auto_retry' when llm >= 0.9 then 'llm' else 'human' end as stage from u")
def _(s, d):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    scores = F.array(*[(F.lit(85.0) + x % 13).cast("double") for x in (k, c, k + c)])
    return table(s, d, "orders").select(k.alias("k"), quality.approval_stage(scores, (c % 20) / 20.0, quality.year_thresholds(F.lit(2024))).alias("stage"))


@query("n11_internal_references", W + "select slug, 'Pasal ' || (k % 9 + 1) || ' ayat (' || (k % 4 + 1) || ') huruf b' as target from laws")
def _(s, d):
    return _law(s, d).select("slug", F.explode(extract.internal_references(F.col("text"))).alias("target"))


@query("n12_conditional_clauses", W + "select slug, case clause_at when 0 then 'DICABUT_DAN_TIDAK_BERLAKU' when 2 then 'SEPANJANG_TIDAK_BERTENTANGAN' else 'TETAP_BERLAKU_SAMPAI' end as clause_type, case clause_at when 0 then 'dicabut dan dinyatakan tidak berlaku' when 2 then 'dinyatakan masih tetap berlaku sepanjang tidak bertentangan dengan ' || ref || ' ini' else 'tetap berlaku sampai dengan ditetapkannya izin baru oleh menteri' end as text, case clause_at when 2 then ref_slug end as target from laws where clause_at in (0, 2, 3)")
def _(s, d):
    return extract.conditional_clauses(_law(s, d))


@query("n13_conflict_clauses", W + "select slug, 'Pasal 2 Semua izin' as subject, ref || ' ini' as condition, 'Pasal 2 ' || clause as sentence from laws where clause_at = 2")
def _(s, d):
    return extract.conflict_clauses(_law(s, d))


@query("n16_title_amendments", W + "select slug, ref_slug as target, 'MENGUBAH' as rel_type from laws where k % 3 = 0")
def _(s, d):
    title = F.when(F.col("k") % 3 == 0, F.concat(F.lit("PERUBAHAN ATAS "), F.upper("ref"))).otherwise(F.upper("ref"))
    return extract.title_amendments(laws(s, d).select("slug", title.alias("tentang")))


_RELATIONS = f"rel as (select slug, {_REL} as rel_type, ref_code as kind, ref_number::varchar as number, ref_year as year, ref_slug as target, 'Pasal 2' as basis, case clause_at when 2 then 'sepanjang tidak bertentangan dengan ' || ref || ' ini' when 3 then 'sampai dengan ditetapkannya izin baru oleh menteri' end as condition, {_RAW} as raw from laws where {HAS_REF})"


@query("n17_n18_relations", W + f", {_RELATIONS} select slug, 4 as at, 0 as nth, * exclude (slug) from rel")
def _(s, d):
    return extract.text_relations(_law(s, d))


@query("n19_n21_tags", W + f", {_RELATIONS} select slug, rel_type, 1 as n, raw from rel where rel_type <> 'MENGIMPLEMENTASI'")
def _(s, d):
    found = extract.text_relations(_law(s, d), keep_unparsed=True).where("rel_type <> 'MENGIMPLEMENTASI'")
    return found.groupBy("slug", "rel_type").agg(F.count(F.lit(1)).alias("n"), F.max("raw").alias("raw"))


@query("n20_condition_phrases", W + f", {_RELATIONS} select slug, condition from rel where condition is not null")
def _(s, d):
    return extract.text_relations(_law(s, d)).where("condition is not null").select("slug", "condition")


@query("n22_status_record", W + f", {_RELATIONS} select slug, rel_type = 'MENCABUT' as revokes, rel_type = 'MENGUBAH' as amends, rel_type in ('BERLAKU_BERSYARAT', 'MASA_PERALIHAN') as conditional, rel_type as tags, target as targets from rel where rel_type <> 'MENGIMPLEMENTASI'")
def _(s, d):
    r = extract.status_record(extract.text_relations(_law(s, d)))
    return r.withColumns({"tags": F.array_join("tags", ","), "targets": F.array_join("targets", ",")})


@query("n15_reference_graph", W + f", {_RELATIONS}, e as (select distinct target as id, rel_type from rel), nodes as (select id, bool_or(known) as known from (select slug as id, true as known from laws union all select target, false from rel) group by 1) select id, known, rel_type from nodes left join e using (id)")
def _(s, d):
    refs = extract.text_relations(_law(s, d)).select(F.col("slug").alias("src"), F.col("target").alias("dst"), "rel_type")
    nodes, edges = graph.nodes_and_edges(laws(s, d), refs)
    return nodes.join(edges.select(F.col("dst").alias("id"), "rel_type").distinct(), "id", "left")


@query("f49_status_relations", W + "select slug, case k % 3 when 0 then 'DICABUT_OLEH' else 'DIUBAH_OLEH' end as rel_type, ref_kind as kind, ref_number::varchar as number, ref_year as year from laws where k % 3 < 2")
def _(s, d):
    status = F.when(F.col("k") % 3 == 0, F.concat(F.lit("Tidak BerlakuDicabut Oleh :"), "ref")).when(F.col("k") % 3 == 1, F.concat(F.lit("Berlaku Diubah Oleh : "), "ref")).otherwise("Berlaku")
    return extract.status_relations(laws(s, d).select("slug", status.alias("status")))


_SECTIONS = [
    ("PREAMBLE", "head", 0),
    ("MENIMBANG", "'Menimbang' || chr(10) || 'bahwa perlu;'", 2),
    ("MEMUTUSKAN", "'MEMUTUSKAN:'", 4),
    ("BAB I", "'BAB I' || chr(10) || 'KETENTUAN UMUM'", 5),
    ("PASAL 1", "'Pasal 1' || chr(10) || '(1) Jenis:' || chr(10) || 'a. logam' || chr(10) || 'b. bukan logam' || chr(10) || '(2) Endapan sebagaimana dimaksud dalam Pasal ' || (k % 9 + 1) || ' ayat (' || (k % 4 + 1) || ') huruf b.'", 7),
    ("PASAL 2", "'Pasal 2' || chr(10) || clause || '.'", 12),
    ("BAB II", "'BAB II' || chr(10) || 'PENUTUP'", 14),
    ("PASAL 3", "'Pasal 3' || chr(10) || entry || chr(10) || 'Ditetapkan di Jakarta'", 16),
]


@query("f54_sections", W + " union all ".join(f"select slug, '{name}' as section, {at} as first, {'rtrim(head, chr(10)) || chr(10)' if name == 'PREAMBLE' else body} as text from laws" for name, body, at in _SECTIONS))
def _(s, d):
    return lines.sections(_law(s, d).select("slug", F.posexplode(F.split("text", "\n", -1)).alias("at", "line")), "slug", "at")


@query("f50_f55_explanations", W + "select slug, 1 as article, '' as note from laws where k % 2 = 0 union all select slug, (k % 50 + 2)::int, 'Yang dimaksud dengan ' || c || '.' from laws where k % 2 = 0")
def _(s, d):
    notes = F.concat(F.lit("UU\nPENJELASAN\nI. UMUM\nUmum.\nPasal 1\nCukup jelas.\nPasal "), F.col("k") % 50 + 2, F.lit("\nYang dimaksud\ndengan "), "c", F.lit("."))
    return records.explanations(laws(s, d).select("slug", F.when(F.col("k") % 2 == 0, notes).otherwise("none").alias("text")))


@query("f51_constitution_versions", "select o_orderkey, case o_orderkey % 6 when 0 then 4 when 1 then 3 when 2 then 2 when 3 then 1 when 4 then 1 else 0 end as version from orders")
def _(s, d):
    names = ["UUD%201945%20Perubahan%20Keempat.pdf", "uud-perubahan-KETIGA.pdf", "UUD Perubahan Kedua.pdf", "UUD%20perubahan%20pertama", "UUD 1945 Perubahan.pdf", "UUD 1945.pdf"]
    name = F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("o_orderkey") % 6 + 1).cast("int"))
    return table(s, d, "orders").select("o_orderkey", records.constitution_version(name).alias("version"))


@query("f57_f62_flags", W + "select slug, false as needs_ocr, true as has_preamble, k % 2 = 0 as has_notes, len(list_distinct([1, 2, 3, k % 9 + 1, case when clause_at = 4 then 5 else 1 end]))::int as n_articles from laws")
def _(s, d):
    stamped = F.concat(F.lit("SALINAN\n"), F.lit("\x07"), "text", F.lit("\nSK No 0123 A\n"), F.when(F.col("k") % 2 == 0, "Penjelasan").otherwise(""))
    return laws(s, d).select("slug", records.text_flags(records.strip_stamps(stamped)).alias("f")).select("slug", "f.*")


@query("f58_xml_safe", W + "select slug, text as safe from laws")
def _(s, d):
    return _law(s, d).select("slug", text.xml_safe(F.concat(F.lit("\x01\x0b"), "text", F.lit("\x1f"))).alias("safe"))


# as in the parser's rule, every number in parentheses opens a paragraph, mentions included


@query("n1_n5_structure", W + "select slug, 3 as n_articles, 3 + (clause_at = 4)::int + (entry_at = 2)::int as n_paragraphs, 2 as n_points from laws")
def _(s, d):
    return structure.totals(_law(s, d), "slug")


@query("n2_articles", W + "select slug, 'I' as chapter, 1 as number, 3 as n_paragraphs, '(1) Jenis:' || chr(10) || 'a. logam' || chr(10) || 'b. bukan logam' || chr(10) || '(2) Endapan sebagaimana dimaksud dalam Pasal ' || (k % 9 + 1) || ' ayat (' || (k % 4 + 1) || ') huruf b.' as text from laws union all select slug, 'I', 2, case when clause_at = 4 then 1 else 0 end, clause || '.' from laws union all select slug, 'II', 3, case when entry_at = 2 then 1 else 0 end, entry from laws")
def _(s, d):
    return structure.articles(_law(s, d), "slug").select("slug", "chapter", "number", F.size("paragraphs").alias("n_paragraphs"), "text")


@query("n6_tree_json", W + "select slug, 'KETENTUAN UMUM' as title, 'bukan logam' as point, 3 as article, entry as last from laws")
def _(s, d):
    tree = _law(s, d).select("slug", F.to_json(structure.parse_tree("text")).alias("t"))
    at = lambda path: F.get_json_object("t", path)
    return tree.select("slug", at("$.chapters[0].title").alias("title"), at("$.chapters[0].articles[0].paragraphs[0].points[1].text").alias("point"), at("$.chapters[1].articles[0].number").cast("int").alias("article"), at("$.chapters[1].articles[0].text").alias("last"))


@query("n8_sk19_xml", W + "select slug, 'chp_I art_1 art_1__para_1 art_1__para_1__point_a art_1__para_1__point_b art_1__para_2 art_1__para_' || (k % 4 + 1) || ' art_2' || case when clause_at = 4 then ' art_2__para_2' else '' end || ' chp_II art_3' || case when entry_at = 2 then ' art_3__para_' || day else '' end as ids, slug as name, case when entry_at = 2 then 'hari sejak tanggal diundangkan.' else entry end as last from laws")
def _(s, d):
    x = _law(s, d).select("slug", structure.to_xml("slug", "text").alias("x"))
    ids = F.array_join(F.regexp_extract_all("x", F.lit('eId="([^"]+)"'), F.lit(1)), " ")
    return x.select("slug", ids.alias("ids"), F.regexp_extract("x", 'act name="([^"]+)"', 1).alias("name"), F.regexp_extract("x", "<p>([^<]*)</p>(?:</paragraph>)?</article></chapter></body>", 1).alias("last"))


@query("f56_article_detail", W + "select slug, 1 as article, 'paragraphs' as form, 'Jenis: a. logam b. bukan logam' as first from laws union all select slug, 2, case when clause_at = 4 then 'paragraphs' else 'plain' end, case when clause_at = 4 then ref || ', perlu aturan.' else clause || '.' end from laws union all select slug, 3, case when entry_at = 2 then 'paragraphs' else 'plain' end, case when entry_at = 2 then 'hari sejak tanggal diundangkan.' else entry end from laws")
def _(s, d):
    a = structure.articles(_law(s, d), "slug")
    first = F.coalesce(F.get("paragraphs", F.lit(0))["text"], F.col("text"))
    return a.select("slug", F.col("number").alias("article"), structure.article_form(F.col("paragraphs")).alias("form"), text.collapse(first).alias("first"))


# words and pages



@query("f21_f25_preprocess", W + "select slug, chr(10) || 'Pasal ' || (k % 90 + 1) || chr(10) || 'Ketentuan ini mengatur hal yang penting, pada tahun 20' || (k % 10) || '0 dan seterusnya.' || chr(10) || '(1) INDONESIA dan UNDANG-UNDANG.' as clean from laws")
def _(s, d):
    raw = F.concat(F.lit("www.peraturan.go.id\nPRESIDEN REPUBLIK INDONESIA\n- "), F.col("k") % 500, F.lit(" -\nPasal "), F.col("k") % 90 + 1, F.lit("\nKetentuan ini meng-\natur  hal\tyang penting,\npada tahun 20"), F.col("k") % 10, F.lit("0 dan seterusnya.\n(1) INDONES1A dan UNDANG - UNDANG."))
    return laws(s, d).select("slug", text.preprocess(raw).alias("clean"))


@query("f22_page_headers", W + "select slug, 'Isi ' || k || chr(10) || 'Pasal ' || n || ' tetap' as kept from laws")
def _(s, d):
    raw = F.concat(F.lit("PRESIDEN\nIsi "), "k", F.lit("\n- "), F.col("k") % 300, F.lit(" -\nREPUBLIK INDONESIA\n"), F.col("k") % 1000, F.lit("\nPasal "), "n", F.lit(" ...\nPasal "), "n", F.lit(" tetap\nSK No 12345 A"))
    return laws(s, d).select("slug", text.remove_page_headers(raw).alias("kept"))


@query("f23_ocr_fixes", W + "select slug, 'PRESIDEN REPUBLIK INDONESIA tahun ' || y || ' nomor 1' || (k % 10) || '0' || (c % 10) || ' UNDANG-UNDANG tentang: sebagian' as fixed from laws")
def _(s, d):
    raw = F.concat(F.lit("PRESTDEN REPUBLTK INDONES1A tahun "), "y", F.lit(" nomor l"), F.col("k") % 10, F.lit("O"), F.col("c") % 10, F.lit(" UNDANG.UNDANG tentartg :ssfegian"))
    return laws(s, d).select("slug", text.fix_ocr(raw).alias("fixed"))


@query("f24_rejoined_lines", W + "select slug, 'Pasal 1' || chr(10) || 'Izin ini berlaku untuk ' || c || chr(10) || '(2) Lanjut ke, baris lain.' || chr(10) || 'BAB II' as joined from laws")
def _(s, d):
    raw = F.concat(F.lit("Pasal 1\nIzin ini ber-\nlaku untuk\n"), "c", F.lit("\n(2) Lanjut ke,\nbaris lain.\nBAB II"))
    return laws(s, d).select("slug", text.rejoin_lines(raw).alias("joined"))


@query("f29_dropped_noise", W + "select slug, 'kata ' || k || ' lagi dan akhir' as clean from laws")
def _(s, d):
    raw = F.concat(F.lit("kata #*@! "), "k", F.lit(" ±× lagi ....... dan -- -- akhir"))
    return laws(s, d).select("slug", F.trim(text.drop_noise(raw)).alias("clean"))


@query("f30_regex_corrections", W + "select slug, 'tahun 200' || (k % 10) || case when n < 10 then ' Pasal ' || n else ' pasal 0' || n end || ' BAB III dan a-b, 1' || (c % 10) || '0' || (k % 10) as fixed from laws")
def _(s, d):
    raw = F.concat(F.lit("tahun 20O"), F.col("k") % 10, F.lit(" pasal O"), "n", F.lit(" BAB I11  dan a — b, 1"), F.col("c") % 10, F.lit("O"), F.col("k") % 10)
    return laws(s, d).select("slug", text.regex_corrections(raw).alias("fixed"))


def _word_query(name: str, pairs: list[tuple[str, str]], **options) -> None:
    """One correction rule over words in three letter cases, dealt by key."""
    w = lambda at: "case cast(k % " + str(len(pairs)) + " as int) " + " ".join(f"when {i} then '{p[at].title()}'" for i, p in enumerate(pairs)) + " end"
    cased = lambda x: f"case cast(c % 3 as int) when 0 then lower({x}) when 1 then upper({x}) else {x} end"

    @query(name, W + f"select slug, 'para ' || {cased(w(1))} || ', ' || k as corrected from laws")
    def _(s, d):
        raw = F.concat(F.lit("para "), F.expr(cased(w(0))), F.lit(", "), "k")
        return laws(s, d).select("slug", text.word_corrector(**options)(raw).alias("corrected"))


_word_query("f31_ligatures", [("urnum", "umum"), ("rnenteri", "menteri"), ("clalam", "dalam"), ("clan", "dan")], old_spelling=False)
_word_query("f32_dictionary", [("telp", "telepon"), ("prop", "propinsi"), ("kab", "kabupaten")], dictionary={"telp": "telepon", "prop": "propinsi", "kab": "kabupaten"})
_word_query("f34_old_spelling", [("soedah", "sudah"), ("djalan", "jalan"), ("tjara", "cara"), ("njata", "nyata"), ("sjarat", "syarat")], old={"soedah": "sudah"})
_word_query("f36_case_preserved", [("jang", "yang"), ("oentoek", "untuk")], old={"jang": "yang", "oentoek": "untuk"})


@query("f33_digit_letters", W + "select slug, case cast(k % 3 as int) when 0 then 'PRESIDEN' when 1 then 'PASAL' else 'NEGARA' end || ' ' || k as corrected from laws")
def _(s, d):
    word = F.element_at(F.array(F.lit("PRE51DEN"), F.lit("P4$AL"), F.lit("N3GARA")), (F.col("k") % 3 + 1).cast("int"))
    return laws(s, d).select("slug", text.word_corrector()(F.concat_ws(" ", word, "k")).alias("corrected"))


@query("f26_correction", W + "select slug, 'REPUBLIK yang sudah 20' || '0' || (k % 10) || ' menteri' || chr(10) || 'sambung-an ' || k as corrected from laws")
def _(s, d):
    raw = F.concat(F.lit("<b>REPUBLIC</b> jang   soedah 20O"), F.col("k") % 10, F.lit(" rnenteri<br>sambung-\nan "), "k")
    words = text.word_corrector({"REPUBLIC": "REPUBLIK"}, {"jang": "yang", "soedah": "sudah"})
    return laws(s, d).select("slug", words(text.regex_corrections(text.drop_noise(text.join_hyphen_breaks(text.strip_html(raw))))).alias("corrected"))


@query("f37_detected_errors", W + "select slug, 0 as at, 'PRES1DEN' as word, 'PRESIDEN' as corrected, 'digit_to_letter' as kind from laws where k % 2 = 0 union all select slug, 1, 'djalan,', 'jalan', 'old_spelling' from laws")
def _(s, d):
    raw = F.concat(F.when(F.col("k") % 2 == 0, "PRES1DEN").otherwise("PRESIDEN"), F.lit(" djalan, "), "k")
    return text.detected_errors(laws(s, d).select("slug", raw.alias("text")), "slug")


_ABBREVIATED = list(records.ABBREVIATIONS.items())


@query("f38_word_lists", "with w as (select o_orderkey as k, case cast(o_orderkey % 9 as int) " + " ".join(f"when {i} then '{a}.'" for i, (a, _) in enumerate(_ABBREVIATED)) + " when 7 then 'untuk' else 'pasal' end as word from orders) select k, case cast(k % 9 as int) " + " ".join(f"when {i} then '{b}'" for i, (_, b) in enumerate(_ABBREVIATED)) + " when 7 then 'untuk' else 'pasal' end as expanded, k % 9 = 7 as stopword, k % 9 = 8 as legal from w")
def _(s, d):
    words = [*[f"{a}." for a, _ in _ABBREVIATED], "untuk", "pasal"]
    w = F.element_at(F.array(*[F.lit(x) for x in words]), (F.col("o_orderkey") % 9 + 1).cast("int"))
    return table(s, d, "orders").select(F.col("o_orderkey").alias("k"), records.expand_abbreviation(w).alias("expanded"), w.isin(*records.STOPWORDS).alias("stopword"), w.isin(*quality.LEGAL_TERMS).alias("legal"))


# kinds, folders, pages



@query("pf17_pf20_kinds", W + "select slug, case cast(k % 5 as int) when 0 then 'uu' when 1 then 'pp' when 2 then 'perpres' when 3 then 'permen' else 'perppu' end as short, case cast(k % 5 as int) when 0 then 100 when 4 then 100 when 1 then 80 when 2 then 70 else 50 end as priority, case cast(c % 5 as int) when 0 then 3 when 1 then 4 when 2 then 5 when 3 then 6 else 3 end as level, case cast(c % 5 as int) when 0 then -1 when 1 then 0 when 4 then -1 else 1 end as versus_pp from laws")
def _(s, d):
    k, code = F.upper("kind"), F.col("ref_code")
    return laws(s, d).select("slug", legal.short_type(k).alias("short"), legal.priority(k).alias("priority"), legal.hierarchy_level(code).alias("level"), legal.compare_hierarchy(code, F.lit("PP")).alias("versus_pp"))


@query("pf21_hierarchy_compare", W + "select slug, sign(a - b)::int as compared from (select slug, case cast(k % 5 as int) when 0 then 3 when 1 then 4 when 2 then 5 when 3 then 6 else 3 end as a, case cast(c % 5 as int) when 0 then 3 when 1 then 4 when 2 then 5 when 3 then 6 else 3 end as b from laws)")
def _(s, d):
    return laws(s, d).select("slug", legal.compare_hierarchy(F.col("code"), F.col("ref_code")).alias("compared"))


@query("pf23_folders", W + "select slug, 'pdfs/' || case when c % 7 = 0 then 'other' else case cast(k % 5 as int) when 0 then 'uu' when 1 then 'pp' when 2 then 'perpres' when 3 then 'permen' else 'perppu' end end as folder from laws")
def _(s, d):
    kind = F.when(F.col("c") % 7 == 0, "SURAT EDARAN").otherwise(F.upper("kind"))
    return laws(s, d).select("slug", records.folder(kind).alias("folder"))


def _detail(s, d):
    """Detail pages of laws: every eleventh has no title, every thirteenth a year out of range."""
    row = lambda label, value: F.concat(F.lit(f"<tr><th>{label}</th><td>"), value, F.lit("</td></tr>"))
    year = F.when(F.col("k") % 13 == 0, "1465").otherwise(F.col("y").cast("string"))
    rows = [row("Jenis/Bentuk Peraturan", F.upper("kind")), row("Nomor", F.col("n").cast("string")), row("Tahun", year), row("Tentang", F.when(F.col("k") % 11 == 0, "").otherwise(F.concat(F.lit("Minyak &amp; Gas Tahun "), "ref_year"))), row("Ditetapkan Tanggal", F.concat_ws(" ", "day", "month_name", "y"))]
    page = F.concat(F.lit('<table class="table">'), *rows, F.lit('</table><a href="/files/uu '), F.col("k").cast("string"), F.lit('.pdf">unduh</a>'))
    return laws(s, d).select("slug", F.concat(F.lower("code"), F.lit("-no-"), "n", F.lit("-tahun-"), "y").alias("own_slug"), page.alias("html"))


@query("f1_f9_records", W + f"select slug, upper(kind) as jenis, n::varchar as nomor, case when k % 13 <> 0 then y when k % 11 <> 0 then ref_year else y end as tahun, case when k % 11 = 0 then '' else 'Minyak & Gas Tahun ' || ref_year end as tentang, 'Berlaku' as status, {_ENTRY_DATE} as tanggal_penetapan, null::varchar as tanggal_pengundangan, 'https://example.org/files/uu' || k || '.pdf' as pdf_url, case when k % 11 = 0 then 'missing tentang' end as error from laws")
def _(s, d):
    # the slug of a catalog names the law; "law-2002" is a key, and its number no year
    return _detail(s, d).select("slug", html.record(F.col("html"), F.col("own_slug"), 2026, "https://example.org").alias("r")).select("slug", "r.*")


@query("sc8_detail_pages", W + "select slug, upper(kind) as jenis, n::varchar as nomor, case when k % 11 = 0 then '' else 'Minyak & Gas Tahun ' || ref_year end as tentang from laws")
def _(s, d):
    fields = _detail(s, d).select("slug", html.table_fields("html").alias("f"))
    return fields.select("slug", *[F.try_element_at("f", F.lit(c)).alias(c) for c in ("jenis", "nomor", "tentang")])


@query("f2_f7_list_page", "select o_orderkey as k, (o_orderkey * 1000 + 234)::bigint as total, (o_custkey % 50 + 1)::int as last_page, '/id/a-' || o_orderkey || '/ /id/b-' || o_custkey as links, 'https://h/files/x' || o_custkey || '.pdf' as pdf, 'https://h/files/x' || o_custkey || '.pdf' as pdfs from orders")
def _(s, d):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    page = F.concat(F.lit("<p>Menampilkan 1 - 20 dari "), k, F.lit('.234 peraturan</p><a href="/id/a-'), k, F.lit('/">a</a><a href="/id/a-'), k, F.lit('/">again</a><a href="#">x</a><a href="https://h.example/id/b-'), c, F.lit('">b</a><meta name="article:tag" content="/files/x '), c, F.lit('.pdf"><ul class="pagination"><a href="?p=1">1</a><a href="?p=n">'), c % 50 + 1, F.lit("</a></ul>"))
    p = F.col("page")
    return table(s, d, "orders").select(k.alias("k"), page.alias("page")).select("k", html.total_count(p).alias("total"), html.last_page(p).alias("last_page"), F.array_join(html.record_links(p), " ").alias("links"), html.pdf_url(p, "https://h").alias("pdf"), F.array_join(html.all_pdf_urls(p, "https://h"), " ").alias("pdfs"))


@query("n9_json_salvage", "select event_id, case when event_id % 3 < 2 then 'x' || event_id end as corrected, case event_id % 3 when 0 then least(value / 50, 1.0) when 1 then 0.5 end::double as confidence from events")
def _(s, d):
    e = F.col("event_id")
    reply = F.when(e % 3 == 0, F.concat(F.lit('ok: {"corrected": "x'), e, F.lit('", "confidence": '), (F.col("value") / 50).cast("string"), F.lit("} done"))).when(e % 3 == 1, F.concat(F.lit('{"corrected": "x'), e, F.lit('"}'))).otherwise("nothing")
    return table(s, d, "events").select("event_id", extract.salvage_json(reply).alias("r")).select("event_id", "r.*")


@query("st7_backoff", "select event_id, ts + to_minutes(least(120, 5 * power(3, greatest(event_id % 9 - 3, 0)))::int) as retry_at from events")
def _(s, d):
    out = dates.backoff_until(F.col("ts").cast("timestamp"), (F.col("event_id") % 9).cast("int"))
    return table(s, d, "events").select("event_id", out.cast("timestamp_ntz").alias("retry_at"))

