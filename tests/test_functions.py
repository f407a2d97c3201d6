"""Value pairs for the text, date, page and quality functions."""

import pytest
from pyspark.sql import functions as F

from folioflow.functions import dates, extract, html, legal, quality, text
from folioflow.operators import lines, mutations, structure, windows


def apply(spark, f, *values, type_="string"):
    columns = ", ".join(f"c{i} {type_}" for i in range(len(values)))
    df = spark.createDataFrame([tuple(values)], columns)
    return df.select(f(*[F.col(c) for c in df.columns]).alias("x")).first()["x"]


@pytest.mark.parametrize("given, iso", [("15 Januari 2025", "2025-01-15"), ("invalid date", None), ("", None), (None, None), ("1 Mei 1999", "1999-05-01")])
def test_dates(spark, given, iso):
    assert apply(spark, dates.iso_date, given) == iso


@pytest.mark.parametrize("slug, year", [("perpres-no-10-tahun-2023", 2023), ("permen-kp-no-37-permen-kp-2018-tahun-1465", None), ("some-slug-2024", 2024)])
def test_slug_years(spark, slug, year):
    f = lambda s: html.year_fallback(F.lit(None).cast("string"), F.lit(""), s, F.lit(None).cast("string"), 2025)
    assert apply(spark, f, slug) == year


@pytest.mark.parametrize("href, reason", [("#", "hash"), ("/id/#", "hash"), ("javascript:void(0)", "javascript"), ("", "empty"), ("/id/", "empty"), ("/about", "other"), ("/id/uu-no-1", None)])
def test_links(spark, href, reason):
    assert apply(spark, html.link_reason, href) == reason


@pytest.mark.parametrize(
    "given, right",
    [
        ("djalan", "jalan"), ("DJENDERAL", "JENDERAL"), ("unclang", "undang"), ("clengan", "dengan"), ("lavv", "law"),
        ("1NDONESIA", "INDONESIA"), ("7AHUN", "TAHUN"), ("PRES!DEN", "PRESIDEN"), ("REPUB|IK", "REPUBLIK"), ("salinan,", "salinan,"), ("2009", "2009"),
    ],
)
def test_word_correction(spark, given, right):
    assert apply(spark, text.word_corrector(text.COMMON_ERRORS), given) == right


@pytest.mark.parametrize("given, right", [("TAHUN 20O4", "TAHUN 2004"), ("NOMOR 1O1", "NOMOR 101"), ("BAB 1|1", "BAB III"), ("a — b", "a-b"), ("Pasal O1", "Pasal 1")])
def test_regex_corrections(spark, given, right):
    assert apply(spark, text.regex_corrections, given) == right


# Words as recognised, and as they should read.
OLD_SPELLINGS = [
    ("djuga", "juga"), ("djadi", "jadi"), ("djabatan", "jabatan"), ("djenderal", "jenderal"), ("djakarta", "jakarta"), ("djanuari", "januari"), ("djuli", "juli"), ("djumlah", "jumlah"),
    ("djaminan", "jaminan"), ("djawatan", "jawatan"), ("djurusan", "jurusan"), ("Djakarta", "Jakarta"), ("tjara", "cara"), ("tjatatan", "catatan"), ("tjukup", "cukup"), ("mentjapai", "mencapai"),
    ("pertjaja", "percaya"), ("TJARA", "CARA"), ("njata", "nyata"), ("njaris", "nyaris"), ("sjarat", "syarat"), ("sjah", "syah"), ("sjahrir", "syahrir"), ("jang", "yang"), ("jaitu", "yaitu"),
    ("jogjakarta", "yogyakarta"), ("jogja", "yogya"), ("juga", "juga"), ("jadi", "jadi"), ("jalan", "jalan"), ("oemoem", "umum"), ("boekoe", "buku"), ("koempoelan", "kumpulan"), ("soedah", "sudah"),
    ("boelan", "bulan"), ("wadjib", "wajib"), ("perdjalanan", "perjalanan"), ("keadjaiban", "keajaiban"), ("sedjak", "sejak"), ("kedjadian", "kejadian"), ("pekerdjaan", "pekerjaan"),
    ("ketentjuan", "ketentuan"), ("pendjelasan", "penjelasan"), ("pendjualan", "penjualan"),
]
MISREAD = [
    ("pernerintah", "pemerintah"), ("pernbangunan", "pembangunan"), ("kernenterian", "kementerian"), ("rnasyarakat", "masyarakat"), ("pernbentukan", "pembentukan"), ("rnenetapkan", "menetapkan"),
    ("rnengingat", "mengingat"), ("rnenimbang", "menimbang"), ("rnenteri", "menteri"), ("PERNERINTAH", "PEMERINTAH"), ("unclang", "undang"), ("keaclilan", "keadilan"), ("pencliclikan", "pendidikan"),
    ("clengan", "dengan"), ("claiam", "dalam"), ("lavv", "law"), ("nevv", "new"), ("SALINAN", "SALINAN"), ("LAMPIRAN", "LAMPIRAN"), ("kualifikasi", "kualifikasi"), ("modifikasi", "modifikasi"),
    ("identifikasi", "identifikasi"), ("klasifikasi", "klasifikasi"), ("berlian", "berlian"), ("dalil", "dalil"), ("1NDONESIA", "INDONESIA"), ("INDONE5IA", "INDONESIA"), ("PRES1DEN", "PRESIDEN"),
    ("PEMER1NTAH", "PEMERINTAH"), ("7AHUN", "TAHUN"), ("7ENTANG", "TENTANG"), ("N3GARA", "NEGARA"), ("PRES!DEN", "PRESIDEN"), ("REPUB|IK", "REPUBLIK"),
]


@pytest.mark.parametrize("given, right", OLD_SPELLINGS + MISREAD)
def test_words_as_they_should_read(given, right):
    lower = lambda d: {k.lower(): v for k, v in d.items()}
    assert text.correct_word(given, lower(text.COMMON_ERRORS), lower(text.OLD_WORDS))[0] == right


@pytest.mark.parametrize("given, right", [("TAHUN 201O", "TAHUN 2010"), ("TAHUN 20OO", "TAHUN 2000"), ("BAB 11", "BAB II"), ("UNDANG - UNDANG", "UNDANG-UNDANG"), ("ayat (I)", "(1)")])
def test_numbers_as_they_should_read(spark, given, right):
    assert apply(spark, text.regex_corrections, given) == right


def test_years_and_dates_of_pages(spark):
    titles = [("Peraturan Tahun 2024", 2024), ("tahun 2025", 2025), ("Berlaku sejak Tahun  2023", 2023), ("No year here", None), ("Invalid Tahun 1400", None), ("", None)]
    slugs = [("uu-no-2-tahun-2025", 2025), ("pp-no-1-tahun-2024", 2024), ("some-slug-2024", 2024), ("no-year-slug", None), ("", None)]
    days = [("15 Januari 2025", 2025), ("1 Desember 2024", 2024), ("No date", None), ("Invalid date 1400", None), ("", None)]
    none = F.lit(None).cast("string")
    rows = [(t, "", "", y) for t, y in titles] + [("", s, "", y) for s, y in slugs] + [("", "", x, y) for x, y in days]
    df = spark.createDataFrame(rows, "title string, slug string, day string, y int")
    got = df.select("y", html.year_fallback(none, F.col("title"), F.col("slug"), F.col("day"), 2025).alias("found")).collect()
    assert [r["found"] for r in got] == [r["y"] for r in got]
    fields = spark.createDataFrame([("1945",), ("1944",), ("1465",), ("3000",), ("2026",), (None,)], "y string")
    assert [r[0] for r in fields.select(html.year_fallback(F.col("y"), F.lit(""), F.lit(""), F.lit(""), 2025)).collect()] == [1945, None, None, None, 2026, None]


def test_slugs_of_links(spark):
    pairs = [("/id/uu-no-2-tahun-2025", "uu-no-2-tahun-2025"), ("https://example.org/id/pp-no-1-tahun-2024", "pp-no-1-tahun-2024"), ("/id/perpres-no-10-tahun-2023/", "perpres-no-10-tahun-2023")]
    assert [apply(spark, html.slug_of, a) for a, _ in pairs] == [b for _, b in pairs]


def test_validation(spark):
    law = "PRESIDEN REPUBLIK INDONESIA\nUNDANG-UNDANG REPUBLIK INDONESIA\nNOMOR 1 TAHUN 2024\nTENTANG PERUBAHAN\nMenimbang bahwa untuk mewujudkan tujuan negara\nMengingat Pasal 5 ayat (1) Undang-Undang Dasar\nMEMUTUSKAN\nMenetapkan UNDANG-UNDANG TENTANG PERUBAHAN\nBAB I\nKETENTUAN UMUM\nPasal 1\nDalam Undang-Undang ini yang dimaksud dengan\n(1) Pemerintah adalah\n(2) Menteri adalah\nPasal 2\n(1) Ketentuan sebagaimana dimaksud dalam Pasal 1\n" * 2
    rows = [("law", law, [0.98] * 30), ("short", "a few words", [0.95]), ("unsure", law, []), ("low", law, [0.7] * 30)]
    df = spark.createDataFrame(rows, "k string, text string, c array<double>")
    got = {r["k"]: r["v"] for r in df.select("k", quality.validation(F.col("text"), F.col("c"), F.lit(2024), sorted(text.CORE_WORDS)).alias("v")).collect()}
    assert got["law"]["score"] >= 80 and got["law"]["n_words"] >= 50
    assert (got["short"]["grade"], got["short"]["score"]) == ("FAIL", 0.0)
    assert got["law"]["score"] - got["unsure"]["score"] == pytest.approx(0.45 * 98, abs=1e-6)
    assert got["low"]["score"] < got["law"]["score"]


def test_salvaged_json(spark):
    df = spark.createDataFrame([('ok {"corrected": "x", "confidence": 1.7} done',), ('{"corrected": "y", "confidence": -1}',), ('{"corrected": "z"}',), ("nothing",)], "r string")
    assert [tuple(r["x"]) for r in df.select(extract.salvage_json(F.col("r")).alias("x")).collect()] == [("x", 1.0), ("y", 0.0), ("z", 0.5), (None, None)]


def test_unicode_normalisation_and_ratio(spark):
    pairs = [("\ufb01le\u00ad\u200b \u201cx\u201d \u2013 y", 'file "x" - y'), ("ber-\nlaku", "berlaku"), ("  a\tb\n", "a b"), (None, "")]
    df = spark.createDataFrame(pairs, "a string, b string")
    assert all(r["x"] == r["b"] for r in df.select("b", text.nfkc("a").alias("x")).collect())


def test_hyphen_and_html(spark):
    assert apply(spark, text.join_hyphen_breaks, "UNDANG-\nUNDANG") == "UNDANG-UNDANG"
    assert apply(spark, text.strip_html, "<b>x</b><br/>y") == "x\ny"
    assert apply(spark, text.xml_safe, "a\x01b") == "ab"


def test_rejoin_lines(spark):
    given = "Pasal 1\nDalam hal ini yang\ndimaksud adalah ter-\nbentuk di alam.\n\nSelesai"
    assert apply(spark, text.rejoin_lines, given) == "Pasal 1\nDalam hal ini yang dimaksud adalah terbentuk di alam.\n\nSelesai"


def test_line_helpers(spark):
    assert apply(spark, text.split_lines, "a\r\nb\x0bc\n") == ["a", "b", "c"]
    assert apply(spark, text.normalize_line, "  Ab \t cD ") == "ab cd"
    assert apply(spark, text.normalize_line, "12345") == ""


def test_jaccard_and_distance(spark):
    f = lambda a, b: text.jaccard(F.split(a, " "), F.split(b, " "))
    assert apply(spark, f, "a b c", "b c d") == 0.5
    assert apply(spark, lambda a, b: text.bounded_levenshtein(a, b, 2), "kitten", "sitting") == 3
    assert apply(spark, text.sequence_ratio, "abcd", "bcde") == 0.75


def test_effective_dates(spark):
    rows = [
        ("Undang-Undang ini mulai berlaku pada tanggal diundangkan.", "2024-01-15", "immediate", "2024-01-15"),
        ("Peraturan ini mulai berlaku pada tanggal 1 Januari 2025.", None, "specific_date", "2025-01-01"),
        ("Peraturan ini mulai berlaku 30 (tiga puluh) hari sejak tanggal diundangkan.", "2024-01-15", "delayed", "2024-02-14"),
        ("Peraturan ini mulai berlaku dua belas bulan setelah tanggal diundangkan.", "2020-01-01", "delayed", "2020-12-26"),
        ("Peraturan ini mulai berlaku surut sejak tanggal 2 Mei 2001.", None, "retroactive", "2001-05-02"),
        ("Undang-Undang ini mulai berlaku setelah Peraturan Pemerintah ditetapkan.", None, "conditional", None),
        ("nothing", None, "unknown", None),
        (None, None, "unknown", None),
    ]
    df = spark.createDataFrame([(i, *r[:2]) for i, r in enumerate(rows)], "i int, text string, published string")
    got = dates.effective_dates(df).orderBy("i").collect()
    assert [(r["date_type"], r["effective_date"]) for r in got] == [r[2:] for r in rows]


def test_relations(spark):
    docs = spark.createDataFrame([("s", "Dengan undang-undang ini UU No. 5 Tahun 1960 dicabut dan dinyatakan tidak berlaku. Perppu Nomor 1 Tahun 2020 tetap berlaku sepanjang tidak bertentangan dengan ini.")], "slug string, text string")
    got = {(r["rel_type"], r["target"]) for r in extract.text_relations(docs).collect()}
    assert got == {("MENCABUT", "uu-no-5-tahun-1960"), ("BERLAKU_BERSYARAT", "perppu-no-1-tahun-2020")}


def test_kinds(spark):
    assert apply(spark, legal.short_type, "undang-undang") == "uu"
    assert apply(spark, legal.short_type, "x") == "other"
    assert apply(spark, legal.hierarchy_level, "PERPRES") == 5
    assert apply(spark, legal.compare_hierarchy, "UU", "PERDA") == -1


def test_thresholds(spark):
    got = spark.createDataFrame([(1953,), (1975,), (2000,), (2024,), (None,)], "y int").select(quality.year_thresholds(F.col("y")).alias("t")).collect()
    assert [tuple(r["t"]) for r in got] == [(88.0, 83.0), (91.0, 86.0), (93.0, 88.0), (95.0, 90.0), (95.0, 90.0)]


def test_quality_bounds(spark):
    df = spark.createDataFrame([("",), ("abc",), ("$$$$ %%%%%% &&&&&&&",), ("Pasal 1 (1) Menimbang bahwa negara hukum",)], "text string")
    for f in (quality.simple_quality, quality.broken_char_ratio, quality.word_recognition_rate, quality.structure_score):
        assert all(0 <= r[0] <= 1 for r in df.select(f(F.col("text"))).collect())


def test_structure():
    tree = structure.parse("BAB I\nUMUM\nPasal 1\n(1) Satu:\na. logam\nlanjutan\n1. emas\nb. lain\n(2) Dua\nPasal 2\nIsi menurut Pasal 1 saja.\nBAB II\nPENUTUP\nPasal 3\nx\nDitetapkan di Jakarta")
    assert [c["number"] for c in tree["chapters"]] == ["I", "II"]
    first = tree["chapters"][0]["articles"]
    assert [a["number"] for a in first] == [1, 2]
    assert [p["letter"] for p in first[0]["paragraphs"][0]["points"]] == ["a", "b"]
    assert first[0]["paragraphs"][0]["points"][0]["subpoints"] == [{"number": 1, "text": "emas"}]
    assert "Pasal 1 saja" in first[1]["text"]
    assert structure.parse("short")["error"] == "too short"


def test_cleaning_is_idempotent(spark):
    pages = spark.createDataFrame([("d", i, f"HEADER LINE\n- {i} -\nbody {i} text") for i in range(4)] + [("one", 0, "ONLY PAGE")], "doc string, page int, text string")
    once = lines.clean_pages(pages, "doc", "page")
    got = {(r["doc"], r["page"]): r["clean"] for r in once.collect()}
    assert got[("d", 2)] == "body 2 text" and got[("one", 0)] == "ONLY PAGE"
    twice = lines.clean_pages(once.select("doc", "page", F.col("clean").alias("text")), "doc", "page")
    assert {(r["doc"], r["page"]): r["clean"] for r in twice.collect()} == got


def test_rules(spark):
    t = "SALINAN\nKeep me\nPage 3 of 9\nwww.x.id"
    rules = [{"kind": "exact", "pattern": "SALINAN"}, {"kind": "regex", "pattern": r"Page \d+ of \d+"}, {"kind": "contains", "pattern": "WWW."}]
    assert apply(spark, lambda c: lines.apply_rules(c, rules), t) == "Keep me"


def test_moving_average(spark):
    df = spark.createDataFrame([("k", i, float(i)) for i in range(5)], "k string, i int, v double")
    got = [r["mean"] for r in windows.moving_average(df, ["k"], "i", "v", 3).orderBy("i").collect()]
    assert got == [1 / 3, 1.0, 2.0, 3.0, 11 / 3]


def test_upsert_last_wins(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, v int, p string")
    new = spark.createDataFrame([("b", 9, None), ("c", 3, "z")], "k string, v int, p string")
    got = {tuple(r) for r in mutations.upsert(old, new, ["k"], keep_if_null=("p",)).collect()}
    assert got == {("a", 1, "x"), ("b", 9, "y"), ("c", 3, "z")}


def test_record_page(spark):
    page = '<table><tr><th>Jenis</th><td>UU</td></tr><tr><th>Nomor</th><td>2</td></tr><tr><th>Nomor Pengundangan</th><td>7</td></tr><tr><th>Tahun</th><td>1465</td></tr><tr><th>Perihal</th><td>Hal Tahun 2018</td></tr></table><a href="/files/a b.pdf">x</a>'
    df = spark.createDataFrame([("s", page)], "slug string, html string")
    r = df.select(html.record(F.col("html"), F.col("slug"), 2025, "https://h").alias("r")).first()["r"]
    assert (r["nomor"], r["tahun"], r["pdf_url"], r["error"]) == ("2", 2018, "https://h/files/ab.pdf", None)


def test_sinks(spark, tmp_path):
    from folioflow.sources import sinks

    path = f"file://{tmp_path}/t"
    spark.range(3).write.parquet(path)
    sinks.replace_table(spark.read.parquet(path).where("id > 0"), path)
    assert spark.read.parquet(path).count() == 2
    log = tmp_path / "log.jsonl"
    log.write_text('{"event": "doc_done", "slug": "a"}\nnot json\n{"event": "start", "slug": "b"}\n')
    assert [r["slug"] for r in sinks.completed_keys(spark, f"file://{log}").collect()] == ["a"]
    (tmp_path / "w.txt").write_text("# note\nAyat\nayat\n")
    assert [r["word"] for r in sinks.read_words(spark, f"file://{tmp_path}/w.txt").collect()] == ["ayat"]


def test_heartbeats(spark, tmp_path):
    from folioflow.streaming import progress

    spark.createDataFrame([(1, 10, 1, "ok"), (1, 20, 2, "error"), (1, 30, 3, "error"), (2, 15, 4, "ok")], "worker bigint, s bigint, seq bigint, kind string").select("worker", F.timestamp_seconds("s").alias("at"), "seq", "kind").write.parquet(f"{tmp_path}/in")
    schema = spark.read.parquet(f"{tmp_path}/in").schema
    stream = progress.heartbeats(progress.read_events(spark, f"{tmp_path}/in", schema, 100))
    q = stream.writeStream.outputMode("update").format("memory").queryName("beats").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination()
    got = {r["worker"]: (r["errors"], r["n"]) for r in spark.sql("select * from beats").collect()}
    assert got == {1: (2, 3), 2: (0, 1)}


def test_moving_average_over_blocks(spark):
    rows = [(k, i * 3, float((i * 7) % 11)) for k in "ab" for i in range(50 if k == "a" else 3)]
    df = spark.createDataFrame(rows, "k string, at bigint, v double")
    got = {(r["k"], r["at"]): r["mean"] for r in windows.moving_average(df, ["k"], "at", "v", 7, block=8).collect()}
    for k in "ab":
        v = [x for key, _, x in rows if key == k]
        for i in range(len(v)):
            assert got[k, i * 3] == pytest.approx(sum(v[min(max(i + d, 0), len(v) - 1)] for d in range(-3, 4)) / 7)
