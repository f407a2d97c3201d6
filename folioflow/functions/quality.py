"""Page and document quality scores as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Terms of legal prose and structure marks with weights.
LEGAL_TERMS = [
    "undang-undang", "peraturan", "pemerintah", "presiden", "menteri", "pasal", "ayat", "huruf", "angka", "bab", "bagian", "paragraf", "menimbang", "mengingat", "memutuskan", "menetapkan",
    "ketentuan", "umum", "peralihan", "penutup", "republik", "indonesia", "negara", "hukum", "warga", "rakyat", "dewan", "perwakilan", "ditetapkan", "diundangkan", "berlaku", "tanggal",
    "jakarta", "tahun", "nomor", "tentang", "penjelasan", "tambahan", "lembaran", "perubahan", "pencabutan", "pengesahan",
]
STRUCTURE = [(r"(?i)BAB\s+[IVX]+", 0.15), (r"(?iU)Bagian\s+\w+", 0.10), (r"(?i)Pasal\s+\d+", 0.25), (r"\(\d+\)", 0.20), (r"(?i)[a-z]\.", 0.10), (r"(?i)Menimbang", 0.10), (r"(?i)Mengingat", 0.10)]
BROKEN = [r"(?i)[bcdfghjklmnpqrstvwxyz]{4,}", r"(?i)\d[O0Il]{2,}\d", r"(?U)[^\w\s.,;:!?\-()\"'\[\]{}]{3,}", r"(?i)(?<![A-Za-z])[lI1]{3,}(?![A-Za-z])"]
LINE_MARKS = [r"(?im)^pasal\s+\d+", r"(?m)^\(\d+\)", r"(?im)^[a-z]\.", r"(?im)^bab\s+[ivxlcdm]+", r"(?imU)^bagian\s+\w+", r"(?im)^ayat\s+\(\d+\)"]

OVERALL_WEIGHTS = {"confidence": 0.25, "words": 0.30, "legal": 0.20, "articles": 0.15, "xml": 0.10}
TIERS = [(0.80, "high"), (0.60, "medium"), (0.40, "low")]
DOCUMENT_TIERS = [(0.85, "EXCELLENT"), (0.70, "GOOD"), (0.50, "FAIR")]
PAGE_WEIGHTS = {"alpha": 0.2, "whole": 0.3, "word": 0.3, "legal": 0.2}
VALIDATION_WEIGHTS = {"confidence": 0.45, "words": 0.35, "terms": 0.15, "marks": 0.05}
#: Pass and warning marks by the year before which a document was made; later ones have the last pair.
YEAR_LIMITS = [(1970, 88.0, 83.0), (1990, 91.0, 86.0), (2010, 93.0, 88.0), (None, 95.0, 90.0)]


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once: a lambda's variable is never
    copied into the places where it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _latin_words(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit("([a-z]+)"))


def _part(found: Column, words: Column) -> Column:
    return F.coalesce(F.try_divide(F.size(found), F.size(words)), F.lit(0.0))


def word_recognition_rate(c: Column) -> Column:
    """Words of three letters or more with a vowel, or legal terms."""
    return _bound(_latin_words(c), lambda words: _part(F.filter(words, lambda w: ((F.length(w) >= 3) & w.rlike("[aeiou]")) | w.isin(*LEGAL_TERMS)), words))


def legal_term_rate(c: Column) -> Column:
    """Words are runs of letters, so hyphenated terms never match."""
    return _bound(_latin_words(c), lambda words: _part(F.filter(words, lambda w: w.isin(*LEGAL_TERMS)), words))


def broken_char_ratio(c: Column) -> Column:
    """Characters in broken patterns, overlaps counted once per pattern."""
    matched = sum((F.aggregate(F.regexp_extract_all(c, F.lit(f"({p})"), F.lit(1)), F.lit(0), lambda n, m: n + F.length(m)) for p in BROKEN), F.lit(0))
    return F.least(F.coalesce(F.try_divide(matched, F.length(c)), F.lit(0.0)), F.lit(1.0))


def structure_score(c: Column) -> Column:
    return F.least(sum((F.when(c.rlike(p), F.lit(w)).otherwise(0.0) for p, w in STRUCTURE), F.lit(0.0)), F.lit(1.0))


def overall_score(confidence: Column, words: Column, legal: Column, has_articles: Column, xml_valid: Column) -> Column:
    """Weighted mean over the parts that are known; five percent of legal terms
    already count fully."""
    w = OVERALL_WEIGHTS
    parts = [(confidence, w["confidence"]), (words, w["words"]), (F.least(legal / 0.05, F.lit(1.0)), w["legal"])]
    score = sum((F.coalesce(v * x, F.lit(0.0)) for v, x in parts), F.lit(0.0))
    used = sum((F.when(v.isNotNull(), x).otherwise(0.0) for v, x in parts), F.lit(0.0))
    score = score + F.when(has_articles, w["articles"]).otherwise(0.0) + F.when(xml_valid, w["xml"]).otherwise(0.0)
    return score / (used + w["articles"] + w["xml"])


def tier(score: Column) -> Column:
    return F.coalesce(*[F.when(score >= least, name) for least, name in TIERS], F.lit("error"))


def document_tier(score: Column) -> Column:
    return F.coalesce(*[F.when(score >= least, name) for least, name in DOCUMENT_TIERS], F.lit("POOR"))


def issues(confidence: Column, words: Column, legal: Column, broken: Column, has_articles: Column) -> Column:
    return F.array_compact(
        F.array(
            F.when(confidence < 0.50, "very low confidence"),
            F.when(words < 0.40, "low word recognition"),
            F.when(legal < 0.02, "hardly any legal terms"),
            F.when(broken > 0.10, "many broken characters"),
            F.when(~has_articles, "no articles"),
        )
    )


def review_reason(tier_: Column, found: Column) -> Column:
    """Why a person should look, null if nobody must."""
    return F.when(tier_ == "error", F.array_join(F.slice(found, 1, 3), "; ")).when((tier_ == "low") & (F.size(found) >= 2), F.array_join(F.slice(found, 1, 2), "; "))


def page_score(c: Column, vocabulary: list[str] | None = None) -> Column:
    """score and strategy of a page: letters, breakage, known words and legal
    terms; short pages have rules of their own."""
    n = F.length(c)
    alpha = F.length(F.regexp_replace(c, r"(?U)[^\p{L}]", "")) / n
    broken = F.aggregate(F.regexp_extract_all(c, F.lit("([�■□▪▫]{2,}|\\?{3,}|_{5,})"), F.lit(1)), F.lit(0), lambda k, m: k + F.length(m)) / n
    words = F.regexp_extract_all(F.replace(F.lower(c), F.lit("-"), F.lit(" ")), F.lit("(?U)\\b([a-zÀ-ɏ]{2,})\\b"))
    part = lambda own, known: _part(F.filter(own, lambda w: w.isin(*known)), own)
    rates = _bound(words, lambda own: F.struct(part(own, vocabulary or LEGAL_TERMS).alias("word"), F.least(part(own, LEGAL_TERMS) * 10, F.lit(1.0)).alias("legal")))
    parts = F.struct(alpha.alias("alpha"), broken.alias("broken"), rates.alias("r"))
    blank = F.coalesce(F.trim(c), F.lit("")) == ""

    k = PAGE_WEIGHTS

    def judged(x: Column) -> Column:
        score = k["alpha"] * x["alpha"] + k["whole"] * (1 - x["broken"]) + k["word"] * x["r"]["word"] + k["legal"] * x["r"]["legal"]
        strategy = F.when(n < 5, "ocr").when(n < 20, F.when((x["alpha"] > 0.7) & (x["broken"] < 0.1), "text").otherwise("hybrid")).when(score >= 0.75, "text").when(score >= 0.45, "hybrid").otherwise("ocr")
        return F.struct(F.when(blank, 0.0).otherwise(score).alias("score"), F.when(blank, "ocr").otherwise(strategy).alias("strategy"))

    return _bound(parts, judged)


def year_thresholds(year: Column) -> Column:
    """(pass, warning) by the year of the document; unknown counts as recent."""
    pair = lambda a, b: F.struct(F.lit(a).alias("pass_at"), F.lit(b).alias("warn_at"))
    return F.coalesce(*[F.when(year < before, pair(a, b)) for before, a, b in YEAR_LIMITS[:-1]], pair(*YEAR_LIMITS[-1][1:]))


def validation(c: Column, confidences: Column, year: Column, vocabulary: list[str], min_words: int = 50) -> Column:
    """grade and score of a recognised text: confidence 45, vocabulary 35, legal
    terms 15 and structure 5 percent; below ``min_words`` words it fails."""
    clean = F.trim(F.regexp_replace(F.regexp_replace(F.lower(c), r"(?U)[^\w\s-]", " "), r"(?U)\s+", " "))
    words = F.filter(F.split(clean, " "), lambda w: (F.length(w) > 1) & ~w.rlike(r"^\d+$"))
    low = F.size(F.filter(confidences, lambda x: x < 0.8)) / F.size(confidences)
    mean = F.aggregate(confidences, F.lit(0.0), lambda a, x: a + x) / F.size(confidences) * 100
    confidence = F.when(F.size(confidences) == 0, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(100.0), mean - low * 10)))

    def counted(own: Column) -> Column:
        credit = F.aggregate(own, F.lit(0.0), lambda a, w: a + F.when(w.isin(*vocabulary) | w.rlike(r"\d"), 1.0).when(F.length(w) >= 4, 0.7).otherwise(0.0))
        return F.struct(F.size(own).alias("n"), credit.alias("credit"), F.size(F.array_distinct(F.filter(own, lambda w: w.isin(*LEGAL_TERMS)))).alias("terms"))

    marks = sum((F.least(F.regexp_count(c, F.lit(p)), F.lit(5)) for p in LINE_MARKS), F.lit(0))
    parts = F.struct(_bound(words, counted).alias("w"), marks.alias("marks"), confidence.alias("confidence"), year_thresholds(year).alias("limits"))

    k = VALIDATION_WEIGHTS

    def graded(x: Column) -> Column:
        n = x["w"]["n"]
        score = x["confidence"] * k["confidence"] + x["w"]["credit"] / n * 100 * k["words"] + F.least(x["w"]["terms"] / 10 * 100, F.lit(100.0)) * k["terms"] + F.least(x["marks"] / 15 * 100, F.lit(100.0)) * k["marks"]
        grade = F.when(score >= x["limits"]["pass_at"], "PASS").when(score >= x["limits"]["warn_at"], "WARNING").otherwise("FAIL")
        short = n < min_words
        return F.struct(F.when(short, "FAIL").otherwise(grade).alias("grade"), F.when(short, 0.0).otherwise(score).alias("score"), n.alias("n_words"), x["w"]["terms"].alias("terms"), x["marks"].alias("marks"))

    return _bound(parts, graded)


def simple_quality(c: Column) -> Column:
    """Alphanumerics less too many spaces and special characters, 0 to 1."""
    n = F.length(c)
    alnum = F.length(F.regexp_replace(c, r"(?U)[^\p{L}\p{N}]", "")) / n
    space = (n - F.length(F.replace(c, F.lit(" "), F.lit("")))) / n
    special = F.length(F.regexp_replace(c, r"(?U)[\p{L}\p{N}\s]", "")) / n
    q = alnum - F.greatest(F.lit(0.0), space - 0.3) * 2 - F.greatest(F.lit(0.0), special - 0.1) * 3
    return F.when(F.coalesce(n, F.lit(0)) < 10, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), q)))


def page_source(embedded: Column, quality: Column, ocr: Column) -> Column:
    """Which text of a page to use: the embedded one if long and good enough."""
    return F.when((F.length(embedded) >= 50) & (quality >= 0.7), "embedded").when(F.length(F.coalesce(ocr, F.lit(""))) > 0, "ocr").otherwise("skip")


def density_flags(n_chars_per_page: Column, n_pages: Column, text: Column, repeated_ratio: Column) -> Column:
    """score, flags and needs_ocr from text density, marks and repetition."""
    sample = F.lower(text)
    article, decided = sample.contains("pasal"), sample.contains("memutuskan") | sample.contains("menetapkan")
    many = n_pages > 1
    sparse, thin = many & (n_chars_per_page < 80), many & (n_chars_per_page < 200)
    score = 100.0 - F.when(sparse, 60).when(thin, 30).otherwise(0) - F.when(article, 0).otherwise(20) - F.when(decided, 0).otherwise(15) - F.when(repeated_ratio >= 0.3, 10).otherwise(0)
    score = F.greatest(score, F.lit(0.0))
    flags = F.array_compact(F.array(F.when(thin, "low_text_density"), F.when(~article, "missing_pasal"), F.when(~decided, "missing_decision_marker"), F.when(repeated_ratio >= 0.3, "high_repetition")))
    return F.struct(score.alias("score"), flags.alias("flags"), (sparse | (thin & ~article) | (score < 50)).alias("needs_ocr"))


def nearest_rank(counted: DataFrame, key: str, value: str, p: float) -> DataFrame:
    """key, value: the element of each key at the half-even rounded rank
    ``(n - 1) * p`` of its sorted values, from rows counted per value."""
    order = Window.partitionBy(key).orderBy(value)
    placed = counted.withColumn("__upto", F.sum("n").over(order)).withColumn("__at", F.bround((F.sum("n").over(Window.partitionBy(key)) - 1) * F.lit(p), 0))
    return placed.where((F.col("__upto") > F.col("__at")) & (F.col("__upto") - F.col("n") <= F.col("__at"))).select(key, value)


def low_confidence_pages(lines: DataFrame, key: str, at: str, confidence: str, per_page: int = 50, below: float = 0.85, buckets: int = 1 << 20) -> DataFrame:
    """key, page: pages of ``per_page`` lines with a line below the threshold.

    The place of a line comes from the counts of runs of ``buckets`` values of
    ``at`` before it and its place in its own run, so no task holds a whole key."""
    run = lines.withColumn("__run", F.floor(F.col(at) / buckets))
    counts = run.groupBy(key, "__run").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(key).orderBy("__run").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(key, "__run", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    inside = F.row_number().over(Window.partitionBy(key, "__run").orderBy(at)) - 1
    placed = run.withColumn("__inside", inside).where(F.col(confidence) < below).join(counts, [key, "__run"])
    return placed.select(key, F.floor((F.col("__before") + F.col("__inside")) / per_page).alias("page")).distinct()


def progress_percent(done: Column, total: Column) -> Column:
    return F.coalesce(F.try_divide(done * 100.0, total), F.lit(0.0))


def approval_stage(scores: Column, llm_confidence: Column, limits: Column, retries: int = 5) -> Column:
    """Where a document ends: passed at once, after retries (at most ``retries``,
    stopping at the first that does not improve), by a confident correction, or
    with a person."""
    first = F.get(scores, F.lit(0))
    best = F.aggregate(
        F.slice(scores, 2, retries),
        F.struct(first.alias("best"), F.lit(True).alias("open")),
        lambda a, x: F.when(a["open"] & (x > a["best"]), F.struct(x.alias("best"), F.lit(True).alias("open"))).otherwise(F.struct(a["best"].alias("best"), F.lit(False).alias("open"))),
        lambda a: a["best"],
    )
    retried = (first >= limits["warn_at"]) & (best >= limits["pass_at"])
    return F.when(first >= limits["pass_at"], "auto").when(retried, "auto_retry").when(llm_confidence >= 0.9, "llm").otherwise("human")
