"""Small record classifiers: folders, file states, names, word lists, notes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .legal import short_type
from .quality import LEGAL_TERMS
from .text import CORE_WORDS, collapse

# Abbreviations and stop words.
ABBREVIATIONS = {"dll": "dan lain-lain", "dsb": "dan sebagainya", "dst": "dan seterusnya", "no": "nomor", "tgl": "tanggal", "yg": "yang", "dgn": "dengan"}
STOPWORDS = [
    "yang", "dan", "di", "ke", "dari", "untuk", "pada", "dengan", "adalah", "ini", "itu", "dalam", "atau", "oleh", "sebagai", "tidak", "akan",
]


def folder(kind: Column) -> Column:
    return F.concat(F.lit("pdfs/"), short_type(kind))


def needs_download(url: Column, size: Column) -> Column:
    """There is an address and no file, or an empty one."""
    return ~(url.isNull() | (url == "") | (url == "NO_PDF")) & (size.isNull() | (size == 0))


def file_state(kind: Column, text_length: Column) -> Column:
    """"html_error", "scanned", "text" or "unknown" of a fetched file."""
    return F.when(kind == "html", "html_error").when((kind == "pdf") & (text_length < 100), "scanned").when(kind == "pdf", "text").otherwise("unknown")


def status_meta(status: Column) -> Column:
    low = F.lower(F.coalesce(status, F.lit("")))
    return F.when(low.contains("dicabut"), "revoked").when(low.contains("diubah"), "amended").when(low.contains("tidak berlaku"), "inactive").when(low.contains("berlaku"), "active").otherwise("unknown")


def is_scanned(chars: Column, pages: Column) -> Column:
    return (pages > 1) & (chars / pages < 100)


def document_uri(kind: Column, year: Column, number: Column, level: str = "work") -> Column:
    """Identifier by level: work, expression (with language), manifestation."""
    base = F.concat(F.lit("/akn/id/act/"), F.lower(kind), F.lit("/"), year, F.lit("/"), number)
    return F.concat(base, F.lit({"work": "", "expression": "/ind@", "manifestation": "/ind@/main.xml"}[level]))


def constitution_version(name: Column) -> Column:
    """Which text of the constitution a file name means."""
    low = F.lower(F.url_decode(name))
    return F.when(low.contains("keempat"), 4).when(low.contains("ketiga"), 3).when(low.contains("kedua"), 2).when(low.contains("pertama") | low.contains("perubahan"), 1).otherwise(0)


def expand_abbreviation(word: Column) -> Column:
    table = F.create_map(*[F.lit(x) for p in ABBREVIATIONS.items() for x in p])
    return F.coalesce(F.try_element_at(table, F.lower(F.rtrim(word, F.lit(".")))), word)


def word_analysis(c: Column) -> Column:
    """total, known, legal and stop words of a text, and the known share."""
    words = F.regexp_extract_all(F.lower(c), F.lit("([a-z]+)"))
    count = lambda vocabulary: F.size(F.filter(words, lambda w: w.isin(*sorted(vocabulary))))
    known = count(set(CORE_WORDS) | set(LEGAL_TERMS))
    return F.struct(F.size(words).alias("total"), known.alias("known"), count(LEGAL_TERMS).alias("legal"), count(STOPWORDS).alias("stop"), F.coalesce(F.try_divide(known, F.size(words)), F.lit(0.0)).alias("share"))


def explanations(docs: DataFrame, key: str = "slug") -> DataFrame:
    """article -> explanation of the notes at the end of a law; the stock phrase
    for "clear enough" gives an empty note."""
    notes = F.regexp_extract("text", r"(?is)PENJELASAN(.*)$", 1)
    parts = F.slice(F.split(notes, r"(?im)^\s*(?=Pasal\s+\d+\s*$)"), 2, 100_000)
    one = docs.select(key, F.explode(F.when(notes != "", parts)).alias("p"))
    body = collapse(F.regexp_extract("p", r"(?is)^Pasal\s+\d+\s*\n(.*)$", 1))
    return one.select(key, F.regexp_extract("p", r"(?i)^Pasal\s+(\d+)", 1).cast("int").alias("article"), F.when(body.rlike(r"(?i)^cukup jelas\.?$"), "").otherwise(body).alias("note")).where("article is not null")


def strip_stamps(c: Column) -> Column:
    """Control characters and copy stamps removed."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"[\x00-\x08\x0B\x0C\x0E-\x1F]", ""), r"(?im)^\s*(?:SALINAN|SK\s*No\.?\s*[\dA-Z ]+)\s*$\n?", ""))


def text_flags(c: Column) -> Column:
    """needs_ocr, marks and distinct articles of a document text."""
    found = F.array_distinct(F.regexp_extract_all(c, F.lit(r"(?i)Pasal\s+(\d+)"), F.lit(1)))
    return F.struct((F.length(c) < 100).alias("needs_ocr"), c.rlike(r"(?i)menimbang").alias("has_preamble"), c.rlike(r"(?i)penjelasan").alias("has_notes"), F.size(found).alias("n_articles"))
