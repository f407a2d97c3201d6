"""Text cleaning and correction as column expressions.

Rules are data (tables below); a pass folds them in order, so later rules see
what earlier ones made.  Patterns carry ``(?U)`` where word classes must cover
Unicode.  Only NFKC, the Ratcliff-Obershelp ratio and the dictionary walk over
words with case rules need vectorised Python, at the end of the module.
"""

from __future__ import annotations

import difflib
import re
import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .vectorized import vectorized

# Patterns and word lists that decide what a text becomes.
PAGE_NOISE = [
    r"^\s*-?\s*\d{1,4}\s*-?\s*$",
    r"^\s*LEMBARAN\s+NEGARA\s*$",
    r"^\s*BERITA\s+NEGARA\s*$",
    r"^\s*REPUBLIK\s+INDONESIA\s*$",
    r"^\s*SALINAN\s*$",
    r"^PRESIDEN$",
    r"^MENTERI$",
    r"^DIREKTUR\s+JENDERAL$",
    r"^SK\s*NO\.?\s*\d+",
    r"www\.peraturan\.go\.id",
    r"www\.djpp\.[a-z0-9.-]+",
]
WATERMARKS = [
    r"www\.djpp\.depkumham\.go\.id",
    r"www\.peraturan\.go\.id",
    r"ditjen Peraturan Perundang-undangan",
    r"jdih\.kemenkeu\.go\.id",
    r"Direktorat Jenderal Peraturan Perundang-undangan",
]
PAGE_HEADERS = [
    r"PRESIDEN\s*",
    r"PRESIDEN\s+REPUBLIK\s+INDONESIA\s*",
    r"REPUBLIK\s+INDONESIA\s*",
    r"PRESTDEN\s*",
    r"REPUBLTK\s+INDONESIA\s*",
    r"SK\s*No\s*[\d\s]+[A-Z]?\s*",
    r"-\s*\d+\s*-\s*",
    r"\d{1,3}\s*",
    r"\.{3,}\s*",
    r"…+\s*",
    r"Pasal\s+\d+\s*\.\.\.\s*",
    r"[A-Z]\.\s*Pasal\s+\d+\s*\.\.\.\s*",
]
OCR_FIXES = [
    (r"(\d)O(\d)", "$10$2"),
    (r"O(\d{3})", "0$1"),
    (r"(\d{3})O", "$10"),
    (r"\bl(\d)", "1$1"),
    (r"(\d)l\b", "$11"),
    (r"PRESTDEN", "PRESIDEN"),
    (r"REPUBLTK", "REPUBLIK"),
    (r"INDONES[1I]A", "INDONESIA"),
    (r"kmbaran", "Lembaran"),
    (r"tentartg", "tentang"),
    (r"ssfegian", "sebagian"),
    (r"pefanjian", "perjanjian"),
    (r"izrn", "izin"),
    (r"ruP", "IUP"),
    (r"UNDANG\.UNDANG", "UNDANG-UNDANG"),
    (r"UNDANG\s*-\s*UNDANG", "UNDANG-UNDANG"),
    (r"Pasall", "Pasal I"),
    (r"\s*:\s*", ": "),
    (r"\s*;\s*", "; "),
]
OCR_NOISE = [
    r"[\$\+\-\*\#\@\!\%\^\&\=]{2,}",
    r"[\°\±\×\÷\¥\€\£]{1,}",
    r"\d+\.\d+[\°\%]",
    r"(?U)(?<!\w)[a-zA-Z]\s*[\+\-\*]\s*[a-zA-Z](?!\w)",
    r"più",
    r"STATE\s*S",
    r"N\s*\d+\.\s*\$\d+",
    r"ay\s*±[\d\.\,]+",
    r"[\.\-\=\_]{5,}",
    r"(?:--\s*){2,}",
]
REGEX_CORRECTIONS = [
    (r"\b(19|20)[Oo](\d)\b", "$10$2"),
    (r"\b(19|20)(\d)[Oo]\b", "$1$20"),
    (r"\b(19|20)[Oo][Oo]\b", "$100"),
    (r"\b(\d+)O(\d+)\b", "$10$2"),
    (r"\b(\d)O(\d)\b", "$10$2"),
    (r"\bO(\d{2,})\b", "0$1"),
    (r"\b(\d{2,})O\b", "$10"),
    (r"(?i)\bPasal\s+[Oo](\d+)\b", "Pasal $1"),
    (r"(?i)\bAyat\s*\([Oo]\)", "Ayat (0)"),
    (r"(?i)(?:ayat|huruf)\s*\([Il|!1]\)", "(1)"),
    (r"[—–−]", "-"),
    (r"[ \t]{2,}", " "),
    (r"(?U)(\w)\s*-\s*(\w)", "$1-$2"),
]
LIGATURES = [("rn", "m"), ("cl", "d"), ("vv", "w")]
OLD_SPELLING = [("tj", "c"), ("dj", "j"), ("nj", "ny"), ("sj", "sy"), ("ch", "kh")]
CORE_WORDS = {
    "indonesia", "republik", "presiden", "pemerintah", "negara", "menteri", "gubernur", "bupati", "walikota", "daerah", "undang", "peraturan", "keputusan", "instruksi", "penetapan", "perpres",
    "perppu", "permen", "keppres", "inpres", "pasal", "ayat", "huruf", "angka", "bab", "bagian", "paragraf", "ketentuan", "umum", "penutup", "peralihan", "menimbang", "mengingat", "memutuskan",
    "menetapkan", "menyatakan", "memerintahkan", "mengatur", "melarang", "tentang", "dengan", "dalam", "untuk", "bahwa", "sebagai", "terhadap", "lembaga", "badan", "nomor", "tahun", "salinan",
    "lampiran", "penjelasan", "perubahan", "tuhan", "rahmat", "berkat", "atas", "adalah", "dapat", "harus", "wajib", "tidak", "atau", "dan", "setiap", "semua", "lain", "tersebut",
    "sebagaimana",
}
COMMON_ERRORS = {
    "pernerintah": "pemerintah",
    "pernbangunan": "pembangunan",
    "kernenterian": "kementerian",
    "rnasyarakat": "masyarakat",
    "pernbentukan": "pembentukan",
    "rnenetapkan": "menetapkan",
    "rnengingat": "mengingat",
    "rnenimbang": "menimbang",
    "rnenteri": "menteri",
    "pernberlakuan": "pemberlakuan",
    "unclang": "undang",
    "keaclilan": "keadilan",
    "pencliclikan": "pendidikan",
    "keputusclan": "keputusan",
    "clengan": "dengan",
    "claiam": "dalam",
    "lavv": "law",
    "nevv": "new",
    "wvajib": "wajib",
    "lndonesia": "indonesia",
    "lnstruksi": "instruksi",
    "lnpres": "inpres",
    "republlk": "republik",
    "presiclen": "presiden",
    "repub1ik": "republik",
    "repub|ik": "republik",
    "REPUBLIC": "REPUBLIK",
    "UNDANGUNDANG": "UNDANG-UNDANG",
}
#: Old spellings that the letter rules do not reach.
OLD_WORDS = {
    "jang": "yang",
    "jaitu": "yaitu",
    "jogjakarta": "yogyakarta",
    "jogja": "yogya",
    "pertjaja": "percaya",
    "ketentjuan": "ketentuan",
    "oemoem": "umum",
    "boekoe": "buku",
    "koempoelan": "kumpulan",
    "soedah": "sudah",
    "boelan": "bulan",
}
DIGIT_LETTERS = {"0": "O", "1": "I", "3": "E", "4": "A", "5": "S", "7": "T", "8": "B"}
SPECIAL_LETTERS = {"!": "I", "|": "L", "$": "S", "@": "A"}


def collapse(c: Column) -> Column:
    """Unicode white space to single spaces, trimmed."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def split_lines(c: Column) -> Column:
    """Lines by every Unicode line end; a final line end opens no line."""
    parts = F.split(F.regexp_replace(c, r"\r\n", "\n"), r"[\n\r\x0B\x0C\x1C-\x1E\x85  ]", -1)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def normalize_line(c: Column, min_len: int = 4) -> Column:
    """Key for comparing lines; "" for digits only and for short ones."""
    s = F.lower(collapse(c))
    return F.when((F.length(s) < min_len) | s.rlike(r"^(?U)\d+$"), "").otherwise(s)


def any_match(c: Column, patterns: list[str]) -> Column:
    """Whether one of the patterns is found anywhere, ignoring case."""
    return reduce(lambda a, b: a | b, [c.rlike(f"(?i){p}") for p in patterns], F.lit(False))


def fold(c: Column, rules: list[tuple[str, str]]) -> Column:
    return reduce(lambda x, r: F.regexp_replace(x, r[0], r[1]), rules, c)


def remove_watermarks(c: Column) -> Column:
    return fold(c, [(f"(?i){p}", "") for p in WATERMARKS])


def remove_page_headers(c: Column) -> Column:
    """Drop lines that are nothing but a page header or number."""
    whole = f"(?i)^(?:{'|'.join(PAGE_HEADERS)})$"
    return F.array_join(F.filter(F.split(c, "\n", -1), lambda line: ~F.trim(line).rlike(whole)), "\n")


def fix_ocr(c: Column) -> Column:
    return fold(c, OCR_FIXES)


def normalize_whitespace(c: Column) -> Column:
    """Single spaces, trimmed lines, at most two blank lines in a row."""
    squeezed = F.regexp_replace(c, r"(?U)[^\S\n]+", " ")
    trimmed = F.regexp_replace(F.regexp_replace(squeezed, r"(?m)^ | $", ""), r"(?m)^ | $", "")
    return F.regexp_replace(F.regexp_replace(trimmed, r"^\n{2,}", "\n\n"), r"\n{4,}", "\n\n\n")


_STRUCTURAL = r"(?i)^(?:BAB\s+[IVXLCDM]+|Pasal\s+\d+|Pasal\s+[IVXLCDM]+|Bagian\s+|Paragraf\s+|\(\d+\)|[a-z]\.\s|\d+\.\s|\d+[a-z]\.\s|Menimbang|Mengingat|Menetapkan|MEMUTUSKAN|DENGAN RAHMAT|PENJELASAN|I\.\s+UMUM|II\.\s+PASAL|UNDANG-UNDANG\s+TENTANG|UNDANG-UNDANG\s+NOMOR)"


def rejoin_lines(c: Column) -> Column:
    """Join lines that were broken inside a sentence: a fold over the lines with
    the finished lines and an open one as state."""

    def joins(last: Column, line: Column) -> Column:
        ended = last.rlike(r"[.;:!?]\s*$") & ~last.rlike(r"\b(?:No|Pasal|dst|dll|dsb)\.$")
        opener = line.rlike(r"^[A-Z]{2,}") | line.rlike(r"^[\d()a-z]\.?\s")
        return ~ended & ~opener & last.rlike(r"(?U)(?:-|\p{Ll}\s*|,\s*)$")

    def step(acc: Column, raw: Column) -> Column:
        line, last, done = F.trim(raw), acc["last"], acc["done"]
        flushed = F.when(last == "", done).otherwise(F.concat(done, F.array(last)))
        new = F.when(
            line == "", F.struct(F.concat(flushed, F.array(F.lit(""))).alias("done"), F.lit("").alias("last"))
        )
        new = new.when((last != "") & ~line.rlike(_STRUCTURAL) & joins(last, line), F.struct(done.alias("done"), F.when(last.endswith("-"), F.concat(F.rtrim(F.substr(last, F.lit(1), F.length(last) - 1)), line)).otherwise(F.concat(last, F.lit(" "), line)).alias("last")))
        return new.otherwise(F.struct(flushed.alias("done"), line.alias("last")))

    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("last"))
    return F.aggregate(F.split(c, "\n", -1), start, step, lambda acc: F.array_join(F.when(acc["last"] == "", acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["last"]))), "\n"))


def preprocess(c: Column) -> Column:
    """Watermarks, page headers, OCR fixes, line joins and white space, in order."""
    return normalize_whitespace(rejoin_lines(fix_ocr(remove_page_headers(remove_watermarks(c)))))


def join_hyphen_breaks(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)(\w+)-\s*\n\s*(\w+)", "$1-$2")


def strip_html(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"(?i)<br\s*/?>", "\n"), r"(?i)</?(?:br|p|div|span|b|i|u|strong|em)[^>]*>", "")


def drop_noise(c: Column) -> Column:
    return F.regexp_replace(fold(c, [(p, " ") for p in OCR_NOISE]), " {2,}", " ")


def regex_corrections(c: Column) -> Column:
    """Years, zeroes, chapter numerals, dashes and spacing."""
    # one stand-in for an I after another: each step turns the first that is left
    for _ in range(8):
        c = F.regexp_replace(c, r"(?i)\bBAB\s+(I*)[1|!](?=[1|!]*\b)", "BAB $1I")
    return fold(c, REGEX_CORRECTIONS)


def punctuation_parts(word: Column) -> Column:
    """prefix, core and suffix of a word around its first and last alphanumeric."""
    p = r"^([^\p{L}\p{N}]*)(.*?)([^\p{L}\p{N}]*)$"
    return F.struct(*[F.regexp_extract(word, p, i + 1).alias(n) for i, n in enumerate(("prefix", "core", "suffix"))])


def slugify(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(c), r"[^a-z0-9\s-]", ""), r"[\s-]+", "-"), F.lit("-"))


def xml_safe(c: Column) -> Column:
    return F.regexp_replace(c, r"[\x00-\x08\x0B\x0C\x0E-\x1F]", "")


def tokens(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit("([a-z0-9]+)"))


def alnum_ratio(c: Column) -> Column:
    """Share of alphanumerics among the characters that are not white space."""
    solid = F.length(F.regexp_replace(c, r"(?U)\s", ""))
    return F.coalesce(F.try_divide(F.length(F.regexp_replace(c, r"(?U)[^\p{L}\p{N}]", "")), solid), F.lit(0.0))


def jaccard(a: Column, b: Column) -> Column:
    """Of two token arrays as sets: both empty 1, one empty 0."""
    both = F.size(F.array_union(a, b))
    return F.when(both == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / both)


def bounded_levenshtein(a: Column, b: Column, most: int) -> Column:
    """Edit distance, ``most`` + 1 for anything beyond ``most``."""
    d = F.levenshtein(a, b, most)
    return F.when(d < 0, most + 1).otherwise(d)


def character_error_rate(reference: Column, other: Column) -> Column:
    """Exact edit distance over the length of the reference."""
    return F.try_divide(F.levenshtein(reference, other), F.length(reference))


def header_metadata(c: Column) -> Column:
    """law_type, nomor, tahun and tentang from a first page; longer names are
    tested before the shorter ones they contain."""
    kinds = [("PERATURAN PEMERINTAH PENGGANTI UNDANG-UNDANG", "PERPPU"), ("UNDANG-UNDANG", "UU"), ("PERATURAN PEMERINTAH", "PP"), ("PERATURAN PRESIDEN", "PERPRES"), ("PERATURAN MENTERI", "PERMEN")]
    kind = F.coalesce(*[F.when(c.rlike(f"(?i){p}"), k) for p, k in kinds])
    number = r"(?i)NOMOR\s+(\d+)\s+TAHUN\s+(\d{4})"
    title = F.substring(collapse(F.regexp_extract(c, r"(?is)TENTANG\s+(.+?)(?=\n\n|DENGAN RAHMAT|$)", 1)), 1, 500)
    empty = lambda x: F.when(x != "", x)
    return F.struct(kind.alias("law_type"), empty(F.regexp_extract(c, number, 1)).alias("nomor"), F.regexp_extract(c, number, 2).try_cast("int").alias("tahun"), empty(title).alias("tentang"))


def body_slice(c: Column) -> Column:
    """What stands between the enacting words and the place of enactment."""
    start = F.regexp_instr(c, F.lit(r"(?i)MEMUTUSKAN\s*:?|MENETAPKAN\s*:?"))
    head = F.length(F.regexp_substr(c, F.lit(r"(?i)MEMUTUSKAN\s*:?|MENETAPKAN\s*:?")))
    rest = F.when(start > 0, F.substr(c, start + head, F.length(c))).otherwise(c)
    end = F.regexp_instr(rest, F.lit(r"(?i)Ditetapkan\s+di"))
    return F.trim(F.when(end > 0, F.substr(rest, F.lit(1), end - 1)).otherwise(rest))


def line_category(c: Column) -> Column:
    """What kind of header line this is."""
    s = F.trim(c)
    return (
        F.when(s.rlike(r"^-?\s*\d{1,4}\s*-?$"), "page_number")
        .when(s.rlike(r"(?i)^(?:presiden|republik|menteri)"), "institution")
        .when(s.rlike(r"(?i)nomor|tahun"), "number")
        .when(s.rlike(r"(?i)www\.|http"), "url")
        .when((F.upper(s) == s) & (F.length(s) > 3), "heading")
        .otherwise("text")
    )


def year_in_name(name: Column) -> Column:
    """A year from a file name by three patterns in order, 1900 to 2100."""
    found = [F.regexp_extract(name, p, 1).try_cast("int") for p in (r"(?i)tahun[-_ ]?(\d{4})", r"[-_ ](\d{4})(?=[-_. ]|$)", r"(\d{4})")]
    return F.coalesce(*[F.when(y.between(1900, 2100), y) for y in found])


# word by word, with case rules


_OLD_LETTERS = dict(OLD_SPELLING)
_OLD = re.compile("|".join(_OLD_LETTERS))


def preserve_case(original: str, new: str) -> str:
    if original.isupper():
        return new.upper()
    if original.islower():
        return new.lower()
    return new.title() if original.istitle() else new


def _parts(word: str) -> tuple[str, str, str]:
    a, b = 0, len(word)
    while a < b and not word[a].isalnum():
        a += 1
    while b > a and not word[b - 1].isalnum():
        b -= 1
    return word[:a], word[a:b], word[b:]


def correct_word(core: str, dictionary: dict[str, str], old: dict[str, str]) -> tuple[str, str]:
    """The corrected word and the rule that applied ("" if none)."""
    low = core.lower()
    if low in CORE_WORDS:
        return core, ""
    if low in dictionary:
        return preserve_case(core, dictionary[low]), "dictionary"
    if not core.isdigit() and any(ch.isalpha() for ch in core):
        swapped = "".join(DIGIT_LETTERS.get(ch) or SPECIAL_LETTERS.get(ch) or ch for ch in core)
        if core.islower() or (swapped != core and core[-1:].islower()):
            swapped = swapped.lower() if core.islower() else swapped
        if swapped != core and (swapped.lower() in CORE_WORDS or (swapped.isalpha() and len(swapped) > 1)):
            return swapped, "digit_to_letter"
    for wrong, right in LIGATURES:
        if wrong in low and low.replace(wrong, right) in CORE_WORDS:
            return preserve_case(core, low.replace(wrong, right)), "ligature"
    if low in old:
        return preserve_case(core, old[low]), "old_spelling"
    new = _OLD.sub(lambda m: _OLD_LETTERS[m[0]], low)  # in one pass: what dj becomes is no nj
    return (preserve_case(core, new), "old_spelling") if new != low else (core, "")


def word_corrector(dictionary: dict[str, str] | None = None, old: dict[str, str] | None = None, old_spelling: bool = True):
    """A vectorised column function that corrects a text word by word.  Each
    distinct word of a batch is judged once; white space is kept as it is."""
    d, o = {k.lower(): v for k, v in (dictionary or {}).items()}, {k.lower(): v for k, v in (old or {}).items()}

    @F.pandas_udf("string")
    def correct(texts: pd.Series) -> pd.Series:
        known: dict[str, str] = {}

        def fix(m: re.Match) -> str:
            word = m[0]
            if word not in known:
                a, core, z = _parts(word)
                new, rule = correct_word(core, d, o) if core else (core, "")
                known[word] = a + (core if rule == "old_spelling" and not old_spelling else new) + z
            return known[word]

        return texts.map(lambda t: None if t is None else re.sub(r"\S+", fix, t))

    return correct


def detected_errors(docs: DataFrame, key: str, dictionary: dict[str, str] | None = None) -> DataFrame:
    """key, at, word, corrected and kind of every word a rule would change,
    without changing the text; distinct words are judged once."""
    d = {k.lower(): v for k, v in (dictionary or {}).items()}

    @F.pandas_udf("struct<corrected:string,kind:string>")
    def judge(words: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([correct_word(_parts(w)[1], d, {}) if _parts(w)[1] else ("", "") for w in words], columns=["corrected", "kind"])

    words = docs.select(key, F.posexplode(F.split(F.trim("text"), r"\s+")).alias("at", "word"))
    verdicts = words.select("word").distinct().withColumn("v", judge("word"))
    return words.join(verdicts, "word").where("v.kind <> ''").select(key, "at", "word", "v.*")


@vectorized("string")
def nfkc(texts: pd.Series) -> pd.Series:
    """NFKC without soft hyphens and zero-width marks, plain quotes and dashes,
    hyphenation undone, white space collapsed."""
    table = str.maketrans({**{chr(c): "" for c in (0xAD, 0x200B, 0x200C, 0x200D, 0xFEFF)}, **{chr(c): "-" for c in (0x2010, 0x2011, 0x2012, 0x2013, 0x2014, 0x2212)}, **{chr(c): "'" for c in (0x2018, 0x2019, 0x201B)}, **{chr(c): '"' for c in (0x201C, 0x201D, 0x201E)}, " ": " "})
    return texts.map(lambda t: "" if not t else " ".join(unicodedata.normalize("NFKC", t).translate(table).replace("-\n", "").replace("-\r\n", "").split()))


@vectorized("double")
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp similarity (two empty texts: 1)."""
    return pd.Series([difflib.SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b, strict=True)])


def better_text(a: Column, b: Column, similarity: Column, quality_a: Column, quality_b: Column) -> Column:
    """The only one that is not empty; nearly equal: the first; else the better."""
    return F.when(a == "", b).when(b == "", a).when(similarity >= 0.9, a).when(quality_b > quality_a, b).otherwise(a)
