"""References, relations, clauses and validity from legal prose."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .legal import slug
from .text import collapse

# Reference forms and the phrases that tell relations apart, in order of precedence.
KINDS = r"Peraturan\s+Pemerintah\s+Pengganti\s+Undang[- ]?Undang|Perppu|Undang[- ]?Undang|UU|Peraturan\s+Pemerintah|PP|Peraturan\s+Presiden|Perpres|Peraturan\s+Menteri|Permen"
REFERENCE = rf"(?i)((?:{KINDS})\s*(?:Nomor|No\.?)\s*\d+\s*Tahun\s*\d{{4}})"
RELATIONS = [
    ("MENCABUT", r"(?:dicabut|mencabut)\s+(?:dan\s+)?(?:dinyatakan\s+)?(?:tidak\s+berlaku)|dinyatakan\s+tidak\s+berlaku|(?:dengan\s+berlakunya|sejak\s+berlakunya).*?dicabut"),
    ("MENGUBAH", r"perubahan\s+(?:atas|terhadap|kedua|ketiga|keempat|kelima)|mengubah\s+(?:ketentuan|beberapa\s+ketentuan)|diubah\s+dengan"),
    ("BERLAKU_BERSYARAT", r"sepanjang\s+tidak\s+bertentangan|tetap\s+berlaku\s+sepanjang|dinyatakan\s+(?:masih\s+)?tetap\s+berlaku\s+sepanjang"),
    ("MASA_PERALIHAN", r"tetap\s+berlaku\s+sampai\s+(?:dengan\s+)?(?:ditetapkannya|diundangkannya)|berlaku\s+sampai\s+dengan\s+(?:ditetapkan|diundangkan)|masih\s+tetap\s+berlaku\s+sampai"),
    ("MENGIMPLEMENTASI", r"(?:untuk\s+)?melaksanakan\s+(?:ketentuan|pasal)|sebagai\s+pelaksanaan\s+(?:dari|atas)|peraturan\s+pelaksanaan\s+(?:dari|atas)"),
    ("MERUJUK", r"sebagaimana\s+(?:dimaksud|diatur)\s+(?:dalam|oleh)|berdasarkan\s+(?:ketentuan|pasal)|sesuai\s+(?:dengan\s+)?(?:ketentuan|pasal)"),
]
CONDITIONS = [
    ("SEPANJANG_TIDAK_BERTENTANGAN", r"(?i)((?:dinyatakan\s+)?(?:masih\s+)?tetap\s+berlaku\s+sepanjang\s+tidak\s+bertentangan\s+dengan[^.]{10,200})"),
    ("TETAP_BERLAKU_SAMPAI", r"(?i)(tetap\s+berlaku\s+sampai\s+(?:dengan\s+)?(?:ditetapkannya|diundangkannya)[^.]{10,150})"),
    ("DICABUT_DAN_TIDAK_BERLAKU", r"(?i)(dicabut\s+dan\s+dinyatakan\s+tidak\s+berlaku[^.]{0,100})"),
]

REFERENCE_TAIL = r"(?i)(?:Nomor|No\.?)\s*(\d+)\s*Tahun\s*(\d{4})"
CONDITION_PHRASES = [r"(?i)(sepanjang\s+tidak\s+bertentangan[^.;]*)", r"(?i)(sampai\s+(?:dengan\s+)?(?:ditetapkannya|diundangkannya)[^.;]*)"]
BASIS = r"(?i)Pasal\s+(\d+)(?:\s+ayat\s+\((\d+)\))?"
AMENDING_TITLE = r"(?i)perubahan\s+(?:atas|kedua|ketiga|keempat|kelima)"
INTERNAL = r"(?i)(?:dimaksud|diatur)\s+(?:dalam|pada|di)\s+(?:ketentuan\s+)?(Pasal\s+\d+[A-Za-z]?(?:\s+ayat\s*\(\d+\))?(?:\s+huruf\s+[a-z]\b)?)"
CONFLICT = r"(?i)^(.*?)sepanjang tidak bertentangan dengan\s+(.+)$"
CONFLICT_SUBJECT = r"(?i)(?:^|,\s*)([^,]+?)\s+(?:dinyatakan\s+)?(?:masih\s+)?(?:tetap\s+)?berlaku"
STATUS_RELATION = r"(?i){word} Oleh\s*:\s*(.+?\s*(?:Nomor|No\.?)\s*\d+\s*Tahun\s*\d+)"
STATUS_PARTS = r"(?i)^(.+?)\s*(?:Nomor|No\.?)\s*(\d+)\s*Tahun\s*(\d+)$"
VALIDITY_SURE = {"revoked": 0.95, "amended": 0.85, "conditional": 0.70, "transitional": 0.65, "own": 0.90, "none": 0.40}


def reference_kind(c: Column) -> Column:
    """Short kind of a reference text; the longer names come first."""
    low = F.lower(c)
    return (
        F.when(low.contains("pengganti") | low.startswith("perppu"), "PERPPU")
        .when(low.rlike(r"undang[- ]?undang") | low.startswith("uu"), "UU")
        .when(low.rlike(r"peraturan\s+pemerintah") | low.startswith("pp"), "PP")
        .when(low.rlike(r"peraturan\s+presiden") | low.startswith("perpres"), "PERPRES")
        .when(low.rlike(r"peraturan\s+menteri") | low.startswith("permen"), "PERMEN")
    )


def reference(c: Column) -> Column:
    """kind, number, year and slug of one reference text."""
    kind, number, year = reference_kind(c), F.regexp_extract(c, REFERENCE_TAIL, 1), F.regexp_extract(c, REFERENCE_TAIL, 2).try_cast("int")
    return F.struct(kind.alias("kind"), number.alias("number"), year.alias("year"), slug(kind, number, year).alias("target"))


def references(c: Column) -> Column:
    return F.transform(F.regexp_extract_all(c, F.lit(REFERENCE), F.lit(1)), reference)


def relation_type(sentence: Column) -> Column:
    out = None
    for name, pattern in RELATIONS:
        hit = sentence.rlike(f"(?i){pattern}")
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out


def condition_phrase(sentence: Column) -> Column:
    return F.coalesce(*[F.when(sentence.rlike(p), F.trim(F.regexp_extract(sentence, p, 1))) for p in CONDITION_PHRASES])


def article_basis(sentence: Column) -> Column:
    article, clause = F.regexp_extract(sentence, BASIS, 1), F.regexp_extract(sentence, BASIS, 2)
    return F.when(article != "", F.concat(F.lit("Pasal "), article, F.when(clause != "", F.concat(F.lit(" ayat ("), clause, F.lit(")"))).otherwise("")))


def title_amendments(records: DataFrame) -> DataFrame:
    """Amendment links from titles: slug -> the first reference."""
    hit = F.col("tentang").rlike(AMENDING_TITLE)
    first = F.get(references(F.col("tentang")), F.lit(0))
    return records.where(hit).select("slug", first.alias("r")).where("r.target is not null").select("slug", "r.target", F.lit("MENGUBAH").alias("rel_type"))


def text_relations(docs: DataFrame, keep_unparsed: bool = False) -> DataFrame:
    """Relations from sentences (cut at . and ;, 20 characters or more) that hold
    a reference and a phrase; each reference of a sentence gives one row."""
    protected = F.regexp_replace("text", r"(?i)\bNo\.", "No")
    s = docs.select("slug", F.posexplode(F.split(protected, "[.;]")).alias("at", "sentence")).where(F.length("sentence") >= 20)
    s = s.withColumn("rel_type", relation_type(F.col("sentence"))).where("rel_type is not null")
    s = s.select("*", F.posexplode(references(F.col("sentence"))).alias("nth", "r"))
    conditional = F.col("rel_type").isin("BERLAKU_BERSYARAT", "MASA_PERALIHAN")
    out = s.select("slug", "at", "nth", "rel_type", "r.kind", "r.number", "r.year", "r.target", article_basis(F.col("sentence")).alias("basis"), F.when(conditional, condition_phrase(F.col("sentence"))).alias("condition"), F.substring(F.trim("sentence"), 1, 300).alias("raw"))
    return out if keep_unparsed else out.where("target is not null")


def internal_references(c: Column) -> Column:
    """"Pasal n [ayat (m) [huruf x]]" of references within the same text."""
    return F.transform(F.regexp_extract_all(c, F.lit(INTERNAL), F.lit(1)), collapse)


def conditional_clauses(docs: DataFrame) -> DataFrame:
    """slug, clause_type, text (200 characters) and first target of clauses."""
    out = None
    for name, pattern in CONDITIONS:
        one = docs.select("slug", F.lit(name).alias("clause_type"), F.explode(F.regexp_extract_all("text", F.lit(pattern), F.lit(1))).alias("text"))
        out = one if out is None else out.unionByName(one)
    text = collapse(F.col("text"))
    return out.select("slug", "clause_type", F.substring(text, 1, 200).alias("text"), F.get(references(text), F.lit(0))["target"].alias("target"))


def conflict_clauses(docs: DataFrame) -> DataFrame:
    """subject, condition and sentence of "as far as not contrary to" clauses."""
    s = docs.select("slug", F.explode(F.split("text", "[.;]")).alias("s")).where(F.lower("s").contains("sepanjang tidak bertentangan"))
    s = s.withColumn("s", collapse(F.col("s"))).where(F.length("s") >= 20)
    s = s.where(F.col("s").rlike(CONFLICT))
    before, condition = F.regexp_extract("s", CONFLICT, 1), F.regexp_extract("s", CONFLICT, 2)
    subject = F.trim(F.regexp_extract(before, CONFLICT_SUBJECT, 1))
    return s.select("slug", F.substring(F.when(subject != "", subject).otherwise(F.trim(F.substring(before, -100, 100))), 1, 200).alias("subject"), F.substring(F.trim(condition), 1, 200).alias("condition"), F.substring("s", 1, 500).alias("sentence"))


def status_relations(records: DataFrame) -> DataFrame:
    """Relations that a status string spells out ("Dicabut Oleh : X Nomor n Tahun y")."""
    out = None
    for word, kind in (("Dicabut", "DICABUT_OLEH"), ("Diubah", "DIUBAH_OLEH")):
        p = STATUS_RELATION.replace("{word}", word)
        one = records.select("slug", F.lit(kind).alias("rel_type"), F.explode(F.regexp_extract_all("status", F.lit(p), F.lit(1))).alias("x"))
        out = one if out is None else out.unionByName(one)
    return out.select("slug", "rel_type", F.trim(F.regexp_extract("x", STATUS_PARTS, 1)).alias("kind"), F.regexp_extract("x", STATUS_PARTS, 2).alias("number"), F.regexp_extract("x", STATUS_PARTS, 3).cast("int").alias("year"))


def validity(records: DataFrame, edges: DataFrame) -> DataFrame:
    """Validity of each record from its incoming edges (src, dst, rel_type), in
    order: revoked, amended, conditional, transitional, then its own status."""
    kinds = {"revoked": ("MENCABUT", "DICABUT"), "amended": ("MENGUBAH", "DIUBAH"), "conditional": ("BERLAKU_BERSYARAT",), "transitional": ("MASA_PERALIHAN",)}
    up = F.upper("rel_type")
    facts = edges.groupBy(F.col("dst").alias("slug")).agg(*[F.count(F.when(up.isin(*v), 1)).alias(f"n_{k}") for k, v in kinds.items()])
    j = records.join(facts, "slug", "left")
    low = F.lower(F.coalesce("status", F.lit("")))
    gone = low.contains("tidak berlaku") | low.contains("dicabut")
    has = {k: F.coalesce(F.col(f"n_{k}"), F.lit(0)) > 0 for k in kinds}
    state = F.when(has["revoked"], "DICABUT").when(has["amended"], "DIUBAH").when(has["conditional"], "BERLAKU_BERSYARAT").when(has["transitional"], "MASA_PERALIHAN")
    state = state.when(gone, "TIDAK_BERLAKU").when(low.contains("berlaku") & ~low.contains("tidak"), "BERLAKU").otherwise("UNCERTAIN")
    sure = F.coalesce(*[F.when(has[k], VALIDITY_SURE[k]) for k in kinds], F.when(gone | low.contains("berlaku"), VALIDITY_SURE["own"]), F.lit(VALIDITY_SURE["none"]))
    return j.select("slug", state.alias("validity"), sure.alias("confidence"))


def status_record(relations: DataFrame) -> DataFrame:
    """Flags, sorted tags and targets per source from its relations."""
    t = F.col("rel_type")
    return relations.where(t != "MENGIMPLEMENTASI").groupBy("slug").agg(
        F.bool_or(t == "MENCABUT").alias("revokes"),
        F.bool_or(t == "MENGUBAH").alias("amends"),
        F.bool_or(t.isin("BERLAKU_BERSYARAT", "MASA_PERALIHAN")).alias("conditional"),
        F.array_sort(F.collect_set(t)).alias("tags"),
        F.array_sort(F.collect_set("target")).alias("targets"),
    )


def salvage_json(c: Column, schema: str = "corrected string, confidence double") -> Column:
    """The object between the first { and the last } of a reply; confidence is
    held to 0..1 and 0.5 if absent.  Both are null if there is no object."""
    x = F.from_json(F.nullif(F.regexp_extract(c, r"(\{[\s\S]*\})", 1), F.lit("")), schema)
    sure = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(x["confidence"], F.lit(0.5))))
    return F.struct(x["corrected"].alias("corrected"), F.when(x.isNotNull(), sure).alias("confidence"))
