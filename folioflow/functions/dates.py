"""Dates, delays and intervals in legal prose."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Month names and number words.
MONTHS = [
    "januari", "februari", "maret", "april", "mei", "juni", "juli", "agustus", "september", "oktober", "november", "desember",
]
NUMBER_WORDS = {
    "satu": 1, "dua": 2, "tiga": 3, "empat": 4, "lima": 5, "enam": 6, "tujuh": 7, "delapan": 8, "sembilan": 9, "sepuluh": 10,
    "sebelas": 11, "dua belas": 12, "tiga belas": 13, "empat belas": 14, "lima belas": 15, "tiga puluh": 30, "enam puluh": 60,
    "sembilan puluh": 90, "seratus": 100, "seratus delapan puluh": 180,
}

# Forms of the clause on the entry into force, and the sureness of each class.
ENACTED = r"di(?:undang|tetap)kan"
DAY = r"tanggal\s+(\d{1,2}\s+[A-Za-z]+\s+\d{4})"
CLAUSE = r"(?i)(?:undang[- ]?undang|peraturan|keputusan|instruksi)\s+ini\s+mulai\s+berlaku"
DELAY_TAIL = rf"\s*(hari|bulan)\s+(?:sejak|setelah)\s+(?:tanggal\s+)?{ENACTED}"
DELAYS = [rf"(?i)mulai\s+berlaku\s+(?:setelah\s+)?(\d+)\s*\([^)]+\){DELAY_TAIL}", rf"(?i)mulai\s+berlaku\s+(?:setelah\s+)?(\d+){DELAY_TAIL}", rf"(?i)mulai\s+berlaku\s+(?:setelah\s+)?([\w\s]+?){DELAY_TAIL}"]
AT_ONCE = rf"(?i)berlaku\s+(?:pada|sejak)\s+tanggal\s+{ENACTED}"
ON_DAY = rf"(?i)mulai\s+berlaku\s+(?:pada\s+)?{DAY}"
BACK_TO_DAY = rf"(?i)mulai\s+berlaku\s+(?:surut\s+)?(?:sejak|pada)\s+{DAY}"
AFTER_ACT = rf"(?i)mulai\s+berlaku\s+setelah\s+(.+?)\s+{ENACTED}"
WHEN = r"(?i)mulai\s+berlaku\s+(?:pada\s+)?(?:saat|ketika)\s+(.+)"
SURE = {"immediate": 0.95, "specific_date": 0.90, "delayed": 0.85, "retroactive": 0.85, "conditional": 0.70}


def _month(name: Column) -> Column:
    table = F.create_map(*[F.lit(x) for i, m in enumerate(MONTHS) for x in (m, i + 1)])
    return F.try_element_at(table, F.lower(name))


def iso_date(c: Column, validate: bool = False) -> Column:
    """"15 Januari 2025" -> "2025-01-15".  Without ``validate`` any day number
    passes; with it days are 1 to 31 and years 1945 to 2100."""
    p = r"^\s*(\d{1,2})\s+(\w+)\s+(\d{4})"
    day, month, year = F.regexp_extract(c, p, 1).try_cast("int"), _month(F.regexp_extract(c, p, 2)), F.regexp_extract(c, p, 3).try_cast("int")
    ok = month.isNotNull() & day.isNotNull()
    if validate:
        ok = ok & day.between(1, 31) & year.between(1945, 2100)
    return F.when(ok, F.format_string("%04d-%02d-%02d", year, month, day))


def pad_date(c: Column) -> Column:
    """Day and month padded to two digits, nothing checked."""
    p = r"(\d{1,2})\s+(\w+)\s+(\d{4})"
    month = _month(F.regexp_extract(c, p, 2))
    return F.when(month.isNotNull(), F.concat_ws("-", F.regexp_extract(c, p, 3), F.lpad(month.cast("string"), 2, "0"), F.lpad(F.regexp_extract(c, p, 1), 2, "0")))


def delay_days(number: Column, unit: Column) -> Column:
    """Digits or number words; a month is 30 days by definition."""
    words = F.create_map(*[F.lit(x) for p in NUMBER_WORDS.items() for x in p])
    n = F.coalesce(number.try_cast("int"), F.try_element_at(words, F.lower(F.trim(number))))
    return F.when(F.lower(unit) == "bulan", n * 30).otherwise(n)


def delayed_date(base: Column, days: Column) -> Column:
    return F.date_format(F.date_add(F.try_to_date(base, "yyyy-MM-dd"), days), "yyyy-MM-dd")


def effective_dates(docs: DataFrame, text: str = "text", published: str = "published") -> DataFrame:
    """Adds date_type, effective_date, confidence, delay_days and condition.

    Looked for in the 500 characters from the first clause on entry into force,
    else in the last 3000; the first class that matches decides.  The steps are
    columns of their own, so every pattern runs once a row."""
    c = F.col(text)
    at = F.regexp_instr(c, F.lit(CLAUSE))
    s = F.col("__s")
    steps = docs.withColumn("__at", at).withColumn("__s", F.when(F.col("__at") > 0, F.substr(c, F.col("__at"), F.lit(500))).otherwise(F.substring(c, -3000, 3000)))
    steps = steps.withColumns(
        {
            "__now": s.rlike(AT_ONCE),
            "__day": F.regexp_extract(s, ON_DAY, 1),
            "__back": F.regexp_extract(s, BACK_TO_DAY, 1),
            "__form": F.coalesce(*[F.when(s.rlike(p), F.lit(i)) for i, p in enumerate(DELAYS)]),
            "__if": F.when(s.rlike(AFTER_ACT), F.trim(F.regexp_extract(s, AFTER_ACT, 1))).when(s.rlike(WHEN), F.trim(F.regexp_extract(s, WHEN, 1))),
        }
    )
    part = lambda g: F.coalesce(*[F.when(F.col("__form") == i, F.regexp_extract(s, p, g)) for i, p in enumerate(DELAYS)])
    steps = steps.withColumns({"__n": part(1), "__unit": part(2)})
    steps = steps.withColumn("__days", delay_days(F.col("__n"), F.col("__unit")))
    kind = (
        F.when(F.coalesce(c, F.lit("")) == "", "unknown")
        .when(F.col("__now"), "immediate")
        .when(F.col("__day") != "", "specific_date")
        .when(F.col("__form").isNotNull(), "delayed")
        .when(F.col("__back") != "", "retroactive")
        .when(F.col("__if").isNotNull(), "conditional")
        .otherwise("unknown")
    )
    k = F.col("date_type")
    date = F.when(k == "immediate", F.col(published)).when(k == "specific_date", iso_date(F.col("__day"), True)).when(k == "delayed", delayed_date(F.col(published), F.col("__days"))).when(k == "retroactive", iso_date(F.col("__back"), True))
    sure = F.coalesce(*[F.when(k == name, v) for name, v in SURE.items()], F.lit(0.0))
    steps = steps.withColumn("date_type", kind)
    steps = steps.withColumns({"effective_date": date, "confidence": sure, "delay_days": F.when(k == "delayed", F.col("__days")), "condition": F.when(k == "conditional", F.col("__if"))})
    return steps.drop("__at", "__s", "__now", "__day", "__back", "__form", "__if", "__n", "__unit", "__days")


def is_recent(at: Column, now: Column, minutes: int = 15) -> Column:
    return at >= now - F.expr(f"interval {minutes} minutes")


def backoff_until(now: Column, failures: Column, start: int = 3, first_minutes: int = 5, factor: int = 3, most: int = 120) -> Column:
    """Time of the next try: 5 * 3**(failures - 3) minutes on, 120 at most."""
    minutes = F.least(F.lit(float(most)), first_minutes * F.pow(F.lit(float(factor)), F.greatest(failures - start, F.lit(0))))
    return F.timestamp_add("MINUTE", minutes.cast("int"), now)


def retry_delay(first: Column, tries: Column, factor: float, most: float) -> Column:
    """Seconds before the next try: ``first`` times ``factor`` per try, ``most`` at most."""
    return F.least(F.lit(most), first * F.pow(F.lit(factor), tries))
