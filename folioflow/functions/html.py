"""Records and links from catalog pages."""

from __future__ import annotations

import html as entities
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .dates import iso_date
from .vectorized import vectorized

# Labels of the detail table with the field each fills, most specific first.
FIELD_LABELS = [
    ("nomor_pengundangan", ["nomor pengundangan"]),
    ("nomor_tambahan", ["nomor tambahan"]),
    ("tahun_pengundangan", ["tahun pengundangan"]),
    ("tanggal_pengundangan", ["tanggal pengundangan"]),
    ("tanggal_penetapan", ["ditetapkan tanggal", "tanggal penetapan"]),
    ("tempat_penetapan", ["tempat penetapan"]),
    ("pejabat_pengundangan", ["pejabat pengundangan", "pejabat yang mengundangkan"]),
    ("pejabat_penetapan", ["pejabat yang menetapkan", "pejabat penetapan"]),
    ("jenis", ["jenis/bentuk peraturan", "jenis / bentuk", "jenis/bentuk", "jenis"]),
    ("nomor", ["nomor"]),
    ("tahun", ["tahun"]),
    ("tentang", ["tentang", "perihal"]),
    ("pemrakarsa", ["pemrakarsa"]),
    ("status", ["status"]),
]
_HREF = r"(?i)<a\b[^>]*\bhref\s*=\s*[\"']([^\"']*)[\"']"
_META = r"(?i)<meta\b[^>]*name\s*=\s*[\"']article:tag[\"'][^>]*content\s*=\s*[\"']([^\"']*)[\"']"


def hrefs(page: Column) -> Column:
    return F.regexp_extract_all(page, F.lit(_HREF), F.lit(1))


def slug_of(url: Column) -> Column:
    return F.rtrim(F.when(url.contains("/id/"), F.get(F.split(url, "/id/"), F.lit(1))).otherwise(url), F.lit("/"))


def link_reason(href: Column) -> Column:
    """Why a link is no record link: "empty", "javascript", "hash",
    "invalid_slug", "other"; null for a record link."""
    h = F.trim(href)
    s = slug_of(h)
    return (
        F.when(F.coalesce(h, F.lit("")) == "", "empty")
        .when(F.lower(h).startswith("javascript:"), "javascript")
        .when(h.endswith("#") | h.contains("/id/#"), "hash")
        .when(~h.contains("/id/"), "other")
        .when(h.endswith("/id/") | F.rtrim(h, F.lit("/")).endswith("/id"), "empty")
        .when((F.trim(s) == "") | s.rlike(r"[\t\n\r]"), "invalid_slug")
    )


def record_links(page: Column) -> Column:
    """Record links in page order, each once, relative to the site."""
    kept = F.filter(hrefs(page), lambda h: link_reason(h).isNull())
    return F.array_distinct(F.transform(kept, lambda h: F.regexp_replace(F.trim(h), r"^https?://[^/]*", "")))


def _absolute(link: Column, base: str) -> Column:
    return F.when(link.startswith("http"), link).when(link.startswith("/"), F.concat(F.lit(base), link)).otherwise(F.concat(F.lit(base + "/"), link))


def _files(links: Column) -> Column:
    tidy = F.transform(links, lambda x: F.replace(F.trim(x), F.lit(" "), F.lit("")))
    return F.filter(tidy, lambda x: x.contains("/files/") & x.endswith(".pdf"))


def pdf_url(page: Column, base: str = "") -> Column:
    """File link: a direct link, else a link around a pdf icon, else meta tags."""
    icon = F.regexp_extract(page, r"(?is)<a\b[^>]*href\s*=\s*[\"']([^\"']*)[\"'][^>]*>\s*<img\b[^>]*src\s*=\s*[\"'][^\"']*pdf", 1)
    words = F.split(F.regexp_extract(page, r"(?i)<meta\b[^>]*name\s*=\s*[\"']keywords[\"'][^>]*content\s*=\s*[\"']([^\"']*)[\"']", 1), ",")
    return F.coalesce(
        _absolute(F.get(_files(hrefs(page)), F.lit(0)), base),
        F.when(icon != "", _absolute(F.replace(F.trim(icon), F.lit(" "), F.lit("")), base)),
        _absolute(F.get(_files(F.regexp_extract_all(page, F.lit(_META), F.lit(1))), F.lit(0)), base),
        F.get(F.filter(_files(words), lambda x: x.startswith("http")), F.lit(0)),
    )


def all_pdf_urls(page: Column, base: str = "") -> Column:
    """Meta links, then direct links, each once."""
    both = F.concat(_files(F.regexp_extract_all(page, F.lit(_META), F.lit(1))), _files(hrefs(page)))
    return F.array_distinct(F.transform(both, lambda x: _absolute(x, base)))


def total_count(page: Column) -> Column:
    n = F.regexp_extract(F.regexp_replace(page, "<[^>]*>", ""), r"(?i)dari\s+([\d.,]+)\s+peraturan", 1)
    return F.coalesce(F.translate(n, ".,", "").try_cast("long"), F.lit(0).cast("long"))


def last_page(page: Column) -> Column:
    block = F.regexp_extract(page, r"(?is)<(?:ul|nav)[^>]*class\s*=\s*[\"'][^\"']*pagination[^\"']*[\"'][^>]*>(.*?)</(?:ul|nav)>", 1)
    numbers = F.transform(F.regexp_extract_all(block, F.lit(r"(?is)<a\b[^>]*>\s*(\d+)\s*</a>"), F.lit(1)), lambda x: x.try_cast("int"))
    return F.greatest(F.coalesce(F.array_max(numbers), F.lit(1)), F.lit(1))


def valid_year(y: Column, now: int) -> Column:
    return F.when(y.between(1945, now + 1), y)


def year_fallback(direct: Column, title: Column, slug: Column, date: Column, now: int) -> Column:
    """The first valid year: field, "Tahun n" in the title, slug, date."""
    pick = lambda c, p: valid_year(F.regexp_extract(c, p, 1).try_cast("int"), now)
    return F.coalesce(valid_year(direct.try_cast("int"), now), pick(title, r"[Tt]ahun\s+(\d{4})"), pick(F.lower(slug), r"tahun[- ](\d{4})"), pick(slug, r"-(\d{4})$"), pick(date, r"(\d{4})"))


def _cells(page: str) -> list[tuple[str, str]]:
    found = []
    for row in re.findall(r"(?is)<tr\b[^>]*>(.*?)(?=</tr>|<tr\b|\Z)", page):
        th, td = re.search(r"(?is)<th\b[^>]*>(.*?)</th>", row), re.search(r"(?is)<td\b[^>]*>(.*?)</td>", row)
        if th and td:
            found.append(tuple(entities.unescape(re.sub(r"<[^>]*>", "", x[1])).strip() for x in (th, td)))
    return found


@vectorized("map<string,string>")
def table_fields(pages: pd.Series) -> pd.Series:
    """Fields of the detail table: labels of several words match by containment,
    single words only exactly; the first unfilled field in order wins."""

    def fields(page: str | None) -> dict[str, str]:
        out: dict[str, str] = {}
        for label, value in _cells(page or ""):
            label = label.lower()
            for name, patterns in FIELD_LABELS:
                if name not in out and any(label == p or label.replace("/", " / ") == p or (" " in p and p in label) for p in patterns):
                    out[name] = value
                    break
        return out

    return pages.map(fields)


def record(page: Column, slug: Column, now: int, base: str = "") -> Column:
    """A catalog record from a detail page, with an error where it has none."""
    f = table_fields(page)
    get = lambda k: F.try_element_at(f, F.lit(k))
    year = year_fallback(get("tahun"), get("tentang"), slug, get("tanggal_penetapan"), now)
    missing = F.array_compact(F.array(*[F.when(F.coalesce(get(k), F.lit("")) == "", k) for k in ("jenis", "nomor", "tentang")]))
    error = F.when(F.size(missing) > 0, F.concat(F.lit("missing "), F.array_join(missing, ","))).when(year.isNull(), "no valid year")
    return F.struct(get("jenis").alias("jenis"), get("nomor").alias("nomor"), year.alias("tahun"), get("tentang").alias("tentang"), F.coalesce(get("status"), F.lit("Berlaku")).alias("status"), iso_date(get("tanggal_penetapan")).alias("tanggal_penetapan"), iso_date(get("tanggal_pengundangan")).alias("tanggal_pengundangan"), pdf_url(page, base).alias("pdf_url"), error.alias("error"))
