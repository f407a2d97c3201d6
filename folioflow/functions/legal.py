"""Kinds, ranks and states of catalog records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nulls import first_match, is_blank

# Record kinds with their short codes, ranks and priorities.
SHORT_TYPES = {
    "UUD": "uud",
    "UUD 1945": "uud",
    "UNDANG-UNDANG DASAR": "uud",
    "TAP MPR": "tapmpr",
    "KETETAPAN MPR": "tapmpr",
    "KETETAPAN MAJELIS PERMUSYAWARATAN RAKYAT": "tapmpr",
    "UNDANG-UNDANG": "uu",
    "UNDANG-UNDANG DARURAT": "uu-darurat",
    "PERATURAN PEMERINTAH PENGGANTI UNDANG-UNDANG": "perppu",
    "PERPPU": "perppu",
    "PERATURAN PEMERINTAH": "pp",
    "PERATURAN PRESIDEN": "perpres",
    "KEPUTUSAN PRESIDEN": "keppres",
    "INSTRUKSI PRESIDEN": "inpres",
    "PENETAPAN PRESIDEN": "penpres",
    "PENPRES": "penpres",
    "PERATURAN MENTERI": "permen",
    "PERATURAN BADAN/LEMBAGA": "perban",
}
HIERARCHY = [("UUD", 1), ("TAP MPR", 2), ("UU", 3), ("PERPPU", 3), ("PP", 4), ("PERPRES", 5), ("PERMEN", 6), ("PERBAN", 6), ("PERDA", 7)]
PRIORITIES = [
    ("UU", 100),
    ("UNDANG-UNDANG", 100),
    ("PERPPU", 90),
    ("PERATURAN PEMERINTAH PENGGANTI UNDANG-UNDANG", 90),
    ("PP", 80),
    ("PERATURAN PEMERINTAH", 80),
    ("PERPRES", 70),
    ("PERATURAN PRESIDEN", 70),
    ("PERMEN", 50),
    ("PERATURAN MENTERI", 50),
    ("PERATURAN BADAN/LEMBAGA", 40),
]


def short_type(kind: Column) -> Column:
    """Exact kind to short code, "other" if unknown."""
    table = F.create_map(*[F.lit(x) for pair in SHORT_TYPES.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.upper(kind)), F.lit("other"))


def priority(kind: Column) -> Column:
    """Priority of the first listed kind that the name contains, else 10."""
    return first_match(F.upper(kind), PRIORITIES, 10)


def hierarchy_level(kind: Column) -> Column:
    """Rank of the first listed code that the name contains, else 99."""
    return first_match(F.translate(F.upper(kind), "-_", "  "), HIERARCHY, 99)


def compare_hierarchy(a: Column, b: Column) -> Column:
    return F.signum(hierarchy_level(a) - hierarchy_level(b)).cast("int")


def status_class(status: Column) -> Column:
    """Revoked states come first: they contain the word for "in force" too."""
    return (
        F.when(status.ilike("%tidak berlaku%") | status.ilike("%dicabut%"), "inactive")
        .when(status.ilike("%berlaku%"), "active")
        .when(is_blank(status), "unknown")
        .otherwise("other")
    )


def era_three(year: Column) -> Column:
    return F.when(year.isNull(), "unknown").when(year < 1990, "old").when(year < 2010, "middle").otherwise("recent")


def era_four(year: Column) -> Column:
    return F.when(year.isNull(), "unknown").when(year < 1970, "before 1970").when(year < 1990, "1970-1989").when(year < 2010, "1990-2009").otherwise("2010 on")


def slug(kind: Column, number: Column, year: Column) -> Column:
    return F.concat(F.replace(F.lower(kind), F.lit(" "), F.lit("-")), F.lit("-no-"), number, F.lit("-tahun-"), year)
