"""Chapter, article, paragraph and point trees of legal texts."""

from __future__ import annotations

import re
from xml.sax.saxutils import escape, quoteattr

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vectorized import vectorized

POINT = "struct<letter:string,text:string,subpoints:array<struct<number:int,text:string>>>"
PARAGRAPH = f"struct<number:int,text:string,points:array<{POINT}>>"
ARTICLE = f"struct<number:int,text:string,paragraphs:array<{PARAGRAPH}>>"
TREE = f"struct<chapters:array<struct<number:string,title:string,articles:array<{ARTICLE}>>>,articles:array<{ARTICLE}>,error:string>"

_CHAPTER = re.compile(r"BAB[ \t]+([IVXLCDM]+)\.?\s*\n\s*([^\n]+)", re.I)
_ARTICLE = re.compile(r"^\s*Pasal\s+(\d+)\s*\.?\s*$", re.I | re.M)
_STOP = re.compile(r"BAB\s+[IVXLCDM]+|Ditetapkan\s+di|PENJELASAN", re.I)
_PARAGRAPH = re.compile(r"\((\d+)\)\s*")
_POINT = re.compile(r"([a-z])\.?\s+(.+)")
_SUBPOINT = re.compile(r"(\d+)\.?\s+(.+)")


def _upto(marks: list[re.Match], text: str) -> list[tuple[re.Match, int]]:
    """Each mark with the place where the next one (or the text's end) is."""
    return list(zip(marks, [*[m.start() for m in marks[1:]], len(text)][: len(marks)], strict=True))


def _items(lines: list[str], pattern: re.Pattern) -> list[list[str]]:
    """Marked lines, each with the lines that continue it."""
    out: list[list[str]] = []
    for line in map(str.strip, lines):
        m = pattern.fullmatch(line)
        if m:
            out.append([m[1], m[2].strip()])
        elif out and line:
            out[-1].append(line)
    return out


def _points(text: str) -> list[dict]:
    points = []
    for letter, *lines in _items(text.split("\n"), _POINT):
        subpoints = [{"number": int(n), "text": " ".join(rest)} for n, *rest in _items(lines, _SUBPOINT)]
        points.append({"letter": letter, "text": " ".join(lines), "subpoints": subpoints})
    return points


def _article(number: str, text: str) -> dict:
    marks = list(_PARAGRAPH.finditer(text))
    paragraphs = []
    for m, after in _upto(marks, text):
        body = text[m.end() : after].strip()
        paragraphs.append({"number": int(m[1]), "text": body, "points": _points(body)})
    if not marks and (points := _points(text)):
        paragraphs.append({"number": 0, "text": text, "points": points})  # points without a numbered paragraph
    return {"number": int(number), "text": text, "paragraphs": paragraphs}


def _articles(text: str) -> list[dict]:
    marks = list(_ARTICLE.finditer(text))
    out = []
    for m, after in _upto(marks, text):
        body = text[m.end() : after]
        stop = _STOP.search(body)
        out.append(_article(m[1], (body[: stop.start()] if stop else body).strip()))
    return out


def parse(text: str | None) -> dict:
    """The tree of one text.  Articles before the first chapter are kept beside
    the chapters; in-text mentions of an article do not end one."""
    if not text or len(text.strip()) < 50:
        return {"chapters": [], "articles": [], "error": "too short"}
    marks = list(_CHAPTER.finditer(text))
    chapters = [{"number": m[1].upper(), "title": m[2].strip(), "articles": _articles(text[m.end() : after])} for m, after in _upto(marks, text)]
    return {"chapters": chapters, "articles": _articles(text[: marks[0].start()] if marks else text), "error": None}


@vectorized(TREE)
def parse_tree(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([parse(t) for t in texts], columns=["chapters", "articles", "error"])


def articles(docs: DataFrame, key: str) -> DataFrame:
    """One row per article: key, chapter (null outside), number, text, paragraphs."""
    t = docs.select(key, parse_tree("text").alias("t"))
    inside = t.select(key, F.explode("t.chapters").alias("c")).select(key, F.col("c.number").alias("chapter"), F.explode("c.articles").alias("a"))
    loose = t.select(key, F.lit(None).cast("string").alias("chapter"), F.explode("t.articles").alias("a"))
    return loose.unionByName(inside).select(key, "chapter", "a.*")


def article_form(paragraphs: Column) -> Column:
    """How an article is laid out: "points" (without numbered paragraphs),
    "paragraphs" or "plain"."""
    return F.when(F.size(paragraphs) == 0, "plain").when(F.get(paragraphs, F.lit(0))["number"] == 0, "points").otherwise("paragraphs")


def _totals(tree: dict) -> tuple[int, int, int]:
    found = [*tree["articles"], *(a for c in tree["chapters"] for a in c["articles"])]
    paragraphs = [p for a in found for p in a["paragraphs"]]
    return len(found), len(paragraphs), sum(len(p["points"]) for p in paragraphs)


@vectorized("struct<n_articles:long,n_paragraphs:long,n_points:long>")
def tree_totals(texts: pd.Series) -> pd.DataFrame:
    """Sizes of the tree, counted where it is parsed: only three numbers leave."""
    return pd.DataFrame([_totals(parse(t)) for t in texts], columns=["n_articles", "n_paragraphs", "n_points"])


def totals(docs: DataFrame, key: str) -> DataFrame:
    """Articles, paragraphs and points of each document, in one pass without an exchange."""
    return docs.select(key, tree_totals("text").alias("t")).select(key, "t.*")


def _xml(slug: str, tree: dict) -> str:
    def points(ps: list[dict], eid: str) -> str:
        return "".join(f'<point eId="{eid}__point_{p["letter"]}"><num>{p["letter"]}.</num><p>{escape(p["text"])}</p></point>' for p in ps)

    def article(a: dict) -> str:
        eid = f"art_{a['number']}"
        inner = "".join(f'<paragraph eId="{eid}__para_{p["number"]}"><num>({p["number"]})</num><p>{escape(p["text"])}</p>{points(p["points"], f"{eid}__para_{p["number"]}")}</paragraph>' for p in a["paragraphs"])
        return f'<article eId="{eid}"><num>Pasal {a["number"]}</num>{inner or f"<p>{escape(a["text"])}</p>"}</article>'

    body = "".join(map(article, tree["articles"])) + "".join(f'<chapter eId="chp_{c["number"]}"><num>BAB {c["number"]}</num><heading>{escape(c["title"])}</heading>{"".join(map(article, c["articles"]))}</chapter>' for c in tree["chapters"])
    return f"<akomaNtoso><act name={quoteattr(slug)}><body>{body}</body></act></akomaNtoso>"


@vectorized("string")
def to_xml(slugs: pd.Series, texts: pd.Series) -> pd.Series:
    """The tree as XML with hierarchical element ids."""
    return pd.Series([_xml(s or "", parse(t)) for s, t in zip(slugs, texts, strict=True)])
