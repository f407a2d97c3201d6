"""Quality rules with robust multivariate outliers.

Base rules come first.  Every text that passes them is a vector of transformed
statistics; for each language and source the minimum covariance determinant
(MCD) gives a location and a scatter that junk cannot pull, and a text whose
squared Mahalanobis distance exceeds the cutoff is rejected.

A group of any size is estimated without meeting in one task: its rows are
split by hash into blocks of about ``BLOCK`` rows, each block runs FAST-MCD with
a reweighting step, and the group's estimate is the mean of its blocks'.  All
rows take part; ``tests/llm`` hold the mean of the blocks against one estimate of
the whole group.  A scatter of seven statistics needs some rows: groups below
``MIN_GROUP`` are estimated together by language, and what is left of languages
that are smaller still in one group, whatever its size.  Every text is judged.

Nulls: a null text is empty (and fails the base rules); null lang and source are
groups of their own; null ids are kept.  Repeated rows, and rows that tie, are
judged alike.  A very long text is measured whole.  An empty table gives an empty
result.  Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import bounded_batches, materialize, settled
from .words import Words, document_windows, mix, span_hashes, text_batches, windows

BLOCK = 2000
MIN_GROUP = 40
BROADCAST_GROUPS = 100_000
MIN_WORDS = 50

#: Scales below which the spread of a statistic counts as noise: a group whose
#: texts never show a thing must not reject the first text that shows it once.
FLOORS = (0.05, 0.08, 0.15, 0.15, 0.15, 0.25, 0.12)
FEATURES = [f"x{i}" for i in range(len(FLOORS))]

_SYMBOLS = np.zeros(256, np.int8)
_SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = 1
_UPPER = np.zeros(256, np.int8)
_UPPER[65:91] = 1
_LETTERS = _UPPER.copy()
_LETTERS[97:123] = 1
_MARKS = np.zeros(256, np.int8)
_MARKS[[ord(c) for c in "!?;:^~=+_\\/@"]] = 1
_NOT_SPACE = np.ones(256, np.int8)
_NOT_SPACE[[0x20, 9, 10, 11, 12, 13]] = 0
_CHARS = _NOT_SPACE.copy()
_CHARS[0x80:0xC0] = 0
_LINES = np.zeros(256, np.int8)
_LINES[10] = 1


def _within(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once, first occurrences included."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    same = np.zeros(len(s), bool)
    if len(s) > 1:
        equal = s[1:] == s[:-1]
        same[1:] |= equal
        same[:-1] |= equal
    out = np.empty(len(s), bool)
    out[order] = same
    return out


def statistics(texts: pa.Array) -> dict[str, np.ndarray]:
    """The base statistics of a batch of texts, whole texts each."""
    w = Words(texts)
    n = len(w.counts)
    doc = np.repeat(np.arange(n), w.counts)
    repeated = np.zeros(len(doc) + 1, np.int64)
    inside = document_windows(w.counts, 3)
    if len(inside):
        at = np.flatnonzero(inside)
        keys = mix(windows(w.hashes(), 3)[at] + mix(doc[at].astype(np.uint64) + np.uint64(1)))
        hit = at[_within(keys)]
        cover = np.zeros(len(doc) + 4, np.int64)
        np.add.at(cover, hit, 1)
        np.add.at(cover, hit + 3, -1)
        repeated[1:] = np.cumsum(np.cumsum(cover)[: len(doc)] > 0)
    # lines: cut at \n and at the ends of documents
    newline = np.flatnonzero(w.data == 10)
    starts = np.sort(np.concatenate([w.bounds[:-1], newline + 1]), kind="stable")
    ends = np.sort(np.concatenate([w.bounds[1:], newline]), kind="stable")
    starts, ends = starts[: len(ends)], ends
    with_word = np.searchsorted(w.starts, ends) > np.searchsorted(w.starts, starts)
    starts, ends = starts[with_word], ends[with_word]
    line_doc = np.searchsorted(w.bounds, starts, "right") - 1
    keys = mix(span_hashes(w.data, starts, ends) + mix(line_doc.astype(np.uint64) + np.uint64(1)))
    first = np.zeros(len(keys), bool)
    first[np.unique(keys, return_index=True)[1]] = True
    lines = np.bincount(line_doc, minlength=n)[:n]
    return {
        "n_words": w.counts.astype(np.int64),
        "word_chars": w.sums(_CHARS),
        "n_symbols": w.sums(_SYMBOLS),
        "n_dup_lines": np.bincount(line_doc[~first], minlength=n)[:n].astype(np.int64),
        "n_repeat_words": repeated[w.first[1:]] - repeated[w.first[:-1]],
        "n_lines": lines.astype(np.int64),
        "n_upper": w.sums(_UPPER),
        "n_letters": w.sums(_LETTERS),
        "n_marks": w.sums(_MARKS),
    }


def features(s: dict[str, np.ndarray]) -> np.ndarray:
    """Transformed statistics, a row for each text: roots and logarithms of
    shares, so that none depends on the length of the text."""
    n = np.maximum(s["n_words"], 1).astype(float)
    lines = np.maximum(s["n_lines"], 1)
    return np.stack(
        [
            np.log(np.maximum(s["word_chars"], 1) / n),
            np.sqrt(s["n_symbols"] / n),
            np.sqrt(s["n_dup_lines"] / lines),
            np.sqrt(s["n_repeat_words"] / n),
            np.sqrt(s["n_marks"] / n),
            np.log(n / lines + 1),
            np.sqrt((s["n_upper"] + 1) / (s["n_letters"] + 10)),
        ],
        axis=1,
    )


_STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_SCHEMA = "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in _STATS) + ", " + ", ".join(f"{c} double" for c in FEATURES)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in text_batches(whole):
            s = statistics(batch.column("text"))
            x = features(s)
            columns = [batch.column(c) for c in ("doc_id", "lang", "source")] + [pa.array(s[c]) for c in _STATS] + [pa.array(x[:, i]) for i in range(x.shape[1])]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang", "source", *_STATS, *FEATURES])


def chi2_quantile(q: float, p: int) -> float:
    """Chi-squared quantile by the Wilson-Hilferty approximation."""
    from statistics import NormalDist

    a = 2 / (9 * p)
    return p * (1 - a + NormalDist().inv_cdf(q) * a**0.5) ** 3


def _distances(x: np.ndarray, m: np.ndarray, s: np.ndarray) -> np.ndarray:
    d = x - m
    return np.einsum("ij,jk,ik->i", d, np.linalg.inv(s), d)


def mcd(x: np.ndarray, share: float = 0.6, starts: int = 30, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Location and scatter of the reweighted minimum covariance determinant.

    FAST-MCD: concentration steps from random small subsets, the best few run
    to the end.  ``FLOORS`` squared is added to the diagonal throughout."""
    n, p = x.shape
    ridge = np.diag(np.square(FLOORS[:p]))
    h = max(p + 1, int(share * n))
    rng = np.random.default_rng(seed)

    def fit(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return rows.mean(axis=0), (np.cov(rows, rowvar=False, bias=True) if len(rows) > 1 else np.zeros((p, p))) + ridge

    def step(m: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return fit(x[np.argpartition(_distances(x, m, s), h - 1)[:h]]) if h < n else fit(x)

    tried = []
    middle = np.median(x, axis=0)
    for k in range(starts):
        m, s = fit(x[rng.choice(n, min(n, p + 1), replace=False)]) if k else (middle, ridge + np.diag(np.square(1.4826 * np.median(np.abs(x - middle), axis=0))))
        for _ in range(2):
            m, s = step(m, s)
        tried.append((np.linalg.slogdet(s)[1], k, m, s))
    best = None
    for _, k, m, s in sorted(tried, key=lambda t: t[:2])[:3]:
        last = np.inf
        for _ in range(50):
            m, s = step(m, s)
            now = np.linalg.slogdet(s)[1]
            if now >= last - 1e-9:
                break
            last = now
        if best is None or now < best[0]:
            best = (now, m, s)
    _, m, s = best
    scale = np.median(_distances(x, m, s)) / chi2_quantile(0.5, p)
    near = _distances(x, m, s * max(scale, 1e-9)) <= chi2_quantile(0.975, p)
    return fit(x[near]) if near.sum() > p + 1 else (m, s)


_PAIRS = [(i, j) for i in range(len(FLOORS)) for j in range(i, len(FLOORS))]


def _fit_block(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values([*FEATURES])  # the same rows give the same estimate, whatever their order
    m, s = mcd(rows[FEATURES].to_numpy())
    return pd.DataFrame([[*key, len(rows), *m, *[s[i, j] for i, j in _PAIRS]]])


def _invert(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    p = len(FLOORS)
    for frame in frames:
        out = []
        for row in frame.itertuples(index=False):
            s = np.zeros((p, p))
            for (i, j), v in zip(_PAIRS, row[1 + p :], strict=True):
                s[i, j] = s[j, i] = v
            out.append([row[0], list(row[1 : 1 + p]), np.linalg.inv(s).ravel().tolist()])
        yield pd.DataFrame(out, columns=["g", "center", "precision"])


def _groups(good: DataFrame) -> DataFrame:
    """gl, gs, the group g that estimates them, and its number of blocks."""
    own = materialize(good.groupBy("gl", "gs").agg(F.count(F.lit(1)).alias("own")), "groups")
    by_lang = own.groupBy("gl").agg(F.sum(F.when(F.col("own") < MIN_GROUP, F.col("own")).otherwise(0)).alias("by_lang"))
    name = F.when(F.col("own") >= MIN_GROUP, F.concat_ws("\u0001", "gl", "gs")).when(F.col("by_lang") >= MIN_GROUP, F.col("gl")).otherwise(F.lit("*"))
    named = materialize(own.join(by_lang, "gl").select("gl", "gs", "own", name.alias("g")), "named")
    totals = named.groupBy("g").agg(F.greatest(F.lit(1), F.round(F.sum("own") / F.lit(BLOCK)).cast("long")).alias("blocks"))
    return materialize(named.join(totals, "g").select("gl", "gs", "g", "blocks"), "plan")


def quality_rules(docs: DataFrame, quantile: float = 1 - 1e-7) -> DataFrame:
    """doc_id, the base statistics, base_failed, distance (squared; null if the
    base rules reject the text) and kept."""
    bounded_batches(docs.sparkSession)
    return settled(lambda: _judged(docs, quantile), "judged")


def _judged(docs: DataFrame, quantile: float) -> DataFrame:
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    stats = docs.select("doc_id", "text", "lang", "source").mapInArrow(_measure, _SCHEMA)
    stats = stats.withColumns(
        {
            "base_failed": failed,
            "gl": F.coalesce(F.concat(F.lit("="), "lang"), F.lit("null")),
            "gs": F.coalesce(F.concat(F.lit("="), "source"), F.lit("null")),
            # rows without an id are dealt by place, so that copies of one row do not share a block
            "deal": F.xxhash64(F.coalesce("doc_id", F.monotonically_increasing_id()), F.col("doc_id").isNull()),
        }
    )
    stats = materialize(stats.drop("lang", "source"), "rules")
    good = stats.where("not base_failed")
    plan = _groups(good)
    plan = F.broadcast(plan) if plan.count() <= BROADCAST_GROUPS else plan
    assigned = good.join(plan, ["gl", "gs"]).withColumn("block", F.pmod("deal", F.col("blocks")))
    fields = "g string, block long, n long, " + ", ".join([f"m{i} double" for i in range(len(FLOORS))] + [f"s{i}_{j} double" for i, j in _PAIRS])
    fits = materialize(assigned.select("g", "block", *FEATURES).groupBy("g", "block").applyInPandas(_fit_block, fields), "mcd")
    weight = F.col("n").cast("double")
    averaged = fits.groupBy("g").agg(*[(F.sum(F.col(c) * weight) / F.sum(weight)).alias(c) for c in fits.columns[3:]])
    # a row per block of each group, so that no task joins a whole group
    per_block = materialize(fits.select("g", "block").join(averaged.mapInPandas(_invert, "g string, center array<double>, precision array<double>"), "g"), "params")
    per_block = F.broadcast(per_block) if per_block.count() <= BROADCAST_GROUPS // 10 else per_block
    p = len(FLOORS)
    d = [F.col(f"x{i}") - F.get("center", F.lit(i)) for i in range(p)]
    distance = sum((d[i] * d[j] * F.get("precision", F.lit(i * p + j)) for i in range(p) for j in range(p)), F.lit(0.0))
    columns = ["doc_id", *_STATS, "base_failed"]
    judged = assigned.join(per_block, ["g", "block"]).select(*columns, distance.alias("distance"))
    out = judged.unionByName(stats.where("base_failed").select(*columns, F.lit(None).cast("double").alias("distance")))
    return out.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= chi2_quantile(quantile, p), F.lit(True)))
