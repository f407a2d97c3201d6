"""Quality classifier over supervised subword embeddings.

Words and character n-grams are hashed to a table of learned vectors, as is a
marker wherever a word repeats one of the two before it; a text is the average
of the vectors of all its features (and of ``REST`` zero vectors, so that a text
of a few characters stays near the prior), and a softmax over that average gives
the class.  Vectors and output weights are trained together by stochastic
gradient descent in numpy, on the driver, over a bounded sample of labelled
rows (``max_rows`` and ``max_bytes``).  A sampled text has about two distinct
features a byte; they are kept compressed until its step, one text at a time.

Scoring uses the model's own linearity: with two classes the average only enters
through its product with the difference of the two output vectors, so each
bucket is one number and a text's score needs one table lookup per feature.
The table has a fixed size whatever the corpus.

A null or empty text has no features and gets the model's prior.  Null ids count
as the empty string in the fold rule.  Without training rows every score is 0.5.
A very long text is scored whole.  Repeated rows are scored alike and trained on
once; a label that comes twice counts by its first row.  An empty table gives an
empty result; a score of exactly 0.5 is class 1.  Other columns play no part.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .sketch import pack, unpack
from .store import bounded_batches, give_back
from .words import Words, mix, text_batches

BITS = 18
NGRAMS = (2, 3, 4)
CHUNK = 1 << 19
LAGS = (1, 2)
REST = 32


def _bucket(h: np.ndarray) -> np.ndarray:
    return (mix(h) >> np.uint64(64 - BITS)).astype(np.int64)


def _ngram_buckets(points: np.ndarray, n: int) -> np.ndarray:
    """The bucket of the n-gram that starts at each code point."""
    h = np.zeros(len(points) - n + 1, np.uint64)
    for k in range(n):
        h = h * np.uint64(0x9E3779B97F4A7C15) + points[k : k + len(h)]
    return _bucket(h + np.uint64(n))


def _repeats(words: Words, hashes: np.ndarray, lag: int) -> np.ndarray:
    """Which words equal the word ``lag`` before them in the same text."""
    same = np.zeros(len(hashes), bool)
    same[lag:] = hashes[lag:] == hashes[:-lag]
    for k in range(lag):
        at = words.first[:-1] + k
        same[at[at < len(same)]] = False
    return same


_MARKS = {lag: int(_bucket(np.array([lag], np.uint64) * np.uint64(0xA0761D6478BD642F))[0]) for lag in LAGS}


def _points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each between two spaces, and their bounds."""
    bounds = np.cumsum([0, *[len(t) + 2 for t in texts]])
    data = "".join(f" {t} " for t in texts).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(data, np.uint32), bounds


@dataclass
class Model:
    """``weights``: what each bucket adds; ``bias``: the prior's log odds."""

    weights: np.ndarray
    bias: float

    def score(self, texts: pa.Array) -> np.ndarray:
        """Probability of class 1 for each text of a batch, whole texts."""
        texts = texts.fill_null("") if texts.null_count else texts
        words = Words(texts)
        n = len(texts)
        sums, counts = np.zeros(n), words.counts.astype(np.int64)
        hashes = words.hashes()
        gain = self.weights[_bucket(hashes)].astype(np.float64)
        extra = np.zeros(len(hashes), np.int64)
        for lag, bucket in _MARKS.items():
            same = _repeats(words, hashes, lag)
            gain += same * float(self.weights[bucket])
            extra += same
        total = np.concatenate([[0.0], np.cumsum(gain)])
        sums += total[words.first[1:]] - total[words.first[:-1]]
        total = np.concatenate([[0], np.cumsum(extra)])
        counts += total[words.first[1:]] - total[words.first[:-1]]
        points, bounds = _points(texts.to_pylist())
        for size in NGRAMS:
            ends = bounds[1:] - size + 1
            counts += np.maximum(ends - bounds[:-1], 0)
            for at in range(0, max(len(points) - size + 1, 0), CHUNK):
                part = points[at : at + CHUNK + size - 1].astype(np.uint64)
                total = np.concatenate([[0.0], np.cumsum(self.weights[_ngram_buckets(part, size)], dtype=np.float64)])
                last = len(total) - 1
                i, j = np.searchsorted(bounds, at, "right") - 1, np.searchsorted(bounds, at + last, "left")
                a, b = np.clip(bounds[i:j] - at, 0, last), np.clip(ends[i:j] - at, 0, last)
                sums[i:j] += total[np.maximum(a, b)] - total[a]
        empty = words.counts == 0
        z = np.where(empty, 0.0, sums / (counts + REST)) + self.bias
        return np.round(1 / (1 + np.exp(-z)), 9)


def _counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text, rising, and how often each comes."""
    words = Words(pa.array([text]))
    if not len(words.starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    points, _ = _points([text])
    wide = points.astype(np.uint64)
    hashes = words.hashes()
    buckets = [_bucket(hashes)]
    buckets += [np.full(int(_repeats(words, hashes, lag).sum()), bucket) for lag, bucket in _MARKS.items()]
    buckets += [_ngram_buckets(wide, size) for size in NGRAMS if len(wide) >= size]
    return np.unique(np.concatenate(buckets), return_counts=True)


def _shares(found: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return found.astype(np.int32), (counts / (counts.sum() + REST)).astype(np.float32)


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their shares of all its features."""
    return _shares(*_counted(text))


def packed(text: str) -> tuple[int, bytes]:
    """Number and compressed gaps and counts of a text's distinct buckets."""
    found, counts = _counted(text)
    return len(found), pack(np.concatenate([np.diff(found, prepend=0), counts]).astype(np.uint32))


def unpacked(n: int, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """What ``features`` gives."""
    gaps, counts = unpack(data, np.uint32, 2 * n).astype(np.int64).reshape(2, n)
    return _shares(np.cumsum(gaps), counts)


def fit(texts: list[str], labels: list[int], dim: int = 8, epochs: int = 5, rate: float = 0.25, seed: int = 11) -> Model:
    """Train vectors and softmax by stochastic gradient descent.

    A text's step is divided by the squared norm of its feature shares, so a
    long text moves its average as far as a short one."""
    if not texts:
        return Model(np.zeros(1 << BITS, np.float32), 0.0)
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (1 << BITS, dim)).astype(np.float32)
    out, bias = np.zeros((dim, 2), np.float32), np.zeros(2, np.float32)
    rows = [(packed(t), y) for t, y in zip(texts, labels, strict=True)]
    steps, done = epochs * len(rows), 0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            found, share = unpacked(*rows[i][0])
            y = rows[i][1]
            lr = rate * (1 - done / steps)
            done += 1
            hidden = share @ vectors[found] if len(found) else np.zeros(dim, np.float32)
            z = hidden @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            if len(found):
                back = out @ p
                vectors[found] -= np.outer(share * (lr / float(share @ share)), back)
                out -= lr * np.outer(hidden, p)
            bias -= 0.1 * lr * p
    way = out[:, 1] - out[:, 0]
    return Model((vectors @ way).astype(np.float32), float(bias[1] - bias[0]))


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 4000, max_bytes: int = 32 << 20) -> Model:
    """Fit on labelled rows outside the held-out fold, in hash order, until
    ``max_rows`` rows or ``max_bytes`` bytes of text are reached."""
    marked = labels.where(F.col("quality").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", "quality")
    sizes = docs.where("text is not null").select("doc_id", F.octet_length("text").alias("bytes"))
    picked = sizes.join(marked, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "quality", "bytes").limit(max_rows).toPandas()
    picked = picked[picked["bytes"].cumsum() <= max_bytes].drop_duplicates("doc_id")
    spark = docs.sparkSession
    ids = spark.createDataFrame(picked[["doc_id", "quality"]], "doc_id long, quality int")
    rows = docs.where("text is not null").select("doc_id", "text").join(F.broadcast(ids), "doc_id").dropDuplicates(["doc_id"]).toArrow().sort_by("doc_id")
    model = fit(rows.column("text").to_pylist(), rows.column("quality").to_pylist())
    del rows
    give_back()
    return model


def scorer(model: Model):
    """A vectorised column function: text -> probability of class 1."""
    bounded_batches(SparkSession.active())

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        if not len(text):
            return pa.array([], pa.float64())
        parts = [model.score(b.column(0)) for b in text_batches(pa.RecordBatch.from_arrays([text], ["text"]))]
        return pa.array(np.concatenate(parts))

    return score


def classified(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    score = scorer(train(docs, labels, **options))
    out = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score("text").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that the classifier does not reject; all columns as they are."""
    score = scorer(train(docs, labels, **options))
    return docs.withColumn("__ff_score", score("text")).where("__ff_score >= 0.5").select(*docs.columns)
