"""Exact token counts as a histogram of encoded lengths.

Every whole text is encoded once and only its length is kept; documents are then
aggregated by length.  Suffix sums over the histogram answer, for every possible
context limit at once: how many documents exceed it, how many tokens survive
truncation to it, and which quantile it is.  The histogram has at most as many
rows as there are different lengths, whatever the number of documents.

The vocabulary file is a parameter; the driver reads it and ships its ranks (one
fixed-size table) with the task, so executors need no local copy.

A null or empty text has 0 tokens; a very long one is encoded whole.  Ids and other
columns play no part, repeated rows count again, texts of one length share a row,
and an empty table gives an empty histogram.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import bounded_batches, ship
from .words import text_batches

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the public pre-tokenisation pattern of the 50k byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_encoders: dict[int, object] = {}


def encoder(data: bytes, pattern: str):
    """A tokenizer over the bytes of a rank file, one per worker process."""
    key = hash((data, pattern))
    if key not in _encoders:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}
        _encoders[key] = tiktoken.Encoding("folioflow", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _encoders[key]


def token_lengths(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """One row per document: n_tokens."""
    with open(vocabulary, "rb") as f:
        shipped = ship(docs.sparkSession, f.read())
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(shipped.value, pattern).encode_ordinary
        for whole in batches:
            for batch in text_batches(whole):
                counts = [len(encode(t)) if t else 0 for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(counts, pa.int64())], ["n_tokens"])

    return docs.select("text").mapInArrow(run, "n_tokens long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """Per distinct length L (= a context limit): documents of that length, and
    by prefix and suffix sums the documents up to and over L, all tokens, tokens
    that truncation to L keeps and loses, and the cumulative share."""
    counts = lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))
    upto = Window.orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    after = Window.orderBy("n_tokens").rowsBetween(1, Window.unboundedFollowing)
    mass = F.col("n_tokens") * F.col("n_docs")
    out = counts.select(
        "n_tokens",
        "n_docs",
        F.sum("n_docs").over(upto).alias("docs_upto"),
        F.coalesce(F.sum("n_docs").over(after), F.lit(0)).alias("docs_over"),
        F.sum(mass).over(upto).alias("tokens_upto"),
        F.coalesce(F.sum(mass).over(after), F.lit(0)).alias("tokens_in_longer"),
    )
    kept = F.col("tokens_upto") + F.col("docs_over") * F.col("n_tokens")
    total = F.col("tokens_upto") + F.col("tokens_in_longer")
    return out.select(
        "*",
        total.alias("tokens_total"),
        kept.alias("tokens_kept"),
        (total - kept).alias("tokens_lost"),
        (F.col("docs_upto") / (F.col("docs_upto") + F.col("docs_over"))).alias("quantile"),
    )


def quantile(histogram: DataFrame, q: float) -> DataFrame:
    """The smallest length that at least a share ``q`` of documents do not exceed."""
    return histogram.where(F.col("quantile") >= q).agg(F.min("n_tokens").alias("n_tokens"))


def truncated_total(histogram: DataFrame, limit: int) -> DataFrame:
    """Tokens left when every document is cut to ``limit`` tokens."""
    kept = F.sum(F.least(F.col("n_tokens"), F.lit(limit)) * F.col("n_docs"))
    return histogram.agg(F.coalesce(kept, F.lit(0)).alias("tokens_kept"))
