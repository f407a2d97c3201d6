"""A corpus from raw documents to training shards.

Each stage takes (spark, docs, sf_dir) and returns what it keeps; ``run`` writes
each result and reads it again as the next stage's input.  All stages but the
last return the columns of ``documents``, whatever these are.

In every stage null and very long texts, null ids, langs and sources, repeated
rows and further columns are allowed, and an empty table gives an empty result;
what each stage makes of them its docstring says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folioflow.llm import decontamination, hilbert, mixing, ngram_join, store, subword


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the subword classifier rejects go.  Null and empty texts get
    the prior of the training labels; repeated rows are judged alike; a score of
    exactly 0.5 stays."""
    return subword.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component stays: the one with the least
    id, of rows with that id the one with the least row hash, of equal rows one.
    Documents without words are no duplicates; all of them stay, but equal rows
    once.  A component whose ids are all null keeps one row."""
    return ngram_join.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go, all rows with that id and text.
    Null and empty texts and items match nothing."""
    return decontamination.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are taken as often as the source schedule takes them, and written
    in its order.  Texts without words are in no mix; of equal rows each is taken
    on its own; a null source is a source."""
    return mixing.resampled(docs)


def hilbert_sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document gets its shard and slot along the Hilbert curve.  Null and
    empty texts have size 16, null langs and sources the last cell; repeated rows
    get a slot each; a column named as one of the results comes back as ``input_``
    and its name."""
    return hilbert.sharded(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("hilbert_sharding", hilbert_sharding),
]

#: The trained classifier and the hashed joins are not expressible in SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store.settled(lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
