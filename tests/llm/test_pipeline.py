"""Pipeline stages on small texts, and the package's boundaries."""

import pathlib
import re

import corpus_pipeline
from pyspark.sql import functions as F

from folioflow.llm import mixing, ngram_join, subword


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "ngram_jaccard_join", "benchmark_decontamination", "source_mixing", "hilbert_sharding"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_one_of_each(spark, sample, nothing):
    df, rows, _ = sample
    kept = ngram_join.one_of_each(df)
    assert kept.columns == df.columns
    found = {(r["doc_id"], r["component_id"]) for r in ngram_join.near_duplicates(df).select("doc_id", "component_id").collect()}
    ids = [r["doc_id"] for r in kept.select("doc_id").collect() if r["doc_id"] is not None]
    assert sorted(ids) == sorted(d for d, c in found if d is not None and d == c)
    assert ngram_join.one_of_each(nothing).count() == 0


def test_one_of_each_keeps_one_row_of_an_id(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text, "b"), (1, text, "a"), (1, text, "a"), (2, text + " end", "c"), (None, "other words here " * 9, "x"), (None, "other words here " * 9, "y"), (3, None, "z"), (3, "", "z")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    first = sorted(map(tuple, ngram_join.one_of_each(df).collect()), key=str)
    assert [r[0] for r in first] == [1, 3, 3, None]
    assert sorted(map(tuple, ngram_join.one_of_each(df.repartition(5)).collect()), key=str) == first


def test_resampled(spark, sample, nothing):
    df, rows, _ = sample
    got = mixing.resampled(df, block_words=8)
    assert got.columns == df.columns
    times = {r["doc_id"]: r["count"] for r in got.where("doc_id is not null").groupBy("doc_id").count().collect()}
    taken, size = {}, {}
    for r in mixing.mixed(df, block_words=8).collect():
        if r["doc_id"] is not None and r["size"]:
            taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + r["taken"]
            size[r["doc_id"]] = r["size"]
    for i in size:  # the middle word decides: only a text that is cut can differ, and by one copy
        assert abs(times.get(i, 0) - taken[i] / size[i]) <= 1
        assert taken[i] % size[i] or times.get(i, 0) == taken[i] / size[i]
    assert mixing.resampled(nothing).count() == 0


def test_resampled_follows_the_schedule(spark, sample):
    """Sources alternate from the first rows on, as the slots do."""
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 64).alias("text"), F.when(F.col("id") % 4 > 0, "a").otherwise("b").alias("source"))
    got = [r["source"] for r in mixing.resampled(df).select("source").collect()]
    share = got.count("a") / len(got)
    for part in (got[: len(got) // 8], got[-len(got) // 8 :]):
        assert abs(part.count("a") / len(part) - share) < 0.05


def test_run(spark, tmp_path, sample):
    df, rows, passage = sample
    base = f"file://{tmp_path}"
    df.write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id bigint, text string").write.parquet(f"{base}/benchmark.parquet")
    spark.createDataFrame([(i * 3, int("#" not in (rows[i][1] or "")), 0) for i in range(60)], "doc_id bigint, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    out = corpus_pipeline.run(spark, base)
    texts = [r["text"] for r in out.collect()]
    assert texts and not any(passage in t for t in texts)
    assert {"doc_id", "text", "lang", "source", "n_chars", "shard", "slot"} <= set(out.columns)


def test_run_on_nothing(spark, tmp_path, nothing):
    base = f"file://{tmp_path}"
    nothing.write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{base}/benchmark.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    assert corpus_pipeline.run(spark, base).count() == 0


def test_accepted(spark, sample, nothing):
    df, rows, _ = sample
    labels = spark.createDataFrame([(i * 3, int("#" not in (rows[i][1] or "")), 0) for i in range(60)], "doc_id bigint, quality int, toxic int")
    kept = subword.accepted(df, labels)
    assert kept.columns == df.columns
    scores = {(r["doc_id"], r["score"]) for r in subword.classified(df, labels).collect()}
    assert {r["doc_id"] for r in kept.collect()} == {i for i, s in scores if s >= 0.5}
    assert subword.accepted(nothing, labels).count() == 0


def test_nothing_else_imports_the_package():
    root = pathlib.Path(corpus_pipeline.__file__).parent
    for path in (root / "folioflow").rglob("*.py"):
        if "llm" not in path.parts:
            assert not re.search(r"\bllm\b\s*(import|\.)|import llm|from \.+llm", path.read_text()), path


def test_native_operators_use_no_python():
    root = pathlib.Path(corpus_pipeline.__file__).parent / "folioflow" / "llm"
    for name in ("mixing", "hilbert", "decontamination", "lines"):
        assert not re.search(r"udf|pandas|InArrow|\.rdd\b|mapPartitions", (root / f"{name}.py").read_text(), re.I), name
