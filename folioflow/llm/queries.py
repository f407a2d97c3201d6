"""Thin queries over the operators of this package, with production settings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontamination, hilbert, html_paths, lengths, lines, mixing, ngram_join, outliers, substrings, subword


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_tag_path_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_paths.main_text(table(spark, sf_dir, "pages"))


def op2_mcd_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.quality_rules(table(spark, sf_dir, "documents"))


def op3_mixing_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op4_count_min_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digests(table(spark, sf_dir, "documents"))


def op5_adaptive_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents")).drop("row", "root")


def op6_token_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lengths.length_histogram(lengths.token_lengths(table(spark, sf_dir, "documents")))


def op7_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.shards(table(spark, sf_dir, "documents")).drop("curve")


def op8_simhash_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("key")


def op9_site_spread_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.without_boilerplate(table(spark, sf_dir, "documents"))


def op10_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subword.classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_tag_path_text": op1_tag_path_text,
    "op2_mcd_outliers": op2_mcd_outliers,
    "op3_mixing_schedule": op3_mixing_schedule,
    "op4_count_min_substrings": op4_count_min_substrings,
    "op5_adaptive_prefix_join": op5_adaptive_prefix_join,
    "op6_token_lengths": op6_token_lengths,
    "op7_hilbert_sharding": op7_hilbert_sharding,
    "op8_simhash_decontamination": op8_simhash_decontamination,
    "op9_site_spread_lines": op9_site_spread_lines,
    "op10_subword_quality": op10_subword_quality,
}
