"""Typed edges: endpoints, neighbourhoods, paths and degree subgraphs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.sinks import scratch


def valid_edges(edges: DataFrame, nodes: DataFrame, key: str) -> DataFrame:
    """Edges (src, dst, ...) both of whose ends are nodes."""
    ids = nodes.select(key).distinct()
    return edges.join(ids.withColumnRenamed(key, "src"), "src", "left_semi").join(ids.withColumnRenamed(key, "dst"), "dst", "left_semi")


def neighbourhood(edges: DataFrame, node) -> DataFrame:
    """direction, other, rel_type of every edge at a node, each once."""
    out = edges.where(F.col("src") == node).select(F.lit("out").alias("direction"), F.col("dst").alias("other"), "rel_type")
    into = edges.where(F.col("dst") == node).select(F.lit("in").alias("direction"), F.col("src").alias("other"), "rel_type")
    return out.unionByName(into).distinct()


def reachable(edges: DataFrame, starts: DataFrame, depth: int) -> DataFrame:
    """(start, node, steps): nodes on paths of 1 to ``depth`` edges, with the
    fewest steps.  One join and dedup per step; nodes reached before do not
    travel again, so cycles end.  Each step is written, so none runs twice."""
    frontier = starts.select(F.col("start"), F.col("start").alias("node"), F.lit(0).alias("steps"))
    seen = frontier
    hop = edges.select(F.col("src").alias("node"), F.col("dst").alias("__next")).distinct()
    for k in range(1, depth + 1):
        frontier = frontier.join(hop, "node").select("start", F.col("__next").alias("node"), F.lit(k).alias("steps")).distinct()
        path = scratch(edges.sparkSession, "frontier")
        frontier.join(seen.select("start", "node"), ["start", "node"], "left_anti").write.parquet(path)
        frontier = edges.sparkSession.read.schema(frontier.schema).parquet(path)
        seen = seen.unionByName(frontier)
    return seen.where("steps > 0")


def densest(edges: DataFrame, n: int) -> DataFrame:
    """Edges among the ``n`` nodes of highest degree."""
    ends = edges.select(F.col("src").alias("node")).unionAll(edges.select(F.col("dst").alias("node")))
    top = ends.groupBy("node").agg(F.count(F.lit(1)).alias("degree")).orderBy(F.desc("degree"), "node").limit(n).select("node")
    top = F.broadcast(top)  # n rows
    return edges.join(top.withColumnRenamed("node", "src"), "src", "left_semi").join(top.withColumnRenamed("node", "dst"), "dst", "left_semi")


def graph_stats(edges: DataFrame) -> DataFrame:
    """Edges and distinct sources and targets per relation type."""
    return edges.groupBy("rel_type").agg(F.count(F.lit(1)).alias("n_edges"), F.countDistinct("src").alias("n_src"), F.countDistinct("dst").alias("n_dst"))


def nodes_and_edges(records: DataFrame, refs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Graph export: a node per record (known ones win over mere references) and
    distinct typed edges; refs are (src, dst, rel_type)."""
    known = records.select(F.col("slug").alias("id"), F.lit(0).alias("rank"))
    named = refs.select(F.col("dst").alias("id"), F.lit(1).alias("rank"))
    nodes = known.unionByName(named).groupBy("id").agg((F.min("rank") == 0).alias("known"))
    return nodes, refs.select("src", "dst", "rel_type").distinct()
