"""Connected components of an undirected graph as DataFrame steps."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import materialize

#: Edges that the driver takes itself, about 2 MB: a round over so few is all scheduling.
DRIVER_EDGES = 100_000


def _least(edges: DataFrame) -> DataFrame:
    """a and m, its least neighbour.  Written: as both sides of the join with the
    edges are plain exchanges then, adaptive execution splits a hub's part of it."""
    return materialize(edges.groupBy("a").agg(F.min("b").alias("m")), "least")


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def least_reached(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All nodes of the edges, and the smallest node that each reaches: roots hang
    on the least root across an edge, and paths are halved to their ends."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while (apart := root[a] != root[b]).any():
        a, b = a[apart], b[apart]
        np.minimum.at(root, np.maximum(root[a], root[b]), np.minimum(root[a], root[b]))
        while (root[root] != root).any():
            root = root[root]
    return nodes, nodes[root]


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: bigint): the smallest
    node that it reaches.

    Alternates large-star and small-star steps, which keep the components and
    end in stars; every step is a few aggregations by node.  Each step is
    written, so lineage and plans stay short; a sum over the edges tells when nothing
    changes any more.  If that takes over ``max_rounds`` rounds, it is an error:
    partial components are never returned.  Without edges there are no rows;
    loops and repeated edges count once; edges with a null end must be left out.

    Up to ``DRIVER_EDGES`` edges need no rounds: the driver connects them."""
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = materialize(e, "edges")
    last = _checksum(e)
    if 0 < last[0] <= DRIVER_EDGES:
        ends = e.toArrow()
        node, root = least_reached(*[ends.column(c).to_numpy() for c in ("a", "b")])
        return materialize(e.sparkSession.createDataFrame(pa.table({"node": node, "root": root})), "roots")
    for _ in range(max_rounds):
        # large star: neighbours above a node hang on its smallest neighbour
        both = e.union(e.select("b", "a"))
        large = both.where("b > a").join(_least(both), "a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).where("a <> b").distinct()
        large = materialize(large, "large")
        # small star: so do those below it, and the node itself
        low = _least(large)
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").union(low).distinct()
        e = materialize(small, "edges")
        now = _checksum(e)
        if now == last:
            break
        last = now
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
