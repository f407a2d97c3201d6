"""Components of graphs, by rounds and by the driver, against union and find."""

import random

import pytest

from folioflow.llm import decontamination, graph, store


def brute(edges):
    parent = {x: x for e in edges if e[0] != e[1] for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {x: find(x) for x in parent}


def some_edges():
    rng = random.Random(3)
    ids = [rng.getrandbits(64) - 2**63 for _ in range(400)]
    path, hub = ids[:120], ids[120:200]
    edges = [*zip(path, path[1:], strict=False), *((hub[0], x) for x in hub[1:]), *((rng.choice(ids[200:]), rng.choice(ids[200:])) for _ in range(120))]
    return edges + edges[:9] + [(b, a) for a, b in edges[20:40]] + [(ids[0], ids[0]), (5, 5), (-(2**63), 2**63 - 1)]


@pytest.mark.parametrize("most", [0, graph.DRIVER_EDGES])
def test_components(spark, monkeypatch, most):
    monkeypatch.setattr(graph, "DRIVER_EDGES", most)
    edges = some_edges()
    found = graph.components(spark.createDataFrame(edges, "a bigint, b bigint").repartition(5)).collect()
    assert len(found) == len({r["node"] for r in found})
    assert {r["node"]: r["root"] for r in found} == brute(edges)
    nothing = graph.components(spark.createDataFrame([(1, 1)], "a bigint, b bigint"))
    assert nothing.dtypes == [("node", "bigint"), ("root", "bigint")] and nothing.count() == 0
    store.release()


def test_few_edges_take_few_jobs(spark):
    """A round over few edges costs as much as its scheduling: a long path must not need one per halving."""
    n = 3000
    rng = random.Random(4)
    ids = rng.sample(range(10 * n), n)
    spark.sparkContext.setJobGroup("path", "components of a path")
    found = graph.components(spark.createDataFrame(list(zip(ids, ids[1:], strict=False)), "a bigint, b bigint"))
    spark.sparkContext.setJobGroup("other", "what follows")
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("path")
    assert {r["root"] for r in found.collect()} == {min(ids)} and found.count() == n
    assert len(jobs) <= 8
    store.release()


def test_table_of_flipped_items_is_narrow(spark, monkeypatch):
    """It has hundreds of rows an item and is built in the driver: no more columns than items are met by."""
    sent = []
    broadcast = decontamination.F.broadcast
    monkeypatch.setattr(decontamination.F, "broadcast", lambda df: sent.append(df.columns) or broadcast(df))
    passage = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, f"some words {passage} and more"), (2, "other words than these are here")], "doc_id bigint, text string")
    items = spark.createDataFrame([(7, passage), (8, passage)], "item_id bigint, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontamination.leaks(docs, items).collect()} == {(1, 7), (1, 8)}
    assert [c for c in sent if "item_mask" in c] == [["item_print", "item_mask", "spot"]]
    store.release()
