"""Near-duplicate classes by an n-gram Jaccard join with adaptive prefixes.

A document is the set of its five-word shingles.  Documents with equal sets form
one class: one of them stands for all from the first pass on.  Shingles are put in
one global order, rare first, by a count-min sketch over all documents.  Two sets
with Jaccard similarity of at least 0.8 share at least L shingles in the first
``n - ceil(0.8 n) + L`` of each, for every L; a document picks the L with the lowest
estimated cost: shingles to scan, plus candidates to verify, which fall as L grows.
Two documents are a candidate pair if they share ``min(L1, L2)`` prefix shingles,
and candidates are verified on their whole sets (100 * intersection >= 80 * union).

Candidates are not verified pair by pair: each set would travel once for every
partner.  Pairs are taken from lists (documents under one prefix shingle) of up to
``SHORT`` members and counted against L; longer lists, where a group of copies or
a common passage meets, tie together those members that have as many long lists
as the least L of the list asks, and count in full towards the L of every pair.
What candidates connect is a cluster.  A cluster is cut into blocks of at most
``BLOCK`` documents and about ``BLOCK_SHINGLES`` shingles.  A task gets the whole
sets of one block and of the cluster's ``PIVOTS`` pivots, tests all pairs of the
block and of block and pivots, and returns a spanning forest of the links.  Only
documents that this leaves outside of the cluster's largest component meet all
others, block by block.  So all links between different components are found, and
a group of near copies costs work in proportion to its size.

A list that may be long is dealt over many tasks by its estimated count, and the
neighbours of one node in the component steps by adaptive execution, so no task
holds a whole group.

Nulls: a null or empty text has an empty set and is linked with nothing; a null
doc_id joins its component but never names it (its component_id is null if all
its members' ids are).  Repeated rows are returned as often as they come.  An empty
table gives an empty result.  A very long text is one set and fills a block alone.
Other columns play no part; names that start with ``__ff_`` are taken.

Sets are told apart by 64-bit fingerprints of 64-bit shingle hashes: among ``N``
distinct sets about ``N**2 / 2**65`` pairs would be taken for equal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import components
from .sketch import Counts, Estimates, Repeated, Repeats, merged, pack, unpack
from .store import KEYS, bounded_batches, materialize, row_key, settled, ship
from .words import Words, document_windows, mix, text_batches, windows

SHINGLE = 5
BITS = 21
NODE_BITS = 24
MOST_SHARED = 6
VERIFY_COST = 8.0
SHORT = 32
BLOCK = 1024
BLOCK_SHINGLES = 1 << 19
PIVOTS = 8
TOKENS = 4096
BROADCAST_ROWS = 100_000
PER_BUCKET = 1_500_000
#: Code of the estimate from which the list of a shingle is dealt over several buckets, and the bit that marks it.
HEAVY = 8 * 16
MARK = 0x80
STAR_SALTS = 64
ENTRY = np.dtype([("t", "<u8"), ("fp", "<i8"), ("n", "<u4"), ("l", "u1")])


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, and where each starts."""
    words = Words(texts, lower=True)
    hashes = words.hashes()
    n = len(words.counts)
    at = np.flatnonzero(document_windows(words.counts, SHINGLE))
    doc = np.searchsorted(words.first, at, "right") - 1
    value = windows(hashes, SHINGLE)[at] if len(at) else np.zeros(0, np.uint64)
    short = np.flatnonzero((words.counts > 0) & (words.counts < SHINGLE))
    if len(short):  # the whole sequence is the one shingle; its length keeps it apart from the long ones
        whole = np.zeros(len(short), np.uint64)
        for k in range(SHINGLE - 1):
            has = words.counts[short] > k
            place = np.minimum(words.first[short] + k, len(hashes) - 1)
            whole = np.where(has, mix(whole + hashes[place] + np.uint64(k + 1)), whole)
        doc, value = np.concatenate([doc, short]), np.concatenate([value, mix(whole)])
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    doc, value = doc[new], value[new]
    return value, np.searchsorted(doc, np.arange(n + 1))


def fingerprints(value: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One 64-bit fingerprint per set (0 for the empty set)."""
    n = np.diff(first)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(value ^ np.uint64(0x9E6C63D0876A9A47)))])
    fp = mix(total[first[1:]] - total[first[:-1]] + n.astype(np.uint64))
    return np.where(n > 0, fp, np.uint64(0)).view(np.int64)


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sketch slices (slice >= 0) and a row (slice -1) for each document."""
    sketch, part = Counts(BITS), TaskContext.get().partitionId()
    names = ["part", "slice", "doc_id", "key", "row", "n", "fp", "data"]
    types = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    any_text = False
    for whole in batches:
        for batch in text_batches(whole):
            value, first = shingle_sets(batch.column("text"))
            fp = fingerprints(value, first)
            if len(value):
                sketch.add(value)
                any_text = True
            k = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(k, part, np.int32)), pa.array(np.full(k, -1, np.int32)), batch.column("doc_id"), batch.column("key"), batch.column("row"), pa.array(np.diff(first).astype(np.int64)), pa.array(fp), pa.nulls(k, pa.binary())], names
            )
    if any_text:
        rows = [(part, k, None, None, None, None, None, d) for k, d in sketch.slices()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


def needed(n: np.ndarray) -> np.ndarray:
    """Shingles that a set of ``n`` shares with any set it links to, at least."""
    return -(-4 * n // 5)


def prefixes(value: np.ndarray, first: np.ndarray, codes: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Prefix shingles of the given documents: indices into ``value``, the
    document of each, and each document's L."""
    n = np.diff(first)
    doc = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((value, codes, doc))  # whole sets in the global order, document by document
    scan = np.concatenate([[0.0], np.cumsum(np.exp2(codes[order] / 8.0))])
    start, size, need = first[docs], n[docs], needed(n[docs])
    best, cost = np.ones(len(docs), np.int64), np.full(len(docs), np.inf)
    for shared in range(1, MOST_SHARED + 1):
        length = np.minimum(size - need + shared, size)
        scanned = scan[start + length] - scan[start]
        price = scanned * (1 + VERIFY_COST / shared**2)
        better = (price < cost) & (shared <= need)
        best[better], cost[better] = shared, price[better]
    length = size - need + best
    at = np.repeat(start - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(int(length.sum()))
    return order[at], np.repeat(docs, length), best


def _emit_prefixes(batches: Iterator[pa.RecordBatch], estimates: Estimates, bits: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in text_batches(whole):
            value, first = shingle_sets(batch.column("text"))
            fp, n = fingerprints(value, first), np.diff(first)
            docs = np.unique(fp, return_index=True)[1]
            docs = docs[n[docs] > 0]
            if not len(docs):
                continue
            codes = estimates(value)
            at, doc, shared = prefixes(value, first, codes, docs)
            l_of = np.zeros(len(n), np.uint8)
            l_of[docs] = shared
            e = np.empty(len(at), ENTRY)
            e["t"], e["fp"], e["n"], e["l"] = value[at], fp[doc], n[doc], l_of[doc]
            place = e["t"].copy()
            heavy = np.flatnonzero(codes[at] >= HEAVY)
            if len(heavy):  # a part of the list for each 2**15 of the estimate
                e["l"][heavy] |= MARK
                salt = mix(e["fp"][heavy].view(np.uint64)) % np.exp2(np.ceil(codes[at[heavy]] / 8.0) - 15).astype(np.uint64)
                place[heavy] = mix(place[heavy] + salt)
            bucket = (place >> np.uint64(64 - bits)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            e, bucket = e[order], bucket[order]
            edges = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(e)]])
            keys = bucket[edges[:-1]]
            data = [pack(np.frombuffer(b"".join(e[c][i:j].tobytes() for c in ENTRY.names), np.uint8)) for i, j in zip(edges[:-1], edges[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.diff(edges)), pa.array(data, pa.binary())], ["bucket", "n", "data"])


def _read(n: int, data: bytes) -> np.ndarray:
    raw, e, at = unpack(data, np.uint8, n * ENTRY.itemsize), np.empty(n, ENTRY), 0
    for c in ENTRY.names:
        size = n * ENTRY[c].itemsize
        e[c] = np.frombuffer(raw[at : at + size].tobytes(), ENTRY[c])
        at += size
    return e


def _lists(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """One bucket's shingles that two different sets have in their prefixes:
    a row for each member.  Of a list that is dealt over buckets every member is
    kept, and its size is that of a long list whatever part of it is here."""
    e = np.concatenate([_read(n, d) for n, d in zip(rows["n"], rows["data"], strict=True)])
    e = e[np.lexsort((e["fp"], e["t"]))]
    new = np.ones(len(e), bool)
    new[1:] = (e["t"][1:] != e["t"][:-1]) | (e["fp"][1:] != e["fp"][:-1])
    e = e[new]
    group = np.concatenate([[0], np.cumsum(e["t"][1:] != e["t"][:-1])]) if len(e) else np.zeros(0, np.int64)
    size = np.bincount(group)[group] if len(e) else group
    size = np.where(e["l"] & MARK > 0, np.maximum(size, SHORT + 1), size)
    e, size = e[size > 1], size[size > 1]
    e["l"] &= MARK - 1
    return pd.DataFrame({"t": e["t"].view(np.int64), "fp": e["fp"], "n": e["n"].astype(np.int64), "l": e["l"].astype(np.int32), "size": size})


def _sets(batches: Iterator[pa.RecordBatch], wanted: Repeated) -> Iterator[pa.RecordBatch]:
    """Sets of the wanted texts; the filter may let others pass."""
    for whole in batches:
        keep = wanted(whole.column("key").to_numpy(zero_copy_only=False).view(np.uint64))
        for batch in text_batches(whole.select(["text"]).filter(pa.array(keep))):
            value, first = shingle_sets(batch.column("text"))
            fp = fingerprints(value, first)
            docs = np.unique(fp, return_index=True)[1]
            docs = docs[(np.diff(first)[docs] > 0)]
            yield pa.RecordBatch.from_arrays([pa.array(fp[docs]), pa.array([value[first[i] : first[i + 1]].tobytes() for i in docs], pa.binary())], ["fp", "set"])


def linked_forest(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Pairs of indices that connect what the links among the sets connect.

    Intersections of all pairs at once: shingles that two sets have are columns of
    a 0/1 matrix, taken ``TOKENS`` columns at a time."""
    n = len(sets)
    size = np.array([len(s) for s in sets], np.float32)
    owner = np.repeat(np.arange(n), size.astype(np.int64))
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    column, owner = (np.cumsum(shared) - 1)[column][shared[column]], owner[shared[column]]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    both = np.zeros((n, n), np.float32)
    for start in range(0, int(shared.sum()), TOKENS):
        a, b = np.searchsorted(column, [start, start + TOKENS])
        part = np.zeros((n, TOKENS), np.float32)
        part[owner[a:b], column[a:b] - start] = 1
        both += part @ part.T
    linked = 100 * both >= 80 * (size[:, None] + size[None, :] - both)
    np.fill_diagonal(linked, False)
    forest, fresh = [], np.ones(n, bool)
    for root in range(n):
        if not fresh[root]:
            continue
        fresh[root] = False
        stack = [root]
        while stack:
            x = stack.pop()
            new = np.flatnonzero(linked[x] & fresh)
            fresh[new] = False
            forest += [(x, int(y)) for y in new]
            stack += new.tolist()
    return forest


def _tile(rows: pd.DataFrame) -> pd.DataFrame:
    """Links of one pair of blocks, or of the small clusters of one bin."""
    out = []
    for _, cluster in rows.groupby("root", sort=False):
        cluster = cluster.drop_duplicates("fp").sort_values("fp")
        fp = cluster["fp"].to_numpy()
        out += [(int(fp[x]), int(fp[y])) for x, y in linked_forest([np.frombuffer(s, np.uint64) for s in cluster["set"]])]
    return pd.DataFrame(out, columns=["a", "b"])


def _note_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sketch, part, seen = Repeats(NODE_BITS), TaskContext.get().partitionId(), False
    for batch in batches:
        keys = batch.column("key").to_numpy(zero_copy_only=False).view(np.uint64)
        if len(keys):
            sketch.add(np.concatenate([keys, keys]))  # twice: the filter knows what was counted twice
            seen = True
    rows = [(part, k, d) for k, d in sketch.slices()] if seen else []
    types = (pa.int32(), pa.int32(), pa.binary())
    columns = list(zip(*rows, strict=True)) if rows else [()] * 3
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["part", "slice", "data"])


def _sized(a: Column, b: Column) -> Column:
    return 5 * F.least(a, b) >= 4 * F.greatest(a, b)


def text_key() -> Column:
    return F.xxhash64(F.col("text").isNull(), "text")


class Join:
    """Survey, prefixes and lists of one table of (doc_id, text)."""

    def __init__(self, docs: DataFrame):
        self.spark = docs.sparkSession
        bounded_batches(self.spark)
        keyed = docs.select("doc_id", "text", text_key().alias("key"), row_key(docs)[2].alias("row"))
        survey = materialize(keyed.mapInArrow(_survey, "part int, slice int, doc_id long, key long, row long, n long, fp long, data binary"), "survey")
        #: a row for each document: doc_id, key (of its text), row (hash of the row), n (shingles), fp (of its set)
        self.documents = survey.where("slice = -1").select("doc_id", "key", "row", "n", "fp")
        estimates = Estimates(merged(survey.where("slice >= 0").select("part", "slice", "data"), Counts), BITS)
        # one text stands for each set; sets that come once are the bulk, and their texts need no exchange
        pairs = self.documents.where("n > 0").groupBy("fp", "key").agg(F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"))
        pairs = materialize(pairs, "pairs")
        self.sets = materialize(pairs.groupBy("fp").agg(F.min("key").alias("key"), F.sum("copies").alias("copies"), F.first("n").alias("n")), "sets")
        again = pairs.select("fp", "key").join(self.sets.where("copies > 1").select("fp", F.col("key").alias("chosen")), "fp")
        again = materialize(again.select("key", (F.col("key") == F.col("chosen")).alias("chosen")), "again")
        again = F.broadcast(again) if again.count() <= BROADCAST_ROWS else again
        texts = keyed.select("key", "text")
        copies = materialize(texts.join(again.where("chosen"), "key", "left_semi").dropDuplicates(["key"]), "copies")
        self.texts = texts.join(again, "key", "left_anti").unionByName(copies)
        total = self.sets.agg(F.sum("n")).first()[0] or 0
        bits = max(1, int(self.spark.conf.get("spark.sql.shuffle.partitions")) - 1, total // (4 * PER_BUCKET)).bit_length()
        shipped = ship(self.spark, estimates)
        sent = self.texts.select("text").mapInArrow(lambda it: _emit_prefixes(it, shipped.value, bits), "bucket long, n long, data binary")
        lists = sent.groupBy("bucket").applyInPandas(_lists, "t long, fp long, n long, l int, size long")
        self.lists = materialize(lists, "lists")

    def links(self) -> DataFrame:
        """Verified links (a, b) that connect exactly what all links connect."""
        clusters = materialize(components(self._candidates()).withColumnRenamed("node", "fp").join(self.sets.select("fp", "key", "n"), "fp"), "clusters")
        wanted = Repeated(merged(clusters.select("key").mapInArrow(_note_nodes, "part int, slice int, data binary"), Repeats), NODE_BITS)
        shipped = ship(self.spark, wanted)
        sets = self.texts.select("key", "text").mapInArrow(lambda it: _sets(it, shipped.value), "fp long, set binary")
        sets = materialize(sets.join(clusters.select("fp", "root"), "fp").dropDuplicates(["fp"]), "members")
        blocks = F.greatest(F.ceil(F.col("m") / BLOCK), F.ceil(F.col("k") / BLOCK_SHINGLES))
        sizes = clusters.groupBy("root").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("k"))
        large = materialize(sizes.select("root", "m", blocks.alias("blocks")).where("blocks > 1"), "large")
        n_large, weight = large.count(), clusters.agg(F.count(F.lit(1)), F.sum("n")).first()
        large = F.broadcast(large) if n_large <= BROADCAST_ROWS else large
        bins = 1 + max(weight[0] // BLOCK, (weight[1] or 0) // BLOCK_SHINGLES)
        zero = F.lit(0).cast("long")
        # clusters of one block share tasks
        tiles = sets.join(large, "root", "left_anti").select("*", F.lit("small").alias("kind"), F.pmod(F.xxhash64("root"), F.lit(bins)).alias("i"), zero.alias("j"))
        if not n_large:
            return _tiles(tiles)
        members = sets.join(large, "root").withColumn("i", F.pmod(F.xxhash64("fp"), F.col("blocks")))
        # pivots are the least by a hash, one of each eighth: partial aggregates merge them
        pivots = members.groupBy("root", "blocks", F.pmod(F.xxhash64("fp", F.lit(2)), F.lit(PIVOTS)).alias("of")).agg(F.min_by("fp", F.struct(F.xxhash64("fp", F.lit(1)), "fp")).alias("fp"))
        pivots = materialize(pivots, "pivots").join(sets.select("fp", "set"), "fp").withColumn("i", F.explode(F.sequence(zero, F.col("blocks") - 1)))
        first = members.select("fp", "root", "set", "i").unionByName(pivots.select("fp", "root", "set", "i"))
        forest = materialize(_tiles(tiles.unionByName(first.select("*", F.lit("first").alias("kind"), F.col("i").alias("j")))), "forest")
        return forest.unionByName(_outer_links(members, forest))

    def _candidates(self) -> DataFrame:
        """Edges (a, b): pairs that share enough prefix shingles, and a star over
        the members of every long list."""
        long = self.lists.where(F.col("size") > SHORT)
        held = materialize(long.groupBy("fp").agg(F.count(F.lit(1)).alias("held")), "held")
        short = self.lists.where(F.col("size") <= SHORT)
        x = short.select("t", F.col("fp").alias("a"), F.col("n").alias("na"), F.col("l").alias("la"))
        y = short.select("t", F.col("fp").alias("b"), F.col("n").alias("nb"), F.col("l").alias("lb"))
        pairs = x.join(y, "t").where((F.col("a") < F.col("b")) & _sized(F.col("na"), F.col("nb")))
        counted = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"), F.min(F.least("la", "lb")).alias("least"))
        counted = counted.join(held.select(F.col("fp").alias("a"), F.col("held").alias("ha")), "a", "left").join(held.select(F.col("fp").alias("b"), F.col("held").alias("hb")), "b", "left")
        most = F.col("shared") + F.coalesce(F.least("ha", "hb"), F.lit(0))
        near = counted.where(F.when(F.col("ha").isNull() | F.col("hb").isNull(), F.col("shared")).otherwise(most) >= F.col("least")).select("a", "b")
        # a pair that meets in long lists only shares as many of them as the smaller L of the two, and that is no less
        # than the least of the list; per list and salt, so that no task holds a whole list
        salted = long.join(held, "fp").withColumn("salt", F.pmod(F.xxhash64("fp"), F.lit(STAR_SALTS)))
        parts = materialize(salted.groupBy("t", "salt").agg(F.min("l").alias("least")), "parts")
        least = parts.select("t", "salt").join(parts.groupBy("t").agg(F.min("least").alias("least")), "t")
        able = materialize(salted.join(least, ["t", "salt"]).where(F.col("held") >= F.least("l", "least")).select("t", "salt", "fp"), "able")
        hubs = materialize(able.groupBy("t", "salt").agg(F.min("fp").alias("b")), "hubs")
        stars = able.join(hubs, ["t", "salt"]).select(F.col("fp").alias("a"), "b")
        tops = hubs.join(hubs.groupBy("t").agg(F.min("b").alias("top")), "t").select(F.col("b").alias("a"), F.col("top").alias("b"))
        return near.unionByName(stars.unionByName(tops).where("a <> b").distinct())


def _tiles(rows: DataFrame) -> DataFrame:
    """Spanning forests of the links in each task: kind, i and j, and in large clusters root."""
    task = F.when(F.col("kind") == "small", F.lit(0).cast("long")).otherwise(F.col("root")).alias("task")
    return rows.select("fp", "root", "set", "kind", "i", "j", task).groupBy("kind", "task", "i", "j").applyInPandas(_tile, "a long, b long")


def _outer_links(members: DataFrame, forest: DataFrame) -> DataFrame:
    """Links of the documents of large clusters (fp, root, set, m, blocks, i) that
    the forest leaves outside of the largest component of their cluster: each
    meets all blocks of it."""
    parts = components(forest.join(members.select(F.col("fp").alias("a")), "a", "left_semi")).select(F.col("node").alias("fp"), F.col("root").alias("part"))
    parts = materialize(members.select("fp", "root").join(parts, "fp", "left").withColumn("part", F.coalesce("part", "fp")), "parts")
    sizes = parts.groupBy("root", "part").agg(F.count(F.lit(1)).alias("held"))
    main = sizes.groupBy("root").agg(F.max_by("part", F.struct("held", "part")).alias("main"), (F.sum("held") - F.max("held")).alias("left")).where("left > 0")
    main = materialize(main, "main")
    main = F.broadcast(main) if main.count() <= BROADCAST_ROWS else main
    met = members.join(parts.select("fp", "part"), "fp").join(main, "root").withColumn("slots", F.ceil(F.col("blocks") * F.col("left") / F.col("m")))
    zero = F.lit(0).cast("long")
    every = met.withColumn("j", F.explode(F.sequence(zero, F.col("slots") - 1)))
    outer = met.where("part <> main").withColumn("j", F.pmod(F.xxhash64("fp", F.lit(3)), F.col("slots"))).withColumn("i", F.explode(F.sequence(zero, F.col("blocks") - 1)))
    columns = ["fp", "root", "set", F.lit("outer").alias("kind"), "i", "j"]
    return _tiles(every.select(*columns).unionByName(outer.select(*columns)))


def _classes(docs: DataFrame) -> DataFrame:
    join = Join(docs)
    roots = materialize(components(join.links()), "roots")
    nodes = join.documents.where("n > 0").groupBy("fp").agg(F.min("doc_id").alias("least")).join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    nodes = materialize(nodes.withColumn("root", F.coalesce("root", "fp")), "nodes")
    named = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    names = nodes.select("fp", "root").join(named, "root").select("fp", "root", "component_id")
    out = join.documents.join(names, "fp", "left")
    alone = F.col("n") == 0
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "row", F.when(alone, F.col("key")).otherwise(F.col("root")).alias("root"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every document; row (a hash of the
    row) and root (of its component) tell documents and components apart."""
    return settled(lambda: _classes(docs), "classes")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each component, the one with the smallest id; all columns
    as they are.  Of rows with the same id and class the one with the least row
    hash stays, of equal rows one; documents without shingles stay."""

    def kept() -> DataFrame:
        found = near_duplicates(docs).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        keep = found.groupBy("root", "doc_id").agg(F.min("row").alias("__ff_key"))
        return keep.select(F.coalesce("doc_id", F.lit(0)).alias("__ff_id"), F.col("doc_id").isNull().alias("__ff_no"), "__ff_key").distinct()

    keep = settled(kept, "kept")
    return docs.select("*", *row_key(docs)).join(keep, KEYS, "left_semi").dropDuplicates(KEYS).select(*docs.columns)
