"""Sharding along a Hilbert curve through several metadata dimensions.

Rows are ordered by the Hilbert index of quantised metadata and the order is
cut into runs.  A run covers a compact box of (lang, source, size), so the
min/max statistics of its file prune on any of them.

Native and linear.  A first scan counts rows per language, source and size class,
and gives the table of the curve's cells (``2**(3 * BITS)`` rows at most): where
each cell starts in the order and how many rows it has.  With it every row knows
its partition, from its cell and a uniform hash that orders the rows of a cell, so
rows move once, partitions are even, a hot cell is split, and nothing is sampled.
The rank of a row is its place in its partition plus the rows of the partitions
before it; no partition ever holds the whole order.

Nulls: a null text counts as empty (size 16, CRC-32 of no bytes), null lang and
source take the last cell, null ids are kept and ordered by their texts.  Repeated
rows, and rows that tie in everything, each get a slot.  A very long text is a row
like others (size classes end at 2**20 bytes).  An empty table gives an empty
result.  An input column whose name the result needs comes back as ``input_`` and
its name; names that start with ``__ff_`` are taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import in_order, materialize, offsets, settled

BITS = 5
MADE = ("size", "text_crc32", "law", "shard", "slot", "grown_shard", "curve")


def size_of(text: Column) -> Column:
    return F.octet_length(F.coalesce(text, F.lit(""))).cast("long") + 16


def hilbert_index(axes: list[Column], bits: int) -> Column:
    """Index on the Hilbert curve (Skilling's transform), most significant bit
    first.  Each axis holds ``bits`` bits; the steps run over a short array."""
    n = len(axes)
    steps = F.array(*[F.struct(F.lit(1 << b).cast("long").alias("q"), F.lit(i).alias("i")) for b in range(bits - 1, 0, -1) for i in range(n)])

    def turn(x: Column, s: Column) -> Column:
        own, low = F.element_at(x, s["i"] + 1), s["q"] - 1
        swap = (F.element_at(x, F.lit(1)).bitwiseXOR(own)).bitwiseAND(low)
        flip = own.bitwiseAND(s["q"]) != 0
        return F.transform(
            x,
            lambda v, j: F.when(flip, F.when(j == 0, v.bitwiseXOR(low)).otherwise(v)).when((j == 0) | (j == s["i"]), v.bitwiseXOR(swap)).otherwise(v),
        )

    turned = F.aggregate(steps, F.array(*[a.cast("long") for a in axes]), turn)
    # Gray code: the running exclusive or along the axes
    gray = F.aggregate(
        turned,
        F.array().cast("array<bigint>"),
        lambda done, v: F.concat(done, F.array(v.bitwiseXOR(F.coalesce(F.get(done, F.size(done) - 1), F.lit(0).cast("long"))))),
    )
    last = F.element_at(gray, F.lit(n))
    tail = F.aggregate(
        F.array(*[F.lit(1 << b).cast("long") for b in range(bits - 1, 0, -1)]),
        F.lit(0).cast("long"),
        lambda t, q: F.when(last.bitwiseAND(q) != 0, t.bitwiseXOR(q - 1)).otherwise(t),
    )
    places = F.array(*[F.struct(F.lit(b).alias("b"), F.lit(i).alias("i")) for b in range(bits - 1, -1, -1) for i in range(n)])
    return F.aggregate(
        places,
        F.struct(F.lit(0).cast("long").alias("index"), F.transform(gray, lambda v: v.bitwiseXOR(tail)).alias("x")),
        lambda acc, p: F.struct(
            (acc["index"] * 2 + F.call_function("shiftright", F.element_at(acc["x"], p["i"] + 1), p["b"]).bitwiseAND(F.lit(1).cast("long"))).alias("index"),
            acc["x"].alias("x"),
        ),
        lambda acc: acc["index"],
    )


def depth_code(counts: DataFrame, column: str, bits: int = BITS) -> Column:
    """An order-preserving code of equal depth for a column of any cardinality,
    from rows (column, n): at most ``2**bits`` boundaries reach the driver."""
    values = counts.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.sum("n").alias("n"))
    ordered = in_order(values, ["v"], "values")
    inside = F.sum("n").over(Window.partitionBy("__ff_p").orderBy("__ff_at")) - F.col("n")
    placed = ordered.withColumn("inside", inside).join(F.broadcast(offsets(ordered, n0=F.col("n"))), "__ff_p")
    cell = F.floor((F.col("n0") + F.col("inside")) * F.lit(1 << bits) / F.col("n0_all"))
    rows = placed.groupBy(cell.alias("cell")).agg(F.min("v").alias("v")).orderBy("v").collect()
    if not rows:
        return F.lit((1 << bits) - 1)
    bounds = F.array(*[F.lit(r["v"]) for r in rows])
    return F.when(F.col(column).isNull(), F.lit((1 << bits) - 1)).otherwise(F.size(F.filter(bounds, lambda b: b <= F.col(column))) - 1)


def size_code(size: Column, bits: int = BITS) -> Column:
    """Half octaves of the size above 16 bytes."""
    return F.least(F.lit((1 << bits) - 1), F.floor(F.log2(size / 16.0) * 2).cast("int"))


def _cells(docs: DataFrame) -> tuple[DataFrame, Column, Column]:
    """curve, rows before (``n0``) and rows (``n``) of every cell (``__ff_l``,
    ``__ff_s``, ``__ff_z``), and the codes of lang and source."""
    counts = docs.groupBy("lang", "source", size_code(size_of(F.col("text"))).alias("__ff_z")).agg(F.count(F.lit(1)).alias("n"))
    counts = materialize(counts, "counts")
    lang, source = depth_code(counts, "lang"), depth_code(counts, "source")
    cells = counts.groupBy(lang.alias("__ff_l"), source.alias("__ff_s"), "__ff_z").agg(F.sum("n").alias("n"))
    cells = cells.withColumn("curve", hilbert_index([F.col("__ff_l"), F.col("__ff_s"), F.col("__ff_z")], BITS))
    # at most 2**15 rows, whatever the table
    before = Window.orderBy("curve").rowsBetween(Window.unboundedPreceding, -1)
    everything = F.sum("n").over(Window.partitionBy())
    return cells.select("__ff_l", "__ff_s", "__ff_z", "curve", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"), everything.alias("all")), lang, source


def shards(docs: DataFrame, n_shards: int = 40, law: str = "rows", keep: list[str] | None = None, partitions: int | None = None) -> DataFrame:
    """Every row with ``curve``, ``shard`` (0 to ``n_shards`` - 1) and ``slot``.

    ``law`` "rows" makes shard counts at most one apart; "bytes" cuts the same
    order where the running size passes equal shares.  ``keep`` names the input
    columns to carry; internal names start with ``__ff_``."""
    if law not in ("rows", "bytes"):
        raise ValueError(f"law must be rows or bytes, not {law}")
    keep = ["doc_id"] if keep is None else keep
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    codes = []

    def cells() -> DataFrame:
        table, *found = _cells(docs)
        codes.extend(found)
        return table

    table = settled(cells, "cells")
    own = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null"), F.md5(F.coalesce("text", F.lit("")).cast("binary"))))
    size = size_of(F.col("text"))
    base = docs.select(
        *[F.col(c).alias(f"__ff_k{i}") for i, c in enumerate(keep)],
        size.alias("__ff_size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("__ff_crc"),
        codes[0].alias("__ff_l"),
        codes[1].alias("__ff_s"),
        size_code(size).alias("__ff_z"),
        F.md5(own.cast("binary")).alias("__ff_tie"),
    ).join(F.broadcast(table), ["__ff_l", "__ff_s", "__ff_z"])
    share = F.conv(F.substring("__ff_tie", 1, 12), 16, 10).cast("double") / float(1 << 48)
    run = F.floor((F.col("n0") + F.col("n") * share) * n / F.col("all")).cast("int")
    base = base.withColumn("__ff_run", F.least(run, F.lit(n - 1))).withColumnRenamed("curve", "__ff_curve").drop("n", "n0", "all", "__ff_l", "__ff_s", "__ff_z")
    order = ["__ff_curve", "__ff_tie", "__ff_size", "__ff_crc"]
    ranged = base.repartitionById(n, "__ff_run").sortWithinPartitions(*order).withColumn("__ff_at", F.monotonically_increasing_id())
    ranged = materialize(ranged.drop("__ff_tie"), "hilbert").withColumn("__ff_p", F.shiftright("__ff_at", 33))
    ordinal = F.col("__ff_at").bitwiseAND(F.lit((1 << 33) - 1))
    starts = offsets(ranged, n0=F.lit(1), b0=F.col("__ff_size"))
    starts = starts.select("__ff_p", *[F.col(c).alias(f"__ff_{c}") for c in ("n0", "b0")], F.col("n0_all").alias("__ff_n"), F.col("b0_all").alias("__ff_b"))
    # one row per range partition: bounded by the number of partitions
    placed = ranged.join(F.broadcast(starts), "__ff_p").withColumn("__ff_rank", F.col("__ff_n0") + ordinal)
    k = F.lit(n_shards).cast("long")
    if law == "rows":
        placed = placed.withColumn("shard", F.floor(F.col("__ff_rank") * k / F.col("__ff_n")).cast("int")).withColumn(
            "shard", F.when(F.col("shard") * F.col("__ff_n") > F.col("__ff_rank") * k, F.col("shard") - 1).otherwise(F.col("shard"))
        )
        first = -F.floor(-(F.col("shard") * F.col("__ff_n")) / k)
        placed = placed.withColumn("slot", (F.col("__ff_rank") - first).cast("long"))
    else:
        running = F.sum("__ff_size").over(Window.partitionBy("__ff_p").orderBy("__ff_at")) - F.col("__ff_size") / 2
        placed = placed.withColumn("shard", F.least(F.lit(n_shards - 1), F.floor((F.col("__ff_b0") + running) * k / F.col("__ff_b"))).cast("int"))
        firsts = placed.groupBy("shard").agg(F.min("__ff_rank").alias("__ff_first"))
        placed = placed.join(F.broadcast(firsts), "shard").withColumn("slot", F.col("__ff_rank") - F.col("__ff_first"))
    return placed.select(
        *[F.col(f"__ff_k{i}").alias(c) for i, c in enumerate(kept_names(keep))],
        F.col("__ff_size").alias("size"),
        F.col("__ff_crc").alias("text_crc32"),
        F.lit(law).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        F.col("__ff_curve").alias("curve"),
    )


def kept_names(keep: list[str]) -> list[str]:
    """Names of the carried columns in the result."""
    out = []
    for c in keep:
        while c in MADE or c in out:
            c = f"input_{c}"
        out.append(c)
    return out


def sharded(docs: DataFrame, n_shards: int = 40, law: str = "rows") -> DataFrame:
    """The documents in curve order with their size, shard, slot and curve."""
    return shards(docs, n_shards, law, keep=docs.columns).select(*kept_names(docs.columns), "size", "shard", "slot", "curve")


def write_shards(docs: DataFrame, path: str, n_shards: int = 40, law: str = "rows") -> None:
    """Write the documents as one folder per shard, in curve order."""
    out = sharded(docs, n_shards, law)
    out.repartitionById(n_shards, "shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
