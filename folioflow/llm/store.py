"""Intermediate tables in the shared folder the session names, row keys, and
ranks over a whole table.

Lineage is cut by writing Parquet below ``spark.checkpoint.dir`` and reading
it back: the files outlive any executor and every executor can see them.  On a
cluster the setting must be there; only a session whose executors run on this
machine (master ``local``) gets a temporary folder once.

``settled`` writes the one table that a computation comes to and deletes what it
needed on the way; all else goes with ``release()``.
"""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_written: list[tuple[SparkSession, str]] = []
_shipped: list[Broadcast] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="folioflow-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once and return a reader of the written table."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/folioflow-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of few megabytes, so that workers hold little, unless the
    session asks for even less."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    asked = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name, "64m"))
    if asked > BATCH_BYTES:
        spark.conf.set(name, BATCH_BYTES)


def ship(spark: SparkSession, value: object) -> Broadcast:
    """A broadcast of a value of bounded size."""
    _shipped.append(spark.sparkContext.broadcast(value))
    return _shipped[-1]


def give_back() -> None:
    """Return freed memory of this process to the system.  The C allocator keeps
    what lies between blocks that are still in use; other allocators than glibc's
    have no such call."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def _delete(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is None:  # stopped
        return
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def settled(build: Callable[[], DataFrame], tag: str) -> DataFrame:
    """Write the table that ``build`` returns; other tables written and values
    shipped on the way are gone afterwards."""
    tables, values, kept = len(_written), len(_shipped), []
    try:
        result = materialize(build(), tag)
        kept.append(_written.pop())
    finally:
        while len(_shipped) > values:
            _shipped.pop().unpersist()
        while len(_written) > tables:
            _delete(*_written.pop())
        _written.extend(kept)
    return result


def release() -> None:
    """Unpersist and delete everything made here in this process."""
    while _shipped:
        _shipped.pop()
    while _written:
        _delete(*_written.pop())


atexit.register(release)


def row_key(docs: DataFrame) -> list[Column]:
    """Three columns that tell rows apart by all their columns, nulls included:
    ``__ff_id``, ``__ff_no`` and a 64-bit hash ``__ff_key`` of the row."""
    parts = []
    for name, kind in docs.dtypes:
        own = F.col(f"`{name}`")
        parts += [own.isNull(), F.to_json(own) if "map<" in kind or kind == "variant" else own]
    return [F.coalesce("doc_id", F.lit(0)).alias("__ff_id"), F.col("doc_id").isNull().alias("__ff_no"), F.xxhash64(*parts).alias("__ff_key")]


KEYS = ["__ff_id", "__ff_no", "__ff_key"]


def in_order(df: DataFrame, order: list, tag: str, partitions: int | None = None) -> DataFrame:
    """``df`` written in a global order: ``__ff_p`` numbers its range partitions
    and ``__ff_at`` its places, both rising with the order."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("__ff_at", F.monotonically_increasing_id())
    return materialize(ranged, tag).withColumn("__ff_p", F.shiftright("__ff_at", 33))


def offsets(ordered: DataFrame, **sums: Column) -> DataFrame:
    """Per range partition of ``in_order``: what each sum comes to before it
    (``name``) and over all (``name_all``): a row for each partition."""
    counts = ordered.groupBy("__ff_p").agg(*[F.sum(c).alias(k) for k, c in sums.items()])
    earlier = Window.orderBy("__ff_p").rowsBetween(Window.unboundedPreceding, -1)
    before = [F.coalesce(F.sum(k).over(earlier), F.lit(0)).alias(k) for k in sums]
    return counts.select("__ff_p", *before, *[F.sum(k).over(Window.partitionBy()).alias(f"{k}_all") for k in sums])
