"""Progress, checkpoints and health over event streams.

Sinks are idempotent: a batch's rows carry its id and replace what an earlier try
of the same batch wrote, so at-least-once delivery ends in exactly-once state.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType


def read_events(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 1) -> DataFrame:
    folder, _, name = path.rstrip("/").rpartition("/")
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    # a stream source is a folder: one file of it is named by a filter
    rows = source.option("pathGlobFilter", name).parquet(folder) if name.endswith(".parquet") else source.parquet(path)
    return rows.withColumns({f.name: F.col(f.name).cast("timestamp") for f in schema.fields if f.dataType.typeName() == "timestamp_ntz"})


def windowed_counts(events: DataFrame, at: str, key: str, length: str, late: str) -> DataFrame:
    """Events per key and window; rows later than the watermark are dropped."""
    return events.withWatermark(at, late).groupBy(F.window(at, length), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), key, "n")


def idempotent_append(path: str):
    """A foreachBatch writer: one folder per batch id, overwritten on a retry."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{path}/batch={batch_id:08d}")

    return write


def run_available(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Process everything that is there, then stop; resumes at the checkpoint."""
    q = stream.writeStream.foreachBatch(idempotent_append(path)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def health_of(idle_seconds: Column, errors: Column, warn: int = 300, stall: int = 600, most_errors: int = 10) -> Column:
    """Stalled before warning before error; never active is healthy."""
    return F.when(idle_seconds > stall, "stalled").when(idle_seconds > warn, "warning").when(errors >= most_errors, "error").otherwise("healthy")


def _track(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Last activity and errors in a row per worker."""
    last, errors, n = state.get if state.exists else (None, 0, 0)
    for frame in frames:
        for row in frame.sort_values(["at", "seq"]).itertuples():
            n += 1
            errors = errors + 1 if row.kind == "error" else 0
            last = row.at if last is None or row.at > last else last
    state.update((last, errors, n))
    yield pd.DataFrame([[key[0], last, errors, n]], columns=["worker", "last", "errors", "n"])


def heartbeats(events: DataFrame) -> DataFrame:
    """worker, last, errors (in a row) and n after each batch, from (worker, at,
    seq, kind)."""
    out = "worker bigint, last timestamp, errors bigint, n bigint"
    return events.groupBy("worker").applyInPandasWithState(_track, out, "last timestamp, errors bigint, n bigint", "update", GroupStateTimeout.NoTimeout)


def resume_after(work: DataFrame, doc: str, page: str, last_doc: str | None, last_page: int | None) -> DataFrame:
    """Work from the cursor on: later documents, later pages of the same one; a
    cursor without a page repeats its document (at least once)."""
    if last_doc is None:
        return work
    same = (F.col(doc) == last_doc) & (F.lit(True) if last_page is None else F.col(page) > last_page)
    return work.where((F.col(doc) > last_doc) | same)


def checkpoint_states(log: DataFrame) -> DataFrame:
    """Latest state of each (stage, batch) of a log of (stage, batch_id, seq,
    action, done, total): paused or failed ones can be resumed."""
    state = F.when(F.col("action") == "complete", "completed").when(F.col("action") == "fail", "failed").when(F.col("action") == "pause", "paused").otherwise("running")
    last = log.groupBy("stage", "batch_id").agg(F.max_by(F.struct(state.alias("state"), "done", "total"), "seq").alias("x"))
    return last.select("stage", "batch_id", "x.*", F.col("x.state").isin("paused", "failed").alias("resumable"), F.coalesce(F.try_divide(F.col("x.done") * 100.0, F.col("x.total")), F.lit(0.0)).alias("pct"))


def rotation(progress: DataFrame, threshold: float = 95.0) -> DataFrame:
    """Which kind to work on next: the first in order below the threshold."""
    return progress.where(F.col("pct") < threshold).agg(F.min_by("kind", "ordinal").alias("next_kind"))


def recoveries(beats: DataFrame, worker: str, at: str, stall: int = 600, most: int = 3) -> DataFrame:
    """worker, at, idle, attempt and action of each stall (no beat for more than
    ``stall`` seconds before ``at``): the first ``most`` are recovered, later ones
    need a person."""
    w = Window.partitionBy(worker).orderBy(at)
    idle = (F.unix_micros(at) - F.unix_micros(F.lag(at).over(w))) / 1e6
    stalls = beats.select(worker, at, idle.alias("idle")).where(F.col("idle") > stall)
    stalls = stalls.withColumn("attempt", F.row_number().over(w))
    return stalls.withColumn("action", F.when(F.col("attempt") <= most, "recover").otherwise("manual"))


def watchdog(polls: DataFrame, key: str, at: str, count: str, threshold: int = 2) -> DataFrame:
    """key, at, delta, stalled and restart per poll: a poll without progress is a
    stall, and every ``threshold``-th stall in a row asks for a restart."""
    w = Window.partitionBy(key).orderBy(at)
    delta = F.coalesce(F.col(count) - F.lag(count).over(w), F.col(count))
    moved = polls.withColumn("delta", delta).withColumn("__run", F.sum((F.col("delta") > 0).cast("int")).over(w))
    inside = Window.partitionBy(key, "__run").orderBy(at)
    stalled = F.sum((F.col("delta") <= 0).cast("int")).over(inside).cast("int")
    return moved.select(key, at, "delta", stalled.alias("stalled")).withColumn("restart", (F.col("delta") <= 0) & (F.col("stalled") % threshold == 0))


def claims(asked: DataFrame, key: str, worker: str, at: str, free: Column) -> DataFrame:
    """key, worker: who gets each item that is still free.  The first to ask wins,
    whatever the order in which claims arrive, so a repeated claim changes nothing."""
    return asked.where(free).groupBy(key).agg(F.min_by(worker, F.struct(at, worker)).alias(worker))


def random_order(work: DataFrame, key: str, workers: int, seed: int) -> DataFrame:
    """work with ``worker`` and ``turn``: a seeded random order in which workers
    claim items, without one task that sorts all of them."""
    turn = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")).cast("binary"))
    return work.withColumn("turn", turn).withColumn("worker", (F.conv(F.substring("turn", 1, 8), 16, 10).cast("long") % workers).cast("int"))
