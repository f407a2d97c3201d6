"""Removal of repeated word windows behind a count-min prefilter.

A window is ``WINDOW`` consecutive words.  First pass: every partition sketches
its windows and the sketches are merged; the sketch key of a window is its
smallest ``GRAM``-word hash (with the leftmost place), so the six or so windows
around one place count once and an estimate can only exceed a window's count.
Second pass: windows that may be repeated, and no others, are grouped exactly by
a 128-bit hash (two lanes that are independent from the bytes on) in hash-range buckets; every window but the first of its group
(by doc_id, then start) marks its words.  Unrepeated windows never travel.

Windows that repeat inside one Arrow batch are settled there, so a window that
occurs everywhere sends one row per batch.  Buckets follow the corpus size.

Nulls: a null text has no words; a null doc_id comes before all others.  Rows
with the same doc_id are the same document: equal starts are the same place and
neither precedes the other.  Texts shorter than a window lose nothing; a very long
one is one row of windows.  An empty table gives an empty result.  Other columns
play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sketch import Repeated, Repeats, merged, pack, unpack
from .store import bounded_batches, materialize, settled, ship
from .words import Words, document_windows, text_batches, windows

WINDOW = 20
GRAM = 10
BITS = 26
PLACE = np.uint64((1 << 24) - 1)
PER_BUCKET = 4_000_000
ENTRY = np.dtype([("a", "<u8"), ("b", "<u8"), ("doc", "<i8"), ("row", "<u4"), ("pos", "<u4")])
FIRST = np.iinfo(np.int64).min


def _minimizers(words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows, and for each its smallest gram with its place."""
    at = np.flatnonzero(document_windows(words.counts, WINDOW))
    if not len(at):
        return at, np.zeros(0, np.uint64)
    gram = windows(hashes, GRAM)
    gram = (gram & ~PLACE) | (np.arange(len(gram), dtype=np.uint64) & PLACE)
    span, low, width = WINDOW - GRAM + 1, gram, 1
    while 2 * width <= span:
        low = np.minimum(low[: len(low) - width], low[width:])
        width *= 2
    low = np.minimum(low[: len(low) - (span - width)], low[span - width :])
    return at, low[at]


def _runs(low: np.ndarray) -> np.ndarray:
    """Indices where the smallest gram moves on."""
    return np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]])) if len(low) else np.zeros(0, np.int64)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sketch, n = Repeats(BITS), 0
    for whole in batches:
        for batch in text_batches(whole):
            words = Words(batch.column("text"))
            at, low = _minimizers(words, words.hashes())
            n += len(at)
            if len(low):
                sketch.add(low[_runs(low)] >> np.uint64(24))
    part = TaskContext.get().partitionId()
    rows = [(part, -1, n, b"")] + ([(part, k, 0, d) for k, d in sketch.slices()] if n else [])
    types = (pa.int32(), pa.int32(), pa.int64(), pa.binary())
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], ["part", "slice", "n", "data"])


def _entries(words: Words, hashes: np.ndarray, ids: np.ndarray, repeated: Repeated) -> tuple[np.ndarray, np.ndarray]:
    """Entries of windows that may be repeated: the first of each kind in this
    batch, and the later ones, which are repeats whatever the rest holds."""
    at, low = _minimizers(words, hashes)
    starts = _runs(low)
    may = np.repeat(repeated(low[starts] >> np.uint64(24)), np.diff(np.append(starts, len(low)))) if len(low) else np.zeros(0, bool)
    at = at[may]
    e = np.empty(len(at), ENTRY)
    e["a"] = windows(hashes, WINDOW)[at] if len(at) else 0
    e["b"] = windows(words.hashes(1), WINDOW)[at] if len(at) else 0
    row = np.searchsorted(words.first, at, "right") - 1
    e["row"], e["pos"], e["doc"] = row, at - words.first[row], ids[row]
    return _split(e)


def _split(e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First entries of each window, and those that come after a first one."""
    e = e[np.lexsort((e["pos"], e["doc"], e["b"], e["a"]))]
    if not len(e):
        return e, e
    new = np.concatenate([[True], (e["a"][1:] != e["a"][:-1]) | (e["b"][1:] != e["b"][:-1])])
    lead = np.maximum.accumulate(np.where(new, np.arange(len(e)), 0))
    later = (e["doc"] != e["doc"][lead]) | (e["pos"] != e["pos"][lead])
    return e[~later], e[later]


def _places(e: np.ndarray) -> bytes:
    e = e[np.lexsort((e["pos"], e["row"]))]
    return pack(np.concatenate([e["row"], e["pos"]]))


_ROWS = "kind int, bucket long, src long, n long, data binary"


def _emit(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    columns = list(zip(*rows, strict=True)) if rows else [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["kind", "bucket", "src", "n", "data"])


ASK, FOUND, TABLE = 0, 1, 2


def _collect(batches: Iterator[pa.RecordBatch], repeated: Repeated, bucket_bits: int) -> Iterator[pa.RecordBatch]:
    part, count = TaskContext.get().partitionId(), 0
    for whole in batches:
        for batch in text_batches(whole):
            src = part << 32 | count
            count += 1
            words = Words(batch.column("text"))
            ids = pc.fill_null(batch.column("id"), FIRST).to_numpy(zero_copy_only=False)
            first, later = _entries(words, words.hashes(), ids, repeated)
            if not len(first):
                continue
            table = np.concatenate([ids, batch.column("key").to_numpy(zero_copy_only=False)])
            rows = [(TABLE, src, src, len(ids), pack(table))]
            if len(later):
                rows.append((FOUND, src, src, len(later), _places(later)))
            bucket = (first["a"] >> np.uint64(64 - bucket_bits)).astype(np.int64) if bucket_bits else np.zeros(len(first), np.int64)
            cut = np.flatnonzero(np.diff(bucket)) + 1  # entries are in order of "a"
            for group in np.split(first, cut):
                k = int(group["a"][0] >> np.uint64(64 - bucket_bits)) if bucket_bits else 0
                group = group[np.lexsort((group["pos"], group["row"]))]
                rows.append((ASK, k, src, len(group), pack(np.frombuffer(b"".join(group[c].tobytes() for c in ENTRY.names), np.uint8))))
            yield _emit(rows)


def _answer(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Settle one bucket: which of the asked windows come after another."""
    if key[0] != ASK:
        return rows
    parts, sources = [], []
    for src, n, data in zip(rows["src"], rows["n"], rows["data"], strict=True):
        raw, e, at = unpack(data, np.uint8, n * ENTRY.itemsize), np.empty(n, ENTRY), 0
        for c in ENTRY.names:
            size = n * ENTRY[c].itemsize
            e[c] = np.frombuffer(raw[at : at + size].tobytes(), ENTRY[c])
            at += size
        parts.append(e)
        sources.append(np.full(n, src, np.int64))
    e, src = np.concatenate(parts), np.concatenate(sources)
    wide = np.empty(len(e), [*[(c, ENTRY[c]) for c in ENTRY.names], ("src", "<i8")])
    for c in ENTRY.names:
        wide[c] = e[c]
    wide["src"] = src
    _, later = _split(wide)
    later = later[np.argsort(later["src"], kind="stable")]
    out = [(FOUND, int(g["src"][0]), int(g["src"][0]), len(g), _places(g)) for g in np.split(later, np.flatnonzero(np.diff(later["src"])) + 1) if len(g)]
    return pd.DataFrame(out, columns=["kind", "bucket", "src", "n", "data"])


def _gather(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """For one batch: the repeated window starts of each of its documents."""
    table = rows[rows["kind"] == TABLE].iloc[0]
    both = unpack(table["data"], np.int64, 2 * table["n"])
    ids, keys = both[: table["n"]], both[table["n"] :]
    found = [unpack(d, np.uint32, 2 * n).reshape(2, n) for k, n, d in zip(rows["kind"], rows["n"], rows["data"], strict=True) if k == FOUND]
    if not found:
        return pd.DataFrame({"id": [], "key": [], "starts": []})
    row, pos = np.concatenate(found, axis=1)
    order = np.lexsort((pos, row))
    row, pos = row[order], pos[order]
    groups = np.split(pos, np.flatnonzero(np.diff(row)) + 1)
    at = row[np.concatenate([[0], np.flatnonzero(np.diff(row)) + 1])]
    return pd.DataFrame({"id": ids[at], "key": keys[at], "starts": [g.astype("<u4").tobytes() for g in groups]})


def covered(n: int, starts: np.ndarray, size: int = WINDOW) -> np.ndarray:
    """Which of ``n`` words lie in a window that starts at one of ``starts``."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + size, -1)
    return np.cumsum(edge[:-1]) > 0


def repeated_starts(docs: DataFrame) -> DataFrame:
    """id, key, starts: for documents with repeated windows, where they start
    (packed 32-bit).  ``docs`` has id, key and text."""
    partials = materialize(docs.select("text").mapInArrow(_sketch, "part int, slice int, n long, data binary"), "windows")
    n = partials.agg(F.sum("n")).first()[0] or 0
    repeated = Repeated(merged(partials.where("slice >= 0").drop("n"), Repeats), BITS)
    spark = docs.sparkSession
    shipped = ship(spark, repeated)
    bits = max(int(spark.conf.get("spark.sql.shuffle.partitions")) - 1, n // PER_BUCKET).bit_length()
    asked = docs.select("id", "key", "text").mapInArrow(lambda it: _collect(it, shipped.value, bits), _ROWS)
    answered = asked.groupBy("kind", "bucket").applyInPandas(_answer, _ROWS)
    return answered.groupBy("src").applyInPandas(_gather, "id long, key long, starts binary")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words, removed, shas = [], [], []
        for text, starts in zip(batch.column("text").to_pylist(), batch.column("starts").to_pylist(), strict=True):
            own = (text or "").encode("utf-8", "surrogatepass").split()
            words.append(len(own))
            if starts:
                gone = covered(len(own), np.frombuffer(starts, "<u4").astype(np.int64))
                removed.append(int(gone.sum()))
                own = [own[i] for i in np.flatnonzero(~gone)]
            else:
                removed.append(0)
            shas.append(hashlib.sha256(b" ".join(own)).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(words, pa.int64()), pa.array(removed, pa.int64()), pa.array(shas, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for text, starts in zip(batch.column("text").to_pylist(), batch.column("starts").to_pylist(), strict=True):
            if starts:
                own = text.encode("utf-8", "surrogatepass").split()
                gone = covered(len(own), np.frombuffer(starts, "<u4").astype(np.int64))
                text = b" ".join(own[i] for i in np.flatnonzero(~gone)).decode("utf-8", "surrogatepass")
            texts.append(text)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])


def _marked(docs: DataFrame) -> DataFrame:
    bounded_batches(docs.sparkSession)
    keyed = docs.select("doc_id", "text", F.col("doc_id").alias("id"), F.xxhash64(F.col("doc_id").isNull(), "text").alias("key"))
    starts = settled(lambda: repeated_starts(keyed.select("id", "key", "text")).dropDuplicates(["id", "key"]), "starts")
    keyed = keyed.withColumn("id", F.coalesce("id", F.lit(FIRST)))
    return keyed.join(starts, ["id", "key"], "left").select("doc_id", "text", "starts")


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id and the text left; texts that lose words are joined by spaces."""
    return _marked(docs).mapInArrow(_rewrite, "doc_id long, text string")


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every document."""
    return _marked(docs).mapInArrow(_digest, "doc_id long, n_words long, n_removed long, kept_sha256 string")
