"""Count-min sketches built per partition and merged by aggregation.

A sketch has ``ROWS`` rows of ``2**bits`` cells.  Each partition fills its own;
the partial sketches travel as compressed slices and are merged in a tree of
fan-in 64, so no task holds more than 64 slices and the driver receives one
sketch of a fixed size, whatever the corpus.  An estimate is the minimum over
the rows and never below the true count.

Two kinds: ``Repeats`` keeps 2-bit counters that stop at 2 (all that "is it
repeated?" needs); ``Counts`` keeps counts.  Deterministic: merging is exact and
commutative, so partitioning and retries do not change a sketch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import mix

ROWS = 2
SLICE_BITS = 17
FAN_IN_BITS = 6
_SEEDS = tuple(np.uint64(s) for s in (0x8BB84B93962EACC9, 0x2D358DCCAA6C78A5))


def cells(keys: np.ndarray, row: int, bits: int) -> np.ndarray:
    return (mix(keys ^ _SEEDS[row]) >> np.uint64(64 - bits)).astype(np.int64)


def pack(a: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(a).tobytes(), codec="zstd", asbytes=True)


def unpack(data: bytes, dtype, count: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, count * np.dtype(dtype).itemsize, codec="zstd", asbytes=True), dtype)


def _bit(bitmap: np.ndarray, cell: np.ndarray) -> np.ndarray:
    return (bitmap[cell >> 3] >> (cell & 7).astype(np.uint8)) & np.uint8(1)


def _set(bitmap: np.ndarray, cell: np.ndarray) -> None:
    np.bitwise_or.at(bitmap, cell >> 3, np.uint8(1) << (cell & 7).astype(np.uint8))


class Repeats:
    """Counters 0, 1 and "2 or more" as two bitmaps a row."""

    def __init__(self, bits: int):
        self.bits = bits
        self.maps = np.zeros((ROWS, 2, 1 << (bits - 3)), np.uint8)

    def add(self, keys: np.ndarray) -> None:
        for row in range(ROWS):
            once, twice = self.maps[row]
            cell, counts = np.unique(cells(keys, row, self.bits), return_counts=True)
            _set(twice, cell[(counts > 1) | (_bit(once, cell) > 0)])
            _set(once, cell)

    def slices(self) -> Iterator[tuple[int, bytes]]:
        width = 1 << max(SLICE_BITS - 3, 0)
        per_row = self.maps.shape[2] // width
        for row in range(ROWS):
            for k in range(per_row):
                part = self.maps[row, :, k * width : (k + 1) * width]
                if part[0].any():
                    yield row * per_row + k, pack(part)

    @staticmethod
    def merge(parts: Iterator[bytes]) -> bytes:
        width = 1 << (SLICE_BITS - 3)
        total = np.zeros((2, width), np.uint8)
        for data in parts:
            part = unpack(data, np.uint8, 2 * width).reshape(2, width)
            total[1] |= part[1] | (total[0] & part[0])
            total[0] |= part[0]
        return pack(total)


class Counts:
    """Plain counters."""

    def __init__(self, bits: int):
        self.bits = bits
        self.counts = np.zeros((ROWS, 1 << bits), np.uint32)

    def add(self, keys: np.ndarray) -> None:
        for row in range(ROWS):
            self.counts[row] += np.bincount(cells(keys, row, self.bits), minlength=1 << self.bits).astype(np.uint32)

    def slices(self) -> Iterator[tuple[int, bytes]]:
        width = 1 << SLICE_BITS
        per_row = self.counts.shape[1] // width
        for row in range(ROWS):
            for k in range(per_row):
                part = self.counts[row, k * width : (k + 1) * width]
                if part.any():
                    yield row * per_row + k, pack(part.astype(np.uint64))

    @staticmethod
    def merge(parts: Iterator[bytes]) -> bytes:
        width = 1 << SLICE_BITS
        total = np.zeros(width, np.uint64)
        for data in parts:
            total += unpack(data, np.uint64, width)
        return pack(total)


def merged(partials: DataFrame, kind: type) -> dict[int, bytes]:
    """Slices of the whole sketch from rows (part int, slice int, data binary)."""

    def join(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": [key[1]], "slice": [key[0]], "data": [kind.merge(iter(rows["data"]))]})

    last = partials.agg(F.max("part")).first()[0] or 0
    while True:
        partials = partials.groupBy("slice", F.shiftright("part", FAN_IN_BITS).alias("up")).applyInPandas(join, "part int, slice int, data binary")
        last >>= FAN_IN_BITS
        if not last:
            break
    return {int(r["slice"]): bytes(r["data"]) for r in partials.select("slice", "data").collect()}


class Repeated:
    """The finished filter: which keys may occur twice (never a false no)."""

    def __init__(self, slices: dict[int, bytes], bits: int):
        width = 1 << (SLICE_BITS - 3)
        self.bits = bits
        self.twice = np.zeros((ROWS, 1 << (bits - 3)), np.uint8)
        flat = self.twice.reshape(-1, width)
        for k, data in slices.items():
            flat[k] = unpack(data, np.uint8, 2 * width)[width:]

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for row in range(ROWS):
            out &= _bit(self.twice[row], cells(keys, row, self.bits)) > 0
        return out


class Estimates:
    """The finished counts in eighths of a power of two, a byte each."""

    def __init__(self, slices: dict[int, bytes], bits: int):
        width = 1 << SLICE_BITS
        self.bits = bits
        self.codes = np.zeros((ROWS, 1 << bits), np.uint8)
        flat = self.codes.reshape(-1, width)
        for k, data in slices.items():
            flat[k] = np.round(8 * np.log2(unpack(data, np.uint64, width).astype(float) + 1))

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Codes of the estimates: ``8 * log2(count + 1)``."""
        return np.minimum(*[self.codes[row][cells(keys, row, self.bits)] for row in range(ROWS)])
