"""Vectorised words, word hashes and window hashes over Arrow text batches.

A word is a run of bytes other than 0x20 and 0x09-0x0D; these bytes never
occur inside a UTF-8 sequence, so scanning bytes is the same as scanning code
points with ``[^\\x20\\x09-\\x0D]+``.  Everything works on whole batches and
in pieces of bounded size, so one very long text costs 8 bytes per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, element by element."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: One start and one odd factor for each lane; lanes share nothing from the bytes on.
_LANES = ((np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)), (np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xA0761D6478BD642F)))
_LONG = 64
_TAIL = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


def text_batches(batch: pa.RecordBatch, column: str = "text", limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of text, one row at least."""
    sizes = np.diff(np.frombuffer(offsets(batch.column(column)), np.int64)) if batch.num_rows else np.zeros(0, np.int64)
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(size)
    if start < batch.num_rows:
        yield batch.slice(start)


def offsets(texts: pa.Array) -> np.ndarray:
    """Byte offsets (int64, n + 1) of a string array; nulls are empty."""
    kind = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    buffer = texts.buffers()[1]
    if buffer is None:
        return np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(buffer, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)


class Words:
    """Words of a string array: ``starts``/``ends`` are byte positions in
    ``data``; document ``i`` has the words ``first[i]`` to ``first[i + 1]``."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        if texts.null_count:
            texts = texts.fill_null("")
        at = offsets(texts)
        buffer = texts.buffers()[2]
        data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
        self.data = data[at[0] : at[-1]]
        at = at - at[0]
        self.bounds = at
        if lower:
            self.data = _LOWER[self.data]
        n = len(self.data)
        inside = ~_SPACE[self.data]
        edge = np.zeros(n + 1, bool)
        edge[at] = True
        before = np.empty(n, bool)
        after = np.empty(n, bool)
        if n:
            before[0] = after[-1] = False
            before[1:], after[:-1] = inside[:-1], inside[1:]
        self.starts = np.flatnonzero(inside & (~before | edge[:-1]))
        self.ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.starts, at)
        self.counts = np.diff(self.first)

    def hashes(self, lane: int = 0) -> np.ndarray:
        """A 64-bit hash of every word; lanes are independent."""
        return span_hashes(self.data, self.starts, self.ends, lane)

    def sums(self, table: np.ndarray) -> np.ndarray:
        """Per document, the sum of ``table[byte]`` over its bytes."""
        total = np.concatenate([[0], np.cumsum(table[self.data], dtype=np.int64)])
        return total[self.bounds[1:]] - total[self.bounds[:-1]]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lane: int = 0) -> np.ndarray:
    """A 64-bit hash of every span of bytes, wherever it stands.

    Eight bytes a step go through ``mix``, which has no algebraic structure that
    texts could follow; spans of over ``_LONG`` bytes are hashed by BLAKE2."""
    start, factor = _LANES[lane]
    out = np.empty(len(starts), np.uint64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    for i in range(0, len(out), PIECE):
        s, n = starts[i : i + PIECE], ends[i : i + PIECE] - starts[i : i + PIECE]
        h = mix(n.astype(np.uint64) * factor + start)
        left = np.flatnonzero(n <= _LONG)
        for step in range(0, _LONG, 8):
            left = left[n[left] > step]
            if not len(left):
                break
            chunk = eight[s[left] + step] & _TAIL[np.minimum(n[left] - step, 8)]
            h[left] = mix((h[left] ^ chunk) * factor + start)
        for k in np.flatnonzero(n > _LONG):
            digest = blake2b(data[s[k] : s[k] + n[k]].tobytes(), digest_size=8, salt=bytes([lane])).digest()
            h[k] = np.frombuffer(digest, "<u8")[0]
        out[i : i + PIECE] = h
    return out


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * np.uint64(0xE7037ED1A0B428DB) + b + np.uint64(0x8EBC6AF09C88C6E3))


def windows(words: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every run of ``size`` words, joined from runs of powers
    of two.  Windows of another lane's words are independent."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    run, width, out, done = words, 1, None, 0
    while True:
        if size & width:
            own = run[done : done + n]
            out = own if out is None else _joined(out, own)
            done += width
        if done == size:
            return mix(out + np.uint64(size)) if size == 1 else out
        run = _joined(run[:-width], run[width:])
        width *= 2


def document_windows(counts: np.ndarray, size: int) -> np.ndarray:
    """Which window starts (of a batch's words) lie inside one document."""
    total = int(counts.sum())
    if total < size:
        return np.zeros(0, bool)
    left = np.repeat(np.cumsum(counts), counts) - np.arange(total)
    return left[: total - size + 1] >= size
