"""Words of many texts at once, as positions in one byte buffer.

Arrow hands a task the texts of a batch in one buffer. The functions here find words and
their hashes in that buffer with whole-array operations, so that no Python object is made
per word. Hashes only choose buckets and candidates; equality is always decided on bytes
by the operators.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Separators of plain words: space and U+0009 to U+000D.
BLANKS = np.zeros(256, bool)
BLANKS[[0x20, *range(0x09, 0x0E)]] = True

_BASE = 0x9E3779B97F4A7C15
_STEPS = 4096


@cache
def _powers() -> np.ndarray:
    """Powers of an odd base modulo 2**64, by position in the word."""
    out = np.empty(_STEPS, np.uint64)
    value = 1
    for i in range(_STEPS):
        out[i] = value
        value = value * _BASE & 0xFFFFFFFFFFFFFFFF
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def give_back() -> None:
    """Return memory that Arrow and the C library keep for reuse: the process lives on and serves
    other operators, next to the JVM, within one executor's limit."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def small(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that Python objects are made for few at a time."""
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its rows; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def blocks(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each; a longer text is a range of its own."""
    row, n = 0, len(offsets) - 1
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(max(end, row + 1), n)
        yield row, end
        row = end


class Words:
    """Words of a block of texts.

    ``start`` and ``end`` are byte positions in the block, ``doc`` the row of each word,
    ``first`` the number of the first word of each row (one more entry than rows).
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, blank: np.ndarray = BLANKS):
        inside = ~blank[data]
        self.data, self.offsets, self.inside = data, offsets, inside
        cut = np.zeros(len(data) + 1, bool)
        cut[offsets] = True
        before = np.empty_like(inside)
        before[:1] = False
        before[1:] = inside[:-1]
        after = np.empty_like(inside)
        after[-1:] = False
        after[:-1] = inside[1:]
        self.start = np.flatnonzero(inside & (~before | cut[:-1]))
        self.end = np.flatnonzero(inside & (~after | cut[1:])) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        lo = self.start[0]
        at = np.zeros(len(self.data), np.int64)
        at[self.start[1:]] = np.diff(self.start)
        at = np.arange(len(self.data)) - lo - np.cumsum(at)
        terms = (self.data.astype(np.uint64) + np.uint64(1)) * _powers()[at & (_STEPS - 1)]
        terms[~self.inside] = 0
        return mix(np.add.reduceat(terms, self.start) + (self.end - self.start).astype(np.uint64))

    def room(self, n: int) -> np.ndarray:
        """For each word: do ``n`` words of its own text start here?"""
        return self.first[self.doc + 1] - np.arange(len(self.start)) >= n


def rolling(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each ``n`` consecutive values, in order; shorter by n - 1."""
    size = max(len(hashes) - n + 1, 0)
    out = np.zeros(size, np.uint64)
    for k in range(n):
        out = out * np.uint64(_BASE) + hashes[k : k + size]
    return mix(out)


def sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    """Minimum of each ``n`` consecutive values; shorter by n - 1."""
    size, span = max(len(x) - n + 1, 0), 1
    if not size:
        return x[:0]
    while span * 2 <= n:
        x = np.minimum(x[: len(x) - span], x[span:])
        span *= 2
    return np.minimum(x[:size], x[n - span : n - span + size])


def gather(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The given byte ranges, one after another."""
    total = int(length.sum())
    if not total:
        return data[:0]
    to = np.cumsum(length) - length
    return data[np.repeat(start - to, length) + np.arange(total)]


def strings(data: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow string or binary column from bytes that lie one after another."""
    at = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=at[1:])
    return pa.Array.from_buffers(
        kind, len(lengths), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(data))]
    )


@cache
def _letters() -> np.ndarray:
    """Which code points belong to a token: letters, digits and combining marks."""
    import unicodedata

    table = np.zeros(0x110000, bool)
    for code in range(0x110000):
        table[code] = unicodedata.category(chr(code))[0] in "LNM"
    return table


_FOLD = 0x110000


def tokens(text: str) -> np.ndarray:
    """Hashes of the case-folded alphanumeric tokens of one text, whole and in order."""
    return token_hashes([text])[0]


def token_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of several texts and the number of the first token of each text.

    A token is a maximal run of letters, digits and marks, lower-cased; everything else
    separates. Spelling, case and punctuation differences of layout therefore vanish.
    """
    folded = [(t or "").lower() for t in texts]
    lengths = np.fromiter(map(len, folded), np.int64, len(folded))
    offsets = np.zeros(len(folded) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    points = np.frombuffer("".join(folded).encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(points):
        return np.zeros(0, np.uint64), np.zeros(len(folded) + 1, np.int64)
    inside = _letters()[points]
    cut = np.zeros(len(points) + 1, bool)
    cut[offsets] = True
    before = np.concatenate([[False], inside[:-1]])
    start = np.flatnonzero(inside & (~before | cut[:-1]))
    first = np.searchsorted(start, offsets)
    if not len(start):
        return np.zeros(0, np.uint64), first
    at = np.zeros(len(points), np.int64)
    at[start[1:]] = np.diff(start)
    at = np.arange(len(points)) - start[0] - np.cumsum(at)
    terms = (points.astype(np.uint64) + np.uint64(1)) * _powers()[at & (_STEPS - 1)]
    terms[~inside] = 0
    return mix(np.add.reduceat(terms, start)), first
