"""Document fingerprints that survive edits: digests of improbable byte windows.

Every 16-byte window of a text has an entropy class. The classes are ranked by how rarely they
occur in the whole corpus. Of each 16 neighbouring windows the rarest becomes a feature; of equally rare
ones a hash of the bytes decides. Their hashes go into a chain of Bloom filters of 2048
bits with at most 160 features each. Two digests are compared by the overlap of their
filters, less what chance explains.

One rule holds for texts of every length: neighbourhoods are cut off at both ends of a text, so that a choice
depends on the bytes around it alone, and parts that two texts share give the same features.

Scale. The class counts are one bounded array a task. Entropies are sums of whole numbers taken
along the text, so a window's class depends on its bytes alone. Everything else is per text, in
memory that follows the longest text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.neighbours import followed, in_slices
from panelforge.llm.words import blocks, flat, mix, sliding_min

WINDOW = 16
NEIGHBOURS = 16
CLASSES = 1001
# Windows of fewer than so many thousandths of the greatest entropy say little and are ranked last.
LEAST_CLASS = 100
FILTER_BITS = 2048
FILTER_FEATURES = 160
HASHES = 5
# Overlap counts from so much of the way between chance and complete.
CUTOFF = 0.3

_BLOCK = 256 << 10
_STRIP = 32 << 10
_SCALE = 4096
_counts = np.arange(WINDOW + 1, dtype=np.float64)
_terms = np.round(_SCALE * _counts * np.log2(np.maximum(_counts, 1))).astype(np.int64)
_GAIN = np.diff(_terms).astype(np.int32)
_TOP = int(_terms[WINDOW])
_BASE = 0x9E3779B97F4A7C15
# Zero bytes around each text, so that neighbouring texts of a block do not meet.
_BEFORE, _AFTER, _LEAST = NEIGHBOURS - 1, NEIGHBOURS - 1, 2 * NEIGHBOURS + WINDOW - 2


def _same_nearby(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often each byte occurs among the 15 before it and the 15 after it."""
    n, reach = len(data), WINDOW - 1
    before, after = np.empty(n, np.uint8), np.empty(n, np.uint8)
    for lo in range(0, n, _STRIP):
        hi = min(lo + _STRIP, n)
        left, right = max(lo - reach, 0), min(hi + reach, n)
        strip = data[left:right]
        back, ahead = np.zeros(right - left, np.uint8), np.zeros(right - left, np.uint8)
        same = np.empty(right - left, np.uint8)
        for k in range(1, min(WINDOW, right - left)):
            hit = np.equal(strip[k:], strip[:-k], out=same[k:].view(bool)).view(np.uint8)
            np.add(back[k:], hit, out=back[k:])
            np.add(ahead[:-k], hit, out=ahead[:-k])
        before[lo:hi] = back[lo - left : hi - left]
        after[lo:hi] = ahead[lo - left : hi - left]
    return before, after


def entropy_classes(data: np.ndarray) -> np.ndarray:
    """Entropy of each ``WINDOW`` bytes, from 0 (one value) to 1000 (all different)."""
    n = len(data)
    if n < WINDOW:
        return np.zeros(0, np.int32)
    before, after = _same_nearby(data)
    step = _GAIN[before]
    step[WINDOW:] -= _GAIN[after[:-WINDOW]]
    total = np.cumsum(step, dtype=np.int32)[WINDOW - 1 :]
    return 1000 - total * np.int32(1000) // np.int32(_TOP)


def class_counts(docs: DataFrame) -> np.ndarray:
    """How many windows of all texts are in each entropy class."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(CLASSES, np.int64)
        for batch in batches:
            data, offsets = flat(batch.column(0))
            for i, j in blocks(offsets, _BLOCK):
                part, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                classes = entropy_classes(part)
                seen += np.bincount(classes[_inside(at, len(classes), WINDOW)], minlength=CLASSES)
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(seen[some])], ["class", "n"])

    counts = np.zeros(CLASSES, np.int64)
    found = docs.select("text").mapInArrow(count, "class long, n long")
    for r in found.groupBy("class").agg(F.sum("n").alias("n")).collect():
        counts[r["class"]] = r["n"]
    return counts


def rarity(counts: np.ndarray) -> np.ndarray:
    """Rank of each entropy class, rarest first; classes too poor to tell texts apart come last."""
    order = np.lexsort((np.arange(CLASSES), counts, np.arange(CLASSES) < LEAST_CLASS))
    ranks = np.empty(CLASSES, np.int64)
    ranks[order] = np.arange(CLASSES)
    return ranks


def _inside(offsets: np.ndarray, n: int, width: int) -> np.ndarray:
    """Of n positions: do ``width`` bytes of one text start there?"""
    edge = np.zeros(n + 1, np.int8)
    lo, hi = np.minimum(offsets[:-1], n), np.minimum(np.maximum(offsets[1:] - width + 1, offsets[:-1]), n)
    some = lo < hi
    edge[lo[some]] += 1
    edge[hi[some]] -= 1
    return np.cumsum(edge[:n], dtype=np.int8).view(bool)


def _window_codes(data: np.ndarray) -> np.ndarray:
    """A polynomial in the bytes of each window, by doubling."""
    code, width, base = data.astype(np.uint64) + np.uint64(1), 1, _BASE
    while width < WINDOW:
        code = code[:-width] * np.uint64(base) + code[width:]
        width, base = 2 * width, base * base % (1 << 64)
    return code


def _padded(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts with zero bytes around each of them, and where each begins."""
    parts = [b"\0" * _BEFORE + r + b"\0" * max(_AFTER, _LEAST - _BEFORE - len(r)) if r else b"" for r in raw]
    offsets = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    return np.frombuffer(b"".join(parts), np.uint8), offsets


def _features(data: np.ndarray, offsets: np.ndarray, sizes: np.ndarray, ranks: np.ndarray):
    """Row and hash of the features of a block of padded texts, in order, each once a text."""
    code, some = _window_codes(data), np.flatnonzero(sizes)
    n = len(code)
    # A text under WINDOW bytes has one window, which ends in zeros.
    edge = np.zeros(n + 1, np.int8)
    edge[offsets[some] + _BEFORE] = 1
    edge[offsets[some] + _BEFORE + np.maximum(sizes[some] - WINDOW + 1, 1)] = -1
    none = np.cumsum(edge[:n], dtype=np.int8) == 0
    # Rank of the class, 20 bits of the window's hash, place.
    key = ranks.astype(np.uint64)[entropy_classes(data)] << np.uint64(52)
    key |= mix(code) >> np.uint64(44) << np.uint64(32)
    key |= np.arange(n, dtype=np.uint64)
    key[none] = ~np.uint64(0)
    least = sliding_min(key, NEIGHBOURS)
    least = least[least != ~np.uint64(0)]
    at = np.unique(least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    row, code = np.searchsorted(offsets, at, "right") - 1, mix(code[at])
    order = np.lexsort((code, row))
    r, c = row[order], code[order]
    first = np.sort(order[np.append(True, (r[1:] != r[:-1]) | (c[1:] != c[:-1]))]) if len(order) else order
    return row[first], code[first]


def digests(texts: list[str], ranks: np.ndarray) -> list[np.ndarray]:
    """The chain of Bloom filters of each text, one row of bytes a filter; none if empty."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.array([len(r) for r in raw], np.int64)
    data, offsets = _padded(raw)
    out: list[np.ndarray] = []
    for i, j in blocks(offsets, _BLOCK):
        at = offsets[i : j + 1] - offsets[i]
        if not at[-1]:
            out += [np.zeros((0, FILTER_BITS // 8), np.uint8)] * (j - i)
            continue
        row, code = _features(data[offsets[i] : offsets[j]], at, sizes[i:j], ranks)
        count = np.bincount(row, minlength=j - i)
        chain = -(-count // FILTER_FEATURES)
        base = np.cumsum(chain) - chain
        nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        filters = np.zeros((int(chain.sum()), FILTER_BITS), bool)
        for k in range(HASHES):
            bit = (code >> np.uint64(11 * k) & np.uint64(FILTER_BITS - 1)).astype(np.int64)
            filters[base[row] + nth // FILTER_FEATURES, bit] = True
        packed = np.packbits(filters, axis=1)
        out += [packed[b : b + c] for b, c in zip(base.tolist(), chain.tolist())]
    return out


def to_text(filters: np.ndarray) -> str:
    """The digest as a string: the filters' bits in hexadecimal, one after another."""
    return filters.tobytes().hex()


def from_text(text: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(text), np.uint8).reshape(-1, FILTER_BITS // 8)


def _ones(packed: np.ndarray) -> np.ndarray:
    return np.bitwise_count(np.ascontiguousarray(packed).view(np.uint64)).sum(axis=-1, dtype=np.int64)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 (no more alike than chance) to 1 (equal). Two empty digests are equal."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if a.shape == b.shape and np.array_equal(a, b):
        return 1.0
    if len(a) > len(b):
        a, b = b, a
    nx, ny = _ones(a), _ones(b)
    common = np.stack([_ones(x & b) for x in a])
    most = np.minimum(nx[:, None], ny)
    chance = nx[:, None] * ny / FILTER_BITS
    floor = chance + CUTOFF * (most - chance)
    score = np.clip((common - floor) / np.maximum(most - floor, 1e-6), 0, 1)
    # How well the filters of the shorter chain are found; both ways if equally long.
    value = (score.max(axis=1) * nx).sum() / nx.sum()
    if len(a) == len(b):
        value = (value + (score.max(axis=0) * ny).sum() / ny.sum()) / 2
    return round(float(value), 6)


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by as many first ones of the next text."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


def fingerprint_edits(docs: DataFrame, slices: int | None = None) -> DataFrame:
    """Fingerprint every text and its edited form, and compare.

    The next document is the one with the next smaller doc_id; after the last comes the first.
    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Null text counts as empty; an empty text has the empty fingerprint, which is like itself
    alone. A text under 16 bytes is one window, filled up with zero bytes. Texts of any length are fingerprinted
    whole, by the same rule. Rows with equal doc_id follow each other by the hash of their texts, rows without
    doc_id come last. A table of one row is its own next. Other columns are not looked at.
    """
    ranks = rarity(class_counts(docs))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in followed(batches):
            for lo in range(0, len(ids) - 1, 512):
                yield compare(ids[lo : lo + 513], texts[lo : lo + 513])

    def compare(ids: list, texts: list[str]) -> pa.RecordBatch:
        changed = [edited(t, f) for t, f in zip(texts, texts[1:])]
        prints, others = digests(texts, ranks), digests(changed, ranks)
        rows = [
            (ids[k], len(texts[k]), hashlib.sha256(changed[k].encode("utf-8", "surrogatepass")).hexdigest(), to_text(prints[k]),
             to_text(others[k]), likeness(prints[k], others[k]), likeness(prints[k], prints[k + 1]))
            for k in range(len(changed)) if ids[k] is not ...
        ]
        columns = list(zip(*rows)) if rows else [[]] * 7
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    return in_slices(docs, slices).mapInArrow(
        work,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )
