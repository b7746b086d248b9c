"""Finding benchmark items in documents, also when their parts are reordered.

Greedy string tiling. Seeds, runs of ``least`` tokens, of all items are looked up in every
document. A pair of document and item whose shared seeds could cover the wanted part of the item is
tiled: running Karp-Rabin finds common substrings from long to short, the longest are marked
first, marked tokens are not used again, and the marked part of the item is its coverage. As
tiles need not keep the item's order, rearranged passages count in full.

Scale. Documents are read once per block of items and never shuffled. A block holds at most
``block_tokens`` characters of items, so what is broadcast has a fixed bound; a larger benchmark is
worked through in blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.llm.words import blocks, give_back, rolling, token_hashes

LEAST = 4
COVERAGE = 0.5
BLOCK_CHARS = 32 << 20

_DOCS = 256
# Bytes of text that are searched at once.
_SLICE = 1 << 20
_BITS = 22


def tile(item: list[int], text: list[int], least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling by running Karp-Rabin: (place in item, place in text, length).

    ``None`` in ``text`` matches nothing. Longer tiles are marked first; of equally long ones the first in
    the item, then in the text.
    """
    free_item, free_text = [True] * len(item), [t is not None for t in text]
    tiles: list[tuple[int, int, int]] = []
    length = max(min(len(item), len(text)), least)
    while length >= least:
        found = _matches(item, text, free_item, free_text, length)
        longest = max((n for _, _, n in found), default=0)
        if longest > 2 * length:
            length = longest
            continue
        for i, t, n in sorted(found, key=lambda m: (-m[2], m[0], m[1])):
            if all(free_item[i : i + n]) and all(free_text[t : t + n]):
                free_item[i : i + n] = free_text[t : t + n] = [False] * n
                tiles.append((i, t, n))
        # Matches cut short by a longer tile are found again at the next, smaller length.
        length = length // 2 if length >= 2 * least else least if length > least else 0
    return tiles


def _matches(item, text, free_item, free_text, length):
    """Maximal common unmarked substrings of at least ``length`` tokens."""
    places: dict[int, list[int]] = {}
    for t, code in _codes(text, free_text, length):
        places.setdefault(code, []).append(t)
    out = []
    for i, code in _codes(item, free_item, length):
        for t in places.get(code, ()):
            if i and t and free_item[i - 1] and free_text[t - 1] and item[i - 1] == text[t - 1]:
                continue  # part of the match that starts one token earlier
            n = 0
            while (
                i + n < len(item) and t + n < len(text) and free_item[i + n] and free_text[t + n]
                and item[i + n] == text[t + n]
            ):
                n += 1
            if n >= length:
                out.append((i, t, n))
    return out


_MOD = (1 << 61) - 1
_RADIX = 1_000_003


def _codes(tokens, free, length):
    """Rolling hash of each run of ``length`` unmarked tokens."""
    top = pow(_RADIX, length - 1, _MOD)
    code = run = 0
    for i, token in enumerate(tokens):
        if not free[i]:
            code = run = 0
            continue
        if run == length:
            code = (code - tokens[i - length] * top) % _MOD
        else:
            run += 1
        code = (code * _RADIX + token) % _MOD
        if run == length:
            yield i - length + 1, code


class _Index:
    """Seeds of a block of items."""

    def __init__(self, items: list[tuple], least: int):
        self.ids = [i for i, _ in items]
        codes, first = token_hashes([t for _, t in items])
        self.tokens = [codes[a:b].tolist() for a, b in zip(first[:-1], first[1:])]
        self.sizes = np.diff(first)
        # Items shorter than a seed are sought whole, with a seed of their own size.
        self.seeds = {}
        for k in sorted({min(least, n) for n in self.sizes.tolist() if n}):
            rows = [
                (code, item, at)
                for item, (a, n) in enumerate(zip(first[:-1].tolist(), self.sizes.tolist()))
                if n and min(least, n) == k
                for at, code in enumerate(rolling(codes[a : a + n], k).tolist())
            ]
            rows.sort()
            code = np.array([r[0] for r in rows], np.uint64)
            bits = np.zeros(1 << _BITS, bool)
            bits[code & np.uint64((1 << _BITS) - 1)] = True
            known, begin = np.unique(code, return_index=True)
            post = np.array([r[1:] for r in rows], np.int64)
            self.seeds[k] = (bits, known, np.append(begin, len(rows)), post)

    def found(self, texts: list, coverage: float, least: int) -> Iterator[tuple]:
        """(row, item, covered, tiles, longest) of all pairs that reach ``coverage``."""
        codes, first = token_hashes(texts)
        place = np.arange(len(codes))
        row = np.repeat(np.arange(len(texts)), np.diff(first))
        for k, (bits, known, begin, post) in self.seeds.items():
            rolled = rolling(codes, k)
            at = np.flatnonzero(bits[rolled & np.uint64((1 << _BITS) - 1)])
            at = at[first[row[at] + 1] - place[at] >= k]
            seed = np.searchsorted(known, rolled[at])
            hit = known[np.minimum(seed, len(known) - 1)] == rolled[at]
            at, seed = at[hit], np.minimum(seed, len(known) - 1)[hit]
            count = begin[seed + 1] - begin[seed]
            nth = np.repeat(begin[seed] - (np.cumsum(count) - count), count) + np.arange(count.sum())
            item, spot = post[nth, 0], post[nth, 1]
            where = np.repeat(at, count)
            pair = row[where] * len(self.ids) + item
            # Item tokens under any shared seed: no tiling can cover more.
            spots = np.unique(np.stack([pair, spot], axis=1), axis=0) if len(pair) else np.zeros((0, 2), int)
            reach = np.full(len(spots), k)
            same = spots[1:, 0] == spots[:-1, 0]
            reach[:-1][same] = np.minimum(spots[1:, 1] - spots[:-1, 1], k)[same]
            pairs, start = np.unique(spots[:, 0], return_index=True)
            most = np.add.reduceat(reach, start) if len(start) else reach[:0]
            wanted = pairs[most >= coverage * self.sizes[pairs % len(self.ids)]]
            order = np.argsort(pair, kind="stable")
            lo, hi = np.searchsorted(pair[order], wanted), np.searchsorted(pair[order], wanted, "right")
            for p, a, z in zip(wanted.tolist(), lo.tolist(), hi.tolist()):
                r, i = divmod(p, len(self.ids))
                text = _regions(codes, np.unique(where[order[a:z]]), k)
                tiles = tile(self.tokens[i], text, k)
                covered = sum(n for _, _, n in tiles)
                if covered >= coverage * len(self.tokens[i]):
                    yield r, i, covered, len(tiles), max(n for _, _, n in tiles)


def _regions(codes: np.ndarray, at: np.ndarray, k: int) -> list:
    """The text's tokens under seeds shared with one item, with a gap between regions.

    A tile of at least k tokens consists of shared seeds, so nothing outside can be tiled.
    """
    out: list = []
    end = -1
    for a in at.tolist():
        if a > end:
            out.append(None)
            end = a
        out.extend(codes[end : a + k].tolist())
        end = a + k
    return out


def _blocks(items: DataFrame, block_chars: int) -> Iterator[list[tuple]]:
    """The distinct item texts and their keys, in blocks of bounded size by a hash of the text."""
    rows = items.where("text IS NOT NULL").select(item_key().alias("key"), "text").dropDuplicates(["key"])
    total = rows.agg(F.sum(F.length("text"))).first()[0]
    n = max(1, math.ceil(2 * (total or 0) / block_chars))
    for k in range(n):
        part = rows.where(F.pmod(F.xxhash64("text"), F.lit(n)) == k) if n > 1 else rows
        yield [(r[0], r[1]) for r in part.collect()]


def item_key() -> Column:
    return F.sha2("text", 256)


def _slices(batches: Iterator[pa.RecordBatch], limit: int = _SLICE) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Batches cut so that their texts have at most ``limit`` bytes together, or are one text, with the texts."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index("text"))
        lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        for lo, hi in blocks(np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]), limit):
            for at in range(lo, hi, _DOCS):
                part = batch.slice(at, min(_DOCS, hi - at))
                yield part, texts.slice(at, part.num_rows).to_pylist()


def find_items(
    docs: DataFrame,
    items: DataFrame,
    least: int = LEAST,
    coverage: float = COVERAGE,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """Every pair of a document (doc_id, text) and a benchmark item (item_id, text) it contains.

    A pair is returned if at least ``coverage`` of the item's tokens lie under tiles of ``least`` or more
    tokens: doc_id, item_id, n_tokens (of the item), covered, tiles, longest, coverage.

    Tokens are lower-cased runs of letters and digits. Null texts and texts without tokens match
    nothing, nor do such items; items shorter than ``least`` have to occur whole. Very long texts are searched whole,
    each alone. Repeated documents and repeated items are reported each; an item text is sought once however
    many items have it. Empty tables give an empty result. Other columns are not looked at.
    """
    spark = docs.sparkSession
    schema = "doc_id long, key string, n_tokens int, covered int, tiles int, longest int, coverage double"
    out = spark.createDataFrame([], schema)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    for block in _blocks(items, block_chars):
        if block:
            out = out.unionByName(rows.mapInArrow(_finder(spark, block, least, coverage), schema))
    named = items.where("text IS NOT NULL").select(item_key().alias("key"), "item_id")
    return out.join(named, "key").select("doc_id", "item_id", "n_tokens", "covered", "tiles", "longest", "coverage")


def _finder(spark, block, least, coverage):
    index = spark.sparkContext.broadcast(_Index(block, least))
    names = ["doc_id", "key", "n_tokens", "covered", "tiles", "longest", "coverage"]
    kinds = [pa.int64(), pa.string(), *[pa.int32()] * 4, pa.float64()]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = index.value
        for part, texts in _slices(batches):
            ids, out = part.column(0).to_pylist(), []
            for r, i, covered, tiles, longest in known.found(texts, coverage, least):
                size = len(known.tokens[i])
                out.append((ids[r], known.ids[i], size, covered, tiles, longest, covered / size))
            columns = list(zip(*out)) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
        give_back()

    return find


def _without(index, coverage, least):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _slices(batches):
            clean = np.ones(len(texts), bool)
            for r, *_ in index.value.found(texts, coverage, least):
                clean[r] = False
            yield part.filter(pa.array(clean))
        give_back()

    return keep


def without_items(
    docs: DataFrame,
    items: DataFrame,
    least: int = LEAST,
    coverage: float = COVERAGE,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The rows of ``docs``, with all their columns, that contain no benchmark item (see ``find_items``)."""
    spark = docs.sparkSession
    clean = docs
    for block in _blocks(items, block_chars):
        if block:
            index = spark.sparkContext.broadcast(_Index(block, least))
            clean = clean.mapInArrow(_without(index, coverage, least), docs.schema)
    return clean
