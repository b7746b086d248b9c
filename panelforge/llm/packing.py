"""Packing documents into as few training sequences as possible.

Large-item matching. Lengths are whole numbers up to the capacity, so the packing is worked
out on the histogram of lengths: items above a third of the capacity fit at most two to a
sequence and are matched greedily, the longest first with the longest that still fits; the
smaller ones then go, longest first, into the tightest gaps left, and what remains opens new
sequences filled the same way.

Scale. The histogram has at most ``capacity`` rows however large the table is, and the plan made
from it is bounded by the capacity too: every length splits at most four classes of alike
sequences, and each filling of a class at least halves its gap, so there are at most about
4 * capacity * log2(capacity) runs. Items find their place by their rank within their length, a
full ranking by range exchange: a length that a third of all items share is spread as well.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.words import blocks, give_back, small
from panelforge.operators.rank import rank_rows
from panelforge.runtime import freeze

CAPACITY = 2048
END_ID = 0
VOCABULARY = "word_bpe_49k.json"

# Entries kept per task process: parts between blanks that are not plain, and the pre-tokens of plain ones.
_CACHED, _CACHED_UNITS = 80_000, 400_000
_CACHED_LENGTH = 64
# Text bytes worked on at once, and pre-tokens encoded in one call.
_BLOCK, _JOINED = 4 << 20, 256

# Latin letters with ASCII punctuation but no apostrophe behind them: one pre-token each, encoded apart.
_PLAIN = "^(?P<core>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<tail>[!-&(-/:-@\\[-`{-~]*)$"


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


class _Kept(dict):
    """A bounded store of what ``make`` gives: once full it stays, so that common entries
    remain, until four times as many lookups have missed as it holds; then it starts anew."""

    def __init__(self, make, size: int):
        super().__init__()
        self.make, self.size, self.missed = make, size, 0

    def __missing__(self, part: str) -> bytes:
        return self._keep(part, self.make(part))

    def _keep(self, part: str, out: bytes) -> bytes:
        if len(self) < self.size:
            if len(part) <= _CACHED_LENGTH:
                self[part] = out
        else:
            self.missed += 1
            if self.missed > 4 * self.size:
                self.clear()
                self.missed = 0
        return out

    def many(self, parts: list[str], make_all) -> list[bytes]:
        """The entries of different parts; ``make_all`` makes those that are not kept, in order."""
        out = list(map(self.get, parts))
        missing = [k for k, known in enumerate(out) if known is None]
        for k, made in zip(missing, make_all([parts[k] for k in missing])):
            out[k] = self._keep(parts[k], made)
        return out


def _runs(values: np.ndarray, bounds: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``values`` numbered in ``order``, one after another, and their bounds; run i
    goes from ``bounds[i]`` to ``bounds[i + 1]``."""
    lengths = np.diff(bounds)[order]
    out = np.zeros(len(order) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    at = np.repeat(bounds[order] - out[:-1], lengths)
    at += np.arange(len(at))
    return values[at], out


class WordIds:
    """Token ids of texts, as little-endian 32-bit numbers.

    This vocabulary's pre-tokens never reach over white space, and white space itself gives no
    id, so a text's ids are those of its blank-free parts one after another. Each part is looked
    up once per block of texts, and its ids are dealt to its places by whole-array operations.
    Common pre-tokens are encoded once per process, new ones many to a call; memory is bounded
    and long parts are never kept.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.units = _Kept(self._ids, _CACHED_UNITS)
        self.parts = _Kept(self._ids, _CACHED)

    def _ids(self, part: str) -> bytes:
        return np.array(self.tokenizer.encode(part, add_special_tokens=False).ids, "<u4").tobytes()

    def _unit_ids(self, units: list[str]) -> Iterator[bytes]:
        """Ids of texts that are one pre-token each."""
        for lo in range(0, len(units), _JOINED):
            some = units[lo : lo + _JOINED]
            made = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            ids = np.array(made.ids, "<u4").tobytes()
            begin = 0
            for end in (4 * np.cumsum(np.bincount(made.word_ids, minlength=len(some)))).tolist():
                yield ids[begin:end]
                begin = end

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and the n + 1 bounds of the texts; null is empty."""
        cut = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        parts = cut.flatten().dictionary_encode()
        found = pc.extract_regex(parts.dictionary, _PLAIN)
        core, tail = (pc.struct_field(found, k) for k in ("core", "tail"))
        tail = pc.if_else(pc.equal(tail, ""), pa.scalar(None, tail.type), tail)
        units = pa.concat_arrays([pc.utf8_lower(core), tail]).dictionary_encode()
        others = parts.dictionary.filter(found.is_null()).to_numpy(zero_copy_only=False).tolist()
        ids = self.units.many(units.dictionary.to_numpy(zero_copy_only=False).tolist(), self._unit_ids)
        ids += map(self.parts.__getitem__, others)
        ids.append(b"")
        # A plain part is two units, another one is itself; the empty entry at the end stands for what is missing.
        pairs = units.indices.fill_null(len(ids) - 1).to_numpy().reshape(2, -1).copy()
        pairs[0, found.is_null().to_numpy(False)] = np.arange(len(others)) + len(units.dictionary)
        bounds = np.cumsum([0, *map(len, ids)]) // 4
        values, bounds = _runs(np.frombuffer(b"".join(ids), "<u4"), bounds, pairs.T.ravel())
        values, bounds = _runs(values, bounds[::2], parts.indices.to_numpy())
        return values, bounds[np.concatenate([[0], np.cumsum(pc.list_value_length(cut).to_numpy(), dtype=np.int64)])]

    def encode(self, text: str) -> bytes:
        return self.encode_all(pa.array([text], pa.string()))[0].tobytes()


@cache
def word_ids(path: str) -> WordIds:
    """One per task process, shared by its tasks."""
    return WordIds(path)


def _by_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows (doc_id, text) in batches of bounded text; a longer text is a batch of its own."""
    for batch in small(batches):
        sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy().astype(np.int64)
        for lo, hi in blocks(np.concatenate([[0], np.cumsum(sizes)]), _BLOCK):
            yield batch.slice(lo, hi - lo)


def pieces(
    docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, with_ids: bool = False
) -> DataFrame:
    """Token ids of each document plus the end id, cut at every ``capacity`` ids.

    Columns doc_id, piece, start, length, ids_crc32 and, if asked for, ids (little-endian 32 bit).
    """
    path = path or vocabulary_path()
    end = np.array([END_ID], "<u4").tobytes()
    step = 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(path)
        for batch in _by_bytes(batches):
            ids, bounds = words.encode_all(batch.column(1))
            rows: list[tuple] = []
            for doc_id, begin, stop in zip(batch.column(0).to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                own = ids[begin:stop].tobytes() + end
                for k, at in enumerate(range(0, len(own), step)):
                    part = own[at : at + step]
                    rows.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part), part))
            columns = list(zip(*rows)) if rows else [[]] * 6
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names)
            del ids, rows, columns, arrays
        give_back()

    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    if with_ids:
        names.append("ids")
        kinds.append(pa.binary())
        schema += ", ids binary"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, schema)


class _Class:
    """``count`` alike sequences from number ``base`` on, each with ``gap`` ids free."""

    __slots__ = ("base", "count", "gap")

    def __init__(self, base: int, count: int, gap: int):
        self.base, self.count, self.gap = base, count, gap


def plan(histogram: dict[int, int], capacity: int) -> np.ndarray:
    """Where the items of each length go.

    Rows (length, first rank, end rank, first sequence, items per sequence, first offset), ranks
    from 0 within the length: item r lies in sequence ``first sequence + (r - first rank) // per``
    at ``first offset + (r - first rank) % per * length``.
    """
    left = {n: c for n, c in histogram.items() if c > 0}
    used = dict.fromkeys(left, 0)
    runs: list[tuple[int, int, int, int, int, int]] = []
    gaps: list[int] = []  # distinct gaps, ascending
    classes: dict[int, list[_Class]] = {}
    sequences = 0

    def keep(item: _Class) -> None:
        if item.gap and item.count:
            if item.gap not in classes:
                classes[item.gap] = []
                insort(gaps, item.gap)
            classes[item.gap].append(item)

    def put(length: int, group: _Class, count: int, per: int) -> _Class:
        """``per`` items of this length into each of the first ``count`` sequences."""
        at = used[length]
        runs.append((length, at, at + count * per, group.base, per, capacity - group.gap))
        used[length] += count * per
        left[length] -= count * per
        return _Class(group.base, count, group.gap - per * length)

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        longest = large[-1]
        k = bisect_left(large, capacity - longest + 1) - 1
        partner = large[k] if k >= 0 else None
        n = left[longest]
        if partner is None:
            opened = put(longest, _Class(sequences, n, capacity), n, 1)
            sequences += n
            keep(opened)
        elif partner == longest:
            pairs = n // 2
            if pairs:
                keep(put(longest, _Class(sequences, pairs, capacity), pairs, 2))
                sequences += pairs
            if n % 2:
                # The odd one takes the next smaller partner, or stays alone.
                single = put(longest, _Class(sequences, 1, capacity), 1, 1)
                sequences += 1
                keep(put(large[k - 1], single, 1, 1) if k else single)
        else:
            n = min(n, left[partner])
            opened = put(longest, _Class(sequences, n, capacity), n, 1)
            sequences += n
            keep(put(partner, opened, n, 1))
        large = [x for x in large if left[x]]

    for length in sorted((n for n in left if left[n]), reverse=True):
        while left[length]:
            k = bisect_left(gaps, length)
            if k < len(gaps):
                gap = gaps[k]
                group = classes[gap].pop()
                if not classes[gap]:
                    del classes[gap], gaps[k]
            else:
                gap, per = capacity, capacity // length
                group = _Class(sequences, -(-left[length] // per), capacity)
                sequences += group.count
            per = gap // length
            full = min(group.count, left[length] // per)
            if full:
                keep(put(length, group, full, per))
                group = _Class(group.base + full, group.count - full, gap)
            if group.count and left[length]:
                keep(put(length, group, 1, left[length]))
                group = _Class(group.base + 1, group.count - 1, gap)
            keep(group)
    return np.array(sorted(runs), np.int64).reshape(-1, 6)


def pack_pieces(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Give every piece (doc_id, piece, length, ...) its sequence_id and offset."""
    spark = cut.sparkSession
    counts = cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    table = spark.sparkContext.broadcast(plan({r["length"]: r["n"] for r in counts}, capacity))
    ranked = rank_rows(cut, [F.col("length"), F.col("doc_id"), F.col("piece")],
                       ["length", "doc_id", "piece"], "_place")
    below, before = {}, 0
    for r in sorted(counts, key=lambda r: r["length"]):
        below[r["length"]], before = before, before + r["n"]

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        runs = table.value
        begin = np.array([below[n] for n in runs[:, 0].tolist()], np.int64) + runs[:, 1]
        # Runs are sorted by length and first rank, so they follow each other in the ranking.
        for rows in frames:
            at = rows.pop("_place").to_numpy() - 1
            run = np.searchsorted(begin, at, "right") - 1
            rank = at - begin[run]
            rows["sequence_id"] = runs[run, 3] + rank // runs[run, 4]
            rows["offset"] = runs[run, 5] + rank % runs[run, 4] * runs[run, 0]
            yield rows

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema.fields)
    return ranked.mapInPandas(place, f"{fields}, sequence_id long, offset long")


def pack(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """Pack all documents (doc_id, text) into sequences of at most ``capacity`` ids.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Pieces of one
    sequence follow each other without gaps.

    Null and empty texts are documents of the end id alone. Strings in a text that spell a special token get its
    id, as by the tokenizer's plain call. Only a document longer than the
    capacity is cut. Repeated rows and rows without doc_id are packed like any other. An
    empty table gives no rows. Other columns are not looked at.
    """
    return pack_pieces(freeze(pieces(docs, capacity, path)), capacity)
