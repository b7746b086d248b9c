"""Repeated passages: windows of words counted exactly by super-k-mer partitioning.

A window is ``width`` consecutive words of one text. Its minimiser is the smallest hash of
its ``seed``-word parts, so equal windows have equal minimisers, and consecutive windows
mostly share theirs. Each run of windows with one minimiser is a super-k-mer: its words
travel as one packed string to the minimiser's bucket, about three times the text instead
of ``width`` times. A bucket sorts its windows by hash and document, compares the bytes of
equal hashes, and reports each window that a smaller doc_id has too.

Scale. Buckets are cut to ``bucket_bytes``, so a task holds one small bucket, and their
number follows the input. A first pass counts the super-k-mers of ``_FINE`` sub-buckets a
bucket: those far over the mean hold hot minimisers (a passage that a third of all documents
share). Their windows leave the buckets and are resolved by Spark alone: a partial
minimum per window, then a join back that splits hot keys. Nothing is capped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.tables import even_parts, partitions, row_key, text_bytes
from panelforge.llm.words import Words, blocks, flat, gather, mix, rolling, sliding_min, small, strings
from panelforge.operators.joins import attach
from panelforge.runtime import freeze

WIDTH = 13
SEED = 3
BUCKET_BYTES = 6 << 20
HOT_RUNS = 20_000

_BLOCK = 2 << 20
_FINE = 16
# Super-k-mers counted in memory before their counts are passed on.
_PENDING = 2_000_000
_CODEC = pa.Codec("zstd", compression_level=1)


class _Runs:
    """The super-k-mers of a block of texts: ``first`` and ``last`` window of each run."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, width: int, seed: int):
        words = Words(data, offsets)
        low = sliding_min(rolling(words.hashes(), seed), width - seed + 1)
        room, doc = words.room(width)[: len(low)], words.doc[: len(low)]
        opens, closes = room.copy(), room.copy()
        same = (low[1:] == low[:-1]) & room[1:] & room[:-1] & (doc[1:] == doc[:-1])
        opens[1:] &= ~same
        closes[:-1] &= ~same
        self.words, self.first = words, np.flatnonzero(opens)
        self.last = np.flatnonzero(closes)
        self.low = mix(low[self.first])
        self.doc = words.doc[self.first]
        self.at = self.first - words.first[self.doc]

    def packed(self, first: np.ndarray, last: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Words ``first`` to ``last + width - 1``, joined by one space, as bytes and lengths."""
        w = self.words
        tail = np.zeros(len(w.data), bool)
        tail[w.end[w.end < len(w.data)]] = True
        keep = w.inside | (tail & ~w.inside)
        clean = np.where(w.inside, w.data, np.uint8(0x20))[keep]
        place = np.cumsum(keep) - keep
        start = place[w.start[first]]
        length = place[w.end[last + width - 1] - 1] + 1 - start
        return gather(clean, start, length), length


def _each_block(batches: Iterator[pa.RecordBatch], width: int, seed: int):
    for batch in batches:
        data, offsets = flat(batch.column("text"))
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        keys = batch.column("key").to_numpy(zero_copy_only=False)
        for i, j in blocks(offsets, _BLOCK):
            part = data[offsets[i] : offsets[j]]
            yield _Runs(part, offsets[i : j + 1] - offsets[i], width, seed), ids[i:j], keys[i:j]


def _join_runs(bytes_: np.ndarray, length: np.ndarray, ids, keys, at) -> bytes:
    head = np.array([len(length), len(bytes_)], np.int64).tobytes()
    body = b"".join(
        [head, length.astype(np.int32).tobytes(), ids.astype(np.int64).tobytes(),
         keys.astype(np.uint32).tobytes(), at.astype(np.int32).tobytes(), bytes_.tobytes()]
    )
    return len(body).to_bytes(8, "little") + _CODEC.compress(body, asbytes=True)


def _split_runs(blob: bytes):
    body = _CODEC.decompress(blob[8:], int.from_bytes(blob[:8], "little"), asbytes=True)
    n, _ = np.frombuffer(body, np.int64, 2)
    length = np.frombuffer(body, np.int32, n, 16)
    ids = np.frombuffer(body, np.int64, n, 16 + 4 * n)
    keys = np.frombuffer(body, np.uint32, n, 16 + 12 * n)
    at = np.frombuffer(body, np.int32, n, 16 + 16 * n)
    return length, ids, keys, at, np.frombuffer(body, np.uint8, -1, 16 + 20 * n)


def _unequal(data, start, length, i, j) -> np.ndarray:
    """Of the window pairs (i, j): which differ in their bytes?"""
    differs = length[i] != length[j]
    for lo in range(0, len(i), 20_000):
        part = np.flatnonzero(~differs[lo : lo + 20_000]) + lo
        if len(part):
            size = length[i[part]]
            same = gather(data, start[i[part]], size) == gather(data, start[j[part]], size)
            cut = np.cumsum(size) - size
            differs[part] = ~np.logical_and.reduceat(same, cut)
    return differs


def repeats_of_bucket(data, length, ids, keys, at, width: int):
    """Word spans of one bucket's runs whose windows a smaller doc_id has too.

    ``data`` holds the packed runs one after another. Returns ids, keys, first word and end
    word of each span.
    """
    order = np.argsort(ids, kind="stable")
    start = np.cumsum(length) - length
    data = gather(data, start[order], length[order])
    length, ids, keys, at = length[order], ids[order], keys[order], at[order]
    offsets = np.zeros(len(length) + 1, np.int64)
    np.cumsum(length, out=offsets[1:])
    words = Words(data, offsets)
    hashes = rolling(words.hashes(), width)
    window = np.flatnonzero(words.room(width)[: len(hashes)])
    begin = words.start[window]
    size = words.end[window + width - 1] - begin
    run = words.doc[window]
    place = at[run] + window - words.first[run]
    code = hashes[window]
    # Runs are in doc_id order, so of equal windows the first has the smallest doc_id.
    by = np.argsort(code, kind="stable")
    fresh = np.ones(len(by), bool)
    fresh[1:] = code[by[1:]] != code[by[:-1]]
    owner = by[np.maximum.accumulate(np.where(fresh, np.arange(len(by)), 0))]
    later = np.flatnonzero(~fresh)
    repeated = np.zeros(len(window), bool)
    mine, theirs = by[later], owner[later]
    repeated[mine] = ids[run[mine]] > ids[run[theirs]]
    wrong = _unequal(data, begin, size, mine, theirs)
    if wrong.any():
        # Different windows under one hash: settle these groups by their bytes.
        clash = np.isin(code, code[mine[wrong]])
        seen: dict[bytes, int] = {}
        for k in np.flatnonzero(clash):
            text = data[begin[k] : begin[k] + size[k]].tobytes()
            first = seen.setdefault(text, ids[run[k]])
            repeated[k] = ids[run[k]] > first
    hit = np.flatnonzero(repeated)
    if not len(hit):
        return (np.zeros(0, np.int64),) * 4
    new = np.ones(len(hit), bool)
    new[1:] = (run[hit[1:]] != run[hit[:-1]]) | (hit[1:] != hit[:-1] + 1)
    a = hit[new]
    z = hit[np.append(np.flatnonzero(new)[1:] - 1, len(hit) - 1)]
    return ids[run[a]], keys[run[a]], place[a], place[z] + width


def repeated_spans(
    docs: DataFrame,
    width: int = WIDTH,
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
    hot_runs: int = HOT_RUNS,
) -> DataFrame:
    """Spans of words covered by windows that a document with a smaller doc_id has too.

    Columns doc_id, key (of the row, see ``row_key``), from_word, to_word (exclusive); spans of
    one row may touch or overlap. Rows without doc_id or text neither give nor get spans.
    """
    spark = docs.sparkSession
    source = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), row_key(F.col("text")).alias("key"), "text"
    )
    buckets = even_parts(3 * text_bytes(source), bucket_bytes)
    fine = buckets * _FINE

    def count(batches):
        pending, waiting = [], 0
        for runs, _, _ in _each_block(batches, width, seed):
            pending.append(runs.low % np.uint64(fine))
            waiting += len(runs.low)
            if waiting > _PENDING:
                yield counted(pending)
                pending, waiting = [], 0
        if pending:
            yield counted(pending)

    def counted(pending: list[np.ndarray]) -> pa.RecordBatch:
        bucket, n = np.unique(np.concatenate(pending), return_counts=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(bucket.astype(np.int64)), pa.array(n.astype(np.int64))], ["fine", "n"]
        )

    # A hot sub-bucket has over 16 times the mean: there is at most one a bucket.
    loads = freeze(
        source.mapInArrow(count, "fine long, n long").groupBy("fine").agg(F.sum("n").alias("n"))
    )
    mean = (loads.agg(F.sum("n")).first()[0] or 0) / fine
    hot_list = [r[0] for r in loads.where(F.col("n") > max(hot_runs, 16 * mean)).select("fine").collect()]
    hot = spark.sparkContext.broadcast(np.sort(np.array(hot_list, np.uint64)))

    def is_hot(runs: _Runs) -> np.ndarray:
        return np.isin(runs.low % np.uint64(fine), hot.value)

    def pack(batches):
        for runs, ids, keys in _each_block(batches, width, seed):
            pick = np.flatnonzero(~is_hot(runs))
            bucket = (runs.low[pick] % np.uint64(fine) // np.uint64(_FINE)).astype(np.int64)
            pick = pick[np.argsort(bucket, kind="stable")]
            bucket = np.sort(bucket, kind="stable")
            data, length = runs.packed(runs.first[pick], runs.last[pick], width)
            end = np.cumsum(length)
            cut = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(pick) else []
            rows = []
            for a, z in zip(cut, [*cut[1:], len(pick)]):
                part, row = slice(a, z), runs.doc[pick[a:z]]
                rows.append(
                    _join_runs(data[end[a] - length[a] : end[z - 1]], length[part], ids[row], keys[row], runs.at[pick[part]])
                )
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[cut] if len(pick) else [], pa.int64()), pa.array(rows, pa.binary())],
                ["bucket", "runs"],
            )

    def resolve(rows: pd.DataFrame) -> pd.DataFrame:
        parts = [_split_runs(blob) for blob in rows["runs"]]
        length, ids, keys, at, data = (np.concatenate(x) for x in zip(*parts))
        out = repeats_of_bucket(data, length.astype(np.int64), ids, keys, at, width)
        return pd.DataFrame(dict(zip(("doc_id", "key", "from_word", "to_word"), out)))

    schema = "doc_id long, key long, from_word int, to_word int"
    spans = (
        source.mapInArrow(pack, "bucket long, runs binary")
        .repartition(max(partitions(spark), min(buckets, 1 << 15)), "bucket")
        .groupBy("bucket")
        .applyInPandas(resolve, schema)
    )
    if not hot_list:
        return spans

    def single(batches):
        for runs, ids, keys in _each_block(batches, width, seed):
            pick = np.flatnonzero(is_hot(runs))
            count = runs.last[pick] - runs.first[pick] + 1
            window = np.repeat(runs.first[pick] - (np.cumsum(count) - count), count) + np.arange(count.sum())
            data, length = runs.packed(window, window, width)
            doc = runs.words.doc[window]
            yield pa.RecordBatch.from_arrays(
                [strings(data, length, pa.binary()), pa.array(ids[doc]), pa.array(keys[doc]),
                 pa.array((window - runs.words.first[doc]).astype(np.int32))],
                ["window", "doc_id", "key", "from_word"],
            )

    windows = freeze(
        source.mapInArrow(single, "window binary, doc_id long, key long, from_word int")
    )
    owners = windows.groupBy("window").agg(
        F.min("doc_id").alias("owner"), F.max("doc_id").alias("_last")
    ).where("owner < _last").select("window", "owner")
    return spans.unionByName(
        attach(windows, owners, ["window"], how="inner")
        .where("doc_id > owner")
        .select("doc_id", "key", "from_word", (F.col("from_word") + width).alias("to_word"))
    )


def _merged(batches):
    """Union of the spans of each row, as two sorted arrays."""
    for batch in batches:
        starts, ends = [], []
        for spans in batch.column("spans").to_pylist():
            pairs = np.array([(s["from_word"], s["to_word"]) for s in spans], np.int32)
            pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
            reach = np.maximum.accumulate(pairs[:, 1])
            new = np.append(True, pairs[1:, 0] > reach[:-1])
            starts.append(pairs[new, 0])
            ends.append(reach[np.append(np.flatnonzero(new)[1:] - 1, len(pairs) - 1)])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("key"),
             pa.array(starts, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int32()))],
            ["doc_id", "key", "starts", "ends"],
        )


def row_spans(spans: DataFrame) -> DataFrame:
    """One row per document row: its spans merged. A row's spans are bounded by its text."""
    return (
        spans.groupBy("doc_id", "key")
        .agg(F.collect_list(F.struct("from_word", "to_word")).alias("spans"))
        .mapInArrow(_merged, "doc_id long, key long, starts array<int>, ends array<int>")
    )


def _without(text: str, starts, ends) -> tuple[int, int, bytes]:
    """Words, removed words, and the kept words joined by one space."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    words = Words(data, np.array([0, len(data)]))
    step = np.zeros(len(words) + 1, np.int64)
    if starts is not None and len(starts):
        np.add.at(step, np.asarray(starts), 1)
        np.add.at(step, np.asarray(ends), -1)
    keep = np.flatnonzero(np.cumsum(step)[:-1] == 0)
    raw = data.tobytes()
    kept = b" ".join([raw[a:b] for a, b in zip(words.start[keep].tolist(), words.end[keep].tolist())])
    return len(words), len(words) - len(keep), kept


def remove_repeats(docs: DataFrame, digest: bool = False, **options) -> DataFrame:
    """Remove the words of every passage that a document with a smaller doc_id has too.

    Windows are judged on the input, not on what is left. Returns doc_id, n_words, n_removed and
    kept_text (kept words joined by one space), or kept_sha256 of it with ``digest``.

    Null text counts as no words. Rows whose doc_id is null keep their words and protect no
    others. Rows that share a doc_id never take words from one another. Fewer than
    ``width`` words: nothing to remove. An empty table gives an empty result. Other columns are not
    looked at, whatever their names.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), row_key(F.col("text")).alias("key"), "text"
    )

    def cut(batches):
        for batch in small(batches):
            out = [
                _without(t or "", a, b)
                for t, a, b in zip(
                    batch.column("text").to_pylist(),
                    batch.column("starts").to_pylist(),
                    batch.column("ends").to_pylist(),
                )
            ]
            kept = [hashlib.sha256(x[2]).hexdigest() if digest else x[2].decode() for x in out]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([x[0] for x in out], pa.int64()),
                 pa.array([x[1] for x in out], pa.int64()), pa.array(kept, pa.string())],
                ["doc_id", "n_words", "n_removed", name],
            )

    name = "kept_sha256" if digest else "kept_text"
    spans = row_spans(repeated_spans(docs, **options))
    return attach(rows, spans, ["doc_id", "key"]).mapInArrow(
        cut, f"doc_id long, n_words long, n_removed long, {name} string"
    )
