"""Near-duplicates by SimHash: fingerprints that differ in few of 64 bits, found by pigeonring filtering.

A fingerprint is a ring of ``SEGMENTS`` segments. If two differ in at most ``distance`` bits, then from some
segment on every chain of l consecutive segments differs in at most ``l * distance / SEGMENTS`` bits, for
each l. So the first segment of the chain is equal, which gives the key under which fingerprints meet, and the
budgets of the longer chains prune the pairs that meet before all 64 bits are compared. No pair is lost.

Scale. Only distinct fingerprints travel, once for each segment, as 16 bytes. A key under which more than
``BLOCK`` fingerprints meet is worked through in pairs of blocks, so that no task holds more than two
of them; a key with very many is first cut by the second segment of the chain, in which at most one
bit may differ: one row for each bit left out. A task reports a spanning forest of the links it finds, never
the pairs, so a group of near copies costs rows in proportion to its size. Copies share one fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.llm.components import components
from panelforge.llm.tables import partitions
from panelforge.llm.words import give_back, small
from panelforge.operators.joins import attach
from panelforge.runtime import freeze

SHINGLE = 4
SEED = 42
DISTANCE = 4
SEGMENTS = 5
# Fingerprints of one key that are compared with each other in one task, at most.
BLOCK = 2048
# Keys with more blocks than this are cut by the next segment first.
MOST_BLOCKS = 32

_BITS = 64
_COUNTED = 1 << 16
_PENDING = 1 << 17
_WIDTH = -(-_BITS // SEGMENTS)


def fingerprint(text: str | None) -> int:
    """The 64-bit SimHash of one whole text, all its shingles counted."""
    from xxhash import xxh64_intdigest

    # Of bytes, ``lower`` changes A-Z only and ``split`` cuts at U+0020 and U+0009 to U+000D.
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    clean = b" ".join(words)
    if len(words) <= SHINGLE:
        return xxh64_intdigest(clean, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[: -SHINGLE] + 1]).tolist()
    ones, ends = np.zeros(_BITS, np.int64), ends[SHINGLE - 1 :].tolist()
    for lo in range(0, len(ends), _COUNTED):
        spans = zip(starts[lo : lo + _COUNTED], ends[lo : lo + _COUNTED])
        codes = np.array([xxh64_intdigest(clean[a:b], SEED) for a, b in spans], "<u8")
        bits = np.unpackbits(codes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    most = np.packbits(2 * ones > len(ends), bitorder="little")
    return int(most.view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """Columns doc_id and fingerprint (64 bits as a long) of every row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, 256):
            texts = batch.column(1)
            prints = np.array([fingerprint(text.as_py()) for text in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints)], ["doc_id", "fingerprint"])
        give_back()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(work, "doc_id long, fingerprint long")


def segments(of: int = SEGMENTS) -> list[tuple[int, int]]:
    """First bit and width of each segment."""
    cuts = [_BITS * k // of for k in range(of + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _segment(print_: Column, start: int, width: int) -> Column:
    return F.shiftrightunsigned(print_, start).bitwiseAND(F.lit((1 << width) - 1))


def _ring_masks() -> np.ndarray:
    """For chain start i and length l: the bits of the chain's segments behind the first, whose bits are equal."""
    masks = np.zeros((SEGMENTS, SEGMENTS + 1), np.uint64)
    for i in range(SEGMENTS):
        mask = 0
        for length in range(2, SEGMENTS + 1):
            at, width = segments()[(i + length - 1) % SEGMENTS]
            mask |= ((1 << width) - 1) << at
            masks[i, length] = mask
    return masks


def chain_ends(prints: DataFrame) -> DataFrame:
    """``fingerprint`` under one key for each chain start: columns key and fingerprint."""
    keys = [
        F.lit(i << _WIDTH).cast("long").bitwiseOR(_segment(F.col("fingerprint"), at, width))
        for i, (at, width) in enumerate(segments())
    ]
    return prints.select(F.explode(F.array(*keys)).alias("key"), "fingerprint")


def _next_segment(rows: DataFrame) -> DataFrame:
    """Keys cut by the chain's second segment with one bit left out, for each bit: fingerprints that
    differ there in at most one bit meet under at least one of these keys."""
    cut = F.lit(None)
    for i in range(SEGMENTS):
        at, width = segments()[(i + 1) % SEGMENTS]
        value = _segment(F.col("fingerprint"), at, width)
        finer = [
            F.col("key")
            .bitwiseOR(F.lit((bit + 1) << (_WIDTH + 8)))
            .bitwiseOR(F.shiftleft(value.bitwiseAND(F.lit(~(1 << bit) & ((1 << width) - 1))), _WIDTH + 16))
            for bit in range(width)
        ]
        cut = F.when(F.shiftright("key", _WIDTH).bitwiseAND(F.lit(255)) == i, F.array(*finer)).otherwise(cut)
    return rows.select(F.explode(cut).alias("key"), "fingerprint")


def _blocked(rows: DataFrame, block: int) -> DataFrame:
    """Rows (key, fingerprint, n) of large keys, once for every pair of blocks (i, j) they take part in."""
    blocks = F.ceil(F.col("n") / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64(F.lit(block), "fingerprint"), F.col("blocks")).cast("int")
    cut = rows.withColumn("blocks", blocks).withColumn("own", own)
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return cut.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fingerprint")


def meetings(prints: DataFrame, block: int = BLOCK, most_blocks: int = MOST_BLOCKS) -> DataFrame:
    """Distinct fingerprints by the group (key, i, j) in which they are compared; of a large key, i and j are blocks."""
    rows = chain_ends(prints)
    # At most 2**13 keys for each chain start, however many documents there are.
    sizes = freeze(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block))
    alone = rows.join(F.broadcast(sizes.select("key")), "key", "left_anti")
    met = alone.select("key", F.lit(0).alias("i"), F.lit(0).alias("j"), "fingerprint")
    if sizes.isEmpty():
        return met
    huge = F.col("n") > block * most_blocks
    met = met.unionByName(_blocked(rows.join(F.broadcast(sizes.where(~huge)), "key"), block))
    if sizes.where(huge).isEmpty():
        return met
    finer = freeze(_next_segment(rows.join(F.broadcast(sizes.where(huge).select("key")), "key")))
    finer_sizes = finer.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    return met.unionByName(_blocked(attach(finer, finer_sizes, ["key"]), block))


def _joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``label`` (smallest member of each node's tree) after linking the nodes a and b."""
    while len(a):
        x, y = label[a], label[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
    return label


def forest(key: np.ndarray, group: np.ndarray, prints: np.ndarray, distance: int = DISTANCE) -> np.ndarray:
    """For rows sorted by group: the number of the first row of the tree that links put each row into.

    Pairs of a group are met by their distance in the order of rows; those already in one tree are not
    compared any more.
    """
    n = len(prints)
    label = np.arange(n)
    masks = _ring_masks()[(key >> _WIDTH) & 255]
    budgets = [length * distance // SEGMENTS for length in range(SEGMENTS + 1)]
    last = np.concatenate([np.flatnonzero(group[1:] != group[:-1]) + 1, [n]])
    room = last[np.searchsorted(last, np.arange(n), "right")] - np.arange(n)
    at, step = np.arange(n), 1
    links: list[tuple[np.ndarray, np.ndarray]] = []
    waiting = 0
    while True:
        at = at[room[at] > step]
        if not len(at):
            break
        one, two = at, at + step
        different = label[one] != label[two]
        one, two = one[different], two[different]
        bits = prints[one] ^ prints[two]
        for length in range(2, SEGMENTS + 1):
            close = np.bitwise_count(bits & masks[one, length]) <= budgets[length]
            one, two, bits = one[close], two[close], bits[close]
        if len(one):
            links.append((one, two))
            waiting += len(one)
            if waiting > _PENDING:
                label, links, waiting = _joined(label, *map(np.concatenate, zip(*links))), [], 0
        step += 1
    if links:
        label = _joined(label, *map(np.concatenate, zip(*links)))
    return label


def links(prints: DataFrame, block: int = BLOCK, most_blocks: int = MOST_BLOCKS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that differ in at most ``DISTANCE`` bits.

    Every edge follows links found in one group, and every link lies inside a path of edges.
    """
    tasks = partitions(prints.sparkSession)
    met = meetings(prints, block, most_blocks).repartition(tasks, "key", "i", "j").sortWithinPartitions("key", "i", "j")
    limit = 32 * block

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = []
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]
            kept.append(np.stack(columns))
            if sum(k.shape[1] for k in kept) < limit:
                continue
            rows = np.concatenate(kept, axis=1)
            # The last group may go on in the next batch.
            same = (rows[:3] == rows[:3, -1:]).all(axis=0)
            cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
            yield from found(rows[:, :cut])
            kept = [rows[:, cut:]]
        if kept:
            yield from found(np.concatenate(kept, axis=1))
        give_back()

    def found(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not rows.shape[1]:
            return
        new = np.concatenate([[True], (rows[:3, 1:] != rows[:3, :-1]).any(axis=0)])
        prints = rows[3].view(np.uint64)
        tree = forest(rows[0], np.cumsum(new), prints)
        child = np.flatnonzero(tree != np.arange(len(tree)))
        yield pa.RecordBatch.from_arrays([pa.array(rows[3][child]), pa.array(rows[3][tree[child]])], ["a", "b"])

    return met.select("key", "i", "j", "fingerprint").mapInArrow(work, "a long, b long").distinct()


def near_copies(docs: DataFrame) -> DataFrame:
    """Columns doc_id, fingerprint (16 lowercase hex digits) and component_id of every row of ``docs``.

    Documents are linked if their fingerprints differ in at most ``DISTANCE`` bits; component_id is the smallest
    doc_id that links lead to, the document's own included.

    Null, empty and blank texts have the fingerprint 0 and are linked like any other. A text of fewer than
    four words is one shingle. Very long texts are counted whole, 65,536 shingles at a time. Repeated rows get a row
    each. A row without doc_id links others but names no component; if all of a component lack it,
    component_id is null. An empty table gives no rows. Other columns are not looked at, whatever
    their names.
    """
    rows = freeze(fingerprints(docs))
    prints = freeze(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first")))
    edges = freeze(links(prints.select("fingerprint")))
    trees = components(edges).select(F.col("node").alias("fingerprint"), "root")
    rooted = freeze(prints.join(trees, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint")))
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    side = attach(rooted.select("fingerprint", "root"), named, ["root"]).select("fingerprint", "component_id")
    return attach(rows, side, ["fingerprint"]).select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )
