"""Two tokenizers aligned on bytes, with corpus-wide counts of the token pairs that overlap.

Text A is cut by a byte-level BPE, text B by a piece BPE with byte fallback. Each text is encoded once and its ids
are kept as a written table; from there on documents are aligned as often as needed, a batch at a time: every
byte offset at which a token of either side ends closes one link, every offset at which both end a group.

Counting goes through minimal perfect hashing. The distinct pairs of all tasks are hashed part by part. A task
then aligns its documents and counts them in dense vectors indexed by the hash, every lookup verified against the
stored key; vectors are summed in a tree, a few at a time. A second pass aligns the documents again and looks
their links' counts up.

Scale. Pairs are at most the product of the vocabularies and grow far slower than the text. Broadcast are parts of up
to ``BROADCAST_BYTES`` together; more pairs are worked through in several rounds of parts. Vectors travel
compressed, and only their touched segments.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.hashing import PerfectHash, part_of
from panelforge.llm.tables import even_parts
from panelforge.llm.words import blocks, give_back, small
from panelforge.operators.joins import BROADCAST_BYTES
from panelforge.runtime import freeze

BYTE_VOCABULARY = "byte_bpe_50k.tiktoken"
PIECE_VOCABULARY = "piece_bpe_32k.model"

# Keys of one part of the hash; their numbers, keys and counts take some 24 bytes each.
PART_KEYS = 1 << 18
_KEY_BYTES = 24
# Vectors added up by one task in one round.
FAN_IN = 16

_SEGMENT = 1 << 14
# Bytes of text, and of ids, that are worked on at once; a longer text is worked on alone.
_BLOCK = 2 << 20
_PENDING = 1 << 21
_CODEC = pa.Codec("zstd", compression_level=1)
_IDS = np.dtype("<u2")


def vocabulary_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(BYTE_VOCABULARY), public_tokenizers.path(PIECE_VOCABULARY)


class Vocabularies:
    """Both encoders and the bytes of their tokens."""

    def __init__(self, byte_path: str, piece_path: str):
        import base64

        import public_tokenizers
        import sentencepiece
        import tiktoken

        with open(byte_path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.a = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        self.a_bytes = [b""] * self.a.n_vocab
        for token, i in ranks.items():
            self.a_bytes[i] = token
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        if max(len(self.a_bytes), len(self.b_bytes)) > 1 << 16:
            raise ValueError("ids are kept in 16 bits")
        self.a_length = np.array(list(map(len, self.a_bytes)), np.int64)
        self.b_length = np.array(list(map(len, self.b_bytes)), np.int64)
        # How an id is written inside and at the end of its side of a group, A before B.
        ids = [range(len(self.a_bytes)), range(len(self.b_bytes))]
        self.written = [f"{i}{sign}" for side, end in zip(ids, "|;") for i in side for sign in ("," + end)]

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[1:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, text: str | None) -> tuple[bytes, bytes]:
        """Ids of both sides, 16 bits each; none if a side's bytes are not those of a space and the text."""
        if not text:
            return b"", b""
        full = " " + text
        raw, a, b = full.encode(), self.a.encode_ordinary(full), self.b.encode(text)
        for ids, known in ((a, self.a_bytes), (b, self.b_bytes)):
            if b"".join(map(known.__getitem__, ids)) != raw:
                return b"", b""
        return np.array(a, _IDS).tobytes(), np.array(b, _IDS).tobytes()


@cache
def vocabularies(byte_path: str, piece_path: str) -> Vocabularies:
    """One per task process."""
    return Vocabularies(byte_path, piece_path)


@dataclass(frozen=True)
class Aligned:
    """The links of consecutive documents: ids ``a`` and ``b`` of each, and whether a group closes with it.

    ``first`` is the number of the first link of each document, with one more entry than documents.
    """

    a: np.ndarray
    b: np.ndarray
    a_at: np.ndarray
    b_at: np.ndarray
    closes: np.ndarray
    first: np.ndarray

    @property
    def pairs(self) -> np.ndarray:
        return self.a.astype(np.int64) << 32 | self.b


def align(a: np.ndarray, b: np.ndarray, a_length: np.ndarray, b_length: np.ndarray, a_first: np.ndarray) -> Aligned:
    """Align the tokens of consecutive documents, which have the same bytes on both sides.

    Between two neighbouring token ends, of either side, lies one token of each side: a link.
    """
    a_ends, b_ends = np.cumsum(a_length[a]), np.cumsum(b_length[b])
    total = int(a_ends[-1]) if len(a_ends) else 0
    of_a, of_b = np.zeros(total + 1, bool), np.zeros(total + 1, bool)
    of_a[a_ends], of_b[b_ends] = True, True
    at = np.flatnonzero(of_a | of_b)
    a_closes, b_closes = of_a[at], of_b[at]
    a_at, b_at = np.cumsum(a_closes) - a_closes, np.cumsum(b_closes) - b_closes
    starts = np.concatenate([[0], a_ends])[a_first]
    return Aligned(a[a_at], b[b_at], a_at, b_at, a_closes & b_closes, np.searchsorted(at, starts, "right"))


def _columns(batch: pa.RecordBatch, one: int, two: int) -> tuple[np.ndarray, ...]:
    """Ids of two binary columns of a batch and the number of each row's first id."""
    out = []
    for k in (one, two):
        column = batch.column(k).cast(pa.large_binary())
        _, offsets, data = column.buffers()
        at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
        raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
        out += [raw.view(_IDS), (at - at[0]) // _IDS.itemsize]
    return tuple(out)


def _slices(batches: Iterator[pa.RecordBatch], one: int, two: int) -> Iterator[tuple[pa.RecordBatch, tuple]]:
    """Batches cut to a bounded number of ids, with their ids."""
    for batch in batches:
        _, a_first, _, _ = _columns(batch, one, two)
        for lo, hi in blocks(a_first * _IDS.itemsize, _BLOCK):
            part = batch.slice(lo, hi - lo)
            yield part, _columns(part, one, two)


def encoded(docs: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """Per row doc_id, both sides' ids, and what its own alignment says."""
    names = ["n_a", "n_b", "n_groups", "n_links"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabularies(*paths)
        for batch in small(batches, 256):
            ids = [known.encode(t.as_py()) for t in batch.column(1)]
            kept = pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([i[k] for i in ids], pa.binary()) for k in (0, 1))], ["doc_id", "a", "b"]
            )
            for part, (a, a_first, b, b_first) in _slices(iter([kept]), 1, 2):
                found = align(a, b, known.a_length, known.b_length, a_first)
                counts = [np.diff(a_first), np.diff(b_first), _sums(found.closes, found.first), np.diff(found.first)]
                digests = pa.array(list(_digests(known, a, b, a_first, b_first, found)), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *(pa.array(c.astype(np.int64)) for c in counts), digests],
                    ["doc_id", "a", "b", *names, "groups_sha256"],
                )
        give_back()

    shape = f"doc_id long, a binary, b binary, {', '.join(f'{n} long' for n in names)}, groups_sha256 string"
    return docs.mapInArrow(work, shape)


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of the values of each document."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[first[1:]] - total[first[:-1]]


def _digests(known: Vocabularies, a, b, a_first, b_first, found: Aligned) -> Iterator[str]:
    """The hash of each document's groups as text."""
    # Of each token: is it the last of its group, and how many tokens of the other side are written before it?
    a_last, b_last = np.zeros(len(a), bool), np.zeros(len(b), bool)
    a_end, b_end = found.a_at[found.closes], found.b_at[found.closes]
    a_last[a_end], b_last[b_end] = True, True
    a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
    order = np.empty(len(a) + len(b), np.int64)
    before = np.concatenate([[0], b_end + 1])
    order[np.arange(len(a)) + before[a_group]] = 2 * a.astype(np.int64) + a_last
    order[np.arange(len(b)) + a_end[b_group] + 1] = 2 * (b.astype(np.int64) + len(known.a_bytes)) + b_last
    for lo, hi in zip(a_first + b_first, a_first[1:] + b_first[1:]):
        text = "".join(map(known.written.__getitem__, order[lo:hi].tolist()))
        yield hashlib.sha256(text[:-1].encode()).hexdigest() if text else ""


def distinct_pairs(ids: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """Column pair: every linked id pair (a << 32 | b) of the corpus, once."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabularies(*paths)
        seen = np.zeros(0, np.int64)
        for _, (a, a_first, b, _) in _slices(batches, 0, 1):
            seen = np.union1d(seen, align(a, b, known.a_length, known.b_length, a_first).pairs)
            if len(seen) > _PENDING:
                yield pa.RecordBatch.from_arrays([pa.array(seen)], ["pair"])
                seen = seen[:0]
        yield pa.RecordBatch.from_arrays([pa.array(seen)], ["pair"])
        give_back()

    return ids.select("a", "b").mapInArrow(work, "pair long").distinct()


def hashed_parts(pairs: DataFrame, parts: int) -> DataFrame:
    """One row a part: its keys' minimal perfect hash and, by number, the keys."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            part, pair = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            for p in np.unique(part).tolist():
                held.setdefault(p, []).append(pair[part == p])
        for p, keys in held.items():
            built = PerfectHash.build(np.concatenate(keys))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([p], pa.int64()),
                    pa.array([built.sizes], pa.list_(pa.int64())),
                    pa.array([np.packbits(built.bits).tobytes()]),
                    pa.array([built.keys.tobytes()]),
                ],
                ["part", "sizes", "bits", "keys"],
            )

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair = batch.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(part_of(pair, parts)), batch.column(0)], ["part", "pair"])

    dealt = pairs.mapInArrow(numbered, "part long, pair long").repartition(parts, "part")
    return freeze(dealt.mapInArrow(work, "part long, sizes array<long>, bits binary, keys binary"))


class Lookup:
    """Some parts of the hash; a pair's slot is its part's first slot plus its number, -1 in other parts."""

    def __init__(self, rows: Iterable, parts: int):
        self.parts = parts
        self.first = np.full(parts, -1, np.int64)
        self.hashes: dict[int, PerfectHash] = {}
        self.slots = 0
        for row in sorted(rows, key=lambda r: r["part"]):
            keys = np.frombuffer(row["keys"], np.int64)
            bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=sum(row["sizes"])).astype(bool)
            self.hashes[row["part"]] = PerfectHash.of(list(row["sizes"]), bits, keys)
            self.first[row["part"]] = self.slots
            self.slots += len(keys)

    def find(self, pairs: np.ndarray) -> np.ndarray:
        part = part_of(pairs, self.parts)
        slot = np.full(len(pairs), -1, np.int64)
        for p in np.unique(part).tolist():
            if p in self.hashes:
                mine = part == p
                number = self.hashes[p].find(pairs[mine])
                slot[mine] = np.where(number >= 0, number + self.first[p], -1)
        return slot

    def keys(self) -> np.ndarray:
        return np.concatenate([self.hashes[p].keys for p in sorted(self.hashes)]) if self.hashes else np.zeros(0, np.int64)


def _packed(counts: np.ndarray) -> bytes:
    return _CODEC.compress(counts.astype(np.int64).tobytes(), asbytes=True)


def _unpacked(blob: bytes) -> np.ndarray:
    return np.frombuffer(_CODEC.decompress(blob, 8 * _SEGMENT, asbytes=True), np.int64)


def _runs(values: np.ndarray) -> np.ndarray:
    """Where the runs of equal values begin."""
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)


def document_counts(ids: DataFrame, lookup: Lookup, paths: tuple[str, str]) -> np.ndarray:
    """In how many documents each slot's pair is linked: dense vectors of tasks, summed in a tree."""
    spark = ids.sparkSession
    shared = spark.sparkContext.broadcast(lookup)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        known, slots = vocabularies(*paths), shared.value
        segments: dict[int, np.ndarray] = {}
        for _, (a, a_first, b, _) in _slices(small(batches), 0, 1):
            found = align(a, b, known.a_length, known.b_length, a_first)
            # 16 bits each for A, B and the document of the batch: sorted, equal ones are one.
            doc = np.repeat(np.arange(len(found.first) - 1), np.diff(found.first))
            keys = np.sort(found.a.astype(np.int64) << 32 | found.b.astype(np.int64) << 16 | doc)
            keys = keys[_runs(keys)] >> 16
            begin = _runs(keys)
            n = np.diff(np.append(begin, len(keys)))
            pair = keys[begin]
            at = slots.find(pair >> 16 << 32 | pair & 0xFFFF)
            n, at = n[at >= 0], at[at >= 0]
            for number in np.unique(at // _SEGMENT).tolist():
                mine = at // _SEGMENT == number
                segments.setdefault(number, np.zeros(_SEGMENT, np.int64))[at[mine] % _SEGMENT] += n[mine]
        task = TaskContext.get().partitionId()
        for number in sorted(segments):
            yield vector(number, task, segments.pop(number))
        give_back()

    def vector(number: int, task: int, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.array([task], pa.int64()), pa.array([_packed(counts)])],
            ["segment", "task", "counts"],
        )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, None
        for batch in batches:
            for segment, task, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if (segment, task) != now:
                    if now:
                        yield vector(*now, total)
                    now, total = (segment, task), np.zeros(_SEGMENT, np.int64)
                total += _unpacked(counts)
        if now:
            yield vector(*now, total)

    shape = "segment long, task long, counts binary"
    vectors = freeze(ids.select("a", "b").mapInArrow(work, shape))
    while not vectors.groupBy("segment").count().where("count > 1").isEmpty():
        grouped = vectors.withColumn("task", F.floor(F.col("task") / FAN_IN))
        ordered = grouped.repartition("segment", "task").sortWithinPartitions("segment", "task")
        vectors = freeze(ordered.mapInArrow(add, shape))
    shared.unpersist()
    # As many numbers as the lookup has slots, whose keys came from the driver too.
    total = np.zeros(-(-lookup.slots // _SEGMENT) * _SEGMENT, np.int64)
    for row in vectors.collect():
        total[row["segment"] * _SEGMENT : (row["segment"] + 1) * _SEGMENT] = _unpacked(bytes(row["counts"]))
    return total[: lookup.slots]


def _rounds(parts: DataFrame, total: int, budget: int) -> Iterator[Lookup]:
    """The hash in rounds of parts that fit ``budget`` together."""
    each = max(1, budget // (_KEY_BYTES * PART_KEYS))
    for lo in range(0, total, each):
        yield Lookup(parts.where((F.col("part") >= lo) & (F.col("part") < lo + each)).collect(), total)


def look_up(frame: DataFrame, shared, paths: tuple[str, str]) -> DataFrame:
    """Add what the broadcast (lookup, counts, best) knows of each row's links to n_best and count_sum."""
    names = frame.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabularies(*paths)
        lookup, counts, best = shared.value
        # The last entry stands for pairs of other rounds.
        counts, best = np.append(counts, 0), np.append(best, False)
        for part, (a, a_first, b, _) in _slices(batches, 1, 2):
            found = align(a, b, known.a_length, known.b_length, a_first)
            # Sorted by pair with the link's place in the low bits, so that each pair is looked up once.
            width = max(len(found.a), 1).bit_length()
            keys = np.sort((found.a.astype(np.int64) << 16 | found.b) << width | np.arange(len(found.a)))
            place, pair = keys & ((1 << width) - 1), keys >> width
            begin = _runs(pair)
            slot = lookup.find(pair[begin] >> 16 << 32 | pair[begin] & 0xFFFF)
            of_link = np.empty(len(keys), np.int64)
            of_link[place] = np.repeat(slot, np.diff(np.append(begin, len(keys))))
            sums = (_sums(v[of_link], found.first) for v in (best, counts))
            added = [pa.array(c.to_numpy(zero_copy_only=False) + s) for c, s in zip(part.columns[-2:], sums)]
            yield pa.RecordBatch.from_arrays([*part.columns[:-2], *added], names)
        give_back()

    return frame.mapInArrow(work, frame.schema)


def aligned_counts(
    docs: DataFrame,
    paths: tuple[str, str] | None = None,
    part_keys: int = PART_KEYS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Tokens, groups and links of each row of ``docs`` (doc_id, text) under both tokenizers.

    Columns doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256. A link's count is the number of
    rows in which its id pair is linked, over all rows; it is best if no pair of its A id has a higher one.

    Null and empty texts, and texts whose tokens of either side do not spell the text with a space before it, have no
    tokens: zeros and an empty groups_sha256. Strings that spell special tokens are ordinary text. Very
    long texts are aligned whole. Repeated rows count each; ties are all best; rows without doc_id stay and count.
    An empty table gives no rows. Other columns are not looked at, whatever their names.
    """
    spark = docs.sparkSession
    paths = paths or vocabulary_paths()
    ids = freeze(encoded(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), paths))
    pairs = freeze(distinct_pairs(ids, paths))
    parts = even_parts(pairs.count(), part_keys)
    hashed = hashed_parts(pairs, parts)

    # Highest count of each A id: one number for each entry of the vocabulary.
    highest = np.zeros(1 << 16, np.int64)
    counted: list[np.ndarray] = []
    for lookup in _rounds(hashed, parts, broadcast_bytes):
        counts = document_counts(ids, lookup, paths)
        np.maximum.at(highest, lookup.keys() >> 32, counts)
        counted.append(counts)

    zero = F.lit(0).cast("long")
    frame = ids.select(
        "doc_id", "a", "b", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", zero.alias("n_best"), zero.alias("count_sum")
    )
    for k, lookup in enumerate(_rounds(hashed, parts, broadcast_bytes)):
        if k:
            frame = freeze(frame)
        counts = counted[k]
        best = counts == highest[lookup.keys() >> 32]
        frame = look_up(frame, spark.sparkContext.broadcast((lookup, counts, best)), paths)
    return frame.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
