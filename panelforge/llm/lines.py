"""Removing multi-line blocks that repeat across the corpus.

A rolling hash over the hashes of two neighbouring lines decides where a chunk of lines ends, so boundaries move
with the content and an inserted line shifts none behind it. Texts are cut at several spacings. A chunk whose
bytes occur earlier goes as one piece. What the boundaries miss is found at the finest spacing, where every two
neighbouring lines are a chunk of their own (a window) and chunks overlap: a block of two or more lines that
occurs earlier has all its windows there, so the union of the repeated windows is the union of all repeated
blocks, wherever they begin and end.

Windows inside a removed chunk need no look. Such a chunk stands earlier in the corpus with the same windows, so
the first occurrence of a window never lies in a removed chunk, and the result is the one that all windows give.

Scale. Hashes are counted first, with one row per chunk and partial sums, and without text; only chunks
whose hash repeats are compared by their text, a chunk inside a larger one of these not at all. The first
occurrence is a partial minimum, and joining it back (``attach``) splits chunks that a large part of all
documents share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.llm.tables import row_key
from panelforge.llm.words import give_back, mix, small
from panelforge.operators.joins import attach
from panelforge.runtime import freeze, freeze_measured

# One line in so many ends a chunk, on average.
SPACING = 4
LEAST_LINES = 2
# Spacings of the chunks that go before the windows are looked at; two lines are a window already.
SPACINGS = (16, 4)
LEAST_CHUNK = 3
# First occurrences carry their text; up to so many bytes of them are broadcast.
SMALL_BYTES = 64 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)


def _line_hash(line: str) -> int:
    return int.from_bytes(
        hashlib.blake2b(line.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little"
    )


def _line_codes(lines: list[str]) -> np.ndarray:
    return np.fromiter(map(_line_hash, lines), np.uint64, len(lines))


def _bounds(code: np.ndarray, spacing: int, least: int) -> np.ndarray:
    """Where the chunks of a text begin, and its number of lines at the end; ``code`` are its lines' hashes."""
    n, bounds = len(code), [0]
    rolled = mix(code[:-1] * _BASE + code[1:])
    for end in (np.flatnonzero(rolled % np.uint64(spacing) == 0) + 2).tolist():
        if end - bounds[-1] >= least and end < n:
            bounds.append(end)
    return np.array([*bounds, n], np.int64)


def chunks(text: str, spacing: int = SPACING, least: int = LEAST_LINES) -> list[list[str]]:
    """The lines of a text in content-defined chunks; joined again they give the text.

    A chunk ends after a line if the hash of that line and the one before it says so and the
    chunk has ``least`` lines. The rest of the text is the last chunk, and may be one line.
    """
    lines = text.split("\n")
    bounds = _bounds(_line_codes(lines), spacing, least).tolist()
    return [lines[a:z] for a, z in zip(bounds, bounds[1:])]


def _span(start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """First line and end of a piece as one number, which sorts by the first line."""
    return (start.astype(np.int64) << 32) | stop.astype(np.int64)


def _lines_of(span: int) -> tuple[int, int]:
    return span >> 32, span & 0xFFFFFFFF


def _chunk_spans(lines: list[str], spacings: Sequence[int], least: int) -> tuple[np.ndarray, np.ndarray]:
    """Spans and hashes of the chunks of ``least`` or more lines, not all blank, at each of the spacings."""
    if len(lines) < least:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    code = _line_codes(lines)
    filled = ~np.fromiter(map(_blank, lines), bool, len(lines))
    spans, codes = [], []
    for spacing in spacings:
        bounds = _bounds(code, spacing, least)
        start, size = bounds[:-1], np.diff(bounds)
        place = (np.arange(len(lines)) - np.repeat(start, size)).astype(np.uint64)
        total = np.add.reduceat(mix(code + place * _BASE), start)
        wanted = (size >= least) & np.logical_or.reduceat(filled, start)
        spans.append(_span(start, bounds[1:])[wanted])
        codes.append(mix(total + size.astype(np.uint64))[wanted])
    span, at = np.unique(np.concatenate(spans), return_index=True)
    return span, np.concatenate(codes)[at]


def _outermost(spans: np.ndarray) -> np.ndarray:
    """Which spans lie in no other one of the same text."""
    start, stop = spans >> 32, spans & 0xFFFFFFFF
    order = np.lexsort((-stop, start))
    reach = np.maximum.accumulate(stop[order])
    keep = np.ones(len(spans), bool)
    keep[order[1:]] = stop[order[1:]] > reach[:-1]
    return keep


def _outside(spans: np.ndarray, removed: np.ndarray) -> np.ndarray:
    """Which spans lie in none of the removed ones."""
    removed = np.sort(removed)
    reach = np.concatenate([[0], np.maximum.accumulate(removed & 0xFFFFFFFF)])
    return reach[np.searchsorted(removed >> 32, spans >> 32, "right")] < (spans & 0xFFFFFFFF)


def _blank(line: str) -> bool:
    return not line or line.isspace()


def _windows(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Spans and hashes of the windows of a text.

    A window is two neighbouring lines, unless both are blank, or runs from a line over three or more
    blank lines to the next line with text, so that the inner ones of them go with a repeated block.
    """
    if len(lines) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    code = _line_codes(lines)
    filled = ~np.fromiter(map(_blank, lines), bool, len(lines))
    pair = np.flatnonzero(filled[:-1] | filled[1:])
    at = np.flatnonzero(filled)
    gap = np.diff(at)
    a, b, gap = at[:-1][gap > 3], at[1:][gap > 3], gap[gap > 3]
    return np.concatenate([_span(pair, pair + 2), _span(a, b + 1)]), np.concatenate(
        [mix(code[pair] * _BASE + code[pair + 1]), mix(mix(code[a] * _BASE + code[b]) + gap.astype(np.uint64))]
    )


def _repeats(
    docs: DataFrame,
    pieces: Callable[[list[str]], tuple[np.ndarray, np.ndarray]],
    apart: Callable[[Column, Column], Column],
    bits: int = 64,
    removed: DataFrame | None = None,
) -> DataFrame:
    """Spans of the pieces of each row that occur earlier in the corpus.

    ``pieces`` gives spans and hashes of the pieces of a text, of which ``bits`` bits are used. ``apart`` says
    whether two spans of one text are far enough from each other. Without ``removed`` a piece inside a larger
    candidate of its text is left out; with it (a result of this function) a piece inside one of its spans.

    Columns doc_id, key (see ``row_key``), drop (array of spans, ascending). Occurrences are
    ordered by doc_id (null last), key and place. Rows that agree in both doc_id and text
    count as one document: they take nothing from one another.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            found = [pieces(t.split("\n") if t else []) for t in batch.column(2).to_pylist()]
            row = pa.array(np.repeat(np.arange(batch.num_rows), [len(n) for n, _ in found]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(row),
                    batch.column(1).take(row),
                    pa.array(np.concatenate([n for n, _ in found])),
                    pa.array((np.concatenate([c for _, c in found]) >> np.uint64(64 - bits)).view(np.int64)),
                ],
                plain,
            )
            del batch, found, row
        give_back()

    def open_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            rows, kept = [], []
            for n, (wanted, gone) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                spans = np.array([w["span"] for w in wanted], np.int64)
                keep = _outermost(spans) if largest else _outside(spans, np.array(gone or [], np.int64))
                if keep.any():
                    rows.append(n)
                    kept.append([w for w, k in zip(wanted, keep.tolist()) if k])
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(kept, batch.column(2).type)],
                ["doc_id", "key", "wanted"],
            )

    def bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, 256):
            out = []
            for i, k, text, wanted in zip(*(c.to_pylist() for c in batch.columns)):
                lines = text.split("\n")
                for w in wanted:
                    a, z = _lines_of(w["span"])
                    out.append((i, k, w["span"], w["code"], "\n".join(lines[a:z])))
            columns = list(zip(*out)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], [*plain, "body"])
            del batch, out, columns
        give_back()

    largest = removed is None
    plain = ["doc_id", "key", "span", "code"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key(F.col("text")).alias("key"), "text")
    found = freeze(texts.mapInArrow(count, "doc_id long, key long, span long, code long"))
    repeated = found.groupBy("code").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("code")
    wanted = (
        attach(found, repeated, ["code"], how="left_semi")
        .groupBy("doc_id", "key")
        .agg(F.collect_set(F.struct("span", "code")).alias("wanted"))
    )
    if largest:
        wanted = wanted.withColumn("drop", F.lit(None).cast("array<bigint>"))
    else:
        wanted = attach(wanted, removed, ["doc_id", "key"], match_nulls=True)
    wanted = wanted.mapInArrow(open_only, "doc_id long, key long, wanted array<struct<span:bigint,code:bigint>>")
    candidates = freeze(
        attach(texts, wanted, ["doc_id", "key"], how="inner", match_nulls=True).mapInArrow(
            bodies, "doc_id long, key long, span long, code long, body string"
        )
    )
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("key"), F.col("span"))

    def firsts(of: DataFrame) -> DataFrame:
        return of.groupBy("code", "body").agg(F.min(order).alias("_first"), F.max(order).alias("_last"))

    # The bytes are compared once, where equal ones meet; if all of a code are equal, the code stands for them.
    by_code = freeze(
        firsts(candidates).select("code", "_first", "_last")
        .groupBy("code").agg(F.count(F.lit(1)).alias("_n"), F.min("_first").alias("_first"), F.max("_last").alias("_last"))
    )
    owners = by_code.where("_n = 1 and _first < _last").select("code", "_first")
    later = attach(candidates.select(plain), owners, ["code"], how="inner", broadcast_bytes=SMALL_BYTES)
    clash, clashes, _ = freeze_measured(by_code.where("_n > 1").select("code"))
    if clashes:
        same = freeze(attach(candidates, clash, ["code"], how="left_semi"))
        owners = firsts(same).where("_first < _last").select("code", "body", "_first")
        same = attach(same, owners, ["code", "body"], how="inner", broadcast_bytes=SMALL_BYTES)
        later = later.unionByName(same.select(*plain, "_first"))
    one_text = F.col("doc_id").eqNullSafe(F.col("_first.doc_id")) & (F.col("key") == F.col("_first.key"))
    return (
        later.where((order > F.col("_first")) & (~one_text | apart(F.col("span"), F.col("_first.span"))))
        .groupBy("doc_id", "key")
        .agg(F.sort_array(F.collect_set("span")).alias("drop"))
    )


def repeated_chunks(
    docs: DataFrame, spacings: Sequence[int] = SPACINGS, least: int = LEAST_CHUNK, bits: int = 64
) -> DataFrame:
    """Spans of the content-defined chunks of each row that occur earlier in the corpus (see ``_repeats``)."""
    return _repeats(
        docs,
        partial(_chunk_spans, spacings=tuple(spacings), least=least),
        lambda span, first: F.shiftright(span, 32) >= first.bitwiseAND(F.lit(0xFFFFFFFF)),
        bits,
    )


def repeated_windows(docs: DataFrame, bits: int = 64, removed: DataFrame | None = None) -> DataFrame:
    """Spans of the windows of each row that occur earlier in the corpus and lie in no span of ``removed``.

    Within one text a window is no repeat of one that it overlaps: of a line that stands there three times
    in a row nothing goes.
    """
    # Every window is looked at, also one that lies in a longer one over blank lines.
    if removed is None:
        removed = docs.sparkSession.createDataFrame([], "doc_id long, key long, drop array<bigint>")
    return _repeats(
        docs, _windows, lambda span, first: F.shiftright(span, 32) - F.shiftright(first, 32) >= 2, bits, removed
    )


def repeated_blocks(docs: DataFrame, bits: int = 64) -> DataFrame:
    """Spans of all repeated blocks: chunks at all spacings, then the windows that these leave."""
    coarse = freeze(repeated_chunks(docs, bits=bits))
    fine = repeated_windows(docs, bits, coarse)
    return (
        coarse.unionByName(fine).groupBy("doc_id", "key")
        .agg(F.sort_array(F.flatten(F.collect_list("drop"))).alias("drop"))
    )


def _kept_lines(text: str, drop, whole: bool) -> tuple[str, int]:
    """The text without the lines of the spans, and how many they are.

    Unless ``whole``, a span goes as far as its windows do: of blank lines at its rim one goes.
    """
    lines = text.split("\n")
    gone = np.zeros(len(lines), bool)
    for a, z in map(_lines_of, map(int, drop)):
        if not whole:
            filled = [n for n in range(a, z) if not _blank(lines[n])]
            a, z = max(a, filled[0] - 1), min(z, filled[-1] + 2)
        gone[a:z] = True
    return "\n".join(line for line, g in zip(lines, gone) if not g), int(gone.sum())


def _remove(docs: DataFrame, drops: DataFrame, kept: Callable[..., tuple[str, int]]) -> DataFrame:
    @F.pandas_udf("text string, n_removed int")
    def cut(texts: pd.Series, drops: pd.Series) -> pd.DataFrame:
        out = [
            (None, 0) if drop is None or text is None else kept(text, drop)
            for text, drop in zip(texts, drops)
        ]
        give_back()
        return pd.DataFrame(out, columns=["text", "n_removed"])

    # A caller's filter on the result would otherwise be pushed below it and cut every text a second time.
    cut = cut.asNondeterministic()
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        row_key(F.col("text")).alias("key"),
    )
    joined = attach(rows, drops, ["doc_id", "key"], match_nulls=True).withColumn(
        "new", cut(F.when(F.col("drop").isNotNull(), F.col("row.text")), F.col("drop"))
    )
    text = F.when(F.col("drop").isNotNull(), F.col("new.text")).otherwise(F.col("row.text"))
    return joined.select(
        F.col("row").withField("text", text).alias("row"),
        F.col("new.n_removed").alias("n_removed"),
    )


def remove_repeated_blocks(docs: DataFrame) -> DataFrame:
    """Remove every block of two or more lines that occurs earlier in the corpus.

    Returns all columns of ``docs`` with the new text in ``text``, as a struct ``row``, and n_removed, the number
    of lines removed. Kept lines stay as they are, in order, and the first occurrence of a line always stays.

    Null and empty texts and texts of one line pass unchanged; so do blocks of blank lines, and blank lines
    beyond the first at a block's rim. Rows that agree in doc_id and text get the same result. Only doc_id
    and text are looked at, so other columns may have any name. An empty table gives an empty result.
    """
    return _remove(docs, repeated_blocks(docs), partial(_kept_lines, whole=False))


def remove_repeated_lines(docs: DataFrame, spacing: int = SPACING, least: int = LEAST_LINES) -> DataFrame:
    """``remove_repeated_blocks`` for whole content-defined chunks of ``least`` or more lines only."""
    return _remove(docs, repeated_chunks(docs, (spacing,), least), partial(_kept_lines, whole=True))
