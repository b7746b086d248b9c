"""Near-duplicate documents by ProbMinHash, banding and exact verification.

Shingles of five tokens, weighted by how often they occur in their document. ProbMinHash: every shingle
is a Poisson process whose rate is its weight, with arrivals spread over the registers of
the signature; a register keeps the shingle that arrives first, and a process is left as soon as
its next arrival is later than every register's. The share of equal registers estimates the
probability Jaccard similarity, which for equal weights is the Jaccard similarity of the sets. A document
with unequal weights has a second signature with all weights 1, so that both similarities are searched.
Documents that agree in a band of registers are candidates; a candidate pair is linked if its exact
probability Jaccard or set Jaccard similarity reaches the threshold. Linked documents form groups.

Scale and skew. Equal texts are one class from the start, so copies never meet in a bucket. In buckets
of up to ``small`` classes every pair is a candidate, and buckets with equal members count once. In a
larger bucket every class is compared with one centre, the member that shares most
buckets with others; only classes that this leaves outside the centre's group are then
compared with the bucket, in blocks of bounded size, where the shared shingles of all pairs are
counted at once and only links that join groups leave the task. So nothing is capped, no
bucket is gathered, and a large group of near copies costs one pair per member.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.llm.components import components
from panelforge.llm.words import blocks, give_back, mix, rolling, token_hashes
from panelforge.llm.words import small as small_batches
from panelforge.operators.joins import attach
from panelforge.operators.topk import first_per_key
from panelforge.runtime import freeze

SHINGLE = 5
THRESHOLD = 0.8
# A prime, so that steps through the registers visit each of them once.
REGISTERS = 127
BANDS, ROWS = 25, 5
SMALL_BUCKET = 16
BLOCK_ROWS = 512
BLOCK_BYTES = 2 << 20

_TEXT_BLOCK = 512 << 10
_COLUMNS = 1024
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_STEPS = np.arange(1, REGISTERS + 1).astype(np.uint64) * _GOLDEN


def shingles(texts: list[str | None], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash and count of the distinct shingles of several texts, by row and hash.

    A text with fewer tokens than a shingle has one shingle of all of them; without tokens, none.
    """
    codes, first = token_hashes(texts)
    n = np.diff(first)
    row = np.repeat(np.arange(len(texts)), n)
    start = np.arange(len(codes))
    rolled = rolling(codes, size)
    full = (first[row + 1] - start)[: len(rolled)] >= size
    rows, values = [row[: len(rolled)][full]], [rolled[full]]
    for k in range(1, size):
        at = first[:-1][n == k]
        if len(at):
            rows.append(row[at])
            values.append(rolling(codes, k)[at])
    rows, values = np.concatenate(rows), np.concatenate(values)
    order = np.lexsort((values, rows))
    rows, values = rows[order], values[order]
    new = np.flatnonzero(np.append(True, (rows[1:] != rows[:-1]) | (values[1:] != values[:-1]))) if len(rows) else []
    return rows[new], values[new], np.diff(np.append(new, len(rows))).astype(np.int64)


def signatures(rows: np.ndarray, codes: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    """ProbMinHash signatures of n documents from their weighted shingles: n x REGISTERS, 16 bits each.

    The i-th arrival of a process comes after an exponential waiting time at the rate
    of the registers it has not hit yet, so every process ends after REGISTERS arrivals at most.
    """
    m = REGISTERS
    best = np.full(n * m, np.inf)
    kept = np.zeros(n * m, np.uint16)
    place = mix(codes ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    at = (place % np.uint64(m)).astype(np.int64)
    step = ((place >> np.uint64(32)) % np.uint64(m - 1)).astype(np.int64) + 1
    mark = (place >> np.uint64(8)).astype(np.uint16)
    base, weight = rows * m, counts.astype(np.float64)
    time = np.zeros(len(rows))
    for i in range(m):
        draw = (mix(codes + _STEPS[i]) >> np.uint64(11)).astype(np.float64)
        time = time - np.log((draw + 0.5) / (1 << 53)) * (m / (m - i)) / weight
        # No later arrival can matter in a document whose registers are all earlier.
        last = best.reshape(n, m).max(axis=1)
        alive = time < last[base // m]
        if not alive.all():
            base, weight, codes, time = base[alive], weight[alive], codes[alive], time[alive]
            at, step, mark = at[alive], step[alive], mark[alive]
        if not len(base):
            break
        slot = base + at
        np.minimum.at(best, slot, time)
        won = best[slot] == time
        kept[slot[won]] = mark[won]
        at = (at + step) % m
    return kept.reshape(n, m)


def similarity(a: tuple, b: tuple) -> tuple[float, float]:
    """Exact set Jaccard and probability Jaccard of two documents' shingles (sorted hashes, counts)."""
    (x, wx), (y, wy) = a, b
    union = np.union1d(x, y)
    p, q = np.zeros(len(union)), np.zeros(len(union))
    p[np.searchsorted(union, x)] = wx
    q[np.searchsorted(union, y)] = wy
    both = (p > 0) & (q > 0)
    if not both.any():
        return 0.0, 0.0
    # sum over d' of max(p'/p, q'/q): p' counts where p'/q' is at least p/q, else q' does.
    ratio = np.divide(p, q, out=np.full(len(p), np.inf), where=q > 0)
    order = np.argsort(ratio, kind="stable")
    ranked = ratio[order]
    at = np.searchsorted(ranked, ratio[both])
    above = np.append(np.cumsum(p[order][::-1])[::-1], 0)[at]
    below = np.append(0, np.cumsum(q[order]))[at]
    return both.mean(), float((1 / (above / p[both] + below / q[both])).sum())


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches):
        texts = batch.column("text").to_pylist()
        at = np.cumsum([0, *(len(t or "") for t in texts)])
        out: list[bytes | None] = []
        for i, j in blocks(at, _TEXT_BLOCK):
            rows, codes, counts = shingles(texts[i:j])
            some, unequal = np.zeros(j - i, bool), np.zeros(j - i, bool)
            some[rows] = True
            unequal[rows[counts > 1]] = True
            signed = [s.tobytes() if has else None for s, has in zip(signatures(rows, codes, counts, j - i), some)]
            if unequal.any():
                # All weights 1: appended where it makes a difference.
                nth, part = np.cumsum(unequal) - 1, unequal[rows]
                ones = signatures(nth[rows[part]], codes[part], np.ones(part.sum(), np.int64), int(unequal.sum()))
                for r, one in zip(np.flatnonzero(unequal).tolist(), ones):
                    if (one := one.tobytes()) != signed[r]:
                        signed[r] += one
            out += signed
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("h"), pa.array(out, pa.binary())], ["doc_id", "h", "sig"]
        )
        del batch, texts, out
    give_back()


def _band(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = mix(np.arange(1, BANDS + 1).astype(np.uint64))
    for batch in batches:
        sigs = batch.column("sig").to_pylist()
        sig = np.frombuffer(b"".join(sigs), np.uint16).reshape(-1, REGISTERS)
        # Both signatures of a document go to the same buckets: with equal weights it has only one.
        of = np.repeat(np.arange(len(sigs)), [len(s) // (2 * REGISTERS) for s in sigs])
        used = sig[:, : BANDS * ROWS].reshape(len(of), BANDS, ROWS).astype(np.uint64)
        code = np.tile(number, (len(of), 1))
        for k in range(ROWS):
            code = mix(code * _GOLDEN + used[:, :, k])
        new = np.ones(code.shape, bool)
        new[1:] = (of[1:] != of[:-1])[:, None] | (code[1:] != code[:-1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(code[new].view(np.int64)), batch.column("h").take(pa.array(np.repeat(of, new.sum(axis=1))))],
            ["code", "h"],
        )


def _list_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches):
        texts = batch.column("text").to_pylist()
        at = np.cumsum([0, *(len(t or "") for t in texts)])
        codes_out, counts_out = [], []
        for i, j in blocks(at, _TEXT_BLOCK):
            rows, codes, counts = shingles(texts[i:j])
            cut = np.searchsorted(rows, np.arange(j - i + 1))
            codes_out += [codes[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])]
            counts_out += [counts[a:b].astype(np.uint32).tobytes() if (counts[a:b] > 1).any() else b"" for a, b in zip(cut[:-1], cut[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column("h"), pa.array(codes_out, pa.binary()), pa.array(counts_out, pa.binary())],
            ["h", "codes", "counts"],
        )
        del batch, texts, codes_out, counts_out
    give_back()


def _weighted(codes: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    x = np.frombuffer(codes, np.uint64)
    return x, np.frombuffer(counts, np.uint32) if counts else np.ones(len(x), np.uint32)


def _verify(threshold: float):
    def check(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            linked = [
                max(similarity(_weighted(ca, na), _weighted(cb, nb))) >= threshold
                for ca, na, cb, nb in zip(f["codes_a"], f["counts_a"], f["codes_b"], f["counts_b"])
            ]
            yield f.loc[linked, ["a", "b"]]
            del f
        give_back()

    return check


def _listed(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """Shingles of the given texts alone: h, codes, counts."""
    return freeze(
        attach(texts, nodes, ["h"], how="left_semi")
        .mapInArrow(_list_shingles, "h binary, codes binary, counts binary")
        .dropDuplicates(["h"])
    )


def _linked(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose texts are similar."""
    nodes = pairs.select(F.col("a").alias("h")).unionByName(pairs.select(F.col("b").alias("h"))).distinct()
    listed = _listed(nodes, texts)

    def side(name: str) -> DataFrame:
        return listed.select(
            F.col("h").alias(name), F.col("codes").alias(f"codes_{name}"), F.col("counts").alias(f"counts_{name}")
        )

    joined = pairs.join(side("b"), "b").join(side("a"), "a")
    return freeze(joined.mapInPandas(_verify(threshold), "a binary, b binary"))


def _shared(x: list[tuple], y: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """For each of x and each of y (codes, counts): how many codes they have in common, and at most
    what their probability Jaccard similarity is (the smaller share of weight in common)."""
    both = [*x, *y]
    values, column = np.unique(np.concatenate([c for c, _ in both]), return_inverse=True)
    rows = np.repeat(np.arange(len(both)), [len(c) for c, _ in both])
    weight = np.concatenate([n / n.sum() for _, n in both])
    often = np.bincount(column, minlength=len(values)) > 1
    number = np.cumsum(often) - 1
    kept = np.flatnonzero(often[column])
    kept = kept[np.argsort(number[column[kept]], kind="stable")]
    rows, column, weight = rows[kept], number[column[kept]], weight[kept]
    count, mass_x, mass_y = (np.zeros((len(x), len(y)), np.float32) for _ in range(3))
    for lo in range(0, int(often.sum()), _COLUMNS):
        part = slice(*np.searchsorted(column, (lo, lo + _COLUMNS)))
        has = np.zeros((len(both), _COLUMNS), np.float32)
        has[rows[part], column[part] - lo] = 1
        count += has[: len(x)] @ has[len(x) :].T
        share = np.zeros_like(has)
        share[rows[part], column[part] - lo] = weight[part]
        mass_x += share[: len(x)] @ has[len(x) :].T
        mass_y += has[: len(x)] @ share[len(x) :].T
    return count, np.minimum(mass_x, mass_y)


def _join_groups(some: pd.DataFrame, every: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links between two blocks that join different groups, enough of them to join all that
    are linked."""
    x = [_weighted(c, n) for c, n in zip(some["codes"], some["counts"])]
    y = [_weighted(c, n) for c, n in zip(every["codes"], every["counts"])]
    shared, most = _shared(x, y)
    sizes_x, sizes_y = (np.array([len(c) for c, _ in v], np.float32) for v in (x, y))
    jaccard = shared / np.maximum(sizes_x[:, None] + sizes_y - shared, 1)
    group: dict[bytes, bytes] = {}

    def find(g: bytes) -> bytes:
        while group.get(g, g) != g:
            g = group[g]
        return g

    a, b = [], []
    roots_x, roots_y = some["root"].tolist(), every["root"].tolist()
    ids_x, ids_y = some["h"].tolist(), every["h"].tolist()
    # The exact similarities decide; these only leave out pairs that cannot reach the threshold.
    for i, j in np.argwhere((jaccard >= threshold - 1e-4) | (most >= threshold - 1e-4)).tolist():
        one, other = find(roots_x[i]), find(roots_y[j])
        if one != other and max(similarity(x[i], y[j])) >= threshold:
            group[one] = other
            a.append(min(ids_x[i], ids_y[j]))
            b.append(max(ids_x[i], ids_y[j]))
    return pd.DataFrame({"a": a, "b": b})


def _outside(members: DataFrame, texts: DataFrame, roots: DataFrame, centres: DataFrame, threshold: float) -> DataFrame:
    """More links of large buckets with a class outside the centre's group.

    Each such class is compared with its whole bucket, in blocks of at most BLOCK_ROWS rows and about
    BLOCK_BYTES of shingles, so a task's work is bounded whatever the bucket's size.
    """
    rooted = (
        members.join(roots.withColumnRenamed("node", "h"), "h", "left")
        .withColumn("root", F.coalesce("root", "h"))
        .join(centres.join(roots.withColumnRenamed("node", "centre"), "centre", "left")
              .select("code", F.coalesce("root", "centre").alias("main")), "code")
    )
    rooted = freeze(rooted.select("code", "h", "root", (F.col("root") != F.col("main")).alias("out")))
    open_ = rooted.where("out").select("code").distinct()
    left = freeze(attach(rooted, open_, ["code"], how="left_semi"))
    # Buckets with the same classes are compared once.
    same = left.groupBy("code").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("h")).alias("set"))
    once = same.groupBy("n", "set").agg(F.min("code").alias("code")).select("code")
    left = attach(left, once, ["code"], how="left_semi").join(_listed(left.select("h").distinct(), texts), "h")
    sizes = left.groupBy("code").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.octet_length("codes")).alias("bytes"),
        F.count_if("out").alias("n_out"),
        F.sum(F.when(F.col("out"), F.octet_length("codes")).otherwise(0)).alias("bytes_out"),
    )
    parts = lambda n, size: F.greatest(F.ceil(F.col(n) / BLOCK_ROWS), F.ceil(F.col(size) / BLOCK_BYTES))
    split = freeze(
        left.join(sizes, "code").withColumn("blocks", parts("n", "bytes")).withColumn("out_blocks", parts("n_out", "bytes_out"))
    )
    columns = ["code", "i", "j", "h", "root", "codes", "counts"]
    every = split.withColumn("j", F.pmod(F.xxhash64("h"), F.col("blocks"))).withColumn(
        "i", F.explode(F.expr("sequence(0L, out_blocks - 1)"))
    )
    some = (
        split.where("out")
        .withColumn("i", F.pmod(F.xxhash64("h", F.lit(1)), F.col("out_blocks")))
        .withColumn("j", F.explode(F.expr("sequence(0L, blocks - 1)")))
    )
    # Both sides come from one table; new names keep their columns apart.
    some = some.select(*(F.col(c).alias(f"_{c}") for c in columns))

    def compare(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        links = _join_groups(x.set_axis(columns, axis=1), y, threshold)
        give_back()
        return links

    return freeze(
        some.groupBy("_code", "_i", "_j")
        .cogroup(every.select(columns).groupBy("code", "i", "j"))
        .applyInPandas(compare, "a binary, b binary")
        .distinct()
    )


def text_class(text: Column) -> Column:
    """What equal texts share; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, small: int = SMALL_BUCKET) -> DataFrame:
    """The group of every row of ``docs`` (doc_id, text).

    Returns doc_id, class_id (the smallest doc_id of the group), h (of the text, see ``text_class``) and keep: true in
    one row per group, or in several if rows agree in doc_id and text.

    Equal texts are always one group, so are all null and empty texts. Texts without tokens
    have no other relatives. Rows without doc_id come last in the order; a group of such rows alone
    has class_id null. Ties go to the smaller hash of the text. An empty table gives an
    empty result. Other columns are not looked at.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_class(F.col("text")).alias("h"), "text")
    rows = freeze(source.mapInArrow(_sign, "doc_id long, h binary, sig binary"))
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")
    classes = freeze(rows.groupBy("h").agg(F.min(rank).alias("first"), F.first("sig").alias("sig")))
    sigs = classes.where("sig IS NOT NULL").select("h", "sig")
    banded = sigs.mapInArrow(_band, "code long, h binary")
    sizes = banded.groupBy("code").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = freeze(attach(banded, sizes, ["code"], how="inner"))

    few = (
        members.where(F.col("n") <= small)
        .groupBy("code")
        .agg(F.sort_array(F.collect_list("h")).alias("hs"))
        .select("hs")
        .distinct()
        .select(F.explode(F.expr(
            "flatten(transform(hs, (x, i) -> transform(slice(hs, i + 2, size(hs)), y -> struct(x AS a, y AS b))))"
        )).alias("p"))
        .select("p.a", "p.b")
    )
    many = members.where(F.col("n") > small)
    # The member that shares most buckets with most others lies in the middle of its group.
    shared = members.groupBy("h").agg(F.sum("n").alias("shared"))
    many = freeze(many.join(shared, "h"))
    centres = freeze(
        many.groupBy("code").agg(F.max(F.struct("shared", "h")).alias("c")).select("code", F.col("c.h").alias("centre"))
    )
    star = attach(many, centres, ["code"], how="inner").where("h <> centre").select(
        F.least("h", "centre").alias("a"), F.greatest("h", "centre").alias("b")
    )
    texts = source.select("h", "text")
    links = _linked(freeze(few.unionByName(star).distinct()), texts, threshold)
    roots = components(links)
    if not centres.isEmpty():
        more = _outside(many, texts, roots, centres, threshold)
        if not more.isEmpty():
            # Groups so far are stars; the new links join some of them.
            roots = components(
                roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more)
            )

    grouped = classes.select("h", "first").join(roots.withColumnRenamed("node", "h"), "h", "left").withColumn(
        "root", F.coalesce("root", "h")
    )
    heads = grouped.groupBy("root").agg(F.min("first").alias("head"))
    found = grouped.join(heads, "root").select("h", "head")
    return rows.select("doc_id", "h").join(found, "h").select(
        "doc_id", F.col("head.doc_id").alias("class_id"), "h", (rank == F.col("head")).alias("keep")
    )


def one_per_group(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs``, with all columns, without the rows that ``near_duplicates`` does not keep.

    Of rows that agree in doc_id and text one is kept, the first by its other columns.
    """
    found = freeze(near_duplicates(docs, threshold))
    gone = found.where("NOT keep").select("doc_id", "h").distinct()
    repeats = (
        found.where("keep").groupBy("doc_id", "h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id", "h")
    )
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text_class(F.col("text")).alias("h"))
    kept = attach(rows, gone, ["doc_id", "h"], how="left_anti", match_nulls=True)
    repeats = freeze(repeats)
    if repeats.isEmpty():
        return kept.select("row.*")
    once = attach(kept, repeats, ["doc_id", "h"], how="left_anti", match_nulls=True)
    several = attach(kept, repeats, ["doc_id", "h"], how="left_semi", match_nulls=True)
    order = [F.to_json("row")]
    return once.unionByName(first_per_key(several, ["doc_id", "h"], order, ties=[])).select("row.*")
