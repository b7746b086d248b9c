"""The prefix trie of conversations whose heads are exchanged, by composable fingerprints.

Every conversation is rebuilt from the head of its family's first conversation and its own turns behind its
own head. The rebuilt texts are never made: a sequence of turns has the fingerprint sum(e_i * B**i) modulo
four primes, and these form a monoid, (n, f) + (m, g) = (n + m, f + B**n * g). So the fingerprint of every
rebuilt prefix is that of a base's head combined with that of an own suffix, both kept once.

Prefixes with one depth and fingerprint are a node. A turn stands in it by reference, the 128-bit code
of its role and text, and each group verifies that all its members end in one turn and come from one
parent; codes are verified against roles and texts. If any of these fails, all starts anew with another seed, so
nodes are exact.

Scale. Running products are sums over ordered slices (``running``): a conversation of any length spreads. Nodes are
aggregated with partial sums, so the root and a common first turn are no hot spots. A node belongs to its
smallest member, which cuts the trie into one chain a conversation; the chains form a tree, whose subtree sums
take a number of rounds that follows the logarithm of its height, and along a chain they are running sums
again. Lists of conversations that end in a node are hashed as a stream of packed pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.llm.running import in_order, running
from panelforge.llm.tables import partitions
from panelforge.operators.joins import attach
from panelforge.runtime import freeze

FAMILY = 20
HEADS = 4

# The four largest primes below 2**31; products of two residues fit in a long.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
_DIGITS, _PLACES = 10, 3
_NODE = ["depth", "f1", "f2"]
_PIECE = 1 << 20
WORDS = r"[^\x20\x09-\x0D]+"


def _bases(seed: int) -> list[int]:
    return [int(np.random.default_rng([seed, lane]).integers(1 << 20, p)) for lane, p in enumerate(PRIMES)]


def _power(base: int, prime: int, exponent: Column) -> Column:
    """base ** exponent modulo prime, from three tables of 1024 powers each."""
    out = None
    for place in range(_PLACES):
        step = pow(base, 1 << (_DIGITS * place), prime)
        table = [1]
        for _ in range((1 << _DIGITS) - 1):
            table.append(table[-1] * step % prime)
        digit = F.shiftright(exponent, _DIGITS * place).bitwiseAND(F.lit((1 << _DIGITS) - 1)).cast("int")
        value = F.get(F.lit(np.array(table, np.int64)), digit)
        out = value if out is None else out * value % F.lit(prime)
    return out


def _elements(code1: Column, code2: Column) -> list[Column]:
    """The residues that a turn's code stands for, one a prime."""
    parts = (code1, F.shiftrightunsigned(code1, 31), code2, F.shiftrightunsigned(code2, 31))
    return [F.pmod(part, F.lit(p)) for part, p in zip(parts, PRIMES)]


def _packed(lanes: list[Column]) -> tuple[Column, Column]:
    return (
        F.shiftleft(lanes[0], 31).bitwiseOR(lanes[1]),
        F.shiftleft(lanes[2], 31).bitwiseOR(lanes[3]),
    )


def _codes(seed: int) -> tuple[Column, Column]:
    role, text = F.col("role"), F.col("text")
    return tuple(F.xxhash64(F.lit(seed), F.lit(k), F.octet_length(role), role, text) for k in (1, 2))


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role and text of every row with a conv_id; missing role and text are empty."""
    return conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def _own_turns(turns: DataFrame, seed: int) -> DataFrame:
    """Every turn by its position, with its code, its words, h, and the running fingerprint of the own suffix."""
    code1, code2 = _codes(seed)
    cut = in_order(
        turns,
        "conv_id",
        [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")],
        {"code1": code1, "code2": code2, "words": F.regexp_count("text", F.lit(WORDS)).cast("long")},
    )
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    placed = running(cut, "conv_id", {"pos": F.lit(1).cast("long")}).withColumn("h", h)
    elements = _elements(F.col("code1"), F.col("code2"))
    at = F.greatest(F.col("pos") - F.col("h") - 1, F.lit(0))
    terms = {
        f"t{k}": F.when(F.col("pos") > F.col("h"), e * _power(b, p, at) % F.lit(p)).otherwise(F.lit(0))
        for k, (e, b, p) in enumerate(zip(elements, _bases(seed), PRIMES))
    }
    placed = freeze(placed.select("*", *(c.alias(n) for n, c in terms.items())))
    summed = running(placed, "conv_id", {f"s{k}": F.col(f"t{k}") for k in range(4)})
    return summed.withColumns({f"s{k}": F.col(f"s{k}") % F.lit(p) for k, p in enumerate(PRIMES)})


def _conversations(own: DataFrame, seed: int) -> DataFrame:
    """Per conversation: its turns ``n``, h, the borrowed head (its turns and fingerprints) and the rebuilt length."""
    first = own.where(f"pos < {HEADS} AND conv_id % {FAMILY} = 0")
    heads = first.groupBy(F.col("conv_id").alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "code1", "code2", "words"))).alias("head")
    )
    convs = own.groupBy("conv_id").agg(F.max("pos").alias("n"), F.first("h").alias("h"))
    convs = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY).join(heads, "base", "left")
    head = F.slice(F.coalesce("head", F.array().cast("array<struct<pos:bigint,code1:bigint,code2:bigint,words:bigint>>")), 1, F.col("h"))
    convs = convs.withColumn("head", F.when(F.col("h") > 0, head).otherwise(F.slice(head, 1, 0)))
    k = F.size("head")
    # Fingerprints of the head's prefixes of 0 to 3 turns.
    values = [[F.lit(0).cast("long")] for _ in PRIMES]
    for i in range(HEADS - 1):
        turn = F.get("head", F.lit(i))
        for lane, (e, b, p) in enumerate(zip(_elements(turn["code1"], turn["code2"]), _bases(seed), PRIMES)):
            values[lane].append(F.coalesce((values[lane][-1] + e * F.lit(pow(b, i, p))) % F.lit(p), F.lit(0)))
    prefixes = [F.struct(*(values[lane][i].alias(f"h{lane}") for lane in range(4))) for i in range(HEADS)]
    return convs.select(
        "conv_id", "n", F.col("h").cast("long").alias("h"), "head", k.cast("long").alias("k"),
        F.array(*prefixes).alias("prefix"),
        (k + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"),
    )


def _prefixes(own: DataFrame, convs: DataFrame, seed: int) -> DataFrame:
    """Every rebuilt prefix but the empty one: conv_id, depth, fingerprint f, parent's fingerprint g, last turn."""

    def shaped(rows: DataFrame, now: list[Column], before: list[Column], last: Column) -> DataFrame:
        (f1, f2), (g1, g2) = _packed(now), _packed(before)
        return rows.select(
            "conv_id", "depth", f1.alias("f1"), f2.alias("f2"), g1.alias("g1"), g2.alias("g2"), "code1", "code2",
            "words", last.alias("last"),
        )

    borrowed = convs.select("conv_id", "length", "prefix", F.posexplode("head").alias("i", "turn")).select(
        "conv_id", "length", F.get("prefix", F.col("i")).alias("then"), F.get("prefix", F.col("i") + 1).alias("now"),
        (F.col("i") + 1).cast("long").alias("depth"), "turn.code1", "turn.code2", "turn.words",
    )
    heads = shaped(
        borrowed, [F.col(f"now.h{k}") for k in range(4)], [F.col(f"then.h{k}") for k in range(4)], F.col("depth") == F.col("length")
    )
    whole = F.get("prefix", F.col("k").cast("int"))
    side = convs.select("conv_id", "k", "length", *(whole[f"h{k}"].alias(f"h{k}") for k in range(4)))
    rows = attach(own.where("pos > h"), side, ["conv_id"]).withColumn("depth", F.col("k") + F.col("pos") - F.col("h"))
    now, before = [], []
    for lane, (b, p) in enumerate(zip(_bases(seed), PRIMES)):
        shift = F.get(F.array(*(F.lit(pow(b, i, p)) for i in range(HEADS))), F.col("k").cast("int"))
        s, t, head = F.col(f"s{lane}"), F.col(f"t{lane}"), F.col(f"h{lane}")
        now.append((head + shift * s % F.lit(p)) % F.lit(p))
        before.append((head + shift * F.pmod(s - t, F.lit(p)) % F.lit(p)) % F.lit(p))
    return heads.unionByName(shaped(rows, now, before, F.col("depth") == F.col("length")))


def _nodes(prefixes: DataFrame) -> DataFrame:
    """Prefixes by depth and fingerprint. ``wrong`` marks groups that hold more than one sequence."""
    same = ["g1", "g2", "code1", "code2"]
    grouped = prefixes.groupBy(*_NODE).agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.min("words").alias("words"),
        *(F.min(c).alias(c) for c in same),
        *(F.max(c).alias(f"_{c}") for c in same),
    )
    wrong = reduce(lambda a, b: a | b, (F.col(c) != F.col(f"_{c}") for c in same))
    return grouped.withColumn("wrong", wrong).drop("code1", "code2", *(f"_{c}" for c in same))


def _codes_clash(turns: DataFrame, seed: int) -> bool:
    """Do two different turns share a code?"""
    code1, code2 = _codes(seed)
    turn = F.struct("role", "text")
    groups = turns.groupBy(code1.alias("code1"), code2.alias("code2")).agg(F.min(turn).alias("a"), F.max(turn).alias("b"))
    return not groups.where("a <> b").isEmpty()


def _verified(conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Conversations, prefixes and nodes, with no two sequences in one node."""
    turns = turns_of(conversations)
    for seed in count():
        own = freeze(_own_turns(turns, seed))
        convs = freeze(_conversations(own, seed))
        prefixes = freeze(_prefixes(own, convs, seed))
        nodes = freeze(_nodes(prefixes))
        if nodes.where("wrong").isEmpty() and not _codes_clash(turns, seed):
            return convs, prefixes, nodes.drop("wrong")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (node, conv_id) to pieces of a node's list: the ids joined by commas."""
    names = [*_NODE, "first", "ids"]
    node, first, ids, size = None, None, [], 0

    def piece():
        return pa.RecordBatch.from_pydict(
            dict(zip(names, ([v] for v in (*node, first, ",".join(ids))))), schema=_PIECES
        )

    done: list[pa.RecordBatch] = []
    for batch in batches:
        for *key, conv in zip(*(c.to_pylist() for c in batch.columns)):
            if key != node or size > _PIECE:
                if ids:
                    done.append(piece())
                node, first, ids, size = key, conv, [], 0
            ids.append(str(conv))
            size += len(ids[-1]) + 1
        if done:
            yield from pa.Table.from_batches(done).combine_chunks().to_batches()
            done = []
    if ids:
        yield piece()


_PIECES = pa.schema([*((n, pa.int64()) for n in (*_NODE, "first")), ("ids", pa.string())])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces to one hash a node; a node's pieces follow each other."""
    names = [*_NODE, "ends_sha256"]
    node, state, done = None, None, []

    def flushed() -> pa.RecordBatch:
        columns = list(zip(*done))
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    for batch in batches:
        for a, b, c, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if (a, b, c) != node:
                if node:
                    done.append((*node, state.hexdigest()))
                node, state = (a, b, c), hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        if done:
            yield flushed()
            done = []
    if node:
        done.append((*node, state.hexdigest()))
        yield flushed()


def _ends(convs: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Per node in which conversations end: the hash of their ids in ascending order."""
    zero = F.lit(0).cast("long")
    empty = convs.where("length = 0").select(*(zero.alias(n) for n in _NODE), "conv_id")
    ends = prefixes.where("last").select(*_NODE, "conv_id").unionByName(empty)
    slices = partitions(ends.sparkSession)
    order = [*_NODE, "conv_id"]
    sorted_ = ends.repartitionByRange(slices, *order).sortWithinPartitions(*order)
    pieces = freeze(sorted_.mapInArrow(_pieces, "depth long, f1 long, f2 long, first long, ids string"))
    order = [*_NODE, "first"]
    by_node = pieces.repartition(slices, *_NODE).sortWithinPartitions(*order).select(*order, "ids")
    return by_node.mapInArrow(_hashed, "depth long, f1 long, f2 long, ends_sha256 string")


def _chain_totals(chains: DataFrame) -> DataFrame:
    """Sums of ``saved`` and ``leaf`` over each chain and all chains below it.

    Each round doubles the distance looked down: sums go to the ancestor ``up`` rounds away, and the
    ancestor of the ancestor is the next one.
    """
    state = freeze(chains.select("conv_id", "up", "saved", "leaf"))
    while not state.where("up IS NOT NULL").isEmpty():
        below = state.where("up IS NOT NULL").groupBy(F.col("up").alias("conv_id")).agg(
            F.sum("saved").alias("more_saved"), F.sum("leaf").alias("more_leaf")
        )
        further = state.select(F.col("conv_id").alias("up"), F.col("up").alias("next"))
        state = freeze(
            attach(state, further, ["up"])
            .join(below, "conv_id", "left")
            .select(
                "conv_id",
                F.col("next").alias("up"),
                (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
                (F.col("leaf") + F.coalesce("more_leaf", F.lit(0))).alias("leaf"),
            )
        )
    return state.select("conv_id", "saved", "leaf")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations.

    Columns conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and
    ends_sha256.

    Conversation c has h = crc32(c as text) % 4 and is the first h turns of conversation c - c % 20, then its own
    turns behind its first h. Turns are ordered by turn (null first), then role, then text; null roles
    and texts are empty, and repeated rows are turns of their own. Rows without conv_id belong to no
    conversation and are left out. Very long conversations and texts are taken whole. A conversation
    without turns after rebuilding ends in the root. An empty table has no node, not even a root. Other
    columns are not looked at, whatever their names.
    """
    convs, prefixes, nodes = _verified(conversations)
    zero = F.lit(0).cast("long")
    root = (
        convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
        .where("n_convs > 0")
        .select(
            *(zero.alias(n) for n in _NODE), "conv_id", "n_convs", zero.alias("words"),
            *(F.lit(None).cast("long").alias(n) for n in ("g1", "g2")),
        )
    )
    nodes = nodes.unionByName(root)
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("f1").alias("g1"), F.col("f2").alias("g2"), F.col("conv_id").alias("parent_conv_id")
    )
    children = nodes.where("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("g1").alias("f1"), F.col("g2").alias("f2")
    ).agg(F.count(F.lit(1)).alias("n_children"))
    tree = attach(nodes, parents, ["depth", "g1", "g2"]).join(children, _NODE, "left")
    tree = freeze(
        tree.select(
            *_NODE, "conv_id", "parent_conv_id", "n_convs",
            F.coalesce("n_children", zero).alias("n_children"),
            F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("leaf"),
            ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
        )
    )

    up = F.min("parent_conv_id")
    chains = tree.groupBy("conv_id").agg(
        F.when(up < F.col("conv_id"), up).alias("up"),
        (F.min("depth") - 1).alias("depth"),
        F.sum("saved").alias("saved"),
        F.sum("leaf").alias("leaf"),
    )
    chains = freeze(chains)
    hung = chains.where("up IS NOT NULL").select("conv_id", F.col("up").alias("_up"), "depth")
    hung = hung.join(_chain_totals(chains), "conv_id").groupBy(F.col("_up").alias("conv_id"), "depth").agg(
        F.sum("saved").alias("hung_saved"), F.sum("leaf").alias("hung_leaf")
    )
    weighed = tree.join(hung, ["conv_id", "depth"], "left")
    kept = ["depth", "f1", "f2", "parent_conv_id", "n_convs", "n_children"]
    cut = in_order(
        weighed,
        "conv_id",
        [F.col("depth").desc()],
        {
            **{c: F.col(c) for c in kept},
            "saved": F.col("saved") + F.coalesce("hung_saved", zero),
            "leaf": F.col("leaf") + F.coalesce("hung_leaf", zero),
        },
    )
    summed = running(cut, "conv_id", {"saved_tokens": F.col("saved"), "n_leaves": F.col("leaf")})
    none = hashlib.sha256(b"").hexdigest()
    return summed.join(_ends(convs, prefixes), _NODE, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
    )
