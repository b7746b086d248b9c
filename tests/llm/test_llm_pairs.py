"""Alignment, prefix trie and SimHash: against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_samples import CLASHES, SCHEMA, prose

from panelforge.llm import alignment, hashing, simhash, trie
from panelforge.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.01"


def components_plainly(nodes, linked) -> dict:
    """Smallest reachable node of each node."""
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if linked(a, b):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


# ---- op 11


@pytest.fixture(scope="module")
def tokenizers():
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def byte_letters() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b): b for b in kept} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in kept)}


def aligned_plainly(rows, tokenizers):
    """Whole texts by the two public encoders, every overlap of every two ranges."""
    one, two = tokenizers
    letters = byte_letters()

    def spans(parts):
        ends = np.cumsum([len(p) for p in parts]).tolist()
        return list(zip([0, *ends], ends))

    results, all_links = [], []
    for doc_id, text in rows:
        a, b, links, groups = [], [], Counter(), []
        if text:
            full = (" " + text).encode()
            a, b = one.encode(" " + text, add_special_tokens=False).ids, two.encode(text)
            raw_a = [bytes(letters[c] for c in one.id_to_token(i)) for i in a]
            raw_b = [
                bytes([int(two.id_to_piece(i)[3:5], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("▁", " ").encode()
                for i in b
            ]
            if b"".join(raw_a) != full or b"".join(raw_b) != full:
                a, b = [], []
        if a:
            at_a, at_b = spans(raw_a), spans(raw_b)
            low = 0
            for i, (start, end) in zip(a, at_a):
                while at_b[low][1] <= start:
                    low += 1
                for j in range(low, len(b)):
                    if at_b[j][0] >= end:
                        break
                    links[i, b[j]] += 1
            ends = sorted({e for _, e in at_a} & {e for _, e in at_b})
            for start, end in zip([0, *ends], ends):
                inside = [[i for i, (s, e) in zip(ids, at) if s >= start and e <= end] for ids, at in ((a, at_a), (b, at_b))] \
                    if len(ends) < 300 else None
                groups.append(inside)
        results.append((doc_id, len(a), len(b), len(groups), sum(links.values()), groups))
        all_links.append(links)
    counts = Counter(p for links in all_links for p in links)
    highest = defaultdict(int)
    for (x, _), n in counts.items():
        highest[x] = max(highest[x], n)
    out = []
    for (*fixed, groups), links in zip(results, all_links):
        best = sum(n for p, n in links.items() if counts[p] == highest[p[0]])
        text = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups) if None not in groups else None
        digest = None if text is None else hashlib.sha256(text.encode()).hexdigest() if text else ""
        out.append((*fixed, best, sum(n * counts[p] for p, n in links.items()), digest))
    return out


ODD_TEXTS = [
    "a  b", "\n x", " lead", "tr ", "ﬁ é <s> x <|endoftext|>", "x▁y", "a\nb c", "日本 語", "a\xa0 b\xa0\xa0\nx", "\x00a \x1c b",
    "", None, "   ", "\n\n\n  x", "x\r\n y\r\nz", "don't  I'll", "👍🏽 😀", "a　b   c", "é" * 300 + " end", "x" * 5000,
    "tab\tx \t y", "\r", "\u0085 q", "  ",
]


def test_alignment_equals_whole_texts(spark, tokenizers):
    """Units one by one against whole texts; many rounds and parts against one."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").where("doc_id % 4 = 0")
    more = [(10**6 + k, t) for k, t in enumerate(ODD_TEXTS)] + [(None, "a b"), (5, "a b"), (5, "a b"), (None, None)]
    docs = docs.unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    docs = docs.repartition(20).cache()
    want = sorted(aligned_plainly([tuple(r) for r in docs.collect()], tokenizers), key=lambda r: str(r[:7]))
    for options in ({}, {"part_keys": 2000, "broadcast_bytes": 1}):
        got = [tuple(r) for r in alignment.aligned_counts(docs, **options).collect()]
        got.sort(key=lambda r: str(r[:7]))
        assert len(got) == len(want)
        for a, b in zip(got, want):
            assert a[:7] == b[:7] and (b[7] is None or a[7] == b[7])
    docs.unpersist()


def test_alignment_of_odd_tables(odd, nothing):
    got = alignment.aligned_counts(odd).collect()
    assert len(got) == odd.count()
    assert all(r["groups_sha256"] == "" and r["n_a"] == r["count_sum"] == 0 for r in got if r["doc_id"] in (2, 3))
    assert alignment.aligned_counts(nothing).collect() == []


def test_perfect_hash_numbers_every_key_once():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 3, 1000, 50_000):
        keys = np.unique(rng.integers(-(2**63), 2**63 - 1, n))
        built = hashing.PerfectHash.build(keys)
        assert sorted(built.find(keys)) == list(range(len(keys))) and (built.keys[built.find(keys)] == keys).all()
        strangers = np.setdiff1d(rng.integers(-(2**63), 2**63 - 1, 500), keys)
        assert (built.find(strangers) == -1).all()
        assert len(built.bits) <= 4 * len(keys) + 64


# ---- op 12


def trie_plainly(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [turn[2:] for turn in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - abs(c) % 20 * (1 if c > 0 else -1)
        rebuilt[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members, children = defaultdict(list), defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved, out = {}, {}, []
    for p in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        leaves[p] = sum(leaves[k] for k in children[p]) or 1
        saved[p] = (len(members[p]) - 1) * words + sum(saved[k] for k in children[p])
        ends = ",".join(str(c) for c in sorted(c for c in members[p] if len(rebuilt[c]) == len(p)))
        out.append(
            (min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(children[p]), leaves[p],
             saved[p], hashlib.sha256(ends.encode()).hexdigest())
        )
    return out


def same_trie(frame):
    order = lambda r: tuple((x is not None, x) for x in r)
    got = sorted((tuple(r) for r in trie.prefix_trie(frame).collect()), key=order)
    rows = [tuple(r) for r in frame.select("conv_id", "turn", "role", "text").collect()]
    assert got == sorted(trie_plainly(rows), key=order)


TURNS = "conv_id long, turn long, role string, text string"


def odd_turns() -> list[tuple]:
    """Gaps, negative ids, ties, nulls, a ladder of growing copies, a very long one, a common start."""
    rng, rows = random.Random(3), []
    for c in [*range(-45, 120), *range(5000, 5060)]:
        if rng.random() > 0.1:
            for t in range(rng.choice([1, 1, 2, 3, 4, 5, 9])):
                words = rng.choice(["a b", "c", "", None, "x  y\tz"])
                rows.append((c, rng.choice([t, t, None]), rng.choice(["u", "a", None]), words))
    for c in range(300, 340):
        rows += [(c, t, "u", f"w{t} z") for t in range(c - 298)]
    rows += [(777, t % 690, "u", f"q{t % 5}") for t in range(700)]
    for c in range(1000, 1200):
        rows += [(c, 0, "u", "same start"), (c, 1, "a", "q"), (c, 5, "a", f"r {c % 3}"), (None, 1, "a", "b")]
    return rows


def test_trie_of_given_conversations(spark):
    same_trie(spark.read.parquet(f"{SMALL}/conversations.parquet"))


def test_trie_of_odd_conversations(spark):
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(odd_turns(), TURNS)
    same_trie(frame.withColumns({c: F.lit("x") for c in [*CLASHES, "depth", "f1", "_from", "pos"]}))
    assert trie.prefix_trie(frame.limit(0)).collect() == []


def test_trie_starts_anew_when_codes_clash(spark, monkeypatch):
    """A first seed under which all texts of a role share a code must not merge their nodes."""
    from pyspark.sql import functions as F

    codes = trie._codes
    asked = []

    def blind(seed):
        asked.append(seed)
        return (F.xxhash64("role"), F.xxhash64(F.lit(1), "role")) if seed == 0 else codes(seed)

    monkeypatch.setattr(trie, "_codes", blind)
    same_trie(spark.createDataFrame([r for r in odd_turns() if r[0] and r[0] < 60], TURNS))
    assert 1 in asked


def test_one_conversation_spreads_over_slices(spark):
    from panelforge.llm.running import in_order, running
    from pyspark.sql import functions as F

    frame = spark.createDataFrame([(k % 50 if k % 3 else 7, k) for k in range(9000)], "key long, v long")
    cut = in_order(frame, "key", [F.col("v")], {"v": F.col("v")})
    assert cut.where("key = 7").select("_slice").distinct().count() > 1
    sums, want = defaultdict(int), {}
    for r in sorted(frame.collect(), key=lambda r: (r["key"], r["v"])):
        sums[r["key"]] += r["v"]
        want[r["key"], r["v"]] = sums[r["key"]]
    got = running(cut, "key", {"total": F.col("v")}).collect()
    assert {(r["key"], r["v"]): r["total"] for r in got} == want and len(got) == 9000


# ---- op 13


def simhash_plainly(text) -> int:
    import xxhash

    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", folded)
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    codes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(code >> bit & 1 for code in codes) > len(codes))


def near(a: int, b: int) -> bool:
    return (a ^ b).bit_count() <= 4


def test_near_copies_of_given_documents(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    prints = {r["doc_id"]: simhash_plainly(r["text"]) for r in rows}
    roots = components_plainly(sorted(prints), lambda a, b: near(prints[a], prints[b]))
    got = QUERIES["op13_simhash_near_dedup"](spark, SMALL).collect()
    assert len(got) == len(rows)
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == {
        d: (f"{p:016x}", roots[d]) for d, p in prints.items()
    }


def test_no_link_between_fingerprints_is_lost(spark):
    """Clouds of fingerprints around forty centres; small blocks and finer keys give the same trees."""
    rng, prints = random.Random(1), set()
    for _ in range(40):
        centre = rng.getrandbits(64)
        for _ in range(100):
            value = centre
            for _ in range(rng.randint(0, 9)):
                value ^= 1 << rng.randrange(64)
            prints.add(value)
    nodes = sorted(prints)
    want = components_plainly(nodes, near)
    frame = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in nodes], "fingerprint long")
    for block, most in ((2048, 32), (16, 32), (16, 1), (8, 4)):
        edges = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in simhash.links(frame, block, most).collect()]
        assert len(edges) <= 5 * 13 * len(nodes)
        known = set(edges) | {(b, a) for a, b in edges}
        neighbours = defaultdict(list)
        for a, b in known:
            neighbours[a].append(b)
        root = {}
        for node in nodes:
            if node in root:
                continue
            stack = [node]
            while stack:
                at = stack.pop()
                if at not in root:
                    root[at] = node
                    stack += neighbours[at]
        assert root == want


def test_near_copies_of_odd_rows(spark, odd, nothing):
    rng = random.Random(8)
    got = simhash.near_copies(odd).collect()
    assert len(got) == odd.count()
    by = defaultdict(set)
    for r in got:
        by[r["component_id"]].add(r["doc_id"])
    # Texts without a word: the fingerprint is zero, and the smallest id names them.
    zero = {r["doc_id"] for r in got if r["fingerprint"] == "0" * 16}
    assert zero == {2, 3, 8, None} and {2, 3, 8, None} <= by[2]
    assert {5, 6, None} <= by[5]
    nameless = spark.createDataFrame([(None, prose(rng, 20), None, None, None)] * 2, SCHEMA)
    assert [r["component_id"] for r in simhash.near_copies(nameless).collect()] == [None, None]
    assert simhash.near_copies(nothing).collect() == []
