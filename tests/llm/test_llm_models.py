"""Language, decontamination, near-duplicates, fingerprints, pipeline: against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from llm_samples import SCHEMA, odd_rows, prose

import corpus_pipeline
from panelforge.llm import components, decontamination, fingerprints, language, neardup, neighbours
from panelforge.llm.queries import QUERIES
from panelforge.llm.words import flat, token_hashes

TINY, SMALL = "/root/testdata/sf0.001", "/root/testdata/sf0.01"

# ---- op 1


def test_copies_are_learned_once(spark, monkeypatch):
    """Two texts of one language: copies under other ids and repeated rows leave the sample as it is."""
    seen = []
    monkeypatch.setattr(language.ByteGru, "train", lambda self, x, y, epochs: seen.append(sorted(map(bytes, x.astype(np.uint8)))))
    rng = random.Random(4)
    texts = [("aa", prose(rng, 9)) for _ in range(4)] + [("bb", prose(rng, 9)) for _ in range(3)]
    ids = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 4 != 2]
    once = [(ids[k], t, lang) for k, (lang, t) in enumerate(texts)]
    more = [(i, t, lang) for i in ids[10:60] for lang, t in texts] + once * 30
    for rows in (once, once + more):
        language.train_model(spark.createDataFrame(rows, "doc_id long, text string, lang string"), docs_per_language=3)
    assert len(seen[0]) == 6 and seen[0] == seen[1]


def test_gradients_equal_differences():
    model = language.ByteGru(["a", "b", "c"], 4, 1)
    for name in "TUVc":
        setattr(model, name, getattr(model, name).astype(np.float64))
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, 257, (3, 6)), np.array([0, 2, 1])
    _, grad = model.gradients(x, y)
    for name in "TUVc":
        values = getattr(model, name)
        places = {tuple(int(v) for v in p) for p in np.argwhere(np.abs(grad[name]) > 1e-4)[::17]}
        assert places
        for place in places:
            old, losses = values[place], []
            for step in (1e-4, -1e-4):
                values[place] = old + step
                losses.append(model.gradients(x, y)[0])
            values[place] = old
            assert abs((losses[0] - losses[1]) / 2e-4 - grad[name][place]) < 1e-5


def test_every_byte_counts_once():
    model = language.ByteGru(["a", "b"], 4, 1)
    texts = ["x" * n + "é" for n in (0, 1, 126, 127, 128, 300, 2000)]
    data, offsets = flat(pa.array([*texts, ""]))
    got = model.documents(data, offsets)
    assert np.allclose(got[:-1].sum(axis=1), 1, atol=1e-5) and not got[-1].any()
    alone = model.documents(*flat(pa.array([texts[5]])))
    assert np.allclose(got[5], alone[0], atol=1e-6)


def test_languages_of_held_out_documents(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = QUERIES["op1_language_id"](spark, SMALL).collect()
    assert len(got) == len(docs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert all(0 <= r["score"] <= 1 for r in got)
    unseen = [r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in got if r["held_out"]]
    assert sum(unseen) >= 0.97 * len(unseen)
    by = defaultdict(set)
    for r in got:
        by[docs[r["doc_id"]]["text"]].add((r["lang_pred"], r["score"]))
    assert all(len(v) == 1 for v in by.values())


def test_held_out_rows_teach_nothing(spark):
    rng = random.Random(1)
    rows = [(i, prose(rng, 30), "zz" if zlib.crc32(str(i).encode()) % 4 == 2 else "ab"[i % 2]) for i in range(60)]
    model = language.train_model(spark.createDataFrame(rows, "doc_id long, text string, lang string"), epochs=1)
    assert model.languages == ["a", "b"]


def test_language_of_odd_rows(odd, nothing):
    got = language.predict_language(odd).collect()
    assert len(got) == odd.count()
    undecided = sorted(str(r["doc_id"]) for r in got if r["lang_pred"] == "und")
    assert undecided == sorted(["2", "3", "3", "7", "8", "None"])
    assert all(r["score"] == 0 for r in got if r["lang_pred"] == "und")
    kept = language.in_known_language(odd)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 6
    assert language.predict_language(nothing).count() == 0 and language.in_known_language(nothing).count() == 0


# ---- op 6


def tile_plainly(item, text, least):
    """Greedy string tiling without hashing: the longest free match first, leftmost on ties."""
    a, b, tiles = [True] * len(item), [t is not None for t in text], []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for t in range(len(text)):
                n = 0
                while i + n < len(item) and t + n < len(text) and a[i + n] and b[t + n] and item[i + n] == text[t + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, t)
        n, i, t = best
        if n < least:
            return tiles
        tiles.append((i, t, n))
        a[i : i + n] = b[t : t + n] = [False] * n


def test_tiles_equal_plain_tiling():
    rng = random.Random(2)
    for _ in range(150):
        item = rng.choices(range(6), k=rng.randint(1, 25))
        text = rng.choices([*range(6), None], k=rng.randint(1, 30)) + item[len(item) // 2 :] + [None] + item[: len(item) // 2]
        got = decontamination.tile(item, text, 3)
        plain = tile_plainly(item, text, 3)
        assert sorted(n for *_, n in got)[-1:] == sorted(n for *_, n in plain)[-1:]
        assert all(item[i : i + n] == text[t : t + n] for i, t, n in got)
        for side in (0, 1):
            marked = [x for m in got for x in range(m[side], m[side] + m[2])]
            assert len(marked) == len(set(marked))


def test_items_found_in_parts_and_in_blocks(spark, odd, nothing):
    rng = random.Random(3)
    items = [prose(rng, 30) for _ in range(12)] + ["short item", "", None, prose(rng, 30).upper()]
    w = items[0].split()
    rows = [
        (1, prose(rng, 50) + " " + items[0] + " " + prose(rng, 50)),
        (2, " ".join(w[20:] + ["x"] + w[10:20] + ["y"] + w[:10])),
        (3, " ".join(w[:9])),
        (4, prose(rng, 300)),
        (5, "here is a SHORT, item!"),
        (6, items[15].lower().replace(" ", " - ")),
        (7, None),
        (7, items[1]),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id int, text string")
    wanted = {(1, 0), (2, 0), (5, 12), (6, 15), (7, 1)}
    for block in (1 << 20, 300):
        got = decontamination.find_items(docs, bench, block_chars=block).collect()
        assert {(r["doc_id"], r["item_id"]) for r in got} == wanted and len(got) == len(wanted)
        clean = decontamination.without_items(docs, bench, block_chars=block).collect()
        assert sorted(map(tuple, clean), key=str) == sorted([rows[2], rows[3], rows[6]], key=str)
    assert next(r for r in got if r["doc_id"] == 2)["tiles"] == 3
    assert decontamination.find_items(nothing, bench).count() == 0
    assert decontamination.find_items(docs, bench.limit(0)).count() == 0
    assert decontamination.without_items(odd, bench).columns == odd.columns


def test_found_items_equal_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{TINY}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{TINY}/benchmark.parquet").collect()]
    wanted = set()
    for j, item in items:
        code = token_hashes([item])[0].tolist()
        seeds = {tuple(code[k : k + 4]) for k in range(len(code) - 3)}
        for i, text in docs:
            t = token_hashes([text])[0].tolist()
            if any(tuple(t[k : k + 4]) in seeds for k in range(len(t) - 3)):
                if sum(n for *_, n in decontamination.tile(code, t, 4)) >= 0.5 * len(code):
                    wanted.add((i, j))
    got = QUERIES["op6_benchmark_decontamination"](spark, TINY).collect()
    assert wanted and {(r["doc_id"], r["item_id"]) for r in got} == wanted


# ---- op 7


def test_components_equal_union_find(spark):
    rng = random.Random(4)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(170)]
    edges += [(1000 + i, 1001 + i) for i in range(40)] + [(2000, 2000 + i) for i in range(100)]
    got = dict(map(tuple, components.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    root = {v: v for e in edges for v in e}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    assert got == {v: find(v) for e in edges if e[0] != e[1] for v in e}


def weighted(text):
    _, codes, counts = neardup.shingles([text])
    return codes, counts


def test_signatures_estimate_the_probability_jaccard():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(3000)]
    texts = []
    for k in range(60):
        base = rng.choices(words, k=[4, 12, 40, 150, 500][k % 5]) * (1 + k % 3)
        texts += [" ".join(rng.choice(words) if rng.random() < r else w for w in base) for r in (0, 0.03)]
    signed = neardup.signatures(*neardup.shingles(texts), len(texts))
    off = []
    for i in range(0, len(texts), 2):
        a, b = weighted(texts[i]), weighted(texts[i + 1])
        plain, exact = neardup.similarity(a, b)
        x, y = dict(zip(*map(np.ndarray.tolist, a))), dict(zip(*map(np.ndarray.tolist, b)))
        naive = sum(
            1 / sum(max(x.get(o, 0) / x[d], y.get(o, 0) / y[d]) for o in x.keys() | y.keys()) for d in x.keys() & y.keys()
        )
        assert abs(exact - naive) < 1e-9
        assert abs(plain - len(x.keys() & y.keys()) / len(x.keys() | y.keys())) < 1e-9
        off.append((signed[i] == signed[i + 1]).mean() - exact)
    assert abs(np.mean(off)) < 0.015 and np.std(off) < 0.06


def groups_plainly(rows, threshold=0.8):
    root = list(range(len(rows)))

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    shingled = [weighted(t) for _, t in rows]
    for i, j in combinations(range(len(rows)), 2):
        same = (rows[i][1] or "") == (rows[j][1] or "")
        if same or (np.intersect1d(shingled[i][0], shingled[j][0]).size and max(neardup.similarity(shingled[i], shingled[j])) >= threshold):
            root[find(j)] = find(i)
    by = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        by[find(i)].append(doc_id)
    least = {k: min((d for d in v if d is not None), default=None) for k, v in by.items()}
    return Counter((doc_id, least[find(i)]) for i, (doc_id, _) in enumerate(rows))


@pytest.mark.parametrize("small", [1, 16])
def test_groups_equal_brute_force(spark, small):
    """A hub with many copies, chains of copies of copies, equal texts, odd rows. With small=1
    every bucket goes by centres and the search outside the centre's group."""
    rng = random.Random(6)
    words = prose(rng, 500).split()
    change = lambda w, r: [rng.choice(words) if rng.random() < r else x for x in w]
    texts = []
    for k in range(6):
        base = rng.choices(words, k=[30, 90, 200][k % 3])
        texts += [base] + [change(base, 0.012) for _ in range(12)]
        for _ in range(5):
            base = change(base, 0.012)
            texts.append(base)
    texts += texts[:15] + [rng.choices(words, k=50) for _ in range(20)]
    rows = [(i, " ".join(w)) for i, w in enumerate(texts)]
    rng.shuffle(rows)
    rows += [r[:2] for r in odd_rows()]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = neardup.near_duplicates(frame, small=small).collect()
    expected = groups_plainly(rows)
    assert Counter((r["doc_id"], r["class_id"]) for r in got) == expected
    assert sum(r["keep"] for r in got) >= len({c for _, c in expected})


def test_repeated_paragraphs_are_found(spark):
    """Equal sets of shingles, set Jaccard about 1, but one paragraph of the one text comes forty times."""
    rng = random.Random(8)
    rows = []
    for k in range(40):
        head, part = prose(rng, 150), prose(rng, 12)
        rows += [(2 * k, f"{head} {part} {part}"), (2 * k + 1, f"{head}" + f" {part}" * (40 if k % 2 else 10))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(frame).collect()}
    assert got == {i: i // 2 * 2 for i, _ in rows}


def test_one_row_of_each_group_stays(odd, nothing):
    kept = neardup.one_per_group(odd)
    assert kept.columns == odd.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=str)
    # 2, 3 and the null row are empty; 5 and 6 are equal, and 9 nearly so but for capitals.
    assert ids == [1, 2, 4, 5, 7, 8]
    assert neardup.one_per_group(nothing).count() == 0


# ---- op 10


def test_entropy_is_that_of_each_window():
    data = np.frombuffer(prose(random.Random(7), 9000).encode() + b"a" * 200, np.uint8)
    got = fingerprints.entropy_classes(data)
    for i in [*range(0, len(got), 997), len(got) - 1]:
        total = sum(int(fingerprints._terms[n]) for n in Counter(data[i : i + 16].tolist()).values())
        assert got[i] == 1000 - total * 1000 // fingerprints._TOP
    assert got[-1] == 0 and len(fingerprints.entropy_classes(data[:15])) == 0


def plain_digest(text, ranks):
    """Filters as sets of bits, straight from the description."""

    def spread(x):
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % 2**64
        x = (x ^ x >> 27) * 0x94D049BB133111EB % 2**64
        return x ^ x >> 31

    raw = text.encode()
    windows = [raw[i : i + 16] for i in range(max(len(raw) - 15, 1))] if raw else []
    terms = [round(4096 * k * math.log2(k)) if k else 0 for k in range(17)]
    weighed = []
    for at, w in enumerate(windows):
        w = w.ljust(16, b"\0")
        code = 0
        for byte in w:
            code = (code * 0x9E3779B97F4A7C15 + byte + 1) % 2**64
        level = 1000 - sum(terms[k] for k in Counter(w).values()) * 1000 // terms[16]
        weighed.append((ranks[level], spread(code) >> 44, at, spread(code)))
    chosen = {min(weighed[max(s, 0) : s + 16])[2] for s in range(-15, len(weighed))}
    codes = list(dict.fromkeys(weighed[at][3] for at in sorted(chosen)))
    return [
        {code >> 11 * k & 2047 for code in codes[lo : lo + 160] for k in range(5)} for lo in range(0, len(codes), 160)
    ]


def plain_likeness(a, b):
    if not a or not b or a == b:
        return float(a == b)
    if len(a) > len(b):
        a, b = b, a

    def score(x, y):
        least, chance = min(len(x), len(y)), len(x) * len(y) / 2048
        floor = chance + 0.3 * (least - chance)
        return min(max((len(x & y) - floor) / max(least - floor, 1e-6), 0), 1)

    def found(of, others):
        return sum(max(score(x, y) for y in others) * len(x) for x in of) / sum(map(len, of))

    return (found(a, b) + found(b, a)) / 2 if len(a) == len(b) else found(a, b)


def bits_of(filters):
    return [set(np.flatnonzero(np.unpackbits(f)).tolist()) for f in filters]


def test_fingerprints_equal_plain_ones(spark):
    """Classes, choice, filters and likeness of the query against the plain version above."""
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    rows = {r["doc_id"]: r for r in QUERIES["op10_document_fingerprints"](spark, TINY).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    terms, counts = [round(4096 * k * math.log2(k)) if k else 0 for k in range(17)], Counter()
    for text in texts.values():
        raw = text.encode()
        for i in range(len(raw) - 15):
            counts[1000 - sum(terms[k] for k in Counter(raw[i : i + 16]).values()) * 1000 // terms[16]] += 1
    ranks = {c: n for n, c in enumerate(sorted(range(1001), key=lambda c: (c < 100, counts[c], c)))}
    ids = sorted(texts, reverse=True)
    prints = {i: plain_digest(texts[i], ranks) for i in ids}
    for i, j in zip(ids, ids[1:] + ids[:1]):
        cut = len(texts[i]) // 3
        other = plain_digest(texts[i][: len(texts[i]) - cut] + texts[j][:cut], ranks)
        assert bits_of(fingerprints.from_text(rows[i]["fingerprint"])) == prints[i]
        assert bits_of(fingerprints.from_text(rows[i]["edited_fingerprint"])) == other
        assert rows[i]["near_edited"] == pytest.approx(plain_likeness(prints[i], other), abs=2e-6)
        assert rows[i]["near_next"] == pytest.approx(plain_likeness(prints[i], prints[j]), abs=2e-6)


@pytest.mark.parametrize("follower", [5, 40, 130, 300, 5000])
def test_likeness_does_not_jump_with_the_length(follower):
    """An edit keeps two thirds of a text; whatever its length and that of the next text, it stays alike."""
    rng = random.Random(11)
    ranks = fingerprints.rarity(np.arange(fingerprints.CLASSES)[::-1])
    story, other = prose(rng, 20_000), prose(rng, follower + 400)[:follower]
    lengths = [*range(120, 1500, 9), *range(395, 406)]
    near = []
    for n in lengths:
        a, b, c = fingerprints.digests([story[:n], fingerprints.edited(story[:n], other), other], ranks)
        near.append(fingerprints.likeness(a, b))
        assert near[-1] > 0.2
    assert np.mean(near) > 0.4
    assert max(abs(x - y) for x, y in zip(near[-11:], near[-10:])) < 0.25


def test_slices_of_one_hot_id(spark):
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"text {i}") for i in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = neighbours.in_slices(frame, 30).where("not _guest").groupBy("_slice").count().collect()
    assert sum(r["count"] for r in got) == 3000
    assert max(r["count"] for r in got) < 500


def test_digests_do_not_depend_on_their_neighbours():
    rng = random.Random(8)
    texts = [prose(rng, n) for n in (1, 5, 20, 60, 300, 4000, 80_000)] + ["", "a" * 5000, "x"]
    ranks = fingerprints.rarity(np.arange(fingerprints.CLASSES))
    together = fingerprints.digests(texts, ranks)
    for text, found in zip(texts, together):
        alone = fingerprints.digests([text], ranks)[0]
        assert np.array_equal(alone, found)
        assert np.array_equal(fingerprints.from_text(fingerprints.to_text(found)), found)
        assert fingerprints.likeness(found, found) == 1.0
    assert fingerprints.likeness(together[4], together[5]) < 0.2
    for text in texts[2:7]:
        a, b = fingerprints.digests([text, fingerprints.edited(text, prose(rng, 90_000))], ranks)
        assert fingerprints.likeness(a, b) > 0.2


def fingerprints_expected(rows, ranks):
    texts = [t or "" for _, t in rows]
    following = texts[1:] + texts[:1]
    changed = [fingerprints.edited(t, f) for t, f in zip(texts, following)]
    prints, others = fingerprints.digests(texts, ranks), fingerprints.digests(changed, ranks)
    return Counter(
        (rows[k][0], len(texts[k]), hashlib.sha256(changed[k].encode()).hexdigest(), fingerprints.to_text(prints[k]),
         fingerprints.to_text(others[k]), fingerprints.likeness(prints[k], others[k]),
         fingerprints.likeness(prints[k], prints[(k + 1) % len(rows)]))
        for k in range(len(rows))
    )


def test_fingerprints_equal_one_list(spark):
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    rows = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), reverse=True)
    ranks = fingerprints.rarity(fingerprints.class_counts(docs))
    got = Counter(map(tuple, QUERIES["op10_document_fingerprints"](spark, TINY).collect()))
    assert got == fingerprints_expected(rows, ranks)


@pytest.mark.parametrize("slices", [1, 5])
def test_fingerprints_of_odd_rows(odd, nothing, slices):
    """Equal ids follow each other by a hash, so only what does not depend on it is compared."""
    got = fingerprints.fingerprint_edits(odd, slices).collect()
    assert Counter((r["doc_id"], r["n_chars"]) for r in got) == Counter((i, len(t or "")) for i, t, *_ in odd_rows())
    by = defaultdict(set)
    texts = {r[0]: r[1] for r in odd_rows()}
    for r in got:
        if r["doc_id"] is not None:
            by[texts[r["doc_id"]] or ""].add(r["fingerprint"])
    assert all(len(v) == 1 for v in by.values())
    assert fingerprints.fingerprint_edits(nothing).count() == 0


def test_every_row_is_followed_by_the_next(spark):
    rows = [(i * i % 101, f"t{i * i % 101}") for i in range(40)]
    frame = spark.createDataFrame(sorted(set(rows)), "doc_id long, text string").repartition(4)
    order = sorted(set(rows), reverse=True)
    wanted = {a[0]: b[1] for a, b in zip(order, order[1:] + order[:1])}
    for slices in (1, 3, 60):
        part = neighbours.in_slices(frame, slices)

        def pairs(batches):
            for ids, texts in neighbours.followed(batches):
                found = [(i, t) for i, t in zip(ids, texts[1:]) if i is not ...]
                yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in found], pa.int64()), pa.array([t for _, t in found], pa.string())], ["i", "t"])

        assert dict(map(tuple, part.mapInArrow(pairs, "i long, t string").collect())) == wanted


# ---- pipeline


def test_stages_filter_as_their_operators_say(spark):
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    bench = [r["text"] for r in spark.read.parquet(f"{TINY}/benchmark.parquet").collect()]
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [tuple(r) for r in kept.collect()]
        kept = corpus_pipeline.freeze(stage(spark, kept, TINY))
        assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
        after = [tuple(r) for r in kept.collect()]
        if name == "language_id":
            assert after and set(after) <= set(before)
        if name == "near_dedup":
            groups = groups_plainly([r[:2] for r in before])
            assert sorted(r[0] for r in after) == sorted({c for _, c in groups})
        if name == "decontaminate":
            code = [token_hashes([b])[0].tolist() for b in bench]
            for r in before:
                t = token_hashes([r[1]])[0].tolist()
                holds = any(sum(n for *_, n in decontamination.tile(c, t, 4)) >= 0.5 * len(c) for c in code if set(c) & set(t))
                assert holds == (r not in after)
        assert all(r[4] == len(r[1]) for r in after)
    packed = corpus_pipeline.run(spark, TINY).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in kept.collect()}


def test_stages_on_odd_rows(spark, odd, nothing):
    plain = spark.createDataFrame(odd_rows(), SCHEMA)
    for frame in (plain, odd, nothing):
        kept = frame
        for _, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, kept, TINY)
            assert kept.columns == frame.columns
        assert corpus_pipeline.STAGES[-1][1](spark, kept, TINY).count() >= kept.count()
