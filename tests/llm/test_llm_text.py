"""Words, substrings, lines, sharding, packing, token counts, pages: against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_samples import odd_rows, prose

from oracle import compare, connect
from panelforge.llm import html, lines, packing, sharding, substrings, tokens, words
from panelforge.llm.queries import ORACLES, QUERIES

TINY = "/root/testdata/sf0.001"


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# ---- words


def test_words_equal_the_pattern():
    texts = ["a b  c", "", None, "dé\tf\n g", " ", "x" * 9000, "ab"] * 2
    data, offsets = words.flat(pa.array(texts))
    found = words.Words(data, offsets)
    assert [bytes(data[a:b]).decode() for a, b in zip(found.start, found.end)] == [w for t in texts for w in split(t)]
    codes = found.hashes()
    assert len(set(codes.tolist())) == len({w for t in texts for w in split(t)})


def test_windows_of_hashes():
    x = np.arange(50, dtype=np.uint64) * 7919 % 101
    assert words.sliding_min(x, 11).tolist() == [min(x[i : i + 11]) for i in range(40)]
    assert len(words.rolling(x, 60)) == 0 and len(words.sliding_min(x, 60)) == 0
    assert words.rolling(x, 5)[3] == words.rolling(x[3:], 5)[0]


# ---- op 4


def without_repeats(rows, width=13):
    owner = {}
    for i, t in rows:
        w = split(t)
        for k in range(len(w) - width + 1):
            if i is not None:
                key = tuple(w[k : k + width])
                owner[key] = min(owner.get(key, i), i)
    out = []
    for i, t in rows:
        w, gone = split(t), set()
        for k in range(len(w) - width + 1):
            if i is not None and owner[tuple(w[k : k + width])] < i:
                gone.update(range(k, k + width))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [1, 20_000])
def test_repeats_of_odd_rows(spark, odd, hot):
    """With hot=1 nearly every bucket takes the way of hot minimisers."""
    got = substrings.remove_repeats(odd, digest=True, bucket_bytes=4000, hot_runs=hot)
    assert sorted(map(tuple, got.collect()), key=str) == without_repeats([r[:2] for r in odd_rows()])


def test_hot_windows_equal_bucket_windows(spark):
    rng = random.Random(1)
    shared = prose(rng, 30)
    rows = [(i, f"{prose(rng, rng.randint(0, 20))} {shared} {prose(rng, rng.randint(0, 20))}") for i in range(150)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    old = substrings._FINE
    try:
        for fine in (1, 16):
            substrings._FINE = fine
            for hot in (1, 10**9):
                got = substrings.remove_repeats(frame, digest=True, bucket_bytes=3000, hot_runs=hot)
                assert sorted(map(tuple, got.collect()), key=str) == without_repeats(rows)
    finally:
        substrings._FINE = old


def test_equal_hashes_are_settled_by_bytes(monkeypatch):
    texts = ["a b c d e", "x b c d y", "a b c d e z"]
    monkeypatch.setattr(substrings, "rolling", lambda h, n: np.zeros(max(len(h) - n + 1, 0), np.uint64))
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    n = np.array([len(t) for t in texts])
    ids = np.array([1, 2, 3])
    got = substrings.repeats_of_bucket(data, n, ids, ids, np.zeros(3, np.int64), 3)
    assert sorted(zip(*(x.tolist() for x in got))) == [(2, 2, 1, 4), (3, 3, 0, 5)]


def test_substrings_equal_sql(spark):
    assert compare(QUERIES["op4_substring_dedup"](spark, TINY), ORACLES["op4_substring_dedup"], connect(TINY)) == []


def test_substrings_of_nothing(nothing):
    assert substrings.remove_repeats(nothing).count() == 0


# ---- op 8


def lines_expected(rows, spacing=4, least=2):
    at = defaultdict(set)
    for i, t in rows:
        for n, c in enumerate(lines.chunks(t or "", spacing, least)):
            body = "\n".join(c)
            if t and len(c) >= least and not body.isspace():
                at[body].add((i is None, i or 0, t, n))
    out = []
    for i, t in rows:
        if not t:
            out.append((i, t, 0))
            continue
        parts = lines.chunks(t, spacing, least)
        # Occurrences are ordered by doc_id alone here: equal ids only come as equal rows below.
        gone = {n for n, c in enumerate(parts) if len(c) >= least and (o := at.get("\n".join(c))) and min(o) != (i is None, i or 0, t, n)}
        out.append((i, "\n".join(x for n, c in enumerate(parts) if n not in gone for x in c), sum(len(parts[n]) for n in gone)))
    return sorted(out, key=str)


def test_chunks_give_the_text_back_and_resist_shifts():
    rng = random.Random(2)
    block = [prose(rng, 5) for _ in range(60)]
    a, b = lines.chunks("\n".join(block)), lines.chunks("\n".join([prose(rng, 4) for _ in range(3)] + block))
    assert "\n".join(x for c in a for x in c) == "\n".join(block)
    assert len({tuple(c) for c in a} & {tuple(c) for c in b}) >= len(a) - 2
    assert all(len(c) >= 2 for c in a[:-1])


@pytest.mark.parametrize("small", [0, 16 << 20])
def test_lines_equal_brute_force(spark, odd, monkeypatch, small):
    """With small=0 first occurrences are joined by a shuffle, hot chunks apart."""
    monkeypatch.setattr(lines, "SMALL_BYTES", small)
    rng = random.Random(3)
    shared = "\n".join(prose(rng, 6) for _ in range(25))
    rows = [(i, "\n".join([prose(rng, 5) for _ in range(i % 7)] + [shared] * (i % 3) + [prose(rng, 5)])) for i in range(60)]
    rows += [r[:2] for r in odd_rows() if r[0] is not None]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = lines.remove_repeated_lines(frame).select("row.doc_id", "row.text", "n_removed")
    assert sorted(((i, t, n or 0) for i, t, n in map(tuple, got.collect())), key=str) == lines_expected(rows)


def test_lines_keep_columns(odd, nothing):
    out = lines.remove_repeated_lines(odd).select("row.*")
    assert out.columns == odd.columns and out.count() == odd.count()
    assert lines.remove_repeated_lines(nothing).count() == 0


def blocks_expected(rows):
    """All two-line windows, in order of doc_id and place; a window that overlaps its first is no repeat."""
    first = {}
    out = []
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        x, gone = (t or "").split("\n"), set()
        for k in range(len(x) - 1):
            if (x[k] + x[k + 1]).strip():
                d, at = first.setdefault((x[k], x[k + 1]), (i, k))
                if d != i or k - at >= 2:
                    gone |= {k, k + 1}
        out.append((i, t and "\n".join(y for k, y in enumerate(x) if k not in gone), len(gone)))
    return sorted(out, key=str)


@pytest.mark.parametrize("small", [0, 16 << 20])
def test_blocks_equal_all_windows(spark, odd, monkeypatch, small):
    """Blocks of two to four lines at any place, blank lines, one line in a row, many copies of one block."""
    monkeypatch.setattr(lines, "SMALL_BYTES", small)
    rng = random.Random(11)
    shared = ["\n".join(prose(rng, 4) for _ in range(n)) for n in (2, 2, 3, 4)]
    some = ["", " ", *(prose(rng, 2) for _ in range(5))]
    rows = [
        (i, "\n".join(rng.choice([rng.choice(shared), rng.choice(some), prose(rng, 5)]) for _ in range(rng.randint(1, 9))))
        for i in range(150)
    ]
    rows += [(200 + n, "\n".join(["run"] * n)) for n in (3, 2, 5)] + [(210, "\n".join(["own"] * 5)), (211, "x\ny\nx\ny")]
    rows += [r[:2] for r in odd_rows() if r[0] in (None, 2, 4, 7, 8, 9)][:-1]
    rows = [(i if i is None else i * 2, t) for i, t in rows]
    rows = list({i: (i, t) for i, t in rows}.values())
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = lines.remove_repeated_blocks(frame).select("row.doc_id", "row.text", "n_removed")
    assert sorted(((i, t, n or 0) for i, t, n in map(tuple, got.collect())), key=str) == blocks_expected(rows)


def test_equal_hashes_of_windows_are_settled_by_bytes(spark):
    rng = random.Random(12)
    shared = [prose(rng, 3) for _ in range(12)]
    rows = [(i, "\n".join(rng.choices(shared, k=6))) for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    rare = lines.repeated_windows(frame)
    assert sorted(map(str, lines.repeated_windows(frame, bits=3).collect())) == sorted(map(str, rare.collect()))


@pytest.mark.parametrize("bits", [64, 3])
def test_long_passages_go_as_chunks_and_windows_take_the_rest(spark, bits):
    """Long passages, shifted and edited, with blank lines, repeated within a text, and exact copies."""
    rng = random.Random(13)
    passages = [[rng.choice(["", prose(rng, 4), prose(rng, 6)]) for _ in range(n)] for n in (25, 40, 60)]
    rows = []
    for i in range(40):
        text = [prose(rng, 5) for _ in range(rng.randint(0, 9))]
        for _ in range(rng.randint(0, 2)):
            x = list(rng.choice(passages))
            x[rng.randrange(len(x))] = prose(rng, 3)
            text += x[rng.randint(0, 5) :] + [prose(rng, 5)]
        rows.append((i, "\n".join(text)))
    rows += [(40 + n, rows[n][1]) for n in range(0, 40, 4)] + [(90, "\n".join(["a", "b", "c"] * 30)), (91, "\n".join(["run"] * 70))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)

    def gone(drops):
        texts, out = dict(rows), set()
        for r in drops.collect():
            left = texts[r.doc_id].split("\n")
            for a, z in map(lines._lines_of, r["drop"]):
                filled = [n for n in range(a, z) if left[n].strip()]
                out |= {(r.doc_id, n) for n in range(max(a, filled[0] - 1), min(z, filled[-1] + 2))}
        return out

    coarse, every = gone(lines.repeated_chunks(frame, bits=bits)), gone(lines.repeated_windows(frame))
    # With 3 bits all chunks are candidates, so only the largest are compared; the windows find the rest.
    assert coarse <= every and (bits == 3 or len(coarse) > len(every) / 2)
    assert gone(lines.repeated_blocks(frame, bits)) == every
    left = sum(len(r["drop"]) for r in lines.repeated_windows(frame, 64, lines.repeated_chunks(frame)).collect())
    assert left < len(every) / 2


def test_short_blocks_go_with_the_blanks_inside(spark):
    rows = [(1, "a\nb\nc"), (2, "x\nb\nc\ny"), (3, "p\n\n\n \n\n\nq"), (4, "r\np\n\n\n \n\n\nq\ns"), (5, "p\n\n\n\n\n\nq")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in lines.remove_repeated_blocks(frame).select("row.*").collect()}
    assert got == {1: rows[0][1], 2: "x\ny", 3: rows[2][1], 4: "r\ns", 5: "\n\n"}


def test_queries_remove_short_blocks(spark):
    docs = spark.read.parquet(f"{TINY}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r.n_removed or 0 for r in QUERIES["op8_line_dedup"](spark, TINY).collect()}
    assert got == {i: n for i, _, n in blocks_expected([tuple(r) for r in docs])}


def test_blocks_keep_columns(odd, nothing):
    out = lines.remove_repeated_blocks(odd).select("row.*")
    assert out.columns == odd.columns and out.count() == odd.count()
    assert lines.remove_repeated_blocks(nothing).count() == 0


# ---- op 2


def test_shards_follow_the_rule(spark, odd):
    for frame, shards in ((odd, 3), (odd, 40), (spark.read.parquet(f"{TINY}/documents.parquet"), 40)):
        rows = sharding.interleave(frame, shards).collect()
        assert len(rows) == frame.count()
        source = Counter(r["source"] for r in rows)
        by = defaultdict(list)
        for r in rows:
            by[r["shard"]].append(r)
        sizes = [len(by[s]) for s in range(shards)]
        assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(rows)
        for members in by.values():
            assert sorted(r["slot"] for r in members) == list(range(len(members)))
            for s, n in Counter(r["source"] for r in members).items():
                assert abs(n - source[s] / shards) <= 2
    texts = {r["doc_id"]: r["text"] for r in frame.collect()}
    for r in rows:
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 16, zlib.crc32(raw), "rows", None)


def test_shards_of_the_query_equal_a_plain_ranking(spark):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    drawn = docs.select("doc_id", "source", F.xxhash64(F.lit(0), "doc_id", F.crc32(F.col("text").cast("binary")), "source").alias("d")).collect()
    by = defaultdict(list)
    for r in sorted(drawn, key=lambda r: r["d"]):
        by[r["source"]].append(r)
    share = {r["doc_id"]: (k + 0.5) / len(v) for v in by.values() for k, r in enumerate(v)}
    order = sorted(drawn, key=lambda r: (share[r["doc_id"]], r["d"]))
    expected = {r["doc_id"]: k * 40 // len(order) for k, r in enumerate(order)}
    assert {r["doc_id"]: r["shard"] for r in QUERIES["op2_sharding"](spark, TINY).collect()} == expected


def test_shards_of_nothing(nothing):
    assert sharding.interleave(nothing).count() == 0


# ---- op 3


def test_plans_fill_sequences_without_gaps():
    rng = random.Random(4)
    for _ in range(150):
        capacity = rng.choice([10, 30, 100, 2048])
        counts = {rng.randint(1, capacity): rng.choice([1, 2, 3, 7, 50, 600]) for _ in range(rng.randint(1, 50))}
        runs = packing.plan(counts, capacity).tolist()
        fill, seen = defaultdict(list), defaultdict(list)
        for size, a, z, first, per, offset in runs:
            seen[size] += range(a, z)
            for r in range(a, z):
                fill[first + (r - a) // per].append((offset + (r - a) % per * size, size))
        assert {k: sorted(v) for k, v in seen.items()} == {k: list(range(v)) for k, v in counts.items()}
        for items in fill.values():
            at = 0
            for offset, size in sorted(items):
                assert offset == at
                at += size
            assert at <= capacity
            assert sum(3 * size > capacity for _, size in items) <= 2


def test_large_items_are_matched_and_small_ones_fill_gaps():
    assert len({r[3] for r in packing.plan({60: 1, 40: 1, 55: 1, 45: 1}, 100).tolist()}) == 2
    runs = packing.plan({70: 2, 30: 1, 20: 1, 10: 1}, 100).tolist()
    assert len({r[3] for r in runs}) == 2


def plain_ids(texts):
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(packing.vocabulary_path())
    return [e.ids for e in encoder.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_word_ids_equal_the_tokenizer():
    texts = ["Hello, World!!", "a\tb\n\nc", "ΑΣ ΟΔΟΣ.", "<|endoftext|> hi", "hello <|endoftext|> world", "ab<|startoftext|>c!<|ENDOFTEXT|>", "it's I'LL 'S can't", "ÀÉ,*** straße%%%", "x́y ﬁ İ Å",
             "日本語 1234 5.6", "", "   ", "\x1c\x85a b", "😀", "w" * 500, "it 's", "a'", "''s"]
    small = packing._Kept(str.encode, 2)
    assert [small[x] for x in "abcabcabc"] == [x.encode() for x in "abcabcabc"] and len(small) <= 2
    encoder = packing.WordIds(packing.vocabulary_path())
    for text, ids in zip(texts, plain_ids(texts)):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == ids, text


def test_new_words_are_encoded_many_to_a_call():
    rng = random.Random(8)
    words = sorted({"".join(rng.choices("abcdeéö", k=9)) for _ in range(3000)})
    text = " ".join(rng.choices(words, k=9000)) + "."
    encoder = packing.WordIds(packing.vocabulary_path())
    expected, calls = plain_ids([text])[0], []

    class Counting:
        def encode(self, text, **options):
            calls.append(text)
            return whole.encode(text, **options)

    whole, encoder.tokenizer = encoder.tokenizer, Counting()
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == expected
    assert 0 < len(calls) < 50


def test_ids_of_many_texts_equal_the_tokenizer(monkeypatch):
    for name, value in (("_JOINED", 3), ("_CACHED", 5), ("_CACHED_UNITS", 7), ("_BLOCK", 200)):
        monkeypatch.setattr(packing, name, value)
    encoder, rng = packing.WordIds(packing.vocabulary_path()), random.Random(9)
    letters = "aAbzZÉßÿÀ×÷   's.!-&<|>\n\t\x1c\x85ΣσςİıЖ日1٣😀é́ﬁ'`~"
    for _ in range(40):
        texts = ["".join(rng.choices(letters, k=rng.randint(0, 70))) for _ in range(rng.randint(0, 30))]
        texts += [None, "", "a<|endoftext|>.", "<|ENDOFTEXT|>", None]
        rng.shuffle(texts)
        batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], ["doc_id", "text"])
        got = []
        for part in packing._by_bytes([batch, batch.slice(1, 0)]):
            ids, bounds = encoder.encode_all(part.column(1))
            got += [ids[a:z].tolist() for a, z in zip(bounds[:-1], bounds[1:])]
        assert got == plain_ids(texts)


def test_packing_gives_every_token_back(spark, odd):
    rows = [(r[0], r[1]) for r in odd_rows()]
    got = packing.pack_pieces(packing.freeze(packing.pieces(odd, 100, with_ids=True)), 100).collect()
    expected = Counter()
    for (i, _), ids in zip(rows, plain_ids([t for _, t in rows])):
        ids = ids + [0]
        for k, at in enumerate(range(0, len(ids), 100)):
            part = np.array(ids[at : at + 100], "<u4").tobytes()
            expected[i, k, at, len(part) // 4, zlib.crc32(part), part] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"], bytes(r["ids"])) for r in got) == expected
    by = defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for items in by.values():
        at = 0
        for offset, size in sorted(items):
            assert offset == at
            at += size
        assert at <= 100


def test_packing_is_near_the_least(spark):
    got = QUERIES["op3_best_fit_packing"](spark, TINY).collect()
    assert len({r["sequence_id"] for r in got}) <= 1.08 * -(-sum(r["length"] for r in got) // 2048)


def test_packing_of_nothing(nothing):
    assert packing.pack(nothing).count() == 0


# ---- op 5


def test_trees_follow_edits():
    count, rng = tokens.counter(tokens.vocabulary_path()), random.Random(6)
    full = lambda t: len(count.encoding.encode_ordinary(t))
    parts = ["a", " ", "  ", "'", "re", "1", "\n", ".", "é", "I'll ", "　", "   x", "'s"]
    for k in range(250):
        text = "".join(rng.choices(parts, k=rng.randint(0, 60))) if k % 3 else prose(rng, 400)
        tree = tokens.CountTree(text, count)
        assert tree.total == full(text)
        for _ in range(5):
            start = rng.randint(0, len(text))
            end = rng.choice([start, min(len(text), start + 5), rng.randint(start, len(text))])
            insert = "".join(rng.choices(parts, k=rng.choice([0, 1, 2, 200])))
            text = text[:start] + insert + text[end:]
            tree.edit(start, end, insert)
            assert tree.text == text and tree.total == full(text)


def test_edits_touch_little():
    count = tokens.counter(tokens.vocabulary_path())
    tree = tokens.CountTree(prose(random.Random(7), 20_000), count)
    tree.edit(50_000, 50_003, "zz")
    assert tree.encoded < 10


def test_token_query_equals_full_encoding(spark):
    count = tokens.counter(tokens.vocabulary_path())
    full = lambda t: len(count.encoding.encode_ordinary(t))
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{TINY}/documents.parquet").collect()}
    for r in QUERIES["op5_token_counts"](spark, TINY).collect():
        t = texts[r["doc_id"]]
        n = len(t)
        edited = t[: n // 4] + t[-8:] + t[min(n // 4 + 8, n // 2) : n // 2] + t[n // 2 + n // 20 :] + t[:20]
        assert (r["n_tokens"], r["edited_tokens"], r["edited_chars"]) == (full(t), full(edited), len(edited))


def test_token_counts_of_odd_rows(odd, nothing):
    from pyspark.sql import functions as F

    edits = F.expr("array(struct(2 AS start, 90 AS end, cast(null AS string) AS insert), struct(500 AS start, 400 AS end, 'z' AS insert))")
    assert tokens.count_with_edits(odd, edits).count() == odd.count()
    none = F.expr("cast(null AS array<struct<start:int,end:int,insert:string>>)")
    assert all(r["n_tokens"] == r["edited_tokens"] and r["reencoded"] == 0 for r in tokens.count_with_edits(odd, none).collect())
    assert tokens.count_with_edits(nothing, none).count() == 0


# ---- op 9


def test_articles_of_the_pages(spark):
    from html import unescape

    pages = {r["page_id"]: r for r in spark.read.parquet(f"{TINY}/pages.parquet").collect()}
    got = QUERIES["op9_html_extraction"](spark, TINY).collect()
    assert len(got) == len(pages)
    for r in got:
        article = re.search("<article>(.*)</article>", pages[r["page_id"]]["html"], re.S)[1]
        spaced = re.sub("</?(p|h1|br)>", " ", article)
        assert r["text"] == " ".join(unescape(re.sub("<[^>]+>", "", spaced)).split())
        assert (r["url"], r["n_chars"]) == (pages[r["page_id"]]["url"], len(r["text"]))


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""), ("<p>a", "a"), ("plain, text", "plain, text"), ("<div>" * 30_000 + "deep, text", "deep, text"),
        ("<!-- c --><script>var x='<p>no</p>'</script>", ""), ("<p>a<b>b</b>c<br>d &amp; e&nbsp;f</p>", "abc d & e f"),
        ("<body><nav><a href=x>m</a></nav><div class=post><h2>T</h2><p>One, two, three.<ul><li>item</ul></div>"
         "<div class='sidebar'>s, s, s, s</div><section id=comments><p>nice, very nice, really</p></section>"
         "<form><input>f</form><footer>z</footer>", "T One, two, three. item"),
        ("<article class=comment><p>reader, says</p></article><article><p>The, article text</p></article>", "The, article text"),
        ("<div><ul><li><a>a1</a><li><a>a2</a><li><a>a3</a></ul><p>Real text, of the page</p></div>", "Real text, of the page"),
    ],
)
def test_pages(page, text):
    assert html.main_text(page) == text


WRAPPERS = [
    '<div class="content has-sidebar">{}</div>', '<div id="post-with-comments">{}</div>', '<section class="share-enabled">{}</section>',
    '<div class="post-content share-enabled">{}</div>', '<div class="layout-no-sidebar"><main>{}</main></div>',
    '<div class="widget">{}</div>', '<div class="hidden">{}</div>', '<div role="alert">{}</div>', '<div id="banner">{}</div>',
    '<form action="/page">{}</form>', '<form><div class="modal">{}</div></form>', '<div class="promo"><article>{}</article></div>',
    '<body class="header-fixed sidebar">{}</body>', '<table><tr><td class="menu-off">{}</td></tr></table>',
    '<div class="related"><div class="share">{}</div></div>', '<article class="comment">{}</article>',
    "<div>" * 90 + "{}" + "</div>" * 90,
]
AROUND = [
    '<div class="sidebar"><p>Follow us, friends.</p></div>', '<div class="cookie-banner">We use cookies, as all do.</div>',
    '<div class="site-footer">All rights reserved.</div>', '<form><label>Name, please</label>Leave your mail, now.</form>',
    '<div class="entry-comments"><p>First, as ever!</p></div>', '<div id="related-posts"><p>See also, perhaps.</p></div>', "",
]


@pytest.mark.parametrize("wrapper", WRAPPERS)
@pytest.mark.parametrize("around", AROUND)
def test_names_do_not_decide_against_the_points(wrapper, around):
    story = [f"Part {k} of the story, long and plain, told once more, runs on for a good while without an end in sight." for k in range(6)]
    inside = wrapper.format("".join(f"<p>{s}</p>" for s in story))
    for page in (inside + around, around + inside):
        assert html.main_text(page) == " ".join(story)


def test_paragraphs_in_widgets_and_long_comments():
    story = [f"Part {k} of the story, long and plain, told once more, runs on for a good while without an end in sight." for k in range(6)]
    widgets = "".join(f'<div class="widget"><p>{s}</p></div>' for s in story)
    assert html.main_text(f"<body>{widgets}</body>") == " ".join(story)
    replies = "".join(f'<div class="comment"><p>Reader {k}, who has much to say, says it, at length, again.</p></div>' for k in range(20))
    article = "".join(f"<p>{s}</p>" for s in story)
    assert html.main_text(f'<article>{article}<div class="comments">{replies}</div></article>') == " ".join(story)


def test_odd_pages(spark):
    rows = [(1, "u", None), (None, None, "<p>x, y"), (2, "u", ""), (2, "u", ""), (3, "v", "<p>" + "long text, " * 50_000)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text", "2 AS n_chars")
    got = sorted(map(tuple, html.extract(frame).collect()), key=str)
    assert [r[3] for r in got] == [0, 0, 0, 11 * 50_000 - 1, 4]
    assert html.extract(frame.limit(0)).count() == 0
