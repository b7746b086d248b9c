"""Token counts that follow edits without encoding the text again.

A document's pre-tokens lie in blocks; the blocks are the leaves of a segment tree whose nodes sum
code points and tokens. An edit splits text anew from shortly before the edit until a
boundary falls on an old one behind it, and only those pre-tokens are encoded. Their block
changes, and the sums above it.

Scale. Everything is per document; rows are mapped where they are read. Counts of common pre-tokens are
kept per task process, bounded.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.llm.words import small

VOCABULARY = "byte_bpe_50k.tiktoken"
BLOCK = 64
# The splitter looks at most two code points past a pre-token's end to decide on it.
LOOKAHEAD = 2

_CACHED = 500_000
_CACHED_LENGTH = 64


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


class Counter:
    """Splits text into pre-tokens and counts the tokens of each."""

    def __init__(self, path: str):
        import base64

        import public_tokenizers
        import regex
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.known: dict[str, int] = {}

    def count(self, piece: str) -> int:
        n = self.known.get(piece)
        if n is None:
            n = len(self.encoding.encode_ordinary(piece))
            if len(piece) <= _CACHED_LENGTH:
                if len(self.known) >= _CACHED:
                    self.known.clear()
                self.known[piece] = n
        return n


@cache
def counter(path: str) -> Counter:
    """One per task process."""
    return Counter(path)


class CountTree:
    """Token counts of one text under edits.

    ``blocks`` holds lists of (code points, tokens) of consecutive pre-tokens. ``chars`` and ``tokens`` are
    a binary segment tree over the blocks: node i has the children 2i and 2i + 1, the leaves
    begin at ``size``.
    """

    def __init__(self, text: str, count: Counter):
        self.text, self.counter, self.encoded = text, count, 0
        pieces = count.pattern.findall(text)
        leaves = list(zip(map(len, pieces), map(count.count, pieces)))
        self.blocks = [leaves[i : i + BLOCK] for i in range(0, len(leaves), BLOCK)] or [[]]
        self._build()

    def _build(self) -> None:
        self.size = 1 << (len(self.blocks) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.size), [0] * (2 * self.size)
        for k, block in enumerate(self.blocks):
            self.chars[self.size + k] = sum(n for n, _ in block)
            self.tokens[self.size + k] = sum(n for _, n in block)
        for i in range(self.size - 1, 0, -1):
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    @property
    def total(self) -> int:
        return self.tokens[1]

    def _find(self, at: int) -> tuple[int, int]:
        """The block that code point ``at`` lies in (the last one behind the end) and where it begins."""
        i, begin = 1, 0
        while i < self.size:
            i *= 2
            if at >= begin + self.chars[i] and self.chars[i + 1]:
                begin += self.chars[i]
                i += 1
        return min(i - self.size, len(self.blocks) - 1), begin

    def _update(self, k: int) -> None:
        i = self.size + k
        self.chars[i] = sum(n for n, _ in self.blocks[k])
        self.tokens[i] = sum(n for _, n in self.blocks[k])
        while i > 1:
            i //= 2
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def edit(self, start: int, end: int, insert: str) -> None:
        """Replace the code points from ``start`` to ``end`` by ``insert``."""
        start = max(0, min(start, len(self.text)))
        end = max(start, min(end, len(self.text)))
        # The first pre-token that the edit can change: it ends within sight of the edit.
        k, begin = self._find(max(start - LOOKAHEAD - 1, 0))
        j, at = 0, begin
        while j < len(self.blocks[k]) and at + self.blocks[k][j][0] < start - LOOKAHEAD:
            at += self.blocks[k][j][0]
            j += 1
        self.text = self.text[:start] + insert + self.text[end:]
        moved = len(insert) - (end - start)
        # Old boundaries from ``at`` on, walked along with the new ones.
        old, ok, oj, fresh, met = at, k, j, [], False
        for piece in self.counter.pattern.finditer(self.text, at):
            fresh.append((piece.end() - piece.start(), self.counter.count(piece.group())))
            wanted = piece.end() - moved
            if wanted < end or piece.end() < start + len(insert):
                continue
            while old < wanted and ok < len(self.blocks):
                if oj == len(self.blocks[ok]):
                    ok, oj = ok + 1, 0
                    continue
                old += self.blocks[ok][oj][0]
                oj += 1
            if old == wanted:
                met = True
                break
        if not met:
            ok, oj = len(self.blocks) - 1, len(self.blocks[-1])
        self.encoded += len(fresh)
        merged = self.blocks[k][:j] + fresh + self.blocks[ok][oj:]
        if ok == k and len(merged) <= 2 * BLOCK:
            self.blocks[k] = merged
            self._update(k)
        else:
            self.blocks[k : ok + 1] = [merged[i : i + BLOCK] for i in range(0, len(merged), BLOCK)] or [[]]
            self._build()


def count_with_edits(docs: DataFrame, edits: Column, path: str | None = None) -> DataFrame:
    """Tokens of every whole text before and after its edits.

    ``edits`` is an array of structs (start, end, insert) per row: code points of the original text, not
    overlapping, in ascending order. Returns doc_id, n_pretokens, n_tokens, n_edits, edited_chars,
    edited_tokens, reencoded (pre-tokens encoded again).

    Null text counts as empty: no tokens; edits may insert into it. Null edits are none, a null insert is
    empty, and places outside the text are moved to its ends. Repeated rows are counted each;
    null doc_ids stay. An empty table gives an empty result. Columns not named by ``edits`` are not looked at.
    """
    path = path or vocabulary_path()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for batch in small(batches):
            rows = []
            for doc_id, text, changes in zip(*(batch.column(i).to_pylist() for i in range(3))):
                tree = CountTree(text or "", count)
                pieces, tokens = sum(map(len, tree.blocks)), tree.total
                # From the last to the first, so that earlier places stay as they are.
                for change in reversed(changes or []):
                    tree.edit(change["start"], change["end"], change["insert"] or "")
                rows.append((doc_id, pieces, tokens, len(changes or []), len(tree.text), tree.total, tree.encoded))
            columns = list(zip(*rows)) if rows else [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    names = ["doc_id", "n_pretokens", "n_tokens", "n_edits", "edited_chars", "edited_tokens", "reencoded"]
    shape = "array<struct<start:bigint,end:bigint,insert:string>>"
    return docs.select(F.col("doc_id").cast("long"), "text", edits.cast(shape)).mapInArrow(
        work, ", ".join(f"{n} long" for n in names)
    )
