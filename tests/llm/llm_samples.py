"""Rows for the tests of the text operators."""

from __future__ import annotations

import random

LETTERS = "ba be bi bo bu da de di do du ka ke ki ko ku la le li lo lu ma me mi mo mu".split()


def prose(rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choices(LETTERS, k=rng.randint(1, 4))) for _ in range(words))


def odd_rows() -> list[tuple]:
    """doc_id, text, lang, source, n_chars: nulls, empties, a very long text, ties, repeats."""
    rng = random.Random(5)
    common = prose(rng, 40)
    return [
        (1, f"{prose(rng, 30)} {common}", "aa", "s1", 1),
        (2, None, None, "s1", None),
        (3, "", "bb", None, 0),
        (3, "", "bb", None, 0),
        (4, f"{common}\n{prose(rng, 60_000)}\n{common}", "aa", "s2", 4),
        (5, common, "bb", "s2", 5),
        (6, common, "aa", "s2", 6),
        (6, common, "aa", "s2", 6),
        (7, "!!! ??? 123", "bb", "s3", 7),
        (8, " \n\t\n ", None, "s3", 8),
        (None, common, "aa", "s3", 9),
        (None, None, None, None, None),
        (9, "é😀 日本語 テスト " + common.upper(), "aa", "s3", 10),
    ]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use for columns of their own.
CLASHES = "key h row code shard slot length piece key_ drop n sig n_removed _order _slice held_out".split()
