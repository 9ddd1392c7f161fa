"""Seeded texts with the awkward cases every text operator must handle."""

from __future__ import annotations

import random


def word(rng):
    return "".join(rng.choice("abcdeéßñ") for _ in range(rng.randint(1, 6)))


def prose(rng, n, vocabulary=None):
    words = [rng.choice(vocabulary) if vocabulary else word(rng) for _ in range(n)]
    return rng.choice([" ", "  ", "\n", "\t "]).join(words)


def awkward(seed=0):
    """(id, text) rows: null, empty, blank, one word, ties, repeated rows, a
    very long text, no separators at all, and control characters."""
    rng = random.Random(seed)
    long = prose(rng, 30_000)
    base = prose(rng, 120)
    return [(1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, base), (6, base), (7, base.upper()),
            (8, long), (8, long), (9, "x" * 50_000), (10, "a\x00b \x1c c d e 　f"),
            (11, prose(rng, 34)), (12, prose(rng, 35)), (13, base + " " + prose(rng, 40)),
            (14, prose(rng, 60, ["ab", "ba"])), (15, "😀 é. É! it's 'tis <|endoftext|> 1.2 ²½"), (None, base)]
