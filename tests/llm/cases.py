"""Small inputs and brute-force versions for the corpus operators."""

from __future__ import annotations

import random
import re

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that operators use inside, as extra columns of an input.
CLASHING = ["__row", "row", "class", "n", "text2", "token", "group", "t", "id", "unit", "size"]


def not_space(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))


def alphanumeric(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def sentence(rng: random.Random, n: int, vocabulary: int = 4000) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def documents(spark, texts, sources=None):
    """A documents table with columns whose names clash with inner ones."""
    rows = [
        (i, t, "en", (sources or ["a"] * len(texts))[i], len(t or "")) for i, t in enumerate(texts)
    ]
    frame = spark.createDataFrame(rows, DOCS)
    for name in CLASHING:
        frame = frame.selectExpr("*", f"'x' AS `{name}`")
    return frame


def components(n: int, links) -> list[int]:
    """Smallest number reachable from each."""
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]
