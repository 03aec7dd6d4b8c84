"""Small hand-made tables for the tests of this folder."""

from __future__ import annotations

import random

#: Columns with the names that the operators use inside.
CLASHES = "id string, text_hash string, key string, words string, size string, class string, rep string, at string, gone string, label string, score string, ids string, hash string, mark string, shift string, item string, __gone string, __gone_digest string, __gone_hash string"
_EXTRA = tuple("x" for _ in CLASHES.split(","))
DOCS = f"doc_id bigint, text string, {CLASHES}"


def docs_frame(spark, rows):
    """Documents from (doc_id, text) with extra columns of clashing names."""
    return spark.createDataFrame([(i, t, *_EXTRA) for i, t in rows], DOCS)


def prose(seed: int, words: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(r.randrange(2, 9))) for _ in range(words))


def edge_cases():
    """Nulls, empty and blank texts, null and repeated ids, repeated rows, copies, a very long text."""
    a, b = prose(1, 120), prose(2, 90)
    return [
        (1, a), (2, None), (3, ""), (4, a), (None, b), (5, b), (5, b), (6, " \t\r\n "), (7, "é ü 日本 🙂 " + b),
        (None, None), (8, "x" * 3000), (9, prose(3, 20_000)), (10, a + "\n" + b), (5, "another text of id five"),
        (11, a.upper()), (12, "\n".join(["the same line again and again"] * 40)), (13, "."), (None, b),
    ]
