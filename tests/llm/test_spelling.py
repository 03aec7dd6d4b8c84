"""Spelling variants against plain Python over all pairs."""

import random
import re
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from samples import docs_frame, edge_cases  # noqa: E402

from siltstone.llm import spelling  # noqa: E402


def counts(rows):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def one_edit(a, b):
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words):
    out = []
    forms = {}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= 2 * words[w] else None
    for w, n in words.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.append((w, n, len(near[w]), forms[w], words.get(forms[w]), root))
    return sorted(out, key=str)


def run(spark, rows):
    got = spelling.spelling_variants(docs_frame(spark, rows)).collect()
    return sorted(((r["word"], r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in got), key=str)


def variants(seed, docs, bases, letters="abcdé"):
    r = random.Random(seed)
    words = ["".join(r.choice(letters) for _ in range(r.randrange(4, 9))) for _ in range(bases)]

    def one():
        w = r.choice(words[: r.randrange(1, bases + 1)])
        if r.random() < 0.3:
            k = r.randrange(len(w) + 1)
            w = r.choice([w[:k] + r.choice(letters) + w[k:], w[:k] + w[k + 1 :], w[:k] + r.choice(letters) + w[k + 1 :]])
        return w.upper() if r.random() < 0.1 else w

    return [(i, " ".join(one() for _ in range(120))) for i in range(docs)]


@pytest.mark.parametrize("group", [1024, 5])
def test_variants(spark, monkeypatch, group):
    # With groups of five every window is cut down to one code point.
    monkeypatch.setattr(spelling, "GROUP", group)
    rows = variants(1024, 60, 40)
    want = brute(counts(rows))
    assert run(spark, rows) == want
    assert any(r[3] != r[5] and r[3] for r in want), "no chain of forms in the sample"


def test_edge_cases(spark):
    rows = edge_cases() + [(20, "Straße straße STRASSE Straßen ×÷×÷× aaaaa aaaaaa aaaaaaa " * 4), (21, "x" * 5000 + " " + "x" * 5001)] * 3
    assert run(spark, rows) == brute(counts(rows))
    assert run(spark, []) == [] and run(spark, [(1, None), (None, "")]) == []


def test_counts_of_long_runs_and_marks(spark):
    rows = [(i, f"{'ab' * 60}word{chr(97 + i % 3)} plain Écoute ßßßßß ñandú") for i in range(400)]
    got = {r["word"]: r["n"] for r in spelling.word_counts(docs_frame(spark, rows)).collect()}
    assert got == counts(rows)


def test_tiles_hold_every_pair():
    r = random.Random(5)
    words = sorted({"".join(r.choice("ab") for _ in range(r.randrange(5, 8))) for _ in range(400)})
    short = [(w, 0) for w in words if len(w) == 6] + [(w, 1) for w in words if len(w) == 7]
    names, extra = [w for w, _ in short], np.array([e for _, e in short])
    n = len(names)
    a, b = spelling.near_pairs(names, np.zeros(n), extra, np.full(n, 6), np.zeros(n, int), np.full(n, 6))
    want = {frozenset((v, w)) for v in names for w in names if one_edit(v, w) and not len(v) == len(w) == 7}
    assert len(a) == len(want) and {frozenset((names[i], names[j])) for i, j in zip(a, b)} == want
