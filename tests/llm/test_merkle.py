"""The Merkle manifest against a plain recursion over lists."""

import hashlib
import sys
import zlib
from collections import defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
from samples import prose  # noqa: E402

from siltstone.llm import merkle  # noqa: E402

DOCS = "doc_id bigint, text string, source string, lang string, n_chars bigint, tree string, rank string, size string, path string, leaf string, root string, now string, carry string, at string"
_EXTRA = ("x",) * 9


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(doc_id, source, lang, n_chars, text):
    def written(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    return sha("".join(map(written, (doc_id, source, lang, n_chars, text))))


def tree(hashes):
    """Root, and for every leaf its (left, right) siblings from the bottom up."""
    paths, at, level = [[] for _ in hashes], list(range(len(hashes))), list(hashes)
    while len(level) > 1:
        for k, i in enumerate(at):
            run = i - i % 3
            paths[k].append(("".join(level[run:i]), "".join(level[i + 1 : run + 3])))
        level = [sha("".join(level[i : i + 3])) for i in range(0, len(level), 3)]
        at = [i // 3 for i in at]
    return level[0], paths


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text, source, lang, n in rows:
        now = text
        if doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0:
            now = text.replace("\n", "")
        groups[source].append((doc_id, leaf_of(doc_id, source, lang, n, text), leaf_of(doc_id, source, lang, n, now)))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for rows_ in groups.values():
        rows_.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    subs = {s: tree([r[1] for r in groups[s]]) for s in names}
    root, upper = tree([subs[s][0] for s in names]) if names else (None, [])
    out = []
    for s, above in zip(names, upper):
        for (doc_id, leaf, now), path in zip(groups[s], subs[s][1]):
            node = now
            for left, right in path + above:
                node = sha(left + node + right)
            proof = sha("".join(a + b for a, b in path + above))
            out.append((doc_id, leaf, subs[s][0], root, proof, node, node == root))
    return out


def run(spark, rows, schema=DOCS):
    df = spark.createDataFrame([(*r, *_EXTRA) for r in rows], schema)
    gone = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(2)) == 0
    got = merkle.verified(df, {"text": F.replace("text", F.lit("\n"), F.lit(""))}, gone)
    got = got.withColumn("proof", F.sha2(merkle.proof_text(F.col("path")), 256))
    names = ["doc_id", "leaf", "subroot", "root", "proof", "folded_root", "verified"]
    return sorted(map(str, (tuple(r[c] for c in names) for r in got.collect())))


def documents(n, sources, seed=0):
    return [(i * 7 % 5001, f"{prose(seed + i, 3)}\n{i}" if i % 5 else f"plain {i}", sources[i % len(sources)], "en", i) for i in range(n)]


@pytest.mark.parametrize("n", [1, 4, 243, 244])
def test_one_source(spark, n):
    rows = documents(n, ["s"])
    assert run(spark, rows) == sorted(map(str, brute(rows)))


def test_hot_source_over_three_rounds(spark, monkeypatch):
    monkeypatch.setattr(merkle, "HEIGHT", 1)
    monkeypatch.setattr(merkle, "WIDTH", 3)
    rows = documents(100, ["hot", "hot", "b", None, "", "é", "Z"])
    assert run(spark, rows) == sorted(map(str, brute(rows)))


def test_many_sources(spark):
    rows = documents(600, [f"s{i}" for i in range(300)])
    assert run(spark, rows) == sorted(map(str, brute(rows)))


def test_edge_cases(spark):
    rows = [
        (1, None, None, None, None), (2, "", "", "", 0), (None, "a\nb", "s", "en", 3), (None, None, None, None, None),
        (5, "same", "s", "en", 4), (5, "same", "s", "en", 4), (5, "other", "s", "en", 5), (-3, "neg\n", "s", None, -1),
        (9, "long " * 200_000 + "\n", "s", "en", 1), (10, "é\n日本🙂", "日", "ß", 5), (11, "\n\n\n", "s", "en", 3),
    ]
    assert run(spark, rows) == sorted(map(str, brute(rows)))
    assert run(spark, []) == []


def test_manifest_alone(spark):
    rows = documents(50, ["a", "b"])
    df = spark.createDataFrame([(*r, *_EXTRA) for r in rows], DOCS)
    got = {(r["doc_id"], r["leaf"], r["subroot"], r["root"]) for r in merkle.manifest(df).collect()}
    assert got == {r[:4] for r in brute(rows)}
