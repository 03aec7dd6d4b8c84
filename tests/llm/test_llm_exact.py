"""Operators whose results are exact, against brute force on small tables."""

import base64
import binascii
import hashlib
import random
import sys
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from samples import DOCS, docs_frame, edge_cases, prose  # noqa: E402

from siltstone.llm import bpe, exact_dedup, line_dedup, suffix_array, token_files, warc  # noqa: E402
from siltstone.llm.components import components  # noqa: E402
from siltstone.llm.registry import tokenizer_path  # noqa: E402
from siltstone.llm import shards  # noqa: E402
from siltstone.llm.shards import in_shards, plan_shards  # noqa: E402


def same(df, want, columns):
    assert Counter(tuple(r[c] for c in columns) for r in df.collect()) == Counter(want)


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


# --- Repeated passages


def test_planted_passages_by_length(spark):
    """Passages of over 50 words: those of 400 bytes go, whole; shorter ones and clean texts stay as they are."""
    rows, want = [], {}
    for k in range(40):
        passage = prose(5000 + k, 52 if k % 2 else 95)
        size = len(passage.encode())
        assert size < 390 if k % 2 else size > 420
        for copy in range(3):
            # Surroundings differ, so that nothing beside the passage repeats.
            rows.append((3 * k + copy, f"{prose(9000 + 3 * k + copy, 60)}|{k}.{copy}|{passage}|{copy}.{k}|{prose(20000 + 3 * k + copy, 60)}"))
            want[3 * k + copy] = 0 if k % 2 else size + 2
    rows += [(1000 + k, prose(40000 + k, 150)) for k in range(40)]
    got = {r["doc_id"]: (r["n_removed"], r["n_spans"]) for r in suffix_array.remove_repeats(docs_frame(spark, rows)).collect()}
    assert got == {i: (want.get(i, 0), int(want.get(i, 0) > 0)) for i, _ in rows}


# --- Exact dedup


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_exact_groups(spark, keep):
    rows = edge_cases()
    by = defaultdict(list)
    for i, t in rows:
        by[t or ""].append(i)
    want = []
    for i, t in rows:
        ids = by[t or ""]
        known = [x for x in ids if x is not None]
        stays = (max if keep == "largest" else min)(known) if known else None
        want.append((i, stays, len(ids), i == stays, sha((t or "").encode())))
    got = exact_dedup.exact_groups(docs_frame(spark, rows), keep=keep)
    same(got, want, ["doc_id", "keep_id", "group_size", "kept", "text_sha256"])


def test_exact_many_copies_and_empty(spark):
    rows = [(i, "hot" if i % 3 else f"t{i}") for i in range(600)]
    got = {r["doc_id"]: r for r in exact_dedup.exact_groups(docs_frame(spark, rows)).collect()}
    assert got[1]["keep_id"] == 599 and got[1]["group_size"] == 400 and got[3]["group_size"] == 1
    assert exact_dedup.exact_groups(docs_frame(spark, [])).count() == 0
    kept = exact_dedup.drop_copies(docs_frame(spark, rows))
    assert kept.count() == 201 and kept.columns == docs_frame(spark, []).columns


# --- Byte-level BPE


def test_bpe_matches_the_public_library(spark):
    import public_tokenizers
    import tiktoken

    path = tokenizer_path("byte_bpe_50k.tiktoken")
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.bpe_of(path).ranks, special_tokens={})
    rows = edge_cases() + [(20, "it's we'll 'twas I'D  x\n\n y z 12² <|endoftext|>"), (21, "ab " * 900 + "q" * 700 + " end")]
    encoded = bpe.encode(docs_frame(spark, rows), path, chunk=600, overlap=40)
    want = []
    for i, t in rows:
        ids = known.encode_ordinary(t or "")
        want.append((i, len(ids), sha(" ".join(map(str, ids)).encode()), (t or "").encode()))
    got = [(r["doc_id"], r["n_tokens"], r["ids_sha256"], bytes(r["decoded"])) for r in bpe.decode(encoded, path).collect()]
    assert Counter(got) == Counter(want)
    assert bpe.encode(docs_frame(spark, []), path).count() == 0


def test_bpe_random_strings():
    import public_tokenizers
    import tiktoken

    mine = bpe.bpe_of(tokenizer_path("byte_bpe_50k.tiktoken"))
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=mine.ranks, special_tokens={})
    r = random.Random(5)
    signs = ["'s", "'ll", "'", " ", "  ", "\n", "\t", "a", "Foo", "12", "é", "!?", "　", "日", "\U0001f642", "\x1c", "Ⅷ", "'Ve", "'ve"]
    texts = ["".join(r.choice(signs) for _ in range(r.randrange(0, 15))) for _ in range(3000)] + ["a" * 300, "é" * 200]
    for t, packed in zip(texts, bpe.encode_texts(mine, texts), strict=True):
        assert np.frombuffer(packed, "<u4").tolist() == known.encode_ordinary(t)


# --- Token files


def test_elias_fano():
    r = random.Random(2)
    for n in (0, 1, 5, 3000):
        values = np.cumsum([r.choice([0, 1, 7, 900]) for _ in range(n)]).astype(np.int64)
        universe = int(values[-1]) if n else 0
        low_bits, low, high = token_files.Bounds.encode(values, universe)
        held = token_files.Bounds(n, low_bits, low, high)
        assert held.all().tolist() == values.tolist()
        assert all(held.select(i) == values[i] for i in range(0, n, 7))
        assert n < 100 or len(low) + len(high) < n * 4


def test_token_files(spark, folder):
    from tokenizers import Tokenizer

    path = tokenizer_path("byte_bpe_50k.json")
    known = Tokenizer.from_file(path)
    rows = edge_cases() + [(20, "a <|endoftext|> b"), (21, "<|endoftext|>"), (22, "x<|endoftext|><|endoftext|>\n<|endoftext|"), (23, "é <|endoftext|>é")]
    manifest = token_files.write_files(docs_frame(spark, rows), path, folder, file_ids=500)
    assert manifest.count() > 2
    got = [(r["doc_id"], r["n_tokens"], r["ids_crc32"], r["start"]) for r in token_files.read_files(manifest, folder).collect()]
    want = []
    for i, t in rows:
        ids = known.encode(t or "", add_special_tokens=False).ids + [0]
        want.append((i, len(ids), binascii.crc32(np.array(ids, "<u4").tobytes())))
    assert Counter(g[:3] for g in got) == Counter(want)
    got.sort(key=lambda g: g[3])
    assert [g[0] for g in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    assert [g[3] for g in got] == np.cumsum([0] + [g[1] for g in got[:-1]]).tolist()
    again = {r["file"]: r["crc32"] for r in token_files.write_files(docs_frame(spark, rows[::-1]), path, folder, file_ids=500).collect()}
    assert again == {r["file"]: r["crc32"] for r in manifest.collect()}
    assert token_files.round_trip(docs_frame(spark, []), path).count() == 0


def test_shard_bounds_follow_the_rows(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(i, 15) for i in [0, 1, 2, 3, 10**15, 10**15 + 1, 10**15 + 2]], "k bigint, w int")
    planned = plan_shards(rows.repartition(3), "k", F.col("w"), target=20)
    assert planned == plan_shards(rows.coalesce(1), "k", F.col("w"), target=20)
    assert planned.bounds == [1, 2, 3, 10**15, 10**15 + 1, 10**15 + 2]
    got = {r["k"]: r["__shard"] for r in in_shards(rows, "k", planned).collect()}
    assert got == {k: n for n, k in enumerate(sorted(got))}
    assert plan_shards(rows.filter("k < 0"), "k", F.col("w")).bounds == []


@pytest.mark.parametrize("keys", [64, 4096])
def test_passes_do_not_grow_with_the_shards(spark, keys):
    from pyspark.sql import functions as F

    rows = spark.range(keys).select((F.col("id") * 7 - 100).alias("k"), F.lit(10).alias("w"))
    tracker, group = spark.sparkContext.statusTracker(), f"shards{keys}"
    spark.sparkContext.setJobGroup(group, group)
    planned = plan_shards(rows, "k", F.col("w"), target=10)
    jobs = len(tracker.getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 16 and len(planned.bounds) == keys - 1
    nulls = rows.union(spark.createDataFrame([(None, 1)], "k bigint, w int"))
    dealt = in_shards(nulls, "k", planned)
    assert {r["k"]: r["__shard"] for r in dealt.collect()} == {None: 0} | {7 * i - 100: i for i in range(keys)}
    plan = dealt._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and len(plan) < 20_000


def test_shards_grow_beyond_their_number(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(shards, "MOST_SHARDS", 8)
    assert 4 <= len(plan_shards(spark.range(1000), "id", F.lit(1), target=1).bounds) <= 16


# --- Line dedup


def lines_by_hand(rows, least=10):
    from collections import defaultdict

    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    order = lambda i: (i is None, i or 0)
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= least:
                holders[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders[key(x)]) < 2 or min(holders[key(x)], key=order) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


@pytest.mark.parametrize(("batches", "fan"), [(1, 2), (5, 2)])
def test_line_dedup(spark, batches, fan):
    a, b = "A shared line of text ", "\tanother shared line\r"
    rows = edge_cases() + [
        (30, f"{a}\nown line number one\n{b}"), (31, f"{a.upper()}\n\n{a}\nshort"), (29, b + "\n"), (None, f"{a}\nlast of all lines"),
        (32, "short\nshort\nİstanbul is a line"), (33, "İSTANBUL is a line\n" + "y" * 9), (34, "y" * 9 + "\n" + a), (40, "a\n" * 3000 + b),
    ]
    got = line_dedup.dedup_lines(docs_frame(spark, rows), batches=batches, fan=fan)
    same(got, lines_by_hand(rows), ["doc_id", "n_lines", "n_dropped", "text"])


def test_line_dedup_empty(spark):
    assert line_dedup.dedup_lines(docs_frame(spark, [])).count() == 0


# --- WARC


PAGES = "page_id bigint, url string, html string, id string, hash string, mark string, payload string, refers_to string"


def test_warc(spark, folder):
    rows = [(5, "http://a", "<p>x</p>"), (2, "http://b\r\nX: y", "<p>x</p>"), (9, None, None), (3, "u", ""), (7, "v", "<p>é🙂</p>\r\n\r\nWARC/1.1\r\n"),
            (None, "w", "<p>x</p>"), (8, "z", "q" * 100_000), (4, "z", "<p>x</p>"), (4, "z", "<p>x</p>")]
    pages = spark.createDataFrame([(*r, *"abcde") for r in rows], PAGES)
    manifest = warc.write_archives(pages, folder, roll_bytes=600, shard_bytes=2000)
    assert manifest.count() > 2
    got = warc.read_archives(manifest, folder).collect()
    want = []
    for i, _, html in rows:
        data = (html or "").encode()
        first = min(p for p, _, h in rows if (h or "") == (html or "") and p is not None)
        want.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if i == first else "revisit", None if i == first else first))
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got) == Counter(want)
    assert {r["page_id"]: bytes(r["payload"]).decode() for r in got if r["payload"] is not None}[7] == rows[4][2]
    files = {r["file"]: r["sha256"] for r in manifest.collect()}
    assert files == {r["file"]: r["sha256"] for r in warc.write_archives(pages.repartition(3), folder, roll_bytes=600, shard_bytes=2000).collect()}
    assert warc.round_trip(pages.filter("page_id < 0")).count() == 0


# --- Suffix arrays


def test_suffix_order():
    r = random.Random(7)
    for _ in range(1500):
        s = [r.randrange(r.choice([1, 2, 3, 40])) for _ in range(r.randrange(0, 30))] * r.randrange(1, 4)
        assert suffix_array.suffix_order(s) == sorted(range(len(s)), key=lambda i: s[i:])


def removed_by_hand(rows, length=400):
    seen = Counter(t.encode()[i : i + length] for _, t in rows for i in range(len(t.encode()) - length + 1))
    out = []
    for i, t in rows:
        data = t.encode()
        gone = np.zeros(len(data) + 1, bool)
        for k in range(len(data) - length + 1):
            if seen[data[k : k + length]] > 1:
                gone[k : k + length] = True
        kept = bytes(x for x, g in zip(data, gone, strict=False) if not g)
        out.append((i, len(data), int(gone.sum()), int((gone[1:] < gone[:-1]).sum()), sha(kept)))
    return out


COLUMNS = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def test_remove_repeats(spark, monkeypatch):
    p, q, s = prose(50, 90), prose(51, 75), prose(52, 60)
    rows = [(i, t if t is None or len(t) < 9000 else t[:3000]) for i, t in edge_cases()]
    rows += [(50, p), (51, s + p + q), (52, q[3:] + p[:-1] + s[:50]), (53, p[:399]), (54, p[:400] + "!" + q[:401]), (55, q * 3),
             (56, p[:250] + "#" + p[251:]), (57, "ab" * 450), (58, "zab" * 300), (59, p[1:401])]
    want = removed_by_hand([(i, t or "") for i, t in rows])
    same(suffix_array.remove_repeats(docs_frame(spark, rows)), want, COLUMNS)
    # The way for middles with very many different sets gives the same.
    monkeypatch.setattr(suffix_array, "LIMIT", 1)
    same(suffix_array.remove_repeats(docs_frame(spark, rows)), want, COLUMNS)


def test_remove_repeats_in_long_texts(spark, monkeypatch):
    p = prose(60, 100)
    rows = [(1, prose(61, 1500) + p + prose(62, 1500) + p), (2, p), (3, "short")]
    monkeypatch.setattr(suffix_array, "CHUNK", 1000)
    same(suffix_array.remove_repeats(docs_frame(spark, rows)), removed_by_hand(rows), COLUMNS)
    assert suffix_array.remove_repeats(docs_frame(spark, [])).count() == 0


# --- Components


def test_components(spark):
    r = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(r.randrange(90), r.randrange(90)) for _ in range(50)] + [(500, i) for i in range(501, 560)]
    up = {x: x for e in edges for x in e}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    got = {x["node"]: x["root"] for x in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(got[x] == root(x) for e in edges if e[0] != e[1] for x in e)
    assert DOCS and components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
