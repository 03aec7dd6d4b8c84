"""Spelling variants: words one edit apart, each with its most frequent near word and the root that leads to.

Words are compared as code points. Two words are one edit apart when their common prefix and common suffix together
reach the longer length less one. This is read off padded code-point matrices, one block of words against
another, for words that can match at all: a word is cut into windows, an edit lies in one window, and outside of it
both words agree. So words meet by their length and by what stands before and after a window, and the pair counts in
the one window that holds the end of its common prefix: every pair is found once. Where more than ``GROUP`` words meet,
the window is cut into three and they meet again; a window of one code point holds no more words than the
alphabet allows. No group is cut off, and none becomes one task's burden.

Defined results: a null text has no words; a null id counts as an empty one where runs are marked; an empty table gives
no rows; repeated rows count as often as they occur; other columns, whatever their names, take no part.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.textbytes import blocks
from siltstone.scratch import materialize

LEAST_LETTERS = 5
LEAST_COUNT = 3
#: A form occurs at least so many times as often as the word.
RATIO = 2
#: Of all (document, run) pairs one in so many loses a code point.
EVERY = 97
#: Words that may meet by one window before it is cut.
GROUP = 1024
PIECES = 3
TILE = 128
_TILE_CELLS = 1 << 22
_BLOCK_BYTES = 1 << 22
#: Runs of more bytes get their checksum one by one.
_SHORT = 64


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t


_CRC = _crc_table()
_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)


def runs_of_letters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lower-cased bytes, first byte, bytes, code points) of the maximal runs of A-Z, a-z and U+00C0 to U+00FF.

    In UTF-8 the latter are the byte C3 and any one byte after it.
    """
    low = _LOWER[data]
    lead = low == 0xC3
    inside = ((low >= 97) & (low <= 122)) | lead
    inside[1:] |= lead[:-1]
    edge = np.diff(inside.astype(np.int8), prepend=np.int8(0)) == 1
    firsts = offsets[:-1]
    firsts = firsts[firsts < len(low)]
    edge[firsts] = inside[firsts]
    first = np.flatnonzero(edge)
    sums = np.concatenate(([0], np.cumsum(inside)))
    size = np.diff(np.append(sums[first], sums[-1]))
    leads = np.concatenate(([0], np.cumsum(lead)))
    return low, first, size, size - (leads[first + size] - leads[first])


def checksums(low: np.ndarray, first: np.ndarray, size: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Unsigned CRC-32 of each run, carried on from ``start``."""
    state = ~start
    order = np.argsort(-size, kind="stable")
    sizes = -size[order]
    for i in order[: np.searchsorted(sizes, -_SHORT, side="left")]:
        state[i] = ~np.uint32(zlib.crc32(low[first[i] : first[i] + size[i]].tobytes(), int(start[i])))
    rest = order[np.searchsorted(sizes, -_SHORT, side="left") :]
    reg, at, sizes = state[rest], first[rest], size[rest]
    for k in range(int(sizes[0]) if len(sizes) else 0):
        n = int(np.searchsorted(-sizes, -k, side="left"))
        reg[:n] = _CRC[(reg[:n] ^ low[at[:n] + k]) & 0xFF] ^ (reg[:n] >> np.uint32(8))
    state[rest] = reg
    return ~state


def _count_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in blocks(batches, "text", _BLOCK_BYTES):
        low, first, size, letters = runs_of_letters(b.data, b.offsets)
        ids = b.batch.column(0).slice(b.lo, b.hi - b.lo).to_pylist()
        start = np.array([zlib.crc32(f"{i}:".encode()) for i in ids], np.uint32)
        crc = checksums(low, first, size, start[np.searchsorted(b.offsets, first, side="right") - 1])
        marked = crc % EVERY == 0
        cut = []
        for i in np.flatnonzero(marked & (letters > LEAST_LETTERS)):
            run = low[first[i] : first[i] + size[i]].tobytes().decode()
            gone = int(crc[i]) % len(run)
            cut.append(run[:gone] + run[gone + 1 :])
        whole = ~marked & (letters >= LEAST_LETTERS)
        ends = np.cumsum(size[whole])
        at = np.repeat(first[whole] - (ends - size[whole]), size[whole]) + np.arange(ends[-1] if len(ends) else 0)
        offsets = pa.py_buffer(np.concatenate(([0], ends)).astype(np.int64))
        words = pa.Array.from_buffers(pa.large_string(), int(whole.sum()), [None, offsets, pa.py_buffer(low[at].tobytes())])
        counts = pa.concat_arrays([words, pa.array(cut, pa.large_string())]).value_counts()
        yield pa.RecordBatch.from_arrays([counts.field(0).cast(pa.string()), counts.field(1)], ["word", "n"])


def word_counts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``word, n`` for the words of enough letters and occurrences, after the marked runs lost a code point."""
    named = docs.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("id"), F.col(text_column).alias("text"))
    counts = named.mapInArrow(_count_block, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.filter(F.col("n") >= LEAST_COUNT)


def _cut(lo: Column, hi: Column) -> Column:
    """The windows, without empty ones, into which ``[lo, hi)`` is cut."""
    ends = [lo + F.floor((hi - lo) * F.lit(i) / F.lit(PIECES)).cast("int") for i in range(PIECES + 1)]
    made = F.array(*[F.struct(a.alias("lo"), b.alias("hi")) for a, b in zip(ends, ends[1:])])
    return F.filter(made, lambda w: w["lo"] < w["hi"])


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows ``word, n, extra, size, lo, hi`` with the ``key`` under which they meet others.

    ``size`` is the shorter length of the pairs looked for, ``extra`` 1 for a word that is longer by one.
    """
    before = F.substr("word", F.lit(1), F.col("lo"))
    after = F.substr("word", F.col("hi") + F.col("extra") + 1, F.col("size") - F.col("hi"))
    return rows.withColumn("key", F.concat_ws(" ", "size", "lo", "hi", before, after))


def _meeting(words: DataFrame) -> DataFrame:
    """The words under every key, in groups of bounded size."""
    length = F.char_length("word")
    roles = F.explode(F.array(F.lit(0), F.lit(1))).alias("extra")
    rows = words.select("word", "n", roles).withColumn("size", length - F.col("extra"))
    rows = rows.filter(F.col("size") >= 1).withColumn("window", F.explode(_cut(F.lit(0), F.col("size"))))
    rows = rows.select("word", "n", "extra", "size", "window.lo", "window.hi")
    done = None
    while True:
        rows = materialize(_keyed(rows), "windows")
        wide = F.col("hi") - F.col("lo") > 1
        large = rows.filter(wide).groupBy("key").count().filter(F.col("count") > GROUP).select("key")
        large = materialize(large, "large")
        if large.isEmpty():
            return rows if done is None else done.unionByName(rows)
        small = rows.join(large, "key", "left_anti")
        done = small if done is None else done.unionByName(small)
        rows = rows.join(large, "key", "left_semi").withColumn("window", F.explode(_cut(F.col("lo"), F.col("hi"))))
        rows = rows.select("word", "n", "extra", "size", "window.lo", "window.hi")


def _matrix(words: list[str], width: int) -> np.ndarray:
    return np.array(words, dtype=f"<U{width}").view(np.uint32).reshape(len(words), width)


def _common(a: np.ndarray, b: np.ndarray, alive: np.ndarray) -> np.ndarray:
    """Leading columns in which each row of ``a`` agrees with each row of ``b``, where ``alive``."""
    alive, out = alive.copy(), np.zeros(alive.shape, np.int32)
    for k in range(a.shape[1]):
        alive &= a[:, k, None] == b[None, :, k]
        if not alive.any():
            break
        out += alive
    return out


def near_pairs(
    words: list[str], group: np.ndarray, extra: np.ndarray, size: np.ndarray, lo: np.ndarray, hi: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of words one edit apart; rows of a group stand together and words differ within it."""
    n, width = len(words), max(map(len, words), default=0)
    tile = int(np.clip(_TILE_CELLS // max(1, width), 1, TILE))
    left, right = [], []
    starts = list(range(0, n, tile))
    kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def matrices(s: int) -> tuple[np.ndarray, np.ndarray]:
        if s not in kept:
            part = words[s : s + tile]
            kept[s] = _matrix(part, width), _matrix([w[::-1] for w in part], width)
        return kept[s]

    for s in starts:
        kept = {k: v for k, v in kept.items() if k >= s}
        i = slice(s, min(s + tile, n))
        for t in range(s, n, tile):
            if group[t] > group[i.stop - 1]:
                break
            j = slice(t, min(t + tile, n))
            pairs = (group[i, None] == group[None, j]) & ((extra[i, None] == 0) | (extra[None, j] == 0))
            if s == t:
                pairs &= np.arange(i.stop - s)[:, None] < np.arange(j.stop - t)[None, :]
            if not pairs.any():
                continue
            (a, a_back), (b, b_back) = matrices(s), matrices(t)
            front = _common(a, b, pairs)
            back = _common(a_back, b_back, pairs)
            longer = size[i, None] + np.maximum(extra[i, None], extra[None, j])
            here = (front >= lo[i, None]) & ((front < hi[i, None]) | ((front == size[i, None]) & (hi[i, None] == size[i, None])))
            x, y = np.nonzero(pairs & here & (front + back >= longer - 1))
            left.append(x + s)
            right.append(y + t)
    none = np.zeros(0, np.int64)
    return np.concatenate(left or [none]), np.concatenate(right or [none])


_NEAR = "word string, n_near bigint, best_n bigint, best string"


def _summed(rows: pa.Table) -> pa.RecordBatch:
    """For each word its near words in these groups: how many, and the most frequent one."""
    words = rows["word"].to_pylist()
    keys = rows["key"].combine_chunks()
    keys = keys if isinstance(keys, pa.Array) else pa.concat_arrays(keys.chunks)
    group = keys.dictionary_encode().indices.to_numpy()
    n = rows["n"].to_numpy()
    a, b = near_pairs(words, group, *(rows[c].to_numpy() for c in ("extra", "size", "lo", "hi")))
    of, near = np.concatenate((a, b)), np.concatenate((b, a))
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((rank[near], -n[near], of))
    at, first, count = np.unique(of[order], return_index=True, return_counts=True)
    best = near[order][first]
    return pa.RecordBatch.from_arrays(
        [pa.array([words[i] for i in at], pa.string()), pa.array(count, pa.int64()), pa.array(n[best], pa.int64()),
         pa.array([words[i] for i in best], pa.string())], ["word", "n_near", "best_n", "best"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups of a sorted partition, a few whole ones at a time."""
    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows])
        if rows.num_rows == 0:
            continue
        last = rows["key"][-1]
        same = pc.equal(rows["key"], last).to_numpy()
        cut = int(np.argmax(same))
        if cut:
            yield _summed(rows.slice(0, cut))
        held = rows.slice(cut)
    if held is not None and held.num_rows:
        yield _summed(held)


def near_words(words: DataFrame) -> DataFrame:
    """``word, n_near, best, best_n`` of each of the distinct words ``word, n`` that has a near one.

    ``best`` is the near word of largest n, of equal ones the smallest in code-point order.
    """
    met = _meeting(words).repartition("key").sortWithinPartitions("key")
    found = met.mapInArrow(_compare, _NEAR)
    first = F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("first")
    near = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first)
    return near.select("word", "n_near", F.col("first.best").alias("best"), (-F.col("first.less")).alias("best_n"))


def roots(forms: DataFrame, rounds: int) -> DataFrame:
    """``word, root`` of each ``word, form``: pointers double their reach in each round."""
    ahead = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(rounds):
        beyond = ahead.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        ahead = ahead.join(beyond, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"))
        ahead = materialize(ahead, "roots")
    return ahead


def spelling_variants(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word of the documents.

    ``form`` is the near word of largest n if it is ``RATIO`` times as frequent, ``root`` where following forms ends. As n
    grows by that factor with each form, a chain has a logarithmic length, and so many rounds find its end.
    """
    words = materialize(word_counts(docs, id_column, text_column), "words")
    near = near_words(words)
    better = F.col("best_n") >= F.col("n") * RATIO
    rows = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(better, F.col("best")).alias("form"), F.when(better, F.col("best_n")).alias("form_n"))
    rows = materialize(rows, "forms")
    most = rows.agg(F.max("n")).first()[0] or LEAST_COUNT
    longest = math.floor(math.log(most / LEAST_COUNT, RATIO)) + 1
    ends = roots(rows.filter("form IS NOT NULL"), math.ceil(math.log2(longest)) if longest > 1 else 0)
    joined = rows.join(ends.withColumnRenamed("word", "from"), F.col("word") == F.col("from"), "left").drop("from")
    return joined.withColumn("root", F.coalesce("root", "word"))
