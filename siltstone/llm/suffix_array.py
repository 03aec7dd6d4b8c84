"""Linear suffix array construction by groups of equal Lyndon prefixes, and suffix-array dedup.

``suffix_order`` sorts the suffixes of one string of integers. ``repeated_bytes`` finds, in a table of texts,
every byte that lies in a string of ``length`` bytes which also starts elsewhere:

1. Of every ``length``-byte string the k-gram with the smallest hash is its anchor, so equal strings have
   equal anchors at equal offsets. Only anchors that occur twice or more go on.
2. Strings around such an anchor are taken in sets of ``STARTS`` consecutive starts. All strings of a set share
   a middle; what differs are the ``STARTS - 1`` bytes before and after it. Sets with equal middles
   meet under the 128-bit hash of the middle; equal sets are counted before.
3. The distinct sets of a middle, each as left bytes, one symbol for the middle, and right bytes, form one
   string with separators. Two strings of ``length`` bytes are equal where two suffixes of it share
   ``STARTS`` symbols: neighbours in the suffix array tell for every start. Columns in which
   the same sets agree are one symbol that counts for its width.
4. A middle with more than ``LIMIT`` distinct sets is not brought into one task: its starts are counted one by
   one under their whole content.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.textbytes import blocks, mix
from siltstone.scratch import materialize

LENGTH = 400
GRAM = 128
STARTS = 64
LIMIT = 4096
CHUNK = 4 << 20
_EDGE = STARTS - 1
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_POSITION_BITS = 23


# --- Suffix array -----------------------------------------------------------------------------


def lyndon_groups(symbols: list[int]) -> tuple[list[int], list[int]]:
    """Group of each suffix by its longest Lyndon prefix, and its previous-smaller pointer.

    A group is named by where it starts in the suffix array. Groups are final from the highest down. When a
    group is reached, each of its suffixes points to the nearest suffix before it of a lower group, whose
    Lyndon prefix it continues; that one moves to the end of its own group, further if it is pointed
    to more than once.
    """
    n = len(symbols)
    order = np.argsort(np.asarray(symbols), kind="stable")
    ranked = np.asarray(symbols)[order]
    begins = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])) if n else np.zeros(0, np.int64)
    sizes = np.diff(np.append(begins, n))
    group_of = np.empty(n, np.int64)
    group_of[order] = np.repeat(begins, sizes)
    place_of = np.empty(n, np.int64)
    place_of[order] = np.arange(n)
    row, group, place = order.tolist(), group_of.tolist(), place_of.tolist()
    stop = dict(zip(begins.tolist(), (begins + sizes).tolist(), strict=True))
    smaller = [-1] * n
    end = n
    while end:
        first = group[row[end - 1]]
        members = row[first:end] if end - first == 1 else sorted(row[first:end])
        pointed: dict[int, int] = {}
        for i in members:
            j = i - 1
            while j >= 0 and group[j] >= first:
                j = smaller[j]
            smaller[i] = j
            if j >= 0:
                pointed[j] = pointed.get(j, 0) + 1
        end = first
        if not pointed:
            continue
        by_times: dict[tuple[int, int], list[int]] = {}
        for j, times in pointed.items():
            by_times.setdefault((-times, group[j]), []).append(j)
        for (_, own), moved in sorted(by_times.items()) if len(by_times) > 1 else by_times.items():
            limit = stop[own]
            to = limit - len(moved)
            if to > own:
                slots = range(to, limit)
                inside = {j for j in moved if place[j] >= to}
                free = [x for x in slots if row[x] not in inside]
                for j, x in zip((j for j in moved if j not in inside), free, strict=True):
                    other, old = row[x], place[j]
                    row[x], row[old] = j, other
                    place[j], place[other] = x, old
                for j in moved:
                    group[j] = to
                stop[to] = limit
            stop[own] = to if to > own else limit
            if to == own:
                # All that is left of the group: it keeps its name, and nothing of it may move again.
                stop[own] = limit
    return group, smaller


def suffix_order(symbols: list[int]) -> list[int]:
    """Suffixes in ascending order, by the order of groups and one pass over the result.

    A suffix's Lyndon prefix ends where its next smaller suffix starts. So when suffix k is emitted, those whose
    Lyndon prefix ends at k follow as next of their groups: k - 1 and, by previous-smaller
    pointers, the ones before it, up to one that is already there.
    """
    n = len(symbols)
    group, smaller = lyndon_groups(symbols)
    out = [-1] * n
    front = {}
    placed = bytearray(n)
    for at in range(-1, n):
        j = (n if at < 0 else out[at]) - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            x = front.get(g, g)
            out[x] = j
            front[g] = x + 1
            placed[j] = 1
            j = smaller[j]
    return out


# --- Anchors and sets -------------------------------------------------------------------------

_inverse = [pow(b, -1, 1 << 64) for b in _BASES]


class Hashes:
    """Hashes of any substring of a byte array, for each of two bases."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums, self.back = [], []
        with np.errstate(over="ignore"):
            for base, inverse in zip(_BASES, _inverse, strict=True):
                power = _power_table(base, n)
                total = np.zeros(n + 1, np.uint64)
                np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], out=total[1:])
                self.sums.append(total)
                self.back.append(_power_table(inverse, n))

    def of(self, at: np.ndarray, length: int, which: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.sums[which][at + length] - self.sums[which][at]) * self.back[which][at] + np.uint64(length))


_tables: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    """base ** i for i to n; kept for the blocks of a worker."""
    if base not in _tables or len(_tables[base]) <= n:
        with np.errstate(over="ignore"):
            grown = np.full(max(n + 1, 1 << 21), base, np.uint64)
            grown[0] = 1
            _tables[base] = np.multiply.accumulate(grown)
    return _tables[base]


def _window_least(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every ``width`` neighbours."""
    n = len(values) - width + 1
    rows = -(-len(values) // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    padded = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of starts with one anchor: its position and hash, the first and the last start."""
    found = []
    for text_lo in range(0, max(1, len(data)), CHUNK):
        lo, hi = text_lo, min(len(data), text_lo + CHUNK + LENGTH - 1)
        if hi - lo < LENGTH:
            break
        part = data[lo:hi]
        gram = Hashes(part).of(np.arange(len(part) - GRAM + 1), GRAM, 0)
        keyed = (gram >> np.uint64(_POSITION_BITS) << np.uint64(_POSITION_BITS)) | np.arange(len(gram), dtype=np.uint64)
        least = _window_least(keyed, LENGTH - GRAM + 1)
        at = (least & np.uint64((1 << _POSITION_BITS) - 1)).astype(np.int64)
        start = np.arange(len(at))
        text = np.searchsorted(offsets, start + lo, side="right") - 1
        valid = start + lo + LENGTH <= offsets[text + 1]
        start, at, text = start[valid], at[valid], text[valid]
        if len(start) == 0:
            continue
        new = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (text[1:] != text[:-1])))
        last = np.append(new[1:], len(start)) - 1
        found.append((at[new] + lo, gram[at[new]], start[new] + lo, start[last] + lo))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none.astype(np.uint64), none, none
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _texts(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = F.coalesce(F.col(text_column), F.lit(""))
    return docs.select(F.col(id_column).alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def anchor_rows(texts: DataFrame) -> DataFrame:
    """``id``, ``text_hash``, ``anchor`` and its position ``at`` in the text."""
    kind = texts.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            at, key, first, _ = anchors(block.data, block.offsets)
            text = np.searchsorted(block.offsets, first, side="right") - 1
            row = pa.array(text + block.lo)
            # A long text's chunks may name an anchor twice: it is one occurrence.
            once = np.append(True, (at[1:] != at[:-1]) | (text[1:] != text[:-1])) if len(at) else np.zeros(0, bool)
            out = pa.RecordBatch.from_arrays(
                [block.batch.column(0).take(row), block.batch.column(1).take(row),
                 pa.array(key.view(np.int64)), pa.array(at - block.offsets[text])],
                names=["id", "text_hash", "anchor", "at"])
            yield out.filter(pa.array(once))

    return texts.mapInArrow(run, f"id {kind}, text_hash bigint, anchor bigint, at bigint")


def set_rows(candidates: DataFrame) -> DataFrame:
    """The sets of starts around the repeated anchors of each text.

    ``k1, k2`` hash the middle; ``edges`` are the bytes before and after it and how many of
    either lie outside the text; ``first`` is the first start, which may lie before the text.
    """
    kind = candidates.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            data, offsets = block.data, block.offsets
            p, _, first, last = anchors(data, offsets)
            if len(p) == 0:
                continue
            text = np.searchsorted(offsets, first, side="right") - 1
            wanted = block.batch.column(block.batch.schema.get_field_index("anchors_at")).slice(block.lo, block.hi - block.lo)
            counts = np.diff(wanted.offsets.to_numpy())
            hit = np.repeat(offsets[:-1], counts) + wanted.flatten().to_numpy()
            keep = np.isin(p, hit)
            p, first, last, text = p[keep], first[keep], last[keep], text[keep]
            if len(p) == 0:
                continue
            low, high = (p - last) // STARTS, (p - first) // STARTS
            n = high - low + 1
            q = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            p, text = np.repeat(p, n), np.repeat(text, n)
            middle = p - q * STARTS
            begin, after = middle - _EDGE, middle + LENGTH - _EDGE
            hashes = Hashes(data)
            # Two anchors of one text may lead to one middle; their sets are told apart by the offset.
            apart = mix(q.astype(np.uint64))
            keys = [(hashes.of(middle, LENGTH - _EDGE, i) ^ apart).view(np.int64) for i in (0, 1)]
            for a in range(0, len(p), 8192):
                s = slice(a, a + 8192)
                lo, hi = offsets[text[s]], offsets[text[s] + 1]
                left = begin[s][:, None] + np.arange(_EDGE)
                right = after[s][:, None] + np.arange(_EDGE)
                edges = np.empty((len(left), 2 * STARTS), np.uint8)
                edges[:, :_EDGE] = np.where(left >= lo[:, None], data[np.maximum(left, 0)], 0)
                edges[:, _EDGE : 2 * _EDGE] = np.where(right < hi[:, None], data[np.minimum(right, len(data) - 1)], 0)
                edges[:, -2] = np.clip(lo - begin[s], 0, _EDGE)
                edges[:, -1] = np.clip(after[s] + _EDGE - hi, 0, _EDGE)
                row = pa.array(text[s] + block.lo)
                packed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(2 * STARTS), len(edges), [None, pa.py_buffer(edges.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[0][s]), pa.array(keys[1][s]), packed.cast(pa.binary()),
                     block.batch.column(0).take(row), block.batch.column(1).take(row), pa.array(begin[s] - lo)],
                    names=["k1", "k2", "edges", "id", "text_hash", "first"])

    return candidates.mapInArrow(
        run, f"k1 bigint, k2 bigint, edges binary, id {kind}, text_hash bigint, first bigint")


# --- Deciding sets ----------------------------------------------------------------------------


def _inside(edges: np.ndarray) -> np.ndarray:
    """For each set, which starts have all their bytes in the text."""
    start = np.arange(STARTS)
    return (start >= edges[:, -2, None]) & (start < STARTS - edges[:, -1, None].astype(np.int64))


def repeated_starts(group: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """For distinct sets sorted by group, the starts at which two sets of a group have one string."""
    rows, width = len(edges), 2 * _EDGE
    code = edges[:, :width].astype(np.int64)
    column = np.arange(width)
    out_left = column < edges[:, -2, None]
    out_right = column >= width - edges[:, -1, None].astype(np.int64)
    code = np.where(out_left | out_right, 256 + np.arange(rows)[:, None], code)
    # Columns that split a group's sets in the same way are one symbol.
    groups = int(group[-1]) + 1
    kinds = [np.bincount(np.unique(group << 32 | code[:, c]) >> 32, minlength=groups) for c in range(width)]
    fresh = np.ones((groups, width), bool)
    for c in range(1, width):
        if c != _EDGE:
            both = np.unique(group << 44 | code[:, c - 1] << 22 | code[:, c]) >> 44
            pairs = np.bincount(both, minlength=groups)
            fresh[:, c] = (pairs != kinds[c]) | (pairs != kinds[c - 1])
    # Left columns, the middle, right columns, a separator.
    total = width + 2
    used = np.ones((rows, total), bool)
    used[:, :_EDGE] = fresh[group, :_EDGE]
    used[:, STARTS : total - 1] = fresh[group, _EDGE:]
    value = np.zeros((rows, total), np.int64)
    value[:, :_EDGE] = code[:, :_EDGE] + 1
    value[:, STARTS : total - 1] = code[:, _EDGE:] + 1
    value[:, -1] = 1 + np.arange(rows)
    row, column = np.nonzero(used)
    wide = np.diff(np.append(column, 0))
    wide[column == total - 1] = 0
    key = (group[row] << 32 | value[row, column]) * total + column
    _, symbol = np.unique(key, return_inverse=True)
    order = np.asarray(suffix_order(symbol.tolist()))
    # Common symbols of neighbours, counted by width.
    a, b = order[:-1].copy(), order[1:].copy()
    common = np.zeros(len(a), np.int64)
    alive = np.arange(len(a))
    step = 0
    while len(alive):
        x, y = a[alive] + step, b[alive] + step
        ok = np.maximum(x, y) < len(symbol)
        ok[ok] = symbol[x[ok]] == symbol[y[ok]]
        alive = alive[ok]
        common[alive] += wide[a[alive] + step]
        step += 1
    best = np.zeros(len(symbol), np.int64)
    np.maximum.at(best, order[:-1], common)
    np.maximum.at(best, order[1:], common)
    # A suffix of ``best`` common bytes holds equal strings at its first best - STARTS + 1 columns.
    reach = np.minimum(best - STARTS + 1, wide)
    hit = (column <= _EDGE) & (reach > 0)
    mark = np.zeros((rows, STARTS + 1), np.int64)
    np.add.at(mark, (row[hit], column[hit]), 1)
    np.add.at(mark, (row[hit], column[hit] + reach[hit]), -1)
    return np.cumsum(mark, axis=1)[:, :STARTS] > 0


def _decide(tables: list[pa.Table]) -> pa.RecordBatch:
    table = pa.concat_tables(tables).combine_chunks()
    k1, k2 = table.column("k1").to_numpy(), table.column("k2").to_numpy()
    times = table.column("times").to_numpy()
    edges = np.frombuffer(b"".join(table.column("edges").to_pylist()), np.uint8).reshape(len(k1), 2 * STARTS)
    group = np.cumsum(np.append(False, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]))).astype(np.int64)
    starts = (times > 1)[:, None] & _inside(edges)
    several = np.bincount(group)[group] > 1
    if several.any():
        _, dense = np.unique(group[several], return_inverse=True)
        starts[several] |= repeated_starts(dense, edges[several])
    keep = starts.any(axis=1)
    packed = np.packbits(starts[keep], axis=1, bitorder="little")
    return pa.RecordBatch.from_arrays(
        [pa.array(k1[keep]), pa.array(k2[keep]), pa.array([edges[i].tobytes() for i in np.flatnonzero(keep)], pa.binary()),
         pa.array([x.tobytes() for x in packed], pa.binary())], names=["k1", "k2", "edges", "starts"])


def _decider(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole groups, some thousand sets at a time."""
    held: list[pa.Table] = []
    rows = 0
    for batch in batches:
        table = pa.Table.from_batches([batch])
        k = np.stack([table.column("k1").to_numpy(), table.column("k2").to_numpy()], 1)
        cuts = np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1
        if held and len(k):
            last = held[-1].slice(held[-1].num_rows - 1)
            if (last.column("k1")[0].as_py(), last.column("k2")[0].as_py()) != (int(k[0, 0]), int(k[0, 1])):
                cuts = np.append(0, cuts)
        done = 0
        for cut in cuts.tolist():
            if rows + cut - done >= 4096:
                yield _decide([*held, table.slice(done, cut - done)])
                held, rows, done = [], 0, cut
        if done < table.num_rows:
            held.append(table.slice(done))
            rows += table.num_rows - done
    if held:
        yield _decide(held)


def _one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The starts of the sets of a large group under the hash of their strings' differing bytes."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 1024):
            part = batch.slice(lo, 1024)
            rows, start, content = [], [], []
            for i, e in enumerate(part.column("edges").to_pylist()):
                for s in range(e[-2], STARTS - e[-1]):
                    rows.append(i)
                    start.append(s)
                    content.append(hashlib.sha256(e[s:_EDGE] + b"|" + e[_EDGE : _EDGE + s]).digest()[:16])
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(part.column(part.schema.get_field_index(n)).take(at) for n in ("k1", "k2", "edges", "times")),
                 pa.array(start, pa.int32()), pa.array(content, pa.binary())],
                names=["k1", "k2", "edges", "times", "start", "content"])


def decided_sets(sets: DataFrame) -> DataFrame:
    """``k1, k2, edges`` and ``starts``, bits of the repeated starts, of sets that have any."""
    counted = materialize(sets.groupBy("k1", "k2", "edges").agg(F.count(F.lit(1)).alias("times")), "sets")
    # Sets of one middle are counted by tasks first, and a middle of very many is joined in parts.
    several = counted.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("distinct"))
    counted = materialize(counted.join(several, ["k1", "k2"]).filter("times > 1 OR distinct > 1"), "counted")
    schema = "k1 bigint, k2 bigint, edges binary, starts binary"
    few = (
        counted.filter(F.col("distinct") <= LIMIT).drop("distinct")
        .repartition("k1", "k2").sortWithinPartitions("k1", "k2").mapInArrow(_decider, schema)
    )
    many = counted.filter(F.col("distinct") > LIMIT).drop("distinct")
    each = many.mapInArrow(
        _one_by_one, "k1 bigint, k2 bigint, edges binary, times bigint, start int, content binary")
    again = each.groupBy("k1", "k2", "start", "content").agg(F.sum("times").alias("all")).filter("all > 1").drop("all")
    bits = each.join(again, ["k1", "k2", "start", "content"]).groupBy("k1", "k2", "edges").agg(F.collect_set("start").alias("on"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mark = np.zeros((batch.num_rows, STARTS), np.uint8)
            for i, on in enumerate(batch.column("on").to_pylist()):
                mark[i, on] = 1
            packed = np.packbits(mark, axis=1, bitorder="little")
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in ("k1", "k2", "edges")), pa.array([x.tobytes() for x in packed], pa.binary())],
                names=["k1", "k2", "edges", "starts"])

    return few.union(bits.mapInArrow(pack, schema))


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: the id, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256``; and
    ``kept``, the remaining bytes, null where nothing is removed.

    A byte goes if a string of ``LENGTH`` bytes that covers it also starts elsewhere in the table, its own
    text included. Null texts are empty. Every row is a text: rows that repeat id and text are copies of
    each other. Ids may be null; only id and text are read. An empty table gives no rows.
    """
    texts = _texts(docs, id_column, text_column)
    found = materialize(anchor_rows(texts), "anchors")
    # Written, so that the join has two exchanges and Spark may split an anchor with very many places.
    twice = materialize(found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "twice")
    wanted = found.join(twice, "anchor").groupBy("id", "text_hash").agg(F.collect_set("at").alias("anchors_at"))
    wanted = wanted.withColumnsRenamed({"id": "wid", "text_hash": "whash"})
    same = texts["id"].eqNullSafe(wanted["wid"]) & (texts["text_hash"] == wanted["whash"])
    candidates = materialize(texts.join(wanted, same).select("id", "text_hash", "text", "anchors_at"), "candidates")

    sets = set_rows(candidates)
    decided = materialize(decided_sets(sets).select("k1", "k2", F.sha2("edges", 256).alias("edge_hash"), "starts"), "decided")
    spans = (
        sets.select("k1", "k2", F.sha2("edges", 256).alias("edge_hash"), "id", "text_hash", "first")
        .join(decided, ["k1", "k2", "edge_hash"])
        .groupBy("id", "text_hash")
        .agg(F.collect_set(F.struct("first", "starts")).alias("hits"))
        .withColumnsRenamed({"id": "wid", "text_hash": "whash"})
    )
    same = candidates["id"].eqNullSafe(spans["wid"]) & (candidates["text_hash"] == spans["whash"])
    cut = candidates.join(spans, same).select("id", "text_hash", "text", "hits").mapInArrow(
        _cutter, f"id {texts.schema['id'].dataType.simpleString()}, text_hash bigint, n_removed bigint, n_spans bigint, kept binary")
    cut = cut.dropDuplicates(["id", "text_hash"]).withColumnsRenamed({"id": "wid", "text_hash": "whash"})
    plain = texts.select("id", "text_hash", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("whole"))
    same = plain["id"].eqNullSafe(cut["wid"]) & (plain["text_hash"] == cut["whash"])
    return plain.join(cut, same, "left").select(
        F.col("id").alias(id_column), "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce(F.sha2("kept", 256), F.col("whole")).alias("kept_sha256"),
        "kept",
    )


def _cutter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches, "text"):
        part = block.batch.slice(block.lo, block.hi - block.lo)
        hits = part.column(part.schema.get_field_index("hits"))
        bounds = np.concatenate([[0], np.cumsum(np.diff(hits.offsets.to_numpy()))])
        flat = hits.flatten()
        first = flat.field(0).to_numpy()
        packed = np.frombuffer(b"".join(flat.field(1).to_pylist()), np.uint8).reshape(-1, STARTS // 8)
        removed, spans, kept = [], [], []
        for i, (lo, hi) in enumerate(zip(block.offsets, block.offsets[1:], strict=False)):
            own = slice(bounds[i], bounds[i + 1])
            at, start = np.nonzero(np.unpackbits(packed[own], axis=1, bitorder="little"))
            repeated = np.zeros(hi - lo, np.int32)
            repeated[first[own][at] + start] = 1
            # A byte goes if one of the LENGTH starts up to it is repeated.
            before = np.cumsum(repeated)
            gone = before > 0
            gone[LENGTH:] = before[LENGTH:] > before[:-LENGTH]
            removed.append(int(gone.sum()))
            spans.append(int((gone & ~np.append(False, gone[:-1])).sum()))
            kept.append(block.data[lo:hi][~gone].tobytes())
        yield pa.RecordBatch.from_arrays(
            [part.column(part.schema.get_field_index("id")), part.column(part.schema.get_field_index("text_hash")),
             pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
            names=["id", "text_hash", "n_removed", "n_spans", "kept"])
