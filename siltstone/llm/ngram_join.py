"""Jaccard self-join on word shingles with Bayesian pruning of candidates.

1. A text is the set of its ``SHINGLE``-word shingles, as 64-bit hashes. Texts with equal sets are one
   class, represented by the smallest id; copies take no further part.
2. Each representative gets ``HASHES`` MinHash values of one byte, and a key for each of ``BANDS`` bands of
   ``ROWS`` of the full values. Representatives with an equal key are candidates.
3. Pairs in a bucket are compared ``STEP`` values at a time. A pair ends as soon as the posterior
   probability that its similarity reaches the threshold, given the matches so far and a
   uniform prior, falls below ``TOLERANCE``. The bound is for one look; summed over all looks a pair at
   0.8 is lost with probability 8.5e-5, one at 0.82 with 1.7e-5. The pairs left connect texts to candidate groups.
4. Within a group all pairs are pruned in the same way and the rest verified on the full shingle sets.

Large buckets and groups are cut into parts of ``PART`` members; a task compares two parts and returns
counts of links and the edges of a spanning forest, never the pairs. So the work on many different
texts that are all alike grows with their pairs, but no table does.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.components import components
from siltstone.llm.names import unused
from siltstone.llm.textbytes import blocks, mix, rolling, words
from siltstone.scratch import materialize

SHINGLE = 5
THRESHOLD = 0.8
HASHES = 128
BANDS, ROWS = 25, 5
STEP = 16
TOLERANCE = 1e-5
PART = 256
_HASH_SLICE = 1 << 11

_rng = np.random.default_rng(20240101)
_MULTIPLY = (_rng.integers(0, 1 << 32, HASHES, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_ADD = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)
_BAND = _rng.integers(0, 1 << 63, ROWS, dtype=np.uint64) | np.uint64(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text. A text of fewer words than a shingle has one
    shingle of all its words; a text without words has none."""
    first, _, word = words(data, offsets)
    bounds = np.searchsorted(first, offsets)
    shingle = rolling(word, SHINGLE)
    out = []
    for a, b in zip(bounds.tolist(), bounds[1:].tolist(), strict=False):
        if b - a >= SHINGLE:
            out.append(np.unique(shingle[a : b - SHINGLE + 1]))
        elif b > a:
            out.append(mix(rolling(word[a:b], b - a) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def min_hashes(shingles: np.ndarray) -> np.ndarray:
    """``HASHES`` minima over a set, as unsigned 32-bit."""
    low = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(x), _HASH_SLICE):
        part = x[None, at : at + _HASH_SLICE] * _MULTIPLY[:, None] + _ADD[:, None]
        low = np.minimum(low, part.min(axis=1))
    return low


def band_keys(low: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band."""
    with np.errstate(over="ignore"):
        rows = low[: BANDS * ROWS].reshape(BANDS, ROWS).astype(np.uint64) * _BAND
        return mix(rows.sum(axis=1) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def least_matches(threshold: float, tolerance: float) -> np.ndarray:
    """For n = STEP, 2 STEP, ...: the fewest matches at which a pair goes on.

    One-byte values of texts of similarity s match with probability ``s + (1 - s) / 256``.
    """
    s = (np.arange(20_000) + 0.5) / 20_000
    p = s + (1 - s) / 256
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        m = np.arange(n + 1)[:, None]
        log = m * np.log(p) + (n - m) * np.log1p(-p)
        weight = np.exp(log - log.max(axis=1, keepdims=True))
        above = weight[:, s >= threshold].sum(axis=1) / weight.sum(axis=1)
        out.append(int(np.argmax(above >= tolerance)))
    return np.array(out)


def survivors(left: np.ndarray, right: np.ndarray, least: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the pairs ``(a[i], b[i])`` of signature rows are not pruned."""
    alive = np.arange(len(a))
    matches = np.zeros(len(a), np.int16)
    for step, enough in enumerate(least):
        at = slice(step * STEP, (step + 1) * STEP)
        matches = matches + (left[a[alive], at] == right[b[alive], at]).sum(axis=1, dtype=np.int16)
        keep = matches >= enough
        alive, matches = alive[keep], matches[keep]
    return alive


def _texts(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = F.coalesce(F.col(text_column), F.lit(""))
    return docs.select(F.col(id_column).cast("long").alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def signatures(texts: DataFrame) -> DataFrame:
    """Per row: id, text hash, class hash, number of shingles, signature and band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            sets = shingle_sets(block.data, block.offsets)
            low = [min_hashes(x) for x in sets]
            own = block.batch.slice(block.lo, block.hi - block.lo)
            yield pa.RecordBatch.from_arrays(
                [own.column(0), own.column(1),
                 pa.array([hashlib.sha256(x.tobytes()).digest()[:16] for x in sets], pa.binary()),
                 pa.array([len(x) for x in sets], pa.int32()),
                 pa.array([x.astype(np.uint8).tobytes() for x in low], pa.binary()),
                 pa.array([band_keys(x) for x in low], pa.list_(pa.int64()))],
                names=["id", "text_hash", "class", "size", "signature", "bands"])

    return texts.mapInArrow(
        run, "id bigint, text_hash bigint, class binary, size int, signature binary, bands array<bigint>")


def with_sets(rows: DataFrame) -> DataFrame:
    """Rows with a ``text``: the text replaced by its signature and its shingle set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            sets = shingle_sets(block.data, block.offsets)
            own = block.batch.slice(block.lo, block.hi - block.lo)
            keep = [n for n in own.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(own.column(own.schema.get_field_index(n)) for n in keep),
                 pa.array([min_hashes(x).astype(np.uint8).tobytes() for x in sets], pa.binary()),
                 pa.array([x.tobytes() for x in sets], pa.binary())],
                names=[*keep, "signature", "shingles"])

    schema = ", ".join(f"{n} {t}" for n, t in rows.dtypes if n != "text")
    return rows.mapInArrow(run, f"{schema}, signature binary, shingles binary")


class Forest:
    """Union-find over the members of one comparison."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i == j:
            return False
        self.up[max(i, j)] = min(i, j)
        return True


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal keys, across batches; keys are integers."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        values = np.stack([batch.column(batch.schema.get_field_index(k)).to_numpy() for k in keys], 1)
        cuts = np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(values)], strict=True):
            if last is not None and tuple(values[a]) != last:
                yield pa.Table.from_batches(held)
                held = []
            last = tuple(values[a])
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _parts(rows: DataFrame, group: str, members: str) -> DataFrame:
    """Copies of the rows of a group for every pair of its parts, dealt out and sorted by pair.

    ``part`` is the row's own part, ``pa <= pb`` the pair. A group of one part has the pair (0, 0).
    """
    parts = F.ceil(F.col(members) / F.lit(PART)).cast("int")
    pair = F.explode(F.sequence(F.lit(0), parts - 1))
    return (
        rows.withColumn("part", F.pmod(F.xxhash64("rep"), parts).cast("int"))
        .withColumn("other", pair)
        .withColumn("pa", F.least("part", "other"))
        .withColumn("pb", F.greatest("part", "other"))
        .drop("other", members)
        .repartition(group, "pa", "pb")
        .sortWithinPartitions(group, "pa", "pb", "rep")
    )


def _pairs(part: np.ndarray, pa_: int, pb: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of the two parts, or of the one part."""
    if pa_ == pb:
        return np.triu_indices(len(part), 1)
    left, right = np.flatnonzero(part == pa_), np.flatnonzero(part == pb)
    return np.repeat(left, len(right)), np.tile(right, len(left))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), width)


def candidate_edges(reps: DataFrame, least: np.ndarray) -> DataFrame:
    """Edges ``a``-``b`` of spanning forests over the pairs that share a band and are not pruned."""
    keys = reps.select("rep", F.explode("bands").alias("band"))
    shared = keys.groupBy("band").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    met = materialize(keys.join(shared, "band"), "buckets")
    dealt = _parts(met.join(reps.select("rep", "signature"), "rep"), "band", "members")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: set[tuple[int, int]] = set()
        for table in _groups(batches, ["band", "pa", "pb"]):
            rep = table.column("rep").to_numpy()
            a, b = _pairs(table.column("part").to_numpy(), table.column("pa")[0].as_py(), table.column("pb")[0].as_py())
            if len(a) == 0:
                continue
            signature = _matrix(table.column("signature"), HASHES)
            alive = survivors(signature, signature, least, a, b)
            forest = Forest(len(rep))
            out.update((int(rep[i]), int(rep[j])) for i, j in zip(a[alive].tolist(), b[alive].tolist(), strict=True) if forest.join(i, j))
            if len(out) >= 4096:
                yield _edges(out)
                out = set()
        yield _edges(out)

    return dealt.mapInArrow(run, "a bigint, b bigint").distinct()


def _edges(pairs: set[tuple[int, int]]) -> pa.RecordBatch:
    pairs = sorted(pairs)
    return pa.RecordBatch.from_arrays(
        [pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], names=["a", "b"])


def _once(table: pa.Table) -> pa.Table:
    """Repeated rows of one text, which lie anywhere in the comparison, once."""
    seen: set[bytes] = set()
    rows = [i for i, x in enumerate(table.column("class").to_pylist()) if not (x in seen or seen.add(x))]
    return table if len(rows) == table.num_rows else table.take(rows)


def _links(table: pa.Table, least: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of the linked pairs of a comparison, verified on the full sets."""
    a, b = _pairs(table.column("part").to_numpy(), table.column("pa")[0].as_py(), table.column("pb")[0].as_py())
    signature = _matrix(table.column("signature"), HASHES)
    alive = survivors(signature, signature, least, a, b)
    a, b = a[alive], b[alive]
    sets = [np.frombuffer(x.as_py(), np.uint64) for x in table.column("shingles")]
    size = np.array([len(x) for x in sets])
    # Sets can only reach the threshold if their sizes do.
    fits = np.minimum(size[a], size[b]) >= threshold * np.maximum(size[a], size[b])
    a, b = a[fits], b[fits]
    if len(a) > 8 * len(sets):
        both = _all_overlaps(sets)[a, b]
    else:
        both = np.array([_overlap(sets[i], sets[j]) for i, j in zip(a.tolist(), b.tolist(), strict=True)], np.int64)
    linked = both >= threshold * (size[a] + size[b] - both) - 1e-9
    return a[linked], b[linked], size


def _overlap(x: np.ndarray, y: np.ndarray) -> int:
    x, y = (x, y) if len(x) <= len(y) else (y, x)
    at = np.searchsorted(y, x)
    return int((y[np.minimum(at, len(y) - 1)] == x).sum()) if len(y) else 0


def _all_overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, by products of membership matrices over slices of the shingles."""
    every, column = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(sets), len(sets)), np.float32)
    for lo in range(0, len(every), 8192):
        a, b = np.searchsorted(column, [lo, lo + 8192])
        member = np.zeros((len(sets), min(8192, len(every) - lo)), np.float32)
        member[row[a:b], column[a:b] - lo] = 1
        out += member @ member.T
    return out.astype(np.int64)


def similar_texts(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    threshold: float = THRESHOLD,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """One row per input row: the id, ``class_id``, ``n_copies``, ``n_links`` and ``group_id``.

    ``class_id`` is the smallest id with an equal shingle set and ``n_copies`` the rows of that class;
    ``n_links`` counts the other classes with a similarity of at least ``threshold``; ``group_id``
    is the smallest id connected by copies and links. Words are runs of ASCII letters and digits and
    of other characters beyond ASCII, ASCII lower-cased. Texts without words, null ones too, are alone:
    each is its own class and group. Rows with a null id are alone as well and have null class and
    group. Rows that repeat an id are one node: their links add up under the id. Ids are whole numbers.
    """
    least = least_matches(threshold, tolerance)
    texts = _texts(docs, id_column, text_column)
    every = materialize(signatures(texts), "signatures")
    # Signature and bands follow from the class, so any row of it has them.
    reps = materialize(
        every.filter("size > 0 AND id IS NOT NULL").groupBy("class")
        .agg(F.min(F.struct("id", "text_hash")).alias("least"), F.count(F.lit(1)).alias("n"),
             F.first("signature").alias("signature"), F.first("bands").alias("bands"))
        .select("class", F.col("least.id").alias("rep"), F.col("least.text_hash").alias("rep_hash"), "n", "signature", "bands"),
        "classes")
    classes = reps.select("class", "rep", "n")
    near = components(candidate_edges(reps, least))
    members = near.groupBy("root").agg(F.count(F.lit(1)).alias("members"))
    grouped = near.join(members, "root").withColumnRenamed("node", "rep").join(reps.select("rep", "rep_hash", "class"), "rep")
    # Only members of a group need their sets, made anew from their texts.
    is_rep = (texts["id"] == grouped["rep"]) & (texts["text_hash"] == grouped["rep_hash"])
    sets = with_sets(texts.join(grouped, is_rep).select("rep", "class", "root", "members", "text"))
    dealt = _parts(sets, "root", "members")
    found = materialize(dealt.mapInArrow(_verifier(least, threshold), "a bigint, b bigint, class binary, links bigint"), "links")
    edges = found.filter("b IS NOT NULL").select("a", "b")
    links = found.filter("links > 0").groupBy("class").agg(F.sum("links").alias("n_links"))
    groups = components(edges)
    per_class = (
        classes.join(links, "class", "left")
        .join(groups.withColumnRenamed("node", "rep"), "rep", "left")
        .select("class", "rep", "n", F.coalesce("n_links", F.lit(0)).alias("n_links"),
                F.coalesce("root", "rep").alias("group"))
    )
    alone = (F.col("size") == 0) | F.col("id").isNull()
    rows = every.select("id", "class", "size")
    # A class may hold a third of all rows; a left join of the rows is one that Spark can split.
    return rows.join(per_class, "class", "left").select(
        F.col("id").alias(id_column),
        F.when(alone, F.col("id")).otherwise(F.col("rep")).cast("long").alias("class_id"),
        F.when(alone, F.lit(1)).otherwise(F.col("n")).cast("long").alias("n_copies"),
        F.when(alone, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"),
        F.when(alone, F.col("id")).otherwise(F.col("group")).cast("long").alias("group_id"),
    )


def _verifier(least: np.ndarray, threshold: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, ["root", "pa", "pb"]):
            table = _once(table)
            rep, classes = table.column("rep").to_numpy(), table.column("class").to_pylist()
            a, b, size = _links(table, least, threshold)
            forest = Forest(len(rep))
            edges = [(int(rep[i]), int(rep[j])) for i, j in zip(a.tolist(), b.tolist(), strict=True) if forest.join(i, j)]
            count = np.bincount(np.concatenate([a, b]), minlength=len(size))
            some = np.flatnonzero(count)
            n = len(edges) + len(some)
            yield pa.RecordBatch.from_arrays(
                [pa.array([e[0] for e in edges] + [None] * len(some), pa.int64()),
                 pa.array([e[1] for e in edges] + [None] * len(some), pa.int64()),
                 pa.array([None] * len(edges) + [classes[i] for i in some], pa.binary()),
                 pa.array(np.append(np.zeros(len(edges), np.int64), count[some])[:n], pa.int64())],
                names=["a", "b", "class", "links"])

    return run


def drop_near_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents whose id is the ``group_id`` of their group, with all their columns."""
    gone = similar_texts(docs, id_column, text_column).filter(F.col("group_id") != F.col(id_column))
    gone_id = unused(docs, "__gone")
    gone = gone.select(F.col(id_column).alias(gone_id)).distinct()
    return docs.join(gone, docs[id_column] == F.col(gone_id), "left_anti")
