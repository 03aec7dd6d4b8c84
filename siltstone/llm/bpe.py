"""Byte-level BPE encoding and decoding from a rank file, by overlapping chunks.

A text longer than ``chunk`` characters is cut into chunks that overlap by ``overlap``. Each is
pre-tokenised by itself and in parallel. A white-space character after another kind of character
starts a pre-token whatever came before, so two neighbouring chunks resynchronise at the first such
place in their overlap: the left one keeps what lies before it, the right one starts there. A text
with an overlap that holds no such place (one run of letters longer than the overlap, say) is
encoded as one chunk, which gives the same ids.

The pre-tokens are those of the public pattern (contractions, letters, numbers, other signs,
white space), found over whole blocks of texts at once by character class.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 1 << 16
OVERLAP = 1 << 10
#: Distinct pre-tokens a worker remembers, some 160 bytes each.
CACHE = 1 << 18
LONG = 64
BLOCK_CHARS = 1 << 20

_LETTER, _NUMBER, _OTHER, _SPACE = 1, 2, 3, 4
_classes: list[np.ndarray] = []


def _char_classes() -> np.ndarray:
    """Class of every code point, from the property tables of the regex library."""
    if not _classes:
        import regex

        every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        lut = np.full(0x110000, _OTHER, np.uint8)
        for kind, what in ((r"\p{L}+", _LETTER), (r"\p{N}+", _NUMBER), (r"\s+", _SPACE)):
            for m in regex.finditer(kind, every):
                a, b = ord(m[0][0]), ord(m[0][-1])
                lut[a : b + 1] = what
        _classes.append(lut)
    return _classes[0]


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes and where each starts."""
    if data.max(initial=0) < 0x80:
        return data.astype(np.uint32), np.arange(len(data))
    at = np.flatnonzero((data & 0xC0) != 0x80)
    codes = data[at].astype(np.uint32)
    padded = np.append(data, np.zeros(3, np.uint8)).astype(np.uint32) & 0x3F
    for lead, bits, extra in ((0xC0, 0x1F, 1), (0xE0, 0x0F, 2), (0xF0, 0x07, 3)):
        here = np.flatnonzero((codes >= lead) & (codes < (lead | bits) + 1) & (codes < 0x100))
        value = codes[here] & bits
        for i in range(1, extra + 1):
            value = value << 6 | padded[at[here] + i]
        codes[here] = value | 0x80000000  # marked, as a small code point looks like a lead byte
    return codes & 0x7FFFFFFF, at


def pretoken_starts(codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pre-tokens start in texts laid end to end; ``offsets`` are the texts' bounds.

    A run of one class is one pre-token, a single space before a run of another class
    belongs to it, the last of several white-space characters before other text stands alone or,
    if a space, leads that text, and an apostrophe that starts a pre-token takes s, t, re, ve, m,
    ll or d with it.
    """
    n = len(codes)
    if n == 0:
        return np.zeros(0, np.int64)
    kind = _char_classes()[codes]
    first = np.zeros(n, bool)
    first[offsets[:-1][offsets[:-1] < n]] = True
    start = first.copy()
    start[1:] |= kind[1:] != kind[:-1]
    space = kind == _SPACE
    last = np.zeros(n, bool)  # white space followed by other text of the same document
    last[:-1] = space[:-1] & ~space[1:] & ~first[1:]
    start |= last
    leads = np.flatnonzero(last & (codes == 32))
    start[leads + 1] = False
    # An apostrophe alone in its run and without a leading space can begin a contraction.
    quote = np.flatnonzero((codes == 39) & start)
    quote = quote[(quote + 1 < n)]
    quote = quote[(kind[quote + 1] == _LETTER) & ~first[quote + 1]]
    if len(quote):
        two = np.zeros(n + 2, np.uint32)
        two[:n] = codes
        a, b = two[quote + 1], two[quote + 2]
        inner = np.append(first, [True, True])
        b = np.where(inner[quote + 2], 0, b)
        one = np.isin(a, [ord(c) for c in "stmd"])
        pair = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e")))
        pair |= (a == ord("l")) & (b == ord("l"))
        for hit, width in ((one, 1), (pair & ~one, 2)):
            at = quote[hit]
            start[at + 1] = False
            after = at + 1 + width
            after = after[after < n]
            start[after] = True
    return np.flatnonzero(start)


class Bpe:
    """Merges by rank, with a bounded cache of pre-tokens."""

    def __init__(self, path: str):
        """Rank files of up to 65,536 tokens with all 256 bytes among them."""
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(a): int(b) for a, b in pairs}
        self.bytes_of = {b: a for a, b in self.ranks.items()}
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.none = np.int32(1 << 30)
        # Every way to make a token of two tokens.
        pairs = sorted(
            (self.ranks[t[:i]] << 16 | self.ranks[t[i:]], r)
            for t, r in self.ranks.items() for i in range(1, len(t))
            if t[:i] in self.ranks and t[i:] in self.ranks
        )
        self.pairs = np.array([p for p, _ in pairs], np.int64)
        self.made = np.array([r for _, r in pairs], np.int32)
        self.cache: dict[str, bytes] = {}

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of pre-tokens: in each, the adjacent pair of lowest rank is joined until none has a rank,
        the leftmost of equals first. All pieces take their next step at once."""
        out = [b""] * len(pieces)
        sizes = np.array([len(p) for p in pieces], np.int64)
        symbol = self.single[np.frombuffer(b"".join(pieces), np.uint8)]
        piece = np.repeat(np.arange(len(pieces), dtype=np.int32), sizes)
        rank = self._ranks(symbol, piece)
        while len(symbol):
            starts = np.flatnonzero(np.append(True, piece[1:] != piece[:-1]))
            least = np.minimum.reduceat(rank, starts)
            done = least == self.none
            if done.any():
                ends = np.append(starts[1:], len(symbol))
                for i, a, b in zip(piece[starts[done]].tolist(), starts[done].tolist(), ends[done].tolist(), strict=True):
                    out[i] = symbol[a:b].tobytes()
                keep = np.repeat(~done, ends - starts)
                symbol, piece, rank = symbol[keep], piece[keep], rank[keep]
                continue
            least = np.repeat(least, np.diff(np.append(starts, len(symbol))))
            at = np.flatnonzero(rank == least)
            at = at[np.append(True, piece[at][1:] != piece[at][:-1])]
            # The rank of a pair is the id of what it makes.
            symbol[at] = least[at]
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            at = at - np.arange(len(at))
            symbol, piece, rank = symbol[keep], piece[keep], rank[keep]
            for left in (at[at > 0] - 1, at):
                rank[left] = self._ranks(symbol, piece, left)
        return out

    def _ranks(self, symbol: np.ndarray, piece: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
        """Rank of each symbol's pair with the next one of its piece."""
        at = np.arange(len(symbol)) if at is None else at
        out = np.full(len(at), self.none, np.int32)
        inner = at + 1 < len(symbol)
        inner[inner] = piece[at[inner]] == piece[at[inner] + 1]
        left = at[inner]
        key = symbol[left].astype(np.int64) << 16 | symbol[left + 1]
        place = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        out[inner] = np.where(self.pairs[place] == key, self.made[place], self.none)
        return out

    def _merge_long(self, piece: bytes) -> bytes:
        """The same order of merges with a heap over linked parts, for very long pre-tokens."""
        import heapq

        n, get = len(piece), self.ranks.get
        end = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            if (rank := get(piece[i : i + 2])) is not None:
                heap.append((rank, i, i + 2))
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            _, i, stop = heapq.heappop(heap)
            if not alive[i] or end[i] >= n or end[end[i]] != stop:
                continue
            j = end[i]
            alive[j] = False
            end[i] = stop
            if stop < n:
                before[stop] = i
                if (rank := get(piece[i : end[stop]])) is not None:
                    heapq.heappush(heap, (rank, i, end[stop]))
            if (k := before[i]) >= 0 and (rank := get(piece[k:stop])) is not None:
                heapq.heappush(heap, (rank, k, stop))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i : end[i]]])
            i = end[i]
        return np.array(out, "<i4").tobytes()

    def encode(self, pieces: list[str]) -> list[bytes]:
        """Packed ids of each pre-token."""
        if len(self.cache) > CACHE:
            self.cache.clear()
        missing = [p for p in set(pieces).difference(self.cache) if len(p) <= LONG]
        self.cache.update(zip(missing, self.merge([p.encode() for p in missing]), strict=True))
        found = list(map(self.cache.get, pieces))
        if None in found:
            found = [self._merge_long(p.encode()) if x is None else x for p, x in zip(pieces, found, strict=True)]
        return found

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


_bpe: dict[str, Bpe] = {}


def bpe_of(path: str) -> Bpe:
    """One encoder per worker process and file."""
    if path not in _bpe:
        _bpe[path] = Bpe(path)
    return _bpe[path]


def encode_texts(bpe: Bpe, texts: list[str]) -> Iterator[bytes]:
    """Ids of every text, little-endian 32-bit, a block of texts at a time."""
    lo = 0
    while lo < len(texts):
        hi, chars = lo, 0
        while hi < len(texts) and (hi == lo or chars + len(texts[hi]) <= BLOCK_CHARS):
            chars += len(texts[hi])
            hi += 1
        whole = "".join(texts[lo:hi])
        offsets = np.cumsum([0, *map(len, texts[lo:hi])])
        codes = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        starts = pretoken_starts(codes, offsets)
        ends = np.append(starts, len(whole))[1:]
        found = bpe.encode([whole[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)])
        bounds = np.searchsorted(starts, offsets).tolist()
        for a, b in zip(bounds, bounds[1:], strict=False):
            yield b"".join(found[a:b])
        lo = hi


def _sync(text: str, lo: int, hi: int) -> int:
    """The first place from ``lo`` on, below ``hi``, where white space follows other text; or -1."""
    codes = np.frombuffer(text[max(lo - 1, 0) : hi].encode("utf-32-le"), np.uint32)
    space = _char_classes()[codes] == _SPACE
    found = np.flatnonzero(space[1:] & ~space[:-1])
    return int(found[0]) + max(lo - 1, 0) + 1 if len(found) else -1


def chunk_ids(
    bpe: Bpe, text: str, at: int, chunk: int, overlap: int, last: bool
) -> tuple[bytes | None, str | None, bool]:
    """Ids of chunk number ``at`` between the places where it meets its neighbours.

    ``text`` starts one character before the chunk (none for the first) and reaches ``overlap``
    characters beyond it. Where a place is missing there are no ids but the chunk's text, and
    whether it ends at such a place: the caller joins such texts before encoding.
    """
    lead = 1 if at else 0
    lo = _sync(text, lead, min(len(text), lead + overlap)) if at else 0
    hi = len(text) if last else _sync(text, lead + chunk, min(len(text), lead + chunk + overlap))
    if lo >= 0 and hi >= 0:
        return next(encode_texts(bpe, [text[lo:hi]])), None, True
    return None, text[lo if lo >= 0 else lead : hi if hi >= 0 else lead + chunk], hi >= 0


def encode(
    docs: DataFrame,
    ranks_path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """One row per document: the id and ``ids``, binary, little-endian unsigned 32-bit.

    Null and empty texts give no ids. Rows with equal or null ids are documents of their own. Other
    columns, of whatever name, are not read. No rows in, no rows out.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(F.col(id_column).alias("__id"), text.alias("__text"))
    kind = rows.schema["__id"].dataType.simpleString()
    size = F.length("__text")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = bpe_of(ranks_path)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                ids = list(encode_texts(bpe, part.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())],
                                                 names=["__id", "ids"])

    short = rows.filter(size <= chunk).mapInArrow(whole, f"__id {kind}, ids binary")

    # Each chunk of a long text, one character before it and its overlap, dealt out anew.
    at = F.col("__at")
    chunks = (
        rows.filter(size > chunk)
        .withColumn("__doc", F.monotonically_increasing_id())
        .withColumn("__n", F.ceil(size / F.lit(chunk)).cast("int"))
        .withColumn("__at", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))
        .withColumn("__text", F.col("__text").substr(
            F.greatest(at * chunk, F.lit(1)),
            F.lit(chunk + overlap) + F.when(at > 0, 1).otherwise(0)))
        .repartition("__doc", "__at")
    )

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = bpe_of(ranks_path)
        for batch in batches:
            for lo in range(batch.num_rows):
                part = batch.slice(lo, 1)
                row = part.to_pylist()[0]
                ids, left, closed = chunk_ids(bpe, row["__text"], row["__at"], chunk, overlap,
                                              row["__at"] == row["__n"] - 1)
                yield pa.RecordBatch.from_arrays(
                    [part.column("__id"), part.column("__doc"), part.column("__at"),
                     pa.array([ids], pa.binary()),
                     pa.array([left], pa.string()), pa.array([closed], pa.bool_())],
                    names=["__id", "__doc", "__at", "ids", "left", "closed"])

    encoded = chunks.mapInArrow(
        pieces, f"__id {kind}, __doc bigint, __at int, ids binary, left string, closed boolean")

    def stitched(table: pa.Table) -> pa.Table:
        bpe, out, pending = bpe_of(ranks_path), [], []
        for row in sorted(table.to_pylist(), key=lambda r: r["__at"]):
            if row["ids"] is not None:
                out.append(row["ids"])
                continue
            pending.append(row["left"])
            if row["closed"]:
                out.append(next(encode_texts(bpe, ["".join(pending)])))
                pending = []
        return pa.table({"__id": table.column("__id").slice(0, 1), "ids": pa.array([b"".join(out)], pa.binary())})

    long = encoded.groupBy("__doc").applyInArrow(stitched, f"__id {kind}, ids binary")
    return short.unionByName(long).withColumnRenamed("__id", id_column)


def decode(encoded: DataFrame, ranks_path: str, id_column: str = "doc_id") -> DataFrame:
    """One row per row of ``encoded``: the id, its ``ids``, ``n_tokens``, ``ids_sha256`` over the decimal
    ids joined by a space, and ``decoded``, the concatenated bytes of the ids. Null ids count as none.
    """
    kind = encoded.schema[id_column].dataType.simpleString()

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = bpe_of(ranks_path)
        digits = {i: str(i) for i in bpe.bytes_of}
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                n, digest, decoded = [], [], []
                for packed in part.column(1).to_pylist():
                    ids = np.frombuffer(packed or b"", "<u4").tolist()
                    n.append(len(ids))
                    said = " ".join(map(digits.__getitem__, ids))
                    digest.append(hashlib.sha256(said.encode()).hexdigest())
                    decoded.append(bpe.decode(ids))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(n, pa.int64()), pa.array(digest), pa.array(decoded, pa.binary())],
                    names=["__id", "ids", "n_tokens", "ids_sha256", "decoded"])

    return (
        encoded.select(F.col(id_column).alias("__id"), "ids")
        .mapInArrow(back, f"__id {kind}, ids binary, n_tokens bigint, ids_sha256 string, decoded binary")
        .withColumnRenamed("__id", id_column)
    )
