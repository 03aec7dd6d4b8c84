"""Token ids in binary files: one id array per file, documents' bounds in Elias-Fano form.

A file holds consecutive documents in ascending id order:

    magic ``EFTOK001``, then little-endian unsigned 64-bit: documents n, ids m, bytes per id, low
    bits l, bytes of the bound's high part, bytes of the document-id column;
    the n bounds (ends of the documents in the id array) in Elias-Fano form: low parts of l bits each,
    then the high parts in unary, both as bit strings padded to whole bytes;
    the document ids (Arrow IPC, for they may be null or repeat); the m ids, unsigned, little-endian, in two
    bytes each where all fit and else in four.

Bounds take about ``2 + log2(m / n)`` bits each. ``Bounds.select`` gives the end of any
document from the position of a one in the high part, found by counts kept for every
``SAMPLE`` ones.
"""

from __future__ import annotations

import binascii
import re
import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.bpe import code_points, pretoken_starts
from siltstone.llm.shards import FileSet, in_shards, one_each, plan_shards
from siltstone.llm.textbytes import blocks
from siltstone.scratch import materialize, new_folder

END_ID = 0
FILE_IDS = 4 << 20
#: Distinct pre-tokens a worker remembers, some 160 bytes each.
CACHE = 1 << 20
SAMPLE = 256
_MAGIC = b"EFTOK001"
_HEAD = struct.Struct("<8s6Q")


class Bounds:
    """A non-decreasing sequence in Elias-Fano form."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes):
        self.n, self.low_bits = n, low_bits
        self._low = np.unpackbits(np.frombuffer(low, np.uint8), bitorder="little")
        self._high = np.frombuffer(high, np.uint8)
        # Ones before every SAMPLE-th byte: select walks one such stretch.
        counts = np.bitwise_count(self._high).astype(np.int64)
        self._before = np.concatenate([[0], np.cumsum(np.add.reduceat(counts, np.arange(0, len(counts), SAMPLE)))]) if len(counts) else np.zeros(1, np.int64)

    @staticmethod
    def encode(values: np.ndarray, universe: int) -> tuple[int, bytes, bytes]:
        """Low bits per value, low and high parts of ``values``, which do not exceed ``universe``."""
        n = len(values)
        low_bits = max(0, int(np.floor(np.log2(max(1, universe) / n)))) if n else 0
        values = values.astype(np.int64)
        bits = (values[:, None] >> np.arange(low_bits)) & 1
        low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()
        high = np.zeros((universe >> low_bits) + n + 1, np.uint8)
        high[(values >> low_bits) + np.arange(n)] = 1
        return low_bits, low, np.packbits(high, bitorder="little").tobytes()

    def _low_part(self, i: np.ndarray) -> np.ndarray:
        at = i[:, None] * self.low_bits + np.arange(self.low_bits)
        return (self._low[at].astype(np.int64) << np.arange(self.low_bits)).sum(axis=1)

    def select(self, i: int) -> int:
        """Value number ``i``."""
        stretch = int(np.searchsorted(self._before, i, side="right")) - 1
        bits = np.unpackbits(self._high[stretch * SAMPLE : (stretch + 1) * SAMPLE], bitorder="little")
        at = int(np.flatnonzero(bits)[i - self._before[stretch]]) + stretch * SAMPLE * 8
        return ((at - i) << self.low_bits) + int(self._low_part(np.array([i]))[0])

    def all(self) -> np.ndarray:
        at = np.flatnonzero(np.unpackbits(self._high, bitorder="little"))[: self.n]
        i = np.arange(self.n)
        return ((at - i) << self.low_bits) + self._low_part(i)


def pack(keys: list, lengths: list[int], ids: np.ndarray, kind: pa.DataType) -> bytes:
    """The bytes of one file."""
    ends = np.cumsum(np.asarray(lengths, np.int64))
    low_bits, low, high = Bounds.encode(ends, len(ids))
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([pa.array(keys, kind)], names=["id"])
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    column = sink.getvalue().to_pybytes()
    width = 2 if not len(ids) or ids.max() < 1 << 16 else 4
    head = _HEAD.pack(_MAGIC, len(ends), len(ids), width, low_bits, len(high), len(column))
    return b"".join([head, low, high, column, ids.astype(f"<u{width}").tobytes()])


def unpack(data: bytes) -> tuple[list, Bounds, np.ndarray]:
    """Document ids, bounds and token ids of a file."""
    magic, n, m, width, low_bits, high, column = _HEAD.unpack_from(data)
    if magic != _MAGIC:
        raise ValueError("not a token file")
    at = _HEAD.size
    low = (n * low_bits + 7) // 8
    bounds = Bounds(n, low_bits, data[at : at + low], data[at + low : at + low + high])
    at += low + high
    keys = pa.ipc.open_stream(data[at : at + column]).read_all().column(0).to_pylist()
    return keys, bounds, np.frombuffer(data, f"<u{width}", count=m, offset=at + column).astype("<u4")


_encoders: dict[str, tuple] = {}


def _encoder(path: str) -> tuple:
    """The tokenizer of a worker process, its cache of pre-tokens, its added tokens and a pattern that finds them."""
    if path not in _encoders:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        added = {t.content.encode(): i for i, t in tokenizer.get_added_tokens_decoder().items()}
        cuts = re.compile(b"(" + b"|".join(re.escape(t) for t in sorted(added, key=len, reverse=True)) + b")") if added else None
        _encoders[path] = (tokenizer, {}, added, cuts)
    return _encoders[path]


def token_ids(path: str, data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """Ids of every text of a block.

    Where a text holds the string of one of the file's added tokens, that is the token's id, and the text on either side is encoded
    by itself, as the library does.
    """
    _, _, added, cuts = _encoder(path)
    raw = data.tobytes()
    if cuts is None or not cuts.search(raw):
        yield from _piece_ids(path, data, offsets)
        return
    parts: list[bytes] = []
    counts = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        # Every second part is an added token.
        split = cuts.split(raw[a:b])
        parts += split
        counts.append(len(split))
    plain = [b"" if k % 2 else p for n, first in zip(counts, np.cumsum([0, *counts]).tolist()) for k, p in enumerate(parts[first : first + n])]
    ends = np.cumsum([0, *map(len, plain)])
    found = _piece_ids(path, np.frombuffer(b"".join(plain), np.uint8), ends)
    for n, first in zip(counts, np.cumsum([0, *counts]).tolist()):
        ids = [next(found) if k % 2 == 0 else (next(found), np.array([added[parts[first + k]]], "<u4"))[1] for k in range(n)]
        yield np.concatenate(ids).astype("<u4")


def _piece_ids(path: str, data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """Ids of texts without added tokens. A byte-level tokenizer encodes each pre-token by itself, so each
    distinct pre-token is given to it once."""
    tokenizer, cache, _, _ = _encoder(path)
    if len(data) == 0:
        yield from [np.zeros(0, "<u4")] * (len(offsets) - 1)
        return
    codes, at = code_points(data)
    starts = pretoken_starts(codes, np.searchsorted(at, offsets))
    # 0xFF is in no UTF-8 text: put before each pre-token it lets bytes.split cut them.
    marked = np.full(len(data) + len(starts), 0xFF, np.uint8)
    inside = np.ones(len(marked), bool)
    inside[at[starts] + np.arange(len(starts))] = False
    marked[inside] = data
    pieces = marked.tobytes().split(b"\xff")[1:]
    if len(cache) > CACHE:
        cache.clear()
    missing = list(set(pieces).difference(cache))
    said = tokenizer.encode_batch_fast([p.decode() for p in missing], add_special_tokens=False)
    cache.update((p, array("I", e.ids).tobytes()) for p, e in zip(missing, said, strict=True))
    found = list(map(cache.__getitem__, pieces))
    bounds = np.searchsorted(at[starts], offsets).tolist()
    for a, b in zip(bounds, bounds[1:], strict=False):
        yield np.frombuffer(b"".join(found[a:b]), "<u4")


def write_files(
    docs: DataFrame,
    tokenizer_path: str,
    folder: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    file_ids: int = FILE_IDS,
) -> DataFrame:
    """Encode every text, end it with id 0 and write files in ascending order of the id.

    Returns the manifest, which is written last: a row per file with its shard, number in the
    shard, ids and CRC. A shard's bounds follow from ids and text sizes alone, a file is
    closed once it holds ``file_ids`` ids, and a task run again writes the same bytes under the
    same name. Null texts are empty; null ids come first; rows that repeat an id are in the order of their
    texts; an empty table gives no file. Ids must be whole numbers.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    planned = plan_shards(rows, "id", F.octet_length("text") + 64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = FileSet(folder)
        shard, number, keys, lengths, parts, held = None, 0, [], [], [], 0

        def close() -> pa.RecordBatch:
            data = pack(keys, lengths, np.concatenate(parts), pa.int64())
            name = f"tokens-{shard:06d}-{number:06d}.eft"
            files.write(name, data)
            return pa.RecordBatch.from_arrays(
                [pa.array([x]) for x in (name, shard, number, sum(lengths), len(keys), binascii.crc32(data))],
                names=["file", "shard", "number", "n_ids", "n_docs", "crc32"])

        for block in blocks(batches, "text"):
            part = block.batch.slice(block.lo, block.hi - block.lo)
            keyed, shards = (part.column(n).to_pylist() for n in ("id", "__shard"))
            for key, s, ids in zip(keyed, shards, token_ids(tokenizer_path, block.data, block.offsets), strict=True):
                if keys and (s != shard or held >= file_ids):
                    yield close()
                    number = number + 1 if s == shard else 0
                    keys, lengths, parts, held = [], [], [], 0
                shard = s
                keys.append(key)
                lengths.append(len(ids) + 1)
                parts += [ids, np.array([END_ID], "<u4")]
                held += len(ids) + 1
        if keys:
            yield close()

    schema = "file string, shard bigint, number bigint, n_ids bigint, n_docs bigint, crc32 bigint"
    dealt = in_shards(rows.withColumn("order", F.sha2("text", 256)), "id", planned, "order").select("id", "text", F.col("__shard").cast("long").alias("__shard"))
    return materialize(dealt.mapInArrow(run, schema), "manifest")


def read_files(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per document of the manifest's files: ``doc_id``, ``start``, ``n_tokens`` and
    ``ids_crc32`` (CRC-32 of its ids as little-endian unsigned 32-bit integers)."""
    # One row per file: files of some 16 MB, so a few numbers for each 16 MB.
    before = Window.orderBy("shard", "number").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("offset", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = FileSet(folder)
        for batch in batches:
            for row in batch.to_pylist():
                data = files.read(row["file"])
                if binascii.crc32(data) != row["crc32"]:
                    raise ValueError(f"{row['file']} is damaged")
                keys, bounds, ids = unpack(data)
                ends = bounds.all()
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                crc = [binascii.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(starts + row["offset"]), pa.array(ends - starts), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return one_each(placed).mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def round_trip(docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    folder = new_folder(docs.sparkSession, "tokens")
    return read_files(write_files(docs, tokenizer_path, folder, id_column, text_column), folder)
