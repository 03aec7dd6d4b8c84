"""WARC archives written in deterministic shards and read back.

Records are range-sorted by page id into shards whose bounds follow from the rows alone. A task writes
its shards one after the other, a gzip member per record, and rolls to the next file once the
compressed size is reached. Headers, record ids and digests are made anew from each row, so the same rows
give the same bytes. A file is written under the name of the attempt and renamed when it is complete;
the manifest, written by Spark after all tasks, names the files that count.

Pages with equal payloads are told by SHA-256: the smallest id is the response, the others are
revisits that refer to it and have no payload.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.exact_dedup import exact_groups
from siltstone.llm.shards import SHARD_BYTES, FileSet, in_shards, one_each, plan_shards
from siltstone.scratch import materialize, new_folder

ROLL_BYTES = 16 << 20
#: The rows have no capture time; records carry this one unless the caller names another.
DATE = "2024-01-01T00:00:00Z"
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the public name space for URLs
_STEP = 1 << 14
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MANIFEST = "file string, shard bigint, number bigint, n_records bigint, n_bytes bigint, sha256 string"


def _base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'{page_id}/{digest}')}>"


def _one_line(value: str) -> str:
    """A header's value: line ends would start another header."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One WARC record, not compressed."""
    digest = _base32_sha1(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _record_id(page_id, digest)),
        ("WARC-Date", date),
        ("WARC-Target-URI", _one_line(url or "")),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{_base32_sha1(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if page_id is not None:
        head.append(("X-Page-Id", str(page_id)))
    if revisit:
        head += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", _record_id(refers_to, digest)), ("X-Refers-To-Page-Id", str(refers_to))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def members(data: bytes) -> Iterator[bytes]:
    """The gzip members of a file, one after the other."""
    view, at = memoryview(data), 0
    while at < len(view):
        # Bounded steps: what a member leaves over is copied each time.
        unpacker, out = zlib.decompressobj(wbits=31), []
        while not unpacker.eof and at < len(view):
            step = view[at : at + _STEP]
            out.append(unpacker.decompress(step))
            at += len(step) - len(unpacker.unused_data)
        yield b"".join(out)


def parse(raw: bytes) -> tuple[dict[str, str], bytes, int]:
    """Headers, payload and the payload's declared length of a record; checks the digests."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    block = rest[: int(headers["Content-Length"])]
    if not version.startswith("WARC/") or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("not a WARC record")
    if headers["WARC-Block-Digest"] != f"sha1:{_base32_sha1(block)}":
        raise ValueError(f"damaged block in {headers['WARC-Record-ID']}")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    if headers["WARC-Type"] == "response" and headers["WARC-Payload-Digest"] != f"sha1:{_base32_sha1(payload)}":
        raise ValueError(f"damaged payload in {headers['WARC-Record-ID']}")
    return headers, payload, length


def write_archives(
    pages: DataFrame,
    folder: str,
    id_column: str = "page_id",
    url_column: str = "url",
    payload_column: str = "html",
    min_revisit_bytes: int = 0,
    roll_bytes: int = ROLL_BYTES,
    shard_bytes: int = SHARD_BYTES,
    date: str = DATE,
) -> DataFrame:
    """Write one record per row and return the manifest, a row per file.

    Null payloads are empty, null urls give an empty target. A record of at least
    ``min_revisit_bytes`` whose payload a smaller id has too is a revisit. Rows repeating both id
    and payload are of one type. Null ids come first and are revisits of an equal payload with an
    id, else responses. An empty table gives no file. Ids must be whole numbers.
    """
    rows = pages.select(
        F.col(id_column).cast("long").alias("id"), F.col(url_column).alias("url"),
        F.coalesce(F.col(payload_column), F.lit("")).alias("payload"))
    copies = (
        exact_groups(rows, "id", "payload", keep="smallest")
        .filter("NOT kept")
        .select(F.col("id").alias("copy"), F.col("keep_id").alias("refers_to"), F.col("text_sha256").alias("copy_hash"))
        .distinct()
    )
    planned = plan_shards(rows, "id", F.octet_length("payload") + 512, shard_bytes)
    # A copy's mark travels to its shard with the pages and comes before them, instead of a join
    # that would shuffle the payloads once more.
    marks = copies.select(F.col("copy").alias("id"), F.col("copy_hash").alias("hash"), F.lit(True).alias("mark"), "refers_to")
    every = rows.withColumn("hash", F.sha2("payload", 256)).unionByName(marks, allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = FileSet(folder)
        shard, number, parts, held, mark = None, 0, [], 0, (None, None, None)

        def close() -> pa.RecordBatch:
            data = b"".join(parts)
            name = f"pages-{shard:06d}-{number:06d}.warc.gz"
            files.write(name, data)
            values = (name, shard, number, len(parts), len(data), hashlib.sha256(data).hexdigest())
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in values], names=["file", "shard", "number", "n_records", "n_bytes", "sha256"])

        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                for row in batch.slice(at, 64).to_pylist():
                    if row["mark"]:
                        mark = (row["id"], row["hash"], row["refers_to"])
                        continue
                    if parts and (row["__shard"] != shard or held >= roll_bytes):
                        yield close()
                        number = number + 1 if row["__shard"] == shard else 0
                        parts, held = [], 0
                    shard = row["__shard"]
                    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                    payload = row["payload"].encode()
                    again = mark[:2] == (row["id"], row["hash"]) and len(payload) >= min_revisit_bytes
                    raw = record(row["id"], row["url"], payload, mark[2], again, date)
                    parts.append(packer.compress(raw) + packer.flush())
                    held += len(parts[-1])
        if parts:
            yield close()

    dealt = in_shards(every, "id", planned, "hash", F.col("mark").desc_nulls_last(), "url").withColumn("__shard", F.col("__shard").cast("long"))
    return materialize(dealt.mapInArrow(run, _MANIFEST), "manifest")


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per record of the manifest's files: ``page_id``, ``url``, ``payload`` (null for a revisit),
    ``payload_bytes``, ``payload_digest``, ``record_type`` and ``refers_to``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = FileSet(folder)
        for batch in batches:
            for row in batch.to_pylist():
                data = files.read(row["file"])
                if hashlib.sha256(data).hexdigest() != row["sha256"]:
                    raise ValueError(f"{row['file']} is damaged")
                out = []
                for raw in members(data):
                    headers, payload, length = parse(raw)
                    response = headers["WARC-Type"] == "response"
                    number = lambda k: int(headers[k]) if headers.get(k, "None") != "None" else None  # noqa: B023, E731
                    out.append({
                        "page_id": number("X-Page-Id"), "url": headers["WARC-Target-URI"],
                        "payload": payload if response else None, "payload_bytes": length,
                        "payload_digest": headers["WARC-Payload-Digest"].removeprefix("sha1:"),
                        "record_type": headers["WARC-Type"], "refers_to": number("X-Refers-To-Page-Id")})
                    if len(out) == 64:
                        yield _batch(out)
                        out = []
                if out:
                    yield _batch(out)

    return one_each(manifest).mapInArrow(
        run, "page_id bigint, url string, payload binary, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint")


_SCHEMA = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)


def round_trip(pages: DataFrame) -> DataFrame:
    folder = new_folder(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder), folder)
