"""Texts of an Arrow batch as one byte array, and words over it, for code inside tasks.

Everything here is vectorised over a block of whole texts of a few MB, so a task's memory
does not follow the number of rows in an Arrow batch.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 21


class Block(NamedTuple):
    """Rows ``lo`` to ``hi`` of ``batch``; text i is ``data[offsets[i]:offsets[i + 1]]``."""

    batch: pa.RecordBatch
    lo: int
    hi: int
    data: np.ndarray
    offsets: np.ndarray


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column; null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(
    batches: Iterable[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES
) -> Iterator[Block]:
    """Consecutive rows of about ``limit`` bytes of text; a longer text is a block of its own."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        data, offsets = text_buffers(batch.column(batch.schema.get_field_index(column)))
        lo = 0
        while lo < batch.num_rows:
            hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
            hi = min(max(hi, lo + 1), batch.num_rows)
            at = offsets[lo : hi + 1]
            yield Block(batch, lo, hi, data[at[0] : at[-1]], at - at[0])
            lo = hi


def _lower_words() -> np.ndarray:
    lut = np.zeros(256, np.uint8)
    for c in range(256):
        if c >= 128 or chr(c).isalnum():
            lut[c] = ord(chr(c).lower()) if c < 128 else c
    return lut


#: Byte to lower-cased word byte; 0 separates words. Bytes of non-ASCII characters are word bytes.
WORD_BYTES = _lower_words()
_LONGEST = 4096


def _powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.full(n, base, np.uint64), dtype=np.uint64)


_POWERS = _powers(0x9E3779B97F4A7C15, _LONGEST)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the public splitmix64 finaliser)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def runs(
    symbols: np.ndarray, inside: np.ndarray, offsets: np.ndarray, groups: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of ``inside`` symbols that cross no text, as (first, end, 64-bit hash).

    ``groups`` also ends a run where its value changes.
    """
    n = len(symbols)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64)
    fresh = np.ones(n, bool)
    fresh[1:] = ~inside[:-1]
    if groups is not None:
        fresh[1:] |= groups[1:] != groups[:-1]
    firsts = offsets[:-1]
    fresh[firsts[firsts < n]] = True
    start = inside & fresh
    at = np.flatnonzero(inside)
    first = np.flatnonzero(start)
    if len(first) == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64)
    run_at = np.flatnonzero(start[at])
    length = np.diff(np.append(run_at, len(at)))
    place = np.arange(len(at)) - np.repeat(run_at, length)
    with np.errstate(over="ignore"):
        value = (symbols[at].astype(np.uint64) + np.uint64(1)) * _POWERS[place % _LONGEST]
        value = np.add.reduceat(value, run_at) + length.astype(np.uint64)
    return first, first + length, mix(value)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words as (first byte, end, hash): runs of letters, digits and non-ASCII, ASCII lower-cased."""
    low = WORD_BYTES[data]
    return runs(low, low != 0, offsets)


def rolling(values: np.ndarray, width: int) -> np.ndarray:
    """Order-sensitive hash of every ``width`` neighbours of ``values``."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(width):
            out = out * np.uint64(0xD6E8FEB86659FD93) + values[i : i + n]
    return mix(out)
