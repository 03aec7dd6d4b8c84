"""Quality classifier: logistic regression on hashed word n-grams, trained by FTRL-proximal.

Tokens are runs of letters, of digits (all written as 0) and of other signs, in their own case.
Unigrams, bigrams, and the bare fact that a token returns after up to ``REPEATS`` places are hashed to ``2 ** BITS`` weights; a text's value of a feature is
``1 + log(count)``, scaled to unit length. A bounded sample of labelled rows is dealt to shards,
each shard runs follow-the-regularised-leader over its rows, and the shards' weights are averaged.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.labelled import held_out, labelled_sample
from siltstone.llm.textbytes import Block, blocks, mix, runs

BITS = 18
SHARDS = 4
REPEATS = 4
#: At most about so many labelled rows of each label are learnt from.
PER_CLASS = {0: 6_000, 1: 12_000}
EPOCHS = 5
ALPHA, BETA, L1, L2 = 20.0, 1.0, 0.05, 0.0


def _token_classes() -> tuple[np.ndarray, np.ndarray]:
    kind, symbol = np.zeros(256, np.uint8), np.arange(256).astype(np.uint8)
    for c in range(256):
        if c >= 128 or chr(c).isalpha():
            kind[c] = 1
        elif chr(c).isdigit():
            kind[c], symbol[c] = 2, ord("0")
        elif not chr(c).isspace():
            kind[c] = 3
    return kind, symbol


_KIND, _SYMBOL = _token_classes()


def features(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed n-grams of a block: bounds by text, indices, values. An empty text has none."""
    kind = _KIND[block.data]
    first, _, token = runs(_SYMBOL[block.data], kind != 0, block.offsets, kind)
    text = np.searchsorted(block.offsets, first, side="right") - 1
    with np.errstate(over="ignore"):
        pair = mix(token[:-1] * np.uint64(0x9E3779B97F4A7C15) + token[1:])
    same = text[1:] == text[:-1]
    mask = np.uint64((1 << BITS) - 1)
    place = text.astype(np.int64) << BITS
    key = [place | (token & mask).astype(np.int64), (place[1:] | (pair & mask).astype(np.int64))[same]]
    # An n-gram that begins and ends with one token also counts as a repeat at that distance.
    for d in range(1, REPEATS + 1):
        again = (token[d:] == token[:-d]) & (text[d:] == text[:-d])
        key.append(place[d:][again] | d)
    key = np.concatenate(key)
    key, count = np.unique(key, return_counts=True)
    value = (1.0 + np.log(count)).astype(np.float32)
    bounds = np.searchsorted(key, np.arange(len(block.offsets), dtype=np.int64) << BITS)
    norm = np.sqrt(np.add.reduceat(np.append(value * value, 0), bounds[:-1])) if len(bounds) > 1 else np.zeros(0)
    value /= np.repeat(norm, np.diff(bounds)).astype(np.float32)
    return bounds, key & ((1 << BITS) - 1), value


class Model(NamedTuple):
    weights: np.ndarray
    bias: float


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS) -> Model:
    """FTRL-proximal over rows of (indices, values, label); the bias is an unregularised weight."""
    n = np.zeros(1 << BITS)
    z = np.zeros(1 << BITS)
    bias_n = bias_z = 0.0
    for _ in range(epochs):
        for index, value, label in rows:
            root = np.sqrt(n[index])
            zi = z[index]
            w = -np.sign(zi) * np.maximum(np.abs(zi) - L1, 0) / ((BETA + root) / ALPHA + L2)
            bias_root = bias_n**0.5
            bias = -bias_z / ((BETA + bias_root) / ALPHA)
            error = 1 / (1 + np.exp(-np.clip(w @ value + bias, -30, 30))) - label
            g = error * value
            n[index] += g * g
            z[index] = zi + g - (np.sqrt(n[index]) - root) / ALPHA * w
            bias_n += error * error
            bias_z += error - (bias_n**0.5 - bias_root) / ALPHA * bias
    root = np.sqrt(n)
    w = -np.sign(z) * np.maximum(np.abs(z) - L1, 0) / ((BETA + root) / ALPHA + L2)
    return Model(w.astype(np.float32), float(-bias_z / ((BETA + bias_n**0.5) / ALPHA)))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    per_class: dict[int, int] | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> Model:
    """Learn from labelled rows outside the fold, a bounded sample of them (``per_class``).

    Without any such row the model gives 0.5 for every text.
    """
    sample = labelled_sample(docs, labels, label, per_class or PER_CLASS, id_column, text_column)
    dealt = sample.repartition(SHARDS, F.xxhash64("id", F.lit("shard"))).sortWithinPartitions(
        F.xxhash64("id", F.lit("order")), "id", F.xxhash64("text"))

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for block in blocks(batches, "text"):
            bounds, index, value = features(block)
            label_of = block.batch.column(block.batch.schema.get_field_index("label")).to_pylist()
            for i in range(block.hi - block.lo):
                at = slice(bounds[i], bounds[i + 1])
                rows.append((index[at].astype(np.int32), value[at].copy(), label_of[block.lo + i]))
        if rows:
            model = ftrl(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(rows)], pa.int64()), pa.array([model.bias]),
                 pa.array([model.weights.tobytes()], pa.binary())], names=["n", "bias", "weights"])

    # One row of 4 * 2 ** BITS bytes from each shard, whatever the input.
    weights, bias, total = np.zeros(1 << BITS), 0.0, 0
    for row in dealt.mapInArrow(shard, "n bigint, bias double, weights binary").toLocalIterator():
        weights += row["n"] * np.frombuffer(row["weights"], np.float32)
        bias += row["n"] * row["bias"]
        total += row["n"]
    return Model((weights / max(1, total)).astype(np.float32), bias / max(1, total))


def margins(model: Model, block: Block) -> np.ndarray:
    """Sparse dot products of a block's texts with the weights."""
    bounds, index, value = features(block)
    terms = np.append(model.weights[index] * value, 0)
    sums = np.add.reduceat(terms, bounds[:-1])
    return np.where(np.diff(bounds) > 0, sums, 0) + model.bias


def score(
    docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per input row: the id, ``held_out`` and ``score`` from 0 to 1.

    Null and empty texts get the score of the bias alone. Ids may be null or repeat. Only id and
    text are read.
    """
    rows = docs.select(F.col(id_column).alias("__id"), F.col(text_column).alias("__text"))
    kind = rows.schema["__id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "__text"):
            p = 1 / (1 + np.exp(-np.clip(margins(shared.value, block), -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [block.batch.column(0).slice(block.lo, block.hi - block.lo), pa.array(p, pa.float64())],
                names=["__id", "score"])

    return rows.mapInArrow(scored, f"__id {kind}, score double").select(
        F.col("__id").alias(id_column), held_out(F.col("__id")).alias("held_out"), "score"
    )
