"""Toxicity: a support vector machine over a gap-weighted subsequence kernel, by Nystrom landmarks.

A text is cut into sentences and words. A word is the letters of a stretch without white space, so that
signs put between letters vanish, accents are folded, and letters standing alone side by side in a
sentence are one word. ``^`` marks a word's start. A word's features are its subsequences of four
symbols within ``SPAN``, each gap weighing ``DECAY``; the kernel of two words is the inner product of
these features. A sentence scores as its highest word does, and a text as its highest sentence.

Training: letter groups and word starts that are more frequent in toxic than in other texts beyond chance
tell which words of a toxic text carry its label first, and point out the landmarks; of other texts every
word may be drawn. The SVM (squared hinge) is fitted on the landmarks' kernel values times the inverse root
of the landmark matrix. Then the highest word of every sample text, whatever its label and margin, is
added and the fit is repeated, so any word of a toxic text may come to carry its label. As the kernel is an
inner product, the sum over landmarks is one weight per subsequence, so a text is scored by table
look-ups and not by kernel values against each landmark. A logistic fit turns a text's margin into 0 to 1.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.labelled import held_out, labelled_sample
from siltstone.llm.textbytes import Block, blocks, mix
from siltstone.scratch import materialize

SPAN = 7
DECAY = 0.35
LONGEST_WORD = 32
_BITS = 5
FEATURES = 1 << (4 * _BITS)
_OTHER, _START = 27, 28

#: Text that a task looks at at once; what is kept per word of it takes some hundred times that.
_BLOCK_BYTES = 1 << 19
#: Bounds of the training: labelled texts of each label, words of each label, landmarks.
PER_CLASS = {0: 4_000, 1: 2_500}
WORDS = 10_000
LANDMARKS = 384
ROUNDS = 3
#: Symbols of the longest word start that is counted, and how far below a toxic text's most telling word others are taken.
LONGEST_START = 9
CLOSE = 0.7


def _letter_codes() -> tuple[np.ndarray, np.ndarray]:
    """Codes 1 to 26 by byte, and by the second byte of a Latin-1 letter after 0xC3."""
    import unicodedata

    code, latin = np.zeros(256, np.uint8), np.zeros(256, np.uint8)
    for c in range(128):
        if chr(c).isalpha():
            code[c] = ord(chr(c).lower()) - 96
    code[0xC4:0xF5] = _OTHER
    for c in range(0xC0, 0x100):
        base = unicodedata.normalize("NFD", chr(c).lower())[0]
        base = {"ß": "s", "æ": "a", "ø": "o", "ð": "d", "þ": "t"}.get(base, base)
        latin[c - 0x40] = ord(base) - 96 if "a" <= base <= "z" else 0
    return code, latin


_CODE, _LATIN = _letter_codes()
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?"]] = True


class Words(NamedTuple):
    """Symbols of a block, the word of each, and the text of each word."""

    symbols: np.ndarray
    word: np.ndarray
    text: np.ndarray


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    n = len(data)
    none = np.zeros(0, np.int64)
    if n == 0:
        return Words(none.astype(np.int32), none, none)
    code = _CODE[data]
    after = np.flatnonzero(data[:-1] == 0xC3) + 1
    code[after] = _LATIN[data[after]]
    space = _SPACE[data]
    first = np.zeros(n + 1, bool)
    first[offsets[:-1]] = True
    first = first[:n]
    fresh = first.copy()
    fresh[1:] |= space[:-1]
    stretch = np.cumsum(fresh)
    stop = _STOP[data]
    stop[:-1] &= space[1:] | first[1:]
    stop |= data == 10
    ends = first.copy()
    ends[1:] |= stop[:-1]
    sentence = np.cumsum(ends)

    at = np.flatnonzero(code)
    if len(at) == 0:
        return Words(none.astype(np.int32), none, none)
    mine = stretch[at]
    begins = np.flatnonzero(np.append(True, mine[1:] != mine[:-1]))
    length = np.diff(np.append(begins, len(at)))
    said = sentence[at[begins]]
    alone = np.zeros(len(begins), bool)
    alone[1:] = (length[1:] == 1) & (length[:-1] == 1) & (said[1:] == said[:-1])
    begins = begins[~alone]
    length = np.diff(np.append(begins, len(at)))
    place = np.arange(len(at)) - np.repeat(begins, length)
    new = place % LONGEST_WORD == 0
    begins = np.flatnonzero(new)
    word = np.cumsum(new) - 1
    text = np.searchsorted(offsets, at[begins], side="right") - 1

    total = len(at) + len(begins)
    symbols = np.full(total, _START, np.int32)
    symbols[np.arange(len(at)) + word + 1] = code[at]
    marks = begins + np.arange(len(begins))
    words = np.zeros(total, np.int64)
    words[marks[1:]] = 1
    return Words(symbols, np.cumsum(words), text)


def subsequences(symbols: np.ndarray, word: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(start positions, feature numbers, weight) of all four-letter subsequences within the span."""
    n = len(symbols)
    for reach in range(3, SPAN):
        if n <= reach:
            return
        at = np.flatnonzero(word[: n - reach] == word[reach:])
        ends = (symbols[at] << (3 * _BITS)) | symbols[at + reach]
        inner = [symbols[at + i] for i in range(1, reach)]
        for a in range(len(inner)):
            high = ends | (inner[a] << (2 * _BITS))
            for b in range(a + 1, len(inner)):
                yield at, high | (inner[b] << _BITS), DECAY ** (reach - 3)


def _lengths_norm() -> np.ndarray:
    """Norm of a word's features by its number of symbols, each subsequence counted once."""
    n = np.arange(LONGEST_WORD + 2)
    square = sum(np.maximum(n - reach, 0) * ((reach - 1) * (reach - 2) // 2) * DECAY ** (2 * (reach - 3))
                 for reach in range(3, SPAN))
    return np.sqrt(np.maximum(square, 1.0)).astype(np.float32)


_NORM = _lengths_norm()


def norms(p: Words) -> np.ndarray:
    return _NORM[np.bincount(p.word, minlength=len(p.text))]


class Model(NamedTuple):
    weights: np.ndarray
    bias: float
    slope: float
    shift: float


def word_margins(weights: np.ndarray, bias: float, p: Words) -> np.ndarray:
    """The SVM's margin of every word."""
    value = np.zeros(len(p.symbols), np.float32)
    for at, feature, weight in subsequences(p.symbols, p.word):
        # Each start occurs once in ``at``.
        value[at] += np.float32(weight) * weights[feature]
    return np.bincount(p.word, value, minlength=len(p.text)) / norms(p) + bias


def text_margins(weights: np.ndarray, bias: float, p: Words, texts: int) -> np.ndarray:
    """The highest margin of each text's words; the bias alone for a text without letters."""
    out = np.full(texts, -np.inf)
    np.maximum.at(out, p.text, word_margins(weights, bias, p))
    return np.where(np.isneginf(out), bias, out)


def _column(block: Block, name: str) -> np.ndarray:
    column = block.batch.column(block.batch.schema.get_field_index(name))
    return np.asarray(column.to_pylist()[block.lo : block.hi])


def _labels(block: Block) -> np.ndarray:
    return _column(block, "label")


def units(p: Words) -> tuple[np.ndarray, np.ndarray]:
    """(word, unit) of all four neighbouring symbols and of all longer word starts up to ``LONGEST_START``."""
    none = np.zeros(0, np.int64)
    words, found = [none], [none]
    for at, feature, _ in subsequences(p.symbols, p.word):
        words.append(p.word[at].astype(np.int64))
        found.append(feature.astype(np.int64))
        break
    bounds = np.searchsorted(p.word, np.arange(len(p.text) + 1))
    key = np.zeros(len(p.text), np.int64)
    for n in range(LONGEST_START):
        here = np.flatnonzero(np.diff(bounds) > n)
        key[here] = (key[here] << _BITS) | p.symbols[bounds[here] + n]
        if n >= 4:
            words.append(here)
            found.append(key[here] | ((n + 1) << (_BITS * LONGEST_START)))
    return np.concatenate(words), np.concatenate(found)


def _text_units(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of (text, unit)."""
    p = words_of(block.data, block.offsets)
    word, unit = units(p)
    values, number = np.unique(unit, return_inverse=True)
    pair = np.unique(p.text[word] * max(1, len(values)) + number)
    return pair // max(1, len(values)), values[pair % max(1, len(values))]


class Telling(NamedTuple):
    """Units in ascending order, the logarithm of how much more frequent each is in toxic texts, and its evidence."""

    unit: np.ndarray
    lift: np.ndarray
    evidence: np.ndarray

    def of_words(self, p: Words) -> np.ndarray:
        """The greatest lift of each word's units; 0 if none is telling."""
        out = np.zeros(len(p.text))
        word, unit = units(p)
        at = np.minimum(np.searchsorted(self.unit, unit), len(self.unit) - 1)
        hit = self.unit[at] == unit
        np.maximum.at(out, word[hit], self.lift[at[hit]])
        return out


def telling_units(sample: DataFrame, totals: dict[int, int]) -> Telling:
    """Units more frequent in toxic texts than in others, beyond chance among all units looked at.

    Neither a least lift nor a least share of all toxic texts is asked for, so words of a language with
    few texts count too; a unit of fewer than three toxic texts does not.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", _BLOCK_BYTES):
            unit, often = np.unique(_text_units(block)[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(unit, pa.int64()), pa.array(often, pa.int64())], names=["u", "n"])

    base = totals[1] / (totals[0] + totals[1])
    counts = materialize(
        sample.filter("label = 1").mapInArrow(count, "u bigint, n bigint").groupBy("u").agg(F.sum("n").alias("n"))
        .filter("n >= 3"), "units")
    least = np.log(max(1, counts.count()) / 0.01)
    # Others can only take from the evidence, so a unit that falls short without them need not be counted there.
    found = counts.filter(F.col("n") * -np.log(base) >= float(least)).orderBy("u").toArrow()
    unit, toxic = (found.column(i).to_numpy().astype(np.int64) for i in range(2))
    if len(unit) == 0:
        return Telling(unit, np.zeros(0), np.zeros(0))
    shared = sample.sparkSession.sparkContext.broadcast(unit)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit = shared.value
        seen = np.zeros(len(unit), np.int64)
        for block in blocks(batches, "text", _BLOCK_BYTES):
            mine = _text_units(block)[1]
            at = np.minimum(np.searchsorted(unit, mine), len(unit) - 1)
            seen += np.bincount(at[unit[at] == mine], minlength=len(unit))
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(seen[at], pa.int64())], names=["at", "n"])

    others = sample.filter("label = 0").mapInArrow(clean, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    other = np.zeros(len(unit), np.int64)
    other[others.column(0).to_numpy()] = others.column(1).to_numpy()
    share = toxic / (toxic + other)
    # Chernoff's bound on so many toxic ones by chance.
    evidence = toxic * np.log(share / base) + other * np.log(np.maximum(1 - share, 1e-300) / (1 - base))
    keep = (share > base) & (evidence >= least)
    lift = np.log(toxic / totals[1] * totals[0] / (other + 0.5))
    keep &= lift > 0
    return Telling(unit[keep], lift[keep], evidence[keep])


def _carriers(sample: DataFrame, telling: Telling, share: dict[int, float]) -> DataFrame:
    """Training words: of toxic texts those that tell most in their text, of others any, a hashed share of each."""
    shared = sample.sparkSession.sparkContext.broadcast(telling)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", _BLOCK_BYTES):
            p = words_of(block.data, block.offsets)
            if len(p.text) == 0:
                continue
            label = _labels(block)[p.text]
            lift = shared.value.of_words(p)
            most = np.zeros(block.hi - block.lo)
            np.maximum.at(most, p.text, lift)
            told = (lift > 0) & (lift >= most[p.text] - CLOSE)
            bounds = np.searchsorted(p.word, np.arange(len(p.text) + 1))
            lot = _lots(p, bounds, _column(block, "lot"), label)
            keep = np.flatnonzero(np.where(label == 1, told & (lot < share[1]), lot < share[0]))
            yield _rows(p, bounds, keep, label)

    drawn = sample.withColumn("lot", F.xxhash64("id")).mapInArrow(words, "symbols binary, label int")
    counts = drawn.groupBy("symbols", "label").count()
    order = [F.xxhash64("symbols", "label"), "symbols"]
    return counts.filter("label = 0").orderBy(*order).limit(2 * WORDS).union(
        counts.filter("label = 1").orderBy(*order).limit(2 * WORDS))


def _lots(p: Words, bounds: np.ndarray, ids: np.ndarray, label: np.ndarray) -> np.ndarray:
    """From 0 to 1 by id, word and label alone, wherever the word stands."""
    place = np.arange(len(p.symbols)) - bounds[p.word]
    with np.errstate(over="ignore"):
        power = np.cumprod(np.full(LONGEST_WORD + 1, 0x9E3779B97F4A7C15, np.uint64))
        h = np.add.reduceat(p.symbols.astype(np.uint64) * power[place], bounds[:-1])
        h = mix(mix(h + label.astype(np.uint64)) + ids.astype(np.uint64)[p.text])
    return (h >> np.uint64(11)).astype(np.float64) / (1 << 53)


def _rows(p: Words, bounds: np.ndarray, keep: np.ndarray, label: np.ndarray) -> pa.RecordBatch:
    words = [p.symbols[bounds[i] : bounds[i + 1]].astype(np.uint8).tobytes() for i in keep]
    return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(label[keep], pa.int32())],
                                      names=["symbols", "label"])


def _joined(words: Iterable[bytes]) -> Words:
    """Collected words end to end."""
    words = list(words)
    lengths = np.array([len(w) for w in words])
    symbols = np.frombuffer(b"".join(words), np.uint8).astype(np.int32)
    return Words(symbols, np.repeat(np.arange(len(words)), lengths), np.arange(len(words)))


def landmark_words(
    words: list[tuple[bytes, int]], telling: Telling, hard: list[bytes], most: int = LANDMARKS
) -> Words:
    """For each telling unit, those with the most evidence first, the shortest word of toxic texts that holds
    it, then the hard words of other texts, then any of their words."""
    toxic = sorted({w for w, y in words if y == 1 and len(w) >= 4}, key=lambda w: (len(w), w))
    by_unit: dict[int, bytes] = {}
    if toxic:
        word, unit = units(_joined(toxic))
        for i in np.argsort(word, kind="stable").tolist():
            by_unit.setdefault(int(unit[i]), toxic[word[i]])
    order = np.argsort(-telling.evidence, kind="stable")
    chosen = dict.fromkeys(by_unit[u] for u in telling.unit[order].tolist() if u in by_unit)
    chosen = dict.fromkeys(list(chosen)[: most // 2])
    others = sorted({w for w, y in words if y == 0 and len(w) >= 4}, key=lambda w: (zlib.crc32(w), w))
    chosen.update(dict.fromkeys(hard[: most // 3]))
    chosen.update(dict.fromkeys(others[: max(0, most - len(chosen))]))
    return _joined(chosen)


def inserted(word: bytes) -> list[bytes]:
    """The word with a letter put in at each inner place, the letter drawn by a hash."""
    return [word[:i] + bytes([1 + zlib.crc32(word + bytes([i])) % 26]) + word[i:] for i in range(2, len(word))]


class Nystrom:
    """Landmark words as rows of subsequence weights, and the map to the features of the SVM."""

    def __init__(self, marks: Words):
        parts = [(p, f, np.full(len(f), w)) for a, f, w in subsequences(marks.symbols, marks.word)
                 for p in [marks.word[a]]]
        word, feature, weight = (np.concatenate(x) for x in zip(*parts, strict=True))
        self.used, column = np.unique(feature, return_inverse=True)
        self.phi = np.zeros((len(marks.text), len(self.used)))
        np.add.at(self.phi, (word, column), weight)
        self.phi /= np.maximum(np.linalg.norm(self.phi, axis=1, keepdims=True), 1e-9)
        values, vectors = np.linalg.eigh(self.phi @ self.phi.T)
        root = np.where(values > 1e-6, 1 / np.sqrt(np.maximum(values, 1e-6)), 0)
        self.half = (vectors * root) @ vectors.T
        self.column = np.full(FEATURES, -1, np.int32)
        self.column[self.used] = np.arange(len(self.used))

    def features(self, p: Words) -> np.ndarray:
        """Kernel values of words with the landmarks, times the inverse root."""
        n, k = len(p.text), len(self.used)
        out = np.zeros((n, len(self.phi)), np.float32)
        parts = []
        for at, feature, weight in subsequences(p.symbols, p.word):
            column = self.column[feature]
            hit = column >= 0
            parts.append((p.word[at[hit]], column[hit], np.full(int(hit.sum()), weight)))
        word, column, weight = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(word, kind="stable")
        word, column, weight = word[order], column[order], weight[order]
        for lo in range(0, n, 512):
            a, b = np.searchsorted(word, [lo, lo + 512])
            rows = min(512, n - lo)
            dense = np.bincount((word[a:b] - lo) * k + column[a:b], weight[a:b], minlength=rows * k)
            out[lo : lo + rows] = dense.reshape(rows, k) @ self.phi.T @ self.half
        return out / norms(p)[:, None]

    def weights(self, v: np.ndarray) -> np.ndarray:
        """One weight per subsequence: the landmark expansion of the SVM's vector."""
        table = np.zeros(FEATURES, np.float32)
        table[self.used] = (self.half @ v) @ self.phi
        return table


def svm(
    x: np.ndarray, label: np.ndarray, often: np.ndarray, c: float = 20.0, rounds: int = 40
) -> tuple[np.ndarray, float]:
    """Linear SVM with squared hinge loss, rows weighted and classes balanced, by Newton steps."""
    y = np.where(label == 1, 1.0, -1.0)
    sums = np.array([often[label == 0].sum(), often[label == 1].sum()])
    weight = c * often / sums[label] * often.sum() / 2
    x1 = np.hstack([x.astype(np.float64), np.ones((len(x), 1))])
    w = np.zeros(x1.shape[1])
    ridge = np.ones(len(w))
    ridge[-1] = 1e-6

    def loss(w: np.ndarray) -> float:
        slack = np.maximum(1 - y * (x1 @ w), 0)
        return 0.5 * (ridge * w * w).sum() + (weight * slack * slack).sum()

    for _ in range(rounds):
        active = y * (x1 @ w) < 1
        xa = x1[active]
        g = ridge * w - 2 * xa.T @ (weight[active] * (y[active] - xa @ w))
        h = np.diag(ridge) + 2 * (xa * weight[active][:, None]).T @ xa
        step = np.linalg.solve(h, g)
        size, now = 1.0, loss(w)
        while size > 1e-4 and loss(w - size * step) > now:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-7:
            break
    return w[:-1], float(w[-1])


def logistic(margin: np.ndarray, label: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift of a logistic fit with a light ridge; the slope is not below zero."""
    x = np.stack([margin, np.ones(len(margin))], 1)
    w = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - label) + np.array([1e-2, 1e-4]) * w
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag([1e-2, 1e-4])
        w = w - np.linalg.solve(h, g)
    return max(0.0, float(w[0])), float(w[1])


def _highest(sample: DataFrame, weights: np.ndarray, bias: float) -> DataFrame:
    """Of every sample text its label, margin and highest-scoring word."""
    shared = sample.sparkSession.sparkContext.broadcast((weights, bias))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = shared.value
        for block in blocks(batches, "text", _BLOCK_BYTES):
            label, texts = _labels(block), block.hi - block.lo
            p = words_of(block.data, block.offsets)
            m = word_margins(weights, bias, p) if len(p.text) else np.zeros(0)
            order = np.lexsort((-m, p.text))
            top = order[np.append(True, p.text[order][1:] != p.text[order][:-1])] if len(m) else order
            bounds = np.searchsorted(p.word, np.arange(len(p.text) + 1))
            rows = _rows(p, bounds, top, label[p.text] if len(m) else label[:0])
            bare = np.setdiff1d(np.arange(texts), p.text)
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([rows.column(0), pa.array([b""] * len(bare), pa.binary())]),
                 pa.concat_arrays([rows.column(1), pa.array(label[bare], pa.int32())]),
                 pa.array(np.append(m[top], np.full(len(bare), bias)), pa.float64())],
                names=["symbols", "label", "margin"])

    return sample.mapInArrow(best, "symbols binary, label int, margin double")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    per_class: dict[int, int] | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> Model:
    """Learn from labelled texts outside the fold: a bounded sample of texts and words.

    If one of the labels is missing there, or nothing tells toxic texts from others, every
    text gets the share of toxic rows in the sample (0 without any row).
    """
    sample = labelled_sample(docs, labels, label, per_class or PER_CLASS, id_column, text_column)
    totals = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    base = totals.get(1, 0) / max(1, sum(totals.values()))
    flat = Model(np.zeros(FEATURES, np.float32), 0.0, 0.0, float(np.log((base + 1e-6) / (1 - base + 1e-6))))
    if len(totals) < 2:
        return flat
    telling = telling_units(sample, totals)
    if len(telling.unit) == 0:
        return flat
    # A word is some six bytes long; toxic texts name a few telling words each.
    size = sample.filter("label = 0").agg(F.sum(F.octet_length("text"))).head()[0] / 6
    share = {0: min(1.0, WORDS / max(1, size)), 1: min(1.0, WORDS / (10 * totals[1]))}
    rows = _carriers(sample, telling, share).collect()
    train = {(bytes(r["symbols"]), r["label"]): r["count"] for r in rows}
    if len({y for _, y in train}) < 2:
        return flat
    for (w, y), n in list(train.items()):
        if y == 1:
            for v in inserted(w):
                train[v, 1] = train.get((v, 1), 0) + max(1, n // 8)
    hard: list[bytes] = []
    for _ in range(ROUNDS):
        words = sorted(train)
        nystrom = Nystrom(landmark_words(words, telling, hard))
        x = nystrom.features(_joined(w for w, _ in words))
        v, bias = svm(x, np.array([y for _, y in words]), np.sqrt([train[w] for w in words]))
        weights = nystrom.weights(v)
        top = _highest(sample, weights, bias).collect()
        worst: dict[bytes, float] = {}
        for r in top:
            w = bytes(r["symbols"])
            if len(w) >= 4:
                train[w, r["label"]] = train.get((w, r["label"]), 0) + 1
                if r["label"] == 0:
                    worst[w] = r["margin"]
        hard += sorted(worst, key=lambda w: (-worst[w], w))[: LANDMARKS // 8]
    if len({r["label"] for r in top}) < 2:
        return flat
    slope, shift = logistic(np.array([r["margin"] for r in top]), np.array([r["label"] for r in top]))
    return Model(weights, bias, slope, shift)


def score(
    docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per input row: the id, ``held_out`` and ``score`` from 0 to 1.

    Null and empty texts, and texts without letters, get the score of the bias. Ids may be null
    or repeat. Only id and text are read.
    """
    rows = docs.select(F.col(id_column).alias("__id"), F.col(text_column).alias("__text"))
    kind = rows.schema["__id"].dataType.simpleString()
    scored = rows.mapInArrow(_scorer(docs, model), f"__id {kind}, score double")
    return scored.select(F.col("__id").alias(id_column), held_out(F.col("__id")).alias("held_out"), "score")


def _scores(m: Model, block: Block) -> np.ndarray:
    margin = text_margins(m.weights, m.bias, words_of(block.data, block.offsets), block.hi - block.lo)
    return 1 / (1 + np.exp(-np.clip(m.slope * margin + m.shift, -30, 30)))


def _scorer(docs: DataFrame, model: Model):
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "__text", 1 << 20):
            p = _scores(shared.value, block)
            yield pa.RecordBatch.from_arrays(
                [block.batch.column(0).slice(block.lo, block.hi - block.lo), pa.array(p, pa.float64())],
                names=["__id", "score"])

    return run


def drop_toxic(
    docs: DataFrame, model: Model, text_column: str = "text", threshold: float = 0.5
) -> DataFrame:
    """The documents scoring below ``threshold``, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come back a block at a time, so neither side holds a batch of long texts twice.
        for block in blocks(batches, text_column, _BLOCK_BYTES):
            keep = pa.array(_scores(shared.value, block) < threshold)
            yield block.batch.slice(block.lo, block.hi - block.lo).filter(keep)

    return docs.mapInArrow(run, docs.schema)
