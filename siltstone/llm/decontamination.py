"""Benchmark decontamination by spaced seeds, in DataFrame operations only.

Texts are words (runs of letters and digits, lower-cased). A mask names the word positions that count and
skips the others, so a hash of the counted words survives substitutions at the skipped places.
Hashes of benchmark and documents under the same mask are joined; a hit fixes how the two texts lie to
each other. On that alignment the words that agree are counted within every window of ``WINDOW`` words of the item (of the whole item if shorter); a share of
``SIMILARITY`` in one window contaminates the document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.names import unused
from siltstone.scratch import materialize

#: Fixed masks: offsets of the words that count. Any five-word run of equal words is hit by the first.
MASKS = ((0, 1, 2, 3, 4), (0, 1, 3, 4, 6), (0, 2, 3, 5, 6), (0, 1, 4, 5, 7))
#: Masks for items of fewer than ``SHORT`` words, which need not keep five words of a mask: with a fifth of the words
#: substituted, one of these still hits at some place (from ``SHORT`` words on one of ``MASKS`` does).
SHORT_MASKS = ((0, 1, 2), (0, 1, 3))
SHORT = 12
WINDOW = 25
SIMILARITY = 0.8
#: Seeds of the benchmark are broadcast up to so many rows of 32 bytes; beyond, both sides are shuffled.
BROADCAST_SEEDS = 1_000_000


def words_of(text: Column) -> Column:
    """Words of a text; null and empty texts have none."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", -1), "")


def seeds_of(rows: DataFrame, masks: tuple[tuple[int, ...], ...], *keep: str) -> DataFrame:
    """For each word of the column ``words`` and each mask a row of ``keep``, ``at``, ``mask`` and ``seed``.

    The words are exploded beside their array and hashed from it, which Spark compiles into one
    loop. Where a mask reaches beyond the text its seed covers fewer words.
    """
    words, at = F.col("words"), F.col("at")
    hashes = [F.xxhash64(F.lit(m), *[F.get(words, at + F.lit(o)) for o in mask]) for m, mask in enumerate(masks)]
    return (
        rows.select(*keep, "words", F.posexplode("words").alias("at", "__word"))
        .select(*keep, "at", F.posexplode(F.array(*hashes)).alias("mask", "seed"))
    )


def _best_share(item: Column, doc: Column, shift: Column) -> Column:
    """Highest share of agreeing words in a window of the item laid over the document."""
    agree = F.transform(
        F.sequence(F.lit(0), F.size(item) - 1),
        lambda i: (F.get(item, i) == F.get(doc, i + shift)),
    )
    window = F.least(F.size(item), F.lit(WINDOW))
    counts = F.transform(
        F.sequence(F.lit(0), F.size(item) - window),
        lambda s: F.size(F.filter(F.slice(agree, s + 1, window), lambda a: a)),
    )
    return F.array_max(counts) / window


def matches(
    docs: DataFrame, benchmark: DataFrame, id_column: str, text_column: str, item_id_column: str, item_text_column: str
) -> DataFrame:
    """``id``, ``text_hash``, ``item``, ``similarity`` and ``shift`` of verified alignments."""
    items = materialize(
        benchmark.select(F.col(item_id_column).alias("item"), words_of(F.col(item_text_column)).alias("item_words"))
        .filter(F.size("item_words") > 0)
        .withColumn("item_row", F.monotonically_increasing_id()), "items")
    size, at, mask = F.col("n"), F.col("at"), F.col("mask")
    short = not items.filter(F.size("item_words").between(len(MASKS[0]), SHORT - 1)).isEmpty()
    masks = MASKS + SHORT_MASKS if short else MASKS
    reach = F.element_at(F.array(*[F.lit(m[-1]) for m in masks]), mask + 1)
    own = (mask < len(MASKS)) | size.between(len(MASKS[0]), SHORT - 1)
    item_seeds = (
        seeds_of(items.select("item_row", F.size("item_words").alias("n"), F.col("item_words").alias("words")), masks, "item_row", "n")
        # Whole masks only, but for items that are shorter than the first one.
        .filter(((at + reach < size) & own) | ((size < len(MASKS[0])) & (at == 0) & (mask == 0)))
        .select("item_row", "seed", at.alias("item_at"))
        .distinct()
    )
    if item_seeds.count() <= BROADCAST_SEEDS:
        item_seeds = F.broadcast(item_seeds)
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(F.col(id_column).alias("id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    hits = (
        seeds_of(rows.select("id", "text_hash", words_of(F.col("text")).alias("words")), masks, "id", "text_hash")
        .join(item_seeds, "seed")
        .select("id", "text_hash", "item_row", (F.col("at") - F.col("item_at")).alias("shift"))
        .distinct()
    )
    found = hits.groupBy("id", "text_hash").agg(F.collect_list(F.struct("item_row", "shift")).alias("hits"))
    found = materialize(found, "hits").withColumnsRenamed({"id": "hit_id", "text_hash": "hit_hash"})
    # Documents without a hit end here; of the others each alignment is looked at once.
    on = rows["id"].eqNullSafe(found["hit_id"]) & (rows["text_hash"] == found["hit_hash"])
    return (
        rows.join(found, on)
        .select("id", "text_hash", words_of(F.col("text")).alias("words"), "hits")
        .select("id", "text_hash", "words", F.inline("hits"))
        .join(items, "item_row")
        .filter((F.size("item_words") >= len(MASKS[0])) | (F.size("item_words") == F.size("words")))
        .withColumn("similarity", _best_share(F.col("item_words"), F.col("words"), F.col("shift")))
        .filter(F.col("similarity") >= SIMILARITY)
        .select("id", "text_hash", "item", "similarity", "shift")
    )


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """One row per document and benchmark item found in it: ids, ``similarity`` and ``at``, the
    document's word where the item starts (below 0 if the item's start is cut off).

    An item is found where at least 0.8 of its words (of a window of 25 in a longer one) stand in their places, for
    every such pattern of substitutions in items of up to 25 words. Null and empty texts and items contain nothing. Items shorter than five words are found only in
    documents that are nothing but them. Rows that repeat an id are read together: the row of the
    best match counts. Null ids take part and come back as null. Other columns are not read.
    """
    found = matches(docs, benchmark, id_column, text_column, item_id_column, item_text_column)
    best = found.groupBy("id", "item").agg(F.max(F.struct("similarity", (-F.col("shift")).alias("early"))).alias("best"))
    return best.select(F.col("id").alias(id_column), F.col("item").alias(item_id_column),
                       F.col("best.similarity").alias("similarity"), (-F.col("best.early")).alias("at"))


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """The documents in which no benchmark item is found, with all their columns."""
    gone_id, gone_hash = unused(docs, "__gone"), unused(docs, "__gone_hash")
    gone = matches(docs, benchmark, id_column, text_column, item_id_column, item_text_column).select(
        F.col("id").alias(gone_id), F.col("text_hash").alias(gone_hash)).distinct()
    text_hash = F.xxhash64(F.coalesce(docs[text_column], F.lit("")))
    on = docs[id_column].eqNullSafe(F.col(gone_id)) & (text_hash == F.col(gone_hash))
    return docs.join(materialize(gone, "gone"), on, "left_anti")
