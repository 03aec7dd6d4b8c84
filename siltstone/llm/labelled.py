"""What the two trained classifiers share: the held-out fold and a bounded labelled sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.scratch import materialize

_STEPS = 1 << 20


def held_out(id_column: Column) -> Column:
    """True where crc32 of the id as text leaves 0 modulo 5; a null id is held out too."""
    return F.coalesce(F.pmod(F.crc32(id_column.cast("string")), F.lit(5)) == 0, F.lit(True))


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    per_class: dict[int, int],
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Rows ``id, text, label`` outside the fold, about ``per_class[label]`` of each label at most.

    Which rows is decided by a hash of the id against the share of its class to take, so the same
    tables give the same rows. Labels other than those of ``per_class``, null ids and ids with
    different labels take no part. The result is written and read back.
    """
    one = (
        labels.select(F.col(id_column).alias("id"), F.col(label).cast("int").alias("label"))
        .filter(F.col("label").isin(list(per_class)) & ~held_out(F.col("id")))
        .groupBy("id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .filter("label = other")
        .drop("other")
    )
    counts = {r["label"]: r["count"] for r in one.groupBy("label").count().collect()}
    share = F.lit(0)
    for value, most in per_class.items():
        part = min(_STEPS, _STEPS * most // max(1, counts.get(value, 0)))
        share = F.when(F.col("label") == value, F.lit(part)).otherwise(share)
    taken = one.filter(F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(_STEPS)) < share)
    # Bounded by per_class: some 16 bytes for each row taken.
    texts = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    return materialize(texts.join(F.broadcast(taken), "id"), "sample")
