"""Exact dedup as a tree of merges over digest runs, in DataFrame operations only.

Rows are dealt to ``RUNS`` runs by their id. A run holds one entry per digest: the id that stays and
how many rows it stands for. In each round ``FAN`` neighbouring runs are exchanged and merged
into one, sorted by digest, until one run is left in each digest shard. So a text that a third
of all rows share arrives as one entry per run, and no task sees its rows together.

Equality is SHA-256 of the UTF-8 bytes, checked at every level by byte length and by an
independent 64-bit hash that are part of an entry's key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.names import unused
from siltstone.scratch import materialize

RUNS = 64
FAN = 4
SHARD_DIGITS = 3
_KEY = ["__digest", "__bytes", "__check"]


def digest_rows(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Id, run and digest key of every row; null text counts as empty."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    return docs.select(
        F.col(id_column).alias("__id"),
        F.pmod(F.xxhash64(F.col(id_column)), F.lit(RUNS)).alias("__run"),
        F.sha2(text, 256).alias("__digest"),
        F.octet_length(text).cast("long").alias("__bytes"),
        F.xxhash64(F.lit("check"), text).alias("__check"),
    )


def merge_rounds(rows: DataFrame, keep: str) -> tuple[DataFrame, DataFrame]:
    """The entries of the first runs, and those of the last merge: one per digest."""
    stays = F.max if keep == "largest" else F.min
    entries = rows.groupBy("__run", *_KEY).agg(
        stays("__id").alias("__keep"), F.count(F.lit(1)).alias("__size")
    )
    level, left = entries, RUNS
    while left > 1:
        left = -(-left // FAN)
        # Equal digests lie in one shard, and a shard's runs of one node in one sorted partition.
        level = (
            level.withColumn("__run", F.col("__run").cast("long") % F.lit(left))
            .withColumn("__shard", F.substring("__digest", 1, SHARD_DIGITS))
            .repartition("__shard", "__run")
            .sortWithinPartitions("__shard", "__run", *_KEY)
            .groupBy("__shard", "__run", *_KEY)
            .agg(stays("__keep").alias("__keep"), F.sum("__size").alias("__size"))
            .drop("__shard")
        )
    return entries, level.drop("__run")


def exact_groups(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: str = "largest"
) -> DataFrame:
    """One row per input row: the id, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    ``keep`` is ``largest`` or ``smallest``. Null texts are empty texts. Ids take part as they
    are: rows that repeat both id and text are one document, share every value and count in
    ``group_size``; a null id stays only where its whole group has none. Other columns, of
    whatever name, are not read. No rows in, no rows out.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError("keep is 'largest' or 'smallest'")
    # The digests are some 3 % of the text; written once, the text is read once.
    rows = materialize(digest_rows(docs, id_column, text_column), "digests")
    entries, merged = merge_rounds(rows, keep)
    # Back down: groups of several rows to their entry in each run, from there to the rows.
    several = merged.filter("__size > 1")
    down = entries.select("__run", *_KEY).join(several, _KEY)
    return rows.join(down, ["__run", *_KEY], "left").select(
        F.col("__id").alias(id_column),
        F.when(F.col("__size").isNull(), F.col("__id")).otherwise(F.col("__keep")).alias("keep_id"),
        F.coalesce("__size", F.lit(1)).cast("long").alias("group_size"),
        F.when(F.col("__size").isNull(), F.lit(True))
        .otherwise(F.col("__id").eqNullSafe(F.col("__keep")))
        .alias("kept"),
        F.col("__digest").alias("text_sha256"),
    )


def drop_copies(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: str = "largest"
) -> DataFrame:
    """The documents that ``exact_groups`` keeps, with all their columns."""
    groups = exact_groups(docs, id_column, text_column, keep)
    gone_id, gone_digest = unused(docs, "__gone"), unused(docs, "__gone_digest")
    gone = groups.filter(~F.col("kept")).select(F.col(id_column).alias(gone_id), F.col("text_sha256").alias(gone_digest))
    digest = F.sha2(F.coalesce(docs[text_column], F.lit("")), 256)
    # One null-safe condition on id and one on digest: an id may repeat with another text.
    on = docs[id_column].eqNullSafe(F.col(gone_id)) & (digest == F.col(gone_digest))
    return docs.join(gone.distinct(), on, "left_anti")
