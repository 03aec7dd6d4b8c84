"""Line dedup by levelled sorted runs of line hashes.

Documents are taken in batches of ascending id. A batch's keys are anti-joined with the runs of all
earlier batches: a key found there, or held by a smaller id of the batch itself, loses its lines;
the other keys are written as the batch's own run, sorted by hash. After every ``FAN`` runs of a
level they are merged into one run of the next level, so a batch meets few files however many
came before. A key is a 128-bit prefix of SHA-256 over the stripped, ASCII-lower-cased line.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.scratch import materialize, new_folder

BATCHES = 6
FAN = 3
MIN_CHARS = 10
_STRIP = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(_STRIP)), _UPPER, _UPPER.lower())


class Runs:
    """Key tables by level; each key is in one run."""

    def __init__(self, fan: int):
        self.fan = fan
        self.levels: list[list[DataFrame]] = []

    def known(self) -> DataFrame | None:
        every = [run for level in self.levels for run in level]
        return reduce(DataFrame.union, every) if every else None

    def add(self, run: DataFrame, level: int = 0) -> None:
        if len(self.levels) == level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fan:
            merged = reduce(DataFrame.union, self.levels[level])
            self.levels[level] = []
            self.add(_sorted_run(merged), level + 1)


def _sorted_run(keys: DataFrame) -> DataFrame:
    return materialize(keys.repartition("key").sortWithinPartitions("key"), "run")


def dropped_lines(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_chars: int = MIN_CHARS,
    batches: int = BATCHES,
    fan: int = FAN,
) -> DataFrame:
    """``id``, ``text_hash`` and ``gone``, the positions of the lines that a document loses.

    Only documents that lose lines have a row.
    """
    text = F.col("text")
    lines = (
        docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
        .select("id", F.xxhash64("text").alias("text_hash"), F.posexplode(lines_of(text)).alias("at", "line"))
        .withColumn("key", line_key(F.col("line")))
        .filter(F.char_length("key") >= min_chars)
        .select("id", "text_hash", "at", F.unhex(F.substring(F.sha2("key", 256), 1, 32)).alias("key"))
    )
    # The bounds are values of the id, so all lines of one id are in one batch whatever they are.
    cuts = docs.select(F.percentile_approx(F.col(id_column), [i / batches for i in range(1, batches)], 1000)).head()[0]
    cuts = sorted(set(cuts or []))
    batch = reduce(lambda x, c: x + F.when(F.col("id") > F.lit(c), 1).otherwise(0), cuts, F.lit(0))
    # Null ids come last: they own a line only if no other document holds it.
    batch = F.when(F.col("id").isNull(), len(cuts) + 1).otherwise(batch)
    path = new_folder(docs.sparkSession, "lines")
    lines = lines.withColumn("batch", batch)
    lines.write.partitionBy("batch").parquet(path)
    read = docs.sparkSession.read.schema(lines.schema).parquet(path)

    runs, gone = Runs(fan), []
    for number in range(len(cuts) + 2):
        mine = read.filter(F.col("batch") == number).drop("batch")
        if number > len(cuts) and mine.isEmpty():
            break
        keys = mine.groupBy("key").agg(F.min("id").alias("owner"), (F.min("id") < F.max("id")).alias("several"))
        known = runs.known()
        if known is None:
            met = keys.withColumn("old", F.lit(False))
        else:
            met = keys.join(known.withColumn("old", F.lit(True)), "key", "left").withColumn(
                "old", F.coalesce("old", F.lit(False)))
        met = materialize(met.repartition("key").sortWithinPartitions("key"), "met")
        runs.add(met.filter(~F.col("old")).select("key"))
        # A null id never precedes another: within the last batch nothing is repeated.
        losing = met.filter(F.col("old") | F.coalesce("several", F.lit(False)))
        gone.append(mine.join(losing, "key").filter("old OR id > owner").select("id", "text_hash", "at"))
    return reduce(DataFrame.union, gone).groupBy("id", "text_hash").agg(F.sort_array(F.collect_set("at")).alias("gone"))


def _without(lines: Column, gone: Column) -> Column:
    """The stretches of ``lines`` between the sorted positions ``gone``, in one pass."""
    bounds = F.concat(F.array(F.lit(-1)), gone, F.array(F.size(lines)))
    return F.flatten(F.transform(
        F.sequence(F.lit(0), F.size(gone)),
        lambda i: F.slice(lines, F.get(bounds, i) + 2, F.get(bounds, i + 1) - F.get(bounds, i) - 1),
    ))


def dedup_lines(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_chars: int = MIN_CHARS,
    batches: int = BATCHES,
    fan: int = FAN,
) -> DataFrame:
    """One row per input row: the id, ``n_lines`` before, ``n_dropped`` and the kept ``text``.

    Lines whose key has at least ``min_chars`` code points and is found in two documents or more stay
    only in the smallest id that holds them, all of them there. A null text is one empty line; a
    text that loses every line is empty. A document is an id: rows repeating it count as one
    document, and so do all null ids, which come after every other. Other columns are not read.
    """
    gone = dropped_lines(docs, id_column, text_column, min_chars, batches, fan)
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    on = rows["id"].eqNullSafe(gone["id"]) & (rows["text_hash"] == gone["text_hash"])
    lines = lines_of(rows["text"])
    return rows.join(gone, on, "left").select(
        rows["id"].alias(id_column),
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size(gone["gone"]), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(gone["gone"].isNull(), rows["text"])
        .otherwise(F.concat_ws("\n", _without(lines, gone["gone"])))
        .alias("text"),
    )
