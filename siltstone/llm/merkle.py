"""Merkle manifest of a dataset: a tree per group of rows, one tree over the groups, and a proof per row.

A leaf is the SHA-256 of a row's fields, each written as its UTF-8 byte count, ``:`` and its value, or ``-``
when null. Leaves of a group stand in the order of their id; every three neighbours become the hash of
their concatenated digests (lowercase hex text) until one node is left, and a single leaf is its own root.
Group roots, ordered by group (null first, then by UTF-8 bytes), make the dataset's root the same way.

No task sees a whole group. Positions come from a range sort and counts per partition. An aligned block of
``WIDTH`` neighbours keeps each of its levels as one hex string, in which fixed-width substrings are hashed to
the level above and the substrings beside a node are its siblings. A block gives one node, and the nodes of all
blocks go through the same step until each group is one block, so a round shuffles 1 / ``WIDTH`` of the one before.

Defined results: a null field differs from an empty one; rows without an id come first; rows of one id are
ordered by leaf, and equal rows are leaves of their own with equal digests but the proofs of their places; an
empty table gives no rows; other columns, whatever their names, take no part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.scratch import materialize

FANOUT = 3
#: Levels that a block climbs, and the nodes it starts from.
HEIGHT = 5
WIDTH = FANOUT**HEIGHT
_HEX = 64
_RUN = FANOUT * _HEX
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*fields: Column) -> Column:
    """SHA-256, in hex, of the fields' texts, each with its length in bytes."""

    def written(field: Column) -> Column:
        text = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(written, fields)), 256)


def ranked(rows: DataFrame, tree: str, *order: str) -> DataFrame:
    """Add ``rank`` (from 0, by ``order`` inside ``tree``) and ``size`` (rows of the tree).

    Rows are sorted by ranges and written with their place in their file; what stands before a file is summed over one row
    per file and tree.
    """
    dealt = rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
    laid = materialize(dealt.withColumn("at", F.monotonically_increasing_id()), "ranked")
    file = F.shiftright("at", 33).alias("file")
    starts = laid.groupBy(tree, file).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy(tree)
    before = whole.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select(
        tree, "file", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("n").over(whole).alias("size"))
    placed = laid.select("*", file).join(starts, [tree, "file"])
    return placed.withColumn("rank", F.col("at") + F.col("shift")).drop("at", "file", "shift")


def _parents(level: Column) -> Column:
    """The level above, as one string: the hash of each run of three digests."""
    runs = F.call_function("div", F.octet_length(level) + F.lit(_RUN - _HEX), F.lit(_RUN)).cast("int")
    starts = F.sequence(F.lit(0), runs - 1)
    return F.array_join(F.transform(starts, lambda i: F.sha2(F.substr(level, i * _RUN + 1, F.lit(_RUN)), 256)), "")


def _step(level: Column, alone: Column, at: Column, height: int) -> Column:
    """What stands left and right of the node over place ``at`` in its run; null where the level is the tree's root."""
    node = F.floor(at / F.lit(FANOUT**height)).cast("int")
    place = F.pmod(node, F.lit(FANOUT))
    start = (node - place) * _HEX + 1
    left = F.substr(level, start, place * _HEX)
    right = F.substr(level, start + (place + 1) * _HEX, (F.lit(FANOUT - 1) - place) * _HEX)
    done = alone & (F.octet_length(level) == _HEX)
    return F.when(~done, F.struct(left.alias("left"), right.alias("right")))


def climb(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes with ``root`` and ``path``, one ``tree, root`` row per tree).

    ``nodes`` has ``tree, size, rank, hash`` and one ``carry`` column; ``path`` lists, from the node's own level up, the
    concatenated digests to its left and right.
    """
    block = F.call_function("div", F.col("rank"), F.lit(WIDTH)).alias("block")
    alone = F.col("size") <= WIDTH
    row = F.struct("rank", "hash", "carry")
    blocks = nodes.groupBy("tree", "size", block).agg(F.sort_array(F.collect_list(row)).alias("nodes"))
    blocks = blocks.select(
        "tree", "size", "block", F.array_join("nodes.hash", "").alias("l0"), F.col("nodes.carry").alias("carried"))
    for i in range(HEIGHT):
        level = F.col(f"l{i}")
        above = F.when(alone & (F.octet_length(level) == _HEX), level).otherwise(_parents(level))
        blocks = blocks.withColumn(f"l{i + 1}", above)
    blocks = materialize(blocks, "blocks")
    top = F.col(f"l{HEIGHT}")
    if (blocks.agg(F.max("size")).first()[0] or 0) <= WIDTH:
        roots = blocks.select("tree", top.alias("root"))
        none = F.expr("CAST(array() AS array<struct<left: string, right: string>>)")
        blocks = blocks.withColumns({"root": top, "beyond": none})
    else:
        count = F.call_function("div", F.col("size") + F.lit(WIDTH - 1), F.lit(WIDTH)).alias("size")
        above, roots = climb(blocks.select("tree", count, F.col("block").alias("rank"), top.alias("hash"), F.lit(0).alias("carry")))
        above = above.select("tree", F.col("rank").alias("block"), "root", F.col("path").alias("beyond"))
        blocks = blocks.join(above, ["tree", "block"])

    def opened(carry: Column, at: Column) -> Column:
        steps = F.array_compact(F.array(*[_step(F.col(f"l{i}"), alone, at, i) for i in range(HEIGHT)]))
        return F.struct(
            (F.col("block") * WIDTH + at).alias("rank"), F.substr("l0", at * _HEX + 1, F.lit(_HEX)).alias("hash"),
            carry.alias("carry"), F.concat(steps, F.col("beyond")).alias("path"))

    return blocks.select("tree", "root", F.inline(F.transform("carried", opened))), roots


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def proof_text(path: Column) -> Column:
    """Sibling digests of a path, level by level, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, group: str = "source", key: str = "doc_id") -> DataFrame:
    """``leaf``, ``subroot`` (of the row's group), ``root`` and ``path`` (left and right siblings) of every row, and its ``key``."""
    return _manifest(docs, fields, group, key, [])


def verified(
    docs: DataFrame, changed: dict[str, Column], where: Column,
    fields: Sequence[str] = FIELDS, group: str = "source", key: str = "doc_id",
) -> DataFrame:
    """The manifest and, per row, the root that its proof gives for the row as it is now.

    A row is now as ``docs`` has it, but for the ``changed`` fields of the rows ``where``. ``folded_root`` is recomputed
    from the present leaf and the recorded siblings; ``verified`` says whether it is the recorded root.
    """
    now = digest(*[changed.get(f, F.col(f)) for f in fields])
    rows = _manifest(docs, fields, group, key, [F.when(F.coalesce(where, F.lit(False)), now).alias("now")])
    root = folded(F.coalesce("now", "leaf"), F.col("path"))
    rows = rows.withColumn("folded_root", root).withColumn("verified", F.col("folded_root") == F.col("root"))
    return rows.drop("now")


def _manifest(docs: DataFrame, fields: Sequence[str], group: str, key: str, more: list[Column]) -> DataFrame:
    # A text in front of every group that is known: the null group is the empty text, and sorts first.
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("tree")
    leaves = docs.select(tree, F.col(key).alias("id"), digest(*map(F.col, fields)).alias("hash"), *more)
    leaves = materialize(leaves, "leaves")
    extra = leaves.columns[3:]
    carried = F.struct("id", *extra)
    placed = ranked(leaves, "tree", "id", "hash").select("tree", "size", "rank", "hash", carried.alias("carry"))
    rows, subroots = climb(placed)
    groups = subroots.select(F.lit("").alias("all"), F.col("tree").alias("carry"), F.col("root").alias("hash"))
    groups = ranked(groups, "all", "carry").withColumnRenamed("all", "tree")
    tops, _ = climb(groups)
    tops = tops.select(F.col("carry").alias("tree"), F.col("root").alias("top"), F.col("path").alias("upper"))
    rows = rows.join(materialize(tops, "groups"), "tree")
    return rows.select(
        F.col("carry.id").alias(key), F.col("hash").alias("leaf"), F.col("root").alias("subroot"),
        F.col("top").alias("root"), F.concat("path", "upper").alias("path"),
        *[F.col(f"carry.{c}") for c in extra])
