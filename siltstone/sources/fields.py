"""JSON rows to columns without losing a value: fields in any case, fields nobody declared, values of another type.

A row is parsed once, to a map of texts. A column takes the values of all names that differ from its own in case only. What
finds no column, a second spelling with a value of its own, or a value that is not of the column's type, stays as JSON text
in the column ``UNFIT``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.operators.columns import quoted
from siltstone.schemas import RAW_SCHEMA, UNFIT
from siltstone.sources.listing import partition_values
from siltstone.sources.tables import append_batch

#: Columns of the layers themselves; a field of that name gets a column of another.
RESERVED = ("PAGE", "DTPROC", UNFIT, "period", "folder")
MAX_FIELDS = 1000


def _fold(spark: SparkSession, name: str) -> str:
    return name if spark.conf.get("spark.sql.caseSensitive", "false") == "true" else name.lower()


def note_fields(names: DataFrame, stamp: str, raw_root: str) -> None:
    """Write the distinct ``field`` names of a landing beside its folders, under the run's stamp."""
    rows = names.select("field").distinct().withColumn("stamp", F.lit(stamp))
    append_batch(rows, f"{raw_root.rstrip('/')}_fields", "stamp")


def noted_fields(spark: SparkSession, raw_root: str, most: int = MAX_FIELDS) -> list[str]:
    """Field names that landings have noted, the earliest first, of one landing lower case before upper.

    At most ``most`` of them: they become columns. Values of any further field stay in ``UNFIT``.
    """
    path = f"{raw_root.rstrip('/')}_fields"
    if not partition_values(spark, path, "stamp"):
        return []
    notes = spark.read.schema("field string, stamp string").parquet(path)
    first = notes.groupBy("field").agg(F.min("stamp").alias("first"))
    first = first.orderBy("first", F.lower("field"), F.desc("field")).limit(most)
    return [r["field"] for r in first.collect()]


def row_schema(spark: SparkSession, noted: Iterable[str], declared: T.StructType = RAW_SCHEMA) -> T.StructType:
    """The declared columns and, as text, one for every other noted name; spellings of a name share a column."""
    fields = list(declared.fields)
    known = {_fold(spark, f.name) for f in fields} - {_fold(spark, r) for r in RESERVED}
    reserved = {_fold(spark, r) for r in RESERVED}
    for name in noted:
        if _fold(spark, name) not in known:
            known.add(_fold(spark, name))
            column = f"item_{name}" if _fold(spark, name) in reserved else name
            fields.append(T.StructField(column, T.StringType()))
    return T.StructType(fields)


def record_columns(spark: SparkSession, lines: DataFrame, schema: T.StructType, *carry: str) -> DataFrame:
    """Columns of ``schema``, ``UNFIT`` and ``carry`` from the JSON text in ``value``.

    ``PAGE`` is the last key of that name, which the landing appends to an item's own. Rows whose keys are
    exactly the columns' names take a short way: one look into the map for each column.
    """
    # As SQL text, which the session parses at once: there are several expressions for every column.
    fold = (lambda text: f"lower({text})") if _fold(spark, "A") == "a" else (lambda text: text)
    reserved = {_fold(spark, r) for r in RESERVED}
    items = [f for f in schema.fields if f.name != "PAGE"]
    bare = [f.name.removeprefix("item_") for f in items]
    source = [b if _fold(spark, b) in reserved else f.name for b, f in zip(bare, items)]
    plain = ["PAGE", *(n for n, f in zip(source, items) if n == f.name)]

    def look(field: T.StructField, name: str) -> str:
        """The exact name's first value, else that of another spelling."""
        first = "try_element_at(filter(rest, e -> {} AND e.value IS NOT NULL), 1).value"
        exact, same = f"e.key = {_literal(name)}", f"{fold('e.key')} = {_literal(_fold(spark, name))}"
        usual = f"m[{_literal(name)}]" if name == field.name else "CAST(NULL AS string)"
        return f"CASE WHEN odd THEN coalesce({first.format(exact)}, {first.format(same)}) ELSE {usual} END"

    rows = lines.filter(F.trim("value") != "").select(F.expr("from_json(value, 'map<string,string>')").alias("m"), "value", *carry)
    rows = rows.selectExpr(
        "*", f"size(array_except(map_keys(m), array({', '.join(map(_literal, plain))}))) > 0 "
        "OR size(map_keys(m)) != size(array_distinct(map_keys(m))) AS odd")
    # The last key of that name is the landing's own.
    rows = rows.selectExpr(
        "*", "CASE WHEN odd THEN filter(map_entries(m), (e, i) -> i + array_position(reverse(map_keys(m)), 'PAGE') != size(m)) END AS rest",
        "CASE WHEN odd THEN try_element_at(filter(map_entries(m), e -> e.key = 'PAGE'), -1).value ELSE m['PAGE'] END AS page")
    rows = rows.selectExpr("*", *[f"{look(f, n)} AS c{i}" for i, (f, n) in enumerate(zip(items, source))])
    strict = [(i, f) for i, f in enumerate(items) if not isinstance(f.dataType, T.StringType)]
    typed = {f.name: f"try_cast(c{i} AS {f.dataType.simpleString()})" for i, f in strict}
    misfit = " OR ".join(f"(c{i} IS NOT NULL AND {typed[f.name]} IS NULL)" for i, f in strict) or "false"
    # A text counts as held when its column has a value.
    held = ", ".join(
        f"{_literal(_fold(spark, n))}, " + (f"IF({typed[f.name]} IS NULL, NULL, c{i})" if f.name in typed else f"c{i}")
        for i, (f, n) in enumerate(zip(items, source)))
    rows = rows.selectExpr("*", f"CASE WHEN odd OR {misfit} THEN map({held}) END AS held")
    left = f"map_filter(m, (k, v) -> v IS NOT NULL AND NOT (k = 'PAGE' AND v <=> page) AND NOT (v <=> try_element_at(held, {fold('k')})))"
    unfit = f"CASE WHEN m IS NULL THEN value WHEN held IS NOT NULL AND size({left}) > 0 THEN to_json({left}) END AS {UNFIT}"
    by_name = {f.name: f"{typed.get(f.name, f'c{i}')} AS {quoted(f.name)}" for i, f in enumerate(items)}
    return rows.selectExpr(*[by_name.get(n, f"page AS {n}") for n in schema.names], unfit, *map(quoted, carry))


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
