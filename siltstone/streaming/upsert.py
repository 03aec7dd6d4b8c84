"""Stream to table: the newest row per key of batch and table, upserted."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from siltstone.operators.columns import conform
from siltstone.operators.latest import latest_per_key
from siltstone.operators.merge import split_null_keys
from siltstone.scratch import materialize
from siltstone.sources.tables import ensure_table, save_merged


def upsert_stream(
    stream: DataFrame,
    name: str,
    path: str,
    schema: T.StructType,
    keys: Sequence[str],
    order: Callable[[DataFrame], list[Column]],
    checkpoint: str,
    partition: str = "dt",
) -> StreamingQuery:
    """Upsert all available rows of ``stream``, then stop.

    Rows compete under ``order`` with the table's row of the same key, so a late row does not replace a newer
    one. A replayed micro-batch upserts the same rows on the same keys again; rows without a key
    match nothing and are added again.
    """

    def upsert(batch: DataFrame, batch_id: int) -> None:
        table = ensure_table(batch.sparkSession, name, path, schema, partition)
        batch = materialize(conform(batch, table.schema), "batch")
        keyed, keyless = split_null_keys(batch, keys)
        held = table.join(keyed.select(*keys).distinct(), list(keys), "left_semi")
        rivals = keyed.unionByName(conform(held, batch.schema))
        newest = latest_per_key(rivals, keys, order(rivals)).unionByName(keyless)
        save_merged(newest, name, path, schema, keys, partition, unique_source=True)
        # The caller's session may have listed the folders that were exchanged.
        stream.sparkSession.catalog.refreshTable(name)

    return (
        stream.writeStream.foreachBatch(upsert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
