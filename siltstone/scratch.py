"""Where a run may put intermediate tables: the shared folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a new /tmp folder only on a local master."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = spark.conf.get("spark.app.id")
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="siltstone-", dir="/tmp")
    return _local_roots[app]


def new_folder(spark: SparkSession, label: str) -> str:
    """A folder name nobody has used; Spark creates it on first write."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, label: str, split_by: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back.

    The result has no lineage beyond its files, and Catalyst knows its true size, so a
    later join broadcasts it only when it is below the session's broadcast threshold.
    ``split_by`` stores the rows by that column, in files of the advisory size.
    """
    path = new_folder(df.sparkSession, label)
    if split_by is None:
        df.write.parquet(path)
    else:
        df.hint("rebalance", split_by).write.partitionBy(split_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
