"""Physical layout: hash repartitioning and caller-controlled caching."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def repartition_by(df: DataFrame, *cols: str, num_partitions: int | None = None,
                   split_hot_keys: bool = True) -> DataFrame:
    """Cluster rows by ``cols`` (every row kept).

    With ``split_hot_keys`` (default) this is a REBALANCE by the columns:
    rows are hash-clustered like ``repartition(cols)``, small partitions are
    coalesced and a partition holding a hot key (say a third of all rows) is
    split by AQE instead of landing in one task.  ``split_hot_keys=False``
    gives the strict hash layout a later co-partitioned join can rely on."""
    if split_hot_keys:
        return df.hint("rebalance", *cols)
    if num_partitions:
        return df.repartition(num_partitions, *cols)
    return df.repartition(*cols)


@contextmanager
def persisted(*frames: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Keep frames reused by several queries materialised for the block.

    Operators never cache by themselves; the caller decides what is reused.
    Cached blocks lost with an executor are recomputed from lineage."""
    for f in frames:
        f.persist(level)
    try:
        yield frames
    finally:
        for f in frames:
            f.unpersist()


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet at ``path``, bucketed by ``key``, and read it back.

    Tables written with equal ``buckets`` (the session's shuffle partitions by
    default) join, and aggregate, on the key without a shuffle.  One task writes
    one bucket's file.  Null keys join nothing and may be many: they are dealt
    over all tasks by a hash of the other columns.  The table's name is dropped
    from the session's catalog at once; the files stay."""
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rest = [c for c in df.columns if c != key]
    spread = F.pmod(F.xxhash64(*rest), F.lit(n)).cast(df.schema[key].dataType)
    name = f"tillwise_{uuid.uuid4().hex}"
    (df.repartition(n, F.coalesce(F.col(key), spread)).write.bucketBy(n, key)
       .option("path", path).saveAsTable(name))
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table
