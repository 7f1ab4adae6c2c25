"""Small planning helpers shared by the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A side is broadcast only when its measured size is within this bound.
BROADCAST_BYTES = 256 << 20
# What a row of a hashed relation costs beside its text.
ROW_BYTES = 80


def checkpointed(df: DataFrame) -> DataFrame:
    """Eager checkpoint into the shared folder named by ``spark.checkpoint.dir``
    (registered on the context first if needed).  Used for small tables that
    several jobs read; cuts their lineage, survives executor loss."""
    from seqtally.session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read again: for
    results of a pass over the reads that several outputs are made from."""
    from seqtally.session import scratch_path
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def size_bytes(df: DataFrame) -> int:
    """Estimated size of ``df`` as a hashed relation: one aggregate over its
    rows (a row per task is shuffled)."""
    text = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema
            if f.dataType.simpleString() in ("string", "binary")]
    row = reduce(lambda a, b: a + b, text, F.lit(ROW_BYTES + 8 * len(df.columns)))
    return int(df.agg(F.sum(row.cast("long"))).first()[0] or 0)


def broadcast_if_small(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Broadcast hint behind a measured size (default bound:
    ``BROADCAST_BYTES``); otherwise leave the join to the planner
    (shuffled hash / sort-merge join, AQE may still broadcast)."""
    bound = BROADCAST_BYTES if max_bytes is None else max_bytes
    return F.broadcast(df) if size_bytes(df) <= bound else df


def spread(df: DataFrame) -> DataFrame:
    """Round-robin a scan that yields fewer partitions than the cluster has
    cores (one small file = one split).  A large input already has many
    splits and is left untouched, so no shuffle is added at scale."""
    sc = df.sparkSession.sparkContext
    target = sc.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df
