"""Dense row numbers in a total order without a single-partition window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqtally.operators._util import checkpointed


def with_index(df: DataFrame, order, name: str = "idx", start: int = 0) -> DataFrame:
    """``name`` = position of the row in ``order`` (0-based by default).

    The data is range-partitioned and sorted, checkpointed to the shared
    checkpoint folder (so both passes below see one fixed layout, and the
    lineage is cut), then numbered as partition offset + position in the
    partition.  Only one row per partition reaches the offset table."""
    s = (df.orderBy(*order)
         .withColumn("_pid", F.spark_partition_id())
         .withColumn("_mid", F.monotonically_increasing_id()))
    s = checkpointed(s)
    per = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    off = per.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return (s.join(F.broadcast(off), "_pid")
            .withColumn(name, F.col("_off") + local + F.lit(start))
            .drop("_pid", "_mid", "_off"))


def with_scan_index(scan: DataFrame, split, name: str = "idx", start: int = 0) -> DataFrame:
    """``name`` = position of the row in a file scan: by ``split`` (columns that
    name the scan's splits, in order: file and byte offset), then as the scan
    reads them.  No row is sorted, shuffled or stored.  A task numbers its rows as
    it reads them; one aggregate has each split's number of rows and its first
    number, and the prefix sums of the counts (a row per split) are joined back."""
    split = list(split)
    rows = scan.withColumn("_mid", F.monotonically_increasing_id())
    per = rows.groupBy(*split).agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    before = Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, -1)
    off = per.select(*split, (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_off"))
    return (rows.join(F.broadcast(off), split).withColumn(name, F.col("_off") + F.col("_mid") + F.lit(start))
            .drop("_mid", "_off"))


def occurrence(df: DataFrame, keys, order, name: str = "occ") -> DataFrame:
    """``name`` = 0, 1, 2, ... over the rows sharing ``keys``, in ``order``.

    No window per key (a key holding a third of the rows would land in one
    task): rows get a global position in (keys, order), the first position
    of each key comes from a partial aggregate, and the difference is the
    occurrence number.  The join back pairs each row with one row per key, so
    a hot key is split by AQE's skew handling, never multiplied."""
    keys, order = list(keys), list(order)
    g = with_index(df, keys + order, "_gidx")
    first = g.groupBy(*keys).agg(F.min("_gidx").alias("_first"))
    return (g.join(first, keys)
            .withColumn(name, F.col("_gidx") - F.col("_first"))
            .drop("_gidx", "_first"))
