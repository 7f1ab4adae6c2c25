"""Session construction and cluster-shared scratch locations."""

from __future__ import annotations

import itertools
import math
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of the library relies on.  They are only applied when the
# caller builds the session through ``get_spark``; an existing cluster session
# keeps its own values.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(app: str = "seqtally", master: str | None = None,
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def scale_conf(input_bytes: int, cores: int, read_bytes: int = 300,
               shuffle_row_bytes: int = 40, split_bytes: int = 256 << 20,
               shuffle_partition_bytes: int = 128 << 20) -> dict:
    """Settings for one run over ``input_bytes`` of reads on ``cores`` cores.

    * input splits of ``split_bytes`` (the reference's 256 MB text blocks):
      a task holds one split's reads in its per-read partial aggregate,
      about split_bytes / read_bytes entries (~0.9M for 256 MB), so it fits
      in a few hundred MB of executor memory;
    * the matching shuffles at most one small row (sample, read key, barcode
      set, ord: ~``shuffle_row_bytes``) per read, so shuffle partitions are
      sized for ~``shuffle_partition_bytes`` each, never fewer than 2x cores;
      AQE coalesces them when fewer reads match and splits skewed ones.

    For 100 TB of 300-byte reads this gives 256 MB splits (~400k tasks) and
    ~100k shuffle partitions for the ~13 TB worst-case hit shuffle."""
    reads = max(1, input_bytes // read_bytes)
    shuffle_parts = max(2 * cores, math.ceil(reads * shuffle_row_bytes / shuffle_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.shuffle.partitions": str(shuffle_parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(shuffle_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and staged tables.

    The cluster names it in ``spark.checkpoint.dir`` (or on the context).  A
    private folder is made only on a local master, where driver and executors
    are one process; anywhere else a missing setting is an error, since other
    machines would not see the driver's folder.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        # registered on the context only (the setting itself is static)
        d = tempfile.mkdtemp(prefix="seqtally-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


_run = f"{os.getpid()}-{uuid.uuid4().hex[:8]}"
_counter = itertools.count(1)


def scratch_root(spark: SparkSession) -> str:
    """This process's folder of staged tables."""
    return f"{checkpoint_dir(spark).rstrip('/')}/seqtally-stage/{_run}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder for a staged table."""
    return f"{scratch_root(spark)}/{name}-{next(_counter)}"


def remove_staged(spark: SparkSession) -> None:
    """Delete the tables this process staged.  Results are lazy and read them,
    so call it when no result is needed any more (end of a run)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
