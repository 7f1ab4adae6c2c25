"""Files in the cluster's shared folder, written and read inside tasks.

A task writes under a name of its own (stage attempt included) and returns the
name; only the names in the table written by Spark from the successful attempts
count, so a lost executor or a speculative copy leaves nothing that is read."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def filesystem(uri: str):
    """(pyarrow file system, path in it) of a folder or file URI."""
    from pyarrow import fs
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    if "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


def own_name(prefix: str, suffix: str) -> str:
    """A file name that no other task attempt uses."""
    return f"{prefix}-{uuid.uuid4().hex}{suffix}"


def free_name(name: str, taken) -> str:
    """``name``, longer by underscores until no column is called so."""
    while name in taken:
        name += "_"
    return name


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read again:
    cuts the lineage with files that survive a lost executor."""
    from seqtally.session import scratch_path
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh shared folder for a query's files; made by its first writer."""
    from seqtally.session import scratch_path
    path = scratch_path(spark, name)
    fs, inner = filesystem(path)
    fs.create_dir(inner, recursive=True)
    return path


def staged_buckets(df: DataFrame, name: str, column: str, buckets: int) -> DataFrame:
    """``df`` written once to the shared folder, bucketed and sorted by
    ``column``.  Later joins and groups on ``column`` leave these rows where
    they are and shuffle only the other side.  The catalog's entry, which writing
    buckets needs, is dropped again; the files and what reads them stay."""
    from seqtally.session import scratch_path
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}".replace("-", "_")
    (df.write.bucketBy(buckets, column).sortBy(column).option("compression", "zstd")
     .option("path", scratch_path(spark, name)).saveAsTable(table))
    out = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return out


def bucket_count(df: DataFrame) -> int:
    """Buckets for a table made from ``df`` without a shuffle: as many as it has
    partitions, and no fewer than a shuffle has, up to the most that Spark takes;
    beyond, a bucket holds the rows of several partitions."""
    conf = df.sparkSession.conf
    return min(max(df.rdd.getNumPartitions(), int(conf.get("spark.sql.shuffle.partitions"))),
               int(conf.get("spark.sql.sources.bucketing.maxBuckets")))
