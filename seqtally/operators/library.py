"""Barcode library preparation (upper-case, keep first of duplicates)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqtally.operators._util import checkpointed


def normalize_barcodes(lib: DataFrame) -> DataFrame:
    """Upper-case every barcode (reads are not upper-cased)."""
    return lib.withColumn("barcode", F.upper("barcode"))


def dedup_barcodes(lib: DataFrame) -> DataFrame:
    """Keep the first row (smallest ``ord``) of every barcode within its
    barcode set.  Aggregation with a partial (map-side) step, so a barcode
    repeated many times does not gather its rows in one task."""
    first = F.min(F.struct("ord", "gene")).alias("first")
    return (lib.groupBy("barcode_set", "barcode").agg(first)
            .select("barcode_set", F.col("first.ord").alias("ord"),
                    F.col("first.gene").alias("gene"), "barcode"))


def prepare_library(lib: DataFrame) -> DataFrame:
    """Upper-case first, then keep the first row of each barcode.  Empty or
    NULL barcodes are rejected: they would match every read.

    The prepared library is small and read by several jobs (profile, index
    broadcast, zero-fill), so it is checkpointed to the shared checkpoint
    folder once; that also cuts its lineage."""
    lib = checkpointed(dedup_barcodes(normalize_barcodes(lib)))
    if lib.filter(F.col("barcode").isNull() | (F.length("barcode") == 0)).limit(1).count():
        raise ValueError("barcode library contains empty barcodes")
    return lib


def is_unique(df: DataFrame, col: str) -> DataFrame:
    """One row: number of non-null values, number of distinct values, and
    whether the column is free of duplicates."""
    return (df.agg(F.count(col).alias("n_values"),
                   F.count_distinct(col).alias("n_distinct"))
            .withColumn("is_unique", F.col("n_values") == F.col("n_distinct")))
