"""Homopolymer test reads and their four-row library, as the reference's
load generator makes (made valid: every read has an ID)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqtally.schemas import BARCODES

# --- fixed values: generator nucleotides and library rows "A:A", "T:T", ... ---
NUCLEOTIDES = ["A", "T", "G", "C"]
# ------------------------------------------------------------------------------


def synthetic_library(spark: SparkSession, barcode_set: str = "synthetic") -> DataFrame:
    return spark.createDataFrame(
        [(barcode_set, i, n, n) for i, n in enumerate(NUCLEOTIDES)], BARCODES)


def synthetic_reads(spark: SparkSession, n_per_nucleotide: int, read_len: int = 300,
                    sample: str = "synthetic") -> DataFrame:
    """``4 * n_per_nucleotide`` reads: a block of poly-A, then T, G, C."""
    r = spark.range(4 * n_per_nucleotide)
    nt = F.element_at(F.array(*[F.lit(x) for x in NUCLEOTIDES]),
                      (F.floor(F.col("id") / n_per_nucleotide) + 1).cast("int"))
    return r.select(F.lit(sample).alias("sample"), F.col("id").alias("read_key"),
                    F.concat(F.lit("s"), F.col("id").cast("string")).alias("read_id"),
                    F.repeat(nt, read_len).alias("sequence"))
