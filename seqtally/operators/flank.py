"""Unknown barcodes between constant flanks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqtally.functions.sequence import (DOWNSTREAM_FLANK, FLANK_GAP,
                                         UPSTREAM_FLANK, extract_between)


def extract_barcodes(reads: DataFrame, up: str = UPSTREAM_FLANK,
                     down: str = DOWNSTREAM_FLANK, n: int = FLANK_GAP,
                     col: str = "sequence") -> DataFrame:
    return reads.withColumn("barcode", extract_between(col, up, down, n))


def flank_stats(extracted: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Total reads, reads with a flank match, and their ratio."""
    g = extracted.groupBy(*by) if by else extracted.groupBy()
    out = g.agg(F.count(F.lit(1)).alias("total_reads"),
                F.count("barcode").alias("detected_reads"))
    rate = F.when(F.col("total_reads") > 0,
                  F.col("detected_reads").cast("double") / F.col("total_reads").cast("double"))
    return out.withColumn("detection_rate", rate)


def distinct_barcodes(extracted: DataFrame) -> DataFrame:
    """Distinct extracted barcodes, case-sensitive, NULL dropped."""
    return extracted.select("barcode").dropna().distinct()


def extract_from_lines(lines: DataFrame, up: str = UPSTREAM_FLANK,
                       down: str = DOWNSTREAM_FLANK, n: int = FLANK_GAP,
                       col: str = "value") -> DataFrame:
    """The reference's text-line mode: keep lines that start like a sequence
    (A/T/G/C/a/t/g/c/N; quality lines starting with those letters count too)
    and extract from each.  ``extract_barcodes`` on parsed records is the
    default; this reproduces the line-based statistics exactly."""
    from seqtally.functions.sequence import is_sequence_line
    return (lines.filter(is_sequence_line(col))
            .withColumn("barcode", extract_between(col, up, down, n)))
