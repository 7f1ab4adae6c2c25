"""The counting plan end to end: reads + library (+ manifest) -> zero-filled
counts with RPM and read statistics of all samples, from one pass over the
reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqtally.operators._util import staged
from seqtally.operators.counts import count_matched, read_stats, rpm, run_pairs, zero_fill
from seqtally.operators.match import match_counts


def tally(reads: DataFrame, library: DataFrame, manifest: DataFrame | None = None,
          every: bool = False, ignore_case: bool = False) -> DataFrame:
    """The staged count table of one matching pass (sample, barcode_set, ord,
    read_counts; NULL set and ord: the sample's reads).  It has at most as many
    rows as the runs have library rows, however many reads there are."""
    matched = match_counts(reads, library, manifest, every, ignore_case=ignore_case)
    return staged(count_matched(matched), "tally")


def counts_of(counted: DataFrame, library: DataFrame, manifest: DataFrame | None = None,
              barcode_set: str | None = None) -> DataFrame:
    """Zero-filled counts with RPM from a staged count table."""
    pairs = run_pairs(counted, library, manifest, barcode_set)
    return rpm(zero_fill(counted, library, pairs), counted)


def stats_of(counted: DataFrame, library: DataFrame, manifest: DataFrame | None = None,
             barcode_set: str | None = None) -> DataFrame:
    """Read statistics from a staged count table."""
    return read_stats(counted, run_pairs(counted, library, manifest, barcode_set))


def barcode_counts(reads: DataFrame, library: DataFrame,
                   manifest: DataFrame | None = None,
                   barcode_set: str | None = None) -> DataFrame:
    """sample, barcode_set, ord, gene, barcode, read_counts, rpm.

    ``library`` must already be prepared (upper-case, deduplicated).  With a
    manifest each sample is matched against the set(s) it lists, and RPM is
    within each (sample, barcode_set).  Without one every sample is matched
    against ``barcode_set`` (or the only set of the library)."""
    return counts_of(tally(reads, library, manifest), library, manifest, barcode_set)


def barcode_stats(reads: DataFrame, library: DataFrame,
                  manifest: DataFrame | None = None,
                  barcode_set: str | None = None) -> DataFrame:
    """Total reads, detected reads and detection rate per sample and barcode
    set, in one pass over the reads."""
    return stats_of(tally(reads, library, manifest), library, manifest, barcode_set)


def counts_columns(counts: DataFrame) -> DataFrame:
    """The reference's result columns (plus the sample)."""
    return counts.select("sample", "gene", "barcode", "read_counts",
                         F.col("rpm").cast("double").alias("rpm"))
