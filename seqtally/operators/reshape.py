"""Row routing: length windows, sample relabelling, mate pairing and the
manifest/input reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqtally.operators._util import broadcast_if_small
from seqtally.schemas import WINDOWS

# --- fixed values: the reference's fragment lengths and tolerance ------------
FRAGMENT_LENGTHS = [("F1", 278), ("F2", 268), ("F3", 194)]
LENGTH_TOLERANCE = 1
# ------------------------------------------------------------------------------


def length_windows(spark: SparkSession, windows=FRAGMENT_LENGTHS,
                   tolerance: int = LENGTH_TOLERANCE) -> DataFrame:
    return spark.createDataFrame([(f, int(t), int(tolerance)) for f, t in windows], WINDOWS)


def split_by_length(reads: DataFrame, windows=None,
                    tolerance: int = LENGTH_TOLERANCE) -> DataFrame:
    """A read goes to every window with target-tol <= length <= target+tol;
    other reads are dropped.  The range condition becomes an equi-join: each
    window is expanded to its admissible lengths (a few rows per window) and
    joined on the read length, so the plan is a broadcast hash join instead of
    a nested loop over windows.  ``windows`` is a DataFrame (fragment,
    target_len, tolerance) or a list of (fragment, target_len) pairs."""
    if windows is None or isinstance(windows, (list, tuple)):
        windows = length_windows(reads.sparkSession, windows or FRAGMENT_LENGTHS, tolerance)
    lens = windows.select(
        "fragment",
        F.explode(F.sequence(F.col("target_len") - F.col("tolerance"),
                             F.col("target_len") + F.col("tolerance"))).alias("_len"))
    lens = broadcast_if_small(lens)
    return (reads.join(lens, F.length(reads["sequence"]) == lens["_len"], "inner")
            .drop("_len"))


def relabel_samples(reads: DataFrame, routing: DataFrame,
                    on: tuple[str, ...] = ("source", "fragment")) -> DataFrame:
    """Rename (source, fragment) groups to sample names through a lookup
    table; unrouted rows are dropped, as files that are never moved."""
    r = broadcast_if_small(routing.select(*on, F.col("sample").alias("_new")))
    out = reads.join(r, list(on), "inner")
    if "sample" in reads.columns:
        out = out.drop("sample")
    return out.withColumnRenamed("_new", "sample")


def pair_mates(r1: DataFrame, r2: DataFrame, key: tuple[str, ...] = ("sample", "read_id"),
               fields: tuple[str, ...] = ("sequence",), by_occurrence: bool = False,
               order: tuple[str, ...] = ("read_key",)) -> DataFrame:
    """Forward and reverse reads of the same fragment: one join on the read ID.

    IDs are unique in a sequencer's file.  Where they may repeat, say
    ``by_occurrence=True``: the k-th occurrence of an ID in R1 (in ``order``,
    file position by default) pairs with its k-th occurrence in R2, so a
    repeated ID never produces all pairs."""
    on = list(key)
    if by_occurrence:
        from seqtally.operators.index import occurrence
        r1, r2 = occurrence(r1, key, order), occurrence(r2, key, order)
        on.append("occ")
    a = r1.select(*on, *[F.col(f).alias(f"{f}_1") for f in fields])
    b = r2.select(*on, *[F.col(f).alias(f"{f}_2") for f in fields])
    return a.join(b, on, "inner").select(*key, *[f"{f}_{i}" for i in (1, 2) for f in fields])


def orphan_mates(r1: DataFrame, r2: DataFrame,
                 key: tuple[str, ...] = ("sample", "read_id")) -> DataFrame:
    """Reads whose mate is missing, with the side (R1/R2) they come from: each
    side is read once, and one aggregate with a partial step tells what sides
    an ID has.  An ID that repeats on its side is listed as often."""
    both = (r1.select(*key, F.lit(1).alias("_side"))
            .unionByName(r2.select(*key, F.lit(2).alias("_side"))))
    sides = both.groupBy(*key).agg(F.count_if(F.col("_side") == 1).alias("_n1"),
                                   F.count_if(F.col("_side") == 2).alias("_n2"))
    alone = sides.filter((F.col("_n1") == 0) | (F.col("_n2") == 0))
    copies = F.explode(F.sequence(F.lit(1), F.greatest("_n1", "_n2"))).alias("_copy")
    return (alone.select(*key, F.when(F.col("_n2") == 0, "R1").otherwise("R2").alias("side"), copies)
            .drop("_copy"))


def reconcile_samples(manifest: DataFrame, inputs: DataFrame) -> DataFrame:
    """Names listed in the manifest without input folder, and input folders
    not in the manifest (a true two-way difference of names)."""
    m = manifest.select("sample").distinct()
    i = inputs.select("sample").distinct()
    return (m.join(i, "sample", "left_anti").withColumn("side", F.lit("manifest_only"))
            .unionByName(i.join(m, "sample", "left_anti")
                         .withColumn("side", F.lit("input_only"))))


def reverse_complement_reads(reads: DataFrame, reverse_quality: bool = False) -> DataFrame:
    """Reverse-complement the sequence of every read.  The reference leaves
    the quality string as it was; ``reverse_quality=True`` reverses it so it
    stays aligned with the bases."""
    from seqtally.functions.sequence import reverse_complement
    out = reads.withColumn("sequence", reverse_complement("sequence"))
    if reverse_quality and "quality" in reads.columns:
        out = out.withColumn("quality", F.reverse("quality"))
    return out
