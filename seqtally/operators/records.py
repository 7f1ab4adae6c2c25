"""Record-level operators: FASTQ validation, line grep, stacking tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqtally.functions.sequence import valid_fastq_record

MODES = ("FAILFAST", "DROP", "FLAG")


def validate_fastq(records: DataFrame, mode: str = "FAILFAST", max_qual: int = 62) -> DataFrame:
    """Structural FASTQ check ('@' header, '+' spacer, equal sequence and
    quality lengths, Phred+33 qualities 0..``max_qual``).

    FAILFAST: the job fails at the first bad record (``raise_error`` inside
    the plan, no separate pass); DROP: bad records are removed; FLAG: a
    boolean ``is_valid`` column is added."""
    mode = mode.upper()
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    ok = valid_fastq_record("header", "sequence", "spacer", "quality")
    if max_qual != 62:
        ok = ok & F.col("quality").rlike(r"^[\x21-\x%02x]*$" % (33 + max_qual))
    if mode == "FLAG":
        return records.withColumn("is_valid", ok)
    if mode == "DROP":
        return records.filter(ok)
    msg = F.concat(F.lit("malformed FASTQ record: "), F.coalesce(F.col("header"), F.lit("<null>")))
    return records.filter(F.when(ok, F.lit(True)).otherwise(F.raise_error(msg).cast("boolean")))


def grep(lines: DataFrame, pattern: str, col: str = "value") -> DataFrame:
    """Lines matching a regular expression anywhere in the line."""
    return lines.filter(F.col(col).rlike(pattern))


def union_counts(*tables: DataFrame) -> DataFrame:
    """Row-wise stack of count tables with the same columns (by name)."""
    return reduce(lambda a, b: a.unionByName(b), tables)


def sample_counts(manifest: DataFrame, inputs: DataFrame) -> DataFrame:
    """One row: manifest rows, distinct manifest samples, input folders; the
    reference compares the first and the last before running.  One aggregate
    over both tables."""
    listed = F.col("side") == "manifest"
    both = (manifest.select("sample", F.lit("manifest").alias("side"))
            .unionByName(inputs.select("sample", F.lit("input").alias("side"))))
    per = both.groupBy("side", "sample").agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.coalesce(F.sum(F.when(listed, F.col("n"))), F.lit(0)).cast("long").alias("manifest_rows"),
                   F.count(F.when(listed, F.col("sample"))).alias("manifest_samples"),
                   F.count(F.when(~listed, F.col("sample"))).alias("input_folders"))
