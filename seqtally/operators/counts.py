"""Count tables: reads per barcode, zero-fill, RPM, statistics, per-chunk ID
lists and the operators of the multiple-detection report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqtally.operators._util import broadcast_if_small
from seqtally.operators.match import manifest_pairs

# The reference processes reads in chunks of this many records by default
# (10,000 is its advice for files under 1 GB).
CHUNK_READS = 100_000


def _ratio(num, den, scale: float = 1.0):
    """num / den * scale as double, 0 when den is 0 (same operation order in
    the SQL oracles, so the doubles are bit-equal)."""
    q = F.col(num).cast("double") / F.col(den).cast("double")
    if scale != 1.0:
        q = q * F.lit(scale)
    return F.when(F.col(den) > 0, q).otherwise(F.lit(0.0))


def count_hits(hits: DataFrame) -> DataFrame:
    """Assigned reads per (sample, barcode_set, ord); partial aggregation
    happens before the shuffle, so a barcode that collects a third of all
    reads costs one row per map task."""
    return (hits.groupBy("sample", "barcode_set", "ord")
            .agg(F.count(F.lit(1)).alias("read_counts")))


def count_matched(matched: DataFrame) -> DataFrame:
    """``match.matched_reads`` or ``match.match_counts`` as a count table: sample,
    barcode_set, ord, read_counts; rows with NULL barcode_set and ord are the
    samples' totals.  Stage it: zero-fill, RPM and statistics are all made from it."""
    return (matched.groupBy("sample", "barcode_set", "ord")
            .agg(F.sum("n").cast("long").alias("read_counts")))


def run_pairs(tally: DataFrame, library: DataFrame, manifest: DataFrame | None = None,
              barcode_set: str | None = None) -> DataFrame:
    """(sample, barcode_set) of a run: the manifest's, or every sample that has
    reads with ``barcode_set``, or with the only set of the library.  Samples
    come from the totals of ``count_matched``, not from a scan of the reads."""
    if manifest is not None:
        return manifest_pairs(manifest)
    if barcode_set is None:
        sets = [r.barcode_set for r in library.select("barcode_set").distinct().limit(2).collect()]
        if len(sets) != 1:
            raise ValueError("the library has several barcode sets: name one or give a manifest")
        barcode_set = sets[0]
    # a value of each row: a constant would turn the join with the library into
    # a nested loop
    own = F.substr(F.concat(F.lit(barcode_set), F.coalesce("sample", F.lit(""))), F.lit(1), F.lit(len(barcode_set)))
    return tally.filter("barcode_set IS NULL").select("sample").distinct().withColumn("barcode_set", own)


def zero_fill(counts: DataFrame, library: DataFrame, pairs: DataFrame) -> DataFrame:
    """Every library row of every (sample, barcode_set) of ``pairs``, with
    count 0 where no read was assigned: |library rows of the set| x |samples
    of the set| rows."""
    grid = pairs.select("sample", "barcode_set").join(
        library.select("barcode_set", "ord", "gene", "barcode"), "barcode_set")
    return (grid.join(counts, ["sample", "barcode_set", "ord"], "left")
            .select("sample", "barcode_set", "ord", "gene", "barcode",
                    F.coalesce(F.col("read_counts"), F.lit(0)).cast("long")
                    .alias("read_counts")))


def rpm(counts: DataFrame, tally: DataFrame | None = None) -> DataFrame:
    """Reads per million: count / (assigned reads of the run) * 1e6, a run
    being a (sample, barcode_set); 0 for a run without any assigned read.

    The totals are an aggregate of ``tally`` (a staged count table; default:
    ``counts`` itself) with a partial step, joined back by run: one row per
    run is broadcast behind a size check, and no run's rows meet in one task."""
    source = counts if tally is None else tally
    total = (source.filter("barcode_set IS NOT NULL").groupBy("sample", "barcode_set")
             .agg(F.sum("read_counts").alias("_tot")))
    total = broadcast_if_small(total) if tally is not None else total
    return (counts.join(total, ["sample", "barcode_set"], "left")
            .withColumn("_tot", F.coalesce("_tot", F.lit(0)))
            .withColumn("rpm", _ratio("read_counts", "_tot", 1e6)).drop("_tot"))


def read_stats(tally: DataFrame, pairs: DataFrame) -> DataFrame:
    """Total reads, detected (assigned) reads and detection rate of every
    (sample, barcode_set) of ``pairs``, from a count table with totals
    (``count_matched``).  A sample without reads has 0 and 0, a set that the
    library lacks 0 detected; the rate is NULL for an empty pool."""
    total = tally.filter("barcode_set IS NULL").select("sample", F.col("read_counts").alias("_total"))
    found = (tally.filter("barcode_set IS NOT NULL").groupBy("sample", "barcode_set")
             .agg(F.sum("read_counts").alias("_found")))
    rate = F.when(F.col("total_reads") > 0,
                  F.col("detected_reads").cast("double") / F.col("total_reads").cast("double"))
    return (pairs.select("sample", "barcode_set").join(total, "sample", "left")
            .join(found, ["sample", "barcode_set"], "left")
            .select("sample", "barcode_set", F.coalesce("_total", F.lit(0)).cast("long").alias("total_reads"),
                    F.coalesce("_found", F.lit(0)).cast("long").alias("detected_reads"))
            .withColumn("detection_rate", rate))


def with_genes(counts: DataFrame, library: DataFrame) -> DataFrame:
    """Attach gene and barcode text to (barcode_set, ord) keyed rows; the
    library side is broadcast behind a size check, so the (possibly large)
    count rows are not shuffled for it."""
    lib = broadcast_if_small(library.select("barcode_set", "ord", "gene", "barcode"))
    return counts.join(lib, ["barcode_set", "ord"])


def chunk_counts(hits: DataFrame, library: DataFrame, chunk_reads: int = CHUNK_READS,
                 chunk: Column | None = None) -> DataFrame:
    """Per chunk of reads and barcode: count and sorted list of assigned read
    IDs, as the reference's per-chunk result files.  The chunk is ``read_key
    div chunk_reads`` unless another column says it (reads from files: their
    place in the file).  A group holds at most one chunk's IDs, whatever the
    skew of barcodes, so no list grows with the data."""
    number = F.expr(f"read_key div {int(chunk_reads)}") if chunk is None else chunk
    g = (hits.withColumn("chunk", number.cast("long"))
         .groupBy("sample", "barcode_set", "chunk", "ord")
         .agg(F.count(F.lit(1)).alias("read_counts"),
              F.array_sort(F.collect_list("read_id")).alias("ids")))
    return with_genes(g, library).select(
        "sample", "barcode_set", "chunk", "ord", "gene", "barcode", "read_counts", "ids")


def merge_counts(chunks: DataFrame) -> DataFrame:
    """Sum chunk tables by (sample, gene, barcode)."""
    return (chunks.groupBy("sample", "gene", "barcode")
            .agg(F.sum("read_counts").cast("long").alias("read_counts"),
                 F.count(F.lit(1)).alias("n_chunks")))


def ids_by_barcode(hits: DataFrame, library: DataFrame) -> DataFrame:
    """Classification list: one row per assigned read with its barcode; a join
    of the hits with the library, no lists in between."""
    return with_genes(hits, library).select("sample", "read_id", "gene", "barcode")


def fractional_counts(hits: DataFrame, library: DataFrame) -> DataFrame:
    """Each row's count shared over its IDs.  A chunk row has as many IDs as
    its count, so every assigned read has the share 1."""
    return with_genes(hits, library).select("sample", "gene", "barcode", "read_id", F.lit(1.0).alias("share"))


def count_barcodes_per_read(hits_all: DataFrame) -> DataFrame:
    """Multiple-detection report: number of barcodes found per read ID, from
    ``match.match_all`` or its numbers (``match.match_numbers``)."""
    n = F.sum("n") if "n" in hits_all.columns else F.count(F.lit(1))
    return hits_all.groupBy("sample", "read_id").agg(n.cast("long").alias("n_barcodes"))


def count_lines_matching(lines: DataFrame, library: DataFrame, key: str = "line_key") -> DataFrame:
    """Lines containing each barcode (a line counts for every barcode it
    contains), zero-filled over the library: the intended meaning of the
    reference's grep | wc -l prototype."""
    from seqtally.operators.match import match_counts
    reads = lines.select(F.lit("lines").alias("sample"), F.col(key).alias("read_key"),
                         F.col("value").alias("sequence"))
    hits = match_counts(reads, library, every=True).filter("ord IS NOT NULL")
    n = hits.groupBy("barcode_set", "ord").agg(F.sum("n").alias("n_lines"))
    return (library.select("barcode_set", "ord", "gene", "barcode")
            .join(n, ["barcode_set", "ord"], "left")
            .select("gene", "barcode",
                    F.coalesce(F.col("n_lines"), F.lit(0)).cast("long").alias("n_lines")))


def top_barcodes(counts: DataFrame, n: int) -> DataFrame:
    """The ``n`` largest counts, ties broken by sample, gene, barcode
    (TakeOrderedAndProject: each task keeps n rows)."""
    return counts.orderBy(F.desc("read_counts"), "sample", "gene", "barcode").limit(n)


def head(df: DataFrame, n: int, order: list) -> DataFrame:
    """First ``n`` rows in a total order."""
    return df.orderBy(*order).limit(n)
