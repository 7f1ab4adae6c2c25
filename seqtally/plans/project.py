"""A whole counting run over a project, from one pass over the reads.

Layout (the reference's): ``input_root/<sample>/<reads>.fastq[.gz]``, a
manifest of ``sample,barcode_file`` lines, barcode files (``gene<sep>barcode``)
in ``barcode_dir``.  Outputs, one folder per barcode set and sample:

* ``counts/``  Gene, Barcode, Read_counts, RPM (CSV with header);
* ``stats/``   the three-line read statistics text;
* ``samples/`` manifest samples without input folder and the reverse;
* ``chunks/``  per-chunk count tables with read IDs (parquet), if asked for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqtally.operators._util import staged
from seqtally.operators.counts import chunk_counts, count_matched
from seqtally.operators.library import prepare_library
from seqtally.operators.match import manifest_pairs, match_counts, matched_reads
from seqtally.operators.reshape import reconcile_samples
from seqtally.plans.counting import counts_of, stats_of
from seqtally.sinks import (write_counts_csv, write_hits_parquet,
                            write_stats_text)
from seqtally.sources.fastq import file_chunk, read_fastq
from seqtally.sources.text import discover_inputs, read_barcodes, read_manifest


def run_project(spark: SparkSession, input_root: str, manifest_path: str,
                barcode_dir: str, output_dir: str, sep: str = ":",
                with_ids: bool = False) -> dict[str, DataFrame]:
    """Count every sample of the manifest against its barcode file(s).

    The run configuration comes to the driver: the names of the barcode files
    and one input path per sample.  A manifest sample whose folder has no FASTQ
    file is an error, as in the reference; one without a folder is reported in
    ``samples/`` and has zero counts.  A sample's input is the first FASTQ file
    directly in its folder, and the reads take their sample from that folder.
    Returns the DataFrames that were written."""
    out = output_dir.rstrip("/")
    manifest = read_manifest(spark, manifest_path).filter(F.col("barcode_set").isNotNull())
    inputs = discover_inputs(spark, input_root, strict=True, samples=manifest)
    report = reconcile_samples(manifest, inputs)
    report.write.mode("overwrite").option("header", True).csv(f"{out}/samples")

    # barcode set = file name of the barcode file, as the output folders are
    files = sorted(r.barcode_set for r in manifest.select("barcode_set").distinct().collect())
    lib = prepare_library(read_barcodes(
        spark, [f"{barcode_dir.rstrip('/')}/{f}" for f in files], sep=sep))
    man = manifest_pairs(manifest.select("sample", F.regexp_extract("barcode_set", r"([^/]+)$", 1)
                                         .alias("barcode_set")))
    paths = sorted(r.path for r in inputs.join(man.select("sample").distinct(), "sample", "left_semi")
                   .select("path").collect())
    if not paths:
        raise ValueError("no input folder matches a manifest sample")
    reads = read_fastq(spark, paths)

    if with_ids:
        matched = staged(matched_reads(reads, lib, man, carry=("read_id",)), "matched")
    else:
        matched = match_counts(reads, lib, man)
    tally = staged(count_matched(matched), "tally")
    result = {"counts": counts_of(tally, lib, man), "stats": stats_of(tally, lib, man), "samples": report}
    write_counts_csv(result["counts"], f"{out}/counts", partition_by=("barcode_set", "sample"))
    write_stats_text(result["stats"], f"{out}/stats", by=("barcode_set", "sample"))
    if with_ids:
        result["chunks"] = chunk_counts(matched.filter("ord IS NOT NULL"), lib, chunk=file_chunk())
        write_hits_parquet(result["chunks"], f"{out}/chunks")
    return result
