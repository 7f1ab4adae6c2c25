"""Writers.  Every sink is a distributed write (no driver-side rows); the
default mode replaces earlier results, and partitioned writes replace only the
partitions they produce (dynamic partition overwrite)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqtally.functions.sequence import format_fastq_record
from seqtally.operators._util import staged
from seqtally.operators.index import with_index


def _writer(df: DataFrame, mode: str):
    """A writer whose partitioned overwrite replaces only the partitions it
    produces; an option of the write, the session's settings stay."""
    return df.write.mode(mode).option("partitionOverwriteMode", "dynamic")


def write_hits_parquet(chunks: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Per-chunk count tables (gene, barcode, read_counts, ids), one folder
    per sample."""
    _writer(chunks, mode).partitionBy("sample").parquet(path)


# --- fixed values: the reference's result headers and statistics text -------
RESULT_HEADER = ["Gene", "Barcode", "Read_counts", "RPM"]
STATS_FILE_LABEL = "File: "
STATS_LABELS = ["Total read: ", "Detected read: ", "Detection rate in the sequence pool: "]
# ------------------------------------------------------------------------------


def write_counts_csv(counts: DataFrame, path: str, mode: str = "overwrite",
                     reference_header: bool = True, partition_by=("sample",)) -> None:
    """Gene, barcode, read count and RPM with a header row (the reference's
    column names unless ``reference_header=False``), one folder per sample,
    rows in key order.  The global sort range-partitions the rows, so a large
    sample is written by many tasks."""
    names = RESULT_HEADER if reference_header else ["gene", "barcode", "read_counts", "rpm"]
    cols = [F.col(c).alias(a) for c, a in zip(["gene", "barcode", "read_counts", "rpm"], names)]
    parts = list(partition_by)
    rows = counts.orderBy(*parts, "gene", "barcode").select(*parts, *cols)
    _writer(rows, mode).option("header", True).partitionBy(*parts).csv(path)


def write_stats(stats: DataFrame, path: str, mode: str = "overwrite") -> None:
    stats.write.mode(mode).option("header", True).csv(path)


def write_stats_text(stats: DataFrame, path: str, mode: str = "overwrite",
                     by="sample") -> None:
    """The statistics text of the reference, one folder per ``by`` value:
    three lines per sample, or four with a leading ``File: <name>`` line when
    the statistics carry a ``file`` column (flank extraction)."""
    lines = []
    if "file" in stats.columns:
        lines.append(F.concat(F.lit(STATS_FILE_LABEL), F.regexp_extract("file", r"([^/]+)$", 1)))
    values = [F.col("total_reads").cast("string"), F.col("detected_reads").cast("string"),
              F.coalesce(F.col("detection_rate").cast("string"), F.lit("nan"))]
    body = F.concat_ws("\n", *lines,
                       *[F.concat(F.lit(label), v) for label, v in zip(STATS_LABELS, values)])
    keys = [by] if isinstance(by, str) else list(by)
    _writer(stats.select(*keys, body.alias("value")), mode).partitionBy(*keys).text(path)


def write_fastq(reads: DataFrame, path: str, partition_by=(), mode: str = "overwrite",
                compression: str | None = None) -> None:
    """Four-line FASTQ records; e.g. ``partition_by=("fragment",)`` gives one
    folder per length window, ``compression="gzip"`` gz files."""
    rec = format_fastq_record("header", "sequence", "spacer", "quality").alias("value")
    w = _writer(reads.select(rec, *partition_by), mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.option("compression", compression or "none").text(path)


def write_fastq_blocks(reads: DataFrame, path: str) -> list[str]:
    """Four-line FASTQ records as block-gzip files, which ``read_fastq`` reads in
    splits: one for each partition, in the order of its rows.  A task writes under
    a name of its own, and only the names that are returned count, so a repeated
    task leaves nothing that is read."""
    rec = format_fastq_record("header", "sequence", "spacer", "quality").alias("value")

    def write(batches):
        import itertools
        import uuid

        import pyarrow as pa

        from seqtally.sources._framing import blocked
        from seqtally.sources.fastq import _fs_and_path
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return
        fs, folder = _fs_and_path(path)
        fs.create_dir(folder, recursive=True)
        name, end = f"part-{uuid.uuid4().hex}.fastq.gz", len(blocked(b""))
        with fs.open_output_stream(f"{folder.rstrip('/')}/{name}", compression=None) as out:
            for batch in itertools.chain([first], batches):
                text = "".join(f"{x}\n" for x in batch.column("value").to_pylist())
                out.write(blocked(text.encode())[:-end])
            out.write(blocked(b""))
        yield pa.RecordBatch.from_arrays([pa.array([f"{path.rstrip('/')}/{name}"])], names=["path"])
    return sorted(r.path for r in staged(reads.select(rec).mapInArrow(write, "path string"), "fastq-blocks").collect())


def write_barcode_list(barcodes: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Headerless ``idx,barcode`` CSV, idx in barcode order."""
    (with_index(barcodes.select("barcode"), ["barcode"]).select("idx", "barcode")
     .write.mode(mode).csv(path))


def write_comparison_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_line_counts_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).csv(path)
