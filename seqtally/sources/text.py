"""Delimited text inputs: barcode libraries, manifests, key:value summaries,
barcode lists, plain text lines, input-folder listings and count parquet."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqtally.operators.index import with_scan_index
from seqtally.schemas import BARCODE_LIST, CHUNK_COUNTS, KEY_VALUE

# --- fixed values: input file suffixes ---------------------------------------
FASTQ_SUFFIXES = (".fastq", ".fq", ".fastq.gz", ".fq.gz")
# ------------------------------------------------------------------------------
# The reference reads text in blocks of this size.
TEXT_BLOCK_BYTES = 256 << 20


def _strip_eol(c):
    return F.regexp_replace(c, r"[\r\n]+$", "")


def read_text_lines(spark: SparkSession, paths, block_bytes: int = TEXT_BLOCK_BYTES) -> DataFrame:
    """One row per line (``value``) with the file it came from, in splits of at
    most ``block_bytes``, an option of the scan (``lines``).  Paths that only
    Spark's file systems know are read by Spark's text source, whose split size is
    a session setting: that scan belongs to a session of its own."""
    from seqtally.sources.fastq import _fs_and_path
    from seqtally.sources.lines import LinesDataSource
    listed = [paths] if isinstance(paths, str) else list(paths)
    try:
        for p in listed:
            _fs_and_path(p)
    except Exception:  # pyarrow has no file system for it
        own = spark.newSession()
        own.conf.set("spark.sql.files.maxPartitionBytes", str(int(block_bytes)))
        return own.read.text(paths).select("value", F.col("_metadata.file_path").alias("file"))
    spark.dataSource.register(LinesDataSource)
    return (spark.read.format("byte_lines").option("splitBytes", str(int(block_bytes)))
            .option("paths", json.dumps(listed)).load())


def read_barcodes(spark: SparkSession, path: str, sep: str = ":",
                  barcode_set: str | None = None) -> DataFrame:
    """Headerless ``gene<sep>barcode`` library.  Only the first two fields are
    used.  ``ord`` follows file order: (file, byte offset of its split, row
    within the split) -- a position that does not depend on the cluster."""
    raw = (spark.read.text(path)
           .select(_strip_eol(F.col("value")).alias("value"),
                   F.col("_metadata.file_path").alias("_file"),
                   F.col("_metadata.file_block_start").alias("_block"))
           .filter(F.length(F.trim("value")) > 0))
    set_name = F.lit(barcode_set) if barcode_set else F.regexp_extract("_file", r"([^/]+)$", 1)
    return with_scan_index(raw, ["_file", "_block"], "ord").select(
                      set_name.alias("barcode_set"), "ord",
                      F.split_part("value", F.lit(sep), F.lit(1)).alias("gene"),
                      F.split_part("value", F.lit(sep), F.lit(2)).alias("barcode"))


def parse_manifest_lines(lines: DataFrame, sep: str = ",") -> DataFrame:
    """Manifest text -> (sample, barcode_set).  Comment lines ('#') and blank
    lines are dropped; fields beyond the second are ignored; a one-field line
    is kept with a NULL barcode set so it can be reported."""
    v = _strip_eol(F.col("value"))
    return (lines.select(v.alias("value"))
            .filter((F.length("value") > 0) & ~F.col("value").startswith("#"))
            .select(F.split_part("value", F.lit(sep), F.lit(1)).alias("sample"),
                    F.nullif(F.split_part("value", F.lit(sep), F.lit(2)), F.lit(""))
                    .alias("barcode_set")))


def read_manifest(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    return parse_manifest_lines(spark.read.text(path), sep)


def read_key_values(spark: SparkSession, path: str, sep: str = ":") -> DataFrame:
    """Headerless ``key<sep>value`` summary (first column is the key)."""
    return spark.read.schema(KEY_VALUE).option("sep", sep).csv(path)


def read_barcode_list(spark: SparkSession, path: str) -> DataFrame:
    """Headerless ``idx,barcode`` CSV."""
    return spark.read.schema(BARCODE_LIST).csv(path)


def read_counts_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Every chunk-count parquet below ``path`` in one scan."""
    return spark.read.schema(CHUNK_COUNTS).parquet(path)


def _folder(spark: SparkSession, root: str):
    """Hadoop file system and qualified path of a folder."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(path)


def _listed(fs, path) -> list:
    """(name, is a folder, path, length) of what lies directly in a folder."""
    return [(f.getPath().getName(), f.isDirectory(), f.getPath().toString(), f.getLen()) for f in fs.listStatus(path)]


def sample_folders(spark: SparkSession, root: str) -> list[str]:
    """Names of the folders in ``root``, sorted: one listing of one folder."""
    fs, path = _folder(spark, root)
    return sorted(name for name, folder, *_ in _listed(fs, path) if folder and not name.startswith(("_", ".")))


def discover_inputs(spark: SparkSession, root: str, strict: bool = True,
                    samples: DataFrame | None = None) -> DataFrame:
    """sample, path, length: per folder ``root/<sample>`` the first file (by
    path) with a FASTQ suffix (.fastq, .fq, .fastq.gz, .fq.gz) among its direct
    children; files deeper down (leftover splits) are not inputs and are not
    listed: one listing for ``root`` and one for each folder in it.  Only file
    metadata is read.  A folder without such a file, an empty one included, has
    a NULL path; with ``strict`` (the default) that is an error naming up to
    ten such folders, those of ``samples`` (sample) only if given."""
    fs, base = _folder(spark, root)
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    rows = []
    for name in sample_folders(spark, root):
        files = [(path, length) for child, folder, path, length in _listed(fs, path_of(base, name))
                 if not folder and child.endswith(FASTQ_SUFFIXES) and not child.startswith(("_", "."))]
        rows.append((name, *min(files, default=(None, None))))
    if strict:
        missing = [name for name, path, _ in rows if path is None]
        if missing and samples is not None:
            named = spark.createDataFrame([(m,) for m in missing], "sample string")
            found = named.join(samples.select("sample").distinct(), "sample", "left_semi").limit(11).collect()
            missing = sorted(r.sample for r in found)
        if missing:
            more = " and more" if len(missing) > 10 else ""
            raise ValueError(f"sample folders without a FASTQ file: {', '.join(missing[:10])}{more}")
    return spark.createDataFrame(rows, "sample string, path string, length long")
