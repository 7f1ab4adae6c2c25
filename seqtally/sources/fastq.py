"""FASTQ readers.

``spark.read.format("fastq")`` (registered by ``register_fastq_source``) is a
Python Data Source that yields Arrow batches of whole records: bare or named
spacers (``+``, ``+read1``), ``\\n`` or ``\\r\\n`` line ends; plain and block-gzip
files in splits, other ``.gz`` files whole.  A partition owns the records whose
header line starts inside its byte range; it finds the first one by the rule
"line starts with '@' and the line two further starts with '+'" (a quality line
may start with '@', but then the line two further is a sequence).  After a record
that breaks the four-line layout it looks for the next one by the same rule.
Records are framed on vectors of line starts, lengths and first bytes
(``_framing``), never one by one.

``read_fastq`` gives what counting needs, with every record verified as the
reference does: equal lengths of sequence and quality, Phred+33 qualities."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from seqtally.functions.sequence import (description_from_header,
                                         read_id_from_header)
from seqtally.operators._util import spread
from seqtally.operators.records import validate_fastq
from seqtally.schemas import FASTQ_RECORD
from seqtally.sources._framing import VIRTUAL, Blocks, Lines, Stream, block_size

# Bytes of a FASTQ file whose reads make one chunk of the per-chunk ID lists.
CHUNK_BYTES = 64 << 20


def read_fastq(spark: SparkSession, paths, sample: str | None = None,
               mode: str = "FAILFAST", verify: bool = True,
               split_bytes: int | None = None) -> DataFrame:
    """Reads with sample, read_key, read_id, description, sequence.

    ``read_key`` is (hash of the file, byte offset of the record; in block-gzip
    files its virtual offset), so it is the same however the file is split and
    differs between any two scans' files; ``sample`` defaults to the name of the folder holding the file.
    A malformed record stops the job (FAILFAST, inside the plan) or is left
    out (DROP: every valid record is kept); ``verify=False`` skips the check
    of qualities and only asks for a header and a sequence."""
    mode = mode.upper()
    if mode not in ("FAILFAST", "DROP"):
        raise ValueError("mode must be FAILFAST or DROP")
    rec = read_fastq_full(spark, paths, split_bytes)
    if verify:
        rec = validate_fastq(rec, mode)
    else:
        rec = rec.filter(F.col("header").startswith("@") & (F.length("sequence") > 0))
    smp = F.lit(sample) if sample else F.regexp_extract("file", r"([^/]+)/[^/]+$", 1)
    return spread(rec.select(
        smp.alias("sample"), F.struct(F.xxhash64("file").alias("file"), F.col("offset").alias("offset")).alias("read_key"),
        read_id_from_header("header").alias("read_id"),
        description_from_header("header").alias("description"), "sequence"))


def file_chunk(read_key="read_key"):
    """Chunk number of a read from a file, for ``counts.chunk_counts``; in
    block-gzip files by the compressed bytes."""
    at = f"{read_key}.offset"
    return F.expr(f"if({at} >= {VIRTUAL}, shiftright({at} - {VIRTUAL}, 16), {at}) div {CHUNK_BYTES}")


def manifest_from_paths(spark: SparkSession, paths, barcode_set: str) -> DataFrame:
    """(sample, barcode_set) for every sample folder holding input files, from
    the file listing alone (the binaryFile content column is never read): the
    default manifest for FASTQ inputs without a second scan of the reads."""
    files = spark.read.format("binaryFile").load(paths).select("path")
    return (files.select(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("sample"))
            .distinct().withColumn("barcode_set", F.lit(barcode_set)))


# ----------------------------------------------------------------------------
# Full-record source

DEFAULT_SPLIT_BYTES = 128 * 1024 * 1024


class _Range(InputPartition):
    def __init__(self, path: str, start: int, end: int, gz: bool):
        super().__init__((path, start, end, gz))
        self.path, self.start, self.end, self.gz = path, start, end, gz


def _fs_and_path(uri: str):
    """pyarrow filesystem and path for a Spark/Hadoop path or URI (local,
    ``file:``, and whatever pyarrow supports, e.g. s3://, gs://, hdfs://
    with libhdfs; Hadoop's s3a:// and s3n:// are read as s3://)."""
    import pyarrow.fs as pafs
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    for hadoop_scheme in ("s3a://", "s3n://"):
        if uri.startswith(hadoop_scheme):
            uri = "s3://" + uri[len(hadoop_scheme):]
    return pafs.FileSystem.from_uri(uri)


def _glob_pattern(path: str) -> re.Pattern:
    """A path with ``*``, ``?``, ``[...]`` and ``{a,b}``, none of which crosses
    a slash, as a regular expression."""
    out, braces = "", 0
    for part in re.findall(r"\[[^\]]*\]|.", path):
        if part.startswith("[") and len(part) > 2:
            out += part.replace("[!", "[^")
        elif part in "{}":
            braces += 1 if part == "{" else -1
            out += "(?:" if part == "{" else ")"
        else:
            out += {"*": "[^/]*", "?": "[^/]", ",": "|" if braces else ","}.get(part, re.escape(part))
    return re.compile(out)


def _children(fs, folder: str) -> list:
    """What lies directly in a folder (nothing if there is none)."""
    import pyarrow.fs as pafs
    return fs.get_file_info(pafs.FileSelector(folder, recursive=False, allow_not_found=True))


def _named(fs, path: str) -> list:
    """What a glob pattern names, found level by level: only folders that match
    the pattern so far are listed."""
    import pyarrow.fs as pafs
    parts = path.rstrip("/").split("/")
    first = next((i for i, p in enumerate(parts) if re.search(r"[*?\[{]", p)), len(parts))
    if first == len(parts):
        return [f for f in fs.get_file_info([path]) if f.type != pafs.FileType.NotFound]
    found = [pafs.FileInfo("/".join(parts[:first]) or "/", type=pafs.FileType.Directory)]
    for part in parts[first:]:
        folders = [f.path for f in found if f.type == pafs.FileType.Directory]
        if re.search(r"[*?\[{]", part):
            pattern = _glob_pattern(part)
            found = [c for f in folders for c in _children(fs, f) if pattern.fullmatch(c.base_name)]
        else:
            found = fs.get_file_info([f"{f.rstrip('/')}/{part}" for f in folders]) if folders else []
    return sorted((f for f in found if f.type != pafs.FileType.NotFound), key=lambda f: f.path)


def _below(fs, folder: str) -> list:
    """All files in a folder and below, but for hidden ones."""
    import pyarrow.fs as pafs
    files = [f for f in fs.get_file_info(pafs.FileSelector(folder, recursive=True)) if f.type == pafs.FileType.File]
    return sorted((f for f in files if not f.base_name.startswith(("_", "."))), key=lambda f: f.path)


def _spelled(path: str) -> list[str]:
    """A pattern whose braces hold slashes, as patterns without such braces."""
    group = re.search(r"\{([^{}]*/[^{}]*)\}", path)
    if not group:
        return [path]
    return [p for part in group[1].split(",") for p in _spelled(path[:group.start()] + part + path[group.end():])]


def _list_files(paths):
    """(URI, size) of every file that the paths name: files, folders (with all
    that lies below) and glob patterns of either."""
    import pyarrow.fs as pafs
    out = []
    for p in paths:
        fs, path = _fs_and_path(p)
        prefix = p[:len(p.rstrip("/")) - len(path.rstrip("/"))] if p.rstrip("/").endswith(path.rstrip("/")) else ""
        if re.search(r"[*?\[{]", path):
            tops = [t for one in _spelled(path) for t in _named(fs, one)]
        else:
            tops = fs.get_file_info([path])
        if not tops or any(t.type == pafs.FileType.NotFound for t in tops):
            raise FileNotFoundError(p)
        for info in tops:
            files = _below(fs, info.path) if info.type == pafs.FileType.Directory else [info]
            out += [(prefix + f.path, f.size) for f in files]
    return out


def join_files(spark: SparkSession, folder: str, path: str) -> None:
    """The files of a folder, in order of their names, copied to one file by a task
    that holds a block of them at a time."""
    def copy(_):
        target, to = _fs_and_path(path)
        target.create_dir(to.rpartition("/")[0], recursive=True)
        with target.open_output_stream(to) as out:
            for name, _ in _list_files([folder]):
                fs, part = _fs_and_path(name)
                with fs.open_input_stream(part) as file:
                    while block := file.read(8 << 20):
                        out.write(block)
    spark.sparkContext.parallelize([0], 1).foreach(copy)


def _is_blocked(uri: str) -> bool:
    """Whether a gzip file begins like a block-gzip file."""
    fs, path = _fs_and_path(uri)
    with fs.open_input_file(path) as file:
        return block_size(file.read(1 << 16)) is not None


def file_ranges(paths, split: int) -> list:
    """The parts that files are read in."""
    parts = []
    for path, size in _list_files(paths):
        gz = path.endswith(".gz")
        if size <= split or gz and not _is_blocked(path):
            parts.append(_Range(path, 0, size, gz))
        else:
            parts += [_Range(path, s, min(size, s + split), gz) for s in range(0, size, split)]
    return parts


#: Parts that a scan reads in a task each; of more parts, the neighbours that make
#: a share of the scan, or these bytes, are read by one task.
TASKS, TASK_BYTES = 32, 16 << 20


class Parts(InputPartition):
    """Parts that a task reads one after the other."""

    def __init__(self, parts):
        super().__init__(len(parts))
        self.parts = parts


def in_tasks(parts, size=lambda part: part.end - part.start) -> list[Parts]:
    """Parts dealt to tasks.  Parts may be small; a task for each would cost more
    than to read it."""
    sizes = [size(part) for part in parts]
    enough = min(TASK_BYTES, sum(sizes) / TASKS) if len(parts) > TASKS else 0
    out, held = [], 0
    for part, n in zip(parts, sizes):
        if out and held < enough:
            out[-1].append(part)
        else:
            out.append([part])
            held = 0
        held += n
    return [Parts(group) for group in out] or [Parts([])]


def option_paths(options) -> list[str]:
    paths = options.get("paths") or options.get("path")
    if isinstance(paths, str) and paths.startswith("["):
        import json
        paths = json.loads(paths)
    return [paths] if isinstance(paths, str) else list(paths)


class FastqDataSource(DataSource):
    """``spark.read.format("fastq").option("splitBytes", n).load(paths)``."""

    @classmethod
    def name(cls):
        return "fastq"

    def schema(self):
        return FASTQ_RECORD

    def reader(self, schema):
        return _FastqReader(self.options)


class _FastqReader(DataSourceReader):
    def __init__(self, options):
        self.paths = option_paths(options)
        self.split = int(options.get("splitBytes", DEFAULT_SPLIT_BYTES))

    def partitions(self):
        return in_tasks(file_ranges(self.paths, self.split))

    def read(self, partition):
        for part in partition.parts:
            yield from _record_batches(part)


def open_part(part: _Range):
    """The bytes of a part, and whether its first line belongs to the part before."""
    fs, path = _fs_and_path(part.path)
    if part.gz:
        file = fs.open_input_file(path)
        if part.start or block_size(file.read(1 << 16)) is not None:
            return Blocks(file, file.size(), part.start, part.end), part.start > 0
        return Stream(fs.open_input_stream(path, compression="gzip"), 0, None), False
    stream = fs.open_input_file(path)
    at = max(0, part.start - 1)
    stream.seek(at)
    return Stream(stream, at, part.end), part.start > 0


def _batch(path: str, lines: Lines, heads):
    import pyarrow as pa
    columns = [pa.repeat(pa.scalar(path, pa.string()), len(heads)), pa.array(lines.source.offsets(lines.places[heads]))]
    columns += [lines.strings(heads + k) for k in range(4)]
    return pa.RecordBatch.from_arrays(columns, names=[f.name for f in FASTQ_RECORD.fields])


def _record_batches(part: _Range):
    """Arrow batches of the records of a part."""
    for lines, heads in record_heads(part):
        yield _batch(part.path, lines, heads)


def record_heads(part: _Range):
    """(lines, numbers of the header lines) of the records whose header starts in
    the part, a block of the file at a time.  A line
    starts a whole record if it begins with '@', the line two further with '+',
    and the lines one and three further are equally long: three vector
    operations on the lines of a block.  In each of the four phases the whole
    records up to the next that isn't are taken as one run.

    Lines that are no record where one should start give one row with what
    they hold, for the caller to reject, and the search goes on behind them.
    Blank lines between records are skipped."""
    import numpy as np
    source, skip = open_part(part)
    lines, synced, going = Lines(source), not skip, True
    while going:
        going = lines.more()
        n = lines.n
        i = 1 if skip and n else 0
        skip = skip and not n
        at, plus = lines.first == 64, lines.first == 43
        heads = at[:-2] & plus[2:]
        whole = heads[:-1] & (lines.lengths[1:n - 2] == lines.lengths[3:]) if n > 3 else np.zeros(0, bool)
        heads = np.flatnonzero(heads)
        broken = [np.flatnonzero(~whole[phase::4]) for phase in range(4)]
        own, runs, done = lines.owned(), [], False
        while i < n:
            if i >= own:
                done = True
                break
            if not synced:
                k = int(np.searchsorted(heads, i))
                if k == len(heads):
                    i = max(i, n - 2) if going else n
                    break
                i, synced = int(heads[k]), True
                continue
            full, b = (n - i) // 4, broken[i % 4]
            k = int(np.searchsorted(b, i // 4))
            good = min(full, int(b[k]) - i // 4) if k < len(b) else full
            if good:
                runs.append(np.arange(i, min(i + 4 * good, own), 4))
                i += 4 * good
            elif lines.blank(i):
                i += 1
            elif full or not going:
                runs.append(np.array([i]))
                i, synced = i + 1, False
            else:
                break
        if runs:
            yield lines, np.concatenate(runs)
        if done:
            return
        lines.keep(i)


def register_fastq_source(spark: SparkSession) -> None:
    spark.dataSource.register(FastqDataSource)


def read_fastq_full(spark: SparkSession, paths, split_bytes: int | None = None) -> DataFrame:
    """All four fields of every record, with file and byte offset."""
    register_fastq_source(spark)
    r = spark.read.format("fastq")
    if split_bytes:
        r = r.option("splitBytes", str(split_bytes))
    if isinstance(paths, str):
        return r.load(paths)
    import json
    return r.option("paths", json.dumps(list(paths))).load()
