"""Text lines read in byte ranges of a size of their own.

``spark.read.format("byte_lines").option("splitBytes", n)`` is a Python Data
Source: the size of its parts is an option of the scan, so it holds wherever the
scan ends up, in a join or a union with the caller's tables, and the session's
settings stay as they are.  Lines end with ``\\n``, ``\\r\\n`` or ``\\r``, as for
Spark's text files; a part owns the lines that start in it.  Of many small parts
a task reads several, one after the other.  Gzip files are read
whole, block-gzip files in parts; bytes that are no UTF-8 are replaced."""

from __future__ import annotations

from pyspark.sql.datasource import DataSource, DataSourceReader

from seqtally.sources._framing import Lines
from seqtally.sources.fastq import _Range, file_ranges, in_tasks, open_part, option_paths


class LinesDataSource(DataSource):
    @classmethod
    def name(cls):
        return "byte_lines"

    def schema(self):
        return "value string, file string"

    def reader(self, schema):
        return _LinesReader(self.options)


class _LinesReader(DataSourceReader):
    def __init__(self, options):
        self.paths = option_paths(options)
        self.split = int(options["splitBytes"])

    def partitions(self):
        return in_tasks(file_ranges(self.paths, self.split))

    def read(self, partition):
        for part in partition.parts:
            yield from _line_batches(part)


def _line_batches(part: _Range):
    import numpy as np
    import pyarrow as pa
    source, skip = open_part(part)
    lines, going = Lines(source, single=True), True
    while going:
        going = lines.more()
        own = lines.owned()
        first = 1 if skip and lines.n else 0
        skip = skip and not lines.n
        if own > first:
            value = lines.strings(np.arange(first, own))
            yield pa.RecordBatch.from_arrays([value, pa.repeat(pa.scalar(part.path, pa.string()), own - first)],
                                             names=["value", "file"])
        if own < lines.n:
            return
        lines.keep(lines.n)
