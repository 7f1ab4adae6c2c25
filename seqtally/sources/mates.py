"""Mate files read side by side.

The k-th record of a forward file and the k-th of its reverse file are mates.  One
pass counts the records of every split of both files; prefix sums of the counts
number them, and a part of the forward file is then read together with the splits
of the reverse file that hold the same numbers, in one task.  No read is shuffled.
The IDs are compared.  Where files are out of step, because one lacks records or has
them in another place, a task looks for the mates among the ``AHEAD`` records that
it has last left over on either side; only what is left over at the end (the ends
of its part, shifted by as much as the files are) is joined by ID."""

from __future__ import annotations

import itertools
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from seqtally.functions.sequence import read_id_from_header
from seqtally.operators.reshape import pair_mates
from seqtally.sources.fastq import (DEFAULT_SPLIT_BYTES, Parts, _Range, _record_batches, file_ranges, in_tasks,
                                    option_paths, record_heads)

#: Records without a mate that a task holds on to on each side.
AHEAD = 20_000
FIELDS = ["offset", "header", "sequence", "quality"]
KINDS = ["long", "string", "string", "string"]
MATES = "file string, number long, " + ", ".join(f"{f}_{i} {k}" for i in (1, 2) for f, k in zip(FIELDS, KINDS))


class FastqIndexSource(DataSource):
    """A row for each part of the files: its byte range and number of records."""

    @classmethod
    def name(cls):
        return "fastq_index"

    def schema(self):
        return "file string, start long, stop long, gz boolean, records long"

    def reader(self, schema):
        return _IndexReader(self.options)


class _IndexReader(DataSourceReader):
    def __init__(self, options):
        self.paths, self.split = option_paths(options), int(options["splitBytes"])

    def partitions(self):
        return in_tasks(file_ranges(self.paths, self.split))

    def read(self, partition):
        for part in partition.parts:
            yield part.path, part.start, part.end, part.gz, sum(len(heads) for _, heads in record_heads(part))


class _Pair(InputPartition):
    """Records from ``number`` on: parts of the forward file and of the reverse
    file, each with the records to skip and the number to read."""

    def __init__(self, file: str, number: int, sides):
        super().__init__((file, number))
        self.file, self.number, self.sides = file, number, sides


def _overlapping(parts, first: int, n: int):
    """(parts, records to skip, records) of the numbers ``first`` to ``first + n``
    of a file whose ``parts`` are (range, first number, records)."""
    held = [(r, at, k) for r, at, k in parts if at < first + n and at + k > first]
    if not held:
        return [], 0, 0
    return ([r for r, *_ in held], max(0, first - held[0][1]),
            min(first + n, held[-1][1] + held[-1][2]) - max(first, held[0][1]))


def paired_parts(index, files_1, files_2) -> list[_Pair]:
    """The parts that mate files are read in, from their index rows (file, start,
    stop, gz, records)."""
    import bisect
    by_file = {}
    for file, rows in itertools.groupby(sorted(index), key=lambda r: r[0]):
        rows = [r for r in rows if r[4]]
        at = [0, *itertools.accumulate(r[4] for r in rows)]
        by_file[file] = [(tuple(r[:4]), a, r[4]) for r, a in zip(rows, at)]
    out = []
    for one, two in zip(files_1, files_2, strict=True):
        forward, reverse = by_file.get(one, []), by_file.get(two, [])
        ends = [at + k for _, at, k in reverse]
        total = forward[-1][1] + forward[-1][2] if forward else 0
        for r, at, k in forward:
            low = bisect.bisect_right(ends, at)
            high = bisect.bisect_left(ends, at + k) + 1
            out.append(_Pair(one, at, (([r], 0, k), _overlapping(reverse[low:high], at, k))))
        for r, at, k in reverse:  # behind the forward file's end
            if at + k > total:
                begin = max(at, total)
                out.append(_Pair(one, begin, (([], 0, 0), ([r], begin - at, at + k - begin))))
    return out


def _merged(pairs) -> list[_Pair]:
    """Neighbouring parts of a file as one: the reverse file's splits that two of
    them share are read once, and no mates are parted at their border."""
    out = []
    for _, group in itertools.groupby(pairs, key=lambda p: p.file):
        group, sides = list(group), []
        for i in (0, 1):
            held = [p.sides[i] for p in group if p.sides[i][2]]
            ranges = list(dict.fromkeys(r for parts, *_ in held for r in parts))
            sides.append((ranges, held[0][1] if held else 0, sum(n for *_, n in held)))
        out.append(_Pair(group[0].file, group[0].number, tuple(sides)))
    return out


def _records(side):
    """Record batches of one side, without the records to skip."""
    parts, skip, left = side
    for part in parts:
        for batch in _record_batches(_Range(*part)):
            gone = min(skip, batch.num_rows)
            skip -= gone
            batch = batch.slice(gone, left)
            left -= batch.num_rows
            if batch.num_rows:
                yield batch.select(FIELDS)
            if not left:
                return


def _side_by_side(pair: _Pair):
    """Arrow batches of both sides' records by number; nulls where one ends."""
    import pyarrow as pa
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string()]
    streams = [_records(side) for side in pair.sides]
    held, number = [next(s, None) for s in streams], pair.number
    while any(h is not None for h in held):
        n = min(h.num_rows for h in held if h is not None)
        columns = [pa.repeat(pa.scalar(pair.file), n), pa.array(range(number, number + n), pa.int64())]
        for i, h in enumerate(held):
            columns += h.slice(0, n).columns if h is not None else [pa.nulls(n, k) for k in kinds]
            if h is not None:
                held[i] = h.slice(n) if h.num_rows > n else next(streams[i], None)
        number += n
        yield pa.RecordBatch.from_arrays(columns, names=["file", "number", *(f"{f}_{i}" for i in (1, 2) for f in FIELDS)])


def _ids(headers):
    """Read IDs of header lines, as ``functions.sequence.read_id_from_header``."""
    import pyarrow.compute as pc
    return pc.list_element(pc.split_pattern_regex(pc.utf8_slice_codeunits(headers, 1), r"\s", max_splits=1), 0)


def _with_mates(pair: _Pair):
    """``_side_by_side`` with the mates of records out of step found by their IDs;
    a record without a mate here has nulls on the other side."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    sides = [["number", *(f"{f}_{i}" for f in FIELDS)] for i in (1, 2)]
    names = ["file", "number", *sides[0][1:], *sides[1][1:]]
    nothing = [None, None]

    def row_batch(one, two, n):
        number = (one if one is not None else two).column(0)
        kinds = [pa.int64(), pa.string(), pa.string(), pa.string()]
        columns = [pa.repeat(pa.scalar(pair.file), n), number]
        for side in (one, two):
            columns += side.columns[1:5] if side is not None else [pa.nulls(n, k) for k in kinds]
        return pa.Table.from_arrays([pa.chunked_array(c) if isinstance(c, pa.Array) else c for c in columns],
                                    names=names).combine_chunks().to_batches()

    held = list(nothing)
    for batch in _side_by_side(pair):
        ids = [_ids(batch.column(f"header_{i}")) for i in (1, 2)]
        if held == nothing and pc.all(pc.fill_null(pc.equal(*ids), False)).as_py():
            yield batch
            continue
        for i, columns in enumerate(sides):
            here = pa.Table.from_batches([batch]).select(columns).append_column("id", ids[i]).filter(pc.is_valid(ids[i]))
            held[i] = here if held[i] is None else pa.concat_tables([held[i], here])
        at = pc.index_in(held[0].column("id"), value_set=held[1].column("id").combine_chunks()).combine_chunks()
        found = np.flatnonzero(pc.is_valid(at).to_numpy(zero_copy_only=False))
        place, first = np.unique(at.take(pa.array(found)).to_numpy(), return_index=True)
        found = found[first]
        if len(found):
            yield from row_batch(held[0].take(found), held[1].take(place), len(found))
        for i, gone in enumerate((found, place)):
            keep = np.ones(held[i].num_rows, bool)
            keep[gone] = False
            rest = held[i].filter(pa.array(keep)).combine_chunks()
            old = rest.slice(0, max(0, rest.num_rows - AHEAD))
            if old.num_rows:
                yield from row_batch(*((old, None) if i == 0 else (None, old)), old.num_rows)
            held[i] = rest.slice(old.num_rows)
        if not any(h.num_rows for h in held):
            held = list(nothing)
    for i, rest in enumerate(held):
        if rest is not None and rest.num_rows:
            yield from row_batch(*((rest, None) if i == 0 else (None, rest)), rest.num_rows)


class FastqMatesSource(DataSource):
    @classmethod
    def name(cls):
        return "fastq_mates"

    def schema(self):
        return MATES

    def reader(self, schema):
        return _MatesReader(self.options)


class _MatesReader(DataSourceReader):
    def __init__(self, options):
        self.index, self.files = json.loads(options["index"]), (json.loads(options["files1"]), json.loads(options["files2"]))
        self.by_id = options.get("byId") == "true"

    def partitions(self):
        size = lambda pair: sum(end - start for parts, *_ in pair.sides for _, start, end, _ in parts)
        return [Parts(_merged(p.parts)) for p in in_tasks(paired_parts(self.index, *self.files), size)]

    def __getstate__(self):  # what a task needs: the index grows with the files
        return {"by_id": self.by_id}

    def read(self, partition):
        for pair in partition.parts:
            yield from (_with_mates if self.by_id else _side_by_side)(pair)


def read_mates(spark: SparkSession, paths_1, paths_2, split_bytes: int | None = None,
               by_id: bool = False) -> DataFrame:
    """file (the forward one), number, and offset, header, sequence and quality of
    both records with that number (``_1``, ``_2``; nulls where a file has fewer).
    With ``by_id`` a row has a record and its mate by ID, where a task finds it, or
    else nulls; ``number`` is then that of the forward record, if there is one.
    The files of both lists belong together in the order of their names.  The
    index, a row for each split, comes to the driver, as the listing does."""
    spark.dataSource.register(FastqIndexSource)
    spark.dataSource.register(FastqMatesSource)
    split = split_bytes or DEFAULT_SPLIT_BYTES
    lists = [[p] if isinstance(p, str) else list(p) for p in (paths_1, paths_2)]
    files = [sorted({r.path for r in file_ranges(paths, 1 << 62)}) for paths in lists]
    if len(files[0]) != len(files[1]):
        raise ValueError(f"{len(files[0])} forward files, but {len(files[1])} reverse files")
    index = (spark.read.format("fastq_index").option("splitBytes", str(split))
             .option("paths", json.dumps(files[0] + files[1])).load().collect())
    return (spark.read.format("fastq_mates").option("index", json.dumps([list(r) for r in index]))
            .option("files1", json.dumps(files[0])).option("files2", json.dumps(files[1]))
            .option("byId", str(by_id).lower()).load())


def pair_mate_files(spark: SparkSession, paths_1, paths_2, split_bytes: int | None = None) -> DataFrame:
    """sample, read_id, sequence_1, sequence_2 of all mates, the sample being the
    folder of the forward file.  IDs are unique in a file.  Records are paired where
    they are read; those whose mate was not found there, and only these, meet in a
    join by ID (``pair_mates``), for which the files are read once more."""
    rows = read_mates(spark, paths_1, paths_2, split_bytes, by_id=True).select(
        F.regexp_extract("file", r"([^/]+)/[^/]+$", 1).alias("sample"),
        *(read_id_from_header(f"header_{i}").alias(f"id_{i}") for i in (1, 2)), "sequence_1", "sequence_2")
    both = "id_1 IS NOT NULL AND id_2 IS NOT NULL"
    together = rows.filter(both).select("sample", F.col("id_1").alias("read_id"), "sequence_1", "sequence_2")
    apart = rows.filter(f"NOT ({both})")
    one, two = (apart.filter(f"id_{i} IS NOT NULL").select("sample", F.col(f"id_{i}").alias("read_id"),
                                                           F.col(f"sequence_{i}").alias("sequence")) for i in (1, 2))
    return together.unionByName(pair_mates(one, two))
