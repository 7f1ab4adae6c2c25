"""Columnar framing: damaged files against a plain line-by-line reader, block-gzip
files at every split size, lines, listings, mates and numbering."""

import gzip
import os
import random

import pytest
from pyspark.sql import functions as F

from seqtally.sources import _framing as framing
from seqtally.sources import fastq as fq
from seqtally.sources import text as txt
from seqtally.sources._framing import VIRTUAL, block_size, blocked
from seqtally.sources.fastq import read_fastq_full


def records(n, seed=0, most=90):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        s = "".join(rnd.choice("ACGTN") for _ in range(rnd.randint(1, most)))
        out.append((f"@read{i} x", s, "+", "".join(rnd.choice('@+,"!#I5?_') for _ in s)))
    return out


def put(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data if isinstance(data, bytes) else data.encode())
    return path


def text_of(recs):
    return "".join("\n".join(r) + "\n" for r in recs)


def plain_rows(data: bytes):
    """The rows of a whole file, line by line: whole records, blank lines left
    out, and a row for each line where no record starts."""
    lines = data.split(b"\n")
    if lines and lines[-1] == b"":
        lines.pop()
    cut = lambda x: x.rstrip(b"\r")
    head = lambda i: i + 2 < len(lines) and lines[i][:1] == b"@" and lines[i + 2][:1] == b"+"
    rows, i, synced = [], 0, True
    while i < len(lines):
        if not synced and not head(i):
            i += 1
            continue
        synced = True
        if head(i) and i + 3 < len(lines) and len(cut(lines[i + 1])) == len(cut(lines[i + 3])):
            rows.append(lines[i:i + 4])
            i += 4
        elif not lines[i].strip():
            i += 1
        else:
            rows.append((lines[i:i + 4] + [None] * 3)[:4])
            i, synced = i + 1, False
    return [tuple(None if x is None else cut(x).decode("utf-8", "replace") for x in r) for r in rows]


def rows_of(parts):
    out = []
    for p in parts:
        for b in fq._record_batches(p):
            d = b.to_pydict()
            out += list(zip(d["offset"], d["header"], d["sequence"], d["spacer"], d["quality"]))
    return out


@pytest.mark.parametrize("block", [7, 64, 1 << 20])
@pytest.mark.parametrize("seed", range(6))
def test_damaged_files_read_as_line_by_line(tmpdir_path, monkeypatch, seed, block):
    """Lines removed, doubled, emptied and garbled, with CRLF and bytes that are no
    UTF-8, in blocks that end anywhere."""
    from seqtally.sources import _framing
    monkeypatch.setattr(_framing, "BLOCK", block)
    rnd = random.Random(seed)
    lines = text_of(records(60, seed, 12)).encode().split(b"\n")[:-1]
    for _ in range(rnd.randrange(1, 25)):
        i = rnd.randrange(len(lines))
        what = rnd.randrange(6)
        if what == 0:
            del lines[i]
        elif what == 1:
            lines.insert(i, rnd.choice([b"", b"  ", b"\t\r", b"@", b"+", b"@x", lines[i], b"\xff\xfe", "@é".encode()]))
        elif what == 2:
            lines[i] = lines[i][:-1]
        elif what == 3:
            lines[i] += b"\r" * rnd.randrange(3)
        elif what == 4:
            lines[i] = lines[i].replace(b"A", b"\x80", 1)
        else:
            lines[i:i + 1] = [lines[i], b""]
    data = rnd.choice([b"\n", b"\r\n"]).join(lines) + rnd.choice([b"", b"\n"])
    p = put(f"{tmpdir_path}/S/d.fastq", data)
    assert [r[1:] for r in rows_of([fq._Range(p, 0, len(data), False)])] == plain_rows(data)


def test_offsets_are_the_headers_places(tmpdir_path):
    recs = records(50, 3)
    data = text_of(recs).encode()
    p = put(f"{tmpdir_path}/S/o.fastq", data)
    for split in (50, 1000, 10 ** 6):
        got = rows_of([fq._Range(p, s, min(s + split, len(data)), False) for s in range(0, len(data), split)])
        assert [data[o:o + len(h)].decode() for o, h, *_ in got] == [r[0] for r in recs]


@pytest.mark.parametrize("piece, most", [(50, 30), (997, 90), (0xFF00, 2000)])
def test_block_gzip_in_splits(tmpdir_path, piece, most):
    """Records over block bounds, blocks smaller and larger than splits, bounds
    that fall on a record's first byte; offsets the same at every split size."""
    recs = records(300, piece, most)
    data = text_of(recs).encode()
    packed = blocked(data, piece)
    assert gzip.decompress(packed) == data
    p = put(f"{tmpdir_path}/S/b.fastq.gz", packed)
    whole = rows_of([fq._Range(p, 0, len(packed), True)])
    assert [r[1:] for r in whole] == recs and len({r[0] for r in whole}) == len(recs)
    assert whole == sorted(whole) and whole[0][0] == VIRTUAL
    for split in (13, 60, 400, 5000, 1 << 16):
        parts = fq.file_ranges([p], split)
        assert len(parts) == max(1, -(-len(packed) // split)) or len(packed) <= split
        assert rows_of(parts) == whole, split


def test_blocks_that_begin_with_a_record(tmpdir_path):
    """One record per block, empty blocks between: each bound is a header."""
    recs = records(40, 8)
    end = blocked(b"")
    packed = b"".join(blocked(text_of([r]).encode())[:-len(end)] + end * (i % 3) for i, r in enumerate(recs)) + end
    p = put(f"{tmpdir_path}/S/e.fastq.gz", packed)
    for split in (1, 7, 28, 64, 300, 10 ** 6):
        assert [r[1:] for r in rows_of(fq.file_ranges([p], split))] == recs, split


def test_other_gzip_files_stay_whole(spark, tmpdir_path):
    recs = records(100, 4)
    half = len(text_of(recs)) // 2
    data = text_of(recs).encode()
    p = put(f"{tmpdir_path}/S/g.fastq.gz", gzip.compress(data[:half]) + gzip.compress(data[half:]))
    assert len(fq.file_ranges([p], 64)) == 1
    got = read_fastq_full(spark, p, split_bytes=64).orderBy("offset").collect()
    assert [(r.header, r.sequence, r.spacer, r.quality) for r in got] == recs
    assert block_size(gzip.compress(data)) is None and block_size(b"") is None and block_size(blocked(b"x")[:14]) is None
    cut = put(f"{tmpdir_path}/T/cut.fastq.gz", blocked(data, 500)[:900])
    with pytest.raises(ValueError, match="no block-gzip member"):
        rows_of([fq._Range(cut, 0, 900, True)])


def test_chunks_of_block_gzip_reads(spark):
    at = F.struct(F.lit(1).alias("file"), F.col("o").alias("offset")).alias("read_key")
    rows = spark.createDataFrame([(0,), (fq.CHUNK_BYTES,), (VIRTUAL,), (VIRTUAL | (fq.CHUNK_BYTES << 16) | 5,)], "o long")
    assert [r.c for r in rows.select(at).select(fq.file_chunk().alias("c")).collect()] == [0, 1, 0, 1]


# --- lines ------------------------------------------------------------------------

@pytest.mark.parametrize("split", [1, 3, 10, 1000])
def test_lines_as_spark_reads_them(spark, tmpdir_path, split):
    rnd = random.Random(split)
    data = "".join(rnd.choice(["a", "bc", "é", "", "xyz " * 3]) + rnd.choice(["\n", "\r\n", "\r", "\n\n"]) for _ in range(60))
    for i, end in enumerate(["", "last", "\r"]):
        put(f"{tmpdir_path}/l{i}/t.txt", data + end)
        want = sorted(r.value for r in spark.read.text(f"{tmpdir_path}/l{i}").collect())
        got = sorted(r.value for r in txt.read_text_lines(spark, f"{tmpdir_path}/l{i}", split).collect())
        assert got == want


def test_line_splits_hold_in_other_plans(spark, tmpdir_path):
    """The size of the parts is the scan's own, in a union and below a join."""
    put(f"{tmpdir_path}/u/t.txt", "line of text\n" * 1000)
    lines = txt.read_text_lines(spark, f"{tmpdir_path}/u", 1000)
    other = spark.createDataFrame([("line of text", "f")], "value string, file string").coalesce(1)
    assert lines.rdd.getNumPartitions() == 13
    assert lines.unionByName(other).rdd.getNumPartitions() == 14
    joined = lines.join(F.broadcast(other.select("value")), "value")
    assert joined.count() == 1000 and joined.rdd.getNumPartitions() == 13
    put(f"{tmpdir_path}/z/t.txt.gz", gzip.compress(b"a\nb\r\nc"))
    assert sorted(r.value for r in txt.read_text_lines(spark, f"{tmpdir_path}/z", 2).collect()) == ["a", "b", "c"]


# --- listings ------------------------------------------------------------------------

def test_only_named_folders_are_listed(spark, tmpdir_path, monkeypatch):
    """Leftover splits deep down are neither inputs nor listed."""
    for s in ("A", "B", "_hidden"):
        put(f"{tmpdir_path}/in/{s}/x.fastq", text_of(records(3)))
        for i in range(5):
            put(f"{tmpdir_path}/in/{s}/Split_files/deep{i}/y.fastq", text_of(records(2)))
    put(f"{tmpdir_path}/in/C/notes.txt", "")
    seen = []
    listed, children = txt._listed, fq._children
    monkeypatch.setattr(txt, "_listed", lambda f, p: seen.append(str(p.toString()).rsplit("/in", 1)[1]) or listed(f, p))
    got = {r.sample: r.path for r in txt.discover_inputs(spark, f"{tmpdir_path}/in", strict=False).collect()}
    assert seen == ["", "/A", "/B", "/C"]
    assert got["C"] is None and got["A"].endswith("/in/A/x.fastq") and set(got) == {"A", "B", "C"}
    seen.clear()
    monkeypatch.setattr(fq, "_children", lambda f, p: seen.append(p.rsplit("/in", 1)[1]) or children(f, p))
    files = fq._list_files([f"{tmpdir_path}/in/[AB]/*.fastq"])
    assert [f.rsplit("/in", 1)[1] for f, _ in files] == ["/A/x.fastq", "/B/x.fastq"] and sorted(seen) == ["", "/A", "/B"]
    seen.clear()
    files = fq._list_files([f"{tmpdir_path}/in/{{A,B/Split_files}}/{{x,deep1/y}}.fastq"])
    assert sorted(f.rsplit("/in", 1)[1] for f, _ in files) == ["/A/x.fastq", "/B/Split_files/deep1/y.fastq"]
    with pytest.raises(FileNotFoundError):
        fq._list_files([f"{tmpdir_path}/in/*/none*.fastq"])


# --- mates ------------------------------------------------------------------------

def mates(n, seed=1):
    rnd = random.Random(seed)
    text = lambda: "".join(rnd.choice("ACGT") for _ in range(rnd.randint(1, 60)))
    return ([(f"@r{i} 1", s, "+", "I" * len(s)) for i, s in ((i, text()) for i in range(n))],
            [(f"@r{i} 2", s, "+", "#" * len(s)) for i, s in ((i, text()) for i in range(n))])


def paired(one, two):
    seq = {r[0].split()[0][1:]: r[1] for r in two}
    return sorted((i, r[1], seq[i]) for r in one if (i := r[0].split()[0][1:]) in seq)


@pytest.mark.parametrize("split", [100, 1000, 1 << 20])
@pytest.mark.parametrize("kind", ["even", "missing", "swapped", "short", "none"])
def test_mates_by_place(spark, tmpdir_path, split, kind):
    from seqtally.sources.mates import pair_mate_files
    one, two = mates(200)
    if kind == "missing":
        del two[60], one[150]
    elif kind == "swapped":
        two[10], two[90] = two[90], two[10]
    elif kind == "short":
        del two[120:]
        one = one[5:]
    elif kind == "none":
        two = []
    files = [put(f"{tmpdir_path}/S/m_{i}.fastq", text_of(r)) for i, r in ((1, one), (2, two))]
    got = pair_mate_files(spark, *files, split_bytes=split).collect()
    assert sorted((r.read_id, r.sequence_1, r.sequence_2) for r in got) == paired(one, two)
    assert {r.sample for r in got} <= {"S"}


def test_few_records_are_left_over_where_files_are_out_of_step(spark, tmpdir_path, monkeypatch):
    """A record that one file lacks shifts all behind it: each task leaves over as
    many records as the shift, not its whole part; what lies too far apart is left
    to the join."""
    from seqtally.sources import mates as M
    one, two = mates(3000, 6)
    del two[500], two[1700], one[2500]
    files = [put(f"{tmpdir_path}/S/m_{i}.fastq", text_of(r)) for i, r in ((1, one), (2, two))]
    rows = M.read_mates(spark, *files, split_bytes=20_000, by_id=True)
    tasks = rows.rdd.getNumPartitions()
    single = rows.filter("header_1 IS NULL OR header_2 IS NULL").count()
    assert tasks > 8 and single <= 4 * tasks + 3
    assert rows.count() - single > 2900
    got = M.pair_mate_files(spark, *files, split_bytes=20_000).collect()
    assert sorted((r.read_id, r.sequence_1, r.sequence_2) for r in got) == paired(one, two)
    parts = M.paired_parts([list(r) for r in spark.read.format("fastq_index").option("splitBytes", "20000").load(files).collect()],
                           files[:1], files[1:])
    for ahead in (0, 1, 5):
        monkeypatch.setattr(M, "AHEAD", ahead)
        seen = [r for p in parts for b in M._with_mates(p) for r in b.to_pylist()]
        for i, recs in ((1, one), (2, two)):
            assert sorted(r[f"header_{i}"] for r in seen if r[f"header_{i}"]) == sorted(r[0] for r in recs)
        assert all(r["header_1"].split()[0] == r["header_2"].split()[0] for r in seen if r["header_1"] and r["header_2"])


def test_sequences_of_mates_are_not_shuffled(spark, tmpdir_path):
    """Several files, one of them block-gzip; mates in step pass no exchange."""
    from seqtally.sources.mates import pair_mate_files, read_mates
    want, files = [], ([], [])
    for k, n in enumerate((120, 0, 75)):
        one, two = mates(n, k)
        want += paired(one, two)
        files[0].append(put(f"{tmpdir_path}/S{k}/a.fastq", text_of(one)))
        files[1].append(put(f"{tmpdir_path}/S{k}/b.fastq.gz", blocked(text_of(two).encode(), 300)))
    df = pair_mate_files(spark, *files, split_bytes=700)
    assert sorted((r.read_id, r.sequence_1, r.sequence_2) for r in df.collect()) == sorted(want)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Union") < plan.index("Join")
    together = plan[plan.index("Union"):plan.index("Join")]
    assert "Relation" in together and "Exchange" not in together and "Aggregate" not in together
    rows = read_mates(spark, *files, split_bytes=700).orderBy("file", "number").collect()
    assert [r.number for r in rows] == [*range(120), *range(75)]
    with pytest.raises(ValueError, match="3 forward files, but 1"):
        read_mates(spark, files[0], files[1][0])


# --- numbering ------------------------------------------------------------------------

@pytest.mark.parametrize("split", ["40", "1000", "1m"])
def test_library_numbers_without_a_sort(spark, tmpdir_path, split):
    from seqtally.sources.text import read_barcodes
    want = []
    for f, n in (("a.txt", 120), ("b.txt", 0), ("c.txt", 55)):
        rows = [(f, f"g{i}", f"AC{i}") for i in range(n)]
        put(f"{tmpdir_path}/lib/{f}", "\n\n".join(f"{g}:{b}" for _, g, b in rows) + "\n \n")
        want += rows
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        df = read_barcodes(spark, f"{tmpdir_path}/lib")
        got = sorted((r.ord, r.barcode_set, r.gene, r.barcode) for r in df.collect())
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
    assert got == [(i, *row) for i, row in enumerate(want)]
    assert "rangepartitioning" not in plan and "ExistingRDD" not in plan


# --- small parts ----------------------------------------------------------------------

@pytest.mark.parametrize("gz", [False, True])
def test_a_part_reads_little_more_than_its_bytes(tmpdir_path, monkeypatch, gz):
    """Parts of 20,000 bytes of a long file, and lines longer than what is read
    behind a part."""
    one, _ = mates(20_000)
    one[7] = ("@long", "ACGT" * 20_000, "+", "I" * 80_000)
    text = text_of(one).encode()
    path = put(f"{tmpdir_path}/S/a.fastq" + ".gz" * gz, blocked(text) if gz else text_of(one))
    read = []
    for kind in (framing.Stream, framing.Blocks):
        old = kind.read
        monkeypatch.setattr(kind, "read", lambda self, old=old: read.append(old(self)) or read[-1])
    parts = fq.file_ranges([path], 20_000)
    ids = [h for p in parts for b in fq._record_batches(p) for h in b.column("header").to_pylist()]
    assert ids == [r[0] for r in one]
    assert sum(map(len, read)) < (4 if gz else 2) * len(text) + 10 ** 6


def test_small_parts_share_tasks(spark, tmpdir_path):
    from seqtally.sources.text import read_text_lines
    one, two = mates(4000)
    del two[1000]
    files = [put(f"{tmpdir_path}/S/m_{i}.fastq", text_of(r)) for i, r in ((1, one), (2, two))]
    parts = fq.file_ranges(files[:1], 500)
    tasks = fq.in_tasks(parts)
    assert len(parts) > 500 and len(tasks) <= fq.TASKS + 1
    assert [r for t in tasks for r in t.parts] == parts
    assert [t.parts for t in fq.in_tasks(parts[:fq.TASKS])] == [[r] for r in parts[:fq.TASKS]]
    lines = read_text_lines(spark, files[0], 500)
    assert lines.rdd.getNumPartitions() <= fq.TASKS + 1 and sorted(r.value for r in lines.collect()) == sorted(x for r in one for x in r)
    full = fq.read_fastq_full(spark, files[0], 500)
    assert full.rdd.getNumPartitions() <= fq.TASKS + 1 and sorted(r.header for r in full.collect()) == sorted(r[0] for r in one)
    from seqtally.sources.mates import pair_mate_files, read_mates
    assert read_mates(spark, *files, split_bytes=500).rdd.getNumPartitions() <= fq.TASKS + 2
    got = pair_mate_files(spark, *files, split_bytes=500).collect()
    assert sorted((r.read_id, r.sequence_1, r.sequence_2) for r in got) == paired(one, two)
    rows = read_mates(spark, *files, split_bytes=500).orderBy("number").collect()
    assert [r.header_1 for r in rows] == [r[0] for r in one] and [r.header_2 for r in rows if r.header_2] == [r[0] for r in two]


def test_files_are_joined_in_order(spark, tmpdir_path):
    spark.range(1000).orderBy("id").selectExpr("cast(id AS string) AS value").write.text(f"{tmpdir_path}/parts")
    fq.join_files(spark, f"{tmpdir_path}/parts", f"{tmpdir_path}/to/one.txt")
    assert open(f"{tmpdir_path}/to/one.txt").read().split() == [str(i) for i in range(1000)]
