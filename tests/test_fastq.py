"""FASTQ readers: quality lines starting with '@' and '+', commas and quotes,
truncated and malformed records, gz, and every split size."""

import gzip
import os
import random

import pytest

from seqtally.functions.sequence import valid_fastq_record
from seqtally.sources.fastq import read_fastq, read_fastq_full


def make_records(n, seed=0):
    rnd = random.Random(seed)
    recs = []
    for i in range(n):
        seq = "".join(rnd.choice("ACGTN") for _ in range(rnd.randint(2, 90)))
        qual = "".join(rnd.choice('@+,"!#I5?_') for _ in range(len(seq)))
        if i % 7 == 0:
            qual = "@" + qual[1:]
        if i % 11 == 0:
            qual = "+" + qual[1:]
        recs.append((f"@read{i} desc {i}", seq, "+", qual))
    return recs


def write(path, recs, gz=False, tail=""):
    text = "".join(f"{h}\n{s}\n{p}\n{q}\n" for h, s, p, q in recs) + tail
    os.makedirs(os.path.dirname(path), exist_ok=True)
    if gz:
        with gzip.open(path, "wt") as f:
            f.write(text)
    else:
        with open(path, "w") as f:
            f.write(text)


@pytest.mark.parametrize("split", [64, 300, 4096, 1 << 20])
def test_full_record_source_every_split(spark, tmpdir_path, split):
    recs = make_records(400)
    p = f"{tmpdir_path}/S1/a.fastq"
    write(p, recs)
    got = read_fastq_full(spark, p, split_bytes=split).orderBy("offset").collect()
    assert [(r.header, r.sequence, r.spacer, r.quality) for r in got] == recs


@pytest.mark.parametrize("max_bytes", [128, 1000, 1 << 20])
def test_reads_every_split(spark, tmpdir_path, max_bytes):
    recs = make_records(300, seed=3)
    p = f"{tmpdir_path}/S1/a.fastq"
    write(p, recs)
    got = read_fastq(spark, p, split_bytes=max_bytes).collect()
    want = sorted((h[1:].split(" ")[0], s) for h, s, _, _ in recs)
    assert sorted((r.read_id, r.sequence) for r in got) == want
    assert {r.sample for r in got} == {"S1"}
    assert len({r.read_key for r in got}) == len(recs)


def test_gz_both_readers(spark, tmpdir_path):
    recs = make_records(120, seed=5)
    p = f"{tmpdir_path}/S2/b.fastq.gz"
    write(p, recs, gz=True)
    assert read_fastq(spark, p).count() == 120
    got = read_fastq_full(spark, p).orderBy("offset").collect()
    assert [(r.header, r.sequence, r.spacer, r.quality) for r in got] == recs


def test_truncated_last_record(spark, tmpdir_path):
    recs = make_records(10)
    p = f"{tmpdir_path}/S/t.fastq"
    write(p, recs, tail="@cut\nACGT\n")
    got = read_fastq_full(spark, p).orderBy("offset").collect()
    assert len(got) == 11
    last = got[-1]
    assert (last.header, last.sequence, last.spacer, last.quality) == ("@cut", "ACGT", None, None)
    v = read_fastq_full(spark, p).select(
        valid_fastq_record("header", "sequence", "spacer", "quality").alias("ok")).collect()
    assert sum(not r.ok for r in v) == 1


def test_validation_flags(spark, tmpdir_path):
    recs = [("@a", "ACGT", "+", "IIII"), ("@b", "ACGT", "+", "III"),
            ("@c", "ACGT", "+", "II~I"), ("@d", "ACGT", "+x", "IIII")]
    p = f"{tmpdir_path}/S/v.fastq"
    write(p, recs)
    df = read_fastq_full(spark, p).orderBy("offset")
    ok = [r.ok for r in df.select(valid_fastq_record("header", "sequence", "spacer",
                                                     "quality").alias("ok")).collect()]
    assert ok == [True, False, False, True]


def test_multiple_files_and_sample_dirs(spark, tmpdir_path):
    write(f"{tmpdir_path}/A/x.fastq", make_records(5, 1))
    write(f"{tmpdir_path}/B/y.fastq", make_records(7, 2))
    got = read_fastq(spark, tmpdir_path + "/*/*.fastq").groupBy("sample").count().collect()
    assert {r.sample: r["count"] for r in got} == {"A": 5, "B": 7}
    assert read_fastq_full(spark, [f"{tmpdir_path}/A", f"{tmpdir_path}/B"]).count() == 12


def test_validate_modes(spark, tmpdir_path):
    from seqtally.operators.records import validate_fastq
    recs = [("@a", "ACGT", "+", "IIII"), ("@b", "ACGT", "+", "III")]
    p = f"{tmpdir_path}/S/m.fastq"
    write(p, recs)
    df = read_fastq_full(spark, p)
    assert [r.header for r in validate_fastq(df, "DROP").collect()] == ["@a"]
    assert sorted((r.header, r.is_valid) for r in validate_fastq(df, "FLAG").collect()) == [
        ("@a", True), ("@b", False)]
    with pytest.raises(Exception, match="malformed FASTQ record: @b"):
        validate_fastq(df, "FAILFAST").collect()
    assert validate_fastq(df.filter("header = '@a'"), "FAILFAST").count() == 1
    assert validate_fastq(df.filter("header = '@a'"), "DROP", max_qual=39).count() == 0


def test_manifest_from_paths_reads_no_content(spark, tmpdir_path):
    from seqtally.sources.fastq import manifest_from_paths
    write(f"{tmpdir_path}/A/x.fastq", make_records(3, 1))
    write(f"{tmpdir_path}/B/y.fastq", make_records(2, 2))
    m = manifest_from_paths(spark, tmpdir_path + "/*/*.fastq", "L")
    assert sorted(tuple(r) for r in m.collect()) == [("A", "L"), ("B", "L")]
    plan = m._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1].split("\n")[0]


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(text)
    return path


def ids(df):
    return sorted(r.read_id for r in df.collect())


def test_malformed_records_fail_or_are_dropped(spark, tmpdir_path):
    good = make_records(20, seed=9)
    text = "".join(f"{h}\n{s}\n{q_}\n{q}\n" for h, s, q_, q in good[:10])
    text += "garbage line\nACGT\n+\nIIII\n"
    text += "".join(f"{h}\n{s}\n{q_}\n{q}\n" for h, s, q_, q in good[10:])
    p = put(f"{tmpdir_path}/S/bad.fastq", text)
    with pytest.raises(Exception, match="malformed FASTQ record: garbage line"):
        read_fastq(spark, p).collect()
    assert read_fastq(spark, p, mode="DROP").count() == 20


@pytest.mark.parametrize("bad", ["@r2\nGGGG\n-\nIIII\n", "@r2\nGGGG\n", "@r2\nGGGG\n+\n", "@r2\n+\nII\n", "+\nIIII\n",
                                 "@r2\nGGGG\n+\nII\n", "@r2\nGGGG\n+\n~~~~\n", "GGGG\n"])
def test_drop_keeps_every_valid_record(spark, tmpdir_path, bad):
    """Records with missing lines, other spacers, short or out-of-range
    qualities: the reference rejects them, their neighbours stay."""
    p = put(f"{tmpdir_path}/S/merged.fastq", "@r1\nACGT\n+\nIIII\n" + bad + "@r3\nTTTT\n+\nIIII\n@r4\nAAAA\n+r4\n@III\n")
    assert ids(read_fastq(spark, p, mode="DROP")) == ["r1", "r3", "r4"]
    with pytest.raises(Exception, match="malformed FASTQ record"):
        read_fastq(spark, p).collect()


@pytest.mark.parametrize("split", [40, 1 << 20])
def test_named_spacers_crlf_and_blank_lines(spark, tmpdir_path, split):
    p = put(f"{tmpdir_path}/S/named.fastq", "@r1 d\r\nACGT\r\n+r1 d\r\n@III\r\n@r2\r\nGGGG\r\n+r2\r\nIIII\r\n\r\n@r3\r\nAC\r\n+\r\nII\r\n\r\n")
    got = sorted((r.read_id, r.sequence) for r in read_fastq(spark, p, split_bytes=split).collect())
    assert got == [("r1", "ACGT"), ("r2", "GGGG"), ("r3", "AC")]


def test_no_read_is_made_of_a_quality_line(spark, tmpdir_path):
    p = put(f"{tmpdir_path}/S/nonl.fastq", "@r1\nACGT\n+\n@III\n@r2\nGGGG\n+\nIIII")
    assert ids(read_fastq(spark, p)) == ["r1", "r2"]
    p = put(f"{tmpdir_path}/T/cut.fastq", "@r1\nACG\n+\n@R2\n")
    assert ids(read_fastq(spark, p)) == ["r1"]


def test_read_keys_differ_between_scans(spark, tmpdir_path):
    from conftest import library_df
    from seqtally.plans.counting import barcode_counts
    a = put(f"{tmpdir_path}/S/a.fastq", "@r1\nACGTA\n+\nIIIII\n")
    b = put(f"{tmpdir_path}/x/S/b.fastq", "@r2\nACGTC\n+\nIIIII\n")
    both = read_fastq(spark, a).unionByName(read_fastq(spark, b))
    assert both.select("read_key").distinct().count() == 2
    assert barcode_counts(both, library_df(spark, [("g", "ACGT")])).first().read_counts == 2


def test_file_uri_paths(spark, tmpdir_path):
    recs = make_records(5, seed=4)
    write(f"{tmpdir_path}/U/u.fastq", recs)
    for p in (f"file:{tmpdir_path}/U", f"file://{tmpdir_path}/U/u.fastq"):
        got = read_fastq_full(spark, p).orderBy("offset").collect()
        assert [(r.header, r.sequence) for r in got] == [(h, s) for h, s, _, _ in recs]
