"""Length windows, flanks, comparison, manifests, indexing, sinks."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from conftest import library_df, reads_df
from seqtally.functions.sequence import (DOWNSTREAM_FLANK, UPSTREAM_FLANK,
                                         reverse_complement)
from seqtally.operators.compare import (column_stats, compare_counts,
                                        drop_upper_outliers, zscore)
from seqtally.operators.flank import distinct_barcodes, extract_barcodes, flank_stats
from seqtally.operators.index import with_index
from seqtally.operators.reshape import (length_windows, orphan_mates, pair_mates,
                                        reconcile_samples, relabel_samples,
                                        split_by_length)
from seqtally.sources.text import (discover_inputs, parse_manifest_lines,
                                   read_barcodes, read_key_values)


def test_length_windows(spark):
    lens = [193, 194, 195, 196, 267, 269, 270, 277, 279, 280]
    reads = reads_df(spark, [(f"r{n}", "A" * n) for n in lens])
    got = {(len(r.sequence), r.fragment)
           for r in split_by_length(reads, length_windows(spark)).collect()}
    assert got == {(193, "F3"), (194, "F3"), (195, "F3"), (267, "F2"), (269, "F2"),
                   (277, "F1"), (279, "F1")}


def test_overlapping_windows_send_a_read_to_both(spark):
    reads = reads_df(spark, [("r", "A" * 100)])
    w = length_windows(spark, [("X", 100), ("Y", 101)], tolerance=1)
    assert sorted(r.fragment for r in split_by_length(reads, w).collect()) == ["X", "Y"]


def test_flanks(spark):
    mid30 = "ACGTACGTACGTACGTACGTACGTACGTAC"
    rows = [
        ("exact", "GG" + UPSTREAM_FLANK + mid30 + DOWNSTREAM_FLANK + "TT"),
        ("mixed", UPSTREAM_FLANK.lower() + mid30.lower() + DOWNSTREAM_FLANK),
        ("29", UPSTREAM_FLANK + mid30[:29] + DOWNSTREAM_FLANK),
        ("31", UPSTREAM_FLANK + mid30 + "A" + DOWNSTREAM_FLANK),
        ("two", UPSTREAM_FLANK + mid30 + DOWNSTREAM_FLANK
         + UPSTREAM_FLANK + "T" * 30 + DOWNSTREAM_FLANK),
    ]
    ext = extract_barcodes(reads_df(spark, rows))
    got = {r.read_id: r.barcode for r in ext.collect()}
    assert got == {"exact": mid30, "mixed": mid30.lower(), "29": None, "31": None, "two": mid30}
    s = flank_stats(ext).collect()[0]
    assert (s.total_reads, s.detected_reads, s.detection_rate) == (5, 3, 0.6)
    assert sorted(r.barcode for r in distinct_barcodes(ext).collect()) == sorted(
        {mid30, mid30.lower()})


def test_reverse_complement_iupac(spark):
    df = spark.createDataFrame([("ACGTNacgtnRYKM",)], "s string")
    assert df.select(reverse_complement("s")).first()[0] == "KMRYnacgtNACGT"


def test_compare_chain(spark):
    src = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 3.0), ("c", 4.0)], "key string, value double")
    dst = spark.createDataFrame([("a", 10.0), ("c", 30.0), ("c", 31.0)], "key string, value double")
    j = compare_counts(src, dst)
    rows = sorted([(r.key, r.focused, r.whole) for r in j.collect()], key=str)
    assert rows == [("a", 1.0, 10.0), ("b", 2.0, None), ("c", 3.0, 30.0), ("c", 3.0, 31.0),
                    ("c", 4.0, 30.0), ("c", 4.0, 31.0)]
    uniq = compare_counts(src.filter("value < 4"), dst.filter("value < 31"))
    assert sorted((r.key, r.focused, r.whole) for r in uniq.collect()) == [
        ("a", 1.0, 10.0), ("b", 2.0, None), ("c", 3.0, 30.0)]
    cut = drop_upper_outliers(j, "whole")
    assert cut.filter(F.col("whole").isNull()).count() == 0
    z = zscore(spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, y double"), ["x", "y"])
    assert sorted((r.x, r.y) for r in z.collect()) == [(-0.7071067811865475, None),
                                                       (0.7071067811865475, None)]
    s = column_stats(spark.createDataFrame([(1.0,), (3.0,)], "x double"), ["x"]).first()
    assert (s.mean_x, round(s.std_x, 12)) == (2.0, round(2 ** 0.5, 12))


def test_manifest_lines(spark):
    lines = spark.createDataFrame(
        [("# comment",), ("",), ("s1,libA",), ("s2,libB,extra\n",), ("lonely",), ("s3,libC\r\n",)],
        "value string")
    got = sorted((r.sample, r.barcode_set) for r in parse_manifest_lines(lines).collect())
    assert got == [("lonely", None), ("s1", "libA"), ("s2", "libB"), ("s3", "libC")]


def test_reconcile(spark):
    m = spark.createDataFrame([("a",), ("b",), ("b",)], "sample string")
    i = spark.createDataFrame([("b",), ("c",)], "sample string")
    got = sorted((r.side, r.sample) for r in reconcile_samples(m, i).collect())
    assert got == [("input_only", "c"), ("manifest_only", "a")]


def test_mates_and_routing(spark):
    r1 = spark.createDataFrame([("S", "x", "AC"), ("S", "y", "GG")], "sample string, read_id string, sequence string")
    r2 = spark.createDataFrame([("S", "x", "TT"), ("S", "z", "CC")], "sample string, read_id string, sequence string")
    assert [(r.read_id, r.sequence_1, r.sequence_2) for r in pair_mates(r1, r2).collect()] == [("x", "AC", "TT")]
    assert sorted((r.side, r.read_id) for r in orphan_mates(r1, r2).collect()) == [("R1", "y"), ("R2", "z")]
    reads = spark.createDataFrame([("f1", "F1", 1), ("f1", "F2", 2), ("f2", "F1", 3)],
                                  "source string, fragment string, read_key long")
    routing = spark.createDataFrame([("f1", "F1", "s_a"), ("f2", "F1", "s_b")],
                                    "source string, fragment string, sample string")
    got = sorted((r.read_key, r.sample) for r in relabel_samples(reads, routing).collect())
    assert got == [(1, "s_a"), (3, "s_b")]


def test_pair_mates_repeated_ids_pair_by_occurrence(spark):
    cols = "sample string, read_id string, read_key long, sequence string"
    r1 = spark.createDataFrame([("S", "d", 1, "A1"), ("S", "d", 5, "A2"), ("S", "d", 9, "A3"),
                                ("S", "u", 2, "U1")], cols)
    r2 = spark.createDataFrame([("S", "d", 3, "B1"), ("S", "d", 4, "B2"), ("S", "u", 7, "V1")], cols)
    got = sorted((r.read_id, r.sequence_1, r.sequence_2) for r in pair_mates(r1, r2, by_occurrence=True).collect())
    assert got == [("d", "A1", "B1"), ("d", "A2", "B2"), ("u", "U1", "V1")]


def test_occurrence_hot_key(spark):
    from seqtally.operators.index import occurrence
    df = spark.range(0, 3000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id"))
    got = occurrence(df, ["k"], ["id"]).filter("k = 'hot'").orderBy("id").collect()
    assert [r.occ for r in got] == list(range(1000))


def test_with_index_is_dense(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5000).alias("v"))
    got = with_index(df, ["v"]).collect()
    assert sorted((r.idx, r.v) for r in got) == [(i, i) for i in range(5000)]


def test_read_barcodes_file_order(spark, tmpdir_path):
    p = f"{tmpdir_path}/lib.txt"
    with open(p, "w") as f:
        f.write("g1:ACGT\n\ng2:ttga:extra\ng3:ACGT\n")
    lib = read_barcodes(spark, p, barcode_set="L").orderBy("ord").collect()
    assert [(r.ord, r.gene, r.barcode) for r in lib] == [(0, "g1", "ACGT"), (1, "g2", "ttga"),
                                                         (2, "g3", "ACGT")]


def test_key_values_and_discover(spark, tmpdir_path):
    p = f"{tmpdir_path}/kv.txt"
    with open(p, "w") as f:
        f.write("a:1\nb:2.5\n")
    assert [(r.key, r.value) for r in read_key_values(spark, p).collect()] == [("a", 1.0), ("b", 2.5)]
    root = f"{tmpdir_path}/in"
    for s, names in {"s1": ["b.fastq", "a.fq.gz", "x.txt"], "s2": ["z.fq"], "s3": ["n.txt"], "s4": [],
                     "s1/Split_files": ["a.fastq"], "s3/deeper": ["nested.fastq"]}.items():
        os.makedirs(f"{root}/{s}")
        for n in names:
            open(f"{root}/{s}/{n}", "w").write("x")
    with pytest.raises(ValueError, match="s3"):
        discover_inputs(spark, root)
    got = {r.sample: r.path and os.path.basename(r.path)
           for r in discover_inputs(spark, root, strict=False).collect()}
    assert got == {"s1": "a.fq.gz", "s2": "z.fq", "s3": None, "s4": None}
    only = spark.createDataFrame([("s1",), ("s2",), ("absent",)], "sample string")
    assert discover_inputs(spark, root, samples=only).count() == 4
    with pytest.raises(ValueError, match="s4"):
        discover_inputs(spark, root, samples=spark.createDataFrame([("s4",)], "sample string"))


def test_sinks(spark, tmpdir_path):
    from seqtally.plans.counting import barcode_counts
    from seqtally.sinks import write_barcode_list, write_counts_csv, write_fastq
    reads = reads_df(spark, [("r1", "AACGTT"), ("r2", "GGGG")])
    c = barcode_counts(reads, library_df(spark, [("g", "ACGT"), ("h", "CCCC")]), barcode_set="L")
    write_counts_csv(c, f"{tmpdir_path}/counts")
    back = spark.read.option("header", True).csv(f"{tmpdir_path}/counts")
    assert back.columns == ["Gene", "Barcode", "Read_counts", "RPM", "sample"]
    assert sorted((r.sample, r.Gene, r.Read_counts) for r in back.collect()) == [
        ("S", "g", "1"), ("S", "h", "0")]
    recs = spark.createDataFrame([("@a", "ACGT", "+", "IIII", "F1")],
                                 "header string, sequence string, spacer string, quality string, fragment string")
    write_fastq(recs, f"{tmpdir_path}/fq", partition_by=("fragment",))
    files = glob.glob(f"{tmpdir_path}/fq/fragment=F1/*.txt")
    assert "".join(open(f).read() for f in files) == "@a\nACGT\n+\nIIII\n"
    write_barcode_list(spark.createDataFrame([("TT",), ("AA",)], "barcode string"), f"{tmpdir_path}/bl")
    got = sorted(tuple(r) for r in spark.read.csv(f"{tmpdir_path}/bl").collect())
    assert got == [("0", "AA"), ("1", "TT")]


def test_ids_and_chunks(spark):
    from seqtally.operators.counts import chunk_counts, fractional_counts, ids_by_barcode
    from seqtally.operators.match import assign_first_match
    reads = reads_df(spark, [("a", "AACGTT"), ("b", "GGGG"), ("c", "TTTT"), ("d", "ACGT")])
    lib = library_df(spark, [("g", "ACGT"), ("h", "GGGG"), ("z", "CCCC")])
    hits = assign_first_match(reads, lib, carry=("read_id",))
    assert sorted((r.chunk, r.gene, r.ids) for r in chunk_counts(hits, lib, 2).collect()) == [
        (0, "g", ["a"]), (0, "h", ["b"]), (1, "g", ["d"])]
    assert sorted((r.gene, r.ids) for r in chunk_counts(hits, lib).collect()) == [("g", ["a", "d"]), ("h", ["b"])]
    assert sorted((r.read_id, r.gene) for r in ids_by_barcode(hits, lib).collect()) == [("a", "g"), ("b", "h"), ("d", "g")]
    assert {r.share for r in fractional_counts(hits, lib).collect()} == {1.0}


def test_orphans_are_listed_as_often_as_they_occur(spark):
    cols = "sample string, read_id string"
    r1 = spark.createDataFrame([("S", "x"), ("S", "x"), ("S", "y"), ("S", None)], cols)
    r2 = spark.createDataFrame([("S", "y"), ("S", "z")], cols)
    df = orphan_mates(r1, r2)
    assert sorted((r.side, str(r.read_id)) for r in df.collect()) == [("R1", "None"), ("R1", "x"), ("R1", "x"), ("R2", "z")]
    assert "Join" not in df._jdf.queryExecution().executedPlan().toString()


def test_sample_counts_without_a_join(spark):
    from seqtally.operators.records import sample_counts
    m = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "sample string")
    i = spark.createDataFrame([("b",), ("c",), ("c",)], "sample string")
    df = sample_counts(m, i)
    assert tuple(df.first()) == (4, 2, 2)
    assert "Join" not in df._jdf.queryExecution().executedPlan().toString()
    assert tuple(sample_counts(m.limit(0), i.limit(0)).first()) == (0, 0, 0)


def test_stats_and_flank_text_sinks(spark, tmpdir_path):
    from seqtally.sinks import write_comparison_csv, write_hits_parquet, write_stats_text
    stats = spark.createDataFrame([("S", 4, 2, 0.5)], "sample string, total_reads long, detected_reads long, detection_rate double")
    write_stats_text(stats, f"{tmpdir_path}/st")
    txt = "".join(open(f).read() for f in glob.glob(f"{tmpdir_path}/st/sample=S/*.txt"))
    assert txt == "Total read: 4\nDetected read: 2\nDetection rate in the sequence pool: 0.5\n"
    fl = spark.createDataFrame([("/x/run1.fastq", 10, 0, None)],
                               "file string, total_reads long, detected_reads long, detection_rate double")
    write_stats_text(fl, f"{tmpdir_path}/fl", by="file")
    txt = "".join(open(f).read() for f in glob.glob(f"{tmpdir_path}/fl/*/*.txt"))
    assert txt.startswith("File: run1.fastq\nTotal read: 10\n") and txt.endswith("pool: nan\n")
    ch = spark.createDataFrame([("S", 0, "g", "ACGT", 2, ["r1", "r2"])],
                               "sample string, chunk long, gene string, barcode string, read_counts long, ids array<string>")
    write_hits_parquet(ch, f"{tmpdir_path}/hp")
    from seqtally.sources.text import read_counts_parquet
    back = read_counts_parquet(spark, f"{tmpdir_path}/hp").first()
    assert (back.sample, back.read_counts, back.ids) == ("S", 2, ["r1", "r2"])
    write_comparison_csv(spark.createDataFrame([("k", 1.0, None)], "key string, focused double, whole double"),
                         f"{tmpdir_path}/cmp")
    assert spark.read.option("header", True).csv(f"{tmpdir_path}/cmp").first().key == "k"


def test_split_by_length_list_windows(spark):
    reads = reads_df(spark, [("r", "A" * 50), ("s", "A" * 60)])
    got = [r.fragment for r in split_by_length(reads, [("X", 51)], tolerance=1).collect()]
    assert got == ["X"]


def test_synthetic_reads_and_library(spark):
    from seqtally.operators.library import prepare_library
    from seqtally.plans.counting import barcode_counts
    from seqtally.sources.synthetic import synthetic_library, synthetic_reads
    reads = synthetic_reads(spark, 50, read_len=30)
    assert reads.count() == 200
    lib = prepare_library(synthetic_library(spark))
    got = {r.gene: (r.read_counts, r.rpm)
           for r in barcode_counts(reads, lib, barcode_set="synthetic").collect()}
    assert got == {n: (50, 250000.0) for n in "ATGC"}


def test_text_lines_and_line_counts_sink(spark, tmpdir_path):
    from seqtally.sinks import write_line_counts_csv
    from seqtally.sources.text import read_barcode_list, read_text_lines
    p = f"{tmpdir_path}/t.txt"
    open(p, "w").write("ACGT\nGGGG\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    lines = read_text_lines(spark, p, block_bytes=4)
    assert sorted(r.value for r in lines.collect()) == ["ACGT", "GGGG"]
    assert lines.rdd.getNumPartitions() == 3 and read_text_lines(spark, p).rdd.getNumPartitions() == 1
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    write_line_counts_csv(spark.createDataFrame([("g", 3)], "name string, n long"),
                          f"{tmpdir_path}/lc")
    assert [tuple(r) for r in spark.read.csv(f"{tmpdir_path}/lc").collect()] == [("g", "3")]
    open(f"{tmpdir_path}/bl.csv", "w").write("0,AAA\n1,CCC\n")
    assert [(r.idx, r.barcode) for r in read_barcode_list(spark, f"{tmpdir_path}/bl.csv")
            .orderBy("idx").collect()] == [(0, "AAA"), (1, "CCC")]


def test_fallbacks_without_broadcast(spark, monkeypatch):
    """With nothing allowed to be broadcast, the joins run shuffled and give
    the same rows."""
    from seqtally.operators import _util
    from seqtally.operators.counts import count_hits, with_genes
    from seqtally.operators.match import assign_first_match

    reads = reads_df(spark, [(f"r{n}", "A" * n) for n in (193, 194, 268, 277)])
    routing = spark.createDataFrame([("S", "F1", "x"), ("S", "F3", "y")],
                                    "source string, fragment string, sample string")
    lib = library_df(spark, [("g", "AAAA"), ("h", "CCCC")])

    def run():
        split = split_by_length(reads, length_windows(spark))
        routed = relabel_samples(split.withColumnRenamed("sample", "source"), routing)
        genes = with_genes(count_hits(assign_first_match(reads, lib)), lib)
        return (sorted((r.read_id, r.fragment) for r in split.collect()),
                sorted((r.read_id, r.sample) for r in routed.collect()),
                sorted((r.gene, r.read_counts) for r in genes.collect()))
    before = run()
    monkeypatch.setattr(_util, "BROADCAST_BYTES", 0)
    assert run() == before
    assert before[0] == [("r193", "F3"), ("r194", "F3"), ("r268", "F2"), ("r277", "F1")]


def test_write_stats_csv(spark, tmpdir_path):
    from seqtally.sinks import write_stats
    stats = spark.createDataFrame([("S", "L", 4, 2, 0.5)],
                                  "sample string, barcode_set string, total_reads long, "
                                  "detected_reads long, detection_rate double")
    write_stats(stats, f"{tmpdir_path}/stats")
    back = spark.read.option("header", True).csv(f"{tmpdir_path}/stats").first()
    assert (back.sample, back.total_reads, back.detection_rate) == ("S", "4", "0.5")
