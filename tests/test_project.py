"""A whole project run from files, as the reference is used."""

import glob
import os

from seqtally.plans.project import run_project


def test_run_project(spark, tmpdir_path):
    root = tmpdir_path
    reads = {"S1": [("r1", "AAACGTAA"), ("r2", "CCGGGGCC"), ("r3", "TTTTTTTT")],
             "S2": [("q1", "ACGTGGGG"), ("q2", "AAAAAAAA")],
             "S3": [("z1", "ACGT")]}
    for s, rs in reads.items():
        os.makedirs(f"{root}/Input/{s}")
        with open(f"{root}/Input/{s}/run.fastq", "w") as f:
            for rid, seq in rs:
                f.write(f"@{rid}\n{seq}\n+\n{'I' * len(seq)}\n")
    # leftovers and strangers that must not count: a split file that sorts
    # before the reads, an unlisted folder without FASTQ, an empty folder
    os.makedirs(f"{root}/Input/S1/Split_files")
    open(f"{root}/Input/S1/Split_files/a.fastq", "w").write("@x\nACGTACGT\n+\nIIIIIIII\n")
    os.makedirs(f"{root}/Input/notes")
    open(f"{root}/Input/notes/readme.txt", "w").write("hello")
    os.makedirs(f"{root}/Input/empty")
    os.makedirs(f"{root}/Barcodes")
    open(f"{root}/Barcodes/libA.txt", "w").write("gA:acgt\ngB:GGGG\ngC:CCCC\n")
    open(f"{root}/Barcodes/libB.txt", "w").write("hA:TTTT\n")
    open(f"{root}/project.txt", "w").write(
        "# sample,barcode file\nS1,libA.txt\nS1,libB.txt\nS2,libA.txt\nS9,libA.txt\n\n")
    res = run_project(spark, f"{root}/Input", f"{root}/project.txt", f"{root}/Barcodes",
                      f"{root}/Output", with_ids=True)
    got = {(r.sample, r.barcode_set, r.gene): (r.read_counts, r.rpm)
           for r in res["counts"].collect()}
    assert got[("S1", "libA.txt", "gA")] == (1, 5e5)
    assert got[("S1", "libA.txt", "gB")] == (1, 5e5)
    assert got[("S1", "libA.txt", "gC")] == (0, 0.0)
    assert got[("S1", "libB.txt", "hA")] == (1, 1e6)
    assert got[("S2", "libA.txt", "gA")] == (1, 1e6)
    st = {(r.sample, r.barcode_set): (r.total_reads, r.detected_reads)
          for r in res["stats"].collect()}
    assert st == {("S1", "libA.txt"): (3, 2), ("S1", "libB.txt"): (3, 1), ("S2", "libA.txt"): (2, 1),
                  ("S9", "libA.txt"): (0, 0)}
    assert got[("S9", "libA.txt", "gA")] == (0, 0.0)
    assert {(r.sample, r.barcode_set, r.gene): r.ids for r in res["chunks"].collect()}[("S1", "libA.txt", "gA")] == ["r1"]
    rep = {(r.side, r.sample) for r in res["samples"].collect()}
    assert rep == {("manifest_only", "S9"), ("input_only", "S3"), ("input_only", "notes"), ("input_only", "empty")}
    csvs = glob.glob(f"{root}/Output/counts/barcode_set=libA.txt/sample=S1/*.csv")
    assert csvs and open(csvs[0]).readline().strip() == "Gene,Barcode,Read_counts,RPM"
    txt = "".join(open(f).read() for f in
                  glob.glob(f"{root}/Output/stats/barcode_set=libB.txt/sample=S1/*.txt"))
    assert txt.startswith("Total read: 3\nDetected read: 1\n")
    assert os.path.isdir(f"{root}/Output/chunks")


def test_listed_folder_without_fastq_is_an_error(spark, tmpdir_path):
    import pytest
    root = tmpdir_path
    for s in ("S1", "S2"):
        os.makedirs(f"{root}/Input/{s}/deeper")
        open(f"{root}/Input/{s}/deeper/r.fastq", "w").write("@r\nACGT\n+\nIIII\n")
    os.makedirs(f"{root}/Barcodes")
    open(f"{root}/Barcodes/lib.txt", "w").write("g:ACGT\n")
    open(f"{root}/project.txt", "w").write("S1,lib.txt\n")
    with pytest.raises(ValueError, match="S1$"):
        run_project(spark, f"{root}/Input", f"{root}/project.txt", f"{root}/Barcodes", f"{root}/Output")


def test_ten_thousand_sample_folders(spark, tmpdir_path):
    root = tmpdir_path
    for i in range(10_001):
        os.makedirs(f"{root}/Input/s{i}")
    open(f"{root}/Input/s5/r.fastq", "w").write("@r\nACGT\n+\nIIII\n")
    os.makedirs(f"{root}/Barcodes")
    open(f"{root}/Barcodes/lib.txt", "w").write("g:ACGT\n")
    open(f"{root}/project.txt", "w").write("s5,lib.txt\n")
    res = run_project(spark, f"{root}/Input", f"{root}/project.txt", f"{root}/Barcodes", f"{root}/Output")
    assert [(r.sample, r.read_counts) for r in res["counts"].collect()] == [("s5", 1)]
    assert res["samples"].count() == 10_000
