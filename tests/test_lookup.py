"""Barcodes looked up in batches: the rows of the seed join."""

import random

import pytest

from conftest import library_df, reads_df
from seqtally.operators import counts as C
from seqtally.operators import lookup, match
from seqtally.plans.counting import barcode_counts, barcode_stats


def inputs(spark, seed, lengths):
    rnd = random.Random(seed)
    text = lambda n: "".join(rnd.choice("ACGT") for _ in range(n))
    lib = [(f"g{i}", text(rnd.choice(lengths))) for i in range(80)]
    reads = [(f"r{i}", text(rnd.randrange(40)) + rnd.choice(["", "N", "n", "é", lib[i % 80][1]]) + lib[i % 7][1] * (i % 3) + text(rnd.randrange(30)))
             for i in range(300)] + [("e", ""), ("low", lib[0][1].lower()), ("z", None)]
    lib = library_df(spark, lib[:50]).unionByName(library_df(spark, lib[30:], "M"))
    return (reads_df(spark, reads[:200], "S").unionByName(reads_df(spark, reads[200:], None))).repartition(3).cache(), lib


def results(reads, lib):
    rows = lambda df: sorted(map(str, (tuple(r) for r in df.collect())))
    man = reads.sparkSession.createDataFrame([("S", "L"), ("S", "M"), ("T", "M")], "sample string, barcode_set string")
    both = match.first_and_all(reads, lib).filter("ord IS NOT NULL")
    key = ["sample", "read_key", "barcode_set"]
    return {
        "first": rows(match.assign_first_match(reads, lib, carry=("read_id",))),
        "listed": rows(match.assign_first_match(reads, lib, man)),
        "all": rows(match.match_all(reads, lib, carry=("read_id",))),
        "outcomes": rows(match.read_outcomes(reads, lib)),
        "any case": rows(match.read_outcomes(reads, lib, ignore_case=True)),
        "counts": rows(C.count_matched(match.match_counts(reads, lib))),
        "all counts": rows(C.count_matched(match.match_counts(reads, lib, every=True))),
        "matched": rows(match.matched_reads(reads, lib, carry=("read_id",)).filter("ord IS NOT NULL")),
        "matched counts": rows(C.count_matched(match.matched_reads(reads, lib, man, every=True))),
        "by read": rows(C.count_barcodes_per_read(match.match_numbers(reads, lib, carry=("read_id",)))),
        "first of both": rows(both.filter("coalesce(first, true)").groupBy(key).agg({"ord": "min"})),
        "all of both": rows(C.count_matched(both.filter("NOT coalesce(first, false)"))),
        "totals": rows(C.count_matched(match.first_and_all(reads, lib).filter("ord IS NULL"))),
        "lines": rows(C.count_lines_matching(reads.selectExpr("read_key AS line_key", "sequence AS value"), lib)),
        "rpm": rows(barcode_counts(reads, lib, man)), "stats": rows(barcode_stats(reads, lib, man)),
    }


@pytest.mark.parametrize("lengths", [[3, 4, 5], [1, 6, 12, 25, 31]])
def test_lookup_gives_the_rows_of_the_seed_join(spark, monkeypatch, lengths):
    reads, lib = inputs(spark, sum(lengths), lengths)
    assert lookup.lookup_of(lib) is None
    want = results(reads, lib)
    monkeypatch.setattr(lookup, "LEAST", 1)
    # several pieces of a batch, several batches out of one, several flushes
    for name, value in (("LETTERS", 700), ("ROWS", 50), ("HELD", 100)):
        monkeypatch.setattr(lookup, name, value)
    assert lookup.lookup_of(lib) is not None
    got = results(reads, lib)
    for name in want:
        assert got[name] == want[name], name
    assert want["all"] and len(want["outcomes"]) == 303


def test_what_is_not_looked_up(spark, monkeypatch):
    monkeypatch.setattr(lookup, "LEAST", 1)
    for other in ("ACGTN", "AC[GT]A", "A" * 32):
        assert lookup.lookup_of(library_df(spark, [("g", "ACGT"), ("h", other)])) is None
    lib = library_df(spark, [("g", "ACGT"), ("h", "ACGTA")])
    assert lookup.lookup_of(lib) is not None and lookup.lookup_of(lib.unionByName(lib)) is None
    monkeypatch.setattr(lookup, "TABLES", 1)
    assert lookup.lookup_of(lib) is None


def test_a_dense_library_leaves_no_row_for_a_position(spark):
    """All 4,096 texts of 6 letters: a row for each read, no generated positions."""
    from itertools import product
    lib = spark.createDataFrame([("L", i, "g", "".join(t)) for i, t in enumerate(product("ACGT", repeat=6))],
                                "barcode_set string, ord long, gene string, barcode string")
    reads = reads_df(spark, [("a", "ACGTTGCAAC" * 9), ("b", "ACGTN")])
    hits = match.assign_first_match(reads, lib)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan
    assert [(r.read_key, r.ord) for r in hits.collect()] == [(0, min(int(s.translate(str.maketrans("ACGT", "0123")), 4)
            for s in (("ACGTTGCAAC" * 9)[i:i + 6] for i in range(85))))]


PATTERNS = ["AC[GT]TA", "ACGT.A", ".CAGT", "GTTC.", "A.C.G", "..TTA", "ACC{2}G+TCA", "(ACGTA|TTGCA)G", "(CCGTA|TAGCA).T",
            "(GGTTC|GATTC)[AG]?C", "TAGC?A{1,3}GG", "ACG\\wTTGAC", "CATG(A|.)C+?T", "GGATCCAT(?=A)", "(CA){2,}GGT", "TTAC"]


def pattern_inputs(spark):
    rnd = random.Random(7)
    text = lambda n: "".join(rnd.choice("ACGT") for _ in range(n))
    planted = ["ACC" + "G" * n + "TCA" for n in (0, 1, 2, 9, 30, 40)] + ["ACCC" + "G" * n + "TCA" for n in (1, 8, 40)] + [
        "ACGT" + c + "A" for c in "NnAé\n\r \u0085\U0001F9EC"] + ["GTTC", "GTTCé", "é\u0085CAGT", " CAGT", "CACACACAGGT" * 2] + [
        "ANC\nG", "ANCxG", "CATGéCCCCT", "GGATCCATA", "GGATCCATC", "ACG_TTGAC", "NNTTA", "\nNTTA"]
    reads = [(f"r{i}", text(rnd.randrange(25)) + planted[i % len(planted)] + text(rnd.randrange(25))) for i in range(400)]
    reads += [(f"s{i}", t) for i, t in enumerate(planted)] + [("e", ""), ("z", None)]
    return reads_df(spark, reads[:300]).unionByName(reads_df(spark, reads[300:], None)).repartition(3).cache()


@pytest.mark.parametrize("kept", [16, 12])
def test_patterns_that_are_looked_up_give_the_rows_of_the_seed_join(spark, monkeypatch, kept):
    """With dots, runs longer than those written out, and patterns to be tested."""
    reads = pattern_inputs(spark)
    rows = [(f"g{i}", p) for i, p in enumerate(PATTERNS[:kept] * (kept == 16) or [p for p in PATTERNS if "\\" not in p and "(?" not in p])]
    lib = library_df(spark, rows[::-1]).unionByName(library_df(spark, rows, "M"))
    found = lambda: {k: v for k, v in results(reads, lib).items()}
    want = found()
    monkeypatch.setattr(lookup, "LEAST", 1)
    for name, value in (("LETTERS", 700), ("ROWS", 50)):
        monkeypatch.setattr(lookup, name, value)
    assert lookup.lookup_of(lib) is None and lookup.pattern_lookup_of(lib) is not None
    got = found()
    for name in want:
        assert got[name] == want[name], name
    assert want["first"] and len(want["outcomes"]) == reads.count()


def test_patterns_that_are_not_looked_up(spark, monkeypatch):
    assert lookup.pattern_lookup_of(library_df(spark, [("g", "AC[GT]A")])) is None
    monkeypatch.setattr(lookup, "LEAST", 1)
    for other in ("ACGTN[AG]", "A.*", "A" * 31 + "[AG]", "^ACGT|.", "[^A]C"):
        assert lookup.pattern_lookup_of(library_df(spark, [("g", "ACGT"), ("h", other)])) is None, other


def test_a_dense_library_of_patterns_makes_no_row_for_a_pattern(spark):
    """1,500 patterns of equal beginnings: a read meets the texts, each once, and is
    not joined or shuffled, however small the broadcast bound of the seeds."""
    from itertools import product
    lib = library_df(spark, [("g", "".join(t) + ".T") for t in product("ACGT", repeat=5)]
                     + [("h", "".join(t) + "[AC][AG]?G") for t in product("ACGT", repeat=5)])
    hits = match.assign_first_match(reads_df(spark, [("a", "ACGTTGCAAC" * 9), ("b", "ACGTNNT"), ("c", "ACGTANT")]), lib)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan and "Exchange" not in plan.split("MapInArrow")[0]
    assert [r.read_key for r in hits.collect()] == [0, 2]


def test_tables_take_no_more_than_they_are_said_to():
    """5.4 million barcodes fit the broadcast bound: a library of short and long ones
    is not left to the shuffled join, where each position meets the short ones."""
    import pickle

    import numpy as np
    import pyarrow as pa
    rnd = np.random.default_rng(1)
    texts = {"".join(t) for t in np.array(list("ACGT"))[rnd.integers(0, 4, (200_000, 22))]}
    library = pa.table({"barcode_set": ["L"] * (len(texts) - 1) + [None], "ord": np.arange(len(texts)), "barcode": sorted(texts)})
    assert len(pickle.dumps(lookup.Lookup(library))) <= lookup.ENTRY_BYTES * len(texts)
    assert 5_421_504 * lookup.ENTRY_BYTES <= lookup._util.BROADCAST_BYTES
