"""First-match assignment, counts and RPM (hand-written cases and a
comparison with a plain Python loop)."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import library_df, reads_df
from seqtally.functions.patterns import cover, facts, plain_texts
from seqtally.operators import _util, match
from seqtally.operators.match import assign_first_match, match_all, matched_reads, read_outcomes
from seqtally.plans.counting import barcode_counts, barcode_stats


def counts(spark, reads, lib):
    df = barcode_counts(reads_df(spark, reads), library_df(spark, lib), barcode_set="L")
    return {(r.gene, r.barcode): (r.read_counts, r.rpm) for r in df.collect()}


def loop_first_match(reads, lib):
    """The reference semantics: barcodes in file order, matched reads leave
    the pool; barcodes upper-cased, first of duplicates kept."""
    seen, order = set(), []
    for g, b in lib:
        b = b.upper()
        if b not in seen:
            seen.add(b)
            order.append((g, b))
    pool = dict(enumerate(reads))
    out = {}
    for g, b in order:
        hit = [k for k, (_, s) in pool.items() if b in s]
        out[(g, b)] = len(hit)
        for k in hit:
            del pool[k]
    return out


def test_first_row_wins_both_orders(spark):
    reads = [("r1", "TTACGTACCCGGGTT")]
    assert counts(spark, reads, [("g1", "ACGTAC"), ("g2", "CCCGGG")])[("g1", "ACGTAC")][0] == 1
    c = counts(spark, reads, [("g2", "CCCGGG"), ("g1", "ACGTAC")])
    assert c[("g2", "CCCGGG")][0] == 1 and c[("g1", "ACGTAC")][0] == 0


def test_nested_barcodes(spark):
    reads = [("r1", "GGACGTACGG"), ("r2", "GGACGTGG")]
    c = counts(spark, reads, [("short", "ACGT"), ("long", "ACGTAC")])
    assert c[("short", "ACGT")][0] == 2 and c[("long", "ACGTAC")][0] == 0
    c = counts(spark, reads, [("long", "ACGTAC"), ("short", "ACGT")])
    assert c[("long", "ACGTAC")][0] == 1 and c[("short", "ACGT")][0] == 1


def test_case_rules(spark):
    c = counts(spark, [("r1", "TTACGTTT"), ("r2", "ttacgttt")], [("g", "acgt")])
    assert c[("g", "ACGT")][0] == 1          # barcode upper-cased; lower-case read misses


def test_duplicate_barcodes_keep_first(spark):
    c = counts(spark, [("r1", "AAACGTAA")], [("g1", "ACGT"), ("g2", "ACGT"), ("g3", "acgt")])
    assert list(c) == [("g1", "ACGT")] and c[("g1", "ACGT")][0] == 1


def test_zero_rows_and_rpm(spark):
    c = counts(spark, [("r1", "AAACGTAA"), ("r2", "CCCC"), ("r3", "TTACGT")],
               [("g1", "ACGT"), ("g2", "GGGG")])
    assert c[("g1", "ACGT")] == (2, 1e6)
    assert c[("g2", "GGGG")] == (0, 0.0)
    # a sample without any hit: RPM 0, not NaN
    c = counts(spark, [("r1", "CCCC")], [("g1", "ACGT")])
    assert c[("g1", "ACGT")] == (0, 0.0)


def test_repeated_read_id_counted_twice(spark):
    c = counts(spark, [("same", "AACGTA"), ("same", "ACGTTT")], [("g", "ACGT")])
    assert c[("g", "ACGT")][0] == 2


def test_regex_barcode_and_one_row_library(spark):
    c = counts(spark, [("r1", "TTACTATT"), ("r2", "TTACGATT"), ("r3", "TTACCATT")],
               [("rx", "AC[GT]A")])
    assert c[("rx", "AC[GT]A")][0] == 2


def test_regex_mixed_with_literal(spark):
    c = counts(spark, [("r1", "TTACTATT"), ("r2", "GGGGGG")],
               [("lit", "GGGG"), ("rx", "AC[GT]A"), ("lit2", "ACTA")])
    assert c[("lit", "GGGG")][0] == 1 and c[("rx", "AC[GT]A")][0] == 1
    assert c[("lit2", "ACTA")][0] == 0


def test_empty_pool(spark):
    reads = spark.createDataFrame([], "sample string, read_key long, read_id string, sequence string")
    lib = library_df(spark, [("g", "ACGT")])
    assert assign_first_match(reads, lib).count() == 0
    assert barcode_stats(reads, lib).count() == 0
    assert barcode_counts(reads, lib).count() == 0
    man = spark.createDataFrame([("S", "L")], "sample string, barcode_set string")
    s = barcode_stats(reads, lib, man).first()
    assert (s.sample, s.total_reads, s.detected_reads, s.detection_rate) == ("S", 0, 0, None)


def test_stats_rate(spark):
    reads = reads_df(spark, [("a", "ACGTT"), ("b", "CCCC"), ("c", "GACGT"), ("d", "TT")])
    s = barcode_stats(reads, library_df(spark, [("g", "ACGT")])).first()
    assert (s.sample, s.barcode_set, s.total_reads, s.detected_reads, s.detection_rate) == ("S", "L", 4, 2, 0.5)


def test_only_set_of_the_library(spark):
    reads = reads_df(spark, [("a", "ACGTT")])
    lib = library_df(spark, [("g", "ACGT")])
    assert [(r.barcode_set, r.read_counts, r.rpm) for r in barcode_counts(reads, lib).collect()] == [("L", 1, 1e6)]
    two = lib.unionByName(library_df(spark, [("h", "GGGG")], "M"))
    with pytest.raises(ValueError, match="several"):
        barcode_counts(reads, two)
    assert [r.gene for r in barcode_counts(reads, two, barcode_set="M").collect()] == ["h"]


def test_empty_barcode_rejected(spark):
    with pytest.raises(ValueError):
        library_df(spark, [("g", "")]).count()


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_matches_python_loop(spark, seed):
    """Random reads and libraries with mixed barcode lengths (1..12), nested
    barcodes, overlapping hits and reads shorter than every barcode."""
    rnd = random.Random(seed)
    nt = "ACGT"
    reads = [(f"r{i}", "".join(rnd.choice(nt) for _ in range(rnd.randint(0, 40))))
             for i in range(300)]
    lib = []
    for i in range(60):
        n = rnd.choice([1, 2, 3, 4, 5, 6, 8, 10, 12]) if seed % 2 else rnd.choice([5, 6, 7, 9, 12])
        b = "".join(rnd.choice(nt) for _ in range(n))
        if lib and rnd.random() < 0.2:       # nested: extend an earlier barcode
            b = lib[rnd.randrange(len(lib))][1] + b[:2]
        if rnd.random() < 0.1:
            b = b.lower()
        lib.append((f"g{i}", b))
    got = {k: v[0] for k, v in counts(spark, reads, lib).items()}
    assert got == loop_first_match(reads, lib)


def test_match_all_vs_loop(spark):
    rnd = random.Random(7)
    reads = [(f"r{i}", "".join(rnd.choice("ACGT") for _ in range(30))) for i in range(200)]
    lib = [(f"g{i}", "".join(rnd.choice("ACGT") for _ in range(rnd.choice([3, 4, 9]))))
           for i in range(40)]
    libdf = library_df(spark, lib)
    kept = {r.ord: r.barcode for r in libdf.collect()}
    got = {(r.read_key, r.ord) for r in match_all(reads_df(spark, reads), libdf).collect()}
    want = {(k, o) for k, (_, s) in enumerate(reads) for o, b in kept.items() if b in s}
    assert got == want


def test_seed_join_plan_has_no_nested_loop(spark):
    reads = reads_df(spark, [("r", "ACGTACGTAAAA")])
    lib = library_df(spark, [("g", "ACGTACGTA"), ("h", "TTTTTTTTT")])
    plan = assign_first_match(reads, lib)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("bound", [None, 4000, 0])
def test_long_barcodes_stepped_seeds(spark, monkeypatch, bound):
    """Barcodes of 14..30 nt (seed 12, step up to 3), planted in reads at
    random places, nested and overlapping; with a small broadcast bound the
    step shrinks, and below it the index is joined by a shuffle."""
    from seqtally.operators.match import seed_lanes
    if bound is not None:
        monkeypatch.setattr(_util, "BROADCAST_BYTES", bound)
    rnd = random.Random(11)
    lib = []
    for i in range(10):
        b = "".join(rnd.choice("ACGT") for _ in range(rnd.randint(14, 30)))
        if i and rnd.random() < 0.3:
            b = lib[-1][1][:14]               # prefix of an earlier barcode
        lib.append((f"g{i}", b))
    reads = []
    for i in range(150):
        s = "".join(rnd.choice("ACGT") for _ in range(rnd.randint(10, 90)))
        for _ in range(rnd.randint(0, 2)):
            b = rnd.choice(lib)[1]
            p = rnd.randint(0, len(s))
            s = s[:p] + b + s[p:]
        reads.append((f"r{i}", s))
    lanes, k, step = seed_lanes({n: 1 for n in {len(b) for _, b in lib}}, max_build_rows=10 ** 9)
    assert k == 12 and step >= 3
    got = {k_: v[0] for k_, v in counts(spark, reads, lib).items()}
    assert got == loop_first_match(reads, lib)


@pytest.mark.parametrize("shape", ["short", "long", "mixed", "patterns"])
def test_shuffled_index_gives_the_same_rows(spark, monkeypatch, shape):
    """Every kind of library with an index that may not be broadcast."""
    rnd = random.Random(21)
    text = lambda n: "".join(rnd.choice("ACGT") for _ in range(n))
    lib = {"short": [text(rnd.choice([2, 3, 5])) for _ in range(40)], "long": [text(20) for _ in range(9)],
           "mixed": [text(rnd.choice([4, 5, 20, 26])) for _ in range(60)],
           "patterns": ["AC.{3}" + text(9), "(ACGTA|TTTTT)G", text(8) + "[AG]T", text(9) + "A+" + text(3), text(12)]}[shape]
    lib = library_df(spark, [(f"g{i}", b) for i, b in enumerate(lib)])
    planted = [r.barcode for r in lib.collect() if r.barcode.isalpha()]
    reads = reads_df(spark, [(f"r{i}", text(rnd.randrange(40)) + rnd.choice(planted or [""]) + text(rnd.randrange(20))) for i in range(200)]
                     + [("p", "GGACAAATTTTTGAC"), ("e", "")])

    def run():
        return (sorted((r.read_key, r.ord) for r in match_all(reads, lib).collect()),
                sorted((r.read_key, r.detected) for r in read_outcomes(reads, lib).collect()))
    before = run()
    monkeypatch.setattr(_util, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(match, "SHORT_INLINE_MAX", 0)
    assert run() == before and len(before[1]) == 202


def test_shuffled_seed_join_carries_a_window_not_the_read(spark, monkeypatch):
    monkeypatch.setattr(_util, "BROADCAST_BYTES", 0)
    reads = reads_df(spark, [("a", "ACGTACGTACGTACGTACGTGG" * 4)])
    df = assign_first_match(reads, library_df(spark, [("g", "ACGTACGTACGTACGTACGT"), ("h", "T" * 24)]))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert "isFinalPlan=true" in final and "NestedLoop" not in final
    for line in final.splitlines():
        if "Exchange hashpartitioning(h#" in line:
            below = final.splitlines()[final.splitlines().index(line) + 1]
            assert "piece#" in below and "sequence#" not in below.split("AS piece")[-1]


LIBRARIES = [
    [("g", "ACGTACGTAA"), ("h", "TTTTTTTTTT")],                 # seeded only
    [("g", "ACG"), ("h", "TTTTTTTTTT")],                        # constants + seeded
    [("g", "AC[GT]A"), ("h", "TTTTTTTTTT"), ("s", "GG")],      # pattern + seeded + short
    [("g", "AC[GT]A"), ("s", "GG")],                            # pattern + short
    [("g", "AC[GT]A"), ("r", "C{5}")],                          # patterns only
    [("g", "(ACGTA|TTTT)")],                                    # a pattern without a certain run
]


@pytest.mark.parametrize("lib", LIBRARIES)
@pytest.mark.parametrize("inline", [32, 0])
def test_one_pass_sees_every_read_once(spark, monkeypatch, lib, inline):
    """Short barcodes as constants or as seeds: the same rows."""
    monkeypatch.setattr(match, "SHORT_INLINE_MAX", inline)
    reads = reads_df(spark, [("a", "CCACGTACGTAACC"), ("b", "TTTTTTTTTTTT"), ("c", "CC"),
                             ("d", ""), ("e", "ACTAGG"), ("f", "CCCCCCCCCCCCCCCC")])
    libdf = library_df(spark, lib)
    one = {(r.read_key, r.detected) for r in read_outcomes(reads, libdf).collect()}
    hit = {r.read_key for r in assign_first_match(reads, libdf).collect()}
    assert one == {(k, k in hit) for k in range(6)}
    found = matched_reads(reads, libdf).collect()
    assert sum(r.n for r in found if r.ord is None) == 6
    assert {r.read_key for r in found if r.ord is not None} == hit
    s = barcode_stats(reads, libdf).first()
    assert (s.total_reads, s.detected_reads) == (6, len(hit))


@pytest.mark.parametrize("set4", [[("x", "ACGT")], [("x", "ACGTACGTAA")], [("x", "AC[GT]T")]])
def test_manifest_rows_without_set_or_reads(spark, set4):
    """A listed set that the library lacks and a listed sample without reads
    have their row, whatever the barcodes look like."""
    reads = reads_df(spark, [("a", "CCACGTACGTAACC"), ("b", "TTTTTTTTTTTT")], sample="S")
    man = spark.createDataFrame([("S", "L"), ("S", "NOPE"), ("T", "L")], "sample string, barcode_set string")
    lib = library_df(spark, set4)
    got = {(r.sample, r.barcode_set): (r.total_reads, r.detected_reads) for r in barcode_stats(reads, lib, man).collect()}
    assert got == {("S", "L"): (2, 1), ("S", "NOPE"): (2, 0), ("T", "L"): (0, 0)}
    filled = {(r.sample, r.barcode_set): (r.read_counts, r.rpm) for r in barcode_counts(reads, lib, man).collect()}
    assert filled == {("S", "L"): (1, 1e6), ("T", "L"): (0, 0.0)}


def test_rpm_is_within_each_run(spark):
    reads = reads_df(spark, [("a", "AACGTT"), ("b", "AACGTC"), ("c", "AACGTG"), ("d", "GGGGTT")])
    lib = library_df(spark, [("g", "ACGT")]).unionByName(library_df(spark, [("h", "GGGG")], "M"))
    man = spark.createDataFrame([("S", "L"), ("S", "M")], "sample string, barcode_set string")
    assert sorted((r.gene, r.read_counts, r.rpm) for r in barcode_counts(reads, lib, man).collect()) == [
        ("g", 3, 1e6), ("h", 1, 1e6)]


def test_ten_thousand_manifest_rows(spark):
    reads = reads_df(spark, [("a", "AACGTT")], sample="s7")
    lib = library_df(spark, [("g", "ACGT")])
    man = spark.range(10_001).selectExpr("concat('s', id) AS sample", "'L' AS barcode_set")
    got = barcode_counts(reads, lib, man)
    assert got.count() == 10_001 and got.filter("read_counts > 0").first().sample == "s7"
    assert barcode_stats(reads, lib, man).count() == 10_001


def test_patterns_with_few_texts():
    assert plain_texts("AC[GT]A") == ["ACGA", "ACTA"]
    assert plain_texts("A{2}[C-D]") == ["AAC", "AAD"]
    assert plain_texts("(ACGTA|TTGCA)G") == ["ACGTAG", "TTGCAG"]
    assert plain_texts("A(?:C|G(T|))A?") == ["AC", "ACA", "AG", "AGA", "AGT", "AGTA"]
    assert plain_texts("A{0,2}C") == ["AAC", "AC", "C"] and plain_texts(r"A\.C") == ["A.C"]
    for p in ("A.C", "A+", "A*", "A?", "[ACGT]" * 5, "^AC", "AC$", "(?=AC)AC", r"\bAC", "A?+C", "(?>A|AC)G", "(?I)AC", "AC)", "(AC",
              "A{2,1}", "*A", r"\QAC\E", r"\X41", "[A[C]]", "[^A]C", ""):
        assert plain_texts(p) is None, p


def test_required_factors():
    assert cover("AC.GTTA") == ["GTTA"] and cover("ACG+TTTT") == ["GTTTT"]
    assert cover("AC[GT]A.") == ["ACGA", "ACTA"]
    assert cover("(ACGTA|TTGCA).*G") == ["ACGTA", "TTGCA"]
    assert cover("(ACGTA.+C|G.TTGCAT?)") == ["ACGTA", "TTGCA"]  # an AND in each alternative, the better factor of each
    assert cover("A(C|G.)TTTTA(A|C)") == ["TTTTAA", "TTTTAC"]
    assert cover("(ACGTT)+") == ["ACGTT"] and cover("(ACGTT){2,}C") == ["ACGTTACGTTC"]
    assert cover("^ACGTA$") == ["ACGTA"] and cover("(?<!C)ACGTA(?=GG).") == ["ACGTA"]
    assert cover("(ACGTA|CACGTAC).") == ["ACGTA"]  # the other contains it
    for p in (".", "A*", "(ACGTA|.)", "(ACGTA)?C.", "AC.", "(?I)ACGTA.", "[ACGT]{3}.[ACGT]"):
        assert cover(p) is None, p
    assert cover("(" * 5000 + "A" + ")" * 5000) is None


@pytest.mark.parametrize("seed", range(4))
def test_facts_hold_for_every_match(seed):
    """Random patterns: each match in random text is one of the exact texts,
    starts and ends as told, and holds a text of the cover."""
    import re
    rnd = random.Random(seed)

    def pattern(depth):
        kind = rnd.randrange(8 if depth else 3)
        if kind < 3:
            return rnd.choice(["A", "C", "GT", "ACA", "[AC]", "[A-G]", ".", "TTG"])
        if kind < 5:
            return pattern(depth - 1) + pattern(depth - 1)
        if kind == 5:
            return "(" + "|".join(pattern(depth - 1) for _ in range(rnd.randint(1, 3))) + ")"
        if kind == 6:
            return f"(?:{pattern(depth - 1)})" + rnd.choice(["?", "*", "+", "{2}", "{0,2}", "{1,}", "+?"])
        return pattern(depth - 1) + rnd.choice(["", "^", "$", "(?=A)"])
    for _ in range(300):
        p = pattern(3)
        f, texts = facts(p), plain_texts(p)
        for _ in range(6):
            s = "".join(rnd.choice("ACGT") for _ in range(rnd.randrange(30)))
            for m in re.finditer(p, s):
                t = m[0]
                assert f.exact is None or t in f.exact, p
                assert any(t.startswith(x) for x in f.starts) and any(t.endswith(x) for x in f.ends), p
                assert f.cover is None or any(x in t for x in f.cover), p
            if texts:
                assert bool(re.search(p, s)) == any(x in s for x in texts), p


def test_thousand_choices_take_one_pass(spark, tmpdir_path):
    """Patterns with choices, short barcodes, patterns without factors: one scan
    of the reads, no pattern collected, no exchange by read."""
    import re
    rnd = random.Random(9)
    text = lambda n: "".join(rnd.choice("ACGT") for _ in range(n))
    lib = [f"({text(5)}|{text(5)})G" for _ in range(400)] + [f"({text(6)}|{text(7)}).{text(2)}" for _ in range(600)]
    lib += [text(3)] + [f"{text(1)}.{text(1)}[AC].{text(1)}{i % 7 + 1}" for i in range(4)] + ["TT.*TTT.AA"]
    libdf = library_df(spark, [(f"g{i}", b) for i, b in enumerate(lib)])
    rows = [(f"r{i}", text(rnd.randrange(60))) for i in range(300)]
    reads_df(spark, rows).write.parquet(f"{tmpdir_path}/reads")
    reads = spark.read.parquet(f"{tmpdir_path}/reads")
    df = assign_first_match(reads, libdf)
    got = {r.read_key: r.ord for r in df.collect()}
    kept = sorted((r.ord, r.barcode) for r in libdf.collect())
    want = {k: next((o for o, b in kept if re.search(b, s)), None) for k, (_, s) in enumerate(rows)}
    assert got == {k: o for k, o in want.items() if o is not None} and len(got) > 100
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count(f"{tmpdir_path}/reads") == 1 and "read_key" not in "".join(
        x for x in plan.splitlines() if "Exchange" in x)


def test_patterns_without_factors_beyond_the_constants(spark, monkeypatch):
    import re
    monkeypatch.setattr(match, "PATTERN_INLINE_MAX", 0)
    lib = [f"{a}.{b}{c}?" for a in "ACGT" for b in "ACGT" for c in "AG"]
    libdf = library_df(spark, [(f"g{i}", b) for i, b in enumerate(lib)])
    rows = [("a", "ACGGT"), ("b", "TTTT"), ("c", ""), ("d", "CAG" * 20)]
    kept = {r.ord: r.barcode for r in libdf.collect()}
    want = {(k, o) for k, (_, s) in enumerate(rows) for o, b in kept.items() if re.search(b, s)}
    for bound in (None, 0):
        if bound is not None:
            monkeypatch.setattr(_util, "BROADCAST_BYTES", bound)
        df = match_all(reads_df(spark, rows), libdf)
        assert {(r.read_key, r.ord) for r in df.collect()} == want
        assert "NestedLoop" not in df._jdf.queryExecution().executedPlan().toString()


def test_first_match_shuffles_nothing_by_read(spark, tmpdir_path):
    """The count table of a broadcast index: exchanges by count keys only."""
    from seqtally.operators.counts import count_matched
    from seqtally.operators.match import match_counts
    rnd = random.Random(3)
    text = lambda n: "".join(rnd.choice("ACGT") for _ in range(n))
    reads = reads_df(spark, [(f"r{i}", text(40)) for i in range(2000)]).repartition(6)
    libdf = library_df(spark, [(f"g{i}", text(rnd.choice([4, 8]))) for i in range(60)])
    df = count_matched(match_counts(reads, libdf))
    got = {r.ord: r.read_counts for r in df.collect()}
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    by = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert by and not any("read_key" in x or "_read" in x for x in by)
    hits = [r.ord for r in assign_first_match(reads, libdf).collect()]
    assert got == {None: 2000} | {o: hits.count(o) for o in set(hits)}


@pytest.mark.parametrize("size", [1, 2, 3, 50])
def test_reads_across_batches(spark, size):
    """Rows of a read that reach over any number of Arrow batches."""
    import pyarrow as pa

    from seqtally.operators.match import _by_read
    rnd = random.Random(size)
    rows = [(r, rnd.choice(["a", "b", None]), rnd.choice([None, 1, 2, 3])) for r in range(12) for _ in range(rnd.randrange(9))]
    rows = [(r, s, o if s else None) for r, s, o in rows]
    schema = pa.schema([("_read", pa.int64()), ("barcode_set", pa.string()), ("ord", pa.int64())])
    batches = [pa.RecordBatch.from_pylist([dict(zip(schema.names, x)) for x in rows[i:i + size]], schema)
               for i in range(0, len(rows), size)]
    big = 10 ** 9
    for by, key in ((("barcode_set",), lambda x: x[:2]), (("barcode_set", "ord"), lambda x: x), ((), lambda x: x[:1])):
        want = {}
        for x in rows:
            want[key(x)] = min(want.get(key(x), big), big if x[2] is None else x[2])
        got = [tuple(x.values()) for b in _by_read(batches, by) for x in b.to_pylist()]
        assert {key(x): big if x[2] is None else x[2] for x in got} == want and len(got) == len(want)
    if len(rows) > 2:
        with pytest.raises(RuntimeError, match="not together"):
            list(_by_read(batches[::-1] if size < len(rows) else [batches[0].take(list(range(len(rows)))[::-1])], ()))


@pytest.mark.parametrize("seed", [1, 2])
def test_patterns_match_python_re(spark, seed):
    import re
    rnd = random.Random(seed)
    text = lambda n: "".join(rnd.choice("ACGT") for _ in range(n))
    piece = lambda: rnd.choice([text(2), text(5), "[AC]", "[A-G]", ".", "G+", "T?", "A{2}", "C{1,2}", "(AC|GT)", "."])
    lib = [(f"g{i}", "".join(piece() for _ in range(rnd.randint(2, 4)))) for i in range(60)]
    libdf = library_df(spark, lib)
    kept = {r.ord: r.barcode for r in libdf.collect()}
    reads = [(f"r{i}", text(rnd.randrange(50))) for i in range(150)]
    got = {(r.read_key, r.ord) for r in match_all(reads_df(spark, reads), libdf).collect()}
    assert got == {(k, o) for k, (_, s) in enumerate(reads) for o, b in kept.items() if re.search(b, s)}


def test_many_patterns_need_no_nested_loop(spark, monkeypatch):
    monkeypatch.setattr(match, "PATTERN_INLINE_MAX", 2)
    lib = library_df(spark, [(f"g{i}", p) for i, p in enumerate(["(A|C)G", "T?T?G", "AC.GT", "G[AC]T", "(AA|TT)", ".C."])])
    df = match_all(reads_df(spark, [("a", "ACGGT"), ("b", "TTTT"), ("c", "")]), lib)
    got = {(r.read_key, r.ord) for r in df.collect()}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert got == {(0, 0), (0, 1), (0, 2), (0, 5), (1, 4)}


def test_ignore_case_option(spark):
    reads = reads_df(spark, [("r1", "ttacgttt"), ("r2", "TTACGTTT")])
    lib = library_df(spark, [("g", "ACGT")])
    assert assign_first_match(reads, lib).count() == 1
    assert assign_first_match(reads, lib, ignore_case=True).count() == 2


def test_manifest_with_incomplete_rows(spark):
    reads = reads_df(spark, [("a", "AACGTT")], sample="S1")
    lib = library_df(spark, [("g", "ACGT")])
    man = spark.createDataFrame([("S1", "L"), ("S1", None), (None, "L")],
                                "sample string, barcode_set string")
    got = [(r.sample, r.barcode_set, r.read_counts) for r in barcode_counts(reads, lib, man).collect()]
    assert got == [("S1", "L", 1)]


def test_every_join_shuffled(spark, monkeypatch):
    reads = reads_df(spark, [("a", "AACGTT"), ("b", "GGGGTT")], sample="S1").unionByName(
        reads_df(spark, [("c", "ACGTAA")], sample="S2"))
    lib = library_df(spark, [("g", "ACGT"), ("h", "GGGG")]).unionByName(
        library_df(spark, [("t", "GTT")], barcode_set="M"))
    man = spark.createDataFrame([("S1", "L"), ("S1", "M"), ("S2", "L")],
                                "sample string, barcode_set string")

    def run():
        return sorted((r.sample, r.barcode_set, r.gene, r.read_counts, r.rpm)
                      for r in barcode_counts(reads, lib, man).collect())
    before = run()
    monkeypatch.setattr(_util, "BROADCAST_BYTES", 0)
    assert run() == before
    assert ("S1", "M", "t", 2, 1e6) in before and ("S2", "L", "h", 0, 0.0) in before


@pytest.mark.parametrize("seed", [5, 6])
def test_manifest_sets_match_python_loop(spark, seed):
    """Two barcode sets (long, short and regex barcodes), samples mapped to
    one or both sets: per (sample, set) counts equal the reference loop run
    for that sample against that set's library."""
    import re as _re
    rnd = random.Random(seed)
    nt = "ACGT"
    sets = {}
    for name in ("A", "B"):
        lib = []
        for i in range(15):
            n = rnd.choice([3, 4, 9, 12, 16])
            lib.append((f"{name}{i}", "".join(rnd.choice(nt) for _ in range(n))))
        lib.append((f"{name}rx", "AC[GT]T"))
        sets[name] = lib
    samples = {"S1": ["A"], "S2": ["B"], "S3": ["A", "B"]}
    reads = {s: [(f"{s}r{i}", "".join(rnd.choice(nt) for _ in range(rnd.randint(5, 50))))
                 for i in range(60)] for s in samples}
    rdf = None
    for s, rs in reads.items():
        d = reads_df(spark, rs, sample=s).withColumn(
            "read_key", F.col("read_key") + F.lit(1000 * int(s[1:])))
        rdf = d if rdf is None else rdf.unionByName(d)
    lib = library_df(spark, sets["A"], "A").unionByName(library_df(spark, sets["B"], "B"))
    man = spark.createDataFrame([(s, b) for s, bs in samples.items() for b in bs],
                                "sample string, barcode_set string")
    got = {(r.sample, r.barcode_set, r.gene): r.read_counts
           for r in barcode_counts(rdf, lib, man).collect()}

    def loop(rs, library):
        seen, order = set(), []
        for g, b in library:
            if b.upper() not in seen:
                seen.add(b.upper())
                order.append((g, b.upper()))
        pool = dict(enumerate(rs))
        out = {}
        for g, b in order:
            lit = _re.fullmatch("[A-Z]+", b) is not None
            hit = [k for k, (_, sq) in pool.items() if (b in sq if lit else _re.search(b, sq))]
            out[g] = len(hit)
            for k in hit:
                del pool[k]
        return out

    want = {(s, b, g): c for s, bs in samples.items() for b in bs
            for g, c in loop(reads[s], sets[b]).items()}
    assert got == want
