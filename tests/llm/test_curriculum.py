"""Mixing to target weights against a plain water-filling loop and a plain walk
over the tapes."""

import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from seqtally.llm import curriculum
from seqtally.llm.curriculum import mixing_plan, training_order

WORD = re.compile("[^\x20\x09-\x0d]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def plain_targets(sizes, weights, budget, cap=3):
    """Share by weight, stop sources above their cap, share the excess again."""
    target, full = {}, set()
    while True:
        rest = budget - sum(cap * sizes[s] for s in full)
        total = sum(weights[s] for s in sizes if s not in full)
        target = {s: cap * sizes[s] if s in full else (weights[s] * rest / total if total else 0.0) for s in sizes}
        over = {s for s in sizes if s not in full and target[s] > cap * sizes[s]}
        if not over:
            return target
        full |= over


def plain_taken(rows, target):
    """(doc_id, source, size, taken) by walking over each source's tape."""
    out = []
    for s, goal in target.items():
        own = sorted((hashlib.md5(str("" if d is None else d).encode()).hexdigest()[:15], -1 if d is None else d, n)
                     for d, src, n in rows if src == s)
        left, taken = math.floor(goal + 0.5), [0] * len(own)
        while left > 0 and any(n for *_, n in own):
            for i, (*_, n) in enumerate(own):
                taken[i] += min(n, left)
                left -= min(n, left)
        out += [(None if d == -1 else d, s, n, t) for (_, d, n), t in zip(own, taken)]
    return sorted(out, key=str)


def corpus():
    rnd = random.Random(11)
    rows = []
    for i in range(400):
        source = rnd.choice(["b", "b", "b", "é", "a", "\U0001f600", "￿", None, "tiny" if i < 40 else "b"])
        n = rnd.choice([0, 1, 5, 30]) if source != "tiny" else 1
        rows.append((i, source, " ".join(["wörd"] * n) + rnd.choice(["", " \t", "\n"])))
    rows += [(None, "a", "x y"), (None, "a", "x y"), (7, None, None), (7, "a", ""), (8, "a", "\x00 \x0b\x0c\r"),
             (500, "void", None), (501, "void", " "), (502, "a", "long " * 30_000)]
    rows += [(9, "b", "same row here")] * 300
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(d, t, None, s, None) for d, s, t in rows], DOCS)


@pytest.fixture(scope="module")
def plan(spark):
    docs = frame(spark, corpus()).withColumn("size", F.lit("clash")).withColumn("key", F.lit(1)).withColumn("n", F.lit(2))
    made = mixing_plan(docs.repartition(5)).persist()
    yield made
    made.unpersist()


def sized():
    return [(d, s, len(WORD.findall(t or ""))) for d, s, t in corpus()]


def expected():
    rows = sized()
    names = sorted({s for _, s, _ in rows}, key=lambda s: (s is None, (s or "").encode()))
    sizes = {s: sum(n for _, x, n in rows if x == s) for s in names}
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    return rows, sizes, weights, plain_targets(sizes, weights, sum(sizes.values()))


def test_matches_plain_loops(plan):
    rows, sizes, _, target = expected()
    got = plan.collect()
    assert sorted(((r.doc_id, r.source, r["size"], r.taken) for r in got), key=str) == plain_taken(rows, target)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert r.taken <= 3 * r["size"]


def test_sorted_by_position_and_complete(plan):
    at = [r.position for r in plan.collect()]
    assert at == sorted(at) and len(at) == len(corpus())


def test_demand_follows_the_schedules(plan):
    """Up to any time a source has given its target times its schedule's integral,
    to within the document that is being read."""
    rows, sizes, weights, target = expected()
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    order = training_order(plan).collect()
    assert [r.position for r in order] == sorted(r.position for r in order)
    for i, s in enumerate(names):
        own = [r for r in order if r.source == s]
        if not target[s]:
            assert not own
            continue
        assert sum(r.words for r in own) == math.floor(target[s] + 0.5)
        tilt = (0.5, 0.0, -0.5)[i % 3]
        for t in (0.1, 0.37, 0.5, 0.92):
            due = target[s] * ((1 + tilt) * t - tilt * t * t)
            given = sum(r.words for r in own if r.position <= t)
            last = max([r.words for r in own if r.position <= t], default=0)
            assert due - 1 <= given + 1 and given - last <= due + 1, (s, t)


def test_result_does_not_depend_on_partitioning(spark, plan):
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        again = mixing_plan(frame(spark, corpus()).repartition(2)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    key = lambda r: (str(r.doc_id), str(r.source), r["size"], r.position, r.taken)
    assert sorted(map(key, again)) == sorted(map(key, plan.collect()))


def test_blocks_of_copies(spark, monkeypatch):
    monkeypatch.setattr(curriculum, "COPIES", 7)
    rows = [(1, "a", "x y z")] * 50 + [(2, "b", "x")] * 10
    got = sorted((r.doc_id, r.taken) for r in mixing_plan(frame(spark, rows)).collect())
    target = plain_targets({"a": 150, "b": 10}, {"a": 5, "b": 2}, 160)
    want = plain_taken([(d, s, len(t.split())) for d, s, t in rows], target)
    assert got == sorted((d, t) for d, _, _, t in want)


def test_own_schedules_and_budget(spark):
    """Piecewise schedules that begin at nothing, a source without one, a budget
    beyond what there is."""
    rows = [(i, "ab"[i % 2], "w " * 10) for i in range(100)] + [(1000, "c", "w w")]
    knots = "source string, knots array<struct<at:double,weight:double>>"
    late = [(0.0, 0.0), (0.5, 0.0), (1.0, 4.0)]
    table = spark.createDataFrame([("a", late), ("b", [(0.0, 1.0), (1.0, 1.0)])], knots)
    plan = mixing_plan(frame(spark, rows), table)
    got = {r.source: r for r in plan.groupBy("source").agg(F.sum("taken").alias("taken"), F.min("position").alias("first"),
                                                           F.max("target").alias("target")).collect()}
    assert got["a"].taken == got["b"].taken == 501 and got["c"].taken == 0 and got["c"].target == 0
    first = training_order(plan).groupBy("source").agg(F.min("position").alias("p"), F.max("position").alias("q"))
    at = {r.source: (r.p, r.q) for r in first.collect()}
    # the first document comes when demand begins, one tenth of it at 0.5 + 0.5 * sqrt(0.1)
    assert at["b"][0] == 0 and at["a"][0] == 0.5 and at["a"][1] <= 1
    tenth = training_order(plan).filter("source = 'a'").collect()[5]
    assert tenth.position == pytest.approx(0.5 + 0.5 * math.sqrt(50 / 501))
    much = mixing_plan(frame(spark, rows), table, budget=10 ** 9)
    assert {r.source: r.t for r in much.groupBy("source").agg(F.sum("taken").alias("t")).collect()} == {
        "a": 1500, "b": 1500, "c": 0}


def test_empty_and_wordless_tables(spark):
    assert mixing_plan(frame(spark, [])).collect() == []
    rows = mixing_plan(frame(spark, [(1, None, None), (2, "a", " ")])).collect()
    assert sorted((r.doc_id, r.taken, r.target) for r in rows) == [(1, 0, 0.0), (2, 0, 0.0)]


def test_no_python_in_the_plan(spark, plan):
    text = mixing_plan(frame(spark, corpus()))._jdf.queryExecution().toString()
    assert not re.search("ArrowEval|BatchEvalPython|MapInArrow|MapInPandas|FlatMapGroups", text)
