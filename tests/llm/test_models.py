"""Learnt operators: exact statistics, held-out accuracy and defined edges."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from seqtally.llm import compress_quality, langid, quality_rules
from seqtally.llm.compress_quality import held_out

SF = "/root/testdata/sf0.01"
EDGES = [None, "", " \n\t", "x", "\n\n", " a\na \n a\n\na\na", "a b c a b c", "ab\x0bab ab ab ab", "é ü\té ü\té ü",
         "#<>|", "!! ?? 12", "日本 語 日本 語 日本 語", "word " * 60_000]


def tables(spark):
    return (spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))


def brute(t):
    ws = re.findall(r"[^\x20\x09-\x0d]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    seen = Counter(tuple(ws[i:i + 3]) for i in range(len(ws) - 2))
    inside = {j for i in range(len(ws) - 2) if seen[tuple(ws[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return [len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(inside)]


def test_statistics_match_brute_force(spark):
    rnd = random.Random(1)
    texts = [e or "" for e in EDGES] + ["".join(rnd.choice("ab \n\t#|é!") for _ in range(rnd.randrange(80))) for _ in range(3000)]
    assert quality_rules.statistics(pa.array(texts))[0].tolist() == [brute(t) for t in texts]


def test_trees_obey_the_constraints():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 3))
    y = (rng.random(3000) < 0.5 + 0.4 * np.sin(9 * x[:, 0]) * x[:, 1]).astype(float)
    trees = quality_rules.fit_trees(x, y, [-1, 1, 0])
    grid = np.linspace(0, 1, 50)
    for rest in rng.random((40, 3)):
        for f, sign in ((0, -1), (1, 1)):
            rows = np.repeat(rest[None], 50, 0)
            rows[:, f] = grid
            assert (sign * np.diff(trees.score(rows)) >= -1e-12).all()
    assert quality_rules.fit_trees(x, np.ones(3000), [0, 0, 0]) is None


def test_quality_rules_on_held_out_documents(spark):
    docs, labels = tables(spark)
    model = quality_rules.train(docs, labels.filter(~held_out(F.col("doc_id"))))
    out = quality_rules.apply_rules(docs, model).join(labels, "doc_id").filter(held_out(F.col("doc_id"))).toPandas()
    out = out[~out.base_failed]
    assert out.kept[out.quality == 1].mean() > 0.97
    assert out.kept[out.quality == 0].mean() < 0.3


def test_compression_on_held_out_documents(spark):
    docs, labels = tables(spark)
    out = compress_quality.score_quality(docs, compress_quality.train(docs, labels))
    out = out.join(labels, "doc_id").filter(held_out(F.col("doc_id"))).toPandas()
    assert ((out.score >= 0.7) == (out.quality == 1)).mean() > 0.95
    assert out.score.between(0, 1).all()


def test_language_on_held_out_documents(spark):
    docs, _ = tables(spark)
    model = langid.train(docs.filter(~held_out(F.col("doc_id"))))
    out = langid.label_languages(docs, model).filter(held_out(F.col("doc_id"))).toPandas()
    assert (out.lang == out.lang_pred).mean() > 0.97


def test_mixed_language_spans(spark):
    docs, _ = tables(spark)
    model = langid.train(docs)
    pick = {r.lang: r.text for r in docs.filter("length(text) BETWEEN 300 AND 500 AND lang IN ('en', 'de')").collect()}
    text = f"{pick['en']} {pick['de']} 漢字"
    _, score, spans = langid._label([text], model)
    assert [s["lang"] for s in spans[0]][:2] == ["en", "de"] and 0.4 < score[0] < 0.7
    assert abs(spans[0][1]["start"] - len(pick["en"]) - 1) < 40


def test_words_are_runs_that_begin_with_a_letter():
    text = langid._Text(["\u0301\u0301a\u0301b c1d", "", "\u0301 2", "É", "\U0001f600x"])
    words = ["".join(map(chr, text.codes[a:b])) for a, b in zip(text.starts, text.ends)]
    assert words == ["a\u0301b", "c", "d", "é", "x"] and text.first.tolist() == [0, 3, 3, 3, 4, 5]


def test_viterbi_matches_all_paths():
    import itertools
    rng = np.random.default_rng(1)
    sizes = [0, 1, 5, 3, 0, 6]
    first = np.concatenate(([0], np.cumsum(sizes)))
    scores = rng.normal(0, 6, (first[-1], 3))
    path = langid.viterbi(scores, first)

    def value(p, s):
        return sum(s[i][x] for i, x in enumerate(p)) - langid.SWITCH * sum(a != b for a, b in zip(p, p[1:]))
    for a, b in zip(first[:-1], first[1:]):
        if b > a:
            best = max(value(p, scores[a:b]) for p in itertools.product(range(3), repeat=b - a))
            assert value(path[a:b], scores[a:b]) == pytest.approx(best)


def plain_path(scores, start):
    """One word after the other: the best path, and its language before the first."""
    now, back = start.copy(), []
    for row in scores:
        top = int(now.argmax())
        other = now[top] - langid._SWITCH
        back.append([i if now[i] >= other else top for i in range(len(now))])
        now = np.maximum(now, other) + row
    lang = int(now.argmax())
    path = []
    for b in reversed(back):
        path.append(lang)
        lang = b[lang]
    return path[::-1], lang, now - now.max()


@pytest.mark.parametrize("k", [1, 2, 5, 24, 25, 300])
@pytest.mark.parametrize("n", [1, 2, 17, 100, 401])
def test_runs_of_a_long_text(k, n):
    """Runs that step together find the path that word by word finds, from any
    start, with ties and with more languages than a byte holds."""
    rng = np.random.default_rng(n * k)
    scores = rng.integers(-9, 9, (n, k)) * langid._SWITCH // rng.integers(1, 9)
    start = np.maximum(rng.integers(-2, 1, k) * langid._SWITCH, -langid._SWITCH)
    run = langid._Run(scores, start - start.max())
    path, before, end = plain_path(scores, start - start.max())
    got, was = run.trace(int(run.end.argmax()))
    assert got.tolist() == path and was == before and (run.end == end).all()


def test_many_languages_and_mixed_lengths(monkeypatch):
    rng = np.random.default_rng(2)
    sizes = [0, 3, 40, 7, 0, 12]
    first = np.concatenate(([0], np.cumsum(sizes)))
    for k in (3, 300):
        scores = rng.normal(0, 9, (first[-1], k))
        want = [plain_path(langid.whole(scores[a:b]), np.zeros(k, np.int64))[0] for a, b in zip(first, first[1:])]
        for steps in (langid.STEPS, 5, 0):
            monkeypatch.setattr(langid, "STEPS", steps)
            path = langid.viterbi(scores, first)
            assert [path[a:b].tolist() for a, b in zip(first, first[1:])] == want
        assert k == 3 or (path > 127).sum() > 10


def test_long_texts_part_by_part(spark, monkeypatch):
    """However a text is cut, its labels are the same; a very long one is labelled
    whole."""
    docs, _ = tables(spark)
    model = langid.train(docs)
    texts = [r.text for r in docs.filter("length(text) > 200").sort("doc_id").limit(60).collect()]
    texts += [" ".join(texts[:9]), "x" * 3000, "1 " * 900, "", "\u0301 \u0301a " * 300, "日本語" * 500]
    want = langid._label(texts, model)
    for most in (40, 333):
        monkeypatch.setattr(langid, "LONG_CHARS", most)
        monkeypatch.setattr(langid, "STEPS", 3)
        got = langid._label(texts, model)
        assert got[0] == want[0] and got[2] == want[2] and np.allclose(got[1], want[1])
    monkeypatch.undo()
    long = (" ".join(texts[:40]) + " ") * 80
    pred, score, spans = langid._label([long, texts[0]], model)
    assert len(long) > 3 * langid.LONG_CHARS and pred[1] == want[0][0]
    assert sum(s["end"] - s["start"] for s in spans[0]) > 0.8 * len(long) and spans[0][-1]["end"] <= len(long)


def test_training_depends_on_distinct_rows_only(spark, make_docs, monkeypatch):
    """An id that occurs thousands of times is one row of the samples, and its
    repeats change no model."""
    from seqtally.llm._sample import distinct_sample, one_text_each
    rnd = random.Random(3)
    rows = [(i, " ".join(rnd.choice(["good", "fine", "#bad", "junk|"]) + str(rnd.randrange(90)) for _ in range(60))) for i in range(80)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(80)], "doc_id long, quality int, toxic int")
    many = rows + [rows[4]] * 3000 + [(4, f"zz {i}") for i in range(500)]
    picked = spark.createDataFrame([(i, 1) for i in range(60)], "doc_id long, mark int")
    got = one_text_each(make_docs(many), picked).collect()
    assert sorted(r.doc_id for r in got) == list(range(60))
    monkeypatch.setattr(quality_rules, "TRAIN_ROWS", 40)
    one, two = (quality_rules.train(make_docs(x).repartition(n), labels) for x, n in ((rows, 2), (rows + [rows[4]] * 3000, 7)))
    assert all((getattr(one, f) == getattr(two, f)).all() for f in ("feature", "threshold", "value"))
    one, two = (compress_quality.train(make_docs(x).repartition(n), labels) for x, n in ((rows, 2), (rows + [rows[4]] * 3000, 7)))
    assert one == two
    sample = lambda x, n: sorted(map(tuple, distinct_sample(make_docs(x).repartition(n), 30, "doc_id", "text").collect()))
    assert len(sample(rows * 4, 3)) < 60 and sample(rows * 4, 3) == sample((rows * 4)[::-1], 8)


def test_edges_and_clashing_columns(spark, make_docs):
    docs, labels = tables(spark)
    rows = make_docs([(i, t) for i, t in enumerate(EDGES)] + [(None, "a b"), (3, "x"), (3, "x")])
    clash = rows.withColumn("score", F.lit("s")).withColumn("kept", F.lit(1)).withColumn("spans", F.lit(1))
    rules = quality_rules.apply_rules(clash, quality_rules.train(docs, labels)).collect()
    assert len(rules) == len(EDGES) + 3 and all(r.base_failed and not r.kept for r in rules)
    assert {r.doc_id: r.n_words for r in rules}[12] == 60_000
    scores = compress_quality.score_quality(clash, compress_quality.train(docs, labels)).collect()
    assert len({r.score for r in scores if r.doc_id in (0, 1)}) == 1
    langs = langid.label_languages(clash, langid.train(docs)).collect()
    assert {r.doc_id: (r.lang_pred, r.score, r.spans) for r in langs}[0] == ("und", 0.0, [])
    assert {r.doc_id: r.lang_pred for r in langs}[10] == "und"


def test_nothing_to_learn_from(spark, make_docs):
    docs = make_docs([(1, "a b c " * 40), (2, None)])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.kept for r in quality_rules.apply_rules(docs, quality_rules.train(docs, none)).sort("doc_id").collect()] == [False, False]
    assert {r.score for r in compress_quality.score_quality(docs, compress_quality.train(docs, none)).collect()} == {0.5}
    assert {r.lang_pred for r in langid.label_languages(docs, langid.train(docs)).collect()} == {"und"}
    assert quality_rules.apply_rules(make_docs([]), None).count() == 0
    assert compress_quality.score_quality(make_docs([]), compress_quality.Model(b"", b"")).count() == 0
