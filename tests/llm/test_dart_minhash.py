"""Near duplicates against all pairs on a small corpus."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from seqtally.llm import dart_minhash as D

WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def shingles(t):
    ws = ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in WORD.findall(t or "")]
    return Counter(tuple(ws[i:i + 5]) for i in range(max(1, len(ws) - 4))) if ws else Counter()


def brute(rows):
    """Class of each row: components of all pairs at weighted similarity 0.8."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                common = sum((sets[i] & sets[j]).values())
                if common >= 0.8 * (sum(sets[i].values()) + sum(sets[j].values()) - common) - 1e-9:
                    root[find(i)] = find(j)
    ids = {}
    for k, (doc, _) in enumerate(rows):
        if doc is not None:
            ids[find(k)] = min(ids.get(find(k), doc), doc)
    return sorted(((doc, ids.get(find(k))) for k, (doc, _) in enumerate(rows)), key=str)


def corpus(seed):
    rnd = random.Random(seed)
    word = lambda: f"w{rnd.randrange(3000)}"
    bases = [[word() for _ in range(rnd.choice([1, 3, 4, 5, 8, 40, 120, 300]))] for _ in range(60)]
    shared = [word() for _ in range(60)]
    texts = [" ".join(b) for b in bases]
    for _ in range(150):  # copies with edits, borderline ones among them
        own = list(rnd.choice(bases))
        for _ in range(rnd.choice([0, 1, 2, 3, 4, 6])):
            own[rnd.randrange(len(own))] = word()
        texts.append(rnd.choice([" ", "\n", ", "]).join(own).upper())
    for k in range(40):  # one passage in many texts
        texts.append(" ".join(shared + [word() for _ in range(rnd.choice([30, 60, 90]))]))
    chain = [word() for _ in range(200)]
    for k in range(25):  # each step alike, the ends not
        chain[8 * k % 200] = word()
        texts.append(" ".join(chain))
    rows = list(enumerate(texts)) + [(900, None), (901, ""), (902, "..."), (None, texts[3]), (None, "only null"), (None, "only null"),
                                     (5, texts[5]), (5, texts[70]), (903, "a b " * 30_000), (904, "a b " * 30_000 + "c")]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_match_all_pairs(spark, make_docs, seed):
    rows = corpus(seed)
    docs = make_docs(rows).withColumn("words", F.lit("clash")).repartition(4)
    got = sorted(((r.doc_id, r.class_id) for r in D.near_duplicates(docs).collect()), key=str)
    assert got == brute(rows)


def test_many_near_copies_are_one_class(spark, make_docs):
    rnd = random.Random(9)
    base = [f"b{i}" for i in range(160)]
    rows = []
    for i in range(400):
        own = list(base)
        for _ in range(rnd.randrange(4)):
            own[rnd.randrange(160)] = f"n{rnd.random()}"
        rows.append((i, " ".join(own)))
    got = sorted(((r.doc_id, r.class_id) for r in D.near_duplicates(make_docs(rows)).collect()), key=str)
    assert got == brute(rows)


def test_signatures_agree_as_often_as_the_similarity():
    import pyarrow as pa
    from seqtally.llm._words import Words
    rnd = random.Random(3)
    for share in (0.3, 0.8):
        hits = total = 0
        for _ in range(60):
            a = [f"{rnd.random()}" for _ in range(100)]
            b = a[:int(share * 100)] + [f"{rnd.random()}" for _ in range(100 - int(share * 100))]
            x, y = shingles(" ".join(a)), shingles(" ".join(b))
            own, weights, bounds = D.shingle_weights(Words(pa.array([" ".join(a), " ".join(b)]), D.PLAIN_SEPARATOR, D.PLAIN_CASE))
            s, t = (D.signature(own[bounds[k]:bounds[k + 1]], weights[bounds[k]:bounds[k + 1]]) for k in (0, 1))
            common = sum((x & y).values())
            hits += (s == t).mean() - common / (sum(x.values()) + sum(y.values()) - common)
            total += 1
        assert abs(hits / total) < 0.02


@pytest.mark.parametrize("scale", [0.05, 1, 40, 5000])
def test_real_weights(scale):
    """Any positive weights: signatures agree as often as the weighted Jaccard
    similarity says, and as a brute-force minimum over all the elements' darts."""
    rng = np.random.default_rng(int(scale * 100))
    off = []
    for _ in range(50):
        n = rng.integers(1, 60)
        names = rng.integers(0, 2 ** 63, n).astype(np.uint64)
        x = scale * rng.gamma(0.5, 1.0, n) + 1e-3
        y = np.where(rng.random(n) < 0.7, x, scale * rng.gamma(0.5, 1.0, n) + 1e-3)
        y[rng.random(n) < 0.1] = 0
        y[0] = x[0]
        s, t = D.signature(names, x), D.signature(names[y > 0], y[y > 0])
        off.append((s == t).mean() - np.minimum(x, y).sum() / np.maximum(x, y).sum())
    assert abs(np.mean(off)) < 0.02
    best = {}
    for rank, name, coordinate in D.darts(names, x, 4 * D.THROWN / x.sum()):
        for r, h, c in zip(rank, name, coordinate):
            best[c] = min(best.get(c, (np.inf, 0)), (r, h))
    assert [best[c][1] for c in range(D.DARTS)] == s.tolist()


def test_darts_fall_evenly_and_stay_where_they_are():
    """One dart for each unit of weight and rank on average; a larger region has
    all the darts of a smaller one; the number of darts looked at follows the
    elements, not their weights."""
    rng = np.random.default_rng(5)
    names = rng.integers(0, 2 ** 63, 3000).astype(np.uint64)
    for weight, limit in ((0.3, 2.0), (1.0, 1.0), (5.5, 0.4), (1000.0, 0.002)):
        found = [np.concatenate(c) for c in zip(*D.darts(names, np.full(3000, weight), limit))]
        assert abs(len(found[0]) / (3000 * weight * limit) - 1) < 0.06
        assert abs(np.bincount(found[2], minlength=D.DARTS).std() / (len(found[0]) / D.DARTS) ** 0.5 - 1) < 0.3
        more = np.concatenate([n for _, n, _ in D.darts(names, np.full(3000, weight * 1.7), limit)])
        assert np.isin(found[1], more).all()


def test_distinct_shingles_with_their_weights():
    import pyarrow as pa
    from seqtally.llm._words import Words
    words = Words(pa.array(["a b " * 50, None, "x", "a b c d e", "a b " * 50 + "c"]), D.PLAIN_SEPARATOR, D.PLAIN_CASE)
    own, weights, bounds = D.shingle_weights(words)
    assert bounds.tolist() == [0, 2, 2, 3, 4, 7]
    assert sorted(weights[:2]) == [48, 48] and weights[2:4].tolist() == [1, 1] and sorted(weights[4:]) == [1, 48, 48]
    assert set(own[:2]) < set(own[4:7])


def test_recall_on_documents(spark):
    """All pairs of five-word shingle sets at 0.8 or more are in one class."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(((r.doc_id, r.class_id) for r in D.near_duplicates(docs).collect()), key=str) == brute(rows)


def test_components(spark):
    rnd = random.Random(4)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rnd.randrange(60), rnd.randrange(60)) for _ in range(45)]
    edges = [(a, b) for a, b in edges if a != b]
    root = {n: n for e in edges for n in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = D.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.id: r["class"] for r in got} == root


def test_empty_table(spark, make_docs):
    assert D.near_duplicates(make_docs([])).count() == 0
    assert [tuple(r)[:2] for r in D.near_duplicates(make_docs([(4, None)])).collect()] == [(4, 4)]


def test_one_of_each_is_told_row_by_row(spark, make_docs):
    """Wordless rows stay whatever else is in the table; repeated rows of a class
    are one document; a user's ``_key`` column is kept."""
    text = "one two three four five six seven"
    wordless = [(8, None), (8, None), (9, "..."), (9, "..."), (None, ""), (None, "")]
    for more, want in (([(1, text)], [1]), ([(1, text), (1, text)], [1]), ([(2, text), (1, text), (1, text)], [1]),
                       ([(None, text), (4, text), (4, text)], [4]), ([(None, text), (None, text)], [None]),
                       ([(5, text * 4), (5, text * 4 + " eight"), (6, "x"), (6, "x")], [5, 6]), ([], [])):
        docs = make_docs(wordless + more).withColumn("_key", F.lit("own")).withColumn("first", F.lit(1))
        kept = D.one_of_each(docs.repartition(3))
        rows = kept.collect()
        assert kept.columns == docs.columns and all(r._key == "own" for r in rows)
        assert sorted(map(str, (r.doc_id for r in rows))) == sorted(map(str, [8, 8, 9, 9, None, None, *want])), more
