"""Substring duplicates against a brute-force scan of all windows."""

import random
import re

import pytest

from seqtally.llm.substring import WINDOW, remove_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    """{index of row: (n_words, n_removed, kept words)} from (doc_id, text) rows."""
    words = [WORD.findall(t or "") for _, t in rows]
    least = {}
    for (doc, _), ws in zip(rows, words):
        if doc is not None:
            for i in range(len(ws) - WINDOW + 1):
                w = tuple(ws[i:i + WINDOW])
                least[w] = min(least.get(w, doc), doc)
    out = []
    for (doc, _), ws in zip(rows, words):
        gone = set()
        if doc is not None:
            for i in range(len(ws) - WINDOW + 1):
                if least[tuple(ws[i:i + WINDOW])] < doc:
                    gone.update(range(i, i + WINDOW))
        out.append((doc, len(ws), len(gone), " ".join(w for i, w in enumerate(ws) if i not in gone)))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, " ".join(WORD.findall(r.text or ""))) for r in df.collect()), key=str)


def prose(rnd, n, vocabulary=4000):
    return [f"w{rnd.randrange(vocabulary)}" for _ in range(n)]


def test_repeats_match_brute_force(spark, make_docs):
    rnd = random.Random(3)
    passages = [prose(rnd, n) for n in (49, 50, 51, 75, 140)]
    rows = []
    for i in range(120):
        ws = prose(rnd, rnd.choice([0, 3, 40, 90, 300]))
        for _ in range(rnd.randrange(3)):
            at = rnd.randrange(len(ws) + 1)
            ws[at:at] = rnd.choice(passages)
        rows.append((i, rnd.choice([" ", "\n", " \t"]).join(ws)))
    rows += [(200 + i, rows[7][1]) for i in range(30)]
    rnd.shuffle(rows)
    got = result(remove_repeats(make_docs(rows).repartition(5)))
    assert got == brute(rows)


def test_edges(spark, make_docs):
    long = " ".join(prose(random.Random(5), 30_000, 10 ** 6))
    rows = [(1, None), (2, ""), (3, " \n\t "), (None, long), (4, long), (5, long), (5, long), (6, "a " * 200),
            (7, "a " * 60), (8, "x" * 300_000), (9, "\x0b".join(long.split()[100:160])), (10, "é ü " * 60)]
    df = make_docs(rows).withColumn("n_words", __import__("pyspark").sql.functions.lit("clash"))
    out = remove_repeats(df)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "n_words", "n_removed"]
    assert result(out) == brute(rows)
    assert [r.text for r in out.filter("doc_id = 1").collect()] == [None]


def test_untouched_texts_stay_and_cuts_keep_the_rest(spark, make_docs):
    shared = " ".join(f"s{i}" for i in range(60))
    rows = [(1, f"one\n two  {shared}\nthree"), (2, f"four\t five  {shared}\n six \n")]
    out = {r.doc_id: r.text for r in remove_repeats(make_docs(rows)).collect()}
    assert out == {1: rows[0][1], 2: "four\t five  six \n"}


@pytest.mark.parametrize("n", [0])
def test_empty_table(spark, make_docs, n):
    assert remove_repeats(make_docs([])).count() == n


def test_internal_names_as_columns(spark, make_docs):
    """A user's columns keep their names and values, the internal ones' too."""
    from pyspark.sql import functions as F
    text = " ".join(f"w{i}" for i in range(60))
    docs = (make_docs([(1, text), (2, text + " tail"), (3, None)]).withColumn("_chunk", F.col("doc_id") * 10)
            .withColumn("_bytes", F.lit("b")).withColumn("_chunk_", F.lit("c")))
    from seqtally.llm.substring import remove_repeats
    out = remove_repeats(docs)
    assert out.columns == [*docs.columns, "n_words", "n_removed"]
    got = sorted((r.doc_id, r._chunk, r._bytes, r._chunk_, r.n_words, r.n_removed) for r in out.collect())
    assert got == [(1, 10, "b", "c", 60, 0), (2, 20, "b", "c", 61, 60), (3, 30, "b", "c", 0, 0)]


def test_more_partitions_than_buckets(spark, make_docs):
    """Beyond the most buckets that Spark takes, a bucket holds several chunks'
    rows; no table is left in the catalog."""
    from seqtally.llm import substring
    rows = [(i, " ".join(f"w{i % 7}x{j}" for j in range(80))) for i in range(120)]
    want = sorted((r.doc_id, r.n_removed) for r in substring.remove_repeats(make_docs(rows)).collect())
    before = spark.conf.get("spark.sql.sources.bucketing.maxBuckets")
    spark.conf.set("spark.sql.sources.bucketing.maxBuckets", "8")
    try:
        got = sorted((r.doc_id, r.n_removed) for r in substring.remove_repeats(make_docs(rows).repartition(50)).collect())
    finally:
        spark.conf.set("spark.sql.sources.bucketing.maxBuckets", before)
    assert got == want and sum(n for _, n in want) == 113 * 80
    assert spark.catalog.listTables() == []
