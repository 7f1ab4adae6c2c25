"""Decontamination against a brute-force scan, and the removal of spans."""

import random
import re

from pyspark.sql import functions as F

from seqtally.llm import decontam
from seqtally.llm.decontam import contamination, remove_documents, remove_spans

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(rows, items):
    grams = {}
    for item, t in items:
        ws = words(t)
        for i in range(max(len(ws) - 9, 1) if ws else 0):
            grams.setdefault(tuple(ws[i:i + 10]), set()).add(str(item))
    sizes = {len(g) for g in grams}
    out = []
    for doc, t in rows:
        ws, hit, found = words(t), set(), set()
        for n in sizes:
            for i in range(len(ws) - n + 1):
                for item in grams.get(tuple(ws[i:i + n]), ()):
                    hit.update(range(i, i + n))
                    found.add(item)
        out.append((doc, len(ws), len(hit), tuple(sorted(found))))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in df.collect()), key=str)


def corpus():
    rnd = random.Random(2)
    word = lambda: rnd.choice(["the", "of", "Éa", "b2", "x", "Çö", "zu"]) + rnd.choice(["", "n", "S"])
    items = [(i, " ".join(word() for _ in range(rnd.choice([0, 1, 3, 9, 10, 11, 25])))) for i in range(14)]
    items += [(99, None), (98, "..."), (97, items[5][1]), (5, items[6][1])]
    rows = []
    for i in range(150):
        ws = [word() for _ in range(rnd.choice([0, 2, 12, 60]))]
        for _ in range(rnd.randrange(3)):
            at = rnd.randrange(len(ws) + 1)
            ws[at:at] = (rnd.choice(items)[1] or "").upper().split()
        rows.append((i, rnd.choice([" ", ", ", "--", "\n"]).join(ws)))
    rows += [(1000, None), (None, rows[3][1]), (7, rows[7][1]), (7, rows[8][1]), (1001, "|" * 5000), (1002, "\x00a\x7fb" * 40),
             (1003, " ".join(["pad"] * 30_000) + " " + items[10][1])]
    return rows, items


def test_matches_brute_force(spark, make_docs):
    rows, items = corpus()
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = make_docs(rows).withColumn("item_id", F.lit("clash")).repartition(4)
    assert result(contamination(docs, bench)) == brute(rows, items)


def test_shuffled_window_set(spark, make_docs, monkeypatch):
    monkeypatch.setattr(decontam, "BROADCAST_BYTES", 0)
    rows, items = corpus()
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert result(contamination(make_docs(rows), bench)) == brute(rows, items)


def test_removal(spark, make_docs):
    rows, items = corpus()
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute(rows, items)
    kept = remove_documents(make_docs(rows), bench)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(w[0]) for w in want if not w[2])
    after = {(r.doc_id, r.text) for r in remove_spans(make_docs(rows), bench).collect()}
    assert sorted((str(d), len(words(t))) for d, t in after) == sorted({(str(w[0]), w[1] - w[2]) for w in want})
    text = "One, two; q1 q2 q3 q4 q5 q6 q7 q8 q9 q10!  three."
    one = remove_spans(make_docs([(1, text)]), spark.createDataFrame([(1, text[10:40])], "item_id long, text string"))
    assert one.first().text == "One, two!  three."


def test_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert result(contamination(make_docs([(1, "a b")]), none)) == [(1, 2, 0, ())]
    assert contamination(make_docs([]), none).count() == 0


def test_items_that_share_windows_do_not_multiply_hits(spark, make_docs):
    """300 items with one beginning, in 200 documents: a row for each occurrence
    and one for each document, and every item is told."""
    start = " ".join(f"s{i}" for i in range(10))
    items = [(i, f"{start} own{i}") for i in range(300)] + [(300, None)]
    rows = [(d, f"text {d} {start} more") for d in range(200)] + [(900, "clean"), (900, "clean"), (None, start)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    grams = decontam.window_set(bench)
    assert grams.count() == 301
    assert decontam.hits(make_docs(rows), grams).count() == 201 + 203
    got = contamination(make_docs(rows), bench)
    assert {(r.doc_id, r.n_hit, len(r["items"])) for r in got.collect()} == (
        {(d, 10, 300) for d in range(200)} | {(None, 10, 300), (900, 0, 0)})
    assert got.count() == 203
    assert sorted(r.doc_id for r in remove_documents(make_docs(rows), bench).collect()) == [900, 900]
