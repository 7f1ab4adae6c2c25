"""The pipeline against brute force on a small corpus, and its stages."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from seqtally.llm import dart_minhash, quality_rules
from seqtally.llm._bpe import load
from seqtally.llm._files import new_folder

from . import test_dart_minhash, test_decontam, test_models, test_substring

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rnd = random.Random(8)
    word = lambda: rnd.choice("abcdefgh") + f"{rnd.randrange(2000)}"
    passage, item = [word() for _ in range(70)], [word() for _ in range(14)]
    rows, labels = [], []
    for i in range(260):
        ws = [word() for _ in range(rnd.choice([20, 70, 150, 260]))]
        if rnd.random() < 0.2:
            ws[30:30] = passage
        if rnd.random() < 0.1:
            ws[5:5] = item
        bad = rnd.random() < 0.3
        rows.append((i, " ".join(f"{w}###" if bad else w for w in ws)))
        labels.append((i, int(not bad), 0))
    for i in range(260, 330):  # exact and near copies
        own = rnd.choice(rows)[1].split()
        for _ in range(rnd.choice([0, 0, 1, 2])):
            own[rnd.randrange(len(own))] = word()
        rows.append((i, " ".join(own)))
    rows += [(400, None), (401, ""), (402, " ".join(passage)), (3, rows[3][1]), (None, " ".join(word() for _ in range(90)))]
    rnd.shuffle(rows)
    return rows, labels, [(1, " ".join(item)), (2, None)]


@pytest.fixture(scope="module")
def folder(spark):
    rows, labels, items = corpus()
    path = new_folder(spark, "pipeline-test")
    docs = spark.createDataFrame([(i, t, None, "s", len(t or "")) for i, t in rows], DOCS)
    docs.repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def brute(spark, folder):
    rows, _, items = corpus()
    model = quality_rules.train(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    kept = []
    for doc, text in rows:
        n, _, _, _, repeats = test_models.brute(text or "")
        score = model.score(quality_rules.statistics(pa.array([text or ""]))[1])[0]
        if not (n < 50 or 100 * repeats > 50 * n) and score >= quality_rules.THRESHOLD:
            kept.append((doc, text))
    kept = [r for k, r in enumerate(kept) if r not in kept[:k]]  # rows alike
    classes = dict(test_dart_minhash.brute(kept))
    kept = [(d, t) for d, t in kept if d is None or classes[d] == d]
    cut = [(d, t) for d, n, gone, t in test_substring.brute(kept) if gone == 0 or gone < n]
    hit = {d for d, _, n, _ in test_decontam.brute(cut, items) if n}
    tok, out = load(public_tokenizers.path("word_bpe_49k.json")), []
    for d, t in cut:
        if d not in hit:
            ids = tok.encode(t, add_special_tokens=False).ids
            out.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                        hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    return sorted(out, key=str)


def test_run_matches_brute_force(spark, folder):
    got = sorted(map(tuple, corpus_pipeline.run(spark, folder).collect()), key=str)
    want = brute(spark, folder)
    assert got == want
    assert 100 < len(want) < 230


def test_stages_keep_the_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert len(corpus_pipeline.STAGES) == 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).schema.simpleString() == docs.schema.simpleString()
        assert stage(spark, docs.filter("false"), folder).count() == 0
    text = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.substring_duplicates(spark, docs, folder).collect()}
    assert all(n == len(t or "") for t, n in text.values())


def test_one_of_each(spark, make_docs):
    copy = " ".join(f"w{i}" for i in range(80))
    docs = make_docs([(3, copy), (2, copy), (2, copy), (5, copy + " more"), (7, "other"), (8, None), (9, "..."), (None, "no id")])
    assert sorted((str(r.doc_id) for r in dart_minhash.one_of_each(docs).collect())) == ["2", "7", "8", "9", "None"]
    assert dart_minhash.one_of_each(docs.filter(F.lit(False))).count() == 0
