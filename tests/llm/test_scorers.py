"""The scores of op2, op4 and op8 against plain loops over their models."""

import math
import random

import numpy as np
import pytest

from seqtally.llm import compress_quality, langid, quality_rules

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_compression_scores_block_by_block(spark, tables):
    """Each text compressed block by block with each dictionary, one after the
    other, and the calibration by hand."""
    import zstandard
    docs, labels = tables
    model = compress_quality.train(docs, labels)

    def sizes(data, dictionary):
        d = zstandard.ZstdCompressionDict(dictionary)
        press = zstandard.ZstdCompressor(level=compress_quality.LEVEL, dict_data=d)
        return sum(len(press.compress(data[i:i + compress_quality.BLOCK])) for i in range(0, len(data), compress_quality.BLOCK))
    got = compress_quality.score_quality(docs, model).select("doc_id", "text", "score").collect()
    for r in random.Random(1).sample(got, 200):
        data = (r.text or "").encode()
        margin = model.intercept + model.short * 64 / (64 + len(data))
        if data:
            margin += model.slope * (sizes(data, model.bad) - sizes(data, model.good)) / len(data)
        assert r.score == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, margin)))), abs=1e-12)


def test_language_scores_word_by_word(spark, tables):
    """Words, their trigrams' scores, the best path and the letters' totals of each
    text by itself, with plain loops."""
    docs, _ = tables
    model = langid.train(docs)
    letters = langid._letters()
    rows = docs.sort("doc_id").limit(40).collect()
    k = len(model.languages)

    def bucket(a, b, c):
        m = (1 << 64) - 1
        h = (a << 42 ^ b << 21 ^ c) & m
        h = (h ^ h >> 29) * 0xBF58476D1CE4E5B9 & m
        h = (h ^ h >> 32) * 0x94D049BB133111EB & m
        return h >> 49
    got = {r.doc_id: r for r in langid.label_languages(docs, model).collect()}
    for row in rows:
        text = langid._lower(row.text or "")
        words, now = [], None
        for at, c in enumerate(text + "\n"):
            kind = letters[ord(c)]
            if now is None and kind == 2:
                now = at
            elif now is not None and kind == 0:
                words.append((now, at))
                now = None
        scores = []
        for a, b in words:
            codes = [32, *map(ord, text[a:b]), 32]
            grams = [bucket(*codes[i:i + 3]) for i in range(len(codes) - 2)]
            script = langid._CODES[np.searchsorted(langid._STARTS, codes[1], "right") - 1]
            own = [float(np.add.reduce(model.scores[grams, j])) for j in range(k)]
            used = model.scripts[script]
            scores.append([s if u else -1e6 for s, u in zip(own, used)] if used.any() else [0.0] * k)
        if not words:
            assert got[row.doc_id].lang_pred == "und"
            continue
        best = np.array(scores[0])
        back = []
        for s in scores[1:]:
            top = int(best.argmax())
            back.append([j if best[j] >= best[top] - langid.SWITCH else top for j in range(k)])
            best = np.maximum(best, best[top] - langid.SWITCH) + s
        path = [int(best.argmax())]
        for b in reversed(back):
            path.append(b[path[-1]])
        total = np.bincount(path[::-1], [b - a for a, b in words], minlength=k)
        assert got[row.doc_id].lang_pred == model.languages[int(total.argmax())]
        assert got[row.doc_id].score == pytest.approx(total.max() / total.sum(), abs=0.02)


def test_trees_node_by_node(spark, tables):
    """Each document's features sent down every tree, one node after the other."""
    docs, labels = tables
    trees = quality_rules.train(docs, labels)
    got = quality_rules.apply_rules(docs, trees).select("text", "score", "kept", "base_failed").collect()
    import pyarrow as pa
    sample = random.Random(2).sample(got, 150)
    _, x = quality_rules.statistics(pa.array([r.text or "" for r in sample]))
    for row, features in zip(sample, x):
        margin = trees.base
        for root in trees.roots:
            node = root
            while trees.left[node] != node:
                node = trees.left[node] if features[trees.feature[node]] <= trees.threshold[node] else trees.right[node]
            margin += trees.value[node]
        assert row.score == pytest.approx(1 / (1 + math.exp(-margin)), abs=1e-9)
        assert row.kept == (not row.base_failed and row.score >= quality_rules.THRESHOLD)
