"""The divergence audit against prices summed term by term."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from seqtally.llm import divergence
from seqtally.llm.divergence import audit, pair_prices, shares

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def plain(rows):
    own, held, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source, _ in rows:
        lang, source = lang or "", source or ""
        terms = TERM.findall(lower(text or ""))
        groups.add((lang, source))
        own[lang, source].update(terms)
        held[lang].update(set(terms))
    out = []
    for lang in {g for g, _ in groups}:
        kept = sorted(t for t, n in held[lang].items() if n >= 3)
        names = [s for g, s in groups if g == lang]

        def p_of(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10 ** 9 * (counts[t] + 1) // (total + len(kept)) for t in kept}
        p = {s: p_of(own[lang, s]) for s in names}
        q = p_of(sum((own[lang, s] for s in names), Counter()))
        for s in names:
            pairs = [(sum((p[s][t] - p[h][t]) ** 2 // p[h][t] for t in kept), h) for h in names if h != s]
            terms = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if own[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, 200)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, i, v, r + 1) for r, (v, i) in enumerate(found[:most])]
    return sorted(out)


def corpus():
    rnd = random.Random(13)
    words = [rnd.choice(["wa", "Zé", "ω", "x"]) + "".join(rnd.choices("abc", k=rnd.randrange(1, 5))) for _ in range(600)]
    rows = []
    for i in range(300):
        lang, source = rnd.choice(["en", "en", "de", "", None]), rnd.choice(["s1", "s1", "s1", "é", "\U0001f600", "", None])
        ws = rnd.choices(words, weights=[1 / (k + 1) for k in range(600)], k=rnd.choice([0, 3, 40, 300]))
        rows.append((i, rnd.choice([" ", "--", "1\n"]).join(ws), lang, source, None))
    rows += [(1, None, "en", "none", None), (2, "...", "en", "none", None), (None, "alone word", "it", "a", None),
             (4, "other", "it", "b", None), (5, None, None, None, None), (6, "x " * 200_000, "de", "s1", None)]
    return rows + [(7, "Copy copy COPY of a row", "en", "cc", None)] * 40


def result(df):
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(map(tuple, df.collect()))


def test_matches_plain_sums(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, DOCS).withColumn("term", F.lit("clash")).withColumn("n", F.lit(7))
    assert result(audit(docs.repartition(4))) == plain(rows)


def test_small_blocks_and_joins(spark, monkeypatch):
    from seqtally.operators import _util
    monkeypatch.setattr(_util, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(divergence, "BLOCK_TERMS", 20)
    monkeypatch.setattr(divergence, "PIECE", 16)
    monkeypatch.setattr(divergence, "HELD", 50)
    rows = corpus()
    assert result(audit(spark.createDataFrame(rows, DOCS).repartition(3))) == plain(rows)


@pytest.mark.parametrize("terms, groups, most", [(3000, 5, 3), (400, 30, 10 ** 6), (40, 300, 50), (1, 2, 5)])
def test_products_price_as_term_by_term(terms, groups, most):
    rnd = np.random.default_rng(terms)
    levels = np.floor(most * rnd.random((terms, groups)) ** 4).astype(np.int64)
    sizes = levels.sum(axis=0)
    p = shares(levels, sizes, terms)
    want = np.zeros((groups, groups), np.int64)
    for g in range(groups):
        want[g] = ((p[:, [g]] - p) ** 2 // p).sum(axis=0)
    assert (pair_prices(levels, sizes, terms) == want).all()


def test_shares_of_large_counts(spark):
    cases = [(0, 0, 1), (5, 9, 3), (10 ** 13, 10 ** 14 + 7, 12345), (10 ** 9 - 1, 10 ** 9, 1), (7 * 10 ** 14, 8 * 10 ** 14, 99)]
    for n, size, terms in cases:
        want = 1 + 10 ** 9 * (n + 1) // (size + terms)
        assert int(shares(np.array([n]), np.array([size]), terms)[0]) == want
        row = spark.createDataFrame([(n, size, terms)], "n long, size long, terms long")
        assert row.select(F.expr(divergence._SHARE.format("n", "size"))).first()[0] == want


def test_top_terms_and_empty_tables(spark):
    assert audit(spark.createDataFrame([], DOCS)).collect() == []
    rows = [(i, " ".join(f"t{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(500)), "en", "a", None) for i in range(3)]
    rows += [(9, "other", "en", "b", None)]
    got = result(audit(spark.createDataFrame(rows, DOCS)))
    assert got == plain(rows) and sum(r[2] == "term" for r in got) <= 200
    assert result(audit(spark.createDataFrame(rows[:1], DOCS))) == []


def test_shares_of_small_and_large_counts(spark):
    """In one product where that fits 64 bits, without the digit-by-digit loop."""
    rows = [(n, size, terms) for n in (0, 1, 7, 10 ** 6, 8_999_999_999, 9_000_000_000, 10 ** 14)
            for size in (n, n + 5, 3 * n + 1) for terms in (1, 977)]
    df = spark.createDataFrame(rows, "n long, size long, terms long")
    share = F.expr(divergence._SHARE.format("n", "size"))
    got = [tuple(r) for r in df.select("n", "size", "terms", share.alias("p")).collect()]
    assert got == [(n, s, t, 1 + 10 ** 9 * (n + 1) // (s + t)) for n, s, t in rows]
    assert divergence._SHARE.startswith("1 + if({0} < 9000000000, (({0} + 1) * 1000000000) div")
