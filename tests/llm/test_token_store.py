"""Token shards and the distinct-word table against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from seqtally.llm import _bpe, bpe_table, token_store
from seqtally.llm._bpe import WordTokenizer
from seqtally.llm._files import filesystem, new_folder

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return WordTokenizer(PATH)


def corpus():
    rnd = random.Random(6)
    bits = list("aAbsStTmdDrRevVlL'''\"!?-_ \t\n12é É ñß½²\xa0İΣσ漢字́éJ̌ẞ \x1c\x85\x00😀K")
    bits += ["<|endoftext|>", "<|startoftext|>", "'s", "'ll", "'re", "'ve", " the ", " Über "]
    rows = [(i * 3, "".join(rnd.choice(bits[:38 if i % 2 else None]) for _ in range(rnd.randrange(60)))) for i in range(800)]
    rows += [(5000, None), (5001, ""), (None, "no id"), (6, rows[2][1]), (6, "again"), (6000, "word'll " * 60_000), (6001, "x" * 100_000)]
    rnd.shuffle(rows)
    return rows


def test_split_and_encode_words_like_the_library(tokenizer):
    texts = [t or "" for _, t in corpus()]
    words, ref, bounds = tokenizer.split(texts)
    ids, counts = tokenizer.encode_words(words)
    each = np.split(ids, np.cumsum(counts)[:-1])
    for k, e in enumerate(tokenizer.whole.encode_batch(texts, add_special_tokens=False)):
        assert [i for w in ref[bounds[k]:bounds[k + 1]] for i in each[w]] == e.ids


def test_words_are_encoded_some_at_a_time(tokenizer):
    own, sizes = WordTokenizer(PATH), []

    class Watched:
        def encode_batch_fast(self, texts, **options):
            sizes.append(len(texts))
            return tokenizer.words.encode_batch_fast(texts, **options)
    own.words = Watched()
    words = [f"{a}{b}{c}" for a in "abcdefgh" for b in "ijklmnopqrstuvwxyz" for c in range(200)]
    ids, counts = own.encode_words(words)
    want = tokenizer.words.encode_batch(words, add_special_tokens=False)
    assert ids.tolist() == [i for e in want for i in e.ids] and counts.tolist() == [len(e.ids) for e in want]
    assert len(sizes) > 1 and max(sizes) <= _bpe.AT_ONCE
    assert "whole" not in vars(own)  # no second copy of the vocabulary


def test_shards_round_trip(spark, make_docs, tokenizer, monkeypatch):
    monkeypatch.setattr(token_store, "SAMPLE_DOCS", 300)
    rows = corpus()
    docs = make_docs(rows).withColumn("n_tokens", F.lit("clash")).repartition(4)
    got = token_store.token_file_table(spark, docs, PATH, 2).collect()
    want = []
    for doc, text in rows:
        ids = tokenizer.whole.encode(text or "", add_special_tokens=False).ids + [2]
        want.append((doc, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=str) == sorted(want, key=str)
    got.sort(key=lambda r: r.start)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in got]
    assert ids[0] is None and ids[1:] == sorted(ids[1:])


def test_single_documents_and_damage(spark, make_docs, tokenizer):
    folder = new_folder(spark, "tokens-test")
    shards = token_store.write_tokens(make_docs([(i, f"text number {i}") for i in range(200)]), folder, PATH, 2).collect()
    file = next(s.file for s in sorted(shards, key=lambda s: (s.part, s.seq)))
    ids, = token_store.read_document(folder, file, 0)
    assert ids.tolist() == tokenizer.whole.encode("text number 0", add_special_tokens=False).ids + [2]
    assert token_store.read_document(folder, file, 10 ** 9) == []
    fs, path = filesystem(folder)
    with fs.open_input_stream(f"{path}/{file}") as f:
        data = f.read()
    with fs.open_output_stream(f"{path}/short.bin") as f:
        f.write(data[:-3])
    with pytest.raises(ValueError):
        token_store.read_document(folder, "short.bin", 0)


@pytest.mark.parametrize("chunk", [bpe_table.CHUNK_CHARS, 4000])
def test_word_table_matches_the_library(spark, make_docs, tokenizer, monkeypatch, chunk):
    monkeypatch.setattr(bpe_table, "CHUNK_CHARS", chunk)
    rows = corpus()
    got = bpe_table.bpe_digests(make_docs(rows).withColumn("ids", F.lit(1)).repartition(3), PATH).collect()
    want = []
    for doc, text in rows:
        ids = tokenizer.whole.encode(text or "", add_special_tokens=False).ids
        said = tokenizer.whole.decode(ids, skip_special_tokens=False)
        want.append((doc, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(said.encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_decode_a_table_of_ids(spark, tokenizer):
    texts = ["Hello world's <|endoftext|>", "", "é 12"]
    rows = [(i, bytearray(np.array(tokenizer.whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes())) for i, t in enumerate(texts)]
    got = bpe_table.decode_documents(spark.createDataFrame([*rows, (9, None)], "doc_id long, ids binary"), PATH).collect()
    want = {i: tokenizer.whole.decode(tokenizer.whole.encode(t, add_special_tokens=False).ids, skip_special_tokens=False) for i, t in enumerate(texts)}
    assert {r.doc_id: r.decoded for r in got} == {**want, 9: ""}


def test_words_that_repeat_in_a_batch(tokenizer):
    from seqtally.llm._bpe import IdCache
    cache, rnd = IdCache(tokenizer, limit=300), random.Random(2)
    for _ in range(40):
        words = ["".join(rnd.choice("abc") for _ in range(rnd.randrange(1, 6))) for _ in range(200)]
        ids, bounds = cache.ids(cache.numbers(words))
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == [
            e.ids for e in tokenizer.whole.encode_batch(words, add_special_tokens=False)]


def test_words_of_many_pieces_are_encoded_once():
    from seqtally.llm._bpe import IdCache
    encoded = []

    class Lengths:
        def encode_words(self, words):
            encoded.extend(words)
            return np.array([len(w) for w in words], np.uint32), np.ones(len(words), np.int64)
    cache = IdCache(Lengths())
    pieces = [[f"{k} {i}" for i in range(70_000)] for k in range(5)]
    for piece in [*pieces, *pieces]:
        ids, _ = cache.ids(cache.numbers(piece))
        assert ids.tolist() == [len(w) for w in piece]
    assert len(encoded) == 350_000
    cache = IdCache(Lengths(), limit=10)  # long words fill it too
    for c in "abcd":
        assert cache.ids(cache.numbers([c * 100, c]))[0].tolist() == [100, 1]
        assert sum(map(len, cache.number)) <= 160


def test_empty_tables(spark, make_docs):
    assert token_store.token_file_table(spark, make_docs([]), PATH, 2).count() == 0
    assert bpe_table.bpe_digests(make_docs([]), PATH).count() == 0


def test_one_doc_id_in_many_tasks(spark, make_docs):
    """A doc_id that holds nearly all rows, most of them alike, is written by
    several tasks, and read back in order."""
    rows = [(7, "same words here")] * 3000 + [(7, f"other {i}") for i in range(500)] + [(None, "none")] * 500 + [(1, "a"), (9, "z")]
    folder = token_store.new_folder(spark, "tokens")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        shards = token_store.write_tokens(make_docs(rows).repartition(4), folder, PATH, 2)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r.n_docs for r in shards.collect()]
    assert sum(sizes) == len(rows) and len(sizes) >= 6 and max(sizes) < 1500
    back = token_store.read_shards(shards, folder).sort("start").collect()
    assert [r.start for r in back] == [sum(x.n_tokens for x in back[:i]) for i in range(len(back))]
    ids = [-1 if r.doc_id is None else r.doc_id for r in back]
    assert ids == sorted(ids) and ids.count(7) == 3500
