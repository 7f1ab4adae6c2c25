"""Token ids as binary shard files with a shared zstandard dictionary.

Every document's ids are one array of little-endian unsigned integers (16 bits
where the vocabulary allows, else 32), compressed as one zstandard frame of its
own with a dictionary trained on serialized id arrays.  Documents lie in
ascending ``doc_id`` order over the shards, so one document is read by one
seek through the offset index, and a shard of short documents still compresses
like one long stream.

Shard layout::

    magic "SQTOK1\\0\\0" | id width (1) | sha-256 of the dictionary (32)
    one zstandard frame per document, in doc_id order
    index: doc_id int64[n], known uint8[n], offset int64[n], length int64[n], n_ids int64[n]
    n (8) | offset of the index (8) | magic

The dictionary lies beside the shards as ``dictionary-<sha-256>.zstd``.

Defined results: a null or empty text has no ids but the end id; a null doc_id
is kept, lies before all others and comes back null; rows that share a doc_id
are kept, in the order of their ids; further columns are ignored; an empty
table makes no shard and no rows."""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seqtally.llm._bpe import IdCache, WordTokenizer
from seqtally.llm._files import filesystem, new_folder, own_name, staged
from seqtally.llm._sample import hashed_sample
from seqtally.llm._words import pieces

MAGIC = b"SQTOK1\0\0"
_HEAD = struct.Struct("<8sB32s")
_TAIL = struct.Struct("<QQ8s")
#: Text that is split and encoded at once.
PIECE_BYTES = 2 << 20
#: A task starts another shard beyond so many bytes of frames.
SHARD_BYTES = 256 << 20
#: The dictionary's sample: about so many documents of at most so many characters.
SAMPLE_DOCS, SAMPLE_CHARS = 1000, 8192
DICTIONARY_BYTES = 64 << 10
LEVEL = 3

FRAMES = "doc_id long, n_tokens long, frame binary"
SHARDS = "part int, seq int, file string, n_docs long, n_tokens long"

_workers: dict[str, IdCache] = {}


def _cache(path: str) -> IdCache:
    if path not in _workers:
        _workers[path] = IdCache(WordTokenizer(path))
    return _workers[path]


def _encode(texts: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the texts, joined, and the n + 1 bounds of each text's ids."""
    cache = _cache(path)
    words, ref, bounds = cache.tokenizer.split(texts)
    if not len(ref):
        return np.empty(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
    ids, ends = cache.ids(cache.numbers(words)[ref])
    return ids, ends[bounds]


def train_dictionary(docs: DataFrame, tokenizer: str, end_id: int, width: int) -> bytes:
    """A dictionary trained on the id arrays of about ``SAMPLE_DOCS`` short
    documents (a bounded sample, picked by a hash); empty where there are too
    few to train on."""
    import zstandard
    short = docs.select("doc_id", "text").filter(F.length("text").between(1, SAMPLE_CHARS))
    sample = sorted(hashed_sample(short, SAMPLE_DOCS, "doc_id", "text").collect(), key=lambda r: r.text)
    arrays = []
    for row in sample:
        ids, _ = _encode([row.text], tokenizer)
        arrays.append(np.append(ids, end_id).astype(f"<u{width}").tobytes())
    _workers.clear()
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, arrays).as_bytes()
    except zstandard.ZstdError:
        return b""


def _compressor(dictionary: bytes):
    import zstandard
    if not dictionary:
        return zstandard.ZstdCompressor(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary))


def _decompressor(dictionary: bytes):
    import zstandard
    if not dictionary:
        return zstandard.ZstdDecompressor()
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))


def encode_frames(docs: DataFrame, tokenizer: str, end_id: int, width: int, dictionary: bytes) -> DataFrame:
    """doc_id, n_tokens and the compressed id array of every document."""
    def run(batches):
        press = _compressor(dictionary)
        for batch in batches:
            for part in pieces(batch, max_bytes=PIECE_BYTES):
                texts = [t or "" for t in part.column("text").to_pylist()]
                ids, bounds = _encode(texts, tokenizer)
                counts, frames = [], []
                for a, b in zip(bounds[:-1], bounds[1:]):
                    own = np.append(ids[a:b], np.uint32(end_id))
                    counts.append(len(own))
                    frames.append(press.compress(own.astype(f"<u{width}").tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), pa.array(counts, pa.int64()), pa.array(frames, pa.binary())],
                    names=["doc_id", "n_tokens", "frame"])
    return docs.select("doc_id", "text").mapInArrow(run, FRAMES)


class _Shard:
    """One shard file being written."""

    def __init__(self, folder: str, part: int, width: int, digest: bytes):
        fs, path = filesystem(folder)
        self.file = own_name(f"tokens-{part:06d}", ".bin")
        self.out = fs.open_output_stream(f"{path}/{self.file}")
        self.out.write(_HEAD.pack(MAGIC, width, digest))
        self.at, self.rows = _HEAD.size, []

    def add(self, doc_id, frame: bytes, n: int):
        self.out.write(frame)
        self.rows.append((0 if doc_id is None else doc_id, doc_id is not None, self.at, len(frame), n))
        self.at += len(frame)

    def close(self) -> tuple[int, int]:
        ids, known, offsets, lengths, counts = map(list, zip(*self.rows))
        for values, kind in ((ids, "<i8"), (known, "u1"), (offsets, "<i8"), (lengths, "<i8"), (counts, "<i8")):
            self.out.write(np.array(values, kind).tobytes())
        self.out.write(_TAIL.pack(len(ids), self.at, MAGIC))
        self.out.close()
        return len(ids), sum(counts)


def write_shards(frames: DataFrame, folder: str, width: int, digest: bytes) -> DataFrame:
    """Write the frames in ascending doc_id order (then by n_tokens and by a hash
    of the frame, then as they were read); one row per shard.  Rows that share a
    doc_id, or are alike in everything, are dealt to as many tasks as others."""
    def run(batches):
        part, seq, shard = TaskContext.get().partitionId(), 0, None
        done = []

        def close():
            n, total = shard.close()
            done.append((part, seq, shard.file, n, total))
        for batch in batches:
            for doc_id, n, frame in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n_tokens", "frame"))):
                if shard is not None and shard.at > SHARD_BYTES:
                    close()
                    seq, shard = seq + 1, None
                if shard is None:
                    shard = _Shard(folder, part, width, digest)
                shard.add(doc_id, frame, n)
        if shard is not None:
            close()
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*done), (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()))],
                names=["part", "seq", "file", "n_docs", "n_tokens"])
    order = ["doc_id", "n_tokens", "hash", "place"]
    placed = frames.withColumn("hash", F.xxhash64("frame")).withColumn("place", F.monotonically_increasing_id())
    ordered = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    return ordered.mapInArrow(run, SHARDS)


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> DataFrame:
    """Encode ``docs`` (doc_id, text) and write dictionary and shards to
    ``folder``; the table of shards, itself written to the shared folder."""
    width = 2 if max(WordTokenizer(tokenizer).words.get_vocab_size(True), end_id + 1) <= 1 << 16 else 4
    dictionary = train_dictionary(docs, tokenizer, end_id, width)
    digest = hashlib.sha256(dictionary).digest()
    fs, path = filesystem(folder)
    with fs.open_output_stream(f"{path}/dictionary-{digest.hex()}.zstd") as out:
        out.write(dictionary)
    frames = staged(encode_frames(docs, tokenizer, end_id, width, dictionary), "token-frames")
    return staged(write_shards(frames, folder, width, digest), "token-shards")


def _open(folder: str, file: str, known: dict[bytes, bytes]):
    """(file, id width, dictionary, index arrays) of a shard, checked."""
    fs, path = filesystem(folder)
    f = fs.open_input_file(f"{path}/{file}")
    magic, width, digest = _HEAD.unpack(f.read_at(_HEAD.size, 0))
    size = f.size()
    n, at, end = _TAIL.unpack(f.read_at(_TAIL.size, size - _TAIL.size))
    if magic != MAGIC or end != MAGIC or at + n * 33 + _TAIL.size != size:
        raise ValueError(f"{file} is not a whole token shard")
    if digest not in known:
        with fs.open_input_stream(f"{path}/dictionary-{digest.hex()}.zstd") as d:
            known[digest] = d.read()
        if hashlib.sha256(known[digest]).digest() != digest:
            raise ValueError(f"the dictionary of {file} is another one")
    raw = f.read_at(n * 33, at)
    ids = np.frombuffer(raw, "<i8", n)
    present = np.frombuffer(raw, "u1", n, 8 * n)
    rest = [np.frombuffer(raw, "<i8", n, 9 * n + 8 * n * k) for k in range(3)]
    return f, width, known[digest], (ids, present, *rest)


def read_document(folder: str, file: str, doc_id: int) -> list[np.ndarray]:
    """The id arrays that a shard holds for one document: the index, then one
    read and one frame for each."""
    f, width, dictionary, (ids, present, offsets, lengths, _) = _open(folder, file, {})
    unpress = _decompressor(dictionary)
    with f:
        return [np.frombuffer(unpress.decompress(f.read_at(int(lengths[k]), int(offsets[k]))), f"<u{width}").astype("<u4")
                for k in np.flatnonzero((ids == doc_id) & (present == 1))]


def read_shards(shards: DataFrame, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32
    (of the ids as little-endian unsigned 32-bit integers) read from the files.

    The window runs over one row per shard, not over documents."""
    def run(batches):
        known: dict[bytes, bytes] = {}
        for batch in batches:
            for file, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                f, width, dictionary, (ids, present, offsets, lengths, counts) = _open(folder, file, known)
                unpress = _decompressor(dictionary)
                starts, crcs = start + np.cumsum(counts) - counts, np.empty(len(ids), np.int64)
                with f:
                    for k in range(len(ids)):
                        own = np.frombuffer(unpress.decompress(f.read_at(int(lengths[k]), int(offsets[k]))), f"<u{width}")
                        if len(own) != counts[k]:
                            raise ValueError(f"{file}: document {ids[k]} has {len(own)} ids, its index says {counts[k]}")
                        crcs[k] = zlib.crc32(own.astype("<u4").tobytes())
                for i in range(0, len(ids), 100_000):
                    j = slice(i, i + 100_000)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[j], mask=present[j] == 0), pa.array(starts[j]), pa.array(counts[j]), pa.array(crcs[j])],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"])
    order = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    placed = shards.select("file", F.coalesce(F.sum("n_tokens").over(order), F.lit(0)).alias("start"))
    many = max(1, shards.count())
    return placed.repartition(many).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_file_table(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Write ``docs`` to a fresh shared folder and read the files back."""
    folder = new_folder(spark, "tokens")
    return read_shards(write_tokens(docs, folder, tokenizer, end_id), folder)
