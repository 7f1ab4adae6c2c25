"""BPE through a table of distinct words.

Documents are split into words chunk by chunk (a chunk is a run of documents of
``CHUNK_CHARS`` characters); a chunk keeps its distinct words once and each
document as word numbers.  A chunk's words are dealt out by a hash of the word,
one compressed row for each range of the hash, so that every distinct word of
the corpus is encoded in one place; the ids go back to the chunks in the same
order and are joined to the documents by position.  What is shuffled are
distinct words per chunk, never word positions or texts: a word that makes up a
third of all positions costs one entry per chunk.  The chunk table is bucketed
by chunk, so it is written once and never shuffled.

Decoding joins ids to pieces: the distinct ids of the corpus meet the table of the
vocabulary (id, piece) in a join, and documents are written out with the pieces that
come back (no more than the vocabulary has), separated by blanks, as the library
decodes a tokenizer without a decoder.

Defined results: a null or empty text has no ids and decodes to the empty
string; null and repeated doc_ids are kept row by row; further columns are
ignored; a text longer than a chunk is a chunk of its own."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqtally.llm._bpe import WordTokenizer, load, take_runs
from seqtally.llm._files import bucket_count, staged, staged_buckets
from seqtally.llm._planes import pack, unpack
from seqtally.llm._words import pieces
from seqtally.operators._util import broadcast_if_small

#: Characters of text in a chunk; bounds what a task holds at once.
CHUNK_CHARS = 4 << 20

_CHUNKS = pa.schema([("chunk", pa.int64()), ("part", pa.int64()), ("doc_id", pa.int64()), ("low", pa.binary()),
                     ("mid", pa.binary()), ("high", pa.binary()), ("top", pa.binary()), ("words", pa.binary()), ("places", pa.binary())])
CHUNKS = ("chunk long, part long, doc_id long, low binary, mid binary, high binary, top binary, words binary, places binary")
_ENCODED = pa.schema([("chunk", pa.int64()), ("part", pa.int64()), ("ids", pa.binary()), ("used", pa.list_(pa.int32()))])
_DOCUMENTS = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())])

PLANES = ("low", "mid", "high", "top")

_workers: dict[str, WordTokenizer] = {}


def _tokenizer(path: str) -> WordTokenizer:
    if path not in _workers:
        _workers[path] = WordTokenizer(path)
    return _workers[path]


class _Chunk:
    """Documents as word numbers, and the chunk's distinct words."""

    def __init__(self, number: int, parts: int):
        self.number, self.parts, self.chars = number, parts, 0
        self.words: dict[str, int] = {}
        self.ids, self.refs = [], []

    def add(self, ids: list, words: list[str], ref: np.ndarray, bounds: np.ndarray):
        own = np.fromiter((self.words.setdefault(w, len(self.words)) for w in words), np.int64, len(words))
        ref = own[ref].astype(np.uint32)
        self.ids += ids
        self.refs += [ref[a:b] for a, b in zip(bounds[:-1], bounds[1:])]

    def batches(self):
        """Documents, then a row for each range with its words in order and
        their numbers.  Frequent words get small numbers, so that the byte
        planes of the documents' numbers compress well; the fourth one is
        written only where a chunk has more than 2^24 words."""
        if not self.ids:
            return
        uses = np.bincount(np.concatenate(self.refs), minlength=len(self.words))
        order = np.argsort(-uses, kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order))
        for i in range(0, len(self.ids), 500):
            planes = [rank[r].astype("<u4").view(np.uint8).reshape(-1, 4) for r in self.refs[i:i + 500]]
            n = len(planes)
            yield self._rows(n, doc_id=self.ids[i:i + n], **{
                name: [p[:, k].tobytes() for p in planes] for k, name in enumerate(PLANES[:3 + (len(order) > 1 << 24)])})
        self.ids, self.refs = [], []
        dealt: dict[int, list[str]] = {}
        for word in self.words:
            dealt.setdefault(zlib.crc32(word.encode()) % self.parts, []).append(word)
        import zstandard
        press = zstandard.ZstdCompressor(level=3)
        for part, words in dealt.items():
            words.sort()
            places = rank[np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))]
            yield self._rows(1, part=[part], words=[press.compress("\n".join(words).encode())], places=[pack((places, 4))])

    def _rows(self, n: int, **columns) -> pa.RecordBatch:
        columns["chunk"] = [self.number] * n
        return pa.RecordBatch.from_arrays([pa.array(columns.get(f.name, [None] * n), f.type) for f in _CHUNKS], schema=_CHUNKS)


def chunk_table(docs: DataFrame, tokenizer: str) -> DataFrame:
    """The chunks of ``docs`` (doc_id, text), bucketed by chunk."""
    parts = bucket_count(docs)

    def run(batches):
        split = _tokenizer(tokenizer).split
        number = TaskContext.get().partitionId() << 32
        chunk = _Chunk(number, parts)
        for batch in batches:
            for part in pieces(batch):
                texts = [t or "" for t in part.column("text").to_pylist()]
                size = sum(map(len, texts))
                if chunk.chars + size > CHUNK_CHARS and chunk.ids:
                    yield from chunk.batches()
                    number += 1
                    chunk = _Chunk(number, parts)
                chunk.chars += size
                chunk.add(part.column("doc_id").cast(pa.int64()).to_pylist(), *split(texts))
        yield from chunk.batches()
    return staged_buckets(docs.select("doc_id", "text").mapInArrow(run, CHUNKS), "bpe-chunks", "chunk", parts)


def encode_words(chunks: DataFrame, tokenizer: str) -> DataFrame:
    """For each chunk and range, the ids of its words in their order, and for each
    range a row without a chunk with the distinct ids (``used``).  All chunks'
    words of a range meet in one task, and each is encoded once."""
    def run(key, table):
        import zstandard
        unpress = zstandard.ZstdDecompressor()
        number: dict[str, int] = {}
        own = []
        for data in table.column("words").to_pylist():
            words = unpress.decompress(data).decode().split("\n")
            own.append(np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words)))
        flat, lengths = _tokenizer(tokenizer).encode_words(list(number))
        bounds = np.concatenate(([0], np.cumsum(lengths)))
        packed = [pack((lengths[which], 4), (take_runs(flat, bounds, which)[0], 4)) for which in own]
        n, part = len(packed), table.column("part").to_pylist()
        used = pa.array([None] * n + [np.unique(flat).astype(np.int32)], pa.list_(pa.int32()))
        return pa.Table.from_arrays([pa.array([*table.column("chunk").to_pylist(), None], pa.int64()),
                                     pa.array([*part, part[0]], pa.int64()), pa.array([*packed, None], pa.binary()), used],
                                    schema=_ENCODED)
    words = chunks.filter("words IS NOT NULL").select("chunk", "part", "words")
    return words.groupBy("part").applyInArrow(run, "chunk long, part long, ids binary, used array<int>")


def used_pieces(encoded: DataFrame, tokenizer: str) -> dict[int, str]:
    """The pieces of the ids in use: their distinct ids joined to the vocabulary;
    at most as many rows as that come to the driver."""
    spark = encoded.sparkSession
    table = spark.createDataFrame(list(enumerate(vocabulary(tokenizer))), "id int, piece string")
    used = encoded.filter("chunk IS NULL").select(F.explode("used").alias("id")).distinct()
    return {r.id: r.piece for r in used.join(broadcast_if_small(table), "id").collect()}


def vocabulary(tokenizer: str) -> list[str]:
    """The piece of each id."""
    known = load(tokenizer).get_vocab(with_added_tokens=True)
    piece = [""] * (max(known.values()) + 1)
    for text, i in known.items():
        piece[i] = text
    return piece


def decode(ids: np.ndarray, piece) -> str:
    """The pieces (a list or a dictionary by id) of ids."""
    return " ".join(map(piece.__getitem__, ids.tolist()))


def encode_documents(docs: DataFrame, tokenizer: str, decoded: bool = False) -> DataFrame:
    """doc_id, ``ids`` (little-endian unsigned 32-bit) and, if asked for,
    ``decoded``: the text that the ids are decoded to (else null)."""
    chunks = chunk_table(docs, tokenizer)
    encoded = staged(encode_words(chunks, tokenizer), "bpe-words")
    piece = used_pieces(encoded, tokenizer) if decoded else None
    right = encoded.filter("chunk IS NOT NULL").select("chunk", "part", "ids")

    def join(left, right):
        lists = left.column("places").to_pylist()
        places = {p: unpack(x, 4)[0].astype(np.int64) for p, x in zip(left.column("part").to_pylist(), lists) if x is not None}
        size = sum(map(len, places.values()))
        start, count, flat, at = np.zeros(size, np.int64), np.zeros(size, np.int64), [], 0
        for p, data in zip(right.column("part").to_pylist(), right.column("ids").to_pylist()):
            lengths, ids = unpack(data, 4, 4)
            lengths = lengths.astype(np.int64)
            start[places[p]], count[places[p]] = at + np.cumsum(lengths) - lengths, lengths
            flat.append(ids.astype("<u4"))
            at += len(ids)
        order = np.cumsum(count) - count
        ids = np.concatenate(flat) if flat else np.empty(0, "<u4")
        ids = ids[np.arange(at) + np.repeat(start - order, count)]
        bounds = np.append(order, at)
        out, found = [], []
        for doc, *planes in zip(*(left.column(c).to_pylist() for c in ("doc_id", *PLANES))):
            if planes[0] is None:
                continue
            ref = np.zeros(len(planes[0]), np.int64)
            for k, plane in enumerate(planes):
                if plane is not None:
                    ref |= np.frombuffer(plane, np.uint8).astype(np.int64) << 8 * k
            own = take_runs(ids, bounds, ref)[0]
            found.append((doc, own.tobytes(), decode(own, piece) if decoded else None))
            if len(found) >= 200:
                out.append(_documents(found))
                found = []
        return pa.Table.from_batches([*out, _documents(found)])
    return (chunks.drop("words").groupBy("chunk").cogroup(right.groupBy("chunk"))
            .applyInArrow(join, "doc_id long, ids binary, decoded string"))


def _documents(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else ([], [], [])
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _DOCUMENTS)], schema=_DOCUMENTS)


def decode_documents(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, ids and ``decoded`` of a table of ids (little-endian unsigned
    32-bit) from any source."""
    piece = vocabulary(tokenizer)

    def run(batches):
        for batch in batches:
            for part in pieces(batch, "ids"):
                text = [decode(np.frombuffer(b or b"", "<u4"), piece) for b in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(text, pa.string())],
                                                 names=[*part.schema.names, "decoded"])
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, decoded string")


def bpe_digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Encode and decode every document: doc_id, n_tokens and the digests of
    its ids and of its decoded text."""
    both = encode_documents(docs, tokenizer, decoded=True)
    return both.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
