"""Substring duplicates by fixed-block anchors.

A window is ``WINDOW`` consecutive words of one document.  A word is removed
when a window that covers it also starts in a document with a smaller doc_id.

Any window of 50 words holds a whole block of 25 words on the fixed grid
(0, 25, 50, ...) of the document it lies in.  So:

1. *anchors*: the grid blocks of all documents are the index; every rolling
   window of 25 words of every document probes it.  A block is shared when it
   is found in another document too.
2. *extension*: around every hit, all 50-word windows that contain it are
   candidates; the smallest doc_id of each candidate's word sequence is found.
   The windows found in an earlier document, joined, are the maximal repeats.
3. the words under those windows are removed.

Documents are cut into chunks of ``CHUNK_BYTES`` of text, written once, bucketed
by chunk; texts are never shuffled.  A chunk sends each distinct window hash
once, sorted and delta-coded, one row per hash range.  Copies of a text
therefore never make pairs of documents, and a passage that a third of all
documents share costs one entry per chunk.  Index and candidates are dealt out
by hash, so nothing is broadcast.  Anchor hashes have 32 bits within their
range (a chance hit only adds a candidate); candidates are compared by 80 bits.

Defined results: words are ``[^\\x20\\x09-\\x0D]+``, unchanged; a null text has
no words and stays null; a document with a null doc_id is neither removed from
nor a reason to remove; rows that share a doc_id don't remove from each other;
further columns are kept, but those named like the result's own (``n_words``,
``n_removed``) give way."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqtally.llm._files import bucket_count, free_name, staged_buckets
from seqtally.llm._planes import pack_sorted, unpack_sorted
from seqtally.llm._words import Words, pieces, rolling

#: Words in a window, and in a block of the anchor grid.
WINDOW, BLOCK = 50, 25
#: Text of a chunk, and of the hashes that one range holds.
CHUNK_BYTES, RANGE_BYTES = 4 << 20, 32 << 20

RESULT = ("n_words", "n_removed")
_SENT = "part long, chunk long, entries binary"
_REPLY = "chunk long, entries binary"


def chunked(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_chunk`` and ``_bytes``, bucketed by ``_chunk``."""
    def run(batches):
        number, size = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            for part in pieces(batch, max_bytes=CHUNK_BYTES // 2):
                own = pc.fill_null(pc.binary_length(part.column("text")), 0)
                total = pc.sum(own).as_py() or 0
                if size and size + total > CHUNK_BYTES:
                    number, size = number + 1, 0
                size += total
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([number] * part.num_rows, pa.int64()), own.cast(pa.int64())],
                    names=[*part.schema.names, "_chunk", "_bytes"])
    docs = docs.drop(*RESULT)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + ["_chunk long", "_bytes long"]
    return staged_buckets(docs.mapInArrow(run, ", ".join(fields)), "chunks", "_chunk", bucket_count(docs))


def _ranges(chunks: DataFrame) -> int:
    """Bits of the hash that number the ranges (a power of two of them)."""
    total = chunks.agg(F.sum("_bytes")).first()[0] or 0
    least = int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, max(total // RANGE_BYTES, least - 1).bit_length())


# --- one chunk ----------------------------------------------------------------

class _Chunk:
    """Word hashes of a chunk's documents, in pieces."""

    def __init__(self, table: pa.Table):
        self.batches = [p for b in table.combine_chunks().to_batches() for p in pieces(b)]

    def parts(self):
        """(batch, words, word hashes, owners' doc_ids, known) of each piece;
        ``known`` is False at words of rows without a doc_id."""
        for batch in self.batches:
            words = Words(batch.column("text"))
            ids = batch.column("doc_id").cast(pa.int64())
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            owner = words.owner()
            yield (batch, words, words.hashes(), pc.fill_null(ids, 0).to_numpy()[owner], known[owner])


def _anchor_keys(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Range (``bits``) and 32 bits of the hash within it."""
    return rolling(hashes, BLOCK, 1) >> np.uint64(32 - bits)


def _sent(chunk: int, bits: int, keys: np.ndarray, low: int, *columns):
    """A row for each range: the chunk's sorted keys, split by their high bits."""
    part = (keys >> np.uint64(low)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
    mask = np.uint64((1 << low) - 1)
    rows = [(int(part[a]), pack_sorted(keys[a:b] & mask, *((c[a:b], w) for c, w in columns)))
            for a, b in zip(cuts[:-1], cuts[1:])]
    return pa.table({"part": pa.array([r[0] for r in rows], pa.int64()),
                     "chunk": pa.array([chunk] * len(rows), pa.int64()),
                     "entries": pa.array([r[1] for r in rows], pa.binary())})


def _distinct(keys: np.ndarray, docs: np.ndarray):
    """Order of the keys, starts of equal runs, and each run's smallest and
    largest doc_id."""
    order = np.argsort(keys, kind="stable")
    keys, docs = keys[order], docs[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
    if not len(first):
        return order, keys, first, docs, docs
    return order, keys[first], first, np.minimum.reduceat(docs, first), np.maximum.reduceat(docs, first)


def _probe(bits: int):
    """A chunk's distinct 25-word windows; bit 0: one lies on the grid, bit 1:
    it is in several of the chunk's documents."""
    def run(key, table):
        found = []
        for _, words, hashes, docs, known in _Chunk(table).parts():
            keys = _anchor_keys(hashes, bits)
            ok = words.window_starts(BLOCK) & known[:len(keys)]
            place = np.arange(len(words)) - np.repeat(words.first[:-1], words.counts)
            found.append((keys[ok], docs[:len(keys)][ok], (place[:len(keys)] % BLOCK == 0)[ok]))
        keys, docs, grid = (np.concatenate(x) for x in zip(*found))
        order, keys, first, low, high = _distinct(keys, docs)
        flags = np.maximum.reduceat(grid[order], first).astype(np.uint8) if len(first) else np.empty(0, np.uint8)
        return _sent(key[0].as_py(), bits, keys, 32, (flags | (low != high).astype(np.uint8) << 1, 1))
    return run


def _share():
    """Of a range's windows, those that are a grid block somewhere and lie in
    two documents; each chunk learns which of its own they are."""
    def run(key, table):
        base = np.uint64(key[0].as_py() << 32)
        chunks = table.column("chunk").to_pylist()
        sent = [unpack_sorted(e.as_py(), 1) for e in table.column("entries")]
        keys = np.concatenate([s[0] for s in sent])
        flags = np.concatenate([s[1] for s in sent]).astype(np.uint8)
        order = np.argsort(keys, kind="stable")
        first = np.flatnonzero(np.append(True, np.diff(keys[order]) != 0))
        any_flag = np.bitwise_or.reduceat(flags[order], first)
        many = np.diff(np.append(first, len(keys))) > 1
        shared = np.empty(len(keys), bool)
        hit = (any_flag & 1 > 0) & (many | (any_flag & 2 > 0))
        shared[order] = np.repeat(hit, np.diff(np.append(first, len(keys))))
        rows, at = [], 0
        for c, s in zip(chunks, sent):
            own = s[0][shared[at:at + len(s[0])]]
            at += len(s[0])
            if len(own):
                rows.append((c, pack_sorted(own | base)))
        return pa.table({"chunk": pa.array([r[0] for r in rows], pa.int64()),
                         "entries": pa.array([r[1] for r in rows], pa.binary())})
    return run


def _replies(table: pa.Table) -> np.ndarray:
    """All keys that a chunk was told, sorted."""
    got = [unpack_sorted(e.as_py())[0] for e in table.column("entries")]
    return np.sort(np.concatenate(got)) if got else np.empty(0, np.uint64)


def _member(keys: np.ndarray, sorted_keys: np.ndarray) -> np.ndarray:
    if not len(sorted_keys):
        return np.zeros(len(keys), bool)
    at = np.searchsorted(sorted_keys, keys)
    return sorted_keys[np.minimum(at, len(sorted_keys) - 1)] == keys


def _extend(bits: int):
    """Candidate windows of a chunk: the distinct 50-word windows around its
    hits, with 16 more bits of hash and the smallest doc_id in the chunk."""
    def run(key, table, told):
        told, found = _replies(told), []
        if len(told):
            for _, words, hashes, docs, known in _Chunk(table).parts():
                hit = _member(_anchor_keys(hashes, bits), told) & words.window_starts(BLOCK) & known[:max(0, len(words) - BLOCK + 1)]
                ok = words.window_starts(WINDOW)
                seen = np.concatenate(([0], np.cumsum(hit)))
                at = np.flatnonzero(ok)
                at = at[seen[at + WINDOW - BLOCK + 1] > seen[at]]
                found.append((rolling(hashes, WINDOW, 2)[at], rolling(hashes, WINDOW, 3)[at] >> np.uint64(48), docs[at]))
        if not found:
            return _sent(0, bits, np.empty(0, np.uint64), 64 - bits)
        keys, more, docs = (np.concatenate(x) for x in zip(*found))
        order, keys, first, low, _ = _distinct(keys, docs)
        base = int(low.min()) if len(low) else 0
        return _sent(key[1 - 1].as_py(), bits, keys, 64 - bits, (more[order][first], 2),
                     ((low - base).astype(np.uint64), 8), (np.full(len(low), base, np.int64).astype(np.uint64), 8))
    return run


def _earlier(bits: int):
    """Of a range's candidates, those that a chunk has from a later document
    than another chunk; each chunk learns which of its own they are."""
    def run(key, table):
        base = np.uint64(key[0].as_py() << (64 - bits))
        chunks = table.column("chunk").to_pylist()
        sent = [unpack_sorted(e.as_py(), 2, 8, 8) for e in table.column("entries")]
        keys, more = (np.concatenate([s[k] for s in sent]) for k in (0, 1))
        docs = np.concatenate([(s[2] + s[3]).astype(np.int64) for s in sent])
        order = np.lexsort((more, keys))
        change = (np.diff(keys[order]) != 0) | (np.diff(more[order]) != 0)
        first = np.flatnonzero(np.append(True, change))
        least = np.minimum.reduceat(docs[order], first)
        later = np.empty(len(keys), bool)
        later[order] = np.repeat(least, np.diff(np.append(first, len(keys)))) < docs[order]
        rows, at = [], 0
        for c, s in zip(chunks, sent):
            own = s[0][later[at:at + len(s[0])]]
            at += len(s[0])
            if len(own):
                rows.append((c, pack_sorted(own | base)))
        return pa.table({"chunk": pa.array([r[0] for r in rows], pa.int64()),
                         "entries": pa.array([r[1] for r in rows], pa.binary())})
    return run


def _cut(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, gone: np.ndarray) -> str:
    """The text without its removed words and the separators after them; other
    words and separators stay as they are."""
    keep = np.ones(len(data), bool)
    runs = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
    for a, b in zip(runs[::2], runs[1::2]):
        keep[starts[a]:starts[b] if b < len(starts) else ends[-1]] = False
    return data[keep].tobytes().decode()


def _remove(columns: list[str]):
    """The documents of a chunk without their repeated words."""
    def run(key, table, told):
        told, out = _replies(told), []
        parts = list(_Chunk(table).parts()) if len(told) or table.num_rows > 1 else _Chunk(table).parts()
        parts = list(parts)
        all_keys, all_docs = [], []
        for _, words, hashes, docs, known in parts:
            keys = rolling(hashes, WINDOW, 2)
            ok = words.window_starts(WINDOW) & known[:len(keys)]
            all_keys.append(keys[ok])
            all_docs.append(docs[:len(keys)][ok])
        keys, docs = np.concatenate(all_keys), np.concatenate(all_docs)
        order, distinct, first, low, high = _distinct(keys, docs)
        inner = low != high
        inner_keys, inner_low = distinct[inner], low[inner]
        for batch, words, hashes, docs, known in parts:
            keys = rolling(hashes, WINDOW, 2)
            ok = words.window_starts(WINDOW) & known[:len(keys)]
            gone = _member(keys, told)
            if len(inner_keys):
                at = np.minimum(np.searchsorted(inner_keys, keys), len(inner_keys) - 1)
                gone |= (inner_keys[at] == keys) & (inner_low[at] < docs[:len(keys)])
            gone &= ok
            depth = np.zeros(len(words) + 1, np.int64)
            depth[:len(gone)] += gone
            depth[WINDOW:WINDOW + len(gone)] -= gone
            covered = np.cumsum(depth)[:len(words)] > 0
            removed = np.concatenate(([0], np.cumsum(covered)))
            removed = removed[words.first[1:]] - removed[words.first[:-1]]
            text = batch.column("text")
            if removed.any():
                values = text.to_pylist()
                for d in np.flatnonzero(removed):
                    a, b, at = words.first[d], words.first[d + 1], words.offsets[d]
                    values[d] = _cut(words.data[at:words.offsets[d + 1]], words.starts[a:b] - at,
                                     words.ends[a:b] - at, covered[a:b])
                text = pa.array(values, text.type)
            out.append(pa.table([text if c == "text" else batch.column(c) for c in columns]
                                + [pa.array(words.counts, pa.int64()), pa.array(removed, pa.int64())],
                                names=[*columns, *RESULT]))
        return pa.concat_tables(out)
    return run


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text`` without repeated words, ``n_words`` (before) and
    ``n_removed``."""
    names = {c: free_name(c, docs.columns) for c in ("_chunk", "_bytes") if c in docs.columns}
    chunks = chunked(docs.withColumnsRenamed(names))
    bits = _ranges(chunks)
    columns = [c for c in chunks.columns if c not in ("_chunk", "_bytes")]
    texts = chunks.select("_chunk", "doc_id", "text").groupBy("_chunk")
    hits = (texts.applyInArrow(_probe(bits), _SENT).groupBy("part").applyInArrow(_share(), _REPLY))
    found = (texts.cogroup(hits.groupBy("chunk")).applyInArrow(_extend(bits), _SENT)
             .groupBy("part").applyInArrow(_earlier(bits), _REPLY))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in chunks.schema if f.name in columns]
    schema = ", ".join([*fields, "n_words long", "n_removed long"])
    return (chunks.drop("_bytes").groupBy("_chunk").cogroup(found.groupBy("chunk"))
            .applyInArrow(_remove(columns), schema).withColumnsRenamed({new: c for c, new in names.items()}))
