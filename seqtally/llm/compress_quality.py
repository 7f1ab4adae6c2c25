"""Quality by compression: one zstandard dictionary from good and one from bad
labelled text.  A text is compressed with each, in blocks of ``BLOCK`` bytes
(so that a long text can't learn its own style), and the difference of the
compressed sizes per byte of text becomes a score by logistic calibration; a
second term of the calibration says how far a short text, of which there is
little to compress, is good without evidence.

Dictionaries are trained on about ``SAMPLE_DOCS`` documents of each class of
at most ``SAMPLE_BYTES`` bytes, and calibrated on as many others; both samples
are picked by a hash of the id among the rows that may be learnt from.

Defined results: a null or empty text has difference 0 and the score that the
calibration gives it; null doc_ids are scored and never learnt from; an id with
both labels counts as good; without both classes the score is the share of good
labels (0.5 without any); further columns are kept, but ``score`` gives way."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqtally.llm._sample import hashed_sample, one_text_each
from seqtally.llm._words import pieces, text_buffer

SAMPLE_DOCS, SAMPLE_BYTES = 3000, 16 << 10
DICTIONARY_BYTES, BLOCK, LEVEL = 110 << 10, 512, 3
#: The dictionary trainer sees sampled texts in parts of this size.
PART = 4096


@dataclass
class Model:
    good: bytes
    bad: bytes
    slope: float = 0.0
    short: float = 0.0
    intercept: float = 0.0

    def score(self, difference: np.ndarray, size: np.ndarray) -> np.ndarray:
        margin = self.slope * difference + self.short * shortness(size) + self.intercept
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def shortness(size: np.ndarray) -> np.ndarray:
    """1 for an empty text, one half at 64 bytes, 0 for a long one."""
    return 64 / (64 + size)


def held_out(doc_id: Column) -> Column:
    """Rows kept apart for measuring: crc32 of the id's text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _compressor(dictionary: bytes):
    import zstandard
    if not dictionary:
        return zstandard.ZstdCompressor(level=LEVEL)
    d = zstandard.ZstdCompressionDict(dictionary)
    d.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=d)


def _trained(texts: list[bytes]) -> bytes:
    import zstandard
    parts = [t[i:i + PART] for t in texts for i in range(0, len(t), PART)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, parts).as_bytes()
    except zstandard.ZstdError:
        return b""


def _own_lines(texts: dict[int, list[str]]) -> dict[int, list[bytes]]:
    """The sampled texts without lines that several of them share: a passage
    that many documents quote is no style, and either dictionary would tie it
    to its class."""
    seen = Counter(line for own in texts.values() for t in own for line in set(t.split("\n")))
    kept = {k: ("\n".join(x for x in t.split("\n") if seen[x] == 1) for t in own) for k, own in texts.items()}
    return {k: [t.encode() for t in own if t] for k, own in kept.items()}


def differences(texts: pa.Array, good, bad) -> tuple[np.ndarray, np.ndarray]:
    """(size with the bad dictionary - size with the good one) per byte, and
    the texts' sizes."""
    data, bounds = text_buffer(texts)
    view, out = memoryview(np.ascontiguousarray(data)), np.zeros(len(bounds) - 1)
    for k, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        more = 0
        for i in range(a, b, BLOCK):
            block = view[i:min(i + BLOCK, b)]
            more += len(bad.compress(block)) - len(good.compress(block))
        out[k] = more / max(1, b - a)
    return out, np.diff(bounds)


def _scored(docs: DataFrame, model: Model, columns: list[str], score) -> DataFrame:
    docs = docs.drop(*columns)
    names = [*docs.columns, *columns]

    def run(batches):
        good, bad = _compressor(model.good), _compressor(model.bad)
        for batch in batches:
            for part in pieces(batch):
                values = score(*differences(part.column("text"), good, bad))
                yield pa.RecordBatch.from_arrays([*part.columns, *map(pa.array, values)], names=names)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    return docs.mapInArrow(run, ", ".join([*fields, *(f"{c} double" for c in columns)]))


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Weighted logistic regression (Newton steps, a small ridge): a
    coefficient for each column of ``x``, and the intercept."""
    scale = np.append(np.where(x.std(0) > 0, x.std(0), 1.0), 1.0)
    design = np.column_stack([x, np.ones(len(x))]) / scale
    ridge = np.append(np.full(x.shape[1], 0.01), 1e-9)
    beta = np.zeros(x.shape[1] + 1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (w * (p - y)) + ridge * beta
        bend = (design * (w * p * (1 - p))[:, None]).T @ design + np.diag(ridge + 1e-6)
        step = np.clip(np.linalg.solve(bend, slope), -2, 2)
        beta -= step
        if np.abs(step).max() < 1e-9:
            break
    return beta / scale


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from labelled rows that are not held out.  The sampled ids are
    broadcast; about ``2 * SAMPLE_DOCS`` texts and as many pairs of a difference
    and a label come to the driver (never more than twice as many), one text of an
    id however often it occurs."""
    own = (labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").filter(~held_out(F.col("doc_id")))
           .groupBy("doc_id").agg(F.max("quality").cast("int").alias("_quality")))
    share = {r["_quality"]: r["count"] for r in own.groupBy("_quality").count().collect()}
    rate = share.get(1, 0) / max(1, sum(share.values())) if share else 0.5
    if len(share) < 2:
        return Model(b"", b"", intercept=float(np.log((rate + 1e-6) / (1 - rate + 1e-6))))
    picked = None
    for label in (0, 1):
        one = hashed_sample(own.filter(F.col("_quality") == label), 2 * SAMPLE_DOCS, "doc_id")
        picked = one if picked is None else picked.unionByName(one)
    turn = F.pmod(F.xxhash64(F.lit("turn"), "doc_id"), F.lit(2))
    rows = one_text_each(docs, picked.withColumn("_turn", turn))
    short = rows.filter(F.octet_length("text").between(1, SAMPLE_BYTES) & (F.col("_turn") == 0))
    texts = {0: [], 1: []}
    for r in sorted(short.select("doc_id", "text", "_quality").collect(), key=lambda r: (r.doc_id, r.text)):
        texts[r["_quality"]].append(r.text)
    own = _own_lines(texts)
    model = Model(_trained(own[1]), _trained(own[0]))
    measured = ["_difference", "_short"]
    got = (_scored(rows.filter("_turn = 1"), model, measured, lambda d, n: (d, shortness(n)))
           .select(*measured, "_quality").toPandas().sort_values([*measured, "_quality"]))
    y, x = got["_quality"].to_numpy(float), got[measured].to_numpy(float)
    if len(set(y)) < 2:
        return Model(b"", b"", intercept=float(np.log(rate / (1 - rate))))
    weight = np.where(y == 1, share[1] / (y == 1).sum(), share[0] / (y == 0).sum())
    model.slope, model.short, model.intercept = _logistic(x, y, weight / weight.mean())
    return model


def score_quality(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score``, the chance that a text is of the good class."""
    return _scored(docs, model, ["score"], lambda d, n: (model.score(d, n),))
