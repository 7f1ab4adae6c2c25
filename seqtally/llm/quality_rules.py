"""Quality rules: gradient-boosted trees over document statistics.

Each document's statistics come from its Arrow buffers (word and line hashes,
no Python strings).  The trees are fitted with numpy on a bounded sample of
labelled documents (``TRAIN_ROWS``, picked by a hash of the id), with monotonic
constraints on the features that may only speak against a document, and are
flattened into arrays of nodes: scoring walks all rows of a batch down all
trees at once, one level per step.

Defined results: words are ``[^\\x20\\x09-\\x0D]+``; a null or wordless text has
all counts 0 and fails the base rule; null and repeated doc_ids are scored row
by row (a null doc_id has no label); without labels of both classes only the
base rule decides; further columns are kept, but those named like the result's
own (``RESULT``) give way."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqtally.llm._sample import hashed_sample, one_text_each
from seqtally.llm._words import SEPARATOR, Words, mix, pieces, rolling, span_hashes

#: Labelled documents that the trees are fitted on, about.
TRAIN_ROWS = 20_000
TREES, DEPTH, RATE, BINS, LEAST_WEIGHT = 40, 3, 0.3, 32, 0.5
#: A document is kept from this score on.
THRESHOLD = 0.5

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RESULT = (*COUNTS, "base_failed", "score", "kept")
#: Features, and whether the score may only fall (-1) with them.
FEATURES = {"log_words": 0, "word_length": 0, "symbols": -1, "exclamations": -1, "capitals": -1, "digits": 0,
            "dup_lines": -1, "repeats": -1, "line_words": 0}


def _sums(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[bounds[1:]] - total[bounds[:-1]]


def _table(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in chars]] = True
    return out


_SYMBOL, _EXCLAIM, _DIGIT = _table("#*$%&|<>"), _table("!"), _table("0123456789")
_CAPITAL = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LEAD = (np.arange(256) & 0xC0) != 0x80


def _repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key, whether it occurs twice or more, and whether an equal one
    stands before it."""
    order = np.argsort(keys, kind="stable")
    again = np.zeros(len(keys), bool)
    again[1:] = keys[order][1:] == keys[order][:-1]
    many = again.copy()
    many[:-1] |= again[1:]
    out, later = np.empty(len(keys), bool), np.empty(len(keys), bool)
    out[order], later[order] = many, again
    return out, later


def statistics(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Counts (a column for each of ``COUNTS``) and features of the texts."""
    words = Words(texts)
    data, bounds = words.data, words.offsets
    texts_n = len(bounds) - 1
    in_word = ~SEPARATOR[data]
    chars = _sums(_LEAD[data] & in_word, bounds)
    symbols = _sums(_SYMBOL[data], bounds)

    # lines: cut at line feeds and between texts
    feeds = np.flatnonzero(data == 10)
    begins = np.sort(np.concatenate((bounds[:-1], feeds + 1)), kind="stable")
    ends = np.sort(np.concatenate((bounds[1:], feeds)), kind="stable")
    owner = np.searchsorted(feeds, bounds[:-1]) + np.arange(texts_n)
    line_owner = np.zeros(len(begins), np.int64)
    line_owner[owner[1:]] = 1
    line_owner = np.cumsum(line_owner)
    filled = _sums(in_word, np.append(begins, len(data))) > 0 if len(begins) else np.zeros(0, bool)
    keys = mix(span_hashes(data, begins, ends) ^ mix(line_owner.astype(np.uint64)))[filled]
    _, later = _repeated(keys)
    dup_lines = np.bincount(line_owner[filled][later], minlength=texts_n)
    lines = np.bincount(line_owner[filled], minlength=texts_n)

    # words inside a 3-word window that occurs twice in its text
    covered = np.zeros(len(words), bool)
    if len(words) >= 3:
        ok = words.window_starts(3)
        at = np.flatnonzero(ok)
        windows = rolling(words.hashes(), 3)[at] ^ mix(words.owner()[at].astype(np.uint64))
        many, _ = _repeated(windows)
        for k in range(3):
            covered[at[many] + k] = True
    repeats = _sums(covered, words.first)

    n = words.counts
    counts = np.stack([n, chars, symbols, dup_lines, repeats], 1)
    size = np.maximum(chars, 1)
    features = np.stack([
        np.log1p(n), chars / np.maximum(n, 1), symbols / size, _sums(_EXCLAIM[data], bounds) / size,
        _sums(_CAPITAL[data], bounds) / size, _sums(_DIGIT[data], bounds) / size,
        dup_lines / np.maximum(lines, 1), repeats / np.maximum(n, 1), n / np.maximum(lines, 1)], 1)
    return counts, features.astype(np.float64)


# --- the trees ------------------------------------------------------------------

@dataclass
class Trees:
    """All trees' nodes in arrays; a leaf points to itself."""
    base: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        node = np.repeat(self.roots[None, :], len(x), 0)
        rows = np.arange(len(x))[:, None]
        for _ in range(DEPTH):
            low = x[rows, self.feature[node]] <= self.threshold[node]
            node = np.where(low, self.left[node], self.right[node])
        return 1 / (1 + np.exp(-(self.base + self.value[node].sum(1))))


class _Grower:
    """One tree: best splits of the gradient histograms.  A split on a
    constrained feature must order its children's values, and the middle of
    the two bounds everything below it."""

    def __init__(self, bins, edges, signs, gradient, hessian, nodes):
        self.bins, self.edges, self.signs = bins, edges, signs
        self.gradient, self.hessian, self.nodes = gradient, hessian, nodes

    def _value(self, g, h, low, high):
        return np.clip(-g / (h + 1.0), low, high)

    def grow(self, rows, depth, low, high) -> int:
        g, h = self.gradient[rows], self.hessian[rows]
        at = len(self.nodes)
        value = float(self._value(g.sum(), h.sum(), low, high))
        self.nodes.append([0, np.inf, at, at, RATE * value])
        best = self._best(rows, g, h, low, high) if depth else None
        if best is None:
            return at
        f, cut, left, right = best
        below = self.bins[rows, f] <= cut
        middle = (left + right) / 2
        bounds = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)),
                  -1: ((middle, high), (low, middle))}[self.signs[f]]
        a = self.grow(rows[below], depth - 1, *bounds[0])
        b = self.grow(rows[~below], depth - 1, *bounds[1])
        self.nodes[at] = [f, self.edges[f][cut], a, b, 0.0]
        return at

    def _best(self, rows, g, h, low, high):
        gain, best = 1e-6, None
        whole = g.sum() ** 2 / (h.sum() + 1.0)
        for f, sign in enumerate(self.signs):
            if not len(self.edges[f]):
                continue
            own = self.bins[rows, f]
            gs = np.cumsum(np.bincount(own, g, BINS))[:len(self.edges[f])]
            hs = np.cumsum(np.bincount(own, h, BINS))[:len(self.edges[f])]
            gr, hr = g.sum() - gs, h.sum() - hs
            left, right = self._value(gs, hs, low, high), self._value(gr, hr, low, high)
            found = gs ** 2 / (hs + 1.0) + gr ** 2 / (hr + 1.0) - whole
            found[(hs < LEAST_WEIGHT) | (hr < LEAST_WEIGHT) | (sign * (right - left) < 0)] = -1
            k = int(found.argmax())
            if found[k] > gain:
                gain, best = found[k], (f, k, left[k], right[k])
        return best


def fit_trees(x: np.ndarray, y: np.ndarray, signs: list[int]) -> Trees | None:
    """Boosted trees for P(y = 1); None unless both classes are there."""
    if not len(y) or y.min() == y.max():
        return None
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1]))[:BINS - 1] for c in x.T]
    bins = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)], 1)
    base = float(np.log(y.mean() / (1 - y.mean())))
    margin, nodes, roots = np.full(len(y), base), [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        grower = _Grower(bins, edges, signs, p - y, p * (1 - p), nodes)
        roots.append(grower.grow(np.arange(len(y)), DEPTH, -4.0, 4.0))
        feature, threshold, left, right, value = (np.array(c) for c in zip(*nodes))
        one = Trees(0.0, np.array(roots[-1:]), feature.astype(int), threshold, left.astype(int), right.astype(int), value)
        node = np.full(len(y), roots[-1])
        for _ in range(DEPTH):
            low = x[np.arange(len(y)), one.feature[node]] <= one.threshold[node]
            node = np.where(low, one.left[node], one.right[node])
        margin += one.value[node]
    return Trees(base, np.array(roots), one.feature, one.threshold, one.left, one.right, one.value)


# --- Spark ----------------------------------------------------------------------

def train(docs: DataFrame, labels: DataFrame) -> Trees | None:
    """Fit on about ``TRAIN_ROWS`` labelled documents; the sampled ids are
    broadcast (bounded by that number), and the features of one text of each are
    collected."""
    known = (labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id")
             .agg(F.max("quality").cast("int").alias("_quality")))
    picked = hashed_sample(known, TRAIN_ROWS, "doc_id")
    rows = one_text_each(docs, picked).select("text", "_quality")

    def run(batches):
        for batch in batches:
            for part in pieces(batch):
                _, x = statistics(part.column("text"))
                y = part.column("_quality").to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float64())), pa.array(y, pa.int32())],
                                                 names=["x", "y"])
    got = rows.mapInArrow(run, "x array<double>, y int").toPandas()
    if got.empty:
        return None
    x, y = np.array(got["x"].tolist()), got["y"].to_numpy(float)
    order = np.lexsort((*x.T, y))  # rows arrive in any order
    return fit_trees(x[order], y[order], list(FEATURES.values()))


def apply_rules(docs: DataFrame, model: Trees | None) -> DataFrame:
    """``docs`` with the counts, base_failed, score and kept."""
    docs = docs.drop(*RESULT)
    columns = docs.columns

    def run(batches):
        for batch in batches:
            for part in pieces(batch):
                counts, x = statistics(part.column("text"))
                n, repeats = counts[:, 0], counts[:, 4]
                failed = (n < 50) | (100 * repeats > 50 * n)
                score = model.score(x) if model else np.ones(len(n))
                own = [pa.array(c) for c in counts.T]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *own, pa.array(failed), pa.array(score), pa.array(~failed & (score >= THRESHOLD))],
                    names=[*columns, *RESULT])
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    own = [f"{c} long" for c in COUNTS] + ["base_failed boolean", "score double", "kept boolean"]
    return docs.mapInArrow(run, ", ".join(fields + own))
