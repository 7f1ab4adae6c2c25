"""Language spans: scripts narrow the candidates, words are scored by hashed
letter trigrams, and Viterbi with a switching penalty labels runs of words.

The model is a table of languages x ``BUCKETS`` log-probabilities and one of
languages x scripts, counted by Spark over about ``SAMPLE_DOCS`` documents that
may be learnt from (picked by a hash of the id); its size does not depend on
the data beyond the number of languages.

Defined results: a null text, or one without a letter, has no span and is
``und`` with score 0; a word of a script that no language was seen in speaks for
none; equal paths and equal totals go to the language first by name; any number
of languages and any length of text is labelled, a very long text a part at a
time with the scores carried over; without anything to learn from every text is ``und``; null doc_ids are labelled and
never learnt from; further columns are kept, but the result's own give way."""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqtally.llm._sample import distinct_sample
from seqtally.llm._words import pieces

SAMPLE_DOCS = 8000
BUCKETS = 1 << 15
#: Cost, in nats, of another language than the word before.
SWITCH = 8.0
#: A language uses a script that holds this share of its words.
SCRIPT_SHARE = 0.001
UNKNOWN = "und"
PIECE_BYTES = 4 << 20
#: A longer text is labelled a part of so many characters at a time.
LONG_CHARS = 1 << 20
#: Words up to which texts step together, and languages up to which the runs of a
#: longer one do.
STEPS, MATRIX = 4096, 24
#: Scores are counted in parts of a nat.
UNIT = 1 << 16
_SWITCH = round(SWITCH * UNIT)
_SPACE = re.compile(r"\s")

RESULT = ("lang_pred", "score", "spans")

# --- fixed values: first code points of script ranges ---------------------------
SCRIPTS = [(0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
           (0x0600, "Arabic"), (0x0700, "Other"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"),
           (0x0A80, "Gujarati"), (0x0B00, "Oriya"), (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"),
           (0x0D00, "Malayalam"), (0x0D80, "Sinhala"), (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, "Tibetan"),
           (0x1000, "Myanmar"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, "Other"),
           (0x1780, "Khmer"), (0x1800, "Mongolian"), (0x18B0, "Other"), (0x1E00, "Latin"), (0x1F00, "Greek"),
           (0x2000, "Other"), (0x2C60, "Latin"), (0x2C80, "Other"), (0x3040, "Kana"), (0x3100, "Other"),
           (0x3130, "Hangul"), (0x3190, "Other"), (0x3400, "Han"), (0xA000, "Other"), (0xAC00, "Hangul"),
           (0xD800, "Other"), (0xF900, "Han"), (0xFB00, "Other"), (0xFF21, "Latin"), (0xFF66, "Kana"),
           (0xFFA0, "Other"), (0x20000, "Han"), (0x323B0, "Other")]
# --------------------------------------------------------------------------------
_NAMES = sorted({name for _, name in SCRIPTS})
_STARTS = np.array([start for start, _ in SCRIPTS])
_CODES = np.array([_NAMES.index(name) for _, name in SCRIPTS])

_kinds: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For each code point: 2 a letter, 1 a mark inside words, else 0."""
    if not _kinds:
        kind = {"L": 2, "M": 1}
        _kinds.append(np.array([kind.get(unicodedata.category(chr(c))[0], 0) for c in range(0x110000)], np.uint8))
    return _kinds[0]


def _lower(text: str) -> str:
    """Lower case of the same length, so that places stay those of the text."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x := c.lower()) == 1 else c for c in text)


class _Text:
    """Words (runs of letters and marks that begin with a letter) of several
    texts and the trigram buckets of each word's letters."""

    def __init__(self, texts: list[str]):
        self.codes = np.frombuffer("\n".join(["", *map(_lower, texts), ""]).encode("utf-32-le", "surrogatepass"), "<u4")
        ends = 1 + np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
        self.bounds = np.concatenate(([1], ends))
        kind = _letters()[self.codes]
        place = np.arange(len(kind))
        letter = np.maximum.accumulate(np.where(kind == 2, place, -1))
        other = np.maximum.accumulate(np.where(kind == 0, place, -1))
        inside = (kind > 0) & (letter > other)
        edge = np.flatnonzero(np.diff(inside.astype(np.int8)))
        self.starts, self.ends = edge[::2] + 1, edge[1::2] + 1
        self.first = np.searchsorted(self.starts, self.bounds)
        self.inside = inside

    def script(self) -> np.ndarray:
        return _CODES[np.searchsorted(_STARTS, self.codes[self.starts], "right") - 1]

    def trigrams(self) -> tuple[np.ndarray, np.ndarray]:
        """Bucket of the trigram around every letter (the neighbours outside a
        word count as blanks), and the first of each word's."""
        at = np.flatnonzero(self.inside)
        c = np.where(self.inside, self.codes, 32).astype(np.uint64)
        h = (c[at - 1] << np.uint64(42)) ^ (c[at] << np.uint64(21)) ^ c[at + 1]
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        return (h >> np.uint64(49)).astype(np.int64), np.searchsorted(at, self.starts)


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray      # BUCKETS x languages, log-probabilities
    scripts: np.ndarray     # scripts x languages, whether in use


def train(docs: DataFrame) -> Model:
    """Trigram and script counts of each language, from rows of ``docs``
    (doc_id, text, lang) that may be learnt from; only the sums, at most
    languages x (``BUCKETS`` + scripts) rows, come to the driver."""
    rows = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL").select("doc_id", "text", "lang")
    rows = distinct_sample(rows, SAMPLE_DOCS, "doc_id", "text", "lang")

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, max_bytes=PIECE_BYTES):
                langs = np.array(piece.column("lang").to_pylist(), object)
                texts = piece.column("text").to_pylist()
                for lang in sorted(set(langs)):
                    own = _Text([texts[i] for i in np.flatnonzero(langs == lang)])
                    counts = np.concatenate([np.bincount(own.trigrams()[0], minlength=BUCKETS),
                                             np.bincount(own.script(), minlength=len(_NAMES))])
                    seen = np.flatnonzero(counts)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(seen)), pa.array(seen), pa.array(counts[seen].astype(np.int64))],
                        names=["lang", "bucket", "n"])
    got = (rows.mapInArrow(run, "lang string, bucket long, n long")
           .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    if got.empty:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros((len(_NAMES), 0), bool))
    languages = sorted(got["lang"].unique())
    table = np.zeros((BUCKETS + len(_NAMES), len(languages)))
    table[got["bucket"], got["lang"].map({x: i for i, x in enumerate(languages)})] = got["n"]
    grams, scripts = table[:BUCKETS] + 0.1, table[BUCKETS:]
    return Model(languages, np.log(grams / grams.sum(0)).astype(np.float32),
                 scripts >= np.maximum(1, SCRIPT_SHARE * scripts.sum(0)))


def word_scores(text: _Text, model: Model) -> np.ndarray:
    """Log-probability of every word in every language; other languages than
    those that use its script are out of reach."""
    if not len(text.starts):
        return np.zeros((0, len(model.languages)), np.float32)
    buckets, first = text.trigrams()
    scores = np.stack([np.add.reduceat(model.scores[:, k][buckets], first) for k in range(len(model.languages))], 1)
    used = model.scripts[text.script()]
    some = used.any(1)
    scores[some] = np.where(used[some], scores[some], -1e6)
    scores[~some] = 0
    return scores


def whole(scores: np.ndarray) -> np.ndarray:
    """Scores as integers of ``UNIT``, whose sums don't depend on their order, so
    that a text's labels don't depend on how it is cut."""
    return np.rint(scores.astype(np.float64) * UNIT).astype(np.int64)


def viterbi(scores: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Best language of every word under the switching penalty.  Texts of up to
    ``STEPS`` words step together, the longest first, so that a step is a few
    vector operations over the texts that still have words; longer ones are cut
    into runs that step together (``_Run``)."""
    scores = whole(scores)
    counts = np.diff(first)
    path = np.zeros(len(scores), np.int32)
    for d in np.flatnonzero(counts > STEPS):
        own = _Run(scores[first[d]:first[d + 1]], np.zeros(scores.shape[1], np.int64))
        path[first[d]:first[d + 1]] = own.trace(int(own.end.argmax()))[0]
    order = np.argsort(-np.where(counts > STEPS, 0, counts), kind="stable")
    begin, counts = first[:-1][order], np.where(counts > STEPS, 0, counts)[order]
    if not len(counts) or not counts[0]:
        return path
    active = np.searchsorted(-counts, -np.arange(counts[0]), "left")  # texts with more words than t
    stay = np.ones(scores.shape, bool)
    best = np.zeros(len(scores), np.int32)
    now = scores[begin[:active[0]]]
    finals = np.zeros((len(counts), scores.shape[1]), np.int64)
    for t in range(1, int(counts[0])):
        m = active[t]
        if m < len(now):
            finals[m:len(now)] = now[m:]
            now = now[:m]
        at = begin[:m] + t
        top = now.argmax(1)
        other = now[np.arange(m), top] - _SWITCH
        keeps = now >= other[:, None]
        stay[at], best[at] = keeps, top
        now = np.where(keeps, now, other[:, None]) + scores[at]
    finals[:len(now)] = now
    lang = finals.argmax(1)
    for t in range(int(counts[0]) - 1, -1, -1):
        at = begin[:active[t]] + t
        own = lang[:active[t]]
        path[at] = own
        if t:
            lang[:active[t]] = np.where(stay[at, own], own, best[at])
    return path


class _Run:
    """The forward pass over a run of words from a ``start`` (a score for each
    language before the first word), and its back pointers, compactly: ``end``
    holds the scores behind the last word.

    The words are cut into runs of equal length that step together.  What a run
    does to the scores is a (max, +) matrix, found by starting it from each
    language; the matrices in turn give every run its start.  Back pointers are
    followed from each language at once in the same way.  With many languages the
    matrices would cost more than they save, and there is one run."""

    def __init__(self, scores: np.ndarray, start: np.ndarray):
        n, k = scores.shape
        self.n, self.k = n, k
        runs = max(1, int(n ** 0.5)) if k <= MATRIX else 1
        self.length = -(-n // runs)
        self.runs = -(-n // self.length)
        self.fill = self.runs * self.length - n  # words before the first: no score, no switch
        padded = np.concatenate([np.zeros((self.fill, k), np.int64), scores]).reshape(self.runs, self.length, k)
        starts = start[None]
        if self.runs > 1:
            m = np.full((self.runs, k, k), -(1 << 60))
            m[:, np.arange(k), np.arange(k)] = 0
            for t in range(self.length):
                m = np.maximum(m, m.max(2, keepdims=True) - _SWITCH) + padded[:, t, None]
            starts = np.empty((self.runs, k), np.int64)
            now = start
            for r in range(self.runs):
                starts[r] = now
                now = (now[:, None] + m[r]).max(0)
                now = now - now.max()
        self.top = np.empty((self.length, self.runs), np.uint8 if k <= 256 else np.int32)
        self.stay = np.empty((self.length, self.runs, -(-k // 8)), np.uint8)
        now = starts
        for t in range(self.length):
            top = now.argmax(1)
            other = now[np.arange(len(now)), top] - _SWITCH
            keeps = now >= other[:, None]
            self.top[t], self.stay[t] = top, np.packbits(keeps, axis=1)
            now = np.where(keeps, now, other[:, None]) + padded[:, t]
        self.end = now[-1] - now[-1].max()

    def _before(self, t: int, lang: np.ndarray) -> np.ndarray:
        """The languages before step t on the best paths to ``lang`` (runs, m)."""
        byte = np.take_along_axis(self.stay[t], lang >> 3, 1)
        keeps = (byte >> (7 - (lang & 7)).astype(np.uint8)) & 1
        return np.where(keeps == 1, lang, self.top[t][:, None].astype(np.int64))

    def trace(self, lang: int) -> tuple[np.ndarray, int]:
        """The best path that ends in ``lang``, and the language before it."""
        last = np.full(self.runs, lang, np.int64)
        if self.runs > 1:
            back = np.tile(np.arange(self.k), (self.runs, 1))
            for t in range(self.length - 1, -1, -1):
                back = self._before(t, back)
            for r in range(self.runs - 1, 0, -1):
                last[r - 1] = back[r, last[r]]
        path = np.empty((self.runs, self.length), np.int32)
        now = last[:, None]
        for t in range(self.length - 1, -1, -1):
            path[:, t] = now[:, 0]
            now = self._before(t, now)
        return path.ravel()[self.fill:], int(now[0, 0])


def _spans(base: np.ndarray, owner: np.ndarray, starts, ends, path, languages, n: int) -> list[list]:
    """Runs of words of one language, text by text; ``base`` is where each begins."""
    change = np.flatnonzero((np.diff(owner, prepend=-1) != 0) | (np.diff(path, prepend=-1) != 0))
    last = np.append(change[1:], len(path)) - 1 if len(change) else change
    spans: list[list] = [[] for _ in range(n)]
    for o, a, b, lang in zip(owner[change].tolist(), starts[change].tolist(), ends[last].tolist(), path[change].tolist()):
        spans[o].append({"start": a - int(base[o]), "end": b - int(base[o]), "lang": languages[lang]})
    return spans


def _blocks(text: str):
    """(place, part) of the parts of a long text, cut at a space where there is one
    nearby, and never inside a word."""
    at = 0
    while at < len(text):
        end = at + LONG_CHARS
        if end < len(text):
            end = next((m.end() for m in _SPACE.finditer(text, end, end + LONG_CHARS)), end)
            kind = _letters()
            while end < len(text) and kind[ord(text[end])] and kind[ord(text[end - 1])]:
                end += 1
        yield at, text[at:end]
        at = end


def _label_long(text: str, model: Model):
    """``_label`` of one long text, a part at a time: scores live for a part only,
    and what is kept of each are its words' places and compact back pointers."""
    k = len(model.languages)
    now, parts = np.zeros(k, np.int64), []
    for at, part in _blocks(text):
        own = _Text([part])
        if not len(own.starts):
            continue
        run = _Run(whole(word_scores(own, model)), now)
        now = run.end
        parts.append((own.starts + (at - 1), own.ends + (at - 1), run))
    if not parts:
        return UNKNOWN, 0.0, []
    lang, paths = int(now.argmax()), []
    for *_, run in reversed(parts):
        path, lang = run.trace(lang)
        paths.append(path)
    path = np.concatenate(paths[::-1])
    starts, ends = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    letters = np.bincount(path, ends - starts, minlength=k)
    spans = _spans(np.zeros(1, np.int64), np.zeros(len(path), np.int64), starts, ends, path, model.languages, 1)
    return model.languages[int(letters.argmax())], letters.max() / letters.sum(), spans[0]


def _label(texts: list[str], model: Model):
    """lang_pred, score and spans of the texts."""
    n, k = len(texts), len(model.languages)
    if not k:
        return [UNKNOWN] * n, np.zeros(n), [[] for _ in range(n)]
    long = [i for i, t in enumerate(texts) if len(t) > LONG_CHARS]
    if long:
        pred, score, spans = _label([t if len(t) <= LONG_CHARS else "" for t in texts], model)
        for i in long:
            pred[i], score[i], spans[i] = _label_long(texts[i], model)
        return pred, score, spans
    text = _Text(texts)
    path = viterbi(word_scores(text, model), text.first)
    owner = np.repeat(np.arange(n), np.diff(text.first))
    letters = np.bincount(owner * k + path, text.ends - text.starts, minlength=n * k).reshape(n, k)
    total, top = letters.sum(1), letters.argmax(1)
    pred = [model.languages[i] if x else UNKNOWN for i, x in zip(top, total)]
    spans = _spans(text.bounds, owner, text.starts, text.ends, path, model.languages, n)
    return pred, letters.max(1) / np.maximum(total, 1), spans


def label_languages(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (the share of the letters in words
    of that language) and ``spans`` (character ranges and their language)."""
    docs = docs.drop(*RESULT)
    names = [*docs.columns, *RESULT]
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))

    def run(batches):
        for batch in batches:
            for part in pieces(batch, max_bytes=PIECE_BYTES):
                pred, score, spans = _label([t or "" for t in part.column("text").to_pylist()], model)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(pred), pa.array(score, pa.float64()), pa.array(spans, kind)], names=names)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    own = ["lang_pred string", "score double", "spans array<struct<start:bigint,end:bigint,lang:string>>"]
    return docs.mapInArrow(run, ", ".join(fields + own))
