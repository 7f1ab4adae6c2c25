"""Splitting text into the words of a word-end BPE tokenizer, and encoding
words, exactly as the tokenizers library does for whole texts.

The tokenizer normalizes (NFC, white space, lower case) and splits by
``'s|'t|'re|'ve|'m|'ll|'d|\\p{L}+|\\p{N}|[^\\s\\p{L}\\p{N}]+`` before BPE, so a
text's ids are its words' ids in order.  Texts of plain Latin code points are
split with numpy; any other text, or one that holds a special token's string,
goes through the library's own normalizer and pre-tokenizer."""

from __future__ import annotations

import re
import unicodedata
from functools import cached_property

import numpy as np

from seqtally.llm._words import span_hashes

#: Texts made of these only are NFC already, and every tool agrees on the
#: lower case and the classes of these code points.
_PLAIN = re.compile("[\t-\r -~ -įı-ſ]*")
_SPACE, _LETTER, _NUMBER, _OTHER = range(4)


def _classes() -> np.ndarray:
    table = np.full(0x180, _OTHER, np.uint8)
    for c in range(0x180):
        kind = unicodedata.category(chr(c))[0]
        table[c] = {"L": _LETTER, "N": _NUMBER}.get(kind, _OTHER)
    table[[*range(9, 14), 0x20, 0x85, 0xA0]] = _SPACE
    return table


_CLASS = _classes()

#: Texts that the library encodes at once: what it tells of each token (its text,
#: offsets, masks) takes many times the id, and only ids are kept.
AT_ONCE = 32


def load(path: str):
    """The tokenizer as its file states it, without truncation and padding."""
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


class WordTokenizer:
    """Splits texts into distinct words and places, and encodes words."""

    def __init__(self, path: str):
        from tokenizers import normalizers, pre_tokenizers
        self.path = path
        self.words = load(path)
        self.normalizer, self.pre_tokenizer = self.words.normalizer, self.words.pre_tokenizer
        self.words.normalizer = normalizers.Sequence([])
        self.words.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.words.get_vocab(with_added_tokens=True)
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for w, i in vocabulary.items() if w.endswith("</w>")]] = True
        self.last[list(self.words.get_added_tokens_decoder())] = True
        special = [t.content for t in self.words.get_added_tokens_decoder().values()]
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None

    @cached_property
    def whole(self):
        """The tokenizer for whole texts; loaded when first asked for."""
        return load(self.path)

    def _encoded(self, texts: list[str]):
        """The ids of each text, ``AT_ONCE`` texts at a time."""
        for i in range(0, len(texts), AT_ONCE):
            for e in self.words.encode_batch_fast(texts[i:i + AT_ONCE], add_special_tokens=False):
                yield np.array(e.ids, np.uint32)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words in order, and the number of ids of each word.
        Words are encoded many to a line: a word's last id ends in ``</w>``."""
        lines = [" ".join(words[i:i + 200]) for i in range(0, len(words), 200)]
        ids = list(self._encoded(lines))
        flat = np.concatenate(ids) if ids else np.empty(0, np.uint32)
        ends = np.flatnonzero(self.last[flat]) + 1
        if len(ends) != len(words) or (len(flat) and ends[-1] != len(flat)):
            each = list(self._encoded(words))
            return np.concatenate(each), np.fromiter(map(len, each), np.int64, len(each))
        return flat, np.diff(ends, prepend=0)

    def split_exact(self, text: str) -> list[str]:
        """Words of any text by the library's own steps."""
        out = []
        for k, part in enumerate(self.special.split(text) if self.special else [text]):
            if k % 2:
                out.append(part)
            elif part:
                norm = self.normalizer.normalize_str(part)
                out += [norm[a:b] for a, b in _spans(self.pre_tokenizer.pre_tokenize_str(norm))]
        return out

    def split(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Distinct words, the word number at each place, and the n + 1 bounds
        of the texts' places."""
        plain = [bool(_PLAIN.fullmatch(t)) and not (self.special and self.special.search(t)) for t in texts]
        words, ref, bounds = _split_plain([t for t, p in zip(texts, plain) if p])
        if all(plain):
            return words, ref, bounds
        number = {w: i for i, w in enumerate(words)}
        parts, at = [], 0
        for t, p in zip(texts, plain):
            if p:
                parts.append(ref[bounds[at]:bounds[at + 1]])
                at += 1
            else:
                parts.append(np.array([number.setdefault(w, len(number)) for w in self.split_exact(t)], np.int32))
        bounds = np.concatenate(([0], np.cumsum([len(p) for p in parts], dtype=np.int64)))
        return list(number), np.concatenate(parts).astype(np.int32), bounds


def _spans(pre_tokens):
    """Bounds of the pre-tokens, one per split part (byte-level pieces of one
    part share no bounds with another)."""
    return [bounds for _, bounds in pre_tokens]


def _split_plain(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    text = "\n".join(texts).lower()
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint16)
    n = len(codes)
    ends_at = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
    kind = _CLASS[codes]
    start = np.ones(n, bool)
    start[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _NUMBER)
    _contractions(codes, kind, start)
    begins = np.flatnonzero(start)
    stops = np.append(begins[1:], n)[:len(begins)]
    word = kind[begins] != _SPACE
    begins, stops = begins[word], stops[word]
    hashes = span_hashes(codes, begins, stops)
    _, where, ref = np.unique(hashes, return_index=True, return_inverse=True)
    a, b = begins[where].tolist(), stops[where].tolist()
    words = [text[i:j] for i, j in zip(a, b)]
    bounds = np.concatenate(([0], np.searchsorted(begins, ends_at))) if len(texts) else np.zeros(1, np.int64)
    return words, ref.astype(np.int32), bounds


def _contractions(codes, kind, start) -> None:
    """A lone apostrophe before s, t, m, d, re, ve or ll takes those letters."""
    n = len(codes)
    lone = np.flatnonzero(start & (codes == ord("'")))
    lone = lone[lone + 1 < n]
    lone = lone[kind[lone + 1] == _LETTER]
    one = codes[lone + 1]
    two = np.where(lone + 2 < n, codes[np.minimum(lone + 2, n - 1)], 0)
    short = np.isin(one, [ord(c) for c in "stmd"])
    pair = np.zeros(len(lone), bool)
    for x in ("re", "ve", "ll"):
        pair |= (one == ord(x[0])) & (two == ord(x[1]))
    for hit, taken in ((lone[short], 1), (lone[pair], 2)):
        start[hit + 1] = False
        rest = hit + 1 + taken
        rest = rest[rest < n]
        start[rest] = True


class IdCache:
    """Ids of words seen by this worker; emptied when it holds ``limit`` words, or
    16 characters for each, so a worker's memory stays bounded (a dropped word is
    encoded again).  The limit is that of many pieces of text: a cache that a few
    pieces fill is emptied before their words come again."""

    def __init__(self, tokenizer: WordTokenizer, limit: int = 600_000):
        self.tokenizer, self.limit = tokenizer, limit
        self.clear()

    def clear(self):
        self.number: dict[str, int] = {}
        self.chars = 0
        self.flat = np.empty(1 << 16, np.uint32)
        self.bounds = np.zeros(1 << 16, np.int64)

    def numbers(self, words: list[str]) -> np.ndarray:
        new = list(dict.fromkeys(w for w in words if w not in self.number))
        chars = sum(map(len, new))
        if self.number and (len(self.number) + len(new) > self.limit or self.chars + chars > 16 * self.limit):
            self.clear()
            new = list(dict.fromkeys(words))
            chars = sum(map(len, new))
        if new:
            ids, lengths = self.tokenizer.encode_words(new)
            at = len(self.number)
            self.bounds = _grown(self.bounds, at + len(new) + 1)
            used = int(self.bounds[at])
            self.bounds[at + 1:at + len(new) + 1] = used + np.cumsum(lengths)
            self.flat = _grown(self.flat, used + len(ids))
            self.flat[used:used + len(ids)] = ids
            self.number.update(zip(new, range(at, at + len(new))))
            self.chars += chars
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))

    def ids(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the numbered words in order, and the bounds of each word's."""
        return take_runs(self.flat, self.bounds, places)


def _grown(a: np.ndarray, n: int) -> np.ndarray:
    if n <= len(a):
        return a
    out = np.zeros(max(n, 2 * len(a)), a.dtype)
    out[:len(a)] = a
    return out


def take_runs(flat: np.ndarray, bounds: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """flat[bounds[i]:bounds[i+1]] for each i of ``which``, joined; and the
    bounds of the joined runs."""
    lengths = bounds[which + 1] - bounds[which]
    ends = np.concatenate(([0], np.cumsum(lengths)))
    index = np.arange(int(ends[-1])) + np.repeat(bounds[which] - ends[:-1], lengths)
    return flat[index], ends
