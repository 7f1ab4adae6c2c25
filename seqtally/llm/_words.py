"""Words of Arrow text columns as numpy arrays.

The operators that look at words work on the UTF-8 buffers of a record batch
instead of on Python strings: word bounds and 64-bit word hashes come from a
few vector operations per piece of text.  Everything here is a per-task helper;
Spark deals out the rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes handled at once by a task (a longer text is a piece of its own).
PIECE_BYTES = 1 << 20
#: Bytes hashed at once, cut between words.
_SEGMENT = 1 << 18

_U = np.uint64
#: Word separators: space and the bytes 0x09-0x0D.
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE_CODE = _rng.integers(1, 2 ** 63, 0x10000, dtype=np.uint64) * _U(2) + _U(1)
_BASES = [int(x) | 5 for x in _rng.integers(2 ** 62, 2 ** 63, 4, dtype=np.uint64)]
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse modulo 2**64, for i below ``n``."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        m = max(n, 1 << 16)
        up, down = np.full(m, base, np.uint64), np.full(m, pow(base, -1, 2 ** 64), np.uint64)
        up[0] = down[0] = 1
        have = (np.cumprod(up), np.cumprod(down))
        if m <= 1 << 22:
            _powers[base] = have
    return have[0][:n], have[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective finalizer that spreads every input bit over the hash."""
    h = h ^ (h >> _U(33))
    h = h * _U(0xFF51AFD7ED558CCD)
    h = h ^ (h >> _U(33))
    h = h * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: int = 0) -> np.ndarray:
    """64-bit hash of every span of ``codes`` (bytes or small code points);
    equal spans have equal hashes.  Spans are ordered and do not overlap."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        lo = int(starts[i])
        j = int(np.searchsorted(ends, lo + _SEGMENT, "right"))
        j = max(j, i + 1)
        part = codes[lo:int(ends[j - 1])]
        up, down = _power(_BASES[0], len(part) + 1)
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE_CODE[part] * up[:-1], out=total[1:])
        a, b = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = (total[b] - total[a]) * down[a]
        i = j
    return mix(out + (ends - starts).astype(np.uint64) * _U(0x9E3779B97F4A7C15) + _U(salt))


def rolling(hashes: np.ndarray, n: int, which: int = 1) -> np.ndarray:
    """Hash of the ``n`` consecutive items that start at each place (an array
    shorter by ``n - 1``); ``which`` (1-3) selects independent hashes."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    up, down = _power(_BASES[which], len(hashes) + 1)
    total = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(mix(hashes + _U(which)) * up[:-1], out=total[1:])
    return mix((total[n:] - total[:-n]) * down[:len(hashes) - n + 1])


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and the n + 1 offsets of an Arrow string array (null: empty)."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if len(texts) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


#: Separators and case of plain words: ASCII letters and digits and everything
#: beyond ASCII make words, and A-Z are lower-cased.
PLAIN_SEPARATOR = np.zeros(256, bool)
PLAIN_SEPARATOR[[c for c in range(128) if not chr(c).isalnum()]] = True
PLAIN_CASE = np.arange(256, dtype=np.uint8)
PLAIN_CASE[ord("A"):ord("Z") + 1] += 32


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a string array, or other words by a
    table of separators and a table of byte cases.

    ``starts``/``ends``: byte bounds in ``data``; ``first``: index of the first
    word of each text, with the number of words at the end."""

    def __init__(self, texts: pa.Array, separator: np.ndarray = SEPARATOR, case: np.ndarray | None = None):
        self.data, self.offsets = text_buffer(texts)
        if case is not None:
            self.data = case[self.data]
        n = len(self.data)
        sep = separator[self.data]
        before, after = np.ones(n, bool), np.ones(n, bool)
        before[1:], after[:-1] = sep[:-1], sep[1:]
        edge = self.offsets[(self.offsets > 0) & (self.offsets < n)]
        before[edge] = True
        after[edge - 1] = True
        np.logical_not(sep, out=sep)
        self.starts = np.flatnonzero(sep & before)
        self.ends = np.flatnonzero(sep & after) + 1
        self.first = np.searchsorted(self.starts, self.offsets)

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends)

    def owner(self) -> np.ndarray:
        """Index of the text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def window_starts(self, n: int) -> np.ndarray:
        """True at each word where a window of ``n`` words of one text starts
        (as many places as ``rolling(hashes, n)`` has)."""
        left = np.repeat(self.first[1:], self.counts) - np.arange(len(self))
        return left[:max(0, len(self) - n + 1)] >= n


def pieces(batch: pa.RecordBatch, column: str = "text", max_bytes: int = PIECE_BYTES):
    """The batch in slices of at most ``max_bytes`` of ``column`` (one row at
    least), so that a task's arrays stay small whatever the batch size."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(total, total[at] + max_bytes, "right")) - 1
        to = min(max(to, at + 1), batch.num_rows)
        yield batch.slice(at, to - at)
        at = to
