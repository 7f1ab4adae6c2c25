"""Lines of files as numpy vectors.

A part of a file is read in blocks.  In each block the newlines give the place
and length of every line, and whatever is asked of lines (their first bytes,
equal lengths, where records begin) is asked of these vectors.  Texts become Arrow
strings straight from the block's bytes: the lines' starts are the offsets of a
string array over the block, from which the wanted lines are taken.

Three kinds of files are read: plain ones from any byte on, gzip files from the
beginning, and block-gzip files (gzip members that tell their size, as `bgzip`
and sequencers write them) from any block on.  Everything here is a per-task
helper; Spark deals out the parts."""

from __future__ import annotations

import zlib

import numpy as np

BLOCK = 8 * 1024 * 1024
#: Bytes read behind a part's end, for its last lines; twice as many each time.
BEHIND = 8 * 1024
#: Offsets in block-gzip files: this bit, the place of the compressed block in the
#: file, and 16 bits for the place in the block.
VIRTUAL = 1 << 62
# --- fixed values: the head of a block-gzip member (gzip with extra fields) and
# the name of the field that holds its size --------------------------------------
_MAGIC, _SIZE_FIELD, _HEAD = b"\x1f\x8b\x08\x04", b"BC", 12
# ---------------------------------------------------------------------------------


def block_size(head: bytes) -> int | None:
    """Size of the block-gzip member that begins with ``head``; None if that is
    something else (or too short to tell)."""
    if head[:4] != _MAGIC or len(head) < _HEAD:
        return None
    at, end = _HEAD, _HEAD + int.from_bytes(head[10:12], "little")
    while at + 4 <= min(end, len(head)):
        size = int.from_bytes(head[at + 2:at + 4], "little")
        if head[at:at + 2] == _SIZE_FIELD and size == 2 and at + 6 <= len(head):
            return int.from_bytes(head[at + 4:at + 6], "little") + 1
        at += 4 + size
    return None


def blocked(data: bytes, piece: int = 0xFF00) -> bytes:
    """``data`` as block-gzip members of ``piece`` bytes each, with the empty
    member that ends such a file."""
    out = []
    for at in [*range(0, len(data), piece), len(data)]:
        part = data[at:at + piece]
        deflate = zlib.compressobj(1, zlib.DEFLATED, -15)
        packed = deflate.compress(part) + deflate.flush()
        size = _HEAD + 6 + len(packed) + 8 - 1
        out.append(_MAGIC + b"\0\0\0\0\0\xff" + (6).to_bytes(2, "little") + _SIZE_FIELD + b"\x02\0"
                   + size.to_bytes(2, "little") + packed + zlib.crc32(part).to_bytes(4, "little")
                   + len(part).to_bytes(4, "little"))
    return b"".join(out)


class Stream:
    """A plain or gzip file from byte ``at`` on; lines from ``limit`` on belong to
    the next part."""

    def __init__(self, stream, at: int, limit: int | None):
        self.stream, self.at, self.limit = stream, at, limit
        self._to, self._behind = at, BEHIND

    def read(self) -> bytes:
        size = BLOCK
        if self.limit is not None and self._to + BLOCK > self.limit:
            size = min(BLOCK, max(0, self.limit - self._to) + self._behind)
            self._behind *= 2
        block = self.stream.read(size)
        self._to += len(block)
        return block

    def offsets(self, places: np.ndarray) -> np.ndarray:
        return places


class Blocks:
    """A block-gzip file from the first block at or after ``start`` on.  Places
    count the bytes from there.  The part owns the lines that begin behind the
    first byte of its first block, up to and with the first byte of the next
    part's first block (that of a file's first part: from its first byte on)."""

    def __init__(self, file, size: int, start: int, end: int):
        self.file, self.size, self.end = file, size, end
        self.at, self.limit = 0, None
        self._raw, self._from = b"", start
        self._places, self._blocks = [], []
        self._length, self._behind = 0, BEHIND
        if start and not self._seek():
            self.limit = 0

    def _have(self, n: int) -> bool:
        """At least ``n`` bytes of the file at hand."""
        if len(self._raw) < n:
            at = self._from + len(self._raw)
            self.file.seek(at)
            self._raw += self.file.read(max(n - len(self._raw), 1 << 20))
        return len(self._raw) >= n

    def _drop(self, n: int) -> None:
        self._raw, self._from = self._raw[n:], self._from + n

    def _block(self) -> bytes | None:
        """The first block at hand, inflated (its checksum is verified); None if
        there is none."""
        self._have(1 << 16)
        n = block_size(self._raw[:1 << 16])
        if n is None or not self._have(n):
            return None
        inflate = zlib.decompressobj(wbits=31)
        try:
            data = inflate.decompress(self._raw[:n])
        except zlib.error:
            return None
        return data if inflate.eof and not inflate.unused_data else None

    def _seek(self) -> bool:
        """Moves on to the next block, one that inflates and is followed by
        another or by the file's end."""
        while self._have(4):
            at = self._raw.find(_MAGIC)
            self._drop(max(0, len(self._raw) - 3) if at < 0 else at)
            if self._from >= self.end:
                return False
            if at < 0:
                continue
            if self._block() is not None:
                n = block_size(self._raw[:1 << 16])
                if self._from + n == self.size or self._have(n + 4) and self._raw[n:n + 4] == _MAGIC:
                    return True
            self._drop(1)
        return False

    def read(self) -> bytes:
        out, n = [], 0
        if self.limit == 0:
            return b""
        most = BLOCK
        while n < most and self._from < self.size:
            if self._from >= self.end and most == BLOCK:
                most = min(BLOCK, n + self._behind)
                self._behind *= 2
            if self.limit is None and self._from >= self.end:
                self.limit = self._length + 1
            data = self._block()
            if data is None:
                raise ValueError(f"no block-gzip member at byte {self._from}")
            self._places.append(self._length)
            self._blocks.append(self._from)
            self._drop(block_size(self._raw[:1 << 16]))
            out.append(data)
            n += len(data)
            self._length += len(data)
        if len(self._places) > 1 << 16:  # those of long ago
            self._places, self._blocks = self._places[-(1 << 15):], self._blocks[-(1 << 15):]
        return b"".join(out)

    def offsets(self, places: np.ndarray) -> np.ndarray:
        first = np.asarray(self._places, np.int64)
        i = np.searchsorted(first, places, "right") - 1
        return VIRTUAL | (np.asarray(self._blocks, np.int64)[i] << 16) | (places - first[i])


class Lines:
    """The complete lines of the bytes at hand: ``n`` of them, their ``starts``,
    ``lengths`` (without line ends) and ``first`` bytes (0 for an empty line),
    and ``places``, their starts in the part.  ``single`` carriage returns end
    lines too if asked."""

    def __init__(self, source, single: bool = False):
        self.source, self.single = source, single
        self._rest, self._at = b"", source.at

    def more(self) -> bool:
        """Reads on; False when this was the end of the file."""
        block = self.source.read()
        self.buf = self._rest + block
        raw = np.frombuffer(self.buf, np.uint8)
        ends = raw == 10
        if self.single and 13 in self.buf:
            alone = raw == 13
            alone[:-1] &= raw[1:] != 10
            alone[-1:] &= not block  # what follows is not known yet
            ends |= alone
        stops = np.flatnonzero(ends)
        if not block and len(raw) and not ends[-1]:
            stops = np.append(stops, len(raw))
        self.n = len(stops)
        self.starts = np.concatenate(([0], stops + 1))[:self.n].astype(np.int64)
        self.bounds = np.append(self.starts, min(stops[-1] + 1, len(raw)) if self.n else 0)
        self.lengths = stops - self.starts
        while True:
            cr = np.flatnonzero(self.lengths > 0)
            cr = cr[raw[self.starts[cr] + self.lengths[cr] - 1] == 13]
            if not len(cr):
                break
            self.lengths[cr] -= 1
        self.first = np.zeros(self.n, np.uint8)
        some = stops > self.starts
        self.first[some] = raw[self.starts[some]]
        self.places = self.starts + self._at
        self._all = None
        return bool(block)

    def keep(self, i: int) -> None:
        """Lines before ``i`` are done with."""
        at = int(self.starts[i]) if i < self.n else int(self.bounds[-1])
        self._rest, self._at = self.buf[at:], self._at + at

    def owned(self) -> int:
        """Number of the lines that belong to this part."""
        limit = self.source.limit
        return self.n if limit is None else int(np.searchsorted(self.places, limit))

    def blank(self, i: int) -> bool:
        return not self.buf[self.bounds[i]:self.bounds[i + 1]].strip()

    def strings(self, lines: np.ndarray):
        """Arrow strings of the numbered lines, without their ends; null behind the
        last line.  Bytes that are no UTF-8 are replaced.

        The bytes at hand are one string array, cut where lines begin and where
        their text ends, so that every second string is a line."""
        import pyarrow as pa
        if self._all is None:
            cuts = np.empty(2 * self.n + 1, np.int32)
            cuts[:-1:2], cuts[1::2], cuts[-1] = self.starts, self.starts + self.lengths, self.bounds[-1]
            try:
                self.buf.isascii() or self.buf[:int(self.bounds[-1])].decode()
                self._all = pa.StringArray.from_buffers(2 * self.n, pa.py_buffer(cuts), pa.py_buffer(self.buf))
            except UnicodeDecodeError:
                parts = (self.buf[a:b].decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:]))
                self._all = pa.array(parts, pa.string())
        if len(lines) and lines[-1] < self.n:  # in order
            return self._all.take(pa.array(2 * lines))
        return self._all.take(pa.array(2 * lines, mask=lines >= self.n))
