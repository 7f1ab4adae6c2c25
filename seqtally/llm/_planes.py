"""Number arrays as bytes that compress well: the bytes of all numbers by
significance, each plane by itself, under zstandard."""

from __future__ import annotations

import numpy as np


def planes(values: np.ndarray, width: int) -> bytes:
    """The lowest ``width`` bytes of each value, plane by plane."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def unplanes(data: bytes, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(width, n).T
    return out.view("<u8").ravel()


def pack(*columns: tuple[np.ndarray, int]) -> bytes:
    """Columns of (values, width), each with its length."""
    import zstandard
    raw = b"".join(len(c).to_bytes(8, "little") + planes(c, w) for c, w in columns)
    return zstandard.ZstdCompressor(level=1).compress(raw)


def unpack(data: bytes, *widths: int) -> list[np.ndarray]:
    import zstandard
    raw, at, out = zstandard.ZstdDecompressor().decompress(data), 0, []
    for w in widths:
        n = int.from_bytes(raw[at:at + 8], "little")
        out.append(unplanes(raw[at + 8:at + 8 + n * w], n, w))
        at += 8 + n * w
    return out


def pack_sorted(keys: np.ndarray, *columns: tuple[np.ndarray, int]) -> bytes:
    """Sorted 64-bit keys by their differences, and further columns."""
    return pack((np.diff(keys, prepend=np.uint64(0)), 8), *columns)


def unpack_sorted(data: bytes, *widths: int) -> list[np.ndarray]:
    steps, *rest = unpack(data, 8, *widths)
    return [np.cumsum(steps, dtype=np.uint64), *rest]
