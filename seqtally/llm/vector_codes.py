"""Vector codes: product quantization by k-means with adaptive bounds.

A component x becomes the integer floor(256 x); a vector is cut into ``PARTS``
equal parts, and each part position has a codebook of ``ENTRIES`` entries that
begins as that part of the vectors with the smallest ids.  A round assigns every
part to its nearest entry and replaces the entries by their parts' floored means.

Assignments are kept between rounds as Drake and Hamerly do: with each part its
entry and the next b closest ones are persisted, each of the b with a lower bound
of its distance, in order, and one outer bound for all entries beyond.  When the
codebook has moved, bounds shrink by the entries' moves (the outer one by the
largest), and the distance to the own entry is measured.  Entries whose bound is
above it cannot be nearest; if none is below, the part stays where it is; if only
the first few are, these are measured; only a part whose outer bound is reached
meets the whole codebook.  Bounds are rounded down, so what they leave open
is decided by exact integer distances, ties to the lower index.  b follows the
number of entries that nearly all parts had to measure.

Vectors never leave their tasks: a round writes its assignments to the shared
folder, each task adds up its parts by entry, and the sums (fixed in number) make
the next codebook on the driver.

Defined results: a null vector, one with a null or non-finite component, and one
whose length is not that of the kept vector with the smallest id (or not a
multiple of ``PARTS``) are dropped; null ids come last, ties go by the vector;
with fewer kept vectors than ``ENTRIES`` the codebooks have as many entries; rows
alike each count; an empty table gives no rows; further columns play no part.
Components beyond about 2^29 / 256 in size are a ``ValueError``, since their
distances would not fit 64 bits."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqtally.llm._files import staged
from seqtally.operators._util import broadcast_if_small

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256.0
#: Share of the parts whose measured entries b must hold, and the least b.
COVERED, LEAST = 0.99, 4
#: Vectors handled at once, in components.
BLOCK = 1 << 20
#: What bounds are widened by before they are rounded.
MARGIN = 1e-6


def whole_numbers(values: np.ndarray) -> np.ndarray:
    """floor(256 x); what 64 bits cannot hold is left to ``_checked``."""
    with np.errstate(invalid="ignore"):
        return np.floor(values.astype(np.float64) * SCALE).astype(np.int64)


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to entries: (n, L) and (k, L), or (n, m, L)
    for entries of each row's own."""
    own = entries if entries.ndim == 3 else entries[None]
    out = np.zeros((len(x), own.shape[1]), np.int64)
    for i in range(x.shape[1]):
        step = x[:, i, None] - own[:, :, i]
        out += step * step
    return out


def _down(d2: np.ndarray) -> np.ndarray:
    """Roots of squared distances, rounded down."""
    return np.sqrt(d2.astype(np.float64)) * (1 - MARGIN)


def _half(bounds: np.ndarray) -> np.ndarray:
    """Lower bounds as 16-bit floats that are never above them."""
    bounds = np.clip(bounds, 0, 65504)
    short = bounds.astype(np.float16)
    return np.where(short.astype(np.float64) > bounds, np.nextafter(short, np.float16(-1)), short)


def nearest(x: np.ndarray, book: np.ndarray, b: int):
    """ids (n, 1 + b) in order of distance, lower bounds (n, b + 1) of all but
    the first with the outer one at the end, and the first's squared distance."""
    d2 = distances(x, book)
    order = np.argsort(d2, axis=1, kind="stable")
    sorted_d2 = np.take_along_axis(d2, order, axis=1)
    low = np.full((len(x), b + 1), np.inf)
    have = min(b + 1, len(book) - 1)
    low[:, :have] = _down(sorted_d2[:, 1:1 + have])
    ids = np.zeros((len(x), 1 + b), np.int64)
    m = min(1 + b, len(book))
    ids[:, :m] = order[:, :m]
    return ids, low, sorted_d2[:, 0]


def reassigned(x: np.ndarray, ids: np.ndarray, low: np.ndarray, book: np.ndarray, moves: np.ndarray, b: int):
    """``nearest`` after the codebook has moved by ``moves`` (rounded up), from
    the bounds before; also how many entries each part had to measure (b + 1: all)."""
    low = low.astype(np.float64)
    low[:, :-1] -= moves[ids[:, 1:]]
    low[:, -1] -= moves.max()
    low = np.minimum.accumulate(low[:, ::-1], axis=1)[:, ::-1]  # in order
    b = min(b, low.shape[1] - 1)
    low, ids = low[:, :b + 1].copy(), ids[:, :1 + b].copy()  # the first bound left out is the outer one
    d2 = distances(x, book[ids[:, :1]])[:, 0]
    need = (low <= (np.sqrt(d2.astype(np.float64)) * (1 + MARGIN))[:, None]).sum(axis=1)
    some = np.flatnonzero((need > 0) & (need <= b))
    if len(some):
        m = int(need[some].max())
        near = ids[some, :1 + m]
        exact = distances(x[some], book[near])
        order = np.lexsort((near, exact), axis=1)
        near, exact = np.take_along_axis(near, order, axis=1), np.take_along_axis(exact, order, axis=1)
        ids[some, :1 + m], d2[some] = near, exact[:, 0]
        low[some, :m] = _down(exact[:, 1:])
        low[some] = np.minimum.accumulate(low[some][:, ::-1], axis=1)[:, ::-1]
    every = np.flatnonzero(need > b)
    if len(every):
        ids[every], low[every], d2[every] = nearest(x[every], book, b)
    return ids, low, d2, need


@dataclass
class Book:
    """Codebooks (PARTS, entries, length of a part) and how far the entries are
    from those of the round before (None at first)."""
    entries: np.ndarray
    moves: np.ndarray | None = None

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def kept_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, label, embedding without null and non-finite vectors."""
    inf = float("inf")
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (x < inf) & (x > -inf))
    return vectors.select("vec_id", "label", "embedding").filter(F.col("embedding").isNotNull() & fine)


def first_book(kept: DataFrame, entries: int = ENTRIES, parts: int = PARTS) -> Book | None:
    """The parts of the vectors with the smallest ids; None without vectors."""
    cut = kept.filter((F.size("embedding") > 0) & (F.size("embedding") % parts == 0))
    by_id = [F.col("vec_id").asc_nulls_last(), "embedding"]
    one = cut.orderBy(*by_id).select("embedding").first()
    if one is None:
        return None
    same = cut.filter(F.size("embedding") == len(one.embedding))
    rows = same.orderBy(*by_id).select("embedding").limit(entries).collect()
    whole = whole_numbers(np.array([r.embedding for r in rows]))
    _checked(whole, parts)
    return Book(whole.reshape(len(rows), parts, -1).transpose(1, 0, 2))


def _checked(whole: np.ndarray, parts: int) -> None:
    length = max(1, whole.shape[1] // parts)
    if whole.size and max(abs(int(whole.min())), abs(int(whole.max()))) > int((2 ** 60 / length) ** 0.5):
        raise ValueError("a component is too large for exact 64-bit distances")


BOUNDS = ("near", "bounds", "need")
STATE = "ints binary, code binary, near binary, bounds binary, need binary, error long"


def _binary(rows: np.ndarray):
    import pyarrow as pa
    rows = np.ascontiguousarray(rows).reshape(len(rows), -1)
    width = rows.shape[1] * rows.itemsize
    ends = np.arange(len(rows) + 1, dtype=np.int64) * width
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(rows), [
        None, pa.py_buffer(ends), pa.py_buffer(rows.tobytes())]).cast(pa.binary())


def _state(keys, ints, found) -> object:
    """A record batch of assignments: ``found`` holds (ids, low, d2, need) of
    each part."""
    import pyarrow as pa
    ids = np.stack([f[0] for f in found], 1).astype(np.uint8)
    bounds = np.stack([_half(f[1]) for f in found], 1)
    need = np.stack([f[3] for f in found], 1).astype(np.uint8)
    error = np.sum([f[2] for f in found], axis=0, dtype=np.int64)
    short = not ints.size or -(1 << 15) <= ints.min() and ints.max() < 1 << 15
    return pa.RecordBatch.from_arrays(
        [*keys, _binary(ints.astype(np.int16 if short else np.int32)), _binary(ids[:, :, 0]), _binary(ids[:, :, 1:]), _binary(bounds),
         _binary(need), pa.array(error)],
        names=["vec_id", "label", "ints", "code", "near", "bounds", "need", "error"])


def _rows(column, dtype, n: int) -> np.ndarray:
    """Equally long binary values of a column as the rows of an array."""
    import pyarrow as pa
    whole = column.cast(pa.large_binary())
    ends = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset:whole.offset + n + 1]
    data = whole.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data else np.empty(0, np.uint8)
    return raw.reshape(n, -1).copy().view(dtype)


def integers(column, n: int, dims: int) -> np.ndarray:
    """The integers of a column of vectors, of two or four bytes each."""
    import pyarrow.compute as pc
    size = pc.binary_length(column).to_numpy()
    out = np.empty((n, dims), np.int64)
    for kind in (np.int16, np.int32):
        own = np.flatnonzero(size == dims * np.dtype(kind).itemsize)
        if len(own):
            out[own] = _rows(column if len(own) == n else column.take(own), kind, len(own))
    return out


def _schema(vectors: DataFrame) -> str:
    kind = {f.name: f.dataType.simpleString() for f in vectors.schema.fields}
    return f"vec_id {kind['vec_id']}, label {kind['label']}, {STATE}"


def assign_first(kept: DataFrame, book: Book, b: int, last: bool = False) -> DataFrame:
    """Assignments of all kept vectors with all distances measured, staged; the
    last ones without bounds."""
    entries = book.entries
    parts, k, length = entries.shape

    def assign(batches):
        for batch in batches:
            step = max(1, BLOCK // (parts * length))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                flat = part.column("embedding").flatten().to_numpy(zero_copy_only=False)
                whole = whole_numbers(flat.reshape(part.num_rows, parts * length))
                _checked(whole, parts)
                cut = whole.reshape(-1, parts, length)
                found = [(*nearest(cut[:, p], entries[p], b), np.full(len(cut), min(b, 255))) for p in range(parts)]
                yield _state([part.column("vec_id"), part.column("label")], whole, found)
    cut = kept.filter(F.size("embedding") == parts * length)
    return staged(cut.mapInArrow(assign, _schema(kept)).drop(*(BOUNDS if last else ())), "vector-codes")


def assign_again(state: DataFrame, book: Book, b: int, last: bool = False) -> DataFrame:
    """Assignments after the codebook has moved, from the bounds of ``state``,
    staged; the last ones without bounds."""
    entries, moves = book.entries, book.moves
    parts, k, length = entries.shape

    def assign(batches):
        for batch in batches:
            step = max(1, BLOCK // (parts * length))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                n = part.num_rows
                whole = integers(part.column("ints"), n, parts * length)
                cut = whole.reshape(n, parts, length)
                first = _rows(part.column("code"), np.uint8, n).reshape(n, parts, 1)
                near = _rows(part.column("near"), np.uint8, n).reshape(n, parts, -1)
                low = _rows(part.column("bounds"), np.float16, n).reshape(n, parts, -1)
                ids = np.concatenate([first, near], 2).astype(np.int64)
                found = [reassigned(cut[:, p], ids[:, p], low[:, p], entries[p], moves[p], b) for p in range(parts)]
                yield _state([part.column("vec_id"), part.column("label")], whole, found)
    return staged(state.mapInArrow(assign, state.schema).drop(*(BOUNDS if last else ())), "vector-codes")


def _sums(state: DataFrame, parts: int, k: int, length: int) -> DataFrame:
    """slot, pos, total: per part and entry the count (pos 0) and the sums of the
    components; per part the number of vectors by measured entries."""

    def add(batches):
        import pyarrow as pa
        sums = np.zeros((parts, k, 1 + length), np.int64)
        needs = np.zeros((parts, 256), np.int64)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            cut = integers(batch.column("ints"), n, parts * length).reshape(n, parts, length)
            code = _rows(batch.column("code"), np.uint8, n)
            need = _rows(batch.column("need"), np.uint8, n)
            for p in range(parts):
                np.add.at(sums[p, :, 1:], code[:, p], cut[:, p])
                sums[p, :, 0] += np.bincount(code[:, p], minlength=k)
                needs[p] += np.bincount(need[:, p], minlength=256)
        rows = sums.reshape(parts * k, 1 + length)
        used = np.flatnonzero(rows[:, 0])
        yield pa.RecordBatch.from_arrays(
            [pa.array([*used.tolist(), *range(parts * k, parts * k + parts)], pa.int32()),
             pa.array([*rows[used].tolist(), *needs.tolist()], pa.list_(pa.int64()))], names=["slot", "sums"])
    each = state.select("ints", "code", "need").mapInArrow(add, "slot int, sums array<long>")
    return (each.select("slot", F.posexplode("sums").alias("pos", "x")).filter("x <> 0")
            .groupBy("slot", "pos").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("total")))


def next_book(state: DataFrame, book: Book, b: int) -> tuple[Book, int]:
    """The floored means of the entries' parts, how far they are from the entries
    before, and the b that follows.  ``parts * entries * (length + 1)`` sums and
    some counts come to the driver, however many vectors there are."""
    parts, k, length = book.entries.shape
    sums = [[[0] * (1 + length) for _ in range(k)] for _ in range(parts)]
    needs = np.zeros((parts, 256))
    for r in _sums(state, parts, k, length).collect():
        if r.slot < parts * k:
            sums[r.slot // k][r.slot % k][r.pos] = int(r.total)
        else:
            needs[r.slot - parts * k, r.pos] = float(r.total)
    entries = book.entries.copy()
    for p in range(parts):
        for e in range(k):
            count, *total = sums[p][e]
            if count:
                entries[p, e] = [t // count for t in total]
    step = (entries - book.entries).astype(np.float64)
    moves = np.sqrt((step * step).sum(axis=2)) * (1 + MARGIN)
    share = np.cumsum(needs.sum(axis=0)) / max(1.0, needs.sum())
    held = int(np.searchsorted(share, COVERED))
    return Book(entries, moves), max(1, min(b, max(LEAST, held)))


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES,
             rounds: int = ROUNDS) -> tuple[DataFrame | None, Book | None]:
    """(assignments, final codebooks) of ``vectors`` (vec_id, embedding, label):
    vec_id, label, ints, code (a byte for each part) and error.  (None,
    None) if no vector is kept.  ``entries`` is at most 256."""
    if not 0 < entries <= 256:
        raise ValueError("entries must be 1 to 256, since a code is a byte")
    kept = kept_vectors(vectors)
    book = first_book(kept, entries, parts)
    if book is None:
        return None, None
    b = max(1, min(entries // 8, book.entries.shape[1] - 1))
    state = None
    for _ in range(rounds):
        state = assign_first(kept, book, b) if state is None else assign_again(state, book, b)
        book, b = next_book(state, book, b)
    state = assign_first(kept, book, b, True) if state is None else assign_again(state, book, b, True)
    return state, book


def decode(code: Column, book: Book) -> Column:
    """The integers that a code stands for, from a literal codebook."""
    table = F.array(*(F.array(*(F.array(*map(F.lit, e)) for e in part)) for part in book.entries.tolist()))
    parts = len(book.entries)
    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda p: F.get(
        F.get(table, p), F.conv(F.hex(F.substring(code, p + 1, F.lit(1))), 16, 10).cast("int"))))


def vector_table(vectors: DataFrame) -> DataFrame:
    """vec_id, code (hex), error, label_error, codebooks_sha256.  The errors of a
    label are added up before they are shuffled and joined back by label."""
    state, book = compress(vectors)
    if state is None:
        kind = {f.name: f.dataType.simpleString() for f in vectors.schema.fields}
        return vectors.sparkSession.createDataFrame(
            [], f"vec_id {kind['vec_id']}, code string, error long, label_error long, codebooks_sha256 string")
    rows = state.select("vec_id", "label", F.lower(F.hex("code")).alias("code"), "error")
    total = rows.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    joined = rows.join(broadcast_if_small(total), F.col("label").eqNullSafe(F.col("_label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(book.digest()).alias("codebooks_sha256"))
