"""Plain barcodes looked up in batches of reads.

Where a library is dense, so that most seeds begin some of its barcodes, a seed
join meets several barcodes at each position of each read.  Here the tasks look up
whole barcodes instead.  Four letters make two bits each; the barcodes of a set
that are equally long are a table of such codes, and a vector operation looks up
all positions of a batch.  What leaves a task are matches, one for each read and
set if only the first counts, or their numbers.

Patterns are looked up too where the first match counts: as the texts that they
come down to, of which equal ones are one entry, with a table for each place of
their dots.  What else a pattern can match is found by texts that it must contain,
and tested inside the task (``candidates``)."""

from __future__ import annotations

import numpy as np

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from seqtally.functions.patterns import cover, wild_texts
from seqtally.functions.sequence import is_literal_barcode
from seqtally.operators import _util

#: Barcodes from which on a library is looked up; bytes that each takes in a task
#: (a code, a rank, an ord and a set: 24, and its bits of the filter).
LEAST, ENTRY_BYTES = 1000, 32
#: Letters of a code; most tables (of a set and a length each).
LONGEST, TABLES = 31, 64
#: Letters up to which a table can have a place for each code.
DENSE = 10
#: Letters of the reads that are looked up at once, rows of a batch that leaves a
#: task, and (sample, barcode) numbers that it holds.
LETTERS, ROWS, HELD = 1 << 20, 1 << 16, 1 << 21

_BITS = np.full(256, 4, np.uint8)
_BITS[np.frombuffer(b"ACGT", np.uint8)] = range(4)
_DOT = ord(".")


def _text(column):
    """The bytes of a string column and where its values begin and end."""
    import pyarrow as pa
    import pyarrow.compute as pc
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), offsets


def _bit(code, width):
    """Places of codes in a filter of 2 ** ``width`` bits."""
    return ((code.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - width)).astype(np.int64)


class Lookup:
    """The tables.  A barcode's rank is its place in the order of ``ord``."""

    def __init__(self, library):
        """``library``: Arrow table of barcode_set, ord, barcode.  A dot in a
        barcode is any character but a line's end."""
        import pyarrow.compute as pc
        sets = library.column("barcode_set").unique()
        self.sets = sets.to_pylist()
        own = pc.index_in(library.column("barcode_set"), value_set=sets).to_numpy().astype(np.int64)
        ords = library.column("ord").to_numpy()
        order = np.lexsort([own, ords])
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(ords[order]) != 0) | (np.diff(own[order]) != 0)
        rank = np.empty(len(order), np.int32)
        rank[order] = np.cumsum(new) - 1
        self.rank_ord, self.rank_set = ords[order][new], own[order][new].astype(np.int32)
        self.none = len(self.rank_ord)
        data, offsets = _text(library.column("barcode").combine_chunks())
        length = np.diff(offsets)
        self.tables = []  # (set, letters, dots, all codes' ranks, or else codes, ranks and a filter)
        for n in np.unique(length):
            n = int(n)
            these = np.flatnonzero(length == n)
            dot = data[offsets[these][:, None] + np.arange(n)] == _DOT
            shape = dot @ (1 << np.arange(n, dtype=np.int64))
            for s in range(len(self.sets)):
                for dots in np.unique(shape[own[these] == s]):
                    at = these[(shape == dots) & (own[these] == s)]
                    self._add(s, n, [j for j in range(n) if int(dots) >> j & 1], data, offsets[at], rank[at])
        self.dots = any(t[2] for t in self.tables)

    def _add(self, s, n, dots, data, starts, ranks):
        code = np.zeros(len(starts), np.int64)
        for j in range(n):
            code = code << 2 | (0 if j in dots else _BITS[data[starts + j]])
        order = np.argsort(code)
        code, ranks = code[order], ranks[order]
        if (np.diff(code) == 0).any():
            raise ValueError("a barcode set holds a barcode twice")
        if n <= DENSE and 4 ** n <= max(1 << 16, 64 * len(code)):
            every = np.full(4 ** n, self.none, np.int32)
            every[code] = ranks
            self.tables.append((s, n, dots, every, None))
        else:
            width = max(16, (8 * len(code)).bit_length())
            held = np.zeros(1 << width, bool)
            held[_bit(code, width)] = True
            self.tables.append((s, n, dots, None, (code, ranks, np.packbits(held, bitorder="little"), width)))

    def _found(self, data, offsets):
        """Of the reads between ``offsets``: what each table finds, as (set,
        positions, ranks)."""
        letters = data[offsets[0]:offsets[-1]]
        base = _BITS[letters]
        here = np.arange(len(base))
        room = whole = np.repeat(offsets[1:] - offsets[0], np.diff(offsets)) - here
        gaps = np.flatnonzero(base == 4)
        if len(gaps):
            base[gaps] = 0
            ahead = np.append(gaps, len(base))[np.searchsorted(gaps, here)] - here
            room = np.minimum(room, ahead)
            ends = gaps[np.isin(letters[gaps], (10, 13))] if self.dots else gaps[:0]
        base = base.astype(np.int32 if self.tables[-1][1] <= 15 else np.int64)
        code, width = base.copy(), 1
        for s, n, dots, every, searched in self.tables:  # the shortest first
            if n > len(base):
                return
            for width in range(width + 1, n + 1):
                head = code[:len(base) - width + 1]
                head <<= 2
                head |= base[width - 1:]
            own, fits = code, room >= n
            if dots:
                own = code & code.dtype.type(4 ** n - 1 - sum(3 << 2 * (n - 1 - j) for j in dots))
                if len(gaps):
                    fits = whole >= n
                    for a, b in zip([-1, *dots], [*dots, n]):  # the letters between dots
                        if b - a > 1:
                            fits[:len(base) - a - 1] &= ahead[a + 1:] >= b - a - 1
                    for j in dots:
                        fits[(ends - j)[ends >= j]] = False
            if every is not None:
                ranks = every[own]
                at = np.flatnonzero(fits & (ranks < self.none))
                yield s, at, ranks[at]
            else:
                codes, ranks, held, wide = searched
                bit = _bit(own, wide)
                at = np.flatnonzero(fits & (held[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(bool))
                wanted = own[at]
                place = np.minimum(np.searchsorted(codes, wanted), len(codes) - 1)
                same = codes[place] == wanted
                yield s, at[same], ranks[place[same]]

    def _pieces(self, sequences):
        data, offsets = _text(sequences)
        if self.dots and (data[offsets[0]:offsets[-1]] > 127).any():  # a dot is a whole character
            import pyarrow.compute as pc
            for what, by in (("[\u0085\u2028\u2029]", "\n"), ("[^\x00-\x7f]", "?")):
                sequences = pc.replace_substring_regex(sequences, what, by)
            data, offsets = _text(sequences)
        a = 0
        while a < len(sequences):
            b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + LETTERS, "right")) - 1)
            if offsets[b] > offsets[a]:
                yield a, data, offsets[a:b + 1]
            a = b

    def first(self, sequences):
        """(reads, ranks) of the first match of each read in each set."""
        reads, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
        for a, data, offsets in self._pieces(sequences):
            filled = np.flatnonzero(np.diff(offsets))
            starts = (offsets[filled] - offsets[0]).astype(np.int64)
            best = {}
            for s, at, ranks in self._found(data, offsets):
                if s not in best:
                    best[s] = np.full(offsets[-1] - offsets[0], self.none, np.int32)
                best[s][at] = np.minimum(best[s][at], ranks)
            for each in best.values():
                least = np.minimum.reduceat(each, starts)
                hit = np.flatnonzero(least < self.none)
                reads.append(filled[hit] + a)
                found.append(least[hit])
        return np.concatenate(reads), np.concatenate(found)

    def every(self, sequences):
        """(reads, ranks) of all matches, each once, in order of the reads."""
        reads, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
        for a, data, offsets in self._pieces(sequences):
            read = np.repeat(np.arange(a, a + len(offsets) - 1), np.diff(offsets))
            pairs = [read[at] * self.none + ranks for _, at, ranks in self._found(data, offsets)]
            if pairs:
                pairs = np.sort(np.concatenate(pairs))
                pairs = pairs[np.append(True, np.diff(pairs) != 0)] if len(pairs) else pairs
                reads.append(pairs // self.none)
                found.append((pairs % self.none).astype(np.int32))
        return np.concatenate(reads), np.concatenate(found)

    def names(self, ranks):
        """Arrow columns barcode_set and ord of ranks; nulls behind the last."""
        import pyarrow as pa
        known = ranks < self.none
        ranks = np.where(known, ranks, 0)
        sets = pa.array(self.sets, pa.string()).take(pa.array(self.rank_set[ranks], mask=~known))
        return sets, pa.array(self.rank_ord[ranks], mask=~known)


class _Numbers:
    """Numbers of (sample, rank), added up inside a task."""

    def __init__(self, lookup: Lookup, kind):
        self.lookup, self.kind, self.samples = lookup, kind, {}
        self._clear()

    def _clear(self):
        self.keys, self.counts, self.new, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

    def add(self, samples, ranks):
        """``samples``: a value of ``codes`` for each rank."""
        self.new.append(samples * (self.lookup.none + 1) + ranks)
        self.size += len(ranks)
        if self.size > max(HELD // 2, len(self.keys)):
            self._merge()

    def codes(self, column):
        """Numbers of a batch's samples."""
        import pyarrow as pa
        values = column.unique()
        own = np.array([self.samples.setdefault(v, len(self.samples)) for v in values.to_pylist()], np.int64)
        import pyarrow.compute as pc
        return own[pc.index_in(column, value_set=values).to_numpy(zero_copy_only=False)] if len(column) else own

    def _merge(self):
        keys = np.sort(np.concatenate(self.new)) if self.new else np.zeros(0, np.int64)
        first = np.flatnonzero(np.append(True, np.diff(keys) != 0)) if len(keys) else np.zeros(0, np.int64)
        counts = np.diff(np.append(first, len(keys)))
        keys = np.concatenate([self.keys, keys[first]])
        counts = np.concatenate([self.counts, counts])
        self.keys, place = np.unique(keys, return_inverse=True)
        self.counts = np.zeros(len(self.keys), np.int64)
        np.add.at(self.counts, place, counts)
        self.new, self.size = [], 0

    def told(self, least: int = 0):
        """(samples, barcode_set, ord, n) columns, if more than ``least`` are held."""
        import pyarrow as pa
        if least and len(self.keys) <= least:
            return
        self._merge()
        names = pa.array(list(self.samples), self.kind)
        for a in range(0, len(self.keys), ROWS):
            sample, rank = np.divmod(self.keys[a:a + ROWS], self.lookup.none + 1)
            sets, ords = self.lookup.names(rank)
            yield names.take(pa.array(sample)), sets, ords, pa.array(self.counts[a:a + ROWS])
        self._clear()
        self.samples = {}


def lookup_of(library: DataFrame):
    """The broadcast tables of a library, or None: of few barcodes, of others than
    A, C, G and T or longer ones, of many sets, or beyond the broadcast bound.  As
    the index of a broadcast join, they pass through the driver."""
    plain = F.coalesce(F.col("barcode").rlike(f"^[ACGT]{{1,{LONGEST}}}$"), F.lit(False)) & F.col("ord").isNotNull()
    about = library.agg(F.count(F.lit(1)).alias("n"), F.count_if(~plain).alias("others")).first()
    if about.n < LEAST or about.others or about.n * ENTRY_BYTES > _util.BROADCAST_BYTES:
        return None
    if library.select("barcode_set", F.length("barcode")).distinct().limit(TABLES + 1).count() > TABLES:
        return None
    if library.groupBy("barcode_set", "barcode").count().filter("count > 1").limit(1).count():
        return None
    tables = Lookup(library.select("barcode_set", "ord", "barcode").toArrow())
    return library.sparkSession.sparkContext.broadcast(tables)


def _pattern_entries(library: DataFrame) -> DataFrame:
    """barcode_set, ord, text, pattern: the texts that the barcodes come down to
    (pattern NULL), and those that a match of a pattern to be tested contains; of
    equal ones the first.  What cannot be looked up has no text."""
    def reduced(batches):
        import pyarrow as pa
        for batch in batches:
            rows = []
            for s, o, b, plain in zip(*(batch.column(c).to_pylist() for c in ("barcode_set", "ord", "barcode", "plain"))):
                texts, tested = ([b], []) if plain else wild_texts(b) or ([], cover(b) or [None])
                rows += [(s, o, t, None) for t in texts]
                rows += [(s, o, t and t[:LONGEST], b) for t in tested]
            kinds = (pa.string(), pa.int64(), pa.string(), pa.string())
            columns = list(zip(*rows)) or [()] * 4
            yield _batch([pa.array(c, k) for c, k in zip(columns, kinds)], ["barcode_set", "ord", "text", "pattern"])
    entries = (library.select("barcode_set", F.col("ord").cast("long").alias("ord"), "barcode", is_literal_barcode("barcode").alias("plain"))
               .mapInArrow(reduced, "barcode_set string, ord long, text string, pattern string"))
    return _util.checkpointed(entries.groupBy("barcode_set", "text", "pattern").agg(F.min("ord").alias("ord")))


def pattern_lookup_of(library: DataFrame):
    """For the first matches of a library with patterns: broadcast tables of the
    texts, and of the texts that are to be tested with the rows (key, t_set, t_ord,
    pattern) that they stand for, either None without such.  None as in
    ``lookup_of``, and where a pattern has no text to be looked up by."""
    if library.select(F.count(F.lit(1)).alias("n"), F.count_if(F.col("ord").isNull()).alias("none")).filter(
            (F.col("n") < LEAST) | (F.col("none") > 0)).count():
        return None
    entries = _pattern_entries(library)
    fits = F.coalesce(F.col("text").rlike(f"^(?:[ACGT.]{{1,{LONGEST}}})\\z"), F.lit(False))
    about = entries.agg(F.count(F.lit(1)).alias("n"), F.count_if(~fits).alias("others"), F.sum(
        F.coalesce(F.octet_length("pattern") + _util.ROW_BYTES, F.lit(0))).alias("tested")).first()
    if about.others or about.n * ENTRY_BYTES + about.tested > _util.BROADCAST_BYTES:
        return None
    shape = F.translate("text", "CGT", "AAA")
    if entries.select(F.when(F.col("pattern").isNull(), F.struct("barcode_set")), shape).distinct().limit(TABLES + 1).count() > TABLES:
        return None
    own = entries.filter("pattern IS NULL").select("barcode_set", "ord", F.col("text").alias("barcode"))
    tested = entries.filter("pattern IS NOT NULL").withColumn("key", F.xxhash64("text"))
    texts = tested.select(F.lit("").alias("barcode_set"), F.col("key").alias("ord"), F.col("text").alias("barcode")).distinct()
    own, texts = own.toArrow(), texts.toArrow()
    share = library.sparkSession.sparkContext.broadcast
    tables = share((Lookup(own) if len(own) else None, Lookup(texts) if len(texts) else None))
    rows = tested.select("key", F.col("barcode_set").alias("t_set"), F.col("ord").alias("t_ord"), "pattern")
    return tables, rows if len(texts) else None


def candidates(reads: DataFrame, looked, carry, keep_unmatched: bool) -> DataFrame:
    """sample, read_key, *carry, _read, barcode_set, ord: the first match of each
    read in each set, and maybe later ones; with ``keep_unmatched`` one row of each
    read with NULLs too.  The rows of a read follow each other in its task."""
    tables, tested = looked
    reads = reads.withColumn("_read", F.monotonically_increasing_id())
    own = ["sample", "read_key", *carry, "_read"]
    schema = StructType([*_fields(reads, own), *_BARCODE, StructField("key", LongType()), StructField("sequence", StringType())])

    def found(batches):
        import pyarrow as pa
        for batch in batches:
            sure, other = tables.value
            none = np.zeros(0, np.int64)
            read, rank = sure.first(batch.column("sequence")) if sure else (none, none)
            at, key = other.every(batch.column("sequence")) if other else (none, none)
            alone = np.arange(batch.num_rows if keep_unmatched else 0)
            place = np.concatenate([alone, read, at])
            order = np.argsort(place, kind="stable")
            rank = np.concatenate([np.full(len(alone), sure.none if sure else 0), rank, np.full(len(at), sure.none if sure else 0)])[order]
            key = np.concatenate([np.full(len(alone) + len(read), other.none if other else 0), key])[order]
            for a in range(0, len(order), ROWS):
                some = pa.array(place[order[a:a + ROWS]])
                n, test = len(some), key[a:a + ROWS] < (other.none if other else 0)
                names = sure.names(rank[a:a + ROWS]) if sure else (pa.nulls(n, pa.string()), pa.nulls(n, pa.int64()))
                keys = other.names(key[a:a + ROWS])[1] if other else pa.nulls(n, pa.int64())
                texts = batch.column("sequence").take(pa.array(some.to_numpy(), mask=~test))
                yield _batch([*(batch.column(c).take(some) for c in own), *names, keys, texts], schema.names)
    rows = reads.select(*own, "sequence").mapInArrow(found, schema)
    if tested is not None:
        rows = rows.join(F.broadcast(tested), "key", "left").filter("key IS NULL OR sequence rlike pattern")
        test = F.col("key").isNotNull()
        rows = rows.withColumns({"barcode_set": F.when(test, F.col("t_set")).otherwise(F.col("barcode_set")),
                                 "ord": F.when(test, F.col("t_ord")).otherwise(F.col("ord"))})
    return rows.select(*own, "barcode_set", "ord")


def _fields(reads: DataFrame, names) -> list[StructField]:
    return [StructField(n, reads.schema[n].dataType) for n in names]


_BARCODE = [StructField("barcode_set", StringType()), StructField("ord", LongType())]


def _batch(columns, names):
    import pyarrow as pa
    columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns]
    return pa.RecordBatch.from_arrays(columns, names=names)


def matches(reads: DataFrame, tables, every: bool, carry=()) -> DataFrame:
    """sample, read_key, *carry, barcode_set, ord: the first match of each read in
    each set, or ``every`` one."""
    own = ["sample", "read_key", *carry]
    schema = StructType([*_fields(reads, own), *_BARCODE])

    def found(batches):
        import pyarrow as pa
        for batch in batches:
            look = tables.value
            read, rank = (look.every if every else look.first)(batch.column("sequence"))
            for a in range(0, len(read), ROWS):
                at = pa.array(read[a:a + ROWS])
                yield _batch([*(batch.column(c).take(at) for c in own), *look.names(rank[a:a + ROWS])], schema.names)
    return reads.select(*own, "sequence").mapInArrow(found, schema)


def matches_and_totals(reads: DataFrame, tables, every: bool, carry=(), number_all: bool = False) -> DataFrame:
    """sample, barcode_set, read_key, ord, n, *carry: ``matches`` with n = 1, and
    numbers of reads with nulls but for the sample.  With ``number_all`` the
    matches are the first ones, the numbers those of every match of a barcode too,
    and a column ``first`` tells them apart."""
    own = ["read_key", *carry]
    schema = StructType([*_fields(reads, ["sample"]), _BARCODE[0], *_fields(reads, ["read_key"]), _BARCODE[1],
                         StructField("n", LongType()), *_fields(reads, carry)]
                        + [StructField("first", BooleanType())] * number_all)

    def found(batches):
        import pyarrow as pa
        numbers, kinds = None, {}

        def row_batch(sample, sets, ords, n, key, more, first):
            told = [sample, sets, key, ords, n, *more]
            return _batch(told + [pa.repeat(pa.scalar(first), len(n))] * number_all, schema.names)

        def totals(least=0):
            for sample, sets, ords, n in numbers.told(least):
                key, *more = (pa.nulls(len(n), kinds[c]) for c in own)
                yield row_batch(sample, sets, ords, n, key, more, False)

        for batch in batches:
            look = tables.value
            if numbers is None:
                kinds = {c: batch.column(c).type for c in ["sample", *own]}
                numbers = _Numbers(look, kinds["sample"])
            sample = numbers.codes(batch.column("sample"))
            numbers.add(sample, np.full(len(sample), look.none))
            if number_all:
                read, rank = look.every(batch.column("sequence"))
                numbers.add(sample[read], rank)
            read, rank = (look.every if every else look.first)(batch.column("sequence"))
            for a in range(0, len(read), ROWS):
                at = pa.array(read[a:a + ROWS])
                sets, ords = look.names(rank[a:a + ROWS])
                key, *more = (batch.column(c).take(at) for c in own)
                yield row_batch(batch.column("sample").take(at), sets, ords, pa.array(np.ones(len(at), np.int64)), key, more, True)
            yield from totals(HELD)
        if numbers is not None:
            yield from totals()
    return reads.select("sample", *own, "sequence").mapInArrow(found, schema)


def numbers_of(reads: DataFrame, tables, every: bool) -> DataFrame:
    """sample, barcode_set, ord, n of the first matches, or ``every`` one, and of
    the reads (NULL barcode_set and ord), still to be added up."""
    schema = StructType([*_fields(reads, ["sample"]), *_BARCODE, StructField("n", LongType())])

    def counted(batches):
        numbers = None
        for batch in batches:
            look = tables.value
            if numbers is None:
                numbers = _Numbers(look, batch.column("sample").type)
            sample = numbers.codes(batch.column("sample"))
            numbers.add(sample, np.full(len(sample), look.none))
            read, rank = (look.every if every else look.first)(batch.column("sequence"))
            numbers.add(sample[read], rank)
            for columns in numbers.told(HELD):
                yield _batch(columns, schema.names)
        if numbers is not None:
            for columns in numbers.told():
                yield _batch(columns, schema.names)
    return reads.select("sample", "sequence").mapInArrow(counted, schema)


def numbers_by_read(reads: DataFrame, tables, carry=()) -> DataFrame:
    """sample, read_key, *carry, n: how many barcodes a read holds, if any."""
    own = ["sample", "read_key", *carry]
    schema = StructType([*_fields(reads, own), StructField("n", LongType())])

    def counted(batches):
        import pyarrow as pa
        for batch in batches:
            read, n = np.unique(tables.value.every(batch.column("sequence"))[0], return_counts=True)
            at = pa.array(read)
            yield _batch([*(batch.column(c).take(at) for c in own), pa.array(n.astype(np.int64))], schema.names)
    return reads.select(*own, "sequence").mapInArrow(counted, schema)


def detected(reads: DataFrame, tables) -> DataFrame:
    """sample, read_key, detected of all reads."""
    own = ["sample", "read_key"]
    schema = StructType([*_fields(reads, own), StructField("detected", BooleanType())])

    def told(batches):
        import pyarrow as pa
        for batch in batches:
            hit = np.zeros(batch.num_rows, bool)
            hit[tables.value.first(batch.column("sequence"))[0]] = True
            yield _batch([*(batch.column(c) for c in own), pa.array(hit)], schema.names)
    return reads.select(*own, "sequence").mapInArrow(told, schema)
