"""Assign reads to barcodes they contain.

Containment (``barcode`` is a substring of ``sequence``) is a theta join that
Spark would plan as a broadcast nested loop (reads x barcodes).  Here it is an
equi-join instead.  Read positions yield seeds (the k-mer starting there,
hashed to a long), the library yields the seeds of each barcode at a few
offsets, and a hash join on the seed finds every candidate occurrence; the full
barcode is then compared at the implied start.  No hit is lost (see
``seed_lanes``), hash collisions only add comparisons, and the work per read
grows with its length, not with the library.

The index is broadcast when its estimated size is within ``BROADCAST_BYTES``.
All seeds of a read then stay in its task, and the smallest ``ord`` of a read is
taken there, from the few rows that matched (``within_reads``): nothing keyed by
read is shuffled.  Beyond the bound, positions first meet a bit table of the
library's seeds, and what is left is shuffled with only the piece of the read
that the comparison needs.

A library of many plain barcodes is not joined at all: a position would meet
several of them.  The tasks look whole barcodes up (``lookup``), and patterns too
where only the first match of a read counts.

Barcodes that are not plain letters are regular expressions, as in the
reference.  A pattern that stands for a few plain texts is replaced by them; any
other is searched by its required factors, a set of texts of which each match
contains one, and then tested.  Patterns without such factors meet each read once,
in the same join and the same pass, through its own row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqtally.functions.patterns import cover, plain_texts
from seqtally.functions.sequence import is_literal_barcode
from seqtally.operators import _util, lookup
from seqtally.operators._util import ROW_BYTES, broadcast_if_small, checkpointed, size_bytes

# Texts shorter than SEED_MIN seed on their own full length.  Longer ones
# share one seed length k = min(shortest such text, SEED_MAX): 4^8 = 65,536
# seed values already make a read position meet few library seeds.
SEED_MIN = 8
SEED_MAX = 12
# Up to this many texts shorter than SEED_MIN are tested with instr() on each
# read instead of seeding every position (a 1-nt barcode would make every
# position a candidate), and up to this many patterns without factors as
# constants, which are compiled once.  More of either are joined.
SHORT_INLINE_MAX = 32
PATTERN_INLINE_MAX = 64
# Seed hash of a read's own row (position 0), which meets each read once.
SENTINEL = -1
# Bits of the seed table of the shuffled join (2^20 rows of 64 bits at most).
TABLE_BITS = 26

ENTRIES = "barcode_set string, ord long, text string, pattern string"


def library_entries(library: DataFrame, patterns: bool = True) -> DataFrame:
    """barcode_set, ord, text, pattern: what is looked for in the reads; without
    ``patterns`` the library has plain barcodes only.  A
    plain barcode is its own text; a pattern becomes the texts it stands for,
    or the texts of which each match contains one plus the pattern, or (text
    NULL) the pattern alone."""
    literal = is_literal_barcode("barcode")
    plain = library.filter(literal).select("barcode_set", "ord", F.col("barcode").alias("text"),
                                           F.lit(None).cast("string").alias("pattern"))
    regex = library.filter(~literal).select("barcode_set", "ord", "barcode")

    def reduced(batches):
        import pyarrow as pa
        for batch in batches:
            rows = []
            for s, o, p in zip(*(batch.column(c).to_pylist() for c in ("barcode_set", "ord", "barcode"))):
                texts = plain_texts(p)
                if texts:
                    rows += [(s, o, t, None) for t in texts]
                else:
                    rows += [(s, o, t, p) for t in cover(p) or [None]]
            kinds = (pa.string(), pa.int64(), pa.string(), pa.string())
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             names=["barcode_set", "ord", "text", "pattern"])
    return checkpointed(plain.unionByName(regex.mapInArrow(reduced, ENTRIES))) if patterns else plain


def text_lengths(entries: DataFrame) -> dict[int, int]:
    """Number of entries of each text length (0: no text); one small job, at
    most one row for each length."""
    rows = entries.groupBy(F.coalesce(F.length("text"), F.lit(0)).alias("n")).count().collect()
    return {r.n: r["count"] for r in rows}


def seed_lanes(plain: dict, seed_min: int = SEED_MIN, seed_max: int = SEED_MAX,
               max_build_rows: int = 1 << 62):
    """Probe lanes (seed length, step) and the seed length / step of the
    long-barcode class.

    A barcode of length L >= Lmin occupies L - k + 1 >= Lmin - k + 1 seed
    positions, so probing every s-th read position (s <= Lmin - k + 1) hits
    one of them at an offset o in [0, s); the library is indexed at exactly
    those s offsets.  s shrinks so the indexed library stays within the
    broadcast bound; if it can't, the join is shuffled and s is as large as it
    can be, for fewer probes."""
    short = sorted(n for n in plain if n < seed_min)
    long_n = sum(c for n, c in plain.items() if n >= seed_min)
    lanes = [(n, 1) for n in short]
    k = s = None
    if long_n:
        lmin = min(n for n in plain if n >= seed_min)
        k = min(lmin, seed_max)
        s = lmin - k + 1
        if long_n <= max_build_rows:
            s = max(1, min(s, max_build_rows // long_n))
        lanes.append((k, s))
    return lanes, k, s


def candidates(reads: DataFrame, library: DataFrame, carry: tuple[str, ...] = (),
               seed_min: int = SEED_MIN, keep_unmatched: bool = False) -> DataFrame:
    """Every (read, barcode) pair where the barcode occurs in the read.

    ``reads``: sample, read_key, sequence (+ ``carry`` columns).  ``library``:
    barcode_set, ord, barcode (upper-case, deduplicated).  Returns sample,
    read_key, *carry, barcode_set, ord; a pair may occur more than once,
    callers aggregate.  With ``keep_unmatched`` every read also yields exactly
    one row with NULL barcode_set and ord, whatever the library holds, so the
    pass that finds the matches also counts the reads."""
    return _found(reads, library, carry, seed_min, keep_unmatched)[0].drop("_read")


def _found(reads: DataFrame, library: DataFrame, carry, seed_min: int,
           keep_unmatched: bool, every: bool = True) -> tuple[DataFrame, bool]:
    """``candidates``, and whether all rows of a read are in one task, one after
    the other, and carry its number there (``_read``).  Unless ``every``, rows
    behind the first match of a read in a set may be left out."""
    kinds = library.agg(F.count(F.lit(1)).alias("n"),
                        F.count_if(F.coalesce(F.length("barcode"), F.lit(0)) == 0).alias("empty"),
                        F.count_if(~is_literal_barcode("barcode")).alias("patterns")).first()
    if kinds.empty:
        raise ValueError("barcode library contains empty barcodes")
    if not kinds.n:
        raise ValueError("empty barcode library")
    if kinds.patterns and not every:
        looked = lookup.pattern_lookup_of(library)
        if looked is not None:
            return lookup.candidates(reads, looked, carry, keep_unmatched), True
    entries = library_entries(library, kinds.patterns > 0)
    lengths = text_lengths(entries)
    alone, short = lengths.pop(0, 0), sum(c for n, c in lengths.items() if n < seed_min)
    inline = F.lit(False)
    if 0 < alone <= PATTERN_INLINE_MAX:
        inline = inline | F.col("text").isNull()
    if 0 < short <= SHORT_INLINE_MAX:
        inline = inline | (F.length("text") < seed_min)
        lengths = {n: c for n, c in lengths.items() if n >= seed_min}
    inline = F.coalesce(inline, F.lit(False))
    constants = entries.filter(inline).collect()  # SHORT_INLINE_MAX + PATTERN_INLINE_MAX at most
    joined = entries.filter(~inline)
    patterns = joined.filter("text IS NULL") if alone > PATTERN_INLINE_MAX else None
    seeded = joined.filter("text IS NOT NULL")

    longest = max(lengths, default=0)
    bound = max(1, _util.BROADCAST_BYTES // (ROW_BYTES + 2 * longest))
    lanes, k, s = seed_lanes(lengths, seed_min, max_build_rows=bound)
    size = sum(c * (1 if n < seed_min else s) for n, c in lengths.items())
    index = _index(seeded, k, s, seed_min) if lengths else None
    own = ["sample", "read_key", *carry]
    alone_bytes = size_bytes(patterns) if patterns is not None else 0
    if size <= bound and alone_bytes <= _util.BROADCAST_BYTES:
        numbered = reads.select(*own, "sequence", F.monotonically_increasing_id().alias("_read"))
        return _joined(numbered, lanes, index, _once(reads, constants, patterns, keep_unmatched), constants,
                       [*own, "_read"]), True
    parts = []
    if constants or keep_unmatched or patterns is not None:
        blocks = max(1, -(-alone_bytes // max(_util.BROADCAST_BYTES, 1 << 20)))
        for i in range(blocks):  # one, unless the patterns alone are beyond the bound
            some = patterns if blocks == 1 else patterns.filter(F.pmod(F.xxhash64("pattern"), F.lit(blocks)) == i)
            told, fixed = keep_unmatched and i == 0, constants if i == 0 else []
            parts.append(_joined(reads, [], None, _once(reads, fixed, some, told), fixed, own))
    if index is not None:
        parts += _shuffled(reads, lanes, s, index, longest, own)
    return reduce(DataFrame.unionByName, parts), False


def _once(reads: DataFrame, constants, patterns: DataFrame | None, keep_unmatched: bool) -> DataFrame | None:
    """Index rows that meet each read once: its own row, the patterns without
    factors, and (met where they were found to match) the constants."""
    def row(barcode_set, ord_, pattern, h):
        return F.struct(F.lit(barcode_set).cast("string").alias("b_set"), F.lit(ord_).cast("long").alias("ord"),
                        F.lit("").alias("text"), F.lit(pattern).cast("string").alias("pattern"), F.lit(0).alias("blen"),
                        F.lit(0).alias("o"), F.lit(h).cast("long").alias("b_h"), F.lit(True).alias("once"))
    rows = [row(None, None, None, SENTINEL)] if keep_unmatched else []
    rows += [row(c.barcode_set, c.ord, None, SENTINEL - 1 - i) for i, c in enumerate(constants)]
    out = reads.sparkSession.range(1).select(F.inline(F.array(*rows))) if rows else None
    if patterns is not None:
        # a constant key would turn the hash join into a nested loop
        key = F.least(F.length("pattern"), F.lit(SENTINEL)).cast("long")
        each = patterns.select(F.col("barcode_set").alias("b_set"), "ord", F.lit("").alias("text"), "pattern",
                               F.lit(0).alias("blen"), F.lit(0).alias("o"), key.alias("b_h"), F.lit(True).alias("once"))
        out = each if out is None else out.unionByName(each)
    return out


def _index(entries: DataFrame, k: int | None, s: int | None, seed_min: int) -> DataFrame:
    """The library's seeds: a row for each text and offset."""
    blen = F.length("text")
    short = F.lit(True) if s is None else blen < seed_min
    offsets = F.array(F.lit(0)) if s is None else F.when(short, F.array(F.lit(0))).otherwise(
        F.sequence(F.lit(0), F.lit(s - 1)))
    klen = blen if k is None else F.when(short, blen).otherwise(F.lit(k))
    return (entries.select(F.col("barcode_set").alias("b_set"), "ord", "text", "pattern",
                           blen.alias("blen"), klen.alias("b_klen"), F.explode(offsets).alias("o"))
            .withColumn("b_h", F.xxhash64(F.expr("substr(text, o + 1, b_klen)"))).drop("b_klen")
            .withColumn("once", F.lit(False)))


def _probe(reads: DataFrame, lanes, keep, extra: list[Column] = ()) -> DataFrame:
    """keep, sequence, pos, klen, h: the seeds of every read.  ``extra`` arrays of
    positions below 1 come first; their h is the position minus one."""
    length = F.length("sequence")
    if len(lanes) <= 1:
        # without a lane no text is as long as this one's seeds
        klen, step = lanes[0] if lanes else (1 << 30, 1)
        probe = reads.select(*keep, "sequence", F.lit(klen).alias("klen"), F.lit(step).alias("step"),
                             F.lit(True).alias("lead"))
    else:
        lane = F.array(*[F.struct(F.lit(a).alias("klen"), F.lit(b).alias("step"), F.lit(i == 0).alias("lead"))
                         for i, (a, b) in enumerate(lanes)])
        probe = reads.select(*keep, "sequence", F.inline(lane))
    none = F.array().cast("array<int>")
    # sequence(1, 0) would count down, hence the guard inside the explode
    positions = F.when(length >= F.col("klen"), F.sequence(F.lit(1), length - F.col("klen") + 1, F.col("step")))
    seed = F.xxhash64(F.expr("substr(sequence, pos, klen)"))
    if extra:
        positions = F.concat(F.when(F.col("lead"), F.concat(*extra)).otherwise(none), F.coalesce(positions, none))
        seed = F.when(F.col("pos") < 1, F.col("pos").cast("long") + SENTINEL).otherwise(seed)
    return probe.select(*keep, "sequence", F.explode(positions).alias("pos"), "klen").withColumn("h", seed)


def _joined(reads: DataFrame, lanes, index: DataFrame | None, once: DataFrame | None, constants, keep) -> DataFrame:
    """Matches of a broadcast index, in one pass over the reads.  Position 0 of a
    read meets the rows that each read meets once; constants that it matches are
    positions below 0."""
    def matches(c):
        hit = F.lit(True) if c.text is None else F.instr("sequence", c.text) > 0
        return hit if c.pattern is None else hit & F.col("sequence").rlike(c.pattern)
    extra = []
    if once is not None:
        extra.append(F.array(F.lit(0)))
        found = [F.when(matches(c), F.lit(-1 - i)) for i, c in enumerate(constants)]
        if found:
            extra.append(F.filter(F.array(*found), lambda p: p.isNotNull()))
        index = once if index is None else index.unionByName(once)
    probe = _probe(reads, lanes, keep, extra)
    # candidates are compared with the whole text: a collision only costs a
    # comparison
    placed = (F.col("pos") - F.col("o") >= 1) & (F.expr("substr(sequence, pos - o, blen)") == F.col("text"))
    same = F.when(F.col("once"), F.col("pos") < 1).otherwise(placed)
    same = same & (F.col("pattern").isNull() | F.expr("sequence rlike pattern"))
    joined = probe.join(F.broadcast(index), F.col("h") == F.col("b_h")).filter(same)
    return joined.select(*keep, F.col("b_set").alias("barcode_set"), "ord")


def _shuffled(reads: DataFrame, lanes, s: int | None, index: DataFrame, longest: int, keep) -> list[DataFrame]:
    """Matches of an index beyond the broadcast bound."""
    out = [*keep, F.col("b_set").alias("barcode_set"), "ord"]
    probe = _probe(reads, lanes, keep)
    probe = probe.join(F.broadcast(_seed_table(index)), _table_word(F.col("h")) == F.col("word")).filter(
        F.expr("shiftright(bits, cast(h & 63 AS int)) & 1 = 1"))
    plain, tested = index.filter("pattern IS NULL").drop("pattern"), index.filter("pattern IS NOT NULL")
    back = (s or 1) - 1
    first = F.greatest(F.col("pos") - back, F.lit(1))
    window = probe.select(*keep, "h", (F.col("pos") - first).alias("at"),
                          F.substr("sequence", first, F.lit(back + longest)).alias("piece"))
    same = (F.col("at") >= F.col("o")) & (F.expr("substr(piece, at - o + 1, blen)") == F.col("text"))
    parts = [window.join(plain, F.col("h") == F.col("b_h")).filter(same).select(*out)]
    if not tested.isEmpty():  # a pattern needs its whole read
        whole = probe.select(*keep, "h", "sequence").join(broadcast_if_small(tested), F.col("h") == F.col("b_h"))
        parts.append(whole.filter("sequence rlike pattern").select(*out))
    return parts


def _least_rows(rows, by: tuple[str, ...]):
    """Of a record batch in order of ``_read``, the row with the smallest
    (non-null) ``ord`` for each read and each value of ``by``."""
    import numpy as np
    import pyarrow.compute as pc
    keys = [rows.column("_read").to_numpy()]
    for name in by:
        column = rows.column(name)
        codes = column if name == "ord" else pc.dictionary_encode(column).indices
        keys.append(pc.fill_null(codes, -1).to_numpy())
    least = pc.fill_null(rows.column("ord"), np.iinfo(np.int64).max).to_numpy()
    order = np.lexsort([least, *keys[::-1]])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[order[1:]] != key[order[:-1]]
    return rows.take(order[new])


def _by_read(batches, by: tuple[str, ...]):
    """``_least_rows`` of all reads of a partition, whose rows follow each other;
    the last read of a batch waits for the next one."""
    import numpy as np
    import pyarrow as pa
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        read = rows.column("_read").to_numpy()
        if (np.diff(read) < 0).any():
            raise RuntimeError("the rows of a read are not together: the seed join was not broadcast")
        last = int(np.searchsorted(read, read[-1]))
        if last:
            yield _least_rows(rows.slice(0, last), by)
        held = _least_rows(rows.slice(last), by)
    if held is not None:
        yield held


def within_reads(found: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """``found`` (numbered by ``_read``) with one row for each read and each value
    of ``by``, the one with the smallest ``ord``; a reduction inside the tasks,
    without a shuffle."""
    schema = found.drop("_read").schema
    names = schema.names

    def reduced(batches):
        for rows in _by_read(batches, by):
            yield rows.select(names)
    return found.mapInArrow(reduced, schema)


def _counted_within(found: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """sample, barcode_set, ord, n: ``within_reads``, counted per batch."""
    keys = ["sample", "barcode_set", "ord"]
    kinds = {f.name: f.dataType.simpleString() for f in found.schema.fields}

    def counted(batches):
        import pyarrow as pa
        for rows in _by_read(batches, by):
            table = pa.Table.from_batches([rows.select(keys)]).group_by(keys).aggregate([([], "count_all")])
            yield from table.select([*keys, "count_all"]).rename_columns([*keys, "n"]).combine_chunks().to_batches()
    return found.select("_read", *keys).mapInArrow(counted, ", ".join(f"{k} {kinds[k]}" for k in keys) + ", n long")


def _table_word(h: Column) -> Column:
    return F.shiftright(h.bitwiseAND(F.lit((1 << TABLE_BITS) - 1)), 6)


def _seed_table(index: DataFrame) -> DataFrame:
    """A bit for each library seed, 64 to a row: at most 2^20 rows (16 MB)
    whatever the library, so it can always be broadcast.  Read positions whose
    bit is not set have no barcode and are not shuffled."""
    return (index.groupBy(_table_word(F.col("b_h")).alias("word"))
            .agg(F.expr("bit_or(shiftleft(1L, cast(b_h & 63 AS int)))").alias("bits")))


def _cased(reads: DataFrame, ignore_case: bool) -> DataFrame:
    """The library is upper-case already; reads are upper-cased only here."""
    return reads.withColumn("sequence", F.upper("sequence")) if ignore_case else reads


def manifest_pairs(manifest: DataFrame) -> DataFrame:
    """Distinct (sample, barcode_set) of a manifest.  Rows without a sample or
    a barcode set (one-field lines) name nothing to match; they are reported
    by ``reconcile_samples``."""
    return manifest.select("sample", "barcode_set").dropna().distinct()


def _listed(found: DataFrame, manifest: DataFrame | None) -> DataFrame:
    """Of the found pairs, those that the manifest lists, and the reads' own
    rows of its samples.  The manifest is joined to the few rows that are
    found, not to the reads."""
    if manifest is None:
        return found
    pairs = manifest_pairs(manifest)
    own = pairs.select("sample", F.lit(None).cast("string").alias("barcode_set")).distinct()
    m = broadcast_if_small(pairs.unionByName(own).select(F.col("sample").alias("m_sample"),
                                                         F.col("barcode_set").alias("m_set")))
    return found.join(m, (F.col("sample") == F.col("m_sample"))
                      & F.col("barcode_set").eqNullSafe(F.col("m_set")), "left_semi")


def _first_by(every: bool) -> tuple[str, ...]:
    return ("barcode_set", "ord") if every else ("barcode_set",)


def _matched(reads, library, manifest, carry, seed_min, ignore_case, every):
    tables = lookup.lookup_of(library)
    if tables is not None:
        return _listed(lookup.matches(_cased(reads, ignore_case), tables, every, carry), manifest)
    found, together = _found(_cased(reads, ignore_case), library, carry, seed_min, False, every)
    if together:
        return _listed(within_reads(found, _first_by(every)), manifest)
    keys = ["sample", "read_key", "barcode_set"] + (["ord"] if every else [])
    aggs = ([] if every else [F.min("ord").alias("ord")]) + [F.any_value(c).alias(c) for c in carry]
    found = _listed(found, manifest)
    return found.groupBy(*keys).agg(*aggs) if aggs else found.select(*keys).distinct()


def assign_first_match(reads: DataFrame, library: DataFrame,
                       manifest: DataFrame | None = None,
                       carry: tuple[str, ...] = (), seed_min: int = SEED_MIN,
                       ignore_case: bool = False) -> DataFrame:
    """Each read goes to the first library barcode (smallest ``ord``) it
    contains; a read is counted at most once per barcode set ("without
    replacement").  Returns sample, read_key, barcode_set, ord, *carry.
    Reads are matched as written (lower-case bases never match, as in the
    reference) unless ``ignore_case``.

    With a broadcast index the first match is taken inside the task of the read;
    beyond, one small row per hit is shuffled by read."""
    out = _matched(reads, library, manifest, carry, seed_min, ignore_case, every=False)
    return out.select("sample", "read_key", "barcode_set", "ord", *carry)


def match_all(reads: DataFrame, library: DataFrame,
              manifest: DataFrame | None = None,
              carry: tuple[str, ...] = (), seed_min: int = SEED_MIN,
              ignore_case: bool = False) -> DataFrame:
    """Every (read, barcode) pair with the barcode contained in the read
    ("with replacement"); a pair is listed once however often it occurs."""
    out = _matched(reads, library, manifest, carry, seed_min, ignore_case, every=True)
    return out.select("sample", "read_key", "barcode_set", "ord", *carry)


def match_numbers(reads: DataFrame, library: DataFrame, carry: tuple[str, ...] = (),
                  seed_min: int = SEED_MIN, ignore_case: bool = False) -> DataFrame:
    """sample, read_key, n, *carry: the pairs of ``match_all`` as their number for
    each read that has some (still to be added up where the index is not looked
    up: a row, n = 1, for each pair)."""
    tables = lookup.lookup_of(library)
    if tables is not None:
        out = lookup.numbers_by_read(_cased(reads, ignore_case), tables, carry)
    else:
        out = match_all(reads, library, carry=carry, seed_min=seed_min, ignore_case=ignore_case).withColumn("n", F.lit(1))
    return out.select("sample", "read_key", F.col("n").cast("long").alias("n"), *carry)


def matched_reads(reads: DataFrame, library: DataFrame, manifest: DataFrame | None = None,
                  every: bool = False, carry: tuple[str, ...] = (), seed_min: int = SEED_MIN,
                  ignore_case: bool = False) -> DataFrame:
    """sample, barcode_set, read_key, ord, n, *carry: a row (n = 1) for each
    assigned read (``every``: each pair of a read and a barcode), and for each
    read one with NULL barcode_set, read_key and ord (n = 1; where the barcodes are
    looked up or the index is not broadcast, some for each sample, with their
    number).  One pass over the reads: their number comes from the pass that
    matches them."""
    tables = lookup.lookup_of(library)
    if tables is not None:
        return _listed(lookup.matches_and_totals(_cased(reads, ignore_case), tables, every, carry), manifest)
    found, together = _found(_cased(reads, ignore_case), library, carry, seed_min, True, every)
    if not together:
        return _shuffled_by_read(_listed(found, manifest), every, carry)
    hit = F.col("ord").isNotNull()
    found = _listed(within_reads(found, _first_by(every)), manifest)
    return found.select("sample", "barcode_set", F.when(hit, F.col("read_key")).alias("read_key"), "ord",
                        F.lit(1).cast("long").alias("n"), *(F.when(hit, F.col(c)).alias(c) for c in carry))


def first_and_all(reads: DataFrame, library: DataFrame, seed_min: int = SEED_MIN,
                  ignore_case: bool = False) -> DataFrame:
    """Both the first match of each read and all of them, from one pass: rows of
    ``matched_reads`` (every) with a column ``first``.  It is true in rows that tell
    a read's first match only, false in numbers of all matches, and NULL in rows
    that are one of all matches, the first of which is the smallest of its read."""
    tables = lookup.lookup_of(library)
    if tables is not None:
        return lookup.matches_and_totals(_cased(reads, ignore_case), tables, every=False, number_all=True)
    return matched_reads(reads, library, every=True, seed_min=seed_min, ignore_case=ignore_case).withColumn(
        "first", F.lit(None).cast("boolean"))


def _shuffled_by_read(found: DataFrame, every: bool, carry) -> DataFrame:
    """``matched_reads`` of rows that are not together: one aggregate by read,
    with a partial step that counts the reads' own rows per task."""
    hit = F.col("ord").isNotNull()
    keys = ["sample", "barcode_set", F.when(hit, F.col("read_key")).alias("read_key")] + (["ord"] if every else [])
    aggs = [F.count(F.lit(1)).alias("_n"), *([] if every else [F.min("ord").alias("ord")])]
    aggs += [F.any_value(c).alias(c) for c in carry]
    n = F.when(hit, 1).otherwise(F.col("_n")).alias("n")
    return found.groupBy(*keys).agg(*aggs).select(
        "sample", "barcode_set", "read_key", "ord", n, *(F.when(hit, F.col(c)).alias(c) for c in carry))


def match_counts(reads: DataFrame, library: DataFrame, manifest: DataFrame | None = None,
                 every: bool = False, seed_min: int = SEED_MIN, ignore_case: bool = False) -> DataFrame:
    """sample, barcode_set, ord, n: numbers of ``matched_reads`` that are still to
    be added up.  With a broadcast index the tasks count what they have matched,
    and nothing else leaves them; the manifest is joined to the counts."""
    tables = lookup.lookup_of(library)
    if tables is not None:
        return _listed(lookup.numbers_of(_cased(reads, ignore_case), tables, every), manifest)
    found, together = _found(_cased(reads, ignore_case), library, (), seed_min, True, every)
    if together:
        return _listed(_counted_within(found, _first_by(every)), manifest)
    return _shuffled_by_read(_listed(found, manifest), every, ()).select("sample", "barcode_set", "ord", "n")


def read_outcomes(reads: DataFrame, library: DataFrame, seed_min: int = SEED_MIN,
                  ignore_case: bool = False) -> DataFrame:
    """One row per read: sample, read_key, detected (by any barcode).  A single
    pass over the reads, at the cost of one more row for each."""
    tables = lookup.lookup_of(library)
    if tables is not None:
        return lookup.detected(_cased(reads, ignore_case), tables)
    found, together = _found(_cased(reads, ignore_case), library, (), seed_min, True, every=False)
    detected = F.col("ord").isNotNull()
    if together:
        return within_reads(found, ()).select("sample", "read_key", detected.alias("detected"))
    return found.groupBy("sample", "read_key").agg(F.bool_or(detected).alias("detected"))
