"""Registered queries over the driver tables.

Each query is a function ``(spark, sf_dir) -> DataFrame`` plus, where SQL can
express it, an independent DuckDB oracle.  Oracles use naive ``contains``
joins, never the seed join, so they check the Spark plans rather than repeat
them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqtally.operators import counts as C
from seqtally.operators.library import prepare_library
from seqtally.operators.match import assign_first_match
from seqtally.plans import derive as D
from seqtally.plans.counting import barcode_counts, barcode_stats, counts_columns, counts_of, tally

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def _library(spark, sf_dir):
    return prepare_library(D.library_raw(spark, sf_dir))


# Common CTEs of the oracles.
BASE = dict(reads=D.READS_SQL, lib_raw=D.LIBRARY_RAW_SQL, lib=D.LIBRARY_SQL)
HITS_SQL = """
SELECT r.sample, r.read_key, any_value(r.read_id) AS read_id, min(b.ord) AS ord
FROM reads r JOIN lib b ON contains(r.sequence, b.barcode)
GROUP BY r.sample, r.read_key"""
FILLED_SQL = """
SELECT s.sample, b.ord, b.gene, b.barcode,
       CAST(coalesce(c.n, 0) AS BIGINT) AS read_counts
FROM (SELECT DISTINCT sample FROM reads) s
JOIN lib b ON TRUE
LEFT JOIN (SELECT sample, ord, count(*) AS n FROM hits GROUP BY sample, ord) c
  ON c.sample = s.sample AND c.ord = b.ord"""
RPM_SQL = """
SELECT f.sample, f.ord, f.gene, f.barcode, f.read_counts,
       CASE WHEN t.tot > 0 THEN f.read_counts * 1.0e0 / t.tot * 1000000.0e0
            ELSE 0.0e0 END AS rpm
FROM filled f JOIN (SELECT sample, CAST(sum(read_counts) AS BIGINT) AS tot
                    FROM filled GROUP BY sample) t ON t.sample = f.sample"""


# --- flagship: first-match counts with RPM (JN1, AGG1, JN5, AGG4, WIN1) -------

@query("first_match_rpm", D.cte(**BASE, hits=HITS_SQL, filled=FILLED_SQL, counted=RPM_SQL)
       + "SELECT sample, gene, barcode, read_counts, rpm FROM counted")
def first_match_rpm(spark, sf_dir):
    reads = D.reads(spark, sf_dir)
    lib = _library(spark, sf_dir)
    return counts_columns(barcode_counts(reads, lib, barcode_set=D.LIBRARY_SET))


def _first_match(spark, sf_dir, carry=("read_id",)):
    reads = D.reads(spark, sf_dir)
    lib = _library(spark, sf_dir)
    return reads, lib, assign_first_match(reads, lib, carry=carry)


def _counts(spark, sf_dir):
    """Zero-filled first-match counts with RPM (keeps ord and barcode_set)."""
    reads = D.reads(spark, sf_dir)
    return barcode_counts(reads, _library(spark, sf_dir), barcode_set=D.LIBRARY_SET)


# --- statistics, detection flags (AGG5, AGG6) -----------------------------------

@query("first_match_stats", D.cte(**BASE, hits=HITS_SQL) + f"""
SELECT t.sample, '{D.LIBRARY_SET}' AS barcode_set, t.total_reads,
       CAST(coalesce(d.n, 0) AS BIGINT) AS detected_reads,
       CASE WHEN t.total_reads > 0 THEN coalesce(d.n, 0) * 1.0e0 / t.total_reads END AS detection_rate
FROM (SELECT sample, count(*) AS total_reads FROM reads GROUP BY sample) t
LEFT JOIN (SELECT sample, count(*) AS n FROM hits GROUP BY sample) d ON d.sample = t.sample""")
def first_match_stats(spark, sf_dir):
    return barcode_stats(D.reads(spark, sf_dir), _library(spark, sf_dir), barcode_set=D.LIBRARY_SET)


@query("flag_detected", D.cte(**BASE, hits=HITS_SQL) + """
SELECT r.sample, r.read_key, h.read_key IS NOT NULL AS detected
FROM reads r LEFT JOIN hits h ON h.sample = r.sample AND h.read_key = r.read_key""")
def flag_detected_q(spark, sf_dir):
    from seqtally.operators.match import read_outcomes
    return read_outcomes(D.reads(spark, sf_dir), _library(spark, sf_dir)).select(
        "sample", "read_key", "detected")


# --- per-chunk ID lists and what the reference derives from them (AGG2, 3, 15, 16)

CHUNK = 10_000  # the reference's advice for small files
CHUNK_SQL = f"""
SELECT sample, CAST(read_key // {CHUNK} AS BIGINT) AS chunk, ord,
       count(*) AS n, list_sort(list(read_id)) AS ids
FROM hits GROUP BY sample, CAST(read_key // {CHUNK} AS BIGINT), ord"""


@query("first_match_ids", D.cte(**BASE, hits=HITS_SQL, ch=CHUNK_SQL) + """
SELECT c.sample, c.chunk, b.gene, b.barcode, CAST(c.n AS BIGINT) AS read_counts, c.ids
FROM ch c JOIN lib b ON b.ord = c.ord""")
def first_match_ids(spark, sf_dir):
    _, lib, hits = _first_match(spark, sf_dir)
    return C.chunk_counts(hits, lib, CHUNK).select("sample", "chunk", "gene", "barcode",
                                            "read_counts", "ids")


@query("merge_counts", D.cte(**BASE, hits=HITS_SQL, ch=CHUNK_SQL) + """
SELECT c.sample, b.gene, b.barcode, CAST(sum(c.n) AS BIGINT) AS read_counts,
       CAST(count(*) AS BIGINT) AS n_chunks
FROM ch c JOIN lib b ON b.ord = c.ord GROUP BY c.sample, b.gene, b.barcode""")
def merge_counts_q(spark, sf_dir):
    _, lib, hits = _first_match(spark, sf_dir)
    return C.merge_counts(C.chunk_counts(hits, lib, CHUNK))


@query("ids_by_barcode", D.cte(**BASE, hits=HITS_SQL) + """
SELECT h.sample, h.read_id, b.gene, b.barcode FROM hits h JOIN lib b ON b.ord = h.ord""")
def ids_by_barcode_q(spark, sf_dir):
    _, lib, hits = _first_match(spark, sf_dir)
    return C.ids_by_barcode(hits, lib)


@query("fractional_counts", D.cte(**BASE, hits=HITS_SQL, ch=CHUNK_SQL) + """
SELECT c.sample, b.gene, b.barcode, u.read_id, c.n * 1.0e0 / len(c.ids) AS share
FROM ch c JOIN lib b ON b.ord = c.ord, unnest(c.ids) AS u(read_id)""")
def fractional_counts_q(spark, sf_dir):
    _, lib, hits = _first_match(spark, sf_dir)
    return C.fractional_counts(hits, lib)


# --- with replacement (JN2, AGG14) ---------------------------------------------

HITS_ALL_SQL = """
SELECT DISTINCT r.sample, r.read_key, r.read_id, b.ord
FROM reads r JOIN lib b ON contains(r.sequence, b.barcode)"""


@query("match_all_counts", D.cte(**BASE, hits=HITS_ALL_SQL) + """
SELECT s.sample, b.gene, b.barcode, CAST(coalesce(c.n, 0) AS BIGINT) AS read_counts
FROM (SELECT DISTINCT sample FROM reads) s JOIN lib b ON TRUE
LEFT JOIN (SELECT sample, ord, count(*) AS n FROM hits GROUP BY sample, ord) c
  ON c.sample = s.sample AND c.ord = b.ord""")
def match_all_counts(spark, sf_dir):
    lib = _library(spark, sf_dir)
    counted = tally(D.reads(spark, sf_dir), lib, every=True)
    return counts_of(counted, lib, barcode_set=D.LIBRARY_SET).select("sample", "gene", "barcode", "read_counts")


@query("barcodes_per_read", D.cte(**BASE, hits=HITS_ALL_SQL) + """
SELECT sample, read_id, CAST(count(*) AS BIGINT) AS n_barcodes FROM hits GROUP BY sample, read_id""")
def barcodes_per_read(spark, sf_dir):
    from seqtally.operators.match import match_numbers
    reads = D.reads(spark, sf_dir)
    hits = match_numbers(reads, _library(spark, sf_dir), carry=("read_id",))
    return C.count_barcodes_per_read(hits)


# --- library (AGG9, AGG10, PRJ1) -------------------------------------------------

@query("dedup_barcodes", D.cte(lib_raw=D.LIBRARY_RAW_SQL, lib=D.LIBRARY_SQL)
       + "SELECT barcode_set, ord, gene, barcode FROM lib")
def dedup_barcodes_q(spark, sf_dir):
    return _library(spark, sf_dir)


@query("barcode_uniqueness", D.cte(lib_raw=D.LIBRARY_RAW_SQL) + """
SELECT CAST(count(barcode) AS BIGINT) AS n_values,
       CAST(count(DISTINCT barcode) AS BIGINT) AS n_distinct,
       count(barcode) = count(DISTINCT barcode) AS is_unique
FROM (SELECT upper(barcode) AS barcode FROM lib_raw)""")
def barcode_uniqueness(spark, sf_dir):
    from seqtally.operators.library import is_unique, normalize_barcodes
    return is_unique(normalize_barcodes(D.library_raw(spark, sf_dir)), "barcode")


# --- sorts, limits, zero rows (SRT1, LIM1, JN5) ----------------------------------

COUNTED = dict(**BASE, hits=HITS_SQL, filled=FILLED_SQL, counted=RPM_SQL)


@query("top_barcodes", D.cte(**COUNTED) + """
SELECT sample, gene, barcode, read_counts FROM counted
ORDER BY read_counts DESC, sample, gene, barcode LIMIT 10""")
def top_barcodes_q(spark, sf_dir):
    return C.top_barcodes(_counts(spark, sf_dir), 10).select(
        "sample", "gene", "barcode", "read_counts")


@query("head_barcodes", D.cte(**COUNTED) + """
SELECT sample, ord, gene, barcode, read_counts FROM counted ORDER BY sample, ord LIMIT 20""")
def head_barcodes(spark, sf_dir):
    return C.head(_counts(spark, sf_dir), 20, ["sample", "ord"]).select(
        "sample", "ord", "gene", "barcode", "read_counts")


@query("zero_fill", D.cte(**BASE, hits=HITS_SQL, filled=FILLED_SQL) + """
SELECT sample, gene, barcode, read_counts FROM filled WHERE read_counts = 0""")
def zero_fill_q(spark, sf_dir):
    return (_counts(spark, sf_dir).filter(F.col("read_counts") == 0)
            .select("sample", "gene", "barcode", "read_counts"))


@query("union_counts", D.cte(**BASE, hits=HITS_SQL, filled=FILLED_SQL, hits_all=HITS_ALL_SQL) + """
SELECT 'first' AS mode, sample, gene, barcode, read_counts FROM filled
UNION ALL
SELECT 'all' AS mode, h.sample, b.gene, b.barcode, CAST(count(*) AS BIGINT)
FROM hits_all h JOIN lib b ON b.ord = h.ord GROUP BY h.sample, b.gene, b.barcode""")
def union_counts(spark, sf_dir):
    """Both count tables from one matching pass: the first match of a read is
    the smallest of all its matches."""
    from seqtally.operators._util import staged
    from seqtally.operators.match import first_and_all
    from seqtally.operators.records import union_counts as stack
    lib = _library(spark, sf_dir)
    found = staged(first_and_all(D.reads(spark, sf_dir), lib), "matched")
    hits = found.filter("ord IS NOT NULL")
    first = hits.filter("coalesce(first, true)").groupBy("sample", "read_key", "barcode_set").agg(F.min("ord").alias("ord"))
    pairs = C.run_pairs(found, lib, barcode_set=D.LIBRARY_SET)
    filled = (C.zero_fill(C.count_hits(first), lib, pairs)
              .select(F.lit("first").alias("mode"), "sample", "gene", "barcode", "read_counts"))
    every = (C.with_genes(C.count_matched(hits.filter("NOT coalesce(first, false)")), lib)
             .select(F.lit("all").alias("mode"), "sample", "gene", "barcode", "read_counts"))
    return stack(filled, every)


# --- manifest-driven counting: each sample against its own barcode sets (JN7) --

# Fixed run configuration (as a user's project file lists it): sample -> set.
RUN_MANIFEST = [("F", "ECONOMY"), ("F", "PROMO"), ("O", "STANDARD"),
                ("P", "LARGE"), ("P", "SMALL"), ("P", "MEDIUM")]
RUN_MANIFEST_SQL = "SELECT * FROM (VALUES " + ", ".join(
    f"('{s}', '{b}')" for s, b in RUN_MANIFEST) + ") AS m(sample, barcode_set)"
LIB_TYPED_SQL = D.LIBRARY_SQL


@query("manifest_match", D.cte(reads=D.READS_SQL, lib_raw=D.LIBRARY_TYPED_RAW_SQL,
                               lib=LIB_TYPED_SQL, man=RUN_MANIFEST_SQL, hits="""
SELECT r.sample, r.read_key, m.barcode_set, min(b.ord) AS ord
FROM reads r JOIN man m ON m.sample = r.sample
JOIN lib b ON b.barcode_set = m.barcode_set AND contains(r.sequence, b.barcode)
GROUP BY r.sample, r.read_key, m.barcode_set""", filled="""
SELECT m.sample, m.barcode_set, b.ord, b.gene, b.barcode,
       CAST(coalesce(c.n, 0) AS BIGINT) AS read_counts
FROM man m JOIN lib b ON b.barcode_set = m.barcode_set
LEFT JOIN (SELECT sample, barcode_set, ord, count(*) AS n FROM hits GROUP BY ALL) c
  ON c.sample = m.sample AND c.barcode_set = m.barcode_set AND c.ord = b.ord""") + """
SELECT f.sample, f.barcode_set, f.gene, f.barcode, f.read_counts,
       CASE WHEN t.tot > 0 THEN f.read_counts * 1.0e0 / t.tot * 1000000.0e0 ELSE 0.0e0 END AS rpm
FROM filled f JOIN (SELECT sample, barcode_set, CAST(sum(read_counts) AS BIGINT) AS tot
                    FROM filled GROUP BY ALL) t
  ON t.sample = f.sample AND t.barcode_set = f.barcode_set""")
def manifest_match(spark, sf_dir):
    from seqtally.schemas import MANIFEST
    reads = D.reads(spark, sf_dir)
    lib = prepare_library(D.library_typed_raw(spark, sf_dir))
    man = spark.createDataFrame(RUN_MANIFEST, MANIFEST)
    return barcode_counts(reads, lib, man).select(
        "sample", "barcode_set", "gene", "barcode", "read_counts", "rpm")


# A sample without reads, a set that the library lacks, and a set of 4-nt
# barcodes beside those of 8 to 10 nt.
STATS_MANIFEST = [*RUN_MANIFEST, ("F", "NATIONS"), ("O", "NATIONS"), ("F", "NOPE"), ("Z", "LARGE"), ("Z", "NOPE")]


@query("manifest_stats", D.cte(reads=D.READS_SQL, lib_raw=D.LIBRARY_MIXED_RAW_SQL, lib=LIB_TYPED_SQL,
                               man="SELECT * FROM (VALUES " + ", ".join(
                                   f"('{s}', '{b}')" for s, b in STATS_MANIFEST) + ") AS m(sample, barcode_set)",
                               hits="""
SELECT DISTINCT r.sample, r.read_key, m.barcode_set FROM reads r JOIN man m ON m.sample = r.sample
JOIN lib b ON b.barcode_set = m.barcode_set AND contains(r.sequence, b.barcode)""") + """
SELECT m.sample, m.barcode_set, CAST(coalesce(t.n, 0) AS BIGINT) AS total_reads,
       CAST(coalesce(h.n, 0) AS BIGINT) AS detected_reads,
       CASE WHEN t.n > 0 THEN coalesce(h.n, 0) * 1.0e0 / t.n END AS detection_rate
FROM man m LEFT JOIN (SELECT sample, count(*) AS n FROM reads GROUP BY sample) t ON t.sample = m.sample
LEFT JOIN (SELECT sample, barcode_set, count(*) AS n FROM hits GROUP BY ALL) h
  ON h.sample = m.sample AND h.barcode_set = m.barcode_set""")
def manifest_stats(spark, sf_dir):
    from seqtally.schemas import MANIFEST
    lib = prepare_library(D.library_mixed_raw(spark, sf_dir))
    return barcode_stats(D.reads(spark, sf_dir), lib, spark.createDataFrame(STATS_MANIFEST, MANIFEST))


# --- other barcode shapes (FIL1, JN1): patterns, stepped seeds, mixed lengths ---

def _shape(name, raw_sql, match="contains(r.sequence, b.barcode)"):
    return D.cte(reads=D.READS_SQL, lib_raw=raw_sql, lib=D.LIBRARY_SQL, hits=f"""
SELECT r.sample, r.read_key, min(b.ord) AS ord FROM reads r JOIN lib b ON {match}
GROUP BY r.sample, r.read_key""") + """
SELECT h.sample, b.gene, b.barcode, count(*) AS read_counts
FROM hits h JOIN lib b ON b.ord = h.ord GROUP BY h.sample, b.gene, b.barcode"""


def _shape_counts(spark, sf_dir, raw):
    lib = prepare_library(raw(spark, sf_dir))
    hits = assign_first_match(D.reads(spark, sf_dir), lib)
    return C.with_genes(C.count_hits(hits), lib).select("sample", "gene", "barcode", "read_counts")


# Choices are first looked up as texts: a pair of plain searches is much cheaper
# for the oracle than a regular expression that changes with every row.
@query("regex_match", _shape("regex", D.LIBRARY_REGEX_RAW_SQL, """CASE
  WHEN b.one IS NOT NULL AND NOT contains(r.sequence, b.one) AND NOT contains(r.sequence, b.two) THEN false
  ELSE regexp_matches(r.sequence, b.barcode) END""").replace("JOIN lib b ON CASE", """JOIN (
  SELECT *, CASE WHEN starts_with(barcode, '(') THEN split_part(substr(barcode, 2), '|', 1) END AS one,
    split_part(split_part(barcode, '|', 2), ')', 1) AS two FROM lib) b ON CASE"""))
def regex_match(spark, sf_dir):
    """Barcodes with classes, wildcards, repeats and choices (two thousand
    at sf0.01), and plain ones, in one pass over the reads."""
    return _shape_counts(spark, sf_dir, D.library_regex_raw)


@query("stepped_seed_match", _shape("stepped", D.LIBRARY_LONG_RAW_SQL))
def stepped_seed_match(spark, sf_dir):
    """Barcodes of 20 nt and more: only every s-th position is probed."""
    return _shape_counts(spark, sf_dir, D.library_long_raw)


@query("mixed_length_match", _shape("mixed", D.LIBRARY_LENGTHS_RAW_SQL))
def mixed_length_match(spark, sf_dir):
    """Barcodes of 5 to 7 nt and of 20 nt and more in one library."""
    return _shape_counts(spark, sf_dir, D.library_lengths_raw)


# --- length windows and routing (JN3, FIL3, JN9) --------------------------------

def _windows_sql():
    from seqtally.operators.reshape import FRAGMENT_LENGTHS, LENGTH_TOLERANCE
    rows = ", ".join(f"('{f}', {t}, {LENGTH_TOLERANCE})" for f, t in FRAGMENT_LENGTHS)
    return f"SELECT * FROM (VALUES {rows}) AS w(fragment, target_len, tolerance)"


SPLIT_SQL = """
SELECT r.sample AS source, r.read_key, length(r.sequence) AS length, w.fragment
FROM len_reads r JOIN windows w
  ON length(r.sequence) BETWEEN w.target_len - w.tolerance AND w.target_len + w.tolerance"""


def _split(spark, sf_dir):
    from seqtally.operators.reshape import length_windows, split_by_length
    reads = D.length_reads(spark, sf_dir)
    return (split_by_length(reads, length_windows(spark))
            .select(F.col("sample").alias("source"), "read_key",
                    F.length("sequence").cast("long").alias("length"), "fragment"))


@query("split_by_length", D.cte(len_reads=D.LENGTH_READS_SQL, windows=_windows_sql())
       + "SELECT read_key, length, fragment FROM (" + SPLIT_SQL + ")")
def split_by_length_q(spark, sf_dir):
    return _split(spark, sf_dir).select("read_key", "length", "fragment")


# Fixed routing configuration: (source, fragment) -> sample; 'error' events
# are not routed.
ROUTING = [(src, frag, f"{src}_{frag.lower()}")
           for src in ("click", "view", "purchase", "signup") for frag in ("F1", "F2", "F3")]


@query("relabel_samples", D.cte(len_reads=D.LENGTH_READS_SQL, windows=_windows_sql(),
                                split=SPLIT_SQL,
                                routing="SELECT * FROM (VALUES " + ", ".join(
                                    f"('{a}', '{b}', '{c}')" for a, b, c in ROUTING)
                                + ") AS t(source, fragment, sample)") + """
SELECT s.read_key, s.fragment, t.sample FROM split s
JOIN routing t ON t.source = s.source AND t.fragment = s.fragment""")
def relabel_samples_q(spark, sf_dir):
    from seqtally.operators.reshape import relabel_samples
    routing = spark.createDataFrame(ROUTING, "source string, fragment string, sample string")
    return relabel_samples(_split(spark, sf_dir), routing).select("read_key", "fragment", "sample")


# --- flank extraction (FN2, AGG7, AGG8, FIL6, WIN2) ----------------------------

FLANK_SQL = dict(flanked=D.FLANKED_READS_SQL, ext=f"""
SELECT read_key, nullif(regexp_extract(sequence,
         '(?i)(' || '{D.UPSTREAM_FLANK}' || ')(.{{30}})(' || '{D.DOWNSTREAM_FLANK}' || ')', 2), '')
       AS barcode
FROM flanked""")


def _flank(spark, sf_dir):
    from seqtally.operators.flank import extract_barcodes
    return extract_barcodes(D.flanked_reads(spark, sf_dir))


@query("flank_extract", D.cte(**FLANK_SQL) + "SELECT read_key, barcode FROM ext")
def flank_extract(spark, sf_dir):
    return _flank(spark, sf_dir).select("read_key", "barcode")


@query("flank_stats", D.cte(**FLANK_SQL) + """
SELECT count(*) AS total_reads, count(barcode) AS detected_reads,
       CASE WHEN count(*) > 0 THEN count(barcode) * 1.0e0 / count(*) END AS detection_rate
FROM ext""")
def flank_stats_q(spark, sf_dir):
    from seqtally.operators.flank import flank_stats
    return flank_stats(_flank(spark, sf_dir))


@query("flank_distinct", D.cte(**FLANK_SQL) + """
SELECT CAST(row_number() OVER (ORDER BY barcode) - 1 AS BIGINT) AS idx, barcode
FROM (SELECT DISTINCT barcode FROM ext WHERE barcode IS NOT NULL)""")
def flank_distinct(spark, sf_dir):
    from seqtally.operators.flank import distinct_barcodes
    from seqtally.operators.index import with_index
    return with_index(distinct_barcodes(_flank(spark, sf_dir)), ["barcode"]).select("idx", "barcode")


# --- FASTQ record functions (FN1, FN9, FN10, SRC4, FIL2, FIL7) -----------------

FQ = dict(len_reads=D.LENGTH_READS_SQL, fq=D.FASTQ_RECORDS_SQL)
LINES_SQL = """
SELECT read_key, CAST(0 AS BIGINT) AS line_no, header AS value FROM fq
UNION ALL SELECT read_key, 1, sequence FROM fq
UNION ALL SELECT read_key, 2, spacer FROM fq
UNION ALL SELECT read_key, 3, quality FROM fq"""


def _lines(spark, sf_dir):
    fq = D.fastq_records(spark, sf_dir)
    return fq.select("read_key", F.posexplode(F.array("header", "sequence", "spacer", "quality"))
                     .alias("line_no", "value")).withColumn("line_no", F.col("line_no").cast("long"))


@query("sequence_line_filter", D.cte(**FQ, lines=LINES_SQL) + """
SELECT read_key, line_no, value FROM lines WHERE regexp_matches(value, '^[ATGCatgcN]')""")
def sequence_line_filter(spark, sf_dir):
    from seqtally.functions.sequence import is_sequence_line
    return _lines(spark, sf_dir).filter(is_sequence_line("value"))


GREP_PATTERN = "GATTACA"


@query("grep_lines", D.cte(**FQ, lines=LINES_SQL) + f"""
SELECT read_key, line_no, value FROM lines WHERE regexp_matches(value, '{GREP_PATTERN}')""")
def grep_lines(spark, sf_dir):
    from seqtally.operators.records import grep
    return grep(_lines(spark, sf_dir), GREP_PATTERN)


@query("reverse_complement", D.cte(**FQ) + f"""
SELECT read_key, reverse(translate(sequence, '{D.IUPAC_FROM}', '{D.IUPAC_TO}')) AS sequence,
       quality
FROM fq""")
def reverse_complement_q(spark, sf_dir):
    from seqtally.operators.reshape import reverse_complement_reads
    return reverse_complement_reads(D.fastq_records(spark, sf_dir)).select(
        "read_key", "sequence", "quality")


@query("read_id_parse", D.cte(**FQ) + r"""
SELECT read_key, regexp_extract(header, '^@(\S*)', 1) AS read_id,
       regexp_extract(header, '^@\S*\s+(.*)$', 1) AS description
FROM fq""")
def read_id_parse(spark, sf_dir):
    from seqtally.functions.sequence import description_from_header, read_id_from_header
    fq = D.fastq_records(spark, sf_dir)
    return fq.select("read_key", read_id_from_header("header").alias("read_id"),
                     description_from_header("header").alias("description"))


@query("fastq_validate", D.cte(**FQ) + """
SELECT read_key, coalesce(starts_with(header, '@') AND starts_with(spacer, '+')
                          AND length(sequence) = length(quality) AND length(sequence) > 0
                          AND regexp_matches(quality, '^[!-_]*$'), false) AS is_valid
FROM fq""")
def fastq_validate(spark, sf_dir):
    from seqtally.operators.records import validate_fastq
    return validate_fastq(D.fastq_records(spark, sf_dir), mode="FLAG").select("read_key", "is_valid")


@query("fastq_drop_invalid", D.cte(**FQ) + """
SELECT read_key, header FROM fq
WHERE coalesce(starts_with(header, '@') AND starts_with(spacer, '+')
               AND length(sequence) = length(quality) AND length(sequence) > 0
               AND regexp_matches(quality, '^[!-_]*$'), false)""")
def fastq_drop_invalid(spark, sf_dir):
    from seqtally.operators.records import validate_fastq
    return validate_fastq(D.fastq_records(spark, sf_dir), mode="DROP").select("read_key", "header")


@query("fastq_format", D.cte(**FQ) + """
SELECT read_key, concat_ws(chr(10), header, sequence, spacer, quality) AS record FROM fq""")
def fastq_format(spark, sf_dir):
    from seqtally.functions.sequence import format_fastq_record
    fq = D.fastq_records(spark, sf_dir)
    return fq.select("read_key", format_fastq_record("header", "sequence", "spacer", "quality")
                     .alias("record"))


# --- lines per barcode (AGG13) ---------------------------------------------------

@query("line_counts", D.cte(**BASE) + """
SELECT b.gene, b.barcode, CAST(count(r.read_key) AS BIGINT) AS n_lines
FROM lib b LEFT JOIN reads r ON contains(r.sequence, b.barcode)
GROUP BY b.ord, b.gene, b.barcode""")
def line_counts(spark, sf_dir):
    lines = D.reads(spark, sf_dir).select(F.col("read_key").alias("line_key"),
                                          F.col("sequence").alias("value"))
    return C.count_lines_matching(lines, _library(spark, sf_dir))


# --- comparison of two count tables (JN4, FIL4, AGG11, AGG12, PRJ4) ------------

COMPARE_SQL = dict(**BASE, hits=HITS_SQL, filled=FILLED_SQL, src="""
SELECT barcode AS key, CAST(read_counts AS DOUBLE) AS value FROM filled WHERE sample = 'F'""",
                   dst="""
SELECT b.barcode AS key, CAST(count(*) AS DOUBLE) AS value
FROM hits h JOIN lib b ON b.ord = h.ord WHERE h.sample <> 'F' GROUP BY b.barcode""",
                   joined="""
SELECT s.key, s.value AS focused, d.value AS whole FROM src s LEFT JOIN dst d ON d.key = s.key""")
CUT_SQL = """
SELECT key, focused, whole FROM joined
WHERE whole <= (SELECT avg(whole) + 1.96e0 * stddev_samp(whole) FROM joined)"""


def _sides(spark, sf_dir):
    """Counts of sample F (zero-filled) and of the reads of all other samples,
    from one matching pass."""
    lib = _library(spark, sf_dir)
    counted = tally(D.reads(spark, sf_dir), lib)
    src = counts_of(counted, lib, barcode_set=D.LIBRARY_SET).filter("sample = 'F'")
    other = (counted.filter("ord IS NOT NULL AND sample <> 'F'").groupBy("barcode_set", "ord")
             .agg(F.sum("read_counts").alias("read_counts")))
    return src, C.with_genes(other, lib)


def _joined(spark, sf_dir):
    from seqtally.operators.compare import compare_counts
    value = F.col("read_counts").cast("double").alias("value")
    src, dst = (side.select(F.col("barcode").alias("key"), value) for side in _sides(spark, sf_dir))
    return compare_counts(src, dst)


@query("compare_repeated_keys", D.cte(**COMPARE_SQL) + """
SELECT substr(s.key, 1, 5) AS key, s.value AS focused, d.value AS whole
FROM src s LEFT JOIN dst d ON substr(d.key, 1, 5) = substr(s.key, 1, 5)""")
def compare_repeated_keys(spark, sf_dir):
    """Keys that repeat on both sides (barcode prefixes): all their pairs."""
    from seqtally.operators.compare import compare_counts
    value = F.col("read_counts").cast("double").alias("value")
    src, dst = (side.select(F.substring("barcode", 1, 5).alias("key"), value) for side in _sides(spark, sf_dir))
    return compare_counts(src, dst)


@query("compare_left", D.cte(**COMPARE_SQL) + "SELECT key, focused, whole FROM joined")
def compare_left(spark, sf_dir):
    return _joined(spark, sf_dir)


@query("compare_outliers", D.cte(**COMPARE_SQL, cut=CUT_SQL) + "SELECT * FROM cut")
def compare_outliers(spark, sf_dir):
    from seqtally.operators.compare import drop_upper_outliers
    return drop_upper_outliers(_joined(spark, sf_dir), "whole")


def _z(c):
    return (f"round(CASE WHEN (SELECT stddev_samp({c}) FROM cut) = 0 THEN NULL ELSE "
            f"({c} - (SELECT avg({c}) FROM cut)) / (SELECT stddev_samp({c}) FROM cut) END, 6) AS {c}")


@query("compare_zscore", D.cte(**COMPARE_SQL, cut=CUT_SQL)
       + f"SELECT key, {_z('focused')}, {_z('whole')} FROM cut")
def compare_zscore(spark, sf_dir):
    from seqtally.operators.compare import drop_upper_outliers, zscore
    z = zscore(drop_upper_outliers(_joined(spark, sf_dir), "whole"), ["focused", "whole"])
    return z.select("key", F.round("focused", 6).alias("focused"),
                    F.round("whole", 6).alias("whole"))


@query("column_stats", D.cte(**COMPARE_SQL) + """
SELECT round(avg(focused), 6) AS mean_focused, round(stddev_samp(focused), 6) AS std_focused,
       round(avg(whole), 6) AS mean_whole, round(stddev_samp(whole), 6) AS std_whole
FROM joined""")
def column_stats_q(spark, sf_dir):
    from seqtally.operators.compare import column_stats
    s = column_stats(_joined(spark, sf_dir), ["focused", "whole"])
    return s.select(*[F.round(c, 6).alias(c) for c in s.columns])


# --- manifest text and sample reconciliation (SRC6, FIL5, FN6, FN7, JN6, SET2) -

MANIFEST_PARSE_SQL = r"""
SELECT split_part(v, ',', 1) AS sample, nullif(split_part(v, ',', 2), '') AS barcode_set
FROM (SELECT regexp_replace(value, '[\r\n]+$', '') AS v FROM mlines)
WHERE length(v) > 0 AND NOT starts_with(v, '#')"""


@query("manifest_parse", D.cte(mlines=D.MANIFEST_LINES_SQL) + MANIFEST_PARSE_SQL)
def manifest_parse(spark, sf_dir):
    from seqtally.sources.text import parse_manifest_lines
    return parse_manifest_lines(D.manifest_lines(spark, sf_dir))


@query("reconcile_samples", D.cte(mlines=D.MANIFEST_LINES_SQL, man=MANIFEST_PARSE_SQL,
                                  inputs=D.INPUT_FOLDERS_SQL) + """
SELECT sample, 'manifest_only' AS side FROM (SELECT DISTINCT sample FROM man) m
WHERE sample NOT IN (SELECT sample FROM inputs)
UNION ALL
SELECT sample, 'input_only' AS side FROM (SELECT DISTINCT sample FROM inputs) i
WHERE sample NOT IN (SELECT sample FROM man)""")
def reconcile_samples_q(spark, sf_dir):
    from seqtally.operators.reshape import reconcile_samples
    from seqtally.sources.text import parse_manifest_lines
    man = parse_manifest_lines(D.manifest_lines(spark, sf_dir))
    return reconcile_samples(man, D.input_folders(spark, sf_dir)).select("sample", "side")


@query("sample_counts", D.cte(mlines=D.MANIFEST_LINES_SQL, man=MANIFEST_PARSE_SQL,
                              inputs=D.INPUT_FOLDERS_SQL) + """
SELECT (SELECT count(*) FROM man) AS manifest_rows,
       (SELECT count(DISTINCT sample) FROM man) AS manifest_samples,
       (SELECT count(DISTINCT sample) FROM inputs) AS input_folders""")
def sample_counts_q(spark, sf_dir):
    from seqtally.operators.records import sample_counts
    from seqtally.sources.text import parse_manifest_lines
    man = parse_manifest_lines(D.manifest_lines(spark, sf_dir))
    return sample_counts(man, D.input_folders(spark, sf_dir))


# --- mates (JN8) ------------------------------------------------------------------

@query("pair_mates", D.cte(**D.MATES_SQL) + """
SELECT a.sample, a.read_id, a.sequence AS sequence_1, b.sequence AS sequence_2
FROM r1 a JOIN r2 b ON a.sample = b.sample AND a.read_id = b.read_id""")
def pair_mates_q(spark, sf_dir):
    from seqtally.operators.reshape import pair_mates
    r1, r2 = D.mate_reads(spark, sf_dir)
    return pair_mates(r1, r2)


@query("orphan_mates", D.cte(**D.MATES_SQL) + """
SELECT sample, read_id, 'R1' AS side FROM r1 a
WHERE NOT EXISTS (SELECT 1 FROM r2 b WHERE b.sample = a.sample AND b.read_id = a.read_id)
UNION ALL
SELECT sample, read_id, 'R2' AS side FROM r2 b
WHERE NOT EXISTS (SELECT 1 FROM r1 a WHERE a.sample = b.sample AND a.read_id = b.read_id)""")
def orphan_mates_q(spark, sf_dir):
    from seqtally.operators.reshape import orphan_mates
    r1, r2 = D.mate_reads(spark, sf_dir)
    return orphan_mates(r1, r2)


@query("mate_files", f"""
SELECT 'pool' AS sample, concat('r', CAST(o_orderkey AS VARCHAR)) AS read_id, substr(f, 1, 40) AS sequence_1,
       reverse(translate(substr(f, 25, 40), 'ACGT', 'TGCA')) AS sequence_2
FROM (SELECT o_orderkey, concat({D._sql_t('m', 'o_orderkey')}, {D._sql_t('n', 'o_orderkey')}) AS f FROM orders)""")
def mate_files(spark, sf_dir):
    """Two FASTQ files read side by side in splits of 64 KB; records out of step
    are found by their IDs."""
    from seqtally.functions.sequence import format_fastq_record
    from seqtally.session import scratch_path
    from seqtally.sources.mates import pair_mate_files
    root = scratch_path(spark, "mates")
    files = [f"{root}/pool/reads_{i}.fastq" for i in (1, 2)]
    for path, records in zip(files, D.mate_records(spark, sf_dir)):
        text = format_fastq_record("header", "sequence", "spacer", "quality").alias("value")
        _one_file(spark, records.orderBy("place", "key").select(text), path)
    return pair_mate_files(spark, *files, split_bytes=64 * 1024)


# --- homopolymer load (SRC12) ------------------------------------------------------

@query("synthetic_reads", D.cte(reads=D.SYNTHETIC_SQL, lib="""
SELECT * FROM (VALUES ('synthetic', 0, 'A', 'A'), ('synthetic', 1, 'T', 'T'),
                      ('synthetic', 2, 'G', 'G'), ('synthetic', 3, 'C', 'C'))
  AS b(barcode_set, ord, gene, barcode)""", hits=HITS_SQL, filled=FILLED_SQL, counted=RPM_SQL)
       + "SELECT sample, gene, barcode, read_counts, rpm FROM counted")
def synthetic_reads_q(spark, sf_dir):
    from seqtally.sources.synthetic import synthetic_library
    reads = D.synthetic_from_events(spark, sf_dir)
    lib = prepare_library(synthetic_library(spark))
    return counts_columns(barcode_counts(reads, lib, barcode_set="synthetic"))


@query("synthetic_source", """
SELECT 'synthetic' AS sample, gene, gene AS barcode, n AS read_counts,
       CASE WHEN n > 0 THEN n * 1.0e0 / (4 * n) * 1000000.0e0 ELSE 0.0e0 END AS rpm
FROM (SELECT count(*) AS n FROM events), (VALUES ('A'), ('T'), ('G'), ('C')) AS t(gene)""")
def synthetic_source(spark, sf_dir):
    """The load generator itself: as many reads of each nucleotide as there are
    events, counted."""
    from seqtally.sources.synthetic import synthetic_library, synthetic_reads
    n = D._tbl(spark, sf_dir, "events").count()
    lib = prepare_library(synthetic_library(spark))
    return counts_columns(barcode_counts(synthetic_reads(spark, n), lib, barcode_set="synthetic"))


# --- round trips through files in the shared checkpoint folder (SRC1-3, SNK1,
# SNK4, SRC8) ------------------------------------------------------------------

def _staged_fastq(spark, sf_dir, gz=False):
    from seqtally.session import scratch_path
    from seqtally.sinks import write_fastq
    fq = D.fastq_records(spark, sf_dir, wellformed=True)
    path = scratch_path(spark, "fastq")
    write_fastq(fq.withColumn("sample_dir", F.col("sample")), path,
                partition_by=("sample_dir",), compression="gzip" if gz else None)
    return path


def _read_back(reads):
    return reads.select(F.regexp_replace("sample", "^sample_dir=", "").alias("sample"), "read_id", "sequence")


@query("fastq_plain_roundtrip", D.cte(len_reads=D.LENGTH_READS_SQL, ok=D.FASTQ_WELLFORMED_SQL) + r"""
SELECT sample, regexp_extract(header, '^@(\S*)', 1) AS read_id, sequence FROM ok""")
def fastq_plain_roundtrip(spark, sf_dir):
    """Plain files read in many splits."""
    from seqtally.sources.fastq import read_fastq
    return _read_back(read_fastq(spark, _staged_fastq(spark, sf_dir), split_bytes=64 * 1024))


@query("fastq_named_spacers", D.cte(len_reads=D.LENGTH_READS_SQL, ok=D.FASTQ_WELLFORMED_SQL) + r"""
SELECT sample, regexp_extract(header, '^@(\S*)', 1) AS read_id, sequence FROM ok""")
def fastq_named_spacers(spark, sf_dir):
    """Spacers that repeat the header, and CRLF line ends."""
    from seqtally.session import scratch_path
    from seqtally.sources.fastq import read_fastq
    path = scratch_path(spark, "fastq-crlf")
    fq = D.fastq_records(spark, sf_dir, wellformed=True)
    spacer = F.concat(F.lit("+"), F.substr("header", F.lit(2)))
    lines = F.concat(*(F.concat(c, F.lit(end)) for c, end in (
        (F.col("header"), "\r\n"), (F.col("sequence"), "\r\n"), (spacer, "\r\n"), (F.col("quality"), "\r"))))
    (fq.select(lines.alias("value"), F.col("sample").alias("sample_dir"))
     .write.partitionBy("sample_dir").text(path))
    return _read_back(read_fastq(spark, path, split_bytes=256 * 1024))


@query("fastq_roundtrip", D.cte(len_reads=D.LENGTH_READS_SQL, ok=D.FASTQ_WELLFORMED_SQL) + r"""
SELECT sample, regexp_extract(header, '^@(\S*)', 1) AS read_id, sequence FROM ok""")
def fastq_roundtrip(spark, sf_dir):
    from seqtally.sources.fastq import read_fastq
    path = _staged_fastq(spark, sf_dir, gz=True)
    return _read_back(read_fastq(spark, path))


@query("fastq_block_gzip", D.cte(len_reads=D.LENGTH_READS_SQL, ok=D.FASTQ_WELLFORMED_SQL) + r"""
SELECT regexp_extract(header, '^@(\S*)', 1) AS read_id, sequence FROM ok""")
def fastq_block_gzip(spark, sf_dir):
    """Block-gzip files read in splits that are smaller than a block and larger."""
    from seqtally.session import scratch_path
    from seqtally.sinks import write_fastq_blocks
    from seqtally.sources.fastq import read_fastq
    paths = write_fastq_blocks(D.fastq_records(spark, sf_dir, wellformed=True), scratch_path(spark, "fastq-blocks"))
    return read_fastq(spark, paths, split_bytes=100_000).select("read_id", "sequence")


@query("fastq_full_roundtrip", D.cte(len_reads=D.LENGTH_READS_SQL, ok=D.FASTQ_WELLFORMED_SQL) + """
SELECT header, sequence, spacer, quality FROM ok""")
def fastq_full_roundtrip(spark, sf_dir):
    from seqtally.sources.fastq import read_fastq_full
    path = _staged_fastq(spark, sf_dir)
    return read_fastq_full(spark, path, split_bytes=64 * 1024).select(
        "header", "sequence", "spacer", "quality")


@query("counts_roundtrip", D.cte(**BASE, hits=HITS_SQL, ch=CHUNK_SQL) + """
SELECT c.sample, b.gene, b.barcode, CAST(sum(c.n) AS BIGINT) AS read_counts,
       CAST(count(*) AS BIGINT) AS n_chunks
FROM ch c JOIN lib b ON b.ord = c.ord GROUP BY c.sample, b.gene, b.barcode""")
def counts_roundtrip(spark, sf_dir):
    from seqtally.session import scratch_path
    from seqtally.sinks import write_hits_parquet
    from seqtally.sources.text import read_counts_parquet
    _, lib, hits = _first_match(spark, sf_dir)
    path = scratch_path(spark, "chunks")
    write_hits_parquet(C.chunk_counts(hits, lib, CHUNK), path)
    return C.merge_counts(read_counts_parquet(spark, path))


@query("library_roundtrip", D.cte(lib_raw=D.LIBRARY_RAW_SQL, lib=D.LIBRARY_SQL)
       + "SELECT barcode_set, ord, gene, barcode FROM lib")
def library_roundtrip(spark, sf_dir):
    """Library written as ``gene:barcode`` text in part order, read back:
    ``ord`` must come back from file order alone."""
    from seqtally.session import scratch_path
    from seqtally.sources.text import read_barcodes
    path = scratch_path(spark, "library")
    raw = D.library_raw(spark, sf_dir)
    (raw.orderBy("ord").select(F.concat_ws(":", "gene", "barcode").alias("value"))
     .write.mode("overwrite").text(path))
    return prepare_library(read_barcodes(spark, path, sep=":", barcode_set=D.LIBRARY_SET))


@query("compare_files", D.cte(**COMPARE_SQL) + "SELECT key, focused, whole FROM joined")
def compare_files(spark, sf_dir):
    """Both count tables written as ``key:value`` summaries and compared from
    the files, as the comparison notebook does."""
    from seqtally.operators.compare import compare_counts
    from seqtally.session import scratch_path
    from seqtally.sources.text import read_key_values
    j = _joined(spark, sf_dir)
    paths = []
    for col in ("focused", "whole"):
        p = scratch_path(spark, f"kv-{col}")
        (j.filter(F.col(col).isNotNull())
         .select(F.concat_ws(":", "key", F.col(col).cast("string")).alias("value"))
         .write.mode("overwrite").text(p))
        paths.append(p)
    return compare_counts(read_key_values(spark, paths[0]), read_key_values(spark, paths[1]))


@query("barcode_list_roundtrip", D.cte(**FLANK_SQL) + """
SELECT CAST(row_number() OVER (ORDER BY barcode) - 1 AS BIGINT) AS idx, barcode
FROM (SELECT DISTINCT barcode FROM ext WHERE barcode IS NOT NULL)""")
def barcode_list_roundtrip(spark, sf_dir):
    from seqtally.operators.flank import distinct_barcodes
    from seqtally.session import scratch_path
    from seqtally.sinks import write_barcode_list
    from seqtally.sources.text import read_barcode_list
    path = scratch_path(spark, "barcode-list")
    write_barcode_list(distinct_barcodes(_flank(spark, sf_dir)), path)
    return read_barcode_list(spark, path)


@query("counts_csv_roundtrip", D.cte(**COUNTED)
       + "SELECT sample, gene, barcode, read_counts, rpm FROM counted")
def counts_csv_roundtrip(spark, sf_dir):
    from seqtally.session import scratch_path
    from seqtally.sinks import write_counts_csv
    path = scratch_path(spark, "counts-csv")
    write_counts_csv(_counts(spark, sf_dir), path)
    back = (spark.read.option("header", True)
            .schema("Gene string, Barcode string, Read_counts long, RPM double, sample string")
            .csv(path))
    return back.select("sample", F.col("Gene").alias("gene"), F.col("Barcode").alias("barcode"),
                       F.col("Read_counts").alias("read_counts"), F.col("RPM").alias("rpm"))


@query("flank_stats_lines", D.cte(flanked=D.FLANKED_READS_SQL, lines=D.FLANKED_LINES_SQL) + f"""
SELECT count(*) AS total_reads, count(barcode) AS detected_reads,
       CASE WHEN count(*) > 0 THEN count(barcode) * 1.0e0 / count(*) END AS detection_rate
FROM (SELECT nullif(regexp_extract(value,
         '(?i)(' || '{D.UPSTREAM_FLANK}' || ')(.{{30}})(' || '{D.DOWNSTREAM_FLANK}' || ')', 2), '')
       AS barcode
      FROM lines WHERE regexp_matches(value, '^[ATGCatgcN]'))""")
def flank_stats_lines(spark, sf_dir):
    """Flank statistics over raw FASTQ text lines, as the reference counts
    them (sequence-like quality lines included)."""
    from seqtally.operators.flank import extract_from_lines, flank_stats
    return flank_stats(extract_from_lines(D.flanked_fastq_lines(spark, sf_dir)))


@query("length_split_files", D.cte(len_reads=D.LENGTH_READS_SQL, ok=D.FASTQ_WELLFORMED_SQL,
                                   windows=_windows_sql()) + """
SELECT w.fragment, o.header, o.sequence, o.quality
FROM ok o JOIN windows w
  ON length(o.sequence) BETWEEN w.target_len - w.tolerance AND w.target_len + w.tolerance""")
def length_split_files(spark, sf_dir):
    """Length separation end to end: records split into windows, written as
    one FASTQ folder per fragment, read back with the full-record source."""
    from seqtally.operators.reshape import length_windows, split_by_length
    from seqtally.session import scratch_path
    from seqtally.sinks import write_fastq
    from seqtally.sources.fastq import read_fastq_full
    fq = D.fastq_records(spark, sf_dir, wellformed=True)
    path = scratch_path(spark, "length-split")
    write_fastq(split_by_length(fq, length_windows(spark)), path, partition_by=("fragment",))
    back = read_fastq_full(spark, path, split_bytes=256 * 1024)
    return back.select(F.regexp_extract("file", r"fragment=([^/]+)/", 1).alias("fragment"),
                       "header", "sequence", "quality")


# --- sinks read back (SNK6, SNK7, SNK8), text blocks (SRC10) ----------------------

@query("comparison_csv_roundtrip", D.cte(**COMPARE_SQL) + "SELECT key, focused, whole FROM joined")
def comparison_csv_roundtrip(spark, sf_dir):
    from seqtally.session import scratch_path
    from seqtally.sinks import write_comparison_csv
    path = scratch_path(spark, "comparison")
    write_comparison_csv(_joined(spark, sf_dir), path)
    return spark.read.option("header", True).schema("key string, focused double, whole double").csv(path)


@query("line_counts_csv_roundtrip", ORACLES["line_counts"])
def line_counts_csv_roundtrip(spark, sf_dir):
    from seqtally.session import scratch_path
    from seqtally.sinks import write_line_counts_csv
    path = scratch_path(spark, "line-counts")
    write_line_counts_csv(line_counts(spark, sf_dir), path)
    return spark.read.schema("gene string, barcode string, n_lines long").csv(path)


@query("overwrite_roundtrip", D.cte(**COUNTED) + """
SELECT sample, gene, barcode, CASE WHEN sample = 'P' THEN read_counts + 1 ELSE read_counts END AS read_counts
FROM counted""")
def overwrite_roundtrip(spark, sf_dir):
    """Results written twice to one folder: the second write has samples F and
    O only and replaces them, sample P stays as it was."""
    from seqtally.operators._util import staged
    from seqtally.session import scratch_path
    from seqtally.sinks import write_counts_csv
    path = scratch_path(spark, "overwrite")
    counts = staged(_counts(spark, sf_dir), "counts")
    write_counts_csv(counts.withColumn("read_counts", F.col("read_counts") + 1), path)
    write_counts_csv(counts.filter("sample <> 'P'"), path)
    back = (spark.read.option("header", True)
            .schema("Gene string, Barcode string, Read_counts long, RPM double, sample string").csv(path))
    return back.select("sample", F.col("Gene").alias("gene"), F.col("Barcode").alias("barcode"),
                       F.col("Read_counts").alias("read_counts"))


@query("text_lines", D.cte(**FQ, lines=LINES_SQL) + "SELECT value, count(*) AS n FROM lines GROUP BY value")
def text_lines(spark, sf_dir):
    """FASTQ lines written as text and read in blocks of 64 KB."""
    from seqtally.session import scratch_path
    from seqtally.sources.text import read_text_lines
    path = scratch_path(spark, "lines")
    _lines(spark, sf_dir).select("value").write.text(path)
    lines = read_text_lines(spark, path, block_bytes=64 * 1024)
    return lines.groupBy("value").agg(F.count(F.lit(1)).alias("n"))


# --- a whole project from files (SRC6, SRC7, FIL8, SRT3, SNK2, SNK3, JN7) ----------

PROJECT_MANIFEST = [("F", "part.txt"), ("O", "part.txt"), ("O", "nations.txt"), ("P", "nations.txt"), ("Z", "part.txt")]
PROJECT_SQL = dict(reads=D.READS_SQL, raw="""
SELECT 'part.txt' AS barcode_set, ord, gene, barcode FROM (""" + D.LIBRARY_RAW_SQL + """)
UNION ALL SELECT 'nations.txt', ord, gene, barcode FROM (""" + D.LIBRARY_NATIONS_RAW_SQL + ")",
                   lib=D.LIBRARY_SQL.replace("lib_raw", "raw"),
                   man="SELECT * FROM (VALUES " + ", ".join(f"('{s}', '{b}')" for s, b in PROJECT_MANIFEST)
                       + ") AS m(sample, barcode_set)", hits="""
SELECT r.sample, r.read_key, m.barcode_set, min(b.ord) AS ord
FROM reads r JOIN man m ON m.sample = r.sample
JOIN lib b ON b.barcode_set = m.barcode_set AND contains(r.sequence, b.barcode)
GROUP BY r.sample, r.read_key, m.barcode_set""")


def _one_file(spark, df, path):
    """The rows of ``df`` (value) as one text file ``path``, as users have it:
    written in parts, in their order, whose bytes a task then joins."""
    from seqtally.session import scratch_path
    from seqtally.sources.fastq import join_files
    folder = scratch_path(spark, "one-file")
    df.write.text(folder)
    join_files(spark, folder, path)


def _project(spark, sf_dir):
    """A project's folders and files from the driver tables: a FASTQ file per
    sample with a leftover of split files beside it, an unlisted folder without
    a FASTQ file, an empty folder, barcode files and a manifest."""
    from seqtally.session import scratch_path
    root = scratch_path(spark, "project")
    reads = D.reads(spark, sf_dir)
    record = F.concat_ws("\n", F.concat(F.lit("@"), "read_id"), "sequence", F.lit("+"),
                         F.repeat(F.lit("I"), F.length("sequence")))
    for sample in ("F", "O", "P"):
        own = reads.filter(F.col("sample") == sample).select(record.alias("value"))
        _one_file(spark, own, f"{root}/Input/{sample}/reads.fastq")
        _one_file(spark, own.limit(3), f"{root}/Input/{sample}/Split_files/split_000000.fastq")
    lines = lambda rows: spark.createDataFrame([(r,) for r in rows], "value string")
    _one_file(spark, lines(["no reads here"]), f"{root}/Input/notes/readme.txt")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/Input/empty")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)
    for name, raw in (("part.txt", D.library_raw), ("nations.txt", D.library_nations_raw)):
        _one_file(spark, raw(spark, sf_dir).orderBy("ord").select(F.concat_ws(":", "gene", "barcode").alias("value")),
                  f"{root}/Barcodes/{name}")
    _one_file(spark, lines(["# sample,barcode file", *(f"{s},{b}" for s, b in PROJECT_MANIFEST), ""]), f"{root}/project.txt")
    return root


def _run(spark, sf_dir, with_ids=False):
    from seqtally.plans.project import run_project
    root = _project(spark, sf_dir)
    run_project(spark, f"{root}/Input", f"{root}/project.txt", f"{root}/Barcodes", f"{root}/Output", with_ids=with_ids)
    return f"{root}/Output"


@query("project_run", D.cte(**PROJECT_SQL, filled="""
SELECT m.sample, m.barcode_set, b.gene, b.barcode, CAST(coalesce(c.n, 0) AS BIGINT) AS read_counts
FROM man m JOIN lib b ON b.barcode_set = m.barcode_set
LEFT JOIN (SELECT sample, barcode_set, ord, count(*) AS n FROM hits GROUP BY ALL) c
  ON c.sample = m.sample AND c.barcode_set = m.barcode_set AND c.ord = b.ord""") + """
SELECT f.sample, f.barcode_set, f.gene, f.barcode, f.read_counts,
       CASE WHEN t.tot > 0 THEN f.read_counts * 1.0e0 / t.tot * 1000000.0e0 ELSE 0.0e0 END AS rpm
FROM filled f JOIN (SELECT sample, barcode_set, CAST(sum(read_counts) AS BIGINT) AS tot
                    FROM filled GROUP BY ALL) t ON t.sample = f.sample AND t.barcode_set = f.barcode_set""")
def project_run(spark, sf_dir):
    """Files in, result CSV out and read back."""
    back = (spark.read.option("header", True)
            .schema("Gene string, Barcode string, Read_counts long, RPM double, barcode_set string, sample string")
            .csv(f"{_run(spark, sf_dir)}/counts"))
    return back.select("sample", "barcode_set", F.col("Gene").alias("gene"), F.col("Barcode").alias("barcode"),
                       F.col("Read_counts").alias("read_counts"), F.col("RPM").alias("rpm"))


@query("project_stats", D.cte(**PROJECT_SQL) + """
SELECT m.sample, m.barcode_set, CAST(coalesce(t.n, 0) AS BIGINT) AS total_reads,
       CAST(coalesce(h.n, 0) AS BIGINT) AS detected_reads
FROM man m LEFT JOIN (SELECT sample, count(*) AS n FROM reads GROUP BY sample) t ON t.sample = m.sample
LEFT JOIN (SELECT sample, barcode_set, count(*) AS n FROM hits GROUP BY ALL) h
  ON h.sample = m.sample AND h.barcode_set = m.barcode_set""")
def project_stats(spark, sf_dir):
    """The statistics text of a run that also writes ID lists, read back."""
    text = (spark.read.schema("value string, barcode_set string, sample string")
            .text(f"{_run(spark, sf_dir, with_ids=True)}/stats", wholetext=True))
    number = lambda label: F.regexp_extract("value", f"{label}: (\\d+)", 1).cast("long")
    return text.select("sample", "barcode_set", number("Total read").alias("total_reads"),
                       number("Detected read").alias("detected_reads"))


@query("discover_inputs", """
SELECT DISTINCT o_orderstatus AS sample, 'reads.fastq' AS file FROM orders
UNION ALL SELECT * FROM (VALUES ('notes', NULL), ('empty', NULL)) AS t(sample, file)""")
def discover_inputs_q(spark, sf_dir):
    from seqtally.sources.text import discover_inputs
    found = discover_inputs(spark, f"{_project(spark, sf_dir)}/Input", strict=False)
    return found.select("sample", F.regexp_extract("path", "[^/]+$", 0).alias("file"))
