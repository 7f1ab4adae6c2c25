"""Sequencing-shaped inputs derived from the driver's tables.

The driver tables hold no DNA, so reads and libraries are derived with
functions Spark and DuckDB share (md5, translate, substr, concat, repeat).
Each Spark derivation has a SQL twin (a CTE body) used by the oracles; both
read the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqtally.functions.sequence import (DOWNSTREAM_FLANK, IUPAC_FROM, IUPAC_TO,  # noqa: F401
                                         UPSTREAM_FLANK,
                                         dna_from_text)
from seqtally.operators._util import spread

LIBRARY_SET = "part"


def _nn(c: Column) -> Column:
    """Derived text is never NULL; declaring it keeps Catalyst from inferring
    an IS NOT NULL filter on it and pushing that (with the whole derivation)
    below the spreading shuffle into the single scan task."""
    return F.coalesce(c, F.lit(""))


def _tbl(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _t(prefix: str, key: Column) -> Column:
    return dna_from_text(F.concat(F.lit(prefix), key.cast("string")))


def _sql_t(prefix: str, key: str) -> str:
    return (f"translate(md5(concat('{prefix}', CAST({key} AS VARCHAR))), "
            f"'0123456789abcdef', 'ACGTACGTACGTACGT')")


# --- reads: orders (o_orderkey is unique at every scale) ---------------------

def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spread(_tbl(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"))
    k = F.col("o_orderkey")
    seq = F.substr(F.concat(_t("a", k), _t("b", k), _t("c", k)), F.lit(1),
                   (F.lit(80) + k % 17).cast("int"))
    return o.select(F.col("o_orderstatus").alias("sample"), k.alias("read_key"),
                    F.concat(F.lit("r"), k.cast("string")).alias("read_id"),
                    _nn(seq).alias("sequence"))


READS_SQL = f"""
SELECT o_orderstatus AS sample, o_orderkey AS read_key,
       concat('r', CAST(o_orderkey AS VARCHAR)) AS read_id,
       substr(concat({_sql_t('a', 'o_orderkey')}, {_sql_t('b', 'o_orderkey')},
                     {_sql_t('c', 'o_orderkey')}),
              1, CAST(80 + o_orderkey % 17 AS INTEGER)) AS sequence
FROM orders"""


# --- library: part; 8..10 nt, some barcodes repeat (dedup is exercised) -------

def library_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _tbl(spark, sf_dir, "part").select("p_partkey", "p_brand")
    k = F.col("p_partkey")
    bc = F.substr(dna_from_text(k.cast("string")), F.lit(1), (F.lit(8) + k % 3).cast("int"))
    return p.select(F.lit(LIBRARY_SET).alias("barcode_set"), k.alias("ord"),
                    F.col("p_brand").alias("gene"), bc.alias("barcode"))


LIBRARY_RAW_SQL = f"""
SELECT '{LIBRARY_SET}' AS barcode_set, p_partkey AS ord, p_brand AS gene,
       substr(translate(md5(CAST(p_partkey AS VARCHAR)), '0123456789abcdef',
                        'ACGTACGTACGTACGT'), 1, CAST(8 + p_partkey % 3 AS INTEGER)) AS barcode
FROM part"""

LIBRARY_SQL = """
SELECT barcode_set, ord, gene, barcode FROM (
  SELECT barcode_set, ord, gene, upper(barcode) AS barcode,
         row_number() OVER (PARTITION BY barcode_set, upper(barcode) ORDER BY ord) AS rn
  FROM lib_raw) WHERE rn = 1"""


# --- length reads: events; 180..289 nt so the windows 194/268/278 are hit -----

def length_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spread(_tbl(spark, sf_dir, "events").select("event_id", "event_type"))
    k = F.col("event_id")
    seq = F.substr(F.repeat(dna_from_text(k.cast("string")), 10), F.lit(1),
                   (F.lit(180) + k % 110).cast("int"))
    return e.select(F.col("event_type").alias("sample"), k.alias("read_key"),
                    F.concat(F.lit("e"), k.cast("string")).alias("read_id"),
                    _nn(seq).alias("sequence"))


LENGTH_READS_SQL = """
SELECT event_type AS sample, event_id AS read_key,
       concat('e', CAST(event_id AS VARCHAR)) AS read_id,
       substr(repeat(translate(md5(CAST(event_id AS VARCHAR)), '0123456789abcdef',
                               'ACGTACGTACGTACGT'), 10),
              1, CAST(180 + event_id % 110 AS INTEGER)) AS sequence
FROM events"""


# --- flanked reads: events; upper-case hit, lower-case hit, noise -------------

def flanked_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spread(_tbl(spark, sf_dir, "events").select("event_id", "event_type"))
    k = F.col("event_id")
    x20 = F.substr(_t("x", k), F.lit(1), F.lit(20))
    y30 = F.substr(_t("y", k), F.lit(1), F.lit(30))
    seq = (F.when(k % 6 == 0, F.concat(x20, F.lit(UPSTREAM_FLANK), y30, F.lit(DOWNSTREAM_FLANK)))
           .when(k % 6 == 3, F.lower(F.concat(F.lit(UPSTREAM_FLANK), y30, F.lit(DOWNSTREAM_FLANK))))
           .otherwise(F.repeat(_t("z", k), 3)))
    return e.select(F.col("event_type").alias("sample"), k.alias("read_key"),
                    F.concat(F.lit("e"), k.cast("string")).alias("read_id"),
                    _nn(seq).alias("sequence"))


FLANKED_READS_SQL = f"""
SELECT event_type AS sample, event_id AS read_key,
       concat('e', CAST(event_id AS VARCHAR)) AS read_id,
       CASE WHEN event_id % 6 = 0
              THEN concat(substr({_sql_t('x', 'event_id')}, 1, 20), '{UPSTREAM_FLANK}',
                          substr({_sql_t('y', 'event_id')}, 1, 30), '{DOWNSTREAM_FLANK}')
            WHEN event_id % 6 = 3
              THEN lower(concat('{UPSTREAM_FLANK}', substr({_sql_t('y', 'event_id')}, 1, 30),
                                '{DOWNSTREAM_FLANK}'))
            ELSE repeat({_sql_t('z', 'event_id')}, 3) END AS sequence
FROM events"""


# --- full FASTQ records: events; quality from md5, some records malformed -----

_QUAL_FROM = "0123456789abcdef"
_QUAL_TO = "!+5?@IAFKE:,#-\"_"   # includes '@', '+', ',' and '"' on purpose


def fastq_records(spark: SparkSession, sf_dir: str, wellformed: bool = False) -> DataFrame:
    """Four-field records.  Unless ``wellformed``, every 13th record has a
    quality one character short and every 17th a spacer that is not '+';
    they exercise validation.  Well-formed records (all of them valid) feed
    the file round trips."""
    r = length_reads(spark, sf_dir)
    k = F.col("read_key")
    qual_full = F.substr(F.repeat(F.translate(F.md5(F.concat(F.lit("q"), k.cast("string"))),
                                              _QUAL_FROM, _QUAL_TO), 10),
                         F.lit(1), F.length("sequence"))
    if wellformed:
        qual, spacer = qual_full, F.lit("+")
    else:
        qual = F.when(k % 13 == 5, F.substr(qual_full, F.lit(2), F.length("sequence"))) \
            .otherwise(qual_full)
        spacer = F.when(k % 17 == 4, F.lit("-")).otherwise(F.lit("+"))
    header = F.concat(F.lit("@"), F.col("read_id"), F.lit(" "), F.col("sample"),
                      F.lit(":"), k.cast("string"))
    return r.select("sample", "read_key", header.alias("header"), "sequence",
                    spacer.alias("spacer"), qual.alias("quality"))


FASTQ_RECORDS_SQL = f"""
SELECT sample, read_key,
       concat('@', read_id, ' ', sample, ':', CAST(read_key AS VARCHAR)) AS header,
       sequence,
       CASE WHEN read_key % 17 = 4 THEN '-' ELSE '+' END AS spacer,
       CASE WHEN read_key % 13 = 5 THEN substr(qf, 2, length(sequence)) ELSE qf END AS quality
FROM (SELECT *, substr(repeat(translate(md5(concat('q', CAST(read_key AS VARCHAR))),
                                        '{_QUAL_FROM}', '{_QUAL_TO.replace("'", "''")}'), 10),
                       1, length(sequence)) AS qf
      FROM len_reads)"""


FASTQ_WELLFORMED_SQL = f"""
SELECT sample, read_key,
       concat('@', read_id, ' ', sample, ':', CAST(read_key AS VARCHAR)) AS header,
       sequence, '+' AS spacer,
       substr(repeat(translate(md5(concat('q', CAST(read_key AS VARCHAR))),
                               '{_QUAL_FROM}', '{_QUAL_TO.replace("'", "''")}'), 10),
              1, length(sequence)) AS quality
FROM len_reads"""


def cte(**bodies: str) -> str:
    """WITH clause from name=body pairs (order kept)."""
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in bodies.items()) + "\n"


# --- library split into sets by part type (manifest: sample -> set) ----------

def library_typed_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _tbl(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    k = F.col("p_partkey")
    bc = F.substr(dna_from_text(k.cast("string")), F.lit(1), (F.lit(8) + k % 3).cast("int"))
    return p.select(F.col("p_type").alias("barcode_set"), k.alias("ord"),
                    F.col("p_brand").alias("gene"), bc.alias("barcode"))


LIBRARY_TYPED_RAW_SQL = """
SELECT p_type AS barcode_set, p_partkey AS ord, p_brand AS gene,
       substr(translate(md5(CAST(p_partkey AS VARCHAR)), '0123456789abcdef',
                        'ACGTACGTACGTACGT'), 1, CAST(8 + p_partkey % 3 AS INTEGER)) AS barcode
FROM part"""


# --- further library shapes ----------------------------------------------------

def library_nations_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A set of 4-nt barcodes, one for each nation."""
    n = _tbl(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return n.select(F.lit("NATIONS").alias("barcode_set"), F.col("n_nationkey").cast("long").alias("ord"),
                    F.col("n_name").alias("gene"), F.substr(_t("n", F.col("n_nationkey")), F.lit(1), F.lit(4)).alias("barcode"))


LIBRARY_NATIONS_RAW_SQL = f"""
SELECT 'NATIONS' AS barcode_set, CAST(n_nationkey AS BIGINT) AS ord, n_name AS gene,
       substr({_sql_t('n', 'n_nationkey')}, 1, 4) AS barcode FROM nation"""


def library_mixed_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return library_typed_raw(spark, sf_dir).unionByName(library_nations_raw(spark, sf_dir))


LIBRARY_MIXED_RAW_SQL = LIBRARY_TYPED_RAW_SQL + " UNION ALL " + LIBRARY_NATIONS_RAW_SQL


def library_regex_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patterns of each kind by supplier (a class, a wildcard beside a run, a
    repeat, a choice, and plain barcodes), and behind them a choice for each
    part, with a wildcard or an optional class after it."""
    s = _tbl(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    k = F.col("s_suppkey")
    b = lambda at, n: F.substr(_t("s", k), F.lit(at), F.lit(n))
    kind = (F.when(k % 5 == 0, F.concat(b(1, 4), F.lit("[AG]"), b(6, 4)))
            .when(k % 5 == 1, F.concat(b(1, 6), F.lit(".T")))
            .when(k % 5 == 2, F.concat(b(1, 2), F.lit("C{2}G+"), b(6, 3)))
            .when(k % 5 == 3, F.concat(F.lit("("), b(1, 5), F.lit("|"), b(11, 5), F.lit(")G")))
            .otherwise(b(1, 8)))
    own = s.select(F.lit("REGEX").alias("barcode_set"), k.cast("long").alias("ord"), F.col("s_name").alias("gene"), kind.alias("barcode"))
    p = _tbl(spark, sf_dir, "part").select("p_partkey", "p_brand")
    j = F.col("p_partkey")
    c = lambda at, n: F.substr(_t("p", j), F.lit(at), F.lit(n))
    choice = F.concat(F.lit("("), c(1, 7), F.lit("|"), c(9, 8), F.when(j % 2 == 0, ").").otherwise(")[AG]?"), c(20, 1))
    return own.unionByName(p.select(F.lit("REGEX").alias("barcode_set"), (j + 10 ** 9).cast("long").alias("ord"),
                                    F.col("p_brand").alias("gene"), choice.alias("barcode")))


LIBRARY_REGEX_RAW_SQL = f"""
SELECT 'REGEX' AS barcode_set, CAST(s_suppkey AS BIGINT) AS ord, s_name AS gene,
       CASE s_suppkey % 5 WHEN 0 THEN concat(substr(t, 1, 4), '[AG]', substr(t, 6, 4))
         WHEN 1 THEN concat(substr(t, 1, 6), '.T')
         WHEN 2 THEN concat(substr(t, 1, 2), 'C{{2}}G+', substr(t, 6, 3))
         WHEN 3 THEN concat('(', substr(t, 1, 5), '|', substr(t, 11, 5), ')G')
         ELSE substr(t, 1, 8) END AS barcode
FROM (SELECT s_suppkey, s_name, {_sql_t('s', 's_suppkey')} AS t FROM supplier)
UNION ALL
SELECT 'REGEX', CAST(p_partkey + 1000000000 AS BIGINT), p_brand,
       concat('(', substr(t, 1, 7), '|', substr(t, 9, 8), CASE p_partkey % 2 WHEN 0 THEN ').' ELSE ')[AG]?' END, substr(t, 20, 1))
FROM (SELECT p_partkey, p_brand, {_sql_t('p', 'p_partkey')} AS t FROM part)"""


def library_long_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Barcodes of 20 to 26 nt that lie in the reads of the same key."""
    p = _tbl(spark, sf_dir, "part").select("p_partkey", "p_brand")
    k = F.col("p_partkey")
    bc = F.substr(F.concat(_t("a", k), _t("b", k)), (k % 9 + 1).cast("int"), (F.lit(20) + k % 7).cast("int"))
    return p.select(F.lit("LONG").alias("barcode_set"), k.alias("ord"), F.col("p_brand").alias("gene"), bc.alias("barcode"))


LIBRARY_LONG_RAW_SQL = f"""
SELECT 'LONG' AS barcode_set, p_partkey AS ord, p_brand AS gene,
       substr(concat({_sql_t('a', 'p_partkey')}, {_sql_t('b', 'p_partkey')}),
              CAST(p_partkey % 9 + 1 AS INTEGER), CAST(20 + p_partkey % 7 AS INTEGER)) AS barcode
FROM part"""


def library_lengths_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the barcodes cut to 5 to 7 nt (and after the long ones, or
    they would take all reads first)."""
    k = F.col("ord")
    own = library_long_raw(spark, sf_dir)
    short = k % 4 == 0
    return own.select("barcode_set", F.when(short, k + 10 ** 9).otherwise(k).alias("ord"), "gene",
                      F.when(short, F.substr("barcode", F.lit(1), (F.lit(5) + k % 3).cast("int"))).otherwise(F.col("barcode")).alias("barcode"))


LIBRARY_LENGTHS_RAW_SQL = f"""
SELECT barcode_set, CASE WHEN ord % 4 = 0 THEN ord + 1000000000 ELSE ord END AS ord, gene,
       CASE WHEN ord % 4 = 0 THEN substr(barcode, 1, CAST(5 + ord % 3 AS INTEGER)) ELSE barcode END AS barcode
FROM ({LIBRARY_LONG_RAW_SQL})"""


# --- mates: R1 lacks the '5-LOW' orders, R2 lacks status 'P' -----------------

def mate_reads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    o = spread(_tbl(spark, sf_dir, "orders")
               .select("o_orderkey", "o_orderstatus", "o_orderpriority"))
    k = F.col("o_orderkey")
    base = o.select(F.col("o_orderstatus").alias("sample"),
                    F.concat(F.lit("r"), k.cast("string")).alias("read_id"),
                    "o_orderpriority", k.alias("read_key"),
                    F.concat(_t("m", k), _t("n", k)).alias("fragment"))
    r1 = (base.filter(F.col("o_orderpriority") != "5-LOW")
          .select("sample", "read_id", "read_key",
                  F.substr("fragment", F.lit(1), F.lit(40)).alias("sequence")))
    r2 = (base.filter(F.col("sample") != "P")
          .select("sample", "read_id", "read_key",
                  F.reverse(F.translate(F.substr("fragment", F.lit(25), F.lit(40)),
                                        "ACGT", "TGCA")).alias("sequence")))
    return r1, r2


MATES_SQL = dict(
    frag=f"""SELECT o_orderstatus AS sample, concat('r', CAST(o_orderkey AS VARCHAR)) AS read_id,
       o_orderpriority, concat({_sql_t('m', 'o_orderkey')}, {_sql_t('n', 'o_orderkey')}) AS fragment
FROM orders""",
    r1="""SELECT sample, read_id, substr(fragment, 1, 40) AS sequence FROM frag
WHERE o_orderpriority <> '5-LOW'""",
    r2="""SELECT sample, read_id, reverse(translate(substr(fragment, 25, 40), 'ACGT', 'TGCA')) AS sequence
FROM frag WHERE sample <> 'P'""")


def mate_records(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """FASTQ records of both mates of every order, with the order of each file:
    in the reverse file some records are a little behind their mates."""
    o = spread(_tbl(spark, sf_dir, "orders").select("o_orderkey"))
    k = F.col("o_orderkey")
    fragment = F.concat(_t("m", k), _t("n", k))

    def side(i, sequence, place):
        return o.select(F.concat(F.lit("@r"), k.cast("string"), F.lit(f" {i}:N:0")).alias("header"),
                        sequence.alias("sequence"), F.lit("+").alias("spacer"),
                        F.repeat(F.lit("I"), F.length(sequence)).alias("quality"), place.alias("place"), k.alias("key"))
    return (side(1, F.substr(fragment, F.lit(1), F.lit(40)), k),
            side(2, F.reverse(F.translate(F.substr(fragment, F.lit(25), F.lit(40)), "ACGT", "TGCA")),
                 k + F.when(k % 1024 == 0, 40).otherwise(0)))


# --- manifest text lines: comments, blanks, one-, two- and three-field lines -

def manifest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _tbl(spark, sf_dir, "nation").select("n_name", "n_regionkey")
    r = _tbl(spark, sf_dir, "region").select("r_regionkey", "r_name")
    two = (n.join(r, n.n_regionkey == r.r_regionkey)
           .select(F.concat(F.col("n_name"), F.lit(","), F.col("r_name")).alias("value")))
    rest = r.select(F.explode(F.array(
        F.concat(F.lit("# region "), F.col("r_name")),      # comment
        F.lit(""),                                          # blank
        F.col("r_name"),                                    # one field
        F.concat(F.col("r_name"), F.lit("_ALL,"), F.col("r_name"), F.lit(",extra\n")),
    )).alias("value"))
    return two.unionByName(rest)


MANIFEST_LINES_SQL = """
SELECT concat(n_name, ',', r_name) AS value FROM nation JOIN region ON n_regionkey = r_regionkey
UNION ALL SELECT concat('# region ', r_name) FROM region
UNION ALL SELECT '' FROM region
UNION ALL SELECT r_name FROM region
UNION ALL SELECT concat(r_name, '_ALL,', r_name, ',extra', chr(10)) FROM region"""


def input_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of sample input folders: one per nation with customers, plus the
    sample names of the reads."""
    c = (_tbl(spark, sf_dir, "customer").select("c_nationkey").distinct()
         .select(F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("sample")))
    o = _tbl(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("sample")).distinct()
    return c.unionByName(o)


INPUT_FOLDERS_SQL = """
SELECT DISTINCT concat('NATION_', CAST(c_nationkey AS VARCHAR)) AS sample FROM customer
UNION SELECT DISTINCT o_orderstatus FROM orders"""


# --- synthetic homopolymer reads, one per event ---------------------------------

def synthetic_from_events(spark: SparkSession, sf_dir: str, read_len: int = 300) -> DataFrame:
    from seqtally.sources.synthetic import NUCLEOTIDES
    e = spread(_tbl(spark, sf_dir, "events").select("event_id"))
    k = F.col("event_id")
    nt = F.element_at(F.array(*[F.lit(x) for x in NUCLEOTIDES]), (k % 4 + 1).cast("int"))
    return e.select(F.lit("synthetic").alias("sample"), k.alias("read_key"),
                    F.concat(F.lit("s"), k.cast("string")).alias("read_id"),
                    F.repeat(nt, read_len).alias("sequence"))


SYNTHETIC_SQL = """
SELECT 'synthetic' AS sample, event_id AS read_key, concat('s', CAST(event_id AS VARCHAR)) AS read_id,
       repeat(list_extract(['A', 'T', 'G', 'C'], CAST(event_id % 4 + 1 AS INTEGER)), 300) AS sequence
FROM events"""


# --- flanked reads as FASTQ text lines (for the line-mode flank statistics) --

def flanked_fastq_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = flanked_reads(spark, sf_dir)
    k = F.col("read_key")
    qual = F.substr(F.repeat(F.translate(F.md5(F.concat(F.lit("q"), k.cast("string"))),
                                         _QUAL_FROM, _QUAL_TO), 10),
                    F.lit(1), F.length("sequence"))
    lines = F.array(F.concat(F.lit("@"), F.col("read_id")), F.col("sequence"), F.lit("+"), qual)
    return r.select("read_key", F.posexplode(lines).alias("line_no", "value")).withColumn(
        "line_no", F.col("line_no").cast("long"))


FLANKED_LINES_SQL = f"""
SELECT read_key, CAST(0 AS BIGINT) AS line_no, concat('@', read_id) AS value FROM flanked
UNION ALL SELECT read_key, 1, sequence FROM flanked
UNION ALL SELECT read_key, 2, '+' FROM flanked
UNION ALL SELECT read_key, 3, substr(repeat(translate(md5(concat('q', CAST(read_key AS VARCHAR))),
                                        '{_QUAL_FROM}', '{_QUAL_TO.replace("'", "''")}'), 10),
                                  1, length(sequence)) FROM flanked"""
