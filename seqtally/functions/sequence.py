"""Column functions on nucleotide text.  All are built-in Spark expressions,
so they stay inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the reference for identical results) -----------
# IUPAC nucleotide complement, upper then lower case, as used by common
# bioinformatics libraries: A<->T, C<->G, U->A, M<->K, R<->Y, W, S, V<->B,
# H<->D, N unchanged.
IUPAC_FROM = "ACGTUMRWSYKVHDBNacgtumrwsykvhdbn"
IUPAC_TO = "TGCAAKYWSRMBDHVNtgcaakywsrmbdhvn"
# Constant flanks around an unknown barcode, and the barcode length between.
UPSTREAM_FLANK = "TCTTTTTACTGACTGCAGTCTGAGTCTGACAG"
DOWNSTREAM_FLANK = "AGCAGAGCTACGCACTCTATGCTAGCTCGA"
FLANK_GAP = 30
# First character of a sequence line in flank mode (lower-case n excluded).
SEQUENCE_LINE_PATTERN = "^[ATGCatgcN]"
# Phred+33 qualities 0..62 ('!'..'_').
PHRED33_PATTERN = "^[!-_]*$"
# -----------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def reverse_complement(seq) -> Column:
    """Reverse complement; IUPAC codes complemented, case kept."""
    return F.reverse(F.translate(_c(seq), IUPAC_FROM, IUPAC_TO))


def extract_between(seq, up: str = UPSTREAM_FLANK, down: str = DOWNSTREAM_FLANK,
                    n: int = FLANK_GAP) -> Column:
    """Text between the first case-insensitive ``up .{n} down`` match, as
    written in the read; NULL when there is no match."""
    pattern = f"(?i)({up})(.{{{n}}})({down})"
    return F.nullif(F.regexp_extract(_c(seq), pattern, 2), F.lit(""))


def is_sequence_line(line) -> Column:
    return _c(line).rlike(SEQUENCE_LINE_PATTERN)


def is_literal_barcode(barcode) -> Column:
    """Barcodes made of letters only match as plain substrings; anything else
    is treated as a regular expression."""
    return _c(barcode).rlike("^[A-Z]+$")


def read_id_from_header(header) -> Column:
    """Header token before the first whitespace, without the leading '@'."""
    return F.regexp_extract(_c(header), r"^@(\S*)", 1)


def description_from_header(header) -> Column:
    return F.regexp_extract(_c(header), r"^@\S*\s+(.*)$", 1)


def valid_fastq_record(header, sequence, spacer, quality) -> Column:
    """Structural FASTQ check: '@' header, '+' spacer, sequence and quality of
    equal length, Phred+33 quality characters."""
    h, s, p, q = map(_c, (header, sequence, spacer, quality))
    return F.coalesce(
        h.startswith("@") & p.startswith("+")
        & (F.length(s) == F.length(q)) & (F.length(s) > 0)
        & q.rlike(PHRED33_PATTERN),
        F.lit(False))


def format_fastq_record(header, sequence, spacer, quality) -> Column:
    return F.concat_ws("\n", _c(header), _c(sequence), _c(spacer), _c(quality))


def dna_from_text(x) -> Column:
    """32 nt derived from the md5 of a text (used to derive reads from the
    driver tables; DuckDB has the same md5/translate)."""
    return F.translate(F.md5(_c(x).cast("string")), "0123456789abcdef",
                       "ACGTACGTACGTACGT")
