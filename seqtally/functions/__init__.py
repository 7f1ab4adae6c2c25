from seqtally.functions.sequence import (  # noqa: F401
    DOWNSTREAM_FLANK, FLANK_GAP, IUPAC_FROM, IUPAC_TO, UPSTREAM_FLANK,
    description_from_header, dna_from_text, extract_between,
    format_fastq_record, is_literal_barcode, is_sequence_line,
    read_id_from_header, reverse_complement, valid_fastq_record)
