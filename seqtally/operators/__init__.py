from seqtally.operators.counts import (  # noqa: F401
    chunk_counts, count_barcodes_per_read, count_hits, count_lines_matching, count_matched,
    fractional_counts, head, ids_by_barcode, merge_counts, read_stats, rpm, run_pairs,
    top_barcodes, with_genes, zero_fill)
from seqtally.operators.library import (  # noqa: F401
    dedup_barcodes, is_unique, normalize_barcodes, prepare_library)
from seqtally.operators.match import (  # noqa: F401
    assign_first_match, candidates, match_all, match_counts, matched_reads, read_outcomes)
from seqtally.operators.compare import (  # noqa: F401
    column_stats, compare_counts, drop_upper_outliers, zscore)
from seqtally.operators.flank import (  # noqa: F401
    distinct_barcodes, extract_barcodes, flank_stats)
from seqtally.operators.index import occurrence, with_index  # noqa: F401
from seqtally.operators.records import (  # noqa: F401
    grep, sample_counts, union_counts, validate_fastq)
from seqtally.operators.reshape import (  # noqa: F401
    length_windows, orphan_mates, pair_mates, reconcile_samples, relabel_samples,
    reverse_complement_reads, split_by_length)
