from seqtally.sources.fastq import (  # noqa: F401
    FastqDataSource, manifest_from_paths, read_fastq, read_fastq_full, register_fastq_source)
from seqtally.sources.mates import pair_mate_files, read_mates  # noqa: F401
from seqtally.sources.synthetic import synthetic_library, synthetic_reads  # noqa: F401
from seqtally.sources.text import (  # noqa: F401
    discover_inputs, parse_manifest_lines, read_barcode_list, read_barcodes,
    read_counts_parquet, read_key_values, read_manifest, read_text_lines)
