"""Canonical schemas (explicit; sources never infer)."""

from pyspark.sql.types import (ArrayType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType)

FASTQ_RECORD = StructType([
    StructField("file", StringType()),
    StructField("offset", LongType()),
    StructField("header", StringType()),
    StructField("sequence", StringType()),
    StructField("spacer", StringType()),
    StructField("quality", StringType()),
])

BARCODES = StructType([
    StructField("barcode_set", StringType()),
    StructField("ord", LongType()),
    StructField("gene", StringType()),
    StructField("barcode", StringType()),
])

MANIFEST = StructType([
    StructField("sample", StringType()),
    StructField("barcode_set", StringType()),
])

WINDOWS = StructType([
    StructField("fragment", StringType()),
    StructField("target_len", IntegerType()),
    StructField("tolerance", IntegerType()),
])

CHUNK_COUNTS = StructType([
    StructField("sample", StringType()),
    StructField("chunk", LongType()),
    StructField("gene", StringType()),
    StructField("barcode", StringType()),
    StructField("read_counts", LongType()),
    StructField("ids", ArrayType(StringType())),
])

KEY_VALUE = StructType([
    StructField("key", StringType()),
    StructField("value", DoubleType()),
])

BARCODE_LIST = StructType([
    StructField("idx", LongType()),
    StructField("barcode", StringType()),
])

