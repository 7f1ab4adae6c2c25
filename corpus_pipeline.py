"""A corpus cleaning pipeline of the training-data operators.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
stage's ``docs``.  Every stage works on all its predecessor kept.  All stages
but the last return the columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from seqtally.llm._files import staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the boosted trees keep."""
    from seqtally.llm.quality_rules import apply_rules, train
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return apply_rules(docs, train(docs, labels)).filter("kept").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    from seqtally.llm.dart_minhash import one_of_each
    return one_of_each(docs)


def substring_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has; a document of
    which no word is left goes."""
    from seqtally.llm.substring import remove_repeats
    cut = remove_repeats(docs).filter("n_removed = 0 OR n_removed < n_words")
    chars = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", chars.cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    from seqtally.llm.decontam import remove_documents
    return remove_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents' ids and decoded texts, as counts and digests."""
    import public_tokenizers

    from seqtally.llm.bpe_table import bpe_digests
    return bpe_digests(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality rules", quality_rules), ("near duplicates", near_duplicates),
          ("substring duplicates", substring_duplicates), ("benchmark decontamination", decontamination), ("BPE", bpe)]

#: None: the stages train models, tokenize and join signatures, which SQL does
#: not express; tests/llm/test_pipeline.py compares run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; the last stage's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
