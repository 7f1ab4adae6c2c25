"""Bounded samples for fitting dictionaries and models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hashed_sample(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """About ``rows`` rows (never more than twice as many), picked by a hash of
    ``keys``: a filter inside the scan, so no task and not the driver sees more
    than the sample.  All of ``df`` if it has no more rows."""
    n = df.count()
    if n <= rows:
        return df
    below = min(2 ** 63 - 1, -2 ** 63 + (rows * 2 ** 64) // n)
    return df.filter(F.xxhash64(*keys) < F.lit(below).cast("long")).limit(2 * rows)


def distinct_sample(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """About ``rows`` of the distinct ``keys`` of ``df``, picked by their hash in
    the scan; repeated rows count once, so the sample depends on nothing but what
    the rows hold.  With at most ``rows`` rows, all their keys."""
    own = df.select(*keys)
    n = df.count()
    if n > rows:
        own = own.filter(F.xxhash64(*keys) < F.lit(min(2 ** 63 - 1, -2 ** 63 + (rows * 2 ** 64) // n)).cast("long"))
    return own.distinct()


def one_text_each(docs: DataFrame, picked: DataFrame) -> DataFrame:
    """``picked`` (doc_id, ...; a bounded sample, broadcast) with the text of each
    id.  Of an id's texts that with the smallest hash counts, so there is a row
    for an id however often it occurs; copies collapse before they are shuffled."""
    hashed = F.struct(F.xxhash64("text").alias("hash"), "text")
    own = docs.select("doc_id", "text").join(F.broadcast(picked.select("doc_id")), "doc_id")
    one = own.groupBy("doc_id").agg(F.min(hashed).alias("one")).select("doc_id", "one.text")
    return one.join(F.broadcast(picked), "doc_id")
