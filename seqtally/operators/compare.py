"""Compare two count tables: left join on the key, one-sided outlier cut,
z-scores.  Statistics are scalar subqueries (a separate aggregate job whose
result enters the plan as a value), never a cross join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqtally.operators._util import checkpointed

# --- fixed values: the reference's one-sided outlier cut (mean + 1.96 std) ---
Z_OUTLIER = 1.96
# ------------------------------------------------------------------------------


def compare_counts(src: DataFrame, dst: DataFrame, key: str = "key",
                   value: str = "value", names=("focused", "whole")) -> DataFrame:
    """src LEFT JOIN dst on key, as the reference merges them: a key that
    repeats pairs each of its rows in src with each in dst (count tables have
    one row per key)."""
    a = src.select(key, F.col(value).alias(names[0]))
    b = dst.select(key, F.col(value).alias(names[1]))
    return a.join(b, key, "left")


def _stats(df: DataFrame, cols) -> Column:
    """Mean and sample std of all columns as one scalar subquery (a struct with
    fields m_<col>, s_<col>): one aggregate, however many columns."""
    return df.select(F.struct(*(f(c).alias(f"{p}_{c}") for c in cols
                                for p, f in (("m", F.avg), ("s", F.stddev_samp))))).scalar()


def _staged(df: DataFrame) -> DataFrame:
    """Statistics need a second pass over the table; a comparison table is
    small (one row per key), so it is checkpointed to the shared folder once
    instead of recomputing its whole lineage for each pass."""
    return checkpointed(df)


def drop_upper_outliers(df: DataFrame, col: str, z: float = Z_OUTLIER) -> DataFrame:
    """Keep rows with col <= mean + z * std (sample std); NULL is dropped."""
    df = _staged(df)
    st = _stats(df, [col])
    return df.filter(F.col(col) <= st.getField(f"m_{col}") + F.lit(z) * st.getField(f"s_{col}"))


def column_stats(df: DataFrame, cols) -> DataFrame:
    """One row: mean and sample standard deviation of each column."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"mean_{c}"), F.stddev_samp(c).alias(f"std_{c}")]
    return df.agg(*aggs)


def zscore(df: DataFrame, cols) -> DataFrame:
    """(x - mean) / std for each column, statistics of ``df`` itself; NULL
    where the std is 0 or undefined."""
    df, cols = _staged(df), list(cols)
    st = _stats(df, cols)
    z = {c: F.try_divide(F.col(c) - st.getField(f"m_{c}"), st.getField(f"s_{c}")).alias(c) for c in cols}
    return df.select(*(z.get(c, F.col(c)) for c in df.columns))
