"""Plan invariants of the join-heavy queries, taken from the executed query
(the final adaptive plan of the DataFrame that was collected)."""

import pytest

import __spark_entry__ as E

SMALL = "/root/testdata/sf0.001"
NAMES = ["first_match_rpm", "first_match_stats", "flag_detected", "match_all_counts",
         "manifest_match", "manifest_stats", "line_counts", "synthetic_reads", "split_by_length",
         "relabel_samples", "pair_mates", "orphan_mates", "zero_fill", "union_counts", "sample_counts",
         "regex_match", "stepped_seed_match", "mixed_length_match", "compare_left", "compare_zscore",
         "ids_by_barcode", "first_match_ids", "reconcile_samples"]


def executed(df) -> str:
    """The plan that ran: the DataFrame itself is collected, so its own plan is
    the final one."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    if "AdaptiveSparkPlan" in plan:
        assert "isFinalPlan=true" in plan
    return plan.split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", NAMES)
def test_no_nested_loop_or_product(spark, name):
    plan = executed(E.queries()[name](spark, SMALL))
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_seed_join_is_broadcast_hash(spark):
    plan = executed(E.queries()["flag_detected"](spark, SMALL))
    assert [ln for ln in plan.splitlines() if "BroadcastHashJoin" in ln and "b_h" in ln], plan


def test_no_lists_behind_id_tables(spark):
    for name in ("ids_by_barcode", "fractional_counts"):
        assert "collect_list" not in executed(E.queries()[name](spark, SMALL))


def test_zscore_has_one_aggregate(spark):
    from seqtally.operators.compare import zscore
    df = zscore(spark.createDataFrame([(1.0, 5.0), (3.0, 6.0)], "x double, y double"), ["x", "y"])
    plan = executed(df)
    assert len(set(__import__("re").findall(r"Subquery subquery#(\d+)", plan))) <= 1


def test_size_check_moves_a_row_for_each_task(spark):
    from seqtally.operators._util import size_bytes
    assert size_bytes(spark.range(10).selectExpr("cast(id AS string) AS a")) == 10 * (80 + 8 + 1)
    assert size_bytes(spark.range(0)) == 0
