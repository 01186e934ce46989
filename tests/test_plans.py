"""Physical-plan checks: pruning, pushdown and bounded broadcasts."""

from paths import SF_SMALL
from kestrel.plans import all_queries


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_prunes_columns_and_skips_line_items(spark):
    plan = _plan(all_queries()["a1_target_rate_by_make"](spark, SF_SMALL))
    assert "lineitem" not in plan and "part.parquet" not in plan
    assert "o_totalprice" not in plan  # only the needed order columns are read


def test_range_filter_reaches_the_scan(spark):
    plan = _plan(all_queries()["c5_range_filters"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,100000.0)" in plan


def test_line_items_read_only_needed_columns(spark):
    plan = _plan(all_queries()["p6_duplicate_line_key_count"](spark, SF_SMALL))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in plan
