import pytest

from kestrel.operators.aggregates import box_summary
from kestrel.operators.quantiles import exact_quantiles


@pytest.fixture
def no_size_estimates(spark):
    """The planner may broadcast nothing on its own."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rows_of_few_groups_are_not_shuffled_by_group(spark, no_size_estimates):
    df = spark.createDataFrame([(i % 2, float(i)) for i in range(200)] + [(None, 5.0), (1, None)], "g int, x double")
    for out in (exact_quantiles(df, ["x"], [0.5], by=["g"]), box_summary(df, "x", ["g"])):
        assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()
    got = {r["g"]: (r["q1"], r["median"], r["n_outliers"]) for r in box_summary(df, "x", ["g"]).collect()}
    assert got == {0: (49.5, 99.0, 0), 1: (50.5, 100.0, 0)}
